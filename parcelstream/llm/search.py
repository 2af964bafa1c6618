"""Ranked lexical search by best positions in impact lists.

Terms are maximal runs of ASCII letters and digits and of all characters beyond
ASCII, A-Z lower-cased.  A document's score for an item sums, over the item's
terms with repeats, ``w * ((10^9 * tf) div (1000 * tf + 8 * m))``; weights and
lengths are those of the whole table (``weight``, ``length_factor``).

1. One pass over the documents gives each one's length and its counts of the
   items' terms; document frequencies, N and L are sums over that table.
2. Runs of documents of at most ``SHARD`` counts are shards: a shard keeps one
   list per term, sorted by impact.  A query reads its lists in rounds from the
   top.  Each document met is looked up in all the query's lists at once (direct
   access), which gives its score and marks its place in each list as seen.  A
   list's best position ends the run of places seen from the top without a gap,
   so no unseen document has more than the impact just after it; the sum of
   those impacts bounds all unseen documents.  The query stops once the bound is
   strictly below the k-th score, as a tie may still hold a smaller id.
3. The k-th score that a task has reached is carried to its next shards, and a
   task hands out ``k`` rows an item; a window keeps the best ``k`` of these.

The items are a stated query set: they are taken in blocks of at most
``BLOCK_TERMS`` distinct terms (one item at least), each against all documents.
Nothing else is collected: per block N, L and one count for each of its terms.

Defined cases: null or empty text has no terms, counts in no statistic and is
found by nothing; an item without terms, or whose terms no document holds, has
no rows; rows that repeat a document id are separate documents, and those
without id rank after all ids at equal scores; equal rows of items count as one,
and items that share an id with other texts are separate queries; an empty table
on either side gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelstream.llm import common

TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
SHARD = 1 << 20
BLOCK_TERMS = 1 << 18
FIRST_ROUND = 32
NO_ID = np.iinfo(np.int64).max


def terms(text: bytes) -> list[bytes]:
    return TERM.findall(text.lower())


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def length_factor(n: int, docs: int, length: int) -> int:
    return 25 + (75 * n * docs) // length


def blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple]]:
    """The items, in blocks: lists of (item id, its terms counted)."""
    rows = items.select(F.col(f"`{id_col}`").cast("long").alias("item"),
                        F.col(f"`{text_col}`").alias("text")).distinct()
    block, held = [], set()
    for r in rows.orderBy("item", "text").toLocalIterator():
        found = Counter(terms((r["text"] or "").encode()))
        if block and len(held | found.keys()) > BLOCK_TERMS:
            yield block
            block, held = [], set()
        block.append((r["item"], dict(found)))
        held |= found.keys()
    if block:
        yield block


def counted(docs: DataFrame, id_col: str, text_col: str, places: dict[bytes, int]) -> DataFrame:
    """(id, n, terms, tfs): each document's length and counts of the wanted terms."""
    common.bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, at, tf = [], [], []
            for text in common.texts(b, "text"):
                found = terms(text)
                n.append(len(found))
                own = {places[t]: c for t, c in Counter(found).items() if t in places}
                at.append(list(own))
                tf.append(list(own.values()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(at, pa.list_(pa.int32())),
                 pa.array(tf, pa.list_(pa.int64()))], names=["id", "n", "terms", "tfs"])

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                       F.col(f"`{text_col}`").alias("text")).mapInArrow(
        run, "id long, n long, terms array<int>, tfs array<long>")


class Shard:
    """Impact lists of some documents: per term sorted by impact, and the same
    entries by document for direct access."""

    def __init__(self, ids: np.ndarray, doc: np.ndarray, term: np.ndarray, impact: np.ndarray):
        self.ids, self.docs = ids, len(ids)
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact, sorted_terms = doc[order], impact[order], term[order]
        self.terms, self.starts = np.unique(sorted_terms, return_index=True)
        self.ends = np.append(self.starts[1:], len(order))
        keys = sorted_terms.astype(np.int64) * self.docs + self.doc
        self.place = np.argsort(keys, kind="stable")   # places in list order, by (term, document)
        self.keys = keys[self.place]

    def top(self, wanted: np.ndarray, times: np.ndarray, k: int, floor: int):
        """(ids, scores) of at least the ``k`` best documents scoring above 0 and
        at least ``floor``; ``wanted`` terms, each counted ``times``."""
        at = np.searchsorted(self.terms, wanted)
        here = at < len(self.terms)
        here[here] = self.terms[at[here]] == wanted[here]
        at, times, wanted = at[here], times[here], wanted[here].astype(np.int64)
        starts, ends = self.starts[at], self.ends[at]
        sizes = ends - starts
        first = np.cumsum(sizes) - sizes               # where each list lies in ``seen``
        seen = np.zeros(int(sizes.sum()) + 1, bool)
        best = np.zeros(len(at), np.int64)             # places seen without a gap
        met = np.zeros(self.docs, bool)
        found, scores = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        kth, depth, width = floor, 0, FIRST_ROUND
        while len(at) and depth < sizes.max():
            reach = np.minimum(depth + width, sizes)
            count = np.maximum(reach - depth, 0)
            step = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
            new = np.unique(self.doc[np.repeat(starts + depth, count) + step])
            new = new[~met[new]]
            met[new] = True
            score = np.zeros(len(new), np.int64)
            for i in range(0, len(new), 4096):         # direct access, all lists at once
                some = new[i:i + 4096]
                keys = wanted[:, None] * self.docs + some[None, :]
                j = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
                held = self.keys[j] == keys
                place = self.place[j]
                score[i:i + 4096] = np.where(held, self.impact[place] * times[:, None], 0).sum(axis=0)
                which, _ = np.nonzero(held)
                seen[place[held] - starts[which] + first[which]] = True
            found.append(new)
            scores.append(score)
            depth, width = depth + width, width * 2
            every = np.concatenate(scores)
            if len(every) >= k:
                kth = max(kth, int(np.partition(every, len(every) - k)[len(every) - k]))
            bound = 0
            for i in range(len(at)):
                rest = seen[first[i] + best[i]:first[i] + sizes[i]]
                gap = int(np.argmin(rest)) if len(rest) else 0
                best[i] += len(rest) if len(rest) and rest[gap] else gap
                if best[i] < sizes[i]:
                    bound += int(self.impact[starts[i] + best[i]]) * int(times[i])
            if bound < kth:
                break
        every, docs = np.concatenate(scores), np.concatenate(found)
        good = (every > 0) & (every >= kth)
        return self.ids[docs[good]], every[good]


def _best(ids: np.ndarray, scores: np.ndarray, k: int):
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def _searched(queries: list[tuple], weights: np.ndarray, docs: int, length: int, k: int):
    """Shards of the counted documents of a partition, each asked all queries."""

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                held.append(part)
                size += len(part.column("terms").flatten())
                if size >= SHARD:
                    yield held
                    held, size = [], 0
        if held:
            yield held

    def shard(parts: list[pa.RecordBatch]) -> Shard:
        ids = np.concatenate([p.column("id").fill_null(NO_ID).to_numpy() for p in parts])
        term = np.concatenate([p.column("terms").flatten().to_numpy() for p in parts])
        tf = np.concatenate([p.column("tfs").flatten().to_numpy() for p in parts])
        held = np.concatenate([p.column("terms").value_lengths().to_numpy() for p in parts])
        m = np.array([length_factor(n, docs, length) for p in parts
                      for n in p.column("n").to_pylist()], np.int64)
        doc = np.repeat(np.arange(len(ids)), held)
        impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
        return Shard(ids, doc, term, impact)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.empty(0, np.int64)
        best = [(none, none)] * len(queries)
        for parts in shards(batches):
            s = shard(parts)
            for q, (_, wanted, times) in enumerate(queries):
                ids, scores = best[q]
                floor = int(scores[-1]) if len(ids) == k else 1
                more, its = s.top(wanted, times, k, floor)
                best[q] = _best(np.concatenate([ids, more]), np.concatenate([scores, its]), k)
        for q in range(0, len(queries), 1000):
            some = best[q:q + 1000]
            lens = [len(ids) for ids, _ in some]
            ids = np.concatenate([ids for ids, _ in some])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(q, q + len(some)), lens), pa.int32()),
                 pa.array(ids, pa.int64(), mask=ids == NO_ID),
                 pa.array(np.concatenate([sc for _, sc in some]), pa.int64())],
                names=["query", "id", "score"])

    return run


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id",
           text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every item."""
    spark = docs.sparkSession
    out = spark.createDataFrame([], f"{item_col} long, rank int, {id_col} long, score long")
    for block in blocks(items, item_col, item_text):
        words = sorted({t for _, own in block for t in own})
        places = {t: i for i, t in enumerate(words)}
        table = common.stored(counted(docs, id_col, text_col, places), "counted")
        n, length = table.filter("n > 0").agg(F.count("*"), F.sum("n")).first()
        weights = np.zeros(len(words), np.int64)
        for r in table.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
            weights[r["t"]] = weight(n, r["count"])
        queries = [(item, np.array([places[t] for t in own], np.int32),
                    np.array(list(own.values()), np.int64)) for item, own in block]
        found = table.filter(F.size("terms") > 0).mapInArrow(
            _searched(queries, weights, n, length or 1, k), "query int, id long, score long")
        order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
        names = spark.createDataFrame([(q, item) for q, (item, _) in enumerate(block)],
                                      f"query int, {item_col} long")
        best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        out = out.unionByName(best.join(F.broadcast(names), "query").select(
            item_col, "rank", F.col("id").alias(id_col), "score"))
    return out
