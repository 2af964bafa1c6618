"""Passages that repeat across documents, by sparse suffix sorting.

Words are maximal runs of characters other than space and \\t..\\r, A-Z
lower-cased.  Of all suffixes only those at minimiser positions are kept: the
positions whose ``GRAM``-word hash is the smallest among ``SPAN`` neighbours.
Every passage of ``LEAST`` words holds one of them, and equal passages hold the
same ones.

1. The kept suffixes are sorted by their first ``GRAM`` words over the whole
   corpus (range partitions, sorted inside), and neighbours are compared: a
   suffix with an equal neighbour may lie in a repeat.
2. Around those, each document is extended left and right: every window of
   ``LEAST`` words that holds such a position is one entry, again sorted and
   compared with its neighbours.  A window that also stands in another document
   is a repeat; runs of them are the maximal spans.

The order includes the document, so a passage that millions of documents share
is spread over partitions; a run cut by a partition's border is found from the
border rows, two a partition.  Nothing gathers a passage's documents.

Defined cases: null and short texts have no spans; null ids are left out; rows
that repeat an id are one document, and repeats inside a single document don't
count; an empty table gives an empty result; only id and text are read.  Equality
is that of 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelstream.llm import common

LEAST = 50                 # words of a passage
GRAM = 16                  # words that order a suffix
SPAN = LEAST - GRAM + 1    # grams among which the smallest is kept


def _join(a: np.ndarray, b: np.ndarray, shift: int) -> np.ndarray:
    """Hashes of longer windows from those at a position and ``shift`` on."""
    n = len(b) - shift
    return common.mix(a[:n] * np.uint64(0x9E3779B97F4A7C15) + b[shift:])


def grams(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of GRAM and of LEAST words (16 and 32 + 16 + 2)."""
    g2 = _join(h, h, 1)
    g4 = _join(g2, g2, 2)
    g8 = _join(g4, g4, 4)
    g16 = _join(g8, g8, 8)
    g32 = _join(g16, g16, 16)
    return g16, _join(_join(g32, g16, 32), g2, 48)


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """The least or greatest of every ``width`` neighbours, by doubling."""
    done = 1
    while 2 * done <= width:
        x = pick(x[:len(x) - done], x[done:])
        done *= 2
    rest = width - done
    return pick(x[:len(x) - rest], x[rest:]) if rest else x


def minimisers(g: np.ndarray) -> np.ndarray:
    """Positions whose hash is the smallest of some SPAN neighbours."""
    low = _slide(g, SPAN, np.minimum)
    edge = np.zeros(SPAN - 1, np.uint64)
    # A position is kept if the greatest of the minima around it is its own.
    return np.flatnonzero(_slide(np.concatenate([edge, low, edge]), SPAN, np.maximum) == g)


def _hashes(text: bytes, cache: common.WordHashes) -> np.ndarray | None:
    words = text.lower().split()
    return cache.array(words) if len(words) >= LEAST else None


def _by_key(i: int, key: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    """One row for each distinct key of a document, with all its places."""
    order = np.argsort(key, kind="stable")
    key, at = key[order].view(np.int64), at[order].astype(np.int32)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    ends = np.concatenate([first, [len(key)]]).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(key[first]), pa.array(np.full(len(first), i, np.int64)),
         pa.ListArray.from_arrays(pa.array(ends), pa.array(at))], names=["key", "id", "at"])


def _gathered(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of a few thousand rows out of small ones."""
    held, n = [], 0
    for b in rows:
        held.append(b)
        n += b.num_rows
        if n >= 4096:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


ROWS = "key long, id long, at array<int>"


def suffixes(docs: DataFrame) -> DataFrame:
    """ROWS of the kept suffixes of ``docs(id, text)``."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = common.kept(("words",), common.WordHashes)
        for b in batches:
            for i, text in zip(b.column("id").to_pylist(), common.texts(b, "text")):
                h = _hashes(text, cache)
                if h is not None:
                    g = grams(h)[0]
                    at = minimisers(g)
                    yield _by_key(i, g[at], at)

    return docs.mapInArrow(lambda batches: _gathered(each(batches)), ROWS)


def windows(docs: DataFrame) -> DataFrame:
    """ROWS of the windows of LEAST words around the positions of
    ``docs(id, text, near)``."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = common.kept(("words",), common.WordHashes)
        for b in batches:
            near, ids = b.column("near"), b.column("id").to_pylist()
            for row, (i, text) in enumerate(zip(ids, common.texts(b, "text"))):
                h = _hashes(text, cache)
                if h is None:
                    continue
                w = grams(h)[1]
                edge = np.zeros(len(w) + 1, np.int32)
                at = near[row].values.to_numpy()
                np.add.at(edge, np.clip(at - SPAN + 1, 0, len(w)), 1)
                np.add.at(edge, np.clip(at + 1, 0, len(w)), -1)
                start = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
                if len(start):
                    yield _by_key(i, w[start], start)

    return docs.mapInArrow(lambda batches: _gathered(each(batches)), ROWS)


def neighbours(rows: DataFrame) -> DataFrame:
    """ROWS in order of key and id.  Kept are rows next to an equal key of
    another id (``same``), and those of each partition's first and last id and
    key (``edge``), whose neighbours may be in another partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_same, first = None, False, True  # the last id of the last key, all its rows
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            t = t if held is None else pa.concat_tables([held, t])
            key, own = t.column("key").to_numpy(), t.column("id").to_numpy()
            new = np.flatnonzero(np.concatenate(
                [[True], (key[1:] != key[:-1]) | (own[1:] != own[:-1])]))
            same = np.zeros(len(new), bool)  # for each id of each key
            pair = key[new][1:] == key[new][:-1]
            same[1:] |= pair
            same[:-1] |= pair
            same[0] |= held_same
            edge = np.zeros(len(new), bool)
            edge[0] = first
            size = np.diff(np.concatenate([new, [len(key)]]))
            flag = lambda x: pa.array(np.repeat(x, size)[:new[-1]])
            done = t.slice(0, new[-1]).append_column("same", flag(same)).append_column(
                "edge", flag(edge)).filter(flag(same | edge))
            if done.num_rows:
                yield from done.combine_chunks().to_batches()
            first = first and len(new) == 1
            held, held_same = t.slice(new[-1]).combine_chunks(), bool(same[-1])
        if held is not None:
            n = held.num_rows
            yield from (held.append_column("same", pa.array([held_same] * n))
                        .append_column("edge", pa.array([True] * n)).to_batches())

    return (rows.repartitionByRange("key", "id").sortWithinPartitions("key", "id")
            .mapInArrow(run, f"{ROWS}, same boolean, edge boolean"))


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, start, end, n_words): the spans of words, end exclusive, that other
    documents hold too, maximal and at least LEAST words long."""
    common.bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).filter(
        "id is not null and text is not null")
    kept = common.stored(suffixes(rows), "suffixes")
    # Border rows stay in: whether they repeat is decided by their windows.
    near = neighbours(kept).groupBy("id").agg(F.flatten(F.collect_list("at")).alias("near"))
    found = common.stored(windows(rows.join(near, "id")), "windows")
    found = common.stored(neighbours(found), "neighbours")
    border = found.filter("edge")
    cut = border.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("low < high")
    more = border.filter("not same").join(cut.select("key"), "key", "left_semi").select("id", "at")
    places = found.filter("same").select("id", "at").union(more)

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, lo, hi = [], [], []
            for i, at in zip(b.column("id").to_pylist(), b.column("at")):
                start = np.unique(np.concatenate([x.values.to_numpy() for x in at.values]))
                new = np.flatnonzero(np.concatenate([[True], start[1:] != start[:-1] + 1]))
                last = np.concatenate([new[1:], [len(start)]]) - 1
                ids += [i] * len(new)
                lo += start[new].tolist()
                hi += (start[last] + LEAST).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(lo, pa.int64()), pa.array(hi, pa.int64())],
                names=["id", "start", "end"])

    return (places.groupBy("id").agg(F.collect_list("at").alias("at"))
            .mapInArrow(spans, "id long, start long, end long")
            .select(F.col("id").alias(id_col), "start", "end",
                    (F.col("end") - F.col("start")).alias("n_words")))
