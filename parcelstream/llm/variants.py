"""Spelling variants: one-edit neighbours of words by a relational trie frontier.

A word's occurrences are counted over all documents.  Two words are near if one
inserted, deleted or replaced code point tells them apart; a word's form is its
most frequent near word, if at least ``RATIO`` times as frequent, and its root
is where its forms lead.

The trie is a table of edges (node, ch, child, ends), a node being a hash of a
prefix and ``ends`` whether a word ends at the child.  Words stand in it twice,
forwards and reversed: an edit in the second half of a word is found in the
forward trie and one in the first half in the reversed one, so an edit is only
tried where the trie has left its crowded top.  Level by level, the states
(word, pos, node) are joined with that level's edges:

* a word's own state at its depth d moves to each other child beyond its next
  letter (replacement; the smaller word finds the larger one) or skips its next
  letter (deletion; insertions are the same pairs seen from the shorter word,
  and in a run of equal letters only one is skipped);
* a state with its edit behind it moves along the word's next letter or ends.

A state whose word is used up at a node where a word ends is a pair of near
words, which is then compared letter by letter, so hashes lose and add nothing.
Words beyond ``LONG`` letters make their edit and take the whole remainder in
one step, as a hash of (prefix, remainder), so that the number of levels is
bounded and their states stay linear in their letters.

States and edges are shuffled by node.  A node has at most 90 edges, so where very
many states ask for one, the skew join splits the states and copies its edges.
Edges are combined in every task first, and every level is a stored table.

Defined cases: null or empty text has no words; a null id counts as the empty
text in the hash that picks damaged runs; rows that repeat an id all count; very
long runs are words like others; ties for the form go to the smallest word in
code-point order; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelstream.llm import common

RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")   # [a-zÀ-ÿ]+ in UTF-8
MIN_LETTERS, MIN_COUNT, RATIO = 5, 3, 2
DAMAGE = 97
LONG = 32
HOT_SHARE = 1000
HELD = 400_000   # distinct words a task sums up before it hands them on


def damaged(run: bytes, h: int) -> bytes:
    """The run, without its code point ``h % length`` where ``DAMAGE`` divides h."""
    if h % DAMAGE:
        return run
    text = run.decode()
    at = h % len(text)
    return (text[:at] + text[at + 1:]).encode()


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) over all documents."""
    if min_letters < 4:
        raise ValueError("words need at least 4 letters")  # both ends are edited from the middle
    common.bound_batches(docs.sparkSession)

    def table(held: dict[bytes, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(held.keys(), pa.binary()).cast(pa.string()),
             pa.array(held.values(), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), common.texts(b, "text")):
                start = crc32(b"%s:" % (doc or "").encode())
                for w, n in Counter(RUN.findall(text.lower())).items():
                    h = crc32(w, start)
                    if not h % DAMAGE:
                        w = damaged(w, h)
                    held[w] = held.get(w, 0) + n
            if len(held) > HELD:
                yield table(held)
                held = {}
        if held:
            yield table(held)

    found = docs.select(F.col(f"`{id_col}`").cast("string").alias("id"),
                        F.col(f"`{text_col}`").alias("text")).mapInArrow(run, "word string, n long")
    return (found.filter(F.length("word") >= min_letters).groupBy("word").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= min_count))


def _node(back: Column, length: Column) -> Column:
    """The node of the word's first letters; the two directions are two tries."""
    return F.xxhash64(back, F.substring(F.col("word"), F.lit(1), length))


def _letter(pos: Column) -> Column:
    """The code of the word's letter at ``pos`` from 0; 0 beyond its ends."""
    return F.when(pos >= 0, F.ascii(F.substring(F.col("word"), pos + 1, F.lit(1)))).otherwise(0)


def both_ways(short: DataFrame) -> DataFrame:
    return short.select("word", F.lit(False).alias("back")).unionAll(
        short.select(F.reverse("word").alias("word"), F.lit(True)))


def own_states(short: DataFrame, depth: int) -> DataFrame:
    """(word, back, pos, node, ch, child, ends, skip, last) of every word at this
    depth, if beyond its middle, in both directions: its own step to the child,
    the letter ``skip`` that follows if its next one is left out (0: not here),
    and whether its last one may be.  These steps are the level's edges as well."""
    size, pos, back = F.length("word"), F.lit(depth), F.col("back")
    half = F.floor(size / 2)
    rows = both_ways(short).filter((F.when(back, size - half).otherwise(half) <= pos) & (pos < size))
    here, after, before = _letter(pos), _letter(pos + 1), _letter(pos - 1)
    # Of equal letters in a row only the last one, as the word is written, is skipped.
    may_skip = F.when(back, here != before).otherwise(here != after)
    # The last letter has no edge after it: it is skipped one step earlier.
    last = (pos == size - 2) & (~back | (here != after))
    return rows.select(
        "word", "back", pos.alias("pos"), _node(back, pos).alias("node"), here.alias("ch"),
        _node(back, pos + 1).alias("child"), (pos == size - 1).alias("ends"),
        F.when(may_skip, after).otherwise(0).alias("skip"), last.alias("last"))


def short_pairs(short: DataFrame) -> DataFrame:
    """(a, b), ``a`` one edit from ``b``, of words up to ``LONG`` letters."""
    straight = F.when(F.col("back"), F.reverse("word")).otherwise(F.col("word"))
    low, high = short.agg(F.min(F.length("word")), F.max(F.length("word"))).first()
    found = short.select(F.col("word").alias("a"), F.lit(0).cast("long").alias("node")).limit(0)
    pos, ch, want, own = F.col("pos"), F.col("ch"), F.col("want"), F.col("own")
    replaced, skipped = own & (ch > want), own & (ch == F.col("skip"))
    ended, followed = F.col("last") & (ch == want), ~own & (ch == want)
    moves = F.array_compact(F.array(
        F.when(replaced | followed, pos + 1), F.when(skipped, pos + 2), F.when(ended, pos + 2)))
    done = F.col("pos") == F.length("word")
    frontier = None
    for depth in range(low // 2, high) if low else ():
        states = own_states(short, depth)
        edges = states.groupBy("node", "ch", "child").agg(F.max("ends").alias("ends"))
        asks = states.select("node", "word", "back", "pos", F.col("ch").alias("want"),
                             F.lit(True).alias("own"), "skip", "last")
        if frontier is not None:
            asks = asks.unionByName(frontier.filter("not ends").select(
                "node", "word", "back", "pos", _letter(pos).alias("want"), F.lit(False).alias("own"),
                F.lit(0).alias("skip"), F.lit(False).alias("last")))
        # A task's edges are few beside its states: they are hashed, nothing is sorted.
        step = asks.join(edges.hint("shuffle_hash"), "node").filter(
            replaced | skipped | ended | followed)
        step = step.withColumn("pos", F.explode(moves)).filter(~done | F.col("ends"))
        frontier = common.stored(step.select(
            "word", "back", "pos", F.col("child").alias("node"), done.alias("ends")), "frontier")
        found = found.unionAll(frontier.filter("ends").select(straight.alias("a"), "node"))
    whole = both_ways(short).select(_node(F.col("back"), F.length("word")).alias("node"),
                                    straight.alias("b"))
    return found.join(whole, "node").select("a", "b").filter(F.levenshtein("a", "b") == 1)


def probe(rows: DataFrame, side: DataFrame, key: str) -> DataFrame:
    """``rows`` joined with ``side``, which holds a bounded number of rows for
    each key.  Keys of more than one row in ``HOT_SHARE``, so fewer than that,
    are joined by broadcast, the others by a shuffle."""
    least = max(rows.count() // HOT_SHARE, 1000)
    hot = [r[key] for r in rows.groupBy(key).agg(F.count("*").alias("n"))
           .filter(F.col("n") > least).select(key).collect()]
    if not hot:
        return rows.join(side, key)
    often = F.col(key).isin(hot)
    return rows.filter(~often).join(side.filter(~often), key).unionByName(
        rows.filter(often).join(F.broadcast(side.filter(often)), key))


def remainders(long: DataFrame) -> DataFrame:
    """(whole, at, size, word digest) states of long words: ``at`` >= 0 is the
    word without that letter, -1 the word itself; whole = hash of the letters."""

    base = np.uint64(0x9E3779B97F4A7C15)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for word in b.column(0).to_pylist():
                codes = np.array([ord(c) for c in word], np.uint64) + np.uint64(1)
                size = len(codes)
                power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, base)]))
                prefix = np.concatenate([[np.uint64(0)], np.cumsum(codes * power[:size])])
                # Without letter i, the remainder moves one place to the left.
                inverse = np.uint64(pow(int(base), -1, 1 << 64))
                skipped = prefix[:-1] + (prefix[-1] - prefix[1:]) * inverse
                last = np.append(codes[1:] != codes[:-1], True)
                at = np.append(np.arange(size), -1)
                whole = np.append(skipped, prefix[-1])
                digest = xxhash.xxh3_128_digest(word.encode())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(common.mix(whole).view(np.int64)), pa.array(at, pa.int32()),
                     pa.array(np.full(size + 1, size), pa.int32()),
                     pa.array([digest] * (size + 1), pa.binary()),
                     pa.array(np.append(last, True))], names=["whole", "at", "size", "digest", "last"])

    return long.mapInArrow(run, "whole long, at int, size int, digest binary, last boolean")


def long_pairs(found: DataFrame) -> DataFrame:
    """(a, b) of near words with ``a`` beyond ``LONG`` letters."""
    long = found.filter(F.length("word") >= LONG).select("word")
    rows = common.stored(remainders(long), "remainders")
    side = rows.toDF("whole", "at_b", "size_b", "digest_b", "last_b")
    # Words that agree without letter ``at``: at most 90 of them for each remainder.
    same = rows.filter("at >= 0").join(side.filter("at_b >= 0"), "whole").filter(
        "at = at_b and size = size_b and digest < digest_b")
    less = rows.filter("at >= 0 and last").join(side.filter("at_b < 0"), "whole").filter(
        "size = size_b + 1")
    ids = same.unionByName(less).select("digest", "digest_b").distinct()
    named = common.stored(long.mapInArrow(_digests, "digest binary, word string"), "digests")
    pairs = (ids.join(named.withColumnRenamed("word", "a"), "digest")
             .join(named.toDF("digest_b", "b"), "digest_b").select("a", "b"))
    return pairs.filter((F.greatest(F.length("a"), F.length("b")) > LONG)
                        & (F.levenshtein("a", "b", 1) == 1))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays(
            [pa.array([xxhash.xxh3_128_digest(w.encode()) for w in b.column(0).to_pylist()],
                      pa.binary()), b.column(0)], names=["digest", "word"])


def neighbours(found: DataFrame) -> DataFrame:
    """(word, near): all one-edit pairs of ``found(word, n)``, both ways."""
    pairs = short_pairs(found.filter(F.length("word") <= LONG).select("word"))
    if not found.filter(F.length("word") > LONG).isEmpty():
        pairs = pairs.unionByName(long_pairs(found))
    pairs = common.stored(pairs.distinct(), "pairs")
    return pairs.toDF("word", "near").unionAll(pairs.select("b", "a"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms(word, form)``.  Counts at least double from form
    to form, so chains are short and the rounds are few."""
    steps = common.stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        moved = probe(steps, steps.toDF("root", "further"), "root")
        moved = common.stored(moved.select("word", F.col("further").alias("root")), "moved")
        if moved.isEmpty():
            return steps
        steps = common.stored(steps.join(moved.select("word"), "word", "left_anti")
                              .unionByName(moved), "roots")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word."""
    found = common.stored(words(docs, id_col, text_col), "words")
    near = neighbours(found).join(found.toDF("near", "near_n"), "near")
    near = near.groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near"))).alias("top"))
    rows = found.join(near, "word", "left")
    is_form = -F.col("top.n") >= RATIO * F.col("n")
    rows = common.stored(rows.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("top.near")).alias("form"),
        F.when(is_form, -F.col("top.n")).alias("form_n")), "forms")
    ends = roots(rows.filter("form is not null").select("word", "form"))
    return rows.join(ends, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
