"""Exact top-k by inner product, pruned with multi-resolution segment statistics.

Vectors are cut into 1, 4, 16 and 32 segments.  With a segment's mean and
deviation on either side, the squared distance is at least the sum over segments
of ``n * ((difference of means)^2 + (difference of deviations)^2)``; as both norms
are known, that is an upper bound on the inner product.  A block takes its
candidates best first, by the coarsest bound that holds for every query (their
norm), and the bounds go from coarse to fine against each query's k-th best score
so far; a level that removes nothing from a chunk is followed by the next one, and
only survivors are multiplied out.  Bounds get a slack above their rounding error,
so the result is exact, ties included (the smaller id first).  On vectors without
structure few bounds fall below the k-th score until the segments are short.

Queries meet candidates in blocks: candidates are dealt to blocks by hash, each
block of queries visits every block of candidates, and each visit returns at
most k rows a query, which are ranked once more.

Defined cases: vectors that are null or hold null or non-finite components take
no part; a null id takes no part; shorter vectors count as padded with zeros;
rows that repeat an id and a vector count once, and a query never meets rows of
its own id; of different vectors under one query id the smallest one asks; scores
beyond 63 bits raise ``OverflowError``, as no column could hold or rank them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelstream.llm import common

SEGMENTS = (1, 4, 16, 32)
CANDIDATES = 8192      # of a block
QUERIES = 8192         # of a block; a candidate is copied once for so many queries
TILE = 1024            # queries that are bounded at a time
CHUNK = 2048           # candidates that are bounded at a time
SLICE = 1 << 15        # pairs that are multiplied at a time
DENSE = 32             # one matrix product pays from one survivor in so many pairs


def quantised(rows: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, v): floor(scale * x) of every usable vector."""
    good = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                    & (F.abs(x.cast("double")) < float("inf")))
    return (rows.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & good)
            .select(F.col(id_col).cast("long").alias("id"), F.transform(
                vector_col, lambda x: F.floor(scale * x.cast("double")).cast("long")).alias("v"))
            .distinct())


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    out = np.zeros((len(column), width), np.int64)
    for i, v in enumerate(column):
        x = v.values.to_numpy()
        out[i, :len(x)] = x
    return out


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of each segment, scaled so that a dot product of two
    rows is the upper bound on their inner product."""
    parts = np.array_split(x.astype(np.float64), segments, axis=1)
    parts = [p for p in parts if p.shape[1]]
    root = np.sqrt([p.shape[1] for p in parts])
    mean = np.stack([p.mean(axis=1) for p in parts], axis=1) * root
    dev = np.stack([p.std(axis=1) for p in parts], axis=1) * root
    return np.concatenate([mean, dev], axis=1)


def products(q: np.ndarray, c: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Exact inner products of the survivors ``(rows, cols)``: floating point
    where every sum is below 2^53 (pair by pair, or as one matrix product where
    many pairs survive), whole numbers of any size otherwise."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, q.shape[1])
    if top >= 2.0 ** 53:
        sums = [sum(int(x) * int(y) for x, y in zip(q[i], c[j])) for i, j in zip(rows, cols)]
        if any(abs(s) >= 1 << 63 for s in sums):
            raise OverflowError("an inner product needs more than 63 bits")
        return np.array(sums, np.int64)
    qf, cf = q.astype(np.float64), c.astype(np.float64)
    if DENSE * len(rows) > len(q) * len(c):
        return (qf @ cf.T)[rows, cols].astype(np.int64)
    parts = [np.einsum("ij,ij->i", qf[rows[a:a + SLICE]], cf[cols[a:a + SLICE]])
             for a in range(0, len(rows), SLICE)]
    return np.concatenate([np.empty(0), *parts]).astype(np.int64)


def survivors(q: list[np.ndarray], c: list[np.ndarray], floor: np.ndarray,
              alive: np.ndarray) -> np.ndarray:
    """Which of the pairs ``alive`` may still reach ``floor``: the statistics of all
    levels on either side, coarse to fine."""
    for stat, own in zip(q, c):
        if not alive.any():
            break
        slack = 1e-9 * (1 + np.linalg.norm(stat, axis=1)[:, None]
                        * np.linalg.norm(own, axis=1)[None, :])
        alive = alive & (stat @ own.T + slack >= floor[:, None])
    return alive


def levels(x: np.ndarray) -> list[np.ndarray]:
    return [statistics(x, s) for s in SEGMENTS if x.shape[1]]


def block_top(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int):
    """Per query its k best candidates of one block: [(query, id, score)]."""
    none = np.empty(0, np.int64)
    best = [(none, none)] * len(q)
    floor = np.full(len(q), -np.inf)
    norm = np.linalg.norm(c.astype(np.float64), axis=1)
    order = np.lexsort((c_ids, -norm))
    c, c_ids = c[order], c_ids[order]
    asked = [(lo, levels(q[lo:lo + TILE])) for lo in range(0, len(q), TILE)]
    for at in range(0, len(c), CHUNK):
        part, ids = c[at:at + CHUNK], c_ids[at:at + CHUNK]
        own = levels(part)
        for lo, stats in asked:
            mine = slice(lo, lo + TILE)
            alive = survivors(stats, own, floor[mine], q_ids[mine, None] != ids[None, :])
            rows, cols = np.nonzero(alive)
            scores = products(q[mine], part, rows, cols)
            cut = np.searchsorted(rows, np.arange(len(q_ids[mine]) + 1))
            for i in np.flatnonzero(cut[1:] > cut[:-1]):
                s = np.concatenate([best[lo + i][0], scores[cut[i]:cut[i + 1]]])
                d = np.concatenate([best[lo + i][1], ids[cols[cut[i]:cut[i + 1]]]])
                if len(s) > 4 * k:  # ties with the k-th best stay in
                    near = s >= np.partition(s, len(s) - k)[len(s) - k]
                    s, d = s[near], d[near]
                first = np.lexsort((d, -s))[:k]
                best[lo + i] = (s[first], d[first])
                if len(first) == k:
                    floor[lo + i] = s[first[-1]]
    return [(q_ids[i], d, s) for i, (ss, dd) in enumerate(best) for s, d in zip(ss, dd)]


def top_k(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20,
          every: int = 20, scale: int = 64) -> DataFrame:
    """(query_id, rank, id, score) of all queries: ids divisible by ``every``."""
    vec = common.stored(quantised(rows, id_col, vector_col, scale), "vectors")
    ask = vec.filter(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v"))
    sizes = vec.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width"),
                    F.count_if(F.col("id") % every == 0).alias("q")).first()
    width = sizes["width"] or 0
    n_c = max(1, -(-sizes["n"] // CANDIDATES))
    n_q = max(1, -(-sizes["q"] // QUERIES))
    block = lambda n, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n)).cast("int")
    every_of = lambda n: F.explode(F.expr(f"sequence(0, {n - 1})"))
    cand = vec.select("id", "v", F.lit(False).alias("asks"), block(n_c, 1).alias("cb"),
                      every_of(n_q).alias("qb"))
    asks = ask.select("id", "v", F.lit(True).alias("asks"), block(n_q, 2).alias("qb"),
                      every_of(n_c).alias("cb"))

    def visit(t: pa.Table) -> pa.Table:
        role = t.column("asks").to_numpy(zero_copy_only=False)
        ids, v = t.column("id").to_numpy(), _matrix(t.column("v"), width)
        found = block_top(ids[role], v[role], ids[~role], v[~role], k)
        cols = list(zip(*found)) if found else [[], [], []]
        return pa.table([pa.array([int(x) for x in col], pa.int64()) for col in cols],
                        names=["query_id", "id", "score"])

    part = cand.unionByName(asks).groupBy("cb", "qb").applyInArrow(
        visit, "query_id long, id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    return (part.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"),
                    F.col("id").alias(id_col), "score"))
