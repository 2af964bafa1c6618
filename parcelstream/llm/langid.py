"""Language identification by nearest centroids.

A text's vector holds the TF-IDF weights of its byte 1- to 4-grams, hashed to
``DIMS`` places and normalised; ASCII letters are lower-cased and everything
else below 128 counts as a space.  Document frequencies come from all labelled
rows.  Each language's sample (at most ``PER_LANGUAGE`` rows, those with the
smallest hashes of their ids) is clustered into ``CENTROIDS`` unit centroids, in
a task of its own.  A text takes the language of the centroid with the highest
cosine; it is marked as rejected where it is farther from that centroid than
``REJECT_SHARE`` of the centroid's own rows, less a margin.

Defined cases: null text, and text without a letter, is ``und`` with score 0;
equal cosines go to the smaller language value; without any labelled row all
texts are ``und``; predictions read nothing but the text, so equal texts get
equal results whatever their ids and other columns are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelstream.llm import common

DIMS = 4096
PER_LANGUAGE = 200     # labelled rows of a language that the clustering reads, at most
CENTROIDS = 4
ROUNDS = 12
REJECT_SHARE = 0.01
REJECT_MARGIN = 0.1

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32
              for c in range(256))


def counts(text: bytes) -> np.ndarray:
    """How often each hashed n-gram occurs in a whole text."""
    b = np.frombuffer(text.translate(_FOLD), np.uint8)
    if len(b) > 1:
        b = b[np.concatenate([[True], (b[1:] != 32) | (b[:-1] != 32)])]
    b = b.astype(np.uint64)
    total, gram = np.zeros(DIMS, np.int64), b
    for n in range(1, 5):
        if len(b) < n:
            break
        if n > 1:
            gram = (gram[:-1] << np.uint64(8)) | b[n - 1:]
        at = (gram + np.uint64(n << 40)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(52)
        total += np.bincount(at.view(np.int64), minlength=DIMS)
    return total


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


def vectors(rows: list[np.ndarray], idf: np.ndarray) -> np.ndarray:
    return _unit(np.log1p(np.array(rows, np.float32).reshape(-1, DIMS)) * idf)


def cluster(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(centroids, cosine floor of each): spherical k-means, started from rows
    evenly spread over the order of likeness to the mean."""
    order = np.argsort(-(x @ x.mean(axis=0)), kind="stable")
    c = x[order[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)]]
    for _ in range(ROUNDS):
        near = (x @ c.T).argmax(axis=1)
        c = _unit(np.array([x[near == j].sum(axis=0) if (near == j).any() else c[j]
                            for j in range(len(c))]))
    cos = x @ c.T
    near = cos.argmax(axis=1)
    floor = [np.quantile(cos[near == j, j], REJECT_SHARE) if (near == j).any() else 1.0
             for j in range(len(c))]
    return c, np.array(floor) - REJECT_MARGIN


def _document_frequency(rows: DataFrame, text_col: str) -> tuple[int, np.ndarray]:
    """Over all rows; each partition sends one sum for each place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(DIMS, np.int64), 0
        for b in batches:
            for text in common.texts(b, text_col):
                df += counts(text) > 0
                n += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, DIMS), pa.int64()), pa.array(np.concatenate([[n], df]))],
            names=["place", "n"])

    found = rows.select(text_col).mapInArrow(run, "place long, n long").groupBy("place").agg(
        F.sum("n").alias("n")).collect()  # DIMS + 1 rows
    sums = np.zeros(DIMS + 1, np.int64)
    for r in found:
        sums[r["place"] + 1] = r["n"]
    return int(sums[0]), sums[1:]


def fit(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang") -> dict:
    """The model of the labelled ``rows``: idf, languages, centroids, floors."""
    common.bound_batches(rows.sparkSession)
    rows = rows.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    n, df = _document_frequency(rows, "text")
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    # A hash threshold leaves about twice the bound; the window then cuts to it.
    sizes = rows.groupBy("lang").agg(F.count("*").alias("rows"))
    uniform = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1 << 30)) / (1 << 30)
    near = (rows.withColumn("u", uniform).join(F.broadcast(sizes) if sizes.count() < 10_000 else sizes, "lang")
            .filter(F.col("u") * F.col("rows") <= 2 * PER_LANGUAGE))
    sample = near.withColumn("place", F.row_number().over(
        Window.partitionBy("lang").orderBy("u", "id", "text"))).filter(F.col("place") <= PER_LANGUAGE)

    def centroids(group: pd.DataFrame) -> pd.DataFrame:
        rows_ = [counts(t.encode("utf-8")) for t in group["text"]]
        c, floor = cluster(vectors(rows_, idf), CENTROIDS)
        return pd.DataFrame({"lang": group["lang"].iloc[0], "centroid": list(c.astype(np.float32)),
                             "floor": floor})

    found = sample.select("lang", "text").groupBy("lang").applyInPandas(
        centroids, "lang string, centroid array<float>, floor double").collect()
    # a few centroids for each language
    found = sorted(found, key=lambda r: (r["lang"].encode(), r["centroid"]))
    return {"idf": idf, "lang": [r["lang"] for r in found],
            "centroid": np.array([r["centroid"] for r in found], np.float32).reshape(-1, DIMS),
            "floor": np.array([r["floor"] for r in found])}


def predict(docs: DataFrame, model: dict, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, rejected) for every row."""
    common.bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIMS floats a centroid

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            texts = b.column(text_col).to_pylist()
            pred, score = ["und"] * len(texts), [0.0] * len(texts)
            reject = [False] * len(texts)
            known = [i for i, t in enumerate(texts)
                     if t and len(m["lang"]) and any(map(str.isalpha, t))]
            for i in range(0, len(known), 128):
                part = known[i:i + 128]
                x = vectors([counts(texts[j].encode("utf-8")) for j in part], m["idf"])
                cos = x @ m["centroid"].T
                best = cos.argmax(axis=1)
                for j, row, at in zip(part, cos, best):
                    pred[j] = m["lang"][at]
                    score[j] = float(min(1.0, max(0.0, row[at])))
                    reject[j] = bool(row[at] < m["floor"][at])
            yield pa.RecordBatch.from_arrays(
                [b.column(id_col), pa.array(pred, pa.string()), pa.array(score, pa.float64()),
                 pa.array(reject, pa.bool_())], names=[id_col, "lang_pred", "score", "rejected"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, lang_pred string, score double, rejected boolean")
