"""Helpers shared by the operators: table readers, stored intermediates, and
word/shingle hashing over Arrow batches."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

# An Arrow batch holds at most so many bytes and rows, so that a worker's memory
# does not depend on how long the documents of a batch happen to be.
ARROW_BOUNDS = {"spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
                "spark.sql.execution.arrow.maxRecordsPerBatch": "3000"}
# Distinct words whose hash a worker keeps; further words are hashed again.
WORD_CACHE = 250_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    for key, value in ARROW_BOUNDS.items():
        try:
            spark.conf.set(key, value)
        except Exception:  # noqa: BLE001 - a session without a setting keeps its own bound
            pass


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a parquet table in the shared checkpoint folder: it cuts the
    lineage, and a lost executor's readers read the files again."""
    from parcelstream.session import ensure_checkpoint_dir  # for the driver alone

    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The UTF-8 bytes of a text column, null as empty."""
    return [b or b"" for b in batch.column(column).cast(pa.large_binary()).to_pylist()]


def kept(key: tuple, make: Callable):
    """What ``make()`` returned in this Python worker's first task with this
    key.  A worker keeps one such value, so what an earlier stage remembered
    goes when the next one starts.  Only for caches, which change no result."""
    held = sys.modules.setdefault("llm_worker_caches", types.ModuleType("llm_worker_caches"))
    if getattr(held, "key", None) != key:
        held.key = held.value = None
        pa.default_memory_pool().release_unused()
        held.key, held.value = key, make()
    return held.value


class WordHashes(dict):
    """word (bytes) -> 64-bit hash, remembered up to ``WORD_CACHE`` words."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < WORD_CACHE:
            self[word] = h
        return h

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_ROLL = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                  0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def five_word_windows(h: np.ndarray) -> np.ndarray:
    """Hashes of all windows of five consecutive word hashes, in text order."""
    if len(h) < 5:
        return np.empty(0, np.uint64)
    n = len(h) - 4
    acc = h[:n] * _ROLL[0]
    for i in range(1, 5):
        acc += h[i:n + i] * _ROLL[i]
    return mix(acc)
