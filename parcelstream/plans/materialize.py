"""Derived inputs that play the role of stored sources.

The captured change logs are inputs in production (files or a topic).  Here
they are derived from the given tables; each is built once per application
and written as a parquet table inside the shared folder named by
``spark.checkpoint.dir`` (never a machine-local folder on a cluster), so
every query reads it like a stored table: small plans, columnar scans with
pushdown, no recomputation, and a lost executor re-reads files instead of
replaying the derivation.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from parcelstream.session import ensure_checkpoint_dir, open_writers

_MEMO: dict[tuple, DataFrame] = {}
# Re-entrant: building one derived table may read another one.
_LOCK = threading.RLock()


def materialized(spark: SparkSession, key: tuple, build: Callable[[], DataFrame],
                 partition_by: tuple[str, ...] = ()) -> DataFrame:
    memo_key = (spark.sparkContext.applicationId,) + key
    with _LOCK:
        df = _MEMO.get(memo_key)
        if df is None:
            root = ensure_checkpoint_dir(spark).rstrip("/")
            name = "_".join(str(k).strip("/").replace("/", "_") for k in key)
            path = f"{root}/tables/{name}"
            rows = build()
            with open_writers(spark):
                rows.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
            df = spark.read.parquet(path)
            _MEMO[memo_key] = df
        return df


def forget() -> None:
    _MEMO.clear()
