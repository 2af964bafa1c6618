"""Readers for the given parquet tables.

Every reader selects only the columns it needs, so Catalyst prunes the
parquet scan (``ReadSchema``) and pushes filters to it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def read(spark: SparkSession, sf_dir: str, name: str, *cols: str,
         spread: bool = False) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    df = df.select(*cols) if cols else df
    return spread_input(df) if spread else df


def spread_input(df: DataFrame) -> DataFrame:
    """Inputs that a session reads from single row groups (the bench's test
    tables) can be spread round-robin over ``spark.parcelstream.scan.spread``
    partitions.  Without that setting, as on a cluster, nothing is shuffled:
    the scan's own splits are the partitions."""
    n = df.sparkSession.conf.get("spark.parcelstream.scan.spread", None)
    return df.repartition(int(n)) if n else df


def utc(c) -> F.Column:
    """Parquet ``timestamp`` without zone loads as TIMESTAMP_NTZ; the data is
    UTC wall-clock and the session zone is pinned to UTC, so the cast keeps
    the instant."""
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp")


def epoch_ms(c) -> F.Column:
    return F.unix_millis(utc(c))


def iso_text(c) -> F.Column:
    """UTC instant -> ``yyyy-MM-ddTHH:mm:ssZ`` (the change-log text format)."""
    return F.date_format(utc(c), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def union_all(dfs) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)
