"""Catalog tables of the dimensions, made from the configuration.

A configuration row names a sink table and its column families.  The table is
created when the row is first seen, before any data: ``row_key`` and one map of
columns a family (an empty family means ``info``).  Cells belong to the first family
of their table, as the configuration gives no other assignment.

The table's files lie under the store (``tables/<name>``), so another session that
creates it from the same configuration finds the same rows.  They are written from
the store's merged cells whenever the store is folded; the state up to the last
batch is ``dim_store.read_current``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelstream.operators import dim_store

KEY = "row_key"
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def families(config: DataFrame) -> dict[str, list[str]]:
    """sink table -> its families in order, from configuration rows (one a source
    table, so few): ``sink_table, sink_family``.  Several rows of one sink table add
    up."""
    family = F.when(F.coalesce("sink_family", F.lit("")) == "", "info").otherwise(F.col("sink_family"))
    rows = config.filter("sink_table is not null").select("source_table", "sink_table",
                                                          F.split(family, ",").alias("names"))
    found: dict[str, list[str]] = {}
    for r in rows.distinct().orderBy("sink_table", "source_table").collect():
        for name in [r["sink_table"], *r["names"]]:
            if not _NAME.fullmatch(name.strip()):
                raise ValueError(f"{name!r} is no name for a table or a column family")
        own = found.setdefault(r["sink_table"], [])
        own += [n.strip() for n in r["names"] if n.strip() not in own]
    return found


def create(spark: SparkSession, config: DataFrame, root: str, database: str = "default") -> list[str]:
    """Creates the tables that don't exist yet; returns their names.  Existing ones
    are left as they are, so a replay does nothing."""
    made = []
    for table, groups in families(config).items():
        if spark.catalog.tableExists(f"{database}.{table}"):
            continue
        columns = ", ".join([f"`{KEY}` STRING", *(f"`{g}` MAP<STRING, STRING>" for g in groups)])
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.`{table}` ({columns}) USING parquet "
                  f"LOCATION '{root.rstrip('/')}/tables/{table}'")
        made.append(table)
    return made


def publish(spark: SparkSession, root: str, table: str, database: str = "default") -> None:
    """Writes the merged cells of one dimension into its table."""
    cells = dim_store.read_current(spark, root, table)
    if cells is None:
        return
    first, *others = [f.name for f in spark.table(f"{database}.{table}").schema if f.name != KEY]
    # A row's cells are no more than its configured columns.
    rows = cells.groupBy(F.col("row_key").alias(KEY)).agg(F.map_from_entries(
        F.collect_list(F.struct("column", "value"))).alias(first))
    empty = F.create_map().cast("map<string,string>")
    rows.select(KEY, first, *[empty.alias(o) for o in others]).write.insertInto(
        f"{database}.{table}", overwrite=True)
