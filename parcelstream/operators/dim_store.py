"""Dimension upsert store (cell-wise merge).

A routed row is a put: row key = value of the ``sink_pk`` column, every
other non-null column one cell.  A put replaces only the cells it carries,
so a later, narrower configuration never erases older cells.  The merged
state is the latest value per ``(sink_table, row_key, column)`` by
``(ts, part, offset)`` — a ``max_by`` aggregation, combined map-side before
the shuffle, so a hot row or table does not land in one task.

A micro-batch appends only its own cells (replaced as a whole on replay, so the
sink is idempotent); ``fold`` merges older batches into a sorted base, and
readers merge that base with the batches since (``upsert_store``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelstream.operators import upsert_store
from parcelstream.operators.upsert_store import Store


def cells(routed: DataFrame) -> DataFrame:
    """One row per written cell: ``sink_table, row_key, column, value, ts,
    part, offset``.  Only configured columns are written, the key is not a
    cell, null values are not written.  Explode + filter keeps the row in
    generated code (no per-row map lambda)."""
    r = routed.filter(F.col("row_key").isNotNull())
    e = r.select("sink_table", "row_key", "sink_pk", "columns", "ts", "part", "offset",
                 F.explode("after_map").alias("column", "value"))
    keep = (F.array_contains(F.col("columns"), F.col("column"))
            & (F.col("column") != F.col("sink_pk")) & F.col("value").isNotNull())
    return e.filter(keep).select("sink_table", "row_key", "column", "value", "ts", "part",
                                 "offset")


def merge(cell_df: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """Merged cells after applying ``cell_df`` over ``state`` (same schema)."""
    allc = cell_df if state is None else state.unionByName(cell_df)
    return allc.groupBy("sink_table", "row_key", "column").agg(
        F.max_by(F.struct("value", "ts", "part", "offset"),
                 F.struct("ts", "part", "offset")).alias("m")).select(
        "sink_table", "row_key", "column", "m.value", "m.ts", "m.part", "m.offset")


def wide(merged: DataFrame, sink_table: str, columns: list[str], pk: str = "id") -> DataFrame:
    """Typed wide view of one sink table from merged cells (one pass of
    conditional aggregation, no pivot discovery job)."""
    t = merged.filter(F.col("sink_table") == sink_table)
    return t.groupBy(F.col("row_key").alias(pk)).agg(
        *[F.max(F.when(F.col("column") == c, F.col("value"))).alias(c) for c in columns])


def route_counts(routed: DataFrame) -> DataFrame:
    return routed.groupBy("sink_table").agg(F.count(F.lit(1)).alias("n"))


CELL_COLS = ["sink_table", "row_key", "column", "value", "ts", "part", "offset"]
CELL_DDL = ("sink_table string, row_key string, column string, value string, ts long, part int, "
            "offset long")


def store(root: str) -> Store:
    """The dimension store: cells by table, row and column, all versions kept for
    lookups at a point in time."""
    return Store(root, CELL_DDL, keys=("sink_table", "row_key", "column"),
                 order=("ts", "part", "offset"), partition="sink_table", log="_cells", history=True)


def append_cells(batch_cells: DataFrame, root: str, batch_id: int, stream: str = "dim") -> None:
    """Store one micro-batch's cells, and only those; a replayed batch replaces
    its own, tables that it no longer writes to included."""
    upsert_store.append(batch_cells.select(*CELL_COLS), store(root), batch_id, stream)


def fold(spark, root: str, upto: int, stream: str = "dim") -> upsert_store.Manifest:
    """Fold the batches up to ``upto``, none of which will be replayed."""
    return upsert_store.fold(spark, store(root), {stream: upto})


def read_current(spark, root: str, sink_table: str) -> DataFrame | None:
    """Merged state of one sink table: the folded base and the batches since;
    None where nothing has been written yet.  Any other failure is raised."""
    return upsert_store.read(spark, store(root), sink_table)


def read_history(spark, root: str, sink_table: str) -> DataFrame | None:
    """Every cell version of one sink table."""
    return upsert_store.read_history(spark, store(root), sink_table)
