"""Where a change stream starts, and what stands for the time before.

* ``earliest``: all captured records, from the first one on.
* ``latest``: the records captured after the start; what is there already is left.
* ``snapshot``: first the rows as they stand at the start (one record a row, with
  ``op = 'r'``; deleted rows are absent), then the records after it.

The seam is a position per source partition: the high-water positions are written
once, before anything is read, and every record is on one side of them, whatever
is captured meanwhile.  The snapshot reads up to them, the stream from there on, so
no change is lost or comes twice.  Both files are published by a rename beside the
query's checkpoint and found again after a restart: a crash in between repeats the
same snapshot, as the captured log only grows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelstream.operators import ods
from parcelstream.operators.upsert_store import Files

MODES = ("earliest", "latest", "snapshot")
RAW_DDL = "part int, offset long, value string"
POSITION_DDL = "part int, upto long"


def _once(spark: SparkSession, root: str, name: str, make: Callable[[], DataFrame]) -> str:
    """``root/name``, written by ``make`` where it does not exist yet."""
    files = Files(spark, root)
    if not files.exists(name):
        aside = f"_aside/{uuid.uuid4().hex}"
        make().write.parquet(f"{files.root}/{aside}")
        files.move(aside, name)
    return f"{files.root}/{name}"


def marks(spark: SparkSession, log: DataFrame, root: str) -> DataFrame:
    """The high-water positions of ``log(part, offset, value)`` at the first start."""
    path = _once(spark, root, "positions", lambda: log.groupBy("part").agg(
        F.max("offset").alias("upto")))
    return spark.read.schema(POSITION_DDL).parquet(path)


def _sided(records: DataFrame, marked: DataFrame) -> DataFrame:
    m = marked.select(F.col("part").alias("__part"), "upto")
    return records.join(m, records["part"].eqNullSafe(m["__part"]), "left").drop("__part")


def after(records: DataFrame, marked: DataFrame) -> DataFrame:
    """Records beyond the marks, partitions that are new since included."""
    cols = records.columns
    return _sided(records, marked).filter("upto is null or offset > upto").select(*cols)


def until(records: DataFrame, marked: DataFrame) -> DataFrame:
    cols = records.columns
    return _sided(records, marked).filter("offset <= upto").select(*cols)


def snapshot(log: DataFrame) -> DataFrame:
    """The rows as they stand after ``log``, as captured records: the last image of
    each (table, id) by time and position, none where that is a delete.  What can't
    be keyed (malformed records, rows without id) is passed on as it is, so that
    the quarantine sees it.  A combinable aggregate: a row with very many changes
    is reduced in every task before the shuffle."""
    parsed = ods.parse(log)
    e = F.col("e")
    table = F.col("e.source.table")
    image = lambda n: e.getField(n)
    rid = F.coalesce(ods.vget(image("after"), "id"), ods.vget(image("before"), "id"))
    rows = parsed.select("part", "offset", "value", table.alias("table"), rid.alias("id"),
                         F.col("e.op").alias("op"), F.col("e.ts_ms").alias("ts"))
    keyed = F.col("table").isNotNull() & F.col("id").isNotNull()
    last = rows.filter(keyed).groupBy("table", "id").agg(F.max_by(
        F.struct("part", "offset", "value", "op"), F.struct("ts", "part", "offset")).alias("m"))
    last = last.filter("m.op is null or m.op <> 'd'").select("m.part", "m.offset", "m.value")
    one = ods.parse(last)
    as_read = one.select("part", "offset", F.to_json(F.struct(
        F.lit("r").alias("op"), F.col("e.ts_ms").alias("ts_ms"), F.col("e.after").alias("after"),
        F.col("e.source").alias("source"))).alias("value"))
    return as_read.unionByName(rows.filter(~F.coalesce(keyed, F.lit(False)))
                               .select("part", "offset", "value"))


def stream(spark: SparkSession, changes: DataFrame, read_log: Callable[[], DataFrame], mode: str,
           root: str) -> DataFrame:
    """The captured records of a stream that starts by ``mode``.  ``changes`` is the
    stream of all records, ``read_log()`` reads them as a table; ``root`` is a folder
    that stays with the query's checkpoint."""
    if mode not in MODES:
        raise ValueError(f"unknown start mode {mode!r}")
    if mode == "earliest":
        return changes
    marked = marks(spark, read_log(), root)
    later = after(changes, marked)
    if mode == "latest":
        return later
    path = _once(spark, root, "snapshot", lambda: snapshot(until(read_log(), marked)))
    return spark.readStream.schema(RAW_DDL).parquet(path).unionByName(later)
