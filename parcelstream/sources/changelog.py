"""Captured change-log records (JSON text) derived from the given tables.

The reference reads Debezium-style envelopes from a database.  Here the
"captured" log is built from the tables, as one record per change:

* fact group (``dwd``): order creations from ``orders``, cargo creations from
  ``lineitem``, and the order life-cycle changes from ``events``; an
  ``error`` event is a capture error (empty text, non-JSON text, a scalar
  ``after`` or a null record, chosen by ``k mod 4``);
* dimension group (``realtime_dim``): an initial snapshot (``op='r'``) of
  customers, organisations, regions, cargo types, trucks and truck models,
  then customer updates (negative balance) and deletes (balance below -500),
  cargo-type updates, and rows of an unconfigured table (``employee_info``).

Records carry ``part`` (source partition) and ``offset`` like a Kafka topic;
``(ts, part, offset)`` orders changes of one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelstream import schemas
from parcelstream.sources import dims, domain, transit
from parcelstream.sources.tables import epoch_ms, read, union_all

# Capture times of the dimension snapshot and later changes.
SNAPSHOT_MS = 1704067200000            # 2024-01-01T00:00:00Z
DIM_UPDATE_MS = SNAPSHOT_MS + 2 * 86400000
DIM_DELETE_MS = SNAPSHOT_MS + 3 * 86400000

# Source partitions of the captured log.
PART = {"order_info": 0, "order_cargo": 1, "events": 2, "user_info": 3, "base_organ": 4,
        "base_region_info": 5, "base_dic": 6, "truck_info": 7, "truck_model": 8,
        "employee_info": 9, "order_org_bound": 10, "transport_task": 11}


def envelope(op, ts_ms, before, after, table: str) -> F.Column:
    """JSON text of one change envelope (null members are omitted)."""
    return F.to_json(F.struct(
        F.lit(op).alias("op") if isinstance(op, str) else op.alias("op"),
        ts_ms.alias("ts_ms"),
        before.alias("before"), after.alias("after"),
        F.struct(F.lit(table).alias("table")).alias("source")))


def _record(df: DataFrame, part: int, offset, value) -> DataFrame:
    return df.select(F.lit(part).alias("part"), offset.cast("long").alias("offset"),
                     value.alias("value"))


def _struct_of(df: DataFrame, cols) -> F.Column:
    return F.struct(*[F.col(c) for c in cols])


def null_image() -> F.Column:
    return F.lit(None).cast("struct<id:string>")


def fact_records(spark: SparkSession, sf_dir: str, order_log: DataFrame | None = None,
                 tables: Sequence[str] = ("order_info", "order_cargo")) -> DataFrame:
    """The fact group, or the source partitions that hold records of ``tables``
    (a reader subscribes to tables; the life-cycle partition holds both)."""
    recs = {"order_info": _order_records, "order_cargo": _cargo_records}
    return union_all([*(recs[t](spark, sf_dir) for t in recs if t in tables),
                      event_records(spark, sf_dir, order_log)])


def _order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    oi = domain.order_info_rows(spark, sf_dir, merge=True)
    # Orders with a key are read and moved once, here and where events look them up
    # (a join keeps no rows without a key, so those are put beside).
    key = F.col("order_key")
    oi = oi.filter(key.isNotNull()).unionByName(oi.filter(key.isNull()))
    info_cols = [f.name for f in schemas.ORDER_INFO.fields]
    return _record(oi, PART["order_info"], F.col("id").cast("long"),
                   envelope("c", F.col("ts_ms"), null_image(),
                            _struct_of(oi, info_cols), "order_info"))


def _cargo_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    oc = domain.order_cargo_rows(spark, sf_dir, merge=True)
    cargo_cols = [f.name for f in schemas.ORDER_CARGO.fields]
    return _record(oc, PART["order_cargo"], F.xxhash64("id"),
                   envelope("c", F.col("ts_ms"), null_image(),
                            _struct_of(oc, cargo_cols), "order_cargo"))


def event_records(spark: SparkSession, sf_dir: str, order_log: DataFrame | None = None) -> DataFrame:
    """Order life-cycle records; capture errors for ``error`` events.
    ``order_log`` may pass an already stored order change log."""
    log = order_log if order_log is not None else domain.order_change_log(spark, sf_dir, merge=True)
    is_order = F.col("table") == "order_info"
    good = log.select(
        F.lit(PART["events"]).alias("part"), F.col("seq").alias("offset"),
        F.when(is_order, envelope(F.col("op"), F.col("ts_ms"), F.col("order_before"),
                                  F.col("order_after"), "order_info"))
        .otherwise(envelope(F.col("op"), F.col("ts_ms"), null_image(), F.col("cargo_after"),
                            "order_cargo")).alias("value"))
    err = read(spark, sf_dir, "events", "event_id", "ts", "event_type", "props") \
        .filter(F.col("event_type") == "error")
    kind = F.pmod(F.get_json_object("props", "$.k").cast("int"), F.lit(4))
    bad_value = (F.when(kind == 0, F.lit(""))
                 .when(kind == 1, F.concat(F.lit("capture error at offset "),
                                           F.col("event_id").cast("string")))
                 .when(kind == 2, F.to_json(F.struct(
                     F.lit("u").alias("op"), epoch_ms("ts").alias("ts_ms"),
                     F.col("event_id").alias("after"),
                     F.struct(F.lit("order_info").alias("table")).alias("source")))))
    bad = err.select(F.lit(PART["events"]).alias("part"), F.col("event_id").alias("offset"),
                     bad_value.alias("value"))
    return good.unionByName(bad)


def dim_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    snap = F.lit(SNAPSHOT_MS).cast("long")
    recs = []
    snapshots = {
        "user_info": (dims.user_info(spark, sf_dir), ["id", "login_name", "user_level",
                                                      "region_id"]),
        "base_organ": (dims.base_organ(spark, sf_dir), ["id", "org_name", "org_parent_id",
                                                        "region_id"]),
        "base_region_info": (dims.base_region_info(spark, sf_dir), ["id", "name", "parent_id"]),
        "base_dic": (dims.base_dic(spark, sf_dir), ["id", "name"]),
        "truck_info": (dims.truck_info(spark, sf_dir), ["id", "truck_model_id"]),
        "truck_model": (dims.truck_model(spark, sf_dir), ["id", "model_name"]),
    }
    for table, (df, cols) in snapshots.items():
        recs.append(_record(df, PART[table], F.xxhash64("id"),
                            envelope("r", snap, null_image(), _struct_of(df, cols), table)))
    c = read(spark, sf_dir, "customer", "c_custkey", "c_name", "c_mktsegment", "c_nationkey",
             "c_acctbal")
    img = F.struct(F.col("c_custkey").cast("string").alias("id"),
                   F.col("c_name").alias("login_name"), F.col("c_mktsegment").alias("user_level"),
                   F.col("c_nationkey").cast("string").alias("region_id"))
    upd = F.struct(F.col("c_custkey").cast("string").alias("id"),
                   F.upper("c_name").alias("login_name"), F.lit("ARREARS").alias("user_level"),
                   F.col("c_nationkey").cast("string").alias("region_id"))
    neg = c.filter(F.col("c_acctbal") < 0)
    recs.append(_record(neg, PART["user_info"], F.col("c_custkey") + F.lit(1 << 40),
                        envelope("u", F.lit(DIM_UPDATE_MS).cast("long"), img, upd, "user_info")))
    gone = c.filter(F.col("c_acctbal") < -500)
    recs.append(_record(gone, PART["user_info"], F.col("c_custkey") + F.lit(2 << 40),
                        envelope("d", F.lit(DIM_DELETE_MS).cast("long"), upd, null_image(),
                                 "user_info")))
    dic = dims.base_dic(spark, sf_dir)
    recs.append(_record(dic, PART["base_dic"], F.xxhash64("id") + F.lit(1),
                        envelope("u", F.lit(DIM_UPDATE_MS).cast("long"),
                                 _struct_of(dic, ["id", "name"]),
                                 F.struct(F.col("id"), F.upper("name").alias("name")),
                                 "base_dic")))
    s = read(spark, sf_dir, "supplier", "s_suppkey", "s_name")
    recs.append(_record(s, PART["employee_info"], F.col("s_suppkey"),
                        envelope("r", snap, null_image(),
                                 F.struct(F.col("s_suppkey").cast("string").alias("id"),
                                          F.col("s_name").alias("emp_name")),
                                 "employee_info")))
    return union_all(recs)


TRANSIT = {"order_org_bound": transit.bound_changelog, "transport_task": transit.task_changelog}


def transit_records(spark: SparkSession, sf_dir: str,
                    tables: Sequence[str] = tuple(TRANSIT)) -> DataFrame:
    """Captured changes of bound rows and transport tasks, or of one of them."""
    recs = []
    for table in tables:
        log = TRANSIT[table](spark, sf_dir)
        recs.append(_record(log, PART[table], F.xxhash64("after.id", "op", "ts_ms"), envelope(
            F.col("op"), F.col("ts_ms"), F.col("before"), F.col("after"), table)))
    return union_all(recs)


def captured_log(spark: SparkSession, sf_dir: str, order_log: DataFrame | None = None) -> DataFrame:
    """The whole captured log: fact group then dimension group."""
    return fact_records(spark, sf_dir, order_log).unionByName(dim_records(spark, sf_dir))
