"""Domain rows derived from the given tables.

The reference consumes captured change logs of a parcel-transport database.
No such log ships with the test data, so each source table is derived from
the TPC-H-like tables (the mapping is documented in the README and mirrored
by the oracle SQL).  All derivations are plain joins/projections; the only
keyed sequential step (previous order status) uses the skew-safe scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelstream import schemas
from parcelstream.operators.keyed_scan import WHOLE, asof_last, whole
from parcelstream.sources.tables import epoch_ms, iso_text, read

DAY_MS = 24 * 60 * 60 * 1000
MONEY = schemas.MONEY


def _s(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def nation_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation -> region key; the planner broadcasts it from its size."""
    return read(spark, sf_dir, "nation", "n_nationkey", "n_regionkey")


def order_sources(spark: SparkSession, sf_dir: str, merge: bool = False) -> DataFrame:
    """The given columns an ``order_info`` image is made of, one row per order that
    has its customer and nation.  ``merge`` joins customers the same way at every size,
    so that what is moved has no step where they no longer fit a broadcast."""
    o = read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus",
             "o_totalprice", "o_orderdate", "o_orderpriority", spread=True)
    c = read(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_acctbal",
             "c_mktsegment")
    j = o.join(c.hint("merge") if merge else c, o.o_custkey == c.c_custkey).join(
        nation_geo(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
    return j.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                    "o_orderpriority", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment",
                    "n_regionkey")


def order_attributes() -> list[F.Column]:
    """The attributes of an order (``order_sources``), status 60010."""
    district, province = _s("c_nationkey"), _s("n_regionkey")
    created = iso_text("o_orderdate")
    return [
        _s("o_orderkey").alias("id"),
        F.concat(F.lit("WB"), F.lpad(_s("o_orderkey"), 10, "0")).alias("order_no"),
        F.lit(schemas.ST_CREATED).alias("status"),
        F.when(F.col("o_orderstatus") == "O", "2").otherwise("1").alias("collect_type"),
        _s("o_custkey").alias("user_id"),
        _s("o_custkey").alias("receiver_complex_id"),
        province.alias("receiver_province_id"),
        district.alias("receiver_city_id"),
        district.alias("receiver_district_id"),
        F.col("c_mktsegment").alias("receiver_name"),
        _s("o_custkey").alias("sender_complex_id"),
        province.alias("sender_province_id"),
        district.alias("sender_city_id"),
        district.alias("sender_district_id"),
        F.col("c_name").alias("sender_name"),
        F.col("o_orderpriority").alias("payment_type"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("cargo_num"),
        F.col("o_totalprice").cast(MONEY).alias("amount"),
        (epoch_ms("o_orderdate") + F.lit(3 * DAY_MS)).alias("estimate_arrive_time"),
        F.abs(F.col("c_acctbal")).cast(MONEY).alias("distance"),
        created.alias("create_time"),
        created.alias("update_time"),
        F.lit("0").alias("is_deleted"),
    ]


def order_info_rows(spark: SparkSession, sf_dir: str, merge: bool = False) -> DataFrame:
    """Typed ``order_info`` images (creation) plus ``ts_ms`` and the numeric
    ``order_key`` (``id`` is its text form) for joins."""
    return order_sources(spark, sf_dir, merge).select(
        F.col("o_orderkey").alias("order_key"), *order_attributes(),
        epoch_ms("o_orderdate").alias("ts_ms"))


def order_cargo_rows(spark: SparkSession, sf_dir: str, merge: bool = False) -> DataFrame:
    """``order_cargo`` images: one cargo per line item, typed by its part
    (``merge`` as in ``order_sources``)."""
    li = read(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
              "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate", spread=True)
    p = read(spark, sf_dir, "part", "p_partkey", "p_type", "p_size")
    j = li.join(p.hint("merge") if merge else p, li.l_partkey == p.p_partkey)
    created = iso_text("l_shipdate")
    return j.select(
        cargo_id().alias("id"),
        _s("l_orderkey").alias("order_id"),
        F.col("p_type").alias("cargo_type"),
        F.col("p_size").cast("int").alias("volumn_length"),
        F.col("l_linenumber").cast("int").alias("volumn_width"),
        F.col("l_quantity").cast("int").alias("volumn_height"),
        F.col("l_quantity").cast(MONEY).alias("weight"),
        created.alias("create_time"),
        created.alias("update_time"),
        F.lit("0").alias("is_deleted"),
        epoch_ms("l_shipdate").alias("ts_ms"),
        F.col("l_orderkey").alias("order_key"),
    )


def cargo_id() -> F.Column:
    """Line items have no single-column key; these five columns are unique."""
    return F.concat_ws("-", _s("l_orderkey"), _s("l_partkey"), _s("l_suppkey"),
                       _s("l_linenumber"), _s(F.col("l_extendedprice").cast("decimal(18,2)")))


# --------------------------------------------------------------------------
# Order life-cycle change log from ``events``
# --------------------------------------------------------------------------
# How an event becomes a change of the order with id = user_id.
#   signup   -> order_info  create
#   view     -> order_info  update (status change candidate)
#   click    -> order_info  update
#   purchase -> order_cargo create (a cargo row of that order)
#   error    -> a capture error: the change record is not valid JSON
EVENT_TABLE = {"signup": "order_info", "view": "order_info", "click": "order_info",
               "purchase": "order_cargo"}
EVENT_OP = {"signup": "c", "view": "u", "click": "u", "purchase": "c"}


def event_status() -> F.Column:
    """Status after the change: the ``k``-th status code, ``k = props.k mod 9``."""
    k = F.col("k")
    codes = F.array(*[F.lit(c) for c in schemas.STATUS_CODES])
    return F.element_at(codes, F.pmod(k, F.lit(len(schemas.STATUS_CODES))) + 1)


def order_change_log(spark: SparkSession, sf_dir: str, merge: bool = False) -> DataFrame:
    """Clean change log of ``order_info``/``order_cargo`` derived from events.

    Columns: ``seq, ts_ms, op, table, order_key, status, before_status``
    plus ``before``/``after`` images typed as ORDER_INFO / ORDER_CARGO.
    ``before_status`` is the status of the previous order change of the same
    order (skew-safe scan), null for the first one.  ``merge`` as in ``order_sources``.
    """
    # What is moved are the given columns; all that is derived from them comes after.
    ev = read(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value",
              "props", spread=True).filter(F.col("event_type") != "error").select(
        F.col("event_id").alias("seq"), epoch_ms("ts").alias("ts_ms"),
        F.col("user_id").alias("order_key"), "event_type",
        F.get_json_object("props", "$.k").cast("int").alias("k"), "value")
    table = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v)) for k, v in EVENT_TABLE.items()])
    op = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v)) for k, v in EVENT_OP.items()])
    ev = asof_last(ev, "order_key", ["ts_ms", "seq"],
                   {"prev": F.when(table == "order_info", F.struct(event_status().alias("s")))},
                   keep_bucket=True)
    ev = ev.withColumn("before_status", F.col("prev.s")).drop("prev")

    on = ["order_key"]
    src = order_sources(spark, sf_dir, merge).withColumn("order_key", F.col("o_orderkey"))
    if WHOLE in ev.columns:      # the join keeps the scan's partitions: rows move once
        on, src = [*on, WHOLE], src.withColumn(WHOLE, whole(F.col("order_key")))
    j = ev.join(src, on, "left")
    is_order, known = F.col("table") == "order_info", F.col("o_custkey").isNotNull()
    attrs = order_attributes()
    names = src.select(attrs).columns
    j = j.select(
        "seq", "ts_ms", "order_key", "k", "value", "before_status", event_status().alias("event_status"),
        table.alias("table"), op.alias("op"), iso_text(F.timestamp_millis("ts_ms")).alias("change_time"),
        *[F.when(known, a).alias(n) for n, a in zip(names, attrs) if n not in ("status", "update_time")])
    info_fields = [f.name for f in schemas.ORDER_INFO.fields]

    def info_image(status_col):
        cols = []
        for n in info_fields:
            if n == "status":
                cols.append(status_col.alias(n))
            elif n == "update_time":
                cols.append(F.col("change_time").alias(n))
            else:
                cols.append(F.col(n))
        return F.struct(*cols)

    cargo_after = F.struct(
        _s("seq").alias("id"), _s("order_key").alias("order_id"),
        F.concat(F.lit("K"), _s("k")).alias("cargo_type"),
        F.col("k").alias("volumn_length"), F.lit(None).cast("int").alias("volumn_width"),
        F.lit(None).cast("int").alias("volumn_height"),
        F.col("value").cast(MONEY).alias("weight"),
        F.col("change_time").alias("create_time"), F.col("change_time").alias("update_time"),
        F.lit("0").alias("is_deleted"))
    return j.select(
        "seq", "ts_ms", "op", "table", "order_key", F.col("event_status").alias("status"), "before_status",
        F.when(is_order, info_image(F.col("event_status"))).alias("order_after"),
        F.when(is_order & (F.col("op") == "u"), info_image(F.col("before_status")))
        .alias("order_before"),
        F.when(~is_order, cargo_after).alias("cargo_after"),
    )
