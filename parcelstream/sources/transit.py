"""Transit change logs (``order_org_bound``, ``transport_task``) derived
from line items.

* ``order_org_bound``: each line item is received (``c``) at its station
  (the supplier) at ship time, sorted (``u``, ``sort_time`` set) two hours
  later and, for finished lines (``l_linestatus = 'F'``), shipped out
  (``u``, ``outbound_time`` set) five hours after receipt.
* ``transport_task``: each line item is a task started (``c``) at the order
  date and finished (``u``, ``actual_end_time`` set) at the ship date; the
  two dates are independent in the data, so durations may be negative.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelstream import schemas
from parcelstream.sources.domain import cargo_id
from parcelstream.sources.tables import epoch_ms, iso_text, read

HOUR_MS = 3_600_000
BOUND_FIELDS = [f.name for f in schemas.ORDER_ORG_BOUND.fields]
TASK_FIELDS = [f.name for f in schemas.TRANSPORT_TASK.fields]


def _iso_ms(ms) -> F.Column:
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _image(fields, values: dict) -> F.Column:
    return F.struct(*[(values.get(n, F.lit(None).cast("string"))).alias(n) for n in fields])


def bound_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
              "l_extendedprice", "l_shipdate", "l_linestatus", spread=True)
    # Per-row values are computed once in a projection: the generator below
    # would otherwise evaluate every repeated expression per image.
    li = li.select(
        "l_linestatus", epoch_ms("l_shipdate").alias("t0"), cargo_id().alias("cid"),
        F.col("l_orderkey").cast("string").alias("oid"),
        F.col("l_suppkey").cast("string").alias("sup"))
    li = li.select("*", _iso_ms(F.col("t0")).alias("i0"),
                   _iso_ms(F.col("t0") + 2 * HOUR_MS).alias("i2"),
                   _iso_ms(F.col("t0") + 5 * HOUR_MS).alias("i5"))
    t0, sup = F.col("t0"), F.col("sup")
    base = {"id": F.col("cid"), "order_id": F.col("oid"), "org_id": sup,
            "inbound_time": F.col("i0"), "inbound_emp_id": F.concat(F.lit("E"), sup),
            "create_time": F.col("i0"), "is_deleted": F.lit("0")}
    received = dict(base, status=F.lit("67001"), update_time=F.col("i0"))
    sorted_ = dict(received, status=F.lit("67002"), sort_time=F.col("i2"),
                   sorter_emp_id=F.concat(F.lit("S"), sup), update_time=F.col("i2"))
    shipped = dict(sorted_, status=F.lit("67003"), outbound_time=F.col("i5"),
                   outbound_emp_id=F.concat(F.lit("O"), sup), update_time=F.col("i5"))
    null_img = F.lit(None).cast(schemas.ORDER_ORG_BOUND)
    receive = F.struct(F.lit("c").alias("op"), t0.alias("ts_ms"), null_img.alias("before"),
                       _image(BOUND_FIELDS, received).alias("after"))
    sort = F.struct(F.lit("u").alias("op"), (t0 + 2 * HOUR_MS).alias("ts_ms"),
                    _image(BOUND_FIELDS, received).alias("before"),
                    _image(BOUND_FIELDS, sorted_).alias("after"))
    ship = F.struct(F.lit("u").alias("op"), (t0 + 5 * HOUR_MS).alias("ts_ms"),
                    _image(BOUND_FIELDS, sorted_).alias("before"),
                    _image(BOUND_FIELDS, shipped).alias("after"))
    # A plain CASE between two arrays keeps the generator input in generated
    # code (a higher-order ``filter`` lambda would be interpreted per row).
    changes = F.when(F.col("l_linestatus") == "F", F.array(receive, sort, ship)) \
        .otherwise(F.array(receive, sort))
    return li.select(F.inline(changes))


def task_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
              "l_quantity", "l_extendedprice", "l_shipdate", spread=True)
    o = read(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    # Orders grow with the line items: a broadcast of them would only fit small inputs.
    j = li.join(o.hint("merge"), li.l_orderkey == o.o_orderkey).select(
        cargo_id().alias("cid"), F.col("l_linenumber").cast("string").alias("ln"),
        F.col("l_suppkey").cast("string").alias("sup"),
        F.col("l_partkey").cast("string").alias("prt"),
        F.col("l_quantity").cast("int").alias("qty"),
        F.col("l_extendedprice").cast(schemas.MONEY).alias("dist"),
        iso_text("o_orderdate").alias("start_iso"), iso_text("l_shipdate").alias("end_iso"),
        epoch_ms("o_orderdate").alias("start_ms"), epoch_ms("l_shipdate").alias("end_ms"))
    sup, part = F.col("sup"), F.col("prt")
    started = {
        "id": F.col("cid"), "shift_id": F.concat(F.lit("SH"), F.col("ln")),
        "line_id": F.concat(F.lit("LN"), sup), "start_org_id": sup,
        "order_num": F.col("qty"), "driver1_emp_id": F.concat(F.lit("D"), sup),
        "truck_id": part, "truck_no": F.concat(F.lit("TRK"), part),
        "actual_start_time": F.col("start_iso"), "actual_distance": F.col("dist")}
    finished = dict(started, actual_end_time=F.col("end_iso"))

    def img(vals):
        return F.struct(*[(vals[n] if n in vals else
                           F.lit(None).cast(schemas.TRANSPORT_TASK[n].dataType)).alias(n)
                          for n in TASK_FIELDS])

    null_img = F.lit(None).cast(schemas.TRANSPORT_TASK)
    changes = F.array(
        F.struct(F.lit("c").alias("op"), F.col("start_ms").alias("ts_ms"),
                 null_img.alias("before"), img(started).alias("after")),
        F.struct(F.lit("u").alias("op"), F.col("end_ms").alias("ts_ms"),
                 img(started).alias("before"), img(finished).alias("after")))
    return j.select(F.inline(changes))
