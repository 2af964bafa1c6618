"""Daily aggregates (DWS layer) over the order / transit facts.

Every aggregate groups by the local day of the fact time plus its grain,
aggregates *before* any dimension lookup (partial aggregation runs map-side,
so a hot day/grain is combined in every task before the shuffle), then
enriches the small result (transports per truck model take the model first).  Columns marked transient in the declared schema
(join helpers such as the district or the truck id) are dropped before output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelstream.functions.timefn import DEFAULT_TZ, millis_to_date
from parcelstream.operators.lookups import centre_of_district, dim_lookup, org_city_province

SUM = "decimal(38,2)"


def with_day(facts: DataFrame, tz: str = DEFAULT_TZ) -> DataFrame:
    return facts.withColumn("cur_date", millis_to_date(F.col("ts"), tz))


def drop_transient(df: DataFrame, *cols: str) -> DataFrame:
    """Sink-side removal of transient helper columns."""
    return df.drop(*cols)


# Each aggregate has two steps: ``*_grain`` counts facts per local day and grain,
# on the few columns it needs, and ``*_named`` looks the small result up in the
# dimensions.  The streams keep the first and apply the second when read.
def cargo_type_grain(place_facts: DataFrame, tz: str = DEFAULT_TZ) -> DataFrame:
    return with_day(place_facts, tz).groupBy("cur_date", "cargo_type").agg(
        F.sum("amount").cast(SUM).alias("order_amount_base"),
        F.count(F.lit(1)).alias("order_count_base"),
        F.max("ts").alias("ts"))


def cargo_type_named(agg: DataFrame, base_dic: DataFrame) -> DataFrame:
    out = dim_lookup(agg, "cargo_type", base_dic, "id", {"name": "cargo_type_name"})
    return out.select("cur_date", "cargo_type", "cargo_type_name", "order_amount_base",
                      "order_count_base", "ts")


def cargo_type_order_day(place_facts: DataFrame, base_dic: DataFrame,
                         tz: str = DEFAULT_TZ) -> DataFrame:
    return cargo_type_named(cargo_type_grain(place_facts, tz), base_dic)


def _district_then_org(agg: DataFrame, district: str, organ: DataFrame,
                       measures: dict[str, str]) -> DataFrame:
    """Re-key a per-(day, district) aggregate to the district's centre."""
    keyed = centre_of_district(agg, district, organ, "org_id")
    return keyed.groupBy("cur_date", "org_id").agg(
        *[getattr(F, fn)(c).alias(c) for c, fn in measures.items()],
        F.max("ts").alias("ts"))


def org_order_grain(place_facts: DataFrame, tz: str = DEFAULT_TZ) -> DataFrame:
    """A place-order fact is one cargo row; an order counts once a day, with its
    amount, however many cargo rows it has."""
    once = with_day(place_facts, tz).groupBy("cur_date", "sender_district_id", "order_id").agg(
        F.max("amount").alias("amount"), F.max("ts").alias("ts"))
    return once.groupBy("cur_date", "sender_district_id").agg(
        F.sum("amount").cast(SUM).alias("order_amount_base"),
        F.count(F.lit(1)).alias("order_count_base"), F.max("ts").alias("ts"))


def org_order_named(agg: DataFrame, organ: DataFrame, region: DataFrame) -> DataFrame:
    by_org = _district_then_org(agg, "sender_district_id", organ,
                                {"order_amount_base": "sum", "order_count_base": "sum"})
    by_org = by_org.withColumn("order_amount_base", F.col("order_amount_base").cast(SUM))
    out = org_city_province(by_org, "org_id", organ, region)
    return out.select("cur_date", "org_id", "org_name", "city_id", "city_name",
                      "order_amount_base", "order_count_base", "ts")


def org_order_day(place_facts: DataFrame, organ: DataFrame, region: DataFrame,
                  tz: str = DEFAULT_TZ) -> DataFrame:
    """Orders and their amounts per centre and day."""
    return org_order_named(org_order_grain(place_facts, tz), organ, region)


def org_receive_grain(receive_facts: DataFrame, tz: str = DEFAULT_TZ) -> DataFrame:
    once = with_day(receive_facts, tz).groupBy("cur_date", "sender_district_id", "order_id") \
        .agg(F.max("ts").alias("ts"))
    return once.groupBy("cur_date", "sender_district_id").agg(
        F.count(F.lit(1)).alias("receive_order_count_base"), F.max("ts").alias("ts"))


def org_receive_named(agg: DataFrame, organ: DataFrame, region: DataFrame) -> DataFrame:
    by_org = _district_then_org(agg, "sender_district_id", organ,
                                {"receive_order_count_base": "sum"})
    out = org_city_province(by_org, "org_id", organ, region)
    return out.select("cur_date", "org_id", "org_name", "city_id", "city_name", "province_id",
                      "province_name", "receive_order_count_base", "ts")


def org_receive_day(receive_facts: DataFrame, organ: DataFrame, region: DataFrame,
                    tz: str = DEFAULT_TZ) -> DataFrame:
    """Receipts per centre and day; one order counts once per day."""
    return org_receive_named(org_receive_grain(receive_facts, tz), organ, region)


def orders_per_day(facts: DataFrame, measure: str, tz: str = DEFAULT_TZ) -> DataFrame:
    """Distinct orders per day (dispatch, bound finish)."""
    once = with_day(facts, tz).groupBy("cur_date", "order_id").agg(F.max("ts").alias("ts"))
    return once.groupBy("cur_date").agg(F.count(F.lit(1)).alias(measure),
                                        F.max("ts").alias("ts"))


def org_deliver_suc_grain(deliver_facts: DataFrame, tz: str = DEFAULT_TZ) -> DataFrame:
    return with_day(deliver_facts, tz).groupBy("cur_date", "receiver_district_id").agg(
        F.count(F.lit(1)).alias("deliver_suc_count_base"), F.max("ts").alias("ts"))


def org_deliver_suc_named(agg: DataFrame, organ: DataFrame, region: DataFrame) -> DataFrame:
    by_org = _district_then_org(agg, "receiver_district_id", organ,
                                {"deliver_suc_count_base": "sum"})
    out = org_city_province(by_org, "org_id", organ, region)
    return out.select("cur_date", "org_id", "org_name", "city_id", "city_name", "province_id",
                      "province_name", "deliver_suc_count_base", "ts")


def org_deliver_suc_day(deliver_facts: DataFrame, organ: DataFrame, region: DataFrame,
                        tz: str = DEFAULT_TZ) -> DataFrame:
    return org_deliver_suc_named(org_deliver_suc_grain(deliver_facts, tz), organ, region)


def org_sort_grain(sort_facts: DataFrame, tz: str = DEFAULT_TZ) -> DataFrame:
    return with_day(sort_facts, tz).groupBy("cur_date", "org_id").agg(
        F.count(F.lit(1)).alias("sort_count_base"), F.max("ts").alias("ts"))


def org_sort_named(agg: DataFrame, organ: DataFrame, region: DataFrame) -> DataFrame:
    out = org_city_province(agg, "org_id", organ, region)
    out = drop_transient(out, "join_org_id")
    return out.select("cur_date", "org_id", "org_name", "city_id", "city_name", "province_id",
                      "province_name", "sort_count_base", "ts")


def org_sort_day(sort_facts: DataFrame, organ: DataFrame, region: DataFrame,
                 tz: str = DEFAULT_TZ) -> DataFrame:
    return org_sort_named(org_sort_grain(sort_facts, tz), organ, region)


def truck_finish_grain(finish_facts: DataFrame, tz: str = DEFAULT_TZ) -> DataFrame:
    return with_day(finish_facts, tz).groupBy("cur_date", "start_org_id", "truck_id").agg(
        F.count(F.lit(1)).alias("trans_finish_count_base"),
        F.sum("actual_distance").cast(SUM).alias("trans_finish_distance_base"),
        F.sum("transport_time").alias("trans_finish_dur_time_base"),
        F.max("ts").alias("ts"))


def _model_finish_named(by_model: DataFrame, models: DataFrame, organ: DataFrame,
                        region: DataFrame) -> DataFrame:
    out = dim_lookup(by_model, "truck_model_id", models, "id", {"model_name": "truck_model_name"})
    out = org_city_province(out, "org_id", organ, region)
    return out.select("cur_date", "org_id", "org_name", "truck_model_id", "truck_model_name",
                      "city_id", "city_name", "trans_finish_count_base",
                      "trans_finish_distance_base", "trans_finish_dur_time_base", "ts")


def truck_finish_named(agg: DataFrame, trucks: DataFrame, models: DataFrame,
                       organ: DataFrame, region: DataFrame) -> DataFrame:
    agg = dim_lookup(agg, "truck_id", trucks, "id", {"truck_model_id": "truck_model_id"})
    by_model = agg.groupBy("cur_date", F.col("start_org_id").alias("org_id"),
                           "truck_model_id").agg(
        F.sum("trans_finish_count_base").alias("trans_finish_count_base"),
        F.sum("trans_finish_distance_base").cast(SUM).alias("trans_finish_distance_base"),
        F.sum("trans_finish_dur_time_base").alias("trans_finish_dur_time_base"),
        F.max("ts").alias("ts"))
    return _model_finish_named(by_model, models, organ, region)


def org_truck_model_finish_day(finish_facts: DataFrame, trucks: DataFrame, models: DataFrame,
                               organ: DataFrame, region: DataFrame,
                               tz: str = DEFAULT_TZ) -> DataFrame:
    """Finished transports per centre, truck model and day.  A truck seldom finishes
    twice a day at one place, so counting per truck first would combine next to
    nothing and move every fact once more: facts get their model, then are counted."""
    facts = dim_lookup(finish_facts, "truck_id", trucks, "id", {"truck_model_id": "truck_model_id"})
    by_model = with_day(facts, tz).groupBy("cur_date", F.col("start_org_id").alias("org_id"),
                                           "truck_model_id").agg(
        F.sum(F.lit(1)).alias("trans_finish_count_base"),
        F.sum("actual_distance").cast(SUM).alias("trans_finish_distance_base"),
        F.sum("transport_time").alias("trans_finish_dur_time_base"),
        F.max("ts").alias("ts"))
    return _model_finish_named(by_model, models, organ, region)


# --------------------------------------------------------------------------
# Streaming form: local-day tumbling windows with a watermark
# --------------------------------------------------------------------------
def local_day_window(tz_offset_hours: int = 8) -> tuple[str, str, str]:
    """``window()`` arguments for days that start at local midnight of a
    fixed-offset zone (+8 h -> windows start at 16:00 UTC)."""
    return "1 day", "1 day", f"{(24 - tz_offset_hours) % 24} hours"


def stream_orders_per_day(facts: DataFrame, measure: str, watermark: str = "1 day",
                          tz: str = DEFAULT_TZ, tz_offset_hours: int = 8) -> DataFrame:
    """Distinct orders per local day over a fact stream (``update`` mode).
    A repeated order is dropped while it is inside the watermark delay, so
    the delay must cover the time an order can repeat within a day."""
    ev = facts.withColumn("event_time", F.timestamp_millis("ts")) \
        .withColumn("cur_date", millis_to_date(F.col("ts"), tz)) \
        .withWatermark("event_time", watermark)
    once = ev.dropDuplicatesWithinWatermark(["cur_date", "order_id"])
    agg = once.groupBy(F.window("event_time", *local_day_window(tz_offset_hours))).agg(
        F.count(F.lit(1)).alias(measure), F.max("ts").alias("ts"))
    return agg.select(
        F.date_format(F.from_utc_timestamp(F.col("window.start"), tz), "yyyy-MM-dd")
        .alias("cur_date"), measure, "ts")


def stream_org_receive_day(facts: DataFrame, organ: DataFrame, region: DataFrame,
                           watermark: str = "1 day", tz: str = DEFAULT_TZ,
                           tz_offset_hours: int = 8) -> DataFrame:
    """Streaming receipts per centre and local day (``update`` mode).

    The lookups run as stream-static joins *before* the stateful steps (the
    organisation attributes are functionally dependent on ``org_id``, so they
    ride along in the grouping key); a repeated order is dropped while it is
    inside the watermark delay, then day windows count per centre."""
    ev = facts.withColumn("event_time", F.timestamp_millis("ts")) \
        .withColumn("cur_date", millis_to_date(F.col("ts"), tz))
    ev = centre_of_district(ev, "sender_district_id", organ, "org_id")
    ev = org_city_province(ev, "org_id", organ, region)
    once = ev.withWatermark("event_time", watermark) \
        .dropDuplicatesWithinWatermark(["cur_date", "org_id", "order_id"])
    keys = ["org_id", "org_name", "city_id", "city_name", "province_id", "province_name"]
    agg = once.groupBy(F.window("event_time", *local_day_window(tz_offset_hours)), *keys).agg(
        F.count(F.lit(1)).alias("receive_order_count_base"), F.max("ts").alias("ts"))
    return agg.select(
        F.date_format(F.from_utc_timestamp(F.col("window.start"), tz), "yyyy-MM-dd")
        .alias("cur_date"), *keys, "receive_order_count_base", "ts")
