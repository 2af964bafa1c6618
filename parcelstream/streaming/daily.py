"""The daily aggregates as streams with a keyed upsert output.

A stream of facts is grouped by local day and grain in update mode: each
micro-batch hands on the grains that it changed, with their totals so far.
``foreachBatch`` appends them to an upsert store under the batch's id, where the
row of the latest batch stands for its grain; a replayed batch replaces its own
rows, so the output is the same however often it is written.  Lookups happen
when the store is read, on one row a grain, so they see the dimensions as they
are then, and the result has the columns of the batch aggregate.

Facts come from files that a replayed DWD batch may write anew, so a fact seen
twice within the watermark's delay counts once (``identity``).  Aggregates that
count an order once a day drop its further facts from counts and sums (``once``)
and still let them move the last time.

The watermark's delay bounds the state and must be given: it has to cover how
late a fact may come, and the time in which an order can repeat in a day.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelstream.functions.timefn import DEFAULT_TZ, millis_to_date
from parcelstream.operators import dws, upsert_store
from parcelstream.operators.dws import SUM, local_day_window
from parcelstream.operators.upsert_store import Store


@dataclass(frozen=True)
class Daily:
    fact: str
    grain: tuple[str, ...]
    measures: tuple[tuple[str, str | None, str], ...]   # output, summed column (None: count), type
    once: bool = False                                  # an order counts once a day and grain
    identity: tuple[str, ...] = ("id", "order_id", "ts")

    @property
    def ddl(self) -> str:
        return ", ".join(["cur_month string", "cur_date string", *(f"{g} string" for g in self.grain),
                          *(f"{m} {t}" for m, _, t in self.measures), "ts long", "batch long"])


COUNT = "long"
DAILY = {
    "dws_trade_cargo_type_order_day": Daily(
        "dwd_trade_order_detail", ("cargo_type",),
        (("order_amount_base", "amount", SUM), ("order_count_base", None, COUNT))),
    "dws_trade_org_order_day": Daily(
        "dwd_trade_order_detail", ("sender_district_id",),
        (("order_amount_base", "amount", SUM), ("order_count_base", None, COUNT)), once=True),
    "dws_trans_org_receive_day": Daily(
        "dwd_trans_receive_detail", ("sender_district_id",),
        (("receive_order_count_base", None, COUNT),), once=True),
    "dws_trans_dispatch_day": Daily(
        "dwd_trans_dispatch_detail", (), (("dispatch_order_count_base", None, COUNT),), once=True),
    "dws_trans_bound_finish_day": Daily(
        "dwd_trans_bound_finish_detail", (),
        (("bound_finish_order_count_base", None, COUNT),), once=True),
    "dws_trans_org_deliver_suc_day": Daily(
        "dwd_trans_deliver_detail", ("receiver_district_id",),
        (("deliver_suc_count_base", None, COUNT),)),
    "dws_bound_org_sort_day": Daily(
        "dwd_bound_sort", ("org_id",), (("sort_count_base", None, COUNT),)),
    "dws_trans_org_truck_model_finish_day": Daily(
        "dwd_trans_finish", ("start_org_id", "truck_id"),
        (("trans_finish_count_base", None, COUNT),
         ("trans_finish_distance_base", "actual_distance", SUM),
         ("trans_finish_dur_time_base", "transport_time", COUNT)), identity=("id", "ts")),
}


def store(root: str, name: str) -> Store:
    d = DAILY[name]
    return Store(f"{root.rstrip('/')}/{name}", d.ddl, keys=("cur_month", "cur_date", *d.grain),
                 order=("batch",), partition="cur_month")


def totals(facts: DataFrame, d: Daily, watermark: str, tz: str = DEFAULT_TZ,
           tz_offset_hours: int = 8) -> DataFrame:
    """The grains' totals over a stream of facts, for update mode."""
    summed = [c for _, c, _ in d.measures if c]
    rows = facts.select(*{*d.grain, *d.identity, *summed, *(["order_id"] if d.once else [])})
    rows = (rows.withColumn("event_time", F.timestamp_millis("ts"))
            .withColumn("cur_date", millis_to_date(F.col("ts"), tz))
            .withWatermark("event_time", watermark))
    grain = ["cur_date", *d.grain]
    counted = rows.dropDuplicatesWithinWatermark(
        [*grain, "order_id"] if d.once else [*grain, *d.identity])
    counted = counted.withColumn("counts", F.lit(1))
    if d.once:  # an order's further facts move the time, and nothing else
        further = rows.withColumn("counts", F.lit(0))
        counted = counted.unionByName(further.withColumns(
            {c: F.lit(0).cast(further.schema[c].dataType) for c in summed}))
    agg = counted.groupBy(F.window("event_time", *local_day_window(tz_offset_hours)), *grain).agg(
        *[F.sum(c or "counts").cast(t).alias(m) for m, c, t in d.measures], F.max("ts").alias("ts"))
    return agg.drop("window")


def writer(root: str, name: str, fold_every: int = 50):
    """``foreachBatch`` body: the batch's grains into the store, and from time to
    time a fold of the batches before it."""
    target = store(root, name)

    def run(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumns({"batch": F.lit(batch_id), "cur_month": F.substring("cur_date", 1, 7)})
        upsert_store.append(rows, target, batch_id)
        if batch_id and batch_id % fold_every == 0:
            upsert_store.fold(batch.sparkSession, target, {"main": batch_id - 1})
    return run


def query(facts: DataFrame, root: str, name: str, checkpoint: str, watermark: str,
          available_now: bool = False, trigger_seconds: int = 6, fold_every: int = 50):
    w = totals(facts, DAILY[name], watermark).writeStream.outputMode("update").option(
        "checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else \
        w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.foreachBatch(writer(root, name, fold_every)).start()


def named(name: str, rows: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """The stored totals with their dimension attributes, as the batch aggregate
    has them.  ``dims``: base_dic, base_organ, base_region_info, truck_info,
    truck_model, as far as the aggregate needs them."""
    organ, region = dims.get("base_organ"), dims.get("base_region_info")
    rows = rows.drop("batch", "cur_month")
    if name == "dws_trade_cargo_type_order_day":
        return dws.cargo_type_named(rows, dims["base_dic"])
    if name == "dws_trans_org_truck_model_finish_day":
        return dws.truck_finish_named(rows, dims["truck_info"], dims["truck_model"], organ, region)
    by_org = {"dws_trade_org_order_day": dws.org_order_named,
              "dws_trans_org_receive_day": dws.org_receive_named,
              "dws_trans_org_deliver_suc_day": dws.org_deliver_suc_named,
              "dws_bound_org_sort_day": dws.org_sort_named}
    return by_org[name](rows, organ, region) if name in by_org else rows


def read(spark: SparkSession, root: str, name: str, dims: dict[str, DataFrame]) -> DataFrame | None:
    """A daily aggregate as it stands; None where its stream has written nothing."""
    rows = upsert_store.read(spark, store(root, name))
    return None if rows is None else named(name, rows, dims)
