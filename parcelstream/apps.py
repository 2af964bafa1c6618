"""Runnable jobs: ``python -m parcelstream.apps {ods,dim,dwd,transit,daily,dws} [options]``.

* ``ods`` — captured change records -> cleaned, keyed ODS records, and a quarantine.
* ``dim`` — ODS records -> configuration routing -> dimension cell store.
* ``dwd`` — ODS records -> per-order state -> one table per fact.
* ``transit`` — ODS records -> bound and transport facts, one table each.
* ``daily`` — fact tables as streams -> daily aggregates, upserted by grain.
* ``dws`` — fact tables + dimension store -> daily aggregates (batch).

Settings are one small object per pipeline (no global overrides), one
server field serves both Kafka directions, and every query has its own
checkpoint folder, so two consumers of one topic keep separate offsets.
The session comes from the cluster (``SparkSession.builder.getOrCreate``);
``configure_for_scale`` only fills settings the cluster left unset.
"""

from __future__ import annotations

import argparse

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from parcelstream.operators import config_dim, dim_store, dws, ods, transit
from parcelstream.operators.upsert_store import Files
from parcelstream.session import configure_for_scale
from parcelstream.streaming import config_state, daily, jobs, order_state

CLEAN_DDL = ("part int, offset long, op string, ts long, table string, before variant, "
             "after variant")
ODS_RECORD_DDL = "key string, value string, part int, offset long, table string"


def _settings(a) -> jobs.StreamSettings:
    return jobs.StreamSettings(
        source_format=a.source_format, source_path=a.source, kafka_servers=a.kafka_servers,
        topic=a.topic, start_mode=a.start_mode or (
            "latest" if a.source_format == "kafka" else "initial"), trigger_seconds=a.trigger_seconds,
        max_files_per_trigger=a.max_files_per_trigger, exact_numbers=a.exact_numbers)


def _ods_stream(spark: SparkSession, a, group: str) -> "DataFrame":  # noqa: F821
    """The clean records of a table group, as ``run ods`` wrote them."""
    s = _settings(a)
    if a.source_format == "kafka":
        raw = ods.once(jobs.read_raw(spark, s, s.clean_topic, with_time=True), "timestamp", a.replay_window)
        return ods.table_group(ods.parse_ods_records(raw), group)
    reader = spark.readStream.schema(ODS_RECORD_DDL).format(a.source_format)
    if s.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", s.max_files_per_trigger)
    return ods.parse_ods_records(reader.load(a.source), group)


def _dim(spark: SparkSession, store: str, sink_table: str, columns: list[str]):
    """A dimension from the store, empty where it holds nothing yet."""
    merged = dim_store.read_current(spark, store, sink_table)
    if merged is None:
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in ["id", *columns]))
    return dim_store.wide(merged, sink_table, columns)


def _facts(spark: SparkSession, root: str, name: str):
    """A fact table, or None where no row of it has been written yet."""
    try:
        return spark.read.parquet(f"{root.rstrip('/')}/{name}").drop("batch")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def fact_schema(spark: SparkSession, fact: str):
    """The columns of a fact table, whether or not it has been written yet."""
    if fact in transit.FACT_TABLE:
        clean = spark.createDataFrame([], CLEAN_DDL)
        return transit.facts_of(clean)[fact].schema
    return order_state.facts_from_output(
        spark.createDataFrame([], order_state.OUTPUT_DDL), fact).schema


def daily_queries(spark: SparkSession, a) -> list:
    """One query an aggregate; facts that no job has written yet are waited for."""
    queries = []
    for name in a.only or sorted(daily.DAILY):
        fact = daily.DAILY[name].fact
        folder = f"{a.source.rstrip('/')}/{fact}"
        Files(spark, a.source).make(fact)
        reader = spark.readStream.schema(fact_schema(spark, fact)).option("basePath", folder)
        if a.max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", a.max_files_per_trigger)
        queries.append(daily.query(reader.parquet(folder), a.sink, name, f"{a.checkpoint}/{name}",
                                   a.watermark, a.available_now, a.trigger_seconds))
    return queries


def run_dws(spark: SparkSession, facts_root: str, store_root: str, out_root: str) -> list[str]:
    """Daily aggregates from the DWD fact tables, looked up in the DIM store.
    Returns the aggregates written; one whose facts have no row yet is skipped."""
    organ = _dim(spark, store_root, "dim_base_organ", ["org_name", "org_parent_id", "region_id"])
    region = _dim(spark, store_root, "dim_base_region_info", ["name", "parent_id"])
    dic = _dim(spark, store_root, "dim_base_dic", ["name"])
    trucks = _dim(spark, store_root, "dim_truck_info", ["truck_model_id"])
    models = _dim(spark, store_root, "dim_truck_model", ["model_name"])
    plans = {
        "dws_trade_cargo_type_order_day":
            ("dwd_trade_order_detail", lambda f: dws.cargo_type_order_day(f, dic)),
        "dws_trade_org_order_day":
            ("dwd_trade_order_detail", lambda f: dws.org_order_day(f, organ, region)),
        "dws_trans_org_receive_day":
            ("dwd_trans_receive_detail", lambda f: dws.org_receive_day(f, organ, region)),
        "dws_trans_dispatch_day":
            ("dwd_trans_dispatch_detail",
             lambda f: dws.orders_per_day(f, "dispatch_order_count_base")),
        "dws_trans_bound_finish_day":
            ("dwd_trans_bound_finish_detail",
             lambda f: dws.orders_per_day(f, "bound_finish_order_count_base")),
        "dws_trans_org_deliver_suc_day":
            ("dwd_trans_deliver_detail", lambda f: dws.org_deliver_suc_day(f, organ, region)),
        "dws_bound_org_sort_day":
            ("dwd_bound_sort", lambda f: dws.org_sort_day(f, organ, region)),
        "dws_trans_org_truck_model_finish_day":
            ("dwd_trans_finish",
             lambda f: dws.org_truck_model_finish_day(f, trucks, models, organ, region)),
    }
    written = []
    for name, (fact, plan) in plans.items():
        facts = _facts(spark, facts_root, fact)
        if facts is not None:
            plan(facts).write.mode("overwrite").parquet(f"{out_root.rstrip('/')}/{name}")
            written.append(name)
    return written


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="parcelstream.apps")
    p.add_argument("job", choices=["ods", "dim", "dwd", "transit", "daily", "dws"])
    p.add_argument("--source", help="input folder (file formats)")
    p.add_argument("--source-format", default="parquet")
    p.add_argument("--kafka-servers")
    p.add_argument("--replay-window", default="1 hour",
                   help="topics: how long after a record it may be written again by a replayed batch")
    p.add_argument("--topic", default="ods_changes")
    p.add_argument("--sink", required=True, help="output folder / store root")
    p.add_argument("--dims", help="dimension store root (dws)")
    p.add_argument("--checkpoint", help="checkpoint folder (streaming jobs)")
    p.add_argument("--trigger-seconds", type=int, default=6)
    p.add_argument("--window-ms", type=int, default=5000)
    p.add_argument("--watermark",
                   help="required by daily and by dwd --event-time: the disorder to accept before "
                        "rows count as late and are dropped")
    p.add_argument("--quarantine", help="folder of rejected records (default: SINK_quarantine)")
    p.add_argument("--config", help="dim: path of the configuration table")
    p.add_argument("--config-changes", help="dim: path of its captured change log (JSON envelopes)")
    p.add_argument("--config-format", default="parquet")
    p.add_argument("--config-keep-days", type=int, default=7,
                   help="dim: how late a record may come and be routed by the configuration of its time")
    p.add_argument("--start-mode", choices=["latest", "initial", "snapshot"],
                   help="what an ods job starts with: later records alone, all records, or the rows "
                        "as they stand and then later records (default: files initial, topics latest)")
    p.add_argument("--max-files-per-trigger", type=int, default=1000,
                   help="bounds a micro-batch, the first one over a backlog too")
    p.add_argument("--event-time", action="store_true",
                   help="measure the order's waiting window in event time (replays); the "
                        "default is arrival time, like the reference, and drops nothing")
    p.add_argument("--available-now", action="store_true")
    p.add_argument("--exact-numbers", action="store_true",
                   help="ods: hand on the row images' numbers as the text they came in")
    p.add_argument("--fold-every", type=int, default=50,
                   help="dim: fold the store's older batches every so many")
    p.add_argument("--database", help="dim: create and publish the configured tables in this database")
    p.add_argument("--only", action="append", choices=sorted(daily.DAILY),
                   help="daily: this aggregate alone (may be given several times)")
    a = p.parse_args(argv)
    if a.job != "dws" and not a.checkpoint:
        p.error("--checkpoint is required for the streaming jobs")
    if a.job == "dim" and not (a.config and a.config_changes):
        p.error("dim needs --config and --config-changes")
    if a.job == "dwd" and a.event_time and not a.watermark:
        p.error("--event-time needs --watermark")
    if a.job == "daily" and not a.watermark:
        p.error("daily needs --watermark")
    if a.job == "dwd" and a.available_now and not a.event_time:
        p.error("--available-now ends only with --event-time: processing-time timers never do")
    rejected = a.quarantine or f"{a.sink.rstrip('/')}_quarantine"
    also = f"{(a.checkpoint or '').rstrip('/')}_quarantine"

    spark = SparkSession.builder.appName(f"parcelstream-{a.job}").getOrCreate()
    configure_for_scale(spark, streaming=a.job != "dws")
    if a.job == "dws":
        run_dws(spark, a.source, a.dims, a.sink)
        return
    if a.job == "ods":
        s = _settings(a)
        start = f"{a.checkpoint.rstrip('/')}_start"   # shared: both start at one place
        qs = [jobs.ods_query(spark, s, a.sink, a.checkpoint, a.available_now, start),
              jobs.ods_quarantine_query(spark, s, rejected, also, a.available_now, start)]
    elif a.job == "dim":
        qs = [jobs.dim_query(
            spark, _ods_stream(spark, a, "realtime_dim"), a.sink, a.checkpoint,
            lambda: config_dim.read_config(spark, a.config, a.config_format),
            lambda: config_state.refresh(spark, a.config_changes, f"{a.sink.rstrip('/')}/_config",
                                         a.config_format, a.config_keep_days * config_state.DAY_MS),
            available_now=a.available_now, fold_every=a.fold_every, database=a.database)]
    elif a.job == "daily":
        qs = daily_queries(spark, a)
    elif a.job == "transit":
        qs = [jobs.transit_query(_ods_stream(spark, a, "dwd"), a.sink, a.checkpoint,
                                 a.available_now, a.trigger_seconds)]
    else:
        stream = _ods_stream(spark, a, "dwd")
        out = order_state.apply_state(
            order_state.stream_input(order_state.order_log_from_ods(stream)), a.window_ms,
            a.watermark, "EventTime" if a.event_time else "ProcessingTime")
        w = out.writeStream.option("checkpointLocation", a.checkpoint).outputMode("append")
        w = w.trigger(availableNow=True) if a.available_now else \
            w.trigger(processingTime=f"{a.trigger_seconds} seconds")
        qs = [w.foreachBatch(jobs.dwd_facts_writer(a.sink)).start(),
              jobs.rejects_query(_ods_stream(spark, a, "dwd"), rejected, also, a.available_now,
                                 a.trigger_seconds)]
    for q in qs:
        q.awaitTermination()


if __name__ == "__main__":
    main()
