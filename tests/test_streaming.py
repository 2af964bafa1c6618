"""Batch/stream parity and replay for the streaming jobs."""

from pyspark.sql import functions as F

from parcelstream.operators import config_dim, dim_store, ods, orders
from parcelstream.sources import changelog, domain
from parcelstream.sources import config as config_src
from parcelstream.streaming import jobs, order_state

from conftest import SF_SMALL

DAY = 24 * 3600 * 1000


def _slices(df, col, n, path):
    """Write ``n`` consecutive time slices, one file each, so that a stream
    reading one file per trigger sees the rows in time order."""
    lo, hi = df.agg(F.min(col), F.max(col)).first()
    step = (hi - lo) // n + 1
    for i in range(n):
        df.filter((F.col(col) >= lo + i * step) & (F.col(col) < lo + (i + 1) * step)) \
            .coalesce(1).write.mode("overwrite").parquet(f"{path}/slice{i:02d}")


def test_order_state_stream_equals_batch(spark, scratch):
    log = domain.order_change_log(spark, SF_SMALL)
    _slices(log, "ts_ms", 3, f"{scratch}/src")
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1) \
        .parquet(f"{scratch}/src/slice*")
    q = jobs.dwd_query(stream, f"{scratch}/ckpt", "dwd_parity", DAY, watermark="0 seconds")
    q.processAllAvailable()
    q.stop()
    out = spark.table("dwd_parity")
    sm = orders.order_state_machine(log, DAY)
    pairs = [(orders.place_order_from_state(sm),
              order_state.facts_from_output(out, "dwd_trade_order_detail"))]
    pairs += [(orders.transition_facts(sm, f), order_state.facts_from_output(out, f))
              for f in orders.FACT_TIME]
    for b, s in pairs:
        assert b.exceptAll(s).count() == 0 and s.exceptAll(b).count() == 0
    quarantined = out.filter(F.col("route").isin("no_detail", "no_before_status")).count()
    q = orders.orders_without_detail(sm)
    assert quarantined == q.filter(F.col("reason") != "expired_without_cargo").count()
    # every order the stream expired without cargo is one the batch also lists
    s_exp = out.filter(F.col("route") == "expired_without_cargo").select("seq")
    b_exp = q.filter(F.col("reason") == "expired_without_cargo").select("seq")
    assert s_exp.exceptAll(b_exp).count() == 0 and s_exp.count() > 0


def test_ods_stream_equals_batch_and_replay_writes_nothing_twice(spark, scratch):
    raw = changelog.captured_log(spark, SF_SMALL)
    raw.repartition(4).write.parquet(f"{scratch}/raw")
    s = jobs.StreamSettings(source_format="parquet", source_path=f"{scratch}/raw",
                            max_files_per_trigger=2)
    for _ in range(2):   # second start replays from the checkpoint: no new output
        q = jobs.ods_query(spark, s, f"{scratch}/out", f"{scratch}/ckpt", available_now=True)
        q.awaitTermination(300)
    got = spark.read.parquet(f"{scratch}/out")
    want = ods.sink_record(ods.clean(raw), with_position=True, with_table=True)
    assert got.count() == want.count()
    assert got.select(want.columns).exceptAll(want).count() == 0
    # what isn't forwarded is in the quarantine, by the same reasons
    q = jobs.ods_quarantine_query(spark, s, f"{scratch}/bad", f"{scratch}/ckpt_bad",
                                  available_now=True)
    q.awaitTermination(300)
    bad, known = spark.read.parquet(f"{scratch}/bad"), ods.quarantine(raw)
    assert bad.exceptAll(known).count() == 0 and known.exceptAll(bad).count() == 0
    assert got.count() + bad.count() == raw.count()


def test_dim_foreach_batch_store_equals_batch_merge(spark, scratch):
    raw = changelog.dim_records(spark, SF_SMALL)
    raw.write.parquet(f"{scratch}/raw")
    stream = ods.clean(spark.readStream.schema(jobs.RAW_DDL).option("maxFilesPerTrigger", 1)
                       .parquet(f"{scratch}/raw"))
    q = jobs.dim_query(spark, stream, f"{scratch}/store", f"{scratch}/ckpt",
                       lambda: config_src.config_table(spark),
                       lambda: config_src.config_changelog(spark), available_now=True)
    q.awaitTermination(600)
    versions = config_dim.config_versions(
        spark, config_dim.preload(config_src.config_table(spark)),
        config_src.config_changelog(spark))
    want = dim_store.merge(dim_store.cells(config_dim.routed_rows(
        ods.table_group(ods.clean(raw), "realtime_dim"), versions)))
    for t in ("dim_user_info", "dim_base_organ", "dim_truck_info"):
        got = dim_store.read_current(spark, f"{scratch}/store", t)
        exp = want.filter(F.col("sink_table") == t)
        cols = ["sink_table", "row_key", "column", "value"]
        assert got.select(cols).exceptAll(exp.select(cols)).count() == 0
        assert exp.select(cols).exceptAll(got.select(cols)).count() == 0


def test_fact_split_writer_and_daily_stream_aggregate(spark, scratch):
    from parcelstream.operators import dws
    log = domain.order_change_log(spark, SF_SMALL)
    _slices(log, "ts_ms", 2, f"{scratch}/src")
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1) \
        .parquet(f"{scratch}/src/slice*")
    q = jobs.dwd_facts_query(stream, f"{scratch}/facts", f"{scratch}/ckpt", DAY,
                             watermark="0 seconds")
    q.awaitTermination(600)
    sm = orders.order_state_machine(log, DAY)
    fact = "dwd_trans_dispatch_detail"
    got = spark.read.parquet(f"{scratch}/facts/{fact}").drop("batch")
    want = orders.transition_facts(sm, fact)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0

    # day windows over the fact stream equal the batch aggregate (update mode:
    # the last update per window is final)
    fstream = spark.readStream.schema(got.schema).parquet(f"{scratch}/facts/{fact}")
    agg = dws.stream_orders_per_day(fstream, "dispatch_order_count_base", watermark="2 days")
    sq = (agg.writeStream.format("memory").queryName("dispatch_days").outputMode("update")
          .option("checkpointLocation", f"{scratch}/ckpt_days").start())
    sq.processAllAvailable()
    sq.stop()
    rows = spark.table("dispatch_days").collect()
    final = {}
    for r in rows:
        final[r["cur_date"]] = max(final.get(r["cur_date"], 0), r["dispatch_order_count_base"])
    batch = {r["cur_date"]: r["dispatch_order_count_base"]
             for r in dws.orders_per_day(want, "dispatch_order_count_base").collect()}
    assert final == batch


def test_two_consumers_read_the_same_source_independently(spark, scratch):
    raw = changelog.dim_records(spark, SF_SMALL)
    raw.write.parquet(f"{scratch}/raw")
    s = jobs.StreamSettings(source_format="parquet", source_path=f"{scratch}/raw")
    outs = []
    for name in ("dim_app_group", "dwd_app_group"):      # own checkpoint = own offsets
        q = jobs.ods_query(spark, s, f"{scratch}/{name}/out", f"{scratch}/{name}/ckpt",
                           available_now=True)
        q.awaitTermination(300)
        outs.append(spark.read.parquet(f"{scratch}/{name}/out"))
    assert outs[0].count() == outs[1].count() == ods.clean(raw).count()


def test_end_to_end_ods_then_dwd_stream(spark, scratch):
    """Captured order records -> ODS stream -> DWD stream reading the ODS
    output -> facts equal the batch state machine."""
    log = domain.order_change_log(spark, SF_SMALL)
    changelog.event_records(spark, SF_SMALL, log).repartition(3).write.parquet(f"{scratch}/raw")
    s = jobs.StreamSettings(source_format="parquet", source_path=f"{scratch}/raw")
    q = jobs.ods_query(spark, s, f"{scratch}/ods", f"{scratch}/ckpt_ods", available_now=True)
    q.awaitTermination(300)
    ods_stream = spark.readStream.schema(spark.read.parquet(f"{scratch}/ods").schema) \
        .parquet(f"{scratch}/ods")
    order_log = order_state.order_log_from_ods(ods.parse_ods_records(ods_stream))
    out = order_state.apply_state(order_state.stream_input(order_log), DAY, "0 seconds")
    sq = (out.writeStream.format("memory").queryName("e2e_out").outputMode("append")
          .option("checkpointLocation", f"{scratch}/ckpt_dwd").start())
    sq.processAllAvailable()
    sq.stop()
    got = spark.table("e2e_out")
    sm = orders.order_state_machine(log, DAY)
    for fact in orders.FACT_TIME:
        b, s_ = orders.transition_facts(sm, fact), order_state.facts_from_output(got, fact)
        assert b.exceptAll(s_).count() == 0 and s_.exceptAll(b).count() == 0, fact
    b = orders.place_order_from_state(sm)
    s_ = order_state.facts_from_output(got, "dwd_trade_order_detail")
    assert b.exceptAll(s_).count() == 0 and s_.exceptAll(b).count() == 0


def _config_args(spark, scratch):
    config_src.config_table(spark).write.parquet(f"{scratch}/config")
    config_src.config_records(spark).write.parquet(f"{scratch}/config_changes")
    return ["--config", f"{scratch}/config", "--config-changes", f"{scratch}/config_changes"]


def test_apps_ods_then_dim(spark, scratch):
    from parcelstream import apps
    changelog.dim_records(spark, SF_SMALL).write.parquet(f"{scratch}/raw")
    apps.main(["ods", "--source", f"{scratch}/raw", "--sink", f"{scratch}/ods",
               "--checkpoint", f"{scratch}/ck1", "--available-now"])
    apps.main(["dim", "--source", f"{scratch}/ods", "--sink", f"{scratch}/store",
               "--checkpoint", f"{scratch}/ck2", "--available-now", *_config_args(spark, scratch)])
    got = dim_store.read_current(spark, f"{scratch}/store", "dim_truck_model")
    assert got.count() == spark.read.parquet(f"{SF_SMALL}/part.parquet") \
        .select("p_brand").distinct().count()


def test_apps_full_pipeline_to_daily_aggregates(spark, scratch):
    """captured records -> ods -> dim + dwd -> dws; the cargo-type aggregate
    equals the batch aggregate over the same facts."""
    from parcelstream import apps
    from parcelstream.operators import dws
    from parcelstream.sources import dims
    changelog.captured_log(spark, SF_SMALL).unionByName(
        changelog.transit_records(spark, SF_SMALL)).write.parquet(f"{scratch}/raw")
    apps.main(["ods", "--source", f"{scratch}/raw", "--sink", f"{scratch}/ods",
               "--checkpoint", f"{scratch}/c1", "--available-now"])
    apps.main(["dim", "--source", f"{scratch}/ods", "--sink", f"{scratch}/store",
               "--checkpoint", f"{scratch}/c2", "--available-now", *_config_args(spark, scratch)])
    apps.main(["transit", "--source", f"{scratch}/ods", "--sink", f"{scratch}/facts",
               "--checkpoint", f"{scratch}/c4", "--available-now"])
    apps.main(["dwd", "--source", f"{scratch}/ods", "--sink", f"{scratch}/facts",
               "--checkpoint", f"{scratch}/c3", "--available-now", "--window-ms", str(DAY),
               "--watermark", "0 seconds", "--event-time"])
    apps.main(["dws", "--source", f"{scratch}/facts", "--dims", f"{scratch}/store",
               "--sink", f"{scratch}/dws"])
    got = spark.read.parquet(f"{scratch}/dws/dws_trade_cargo_type_order_day")
    place = spark.read.parquet(f"{scratch}/facts/dwd_trade_order_detail").drop("batch")
    want = dws.cargo_type_order_day(place, dims.base_dic(spark, SF_SMALL))
    assert got.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    from parcelstream.sources import transit as transit_src
    from parcelstream.operators import transit
    want = dws.org_sort_day(transit.bound_sort(transit_src.bound_changelog(spark, SF_SMALL)),
                            dims.base_organ(spark, SF_SMALL), dims.base_region_info(spark, SF_SMALL))
    got = spark.read.parquet(f"{scratch}/dws/dws_bound_org_sort_day")
    assert got.count() > 0 and got.exceptAll(want).count() == 0
    assert spark.read.parquet(f"{scratch}/dws/dws_trans_org_truck_model_finish_day").count() > 0


def test_apps_dws_on_an_empty_store_writes_nothing(spark, scratch):
    from parcelstream import apps
    assert apps.run_dws(spark, f"{scratch}/facts", f"{scratch}/store", f"{scratch}/out") == []


def test_apps_reject_settings_that_lose_rows_or_never_end():
    import pytest
    from parcelstream import apps
    base = ["dwd", "--source", "x", "--sink", "y", "--checkpoint", "z"]
    for bad in (["--event-time"], ["--available-now"]):
        with pytest.raises(SystemExit):
            apps.main(base + bad)
    with pytest.raises(SystemExit):
        apps.main(["dim", "--source", "x", "--sink", "y", "--checkpoint", "z"])


def test_topic_records_are_a_legal_stream(spark, scratch):
    """The plan of the topic branch, run on a file stream into memory."""
    changelog.dim_records(spark, SF_SMALL).write.parquet(f"{scratch}/raw")
    s = jobs.StreamSettings(source_path=f"{scratch}/raw", start_mode="initial")
    assert (s.clean_topic, s.starting_offsets) == ("ods_changes_clean", "earliest")
    records = jobs.ods_records(ods.clean(jobs.read_raw(spark, s)), for_topic=True)
    q = (records.writeStream.format("memory").queryName("topic_records")
         .option("checkpointLocation", f"{scratch}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination(200)
    assert spark.table("topic_records").count() == ods.clean(spark.read.parquet(f"{scratch}/raw")).count()


def test_idle_batches_write_no_folders(spark, scratch):
    import os
    empty = spark.createDataFrame([], order_state.OUTPUT_DDL)
    write = jobs.dwd_facts_writer(f"{scratch}/facts")
    for i in range(3):
        write(empty, i)
    assert not os.path.exists(f"{scratch}/facts")


def test_event_time_needs_a_watermark(spark):
    import pytest
    log = spark.createDataFrame([], LOG_SCHEMA)
    with pytest.raises(ValueError):
        order_state.apply_state(order_state.stream_input(log))


def test_stream_org_receive_day_equals_batch(spark, scratch):
    from parcelstream.operators import dws
    from parcelstream.sources import dims
    log = domain.order_change_log(spark, SF_SMALL)
    facts = orders.transition_facts(orders.order_state_machine(log, DAY),
                                    "dwd_trans_receive_detail")
    _slices(facts, "ts", 3, f"{scratch}/facts")
    organ, region = dims.base_organ(spark, SF_SMALL), dims.base_region_info(spark, SF_SMALL)
    stream = spark.readStream.schema(facts.schema).option("maxFilesPerTrigger", 1) \
        .parquet(f"{scratch}/facts/slice*")
    agg = dws.stream_org_receive_day(stream, organ, region, watermark="2 days")
    q = (agg.writeStream.format("memory").queryName("receive_days").outputMode("update")
         .option("checkpointLocation", f"{scratch}/ckpt").start())
    q.processAllAvailable()
    q.stop()
    final = {}
    for r in spark.table("receive_days").collect():
        k = (r["cur_date"], r["org_id"])
        final[k] = max(final.get(k, 0), r["receive_order_count_base"])
    batch = {(r["cur_date"], r["org_id"]): r["receive_order_count_base"]
             for r in dws.org_receive_day(facts, organ, region).collect()}
    assert final == batch and batch


def _random_log(rnd, n_keys=4, n_events=40):
    """Random per-order histories: creates, cargo rows and status updates
    whose previous status is the order's last status (first update: none)."""
    from parcelstream import schemas
    rows, last = [], {}
    for seq in range(1, n_events + 1):
        key = rnd.randint(1, n_keys)
        ts = 1_700_000_000_000 + rnd.randint(0, 50_000)      # a realistic epoch
        kind = rnd.choice(["order_c", "cargo", "update", "update"])
        if kind == "cargo":
            img = {f.name: None for f in schemas.ORDER_CARGO.fields}
            img.update(id=f"c{seq}", order_id=str(key), create_time="2024-01-01T00:00:00Z")
            rows.append((seq, ts, "c", "order_cargo", key, None, None, None, img))
            continue
        status = rnd.choice(list(schemas.STATUS_CODES))
        img = {f.name: None for f in schemas.ORDER_INFO.fields}
        img.update(id=str(key), status=status, sender_name="ab", receiver_name="cd",
                   update_time="2024-01-01T00:00:00Z", estimate_arrive_time=0)
        op = "c" if kind == "order_c" else "u"
        rows.append((seq, ts, op, "order_info", key, status, None, img, None))
    # previous status in (ts, seq) order per key
    rows.sort(key=lambda r: (r[1], r[0]))
    out = []
    for r in rows:
        before = last.get(r[4]) if r[3] == "order_info" else None
        if r[3] == "order_info":
            last[r[4]] = r[5]
        out.append(r[:6] + (before if r[2] == "u" else None,) + r[7:])
    return out


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402
from test_state_machine import LOG_SCHEMA  # noqa: E402


@settings(max_examples=3, deadline=None)
@given(st.randoms(use_true_random=False), st.integers(min_value=1, max_value=4))
def test_property_stream_equals_batch_on_random_histories(spark, tmp_path_factory, rnd, parts):
    scratch = str(tmp_path_factory.mktemp("prop"))
    log = spark.createDataFrame(_random_log(rnd), LOG_SCHEMA)
    _slices(log, "ts_ms", parts, f"{scratch}/src")
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1) \
        .parquet(f"{scratch}/src/slice*")
    name = f"prop_{abs(hash(scratch)) % 10**8}"
    q = jobs.dwd_query(stream, f"{scratch}/ckpt", name, 5000, watermark="0 seconds")
    q.processAllAvailable()
    q.stop()
    out = spark.table(name)
    sm = orders.order_state_machine(log, 5000)
    pairs = [(orders.place_order_from_state(sm),
              order_state.facts_from_output(out, "dwd_trade_order_detail"))]
    pairs += [(orders.transition_facts(sm, f), order_state.facts_from_output(out, f))
              for f in orders.FACT_TIME]
    for b, s in pairs:
        assert b.exceptAll(s).count() == 0 and s.exceptAll(b).count() == 0
    q_b = orders.orders_without_detail(sm).filter(F.col("reason") != "expired_without_cargo")
    assert out.filter(F.col("route").isin("no_detail", "no_before_status")).count() == q_b.count()


def test_processing_time_mode_routes_transitions_like_batch(spark, scratch):
    """Arrival-time windows change only place-order matching; the routed
    transitions and their details are the same as in the batch rules."""
    log = domain.order_change_log(spark, SF_SMALL)
    _slices(log, "ts_ms", 2, f"{scratch}/src")
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1) \
        .parquet(f"{scratch}/src/slice*")
    q = jobs.dwd_query(stream, f"{scratch}/ckpt", "dwd_proc_time", DAY,
                       time_mode="ProcessingTime")
    # processing-time timers keep the query busy, so wait (bounded) until
    # every input row was consumed instead of processAllAvailable()
    import time
    want, deadline = log.count(), time.time() + 180
    while time.time() < deadline:
        if sum(p["numInputRows"] for p in q.recentProgress) >= want:
            break
        time.sleep(1)
    time.sleep(2)
    q.stop()
    out = spark.table("dwd_proc_time")
    sm = orders.order_state_machine(log, DAY)
    for fact in orders.FACT_TIME:
        b, s = orders.transition_facts(sm, fact), order_state.facts_from_output(out, fact)
        assert b.exceptAll(s).count() == 0 and s.exceptAll(b).count() == 0, fact
    assert out.filter(F.col("route") == "dwd_trade_order_detail").count() > 0
