"""Each daily aggregate as a stream equals its batch form on the captured log,
over restarts, replayed batches and folds."""

import pytest

from parcelstream.operators import dws, orders, transit, upsert_store
from parcelstream.sources import dims, domain
from parcelstream.sources import transit as transit_src
from parcelstream.streaming import daily

from conftest import SF_SMALL
from test_streaming import _slices

DAY = 24 * 3600 * 1000


@pytest.fixture(scope="module", autouse=True)
def few_state_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture(scope="module")
def facts(spark, tmp_path_factory):
    """Every fact table, stored as the fact streams write them: in slices of time."""
    root = str(tmp_path_factory.mktemp("facts"))
    sm = orders.order_state_machine(domain.order_change_log(spark, SF_SMALL), DAY).cache()
    made = {"dwd_trade_order_detail": orders.place_order_facts(
        domain.order_info_rows(spark, SF_SMALL), domain.order_cargo_rows(spark, SF_SMALL))}
    for fact in {d.fact for d in daily.DAILY.values()} & set(orders.FACT_TIME):
        made[fact] = orders.transition_facts(sm, fact)
    made["dwd_bound_sort"] = transit.bound_sort(transit_src.bound_changelog(spark, SF_SMALL))
    made["dwd_trans_finish"] = transit.trans_finish(transit_src.task_changelog(spark, SF_SMALL))
    for name, rows in made.items():
        _slices(rows, "ts", 2, f"{root}/{name}")
    return root


@pytest.fixture(scope="module")
def found(spark):
    return {n: getattr(dims, n)(spark, SF_SMALL) for n in
            ("base_dic", "base_organ", "base_region_info", "truck_info", "truck_model")}


BATCH = {
    "dws_trade_cargo_type_order_day": lambda f, d: dws.cargo_type_order_day(f, d["base_dic"]),
    "dws_trade_org_order_day": lambda f, d: dws.org_order_day(f, d["base_organ"], d["base_region_info"]),
    "dws_trans_org_receive_day": lambda f, d: dws.org_receive_day(f, d["base_organ"], d["base_region_info"]),
    "dws_trans_dispatch_day": lambda f, d: dws.orders_per_day(f, "dispatch_order_count_base"),
    "dws_trans_bound_finish_day": lambda f, d: dws.orders_per_day(f, "bound_finish_order_count_base"),
    "dws_trans_org_deliver_suc_day":
        lambda f, d: dws.org_deliver_suc_day(f, d["base_organ"], d["base_region_info"]),
    "dws_bound_org_sort_day": lambda f, d: dws.org_sort_day(f, d["base_organ"], d["base_region_info"]),
    "dws_trans_org_truck_model_finish_day": lambda f, d: dws.org_truck_model_finish_day(
        f, d["truck_info"], d["truck_model"], d["base_organ"], d["base_region_info"]),
}


def fact_stream(spark, facts, name, files=1):
    path = f"{facts}/{daily.DAILY[name].fact}"
    schema = spark.read.parquet(f"{path}/slice*").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(f"{path}/slice*")


def same(a, b):
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("name", sorted(daily.DAILY))
def test_stream_equals_batch(spark, scratch, facts, found, name):
    q = daily.query(fact_stream(spark, facts, name), scratch, name, f"{scratch}/ckpt", "400 days",
                    available_now=True, fold_every=1)
    q.awaitTermination(400)
    want = BATCH[name](spark.read.parquet(f"{facts}/{daily.DAILY[name].fact}/slice*"), found)
    assert want.count() > 0
    same(daily.read(spark, scratch, name, found), want)
    assert upsert_store.manifest(spark, daily.store(scratch, name)).version >= 1   # was folded on the way


def test_replayed_batches_change_nothing(spark, scratch, facts, found):
    """A batch written again, and facts that a replayed batch writes anew."""
    name = "dws_trade_org_order_day"
    seen = []
    write = daily.writer(scratch, name)

    def twice(batch, batch_id):
        batch.persist()
        write(batch, batch_id)
        write(batch, batch_id)
        seen.append(batch_id)
        batch.unpersist()

    stream = fact_stream(spark, facts, name)
    again = spark.readStream.schema(stream.schema).parquet(f"{facts}/{daily.DAILY[name].fact}/slice00")
    q = (daily.totals(stream.unionByName(again), daily.DAILY[name], "400 days").writeStream
         .outputMode("update").option("checkpointLocation", f"{scratch}/ckpt")
         .trigger(availableNow=True).foreachBatch(twice).start())
    q.awaitTermination(400)
    assert len(seen) >= 2
    same(daily.read(spark, scratch, name, found),
         BATCH[name](spark.read.parquet(f"{facts}/{daily.DAILY[name].fact}/slice*"), found))


def test_restart_goes_on_from_its_state(spark, scratch, facts, found, tmp_path_factory):
    name = "dws_trade_cargo_type_order_day"
    source = f"{facts}/{daily.DAILY[name].fact}"
    schema = spark.read.parquet(f"{source}/slice*").schema
    inbox = str(tmp_path_factory.mktemp("inbox"))
    for i in range(2):
        spark.read.parquet(f"{source}/slice{i:02d}").write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(schema).parquet(inbox)
        q = daily.query(stream, scratch, name, f"{scratch}/ckpt", "400 days", available_now=True)
        q.awaitTermination(400)
    same(daily.read(spark, scratch, name, found),
         BATCH[name](spark.read.parquet(f"{source}/slice*"), found))


def test_one_row_a_grain_and_nothing_before_the_first_batch(spark, scratch, found):
    name = "dws_bound_org_sort_day"
    assert daily.read(spark, scratch, name, found) is None
    rows = lambda n: spark.createDataFrame(
        [("2024-01-01", "C1", n, 5), ("2024-01-02", "C1", 1, 6)],
        "cur_date string, org_id string, sort_count_base long, ts long")
    write = daily.writer(scratch, name)
    for batch, n in ((0, 3), (1, 7)):
        write(rows(n), batch)
    got = {r.cur_date: r.sort_count_base for r in daily.read(spark, scratch, name, found).collect()}
    assert got == {"2024-01-01": 7, "2024-01-02": 1}


def test_app_streams_the_facts_of_the_other_jobs(spark, scratch, facts, found):
    """``apps daily`` over a folder of fact tables, started twice."""
    from parcelstream import apps
    name = "dws_bound_org_sort_day"
    source = f"{facts}/dwd_bound_sort"
    for i in range(2):
        spark.read.parquet(f"{source}/slice{i:02d}").write.parquet(f"{scratch}/facts/dwd_bound_sort/batch={i}")
        apps.main(["daily", "--source", f"{scratch}/facts", "--sink", f"{scratch}/out", "--checkpoint",
                   f"{scratch}/ck", "--watermark", "400 days", "--available-now", "--only", name])
    same(daily.read(spark, f"{scratch}/out", name, found),
         BATCH[name](spark.read.parquet(f"{source}/slice*"), found))
    with pytest.raises(SystemExit):
        apps.main(["daily", "--source", "x", "--sink", "y", "--checkpoint", "z"])    # no watermark
