"""Logs are passed over once, records are judged by one look into their image, and
finished transports get their model before they are counted."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from parcelstream.operators import dws, ods
from parcelstream.plans import materialize
from test_logs_read_once import plan_text, tiny  # noqa: F401


def test_snapshot_and_changes_come_from_one_pass(spark, tiny):  # noqa: F811
    materialize.forget()
    df = E.queries()["cdc_initial_snapshot_union"](spark, tiny)
    assert plan_text(df).count("from_json(") == plan_text(E.queries()["ods_clean"](spark, tiny)).count("from_json(")
    got = {(r["table"], r.op): r.n for r in df.collect()}
    assert got[("user_info", "r")] == 4 and got[("user_info", "u")] == 3 and got[("user_info", "d")] == 2
    assert not {t for t, _ in got} & {"order_info", "order_cargo"}


def test_orders_are_never_broadcast(spark, tiny):  # noqa: F811
    """The join of tasks with orders is the same at every size."""
    plan = plan_text(E.queries()["dwd_trans_finish"](spark, tiny))
    assert plan.count("SortMergeJoin") == 1 and "BroadcastHashJoin" not in plan


@pytest.mark.parametrize("mode, ops", [("initial", ["None", "c", "r"]), ("latest", ["None", "c"])])
def test_startup_keeps_a_null_op(spark, mode, ops):
    from parcelstream.plans.catalog import startup
    df = spark.createDataFrame([("r",), ("c",), (None,)], "op string")
    assert sorted(str(r.op) for r in startup(df, mode).collect()) == ops


def test_forwarded_is_no_reason(spark):
    """Whatever the parts of a record are, it is forwarded if it has no reason not to be."""
    images = ["null", "7", '"x"', "[1]", '[{"id":"1"}]', "{}", '{"id":null}', '{"id":"1"}', '{"id":1.50}',
              '{"id":{"id":"1"}}', '{"id":[1]}', '{"id":true}', "{"]
    values = [f'{{{op}"ts_ms":1,"after":{image}{source}}}' for image in images
              for op in ("", '"op":null,', '"op":"d",', '"op":"u",', '"op":7,')
              for source in ("", ',"source":null', ',"source":{"table":null}', ',"source":{"table":"t"}')]
    values += [None, "", "text", "7", "null", "[]", '{"op":"u","source":{"table":"t"}}']
    raw = spark.createDataFrame([(0, i, v) for i, v in enumerate(values)], "part int, offset long, value string")
    for exact in (False, True):
        p = ods.parse(raw, exact_numbers=exact)
        both = p.select((ods.reason().isNull()).alias("none"), ods.forwarded().alias("sent")).collect()
        assert [bool(r.sent) for r in both] == [r.none for r in both] and {r.none for r in both} == {True, False}
    clean = ods.clean(raw).select("offset")
    condition = [x for x in plan_text(clean).splitlines() if "Filter" in x]
    assert len(condition) == 1 and condition[0].count("try_variant_get") == 1


def test_transports_are_not_counted_per_truck(spark):
    """One count per model and day, with what the count per truck and its lookup gave;
    trucks that repeat, lack a model or are unknown included."""
    day = 1_700_000_000_000
    facts = spark.createDataFrame(
        [(org, truck, None if i % 7 == 0 else i, i, day + i * 3_600_000)
         for i, (org, truck) in enumerate((o, t) for o in ("s1", "c1", None) for t in ("t1", "t2", "t3", "x", None)
                                          for _ in range(3))],
        "start_org_id string, truck_id string, d int, transport_time long, ts long").select(
            "*", F.col("d").cast("decimal(16,2)").alias("actual_distance"))
    trucks = spark.createDataFrame([("t1", "m1"), ("t2", "m1"), ("t2", "m2"), ("t3", None), (None, "m1")],
                                   "id string, truck_model_id string")
    models = spark.createDataFrame([("m1", "one"), ("m2", "two")], "id string, model_name string")
    organ = spark.createDataFrame([("c1", "Centre", None, "d1"), ("s1", "Station", "c1", "d1")],
                                  "id string, org_name string, org_parent_id string, region_id string")
    region = spark.createDataFrame([("d1", "City", "p1")], "id string, name string, parent_id string")
    got = dws.org_truck_model_finish_day(facts, trucks, models, organ, region)
    want = dws.truck_finish_named(dws.truck_finish_grain(facts), trucks, models, organ, region)
    assert plan_text(got).count("HashAggregate(") == 2 and plan_text(want).count("HashAggregate(") == 4
    assert got.schema == want.schema
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() > 9
