"""Clean / quarantine classes of captured records."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelstream.operators import ods

RAW = [
    (0, 1, '{"op":"c","ts_ms":10,"after":{"id":"a"},"source":{"table":"order_info"},"transaction":{"x":1}}'),
    (0, 2, "not json at all"),
    (0, 3, ""),
    (0, 4, None),
    (0, 5, '{"op":"u","ts_ms":11,"after":7,"source":{"table":"order_info"}}'),
    (0, 6, '{"op":"u","ts_ms":12,"after":null,"source":{"table":"order_info"}}'),
    (0, 7, '{"op":"d","ts_ms":13,"before":{"id":"b"},"source":{"table":"order_info"}}'),
    (0, 8, '{"ts_ms":14,"after":{"id":"c"},"source":{"table":"user_info"}}'),
    (0, 9, '{"op":"u","ts_ms":15,"after":{"name":"no id"},"source":{"table":"user_info"}}'),
]


def _raw(spark):
    return spark.createDataFrame(RAW, "part int, offset long, value string")


def test_quarantine_reasons(spark):
    q = {r["offset"]: r["reason"] for r in ods.quarantine(_raw(spark)).collect()}
    assert q == {2: "malformed", 3: "malformed", 4: "tombstone", 5: "malformed",
                 6: "no_after", 7: "delete", 9: "no_key"}


def test_clean_renames_lifts_and_keeps_null_op(spark):
    c = ods.clean(_raw(spark))
    assert c.columns == ["part", "offset", "op", "ts", "table", "before", "after"]
    rows = {r["offset"]: r for r in c.select("offset", "op", "ts", "table",
                                             ods.record_id(c).alias("id")).collect()}
    assert set(rows) == {1, 8}                         # 9 has no after.id: quarantined
    assert rows[1]["ts"] == 10 and rows[1]["table"] == "order_info" and rows[1]["id"] == "a"
    assert rows[8]["op"] is None                      # a null op passes the clean step


def test_table_group_and_unknown_option(spark):
    import pytest
    c = ods.clean(_raw(spark))
    assert {r[0] for r in ods.table_group(c, "dwd").select("table").collect()} == {"order_info"}
    with pytest.raises(ValueError):
        ods.table_group(c, "nope")


def test_sink_record_keyed_by_after_id(spark):
    rec = ods.sink_record(ods.clean(_raw(spark))).filter(F.col("key") == "a").first()
    assert '"ts":10' in rec["value"] and '"table":"order_info"' in rec["value"]
    assert "ts_ms" not in rec["value"]


def test_startup_modes(spark):
    import pytest
    from parcelstream.plans.catalog import startup
    df = spark.createDataFrame([("r",), ("c",), ("u",), (None,)], "op string")
    assert startup(df, "initial").count() == 4
    assert sorted(str(r[0]) for r in startup(df, "latest").collect()) == ["None", "c", "u"]
    with pytest.raises(ValueError):
        startup(df, "earliest")


def test_dwd_rows_without_order_id_are_quarantined(spark):
    from parcelstream.streaming.order_state import order_log_from_ods, order_log_rejects
    big = (1 << 48) + 5
    recs = spark.createDataFrame([
        ("1", '{"op":"c","ts":5,"after":{"id":"c1","order_id":"9"},"source":{"table":"order_cargo"}}', 70000, -big),
        ("2", '{"op":"c","ts":6,"after":{"id":"c2"},"source":{"table":"order_cargo"}}', 0, 2),
        ("3", '{"op":"c","ts":6,"after":{"id":"o"},"source":{"table":"order_info"}}', 1, 2**63 - 1),
    ], "key string, value string, part int, offset long")
    rows = ods.parse_ods_records(recs)
    got = sorted((r["order_key"], r["part"], r["seq"]) for r in order_log_from_ods(rows).collect())
    assert got == [("9", 70000, -big), ("o", 1, 2**63 - 1)]
    out = [(r["part"], r["offset"], r["reason"], r["table"]) for r in order_log_rejects(rows).collect()]
    assert out == [(0, 2, "no_order_id", "order_cargo")]
    assert len(got) + len(out) == rows.count()


def test_transit_facts_from_captured_json(spark):
    """Bound and transport changes through JSON, cleaning and typed decode are
    the facts of the typed images."""
    from conftest import SF_SMALL
    from parcelstream.operators import transit
    from parcelstream.sources import changelog
    from parcelstream.sources import transit as source
    clean = ods.clean(changelog.transit_records(spark, SF_SMALL))
    facts = transit.facts_of(clean)
    bound, task = source.bound_changelog(spark, SF_SMALL), source.task_changelog(spark, SF_SMALL)
    want = {"dwd_bound_inbound": transit.bound_inbound(bound), "dwd_bound_sort": transit.bound_sort(bound),
            "dwd_bound_outbound": transit.bound_outbound(bound), "dwd_trans_finish": transit.trans_finish(task)}
    for name, rows in want.items():
        assert rows.count() > 0
        assert facts[name].exceptAll(rows).count() == 0 and rows.exceptAll(facts[name]).count() == 0


def test_group_pruning_reads_own_tables_only(spark, scratch):
    clean = ods.clean(_raw(spark))
    ods.sink_record(clean, with_position=True, with_table=True).write.partitionBy("table").parquet(scratch + "/o")
    rows = ods.parse_ods_records(spark.read.parquet(scratch + "/o"), "dwd")
    assert {r["table"] for r in rows.select("table").collect()} == {"order_info"}
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [table" in plan


def test_numbers_keep_their_text(spark):
    """Exact numbers: digits stay as captured, strings that look like numbers and
    malformed records stay what they are, typed decoding reads the same values."""
    from parcelstream.operators import config_dim, dim_store
    from parcelstream.sources import config as config_src
    image = ('"after": {"id": 7, "truck_model_id": 1.50, "a": 12345678901234567.89, "b": -0.10, "c": 1e3, '
             '"d": "x\\" 1.50: 2, \\\\", "e": true, "f": null, "g": "5"}')
    values = [f'{{"op" : "r","ts_ms": 17,{image},"source":{{"table":"truck_info"}}}}', "text 12 -3", "12", "",
              None, '{"op":"u","ts_ms":1,"after":5.0,"source":{"table":"t"}}',
              '{"op":"r","ts_ms":"x","after":{"id":1},"source":{"table":"t"}}']
    raw = spark.createDataFrame([(0, i, v) for i, v in enumerate(values)],
                                "part int, offset long, value string")
    got = ods.clean(raw, exact_numbers=True)
    rows = got.select("offset", "ts", config_dim.row_map(F.col("after")).alias("m")).collect()
    assert [(r.offset, r.ts) for r in rows] == [(0, 17), (6, None)]
    assert rows[0].m == {"id": "7", "truck_model_id": "1.50", "a": "12345678901234567.89", "b": "-0.10",
                         "c": "1e3", "d": 'x" 1.50: 2, \\', "e": "true", "f": None, "g": "5"}
    typed = ods.decode(F.col("after"), T.StructType.fromDDL("id int, a decimal(19,2), b double, c double"))
    for exact in (False, True):
        one = ods.clean(raw, exact_numbers=exact).filter("offset = 0").select(typed.alias("t")).first().t
        assert (one.id, str(one.a), one.b, one.c) == (7, "12345678901234567.89", -0.1, 1000.0)
    versions = config_dim.config_versions(
        spark, config_dim.preload(config_src.config_table(spark)), config_src.config_changelog(spark))
    cells = dim_store.cells(config_dim.routed_rows(got, versions)).collect()
    assert [(c.sink_table, c.row_key, c.column, c.value) for c in cells] == [
        ("dim_truck_info", "7", "truck_model_id", "1.50")]


def test_long_texts_and_many_numbers_keep_their_text(spark):
    long = "9.90 " * 20_000
    value = ('{"op":"r","ts_ms":1,"after":{"id":"' + long + '",' + ",".join(
        f'"n{i}":{i}.10' for i in range(3000)) + '},"source":{"table":"t"}}')
    raw = spark.createDataFrame([(0, 0, value)], "part int, offset long, value string")
    from parcelstream.operators import config_dim
    m = ods.clean(raw, exact_numbers=True).select(config_dim.row_map(F.col("after")).alias("m")).first().m
    assert m["id"] == long and all(m[f"n{i}"] == f"{i}.10" for i in range(3000))
