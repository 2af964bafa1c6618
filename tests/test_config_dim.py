"""Configuration routing, projection and cell-merge upsert."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parcelstream.operators import config_dim, dim_store, ods
from parcelstream.sources import config as config_src

T0 = config_src.SNAPSHOT_MS


def _raw(spark, rows):
    return spark.createDataFrame(rows, "part int, offset long, value string")


def _rec(off, ts, table, after, op="r"):
    import json
    return (3, off, json.dumps({"op": op, "ts_ms": ts, "after": after, "source": {"table": table}}))


def _routed(spark, rows):
    c = ods.table_group(ods.clean(_raw(spark, rows)), "realtime_dim")
    versions = config_dim.config_versions(
        spark, config_dim.preload(config_src.config_table(spark)),
        config_src.config_changelog(spark))
    return config_dim.routed_rows(c, versions)


def test_narrowed_columns_keep_old_cells_and_delete_drops(spark):
    later = config_src.CONFIG_CHANGE_MS + 1
    rows = [
        _rec(1, T0, "user_info", {"id": "7", "login_name": "a", "user_level": "L1", "region_id": "3"}),
        _rec(2, later, "user_info", {"id": "7", "login_name": "B", "user_level": "L9", "region_id": "4"}, "u"),
        _rec(3, T0, "base_dic", {"id": "x", "name": "n1"}),
        _rec(4, later, "base_dic", {"id": "x", "name": "n2"}, "u"),
        _rec(5, T0, "employee_info", {"id": "1", "emp_name": "e"}),
        _rec(6, T0, "truck_info", {"id": "t1", "truck_model_id": "m1", "extra": "z"}),
    ]
    r = _routed(spark, rows)
    merged = dim_store.merge(dim_store.cells(r))
    cells = {(m["sink_table"], m["row_key"], m["column"]): m["value"] for m in merged.collect()}
    assert cells[("dim_user_info", "7", "login_name")] == "B"
    assert cells[("dim_user_info", "7", "user_level")] == "L1"     # not in narrowed config
    assert cells[("dim_user_info", "7", "region_id")] == "4"
    assert cells[("dim_base_dic", "x", "name")] == "n1"           # later put dropped: config deleted
    assert not any(k[0] == "dim_employee_info" for k in cells)    # unconfigured table
    assert cells[("dim_truck_info", "t1", "truck_model_id")] == "m1"
    assert ("dim_truck_info", "t1", "extra") not in cells
    keys = {x["sink_table"]: x["keys"] for x in r.select(
        "sink_table", F.array_join(F.array_sort(F.map_keys("row")), ",").alias("keys")).collect()}
    assert keys["dim_truck_info"] == "id,truck_model_id"          # PK kept though not configured


def test_origin_preload_before_live_snapshot(spark):
    rows = [_rec(1, T0, "base_dic", {"id": "x", "name": "n"}),
            _rec(2, config_src.CONFIG_SNAPSHOT_MS + 1, "truck_model", {"id": "m", "model_name": "q"})]
    got = {x["table"]: x["origin"] for x in _routed(spark, rows).collect()}
    assert got == {"base_dic": "preload", "truck_model": "live"}


def test_table_plan_default_family(spark):
    plan = {(r["sink_table"], r["family"]) for r in
            config_dim.table_plan(config_src.config_changelog(spark)).collect()}
    assert ("dim_base_organ", "info") in plan and ("dim_truck_model", "info") in plan
    assert ("dim_truck_info", "ext") in plan


@settings(max_examples=5, deadline=None)
@given(st.randoms(use_true_random=False))
def test_fold_is_order_independent(spark, rnd):
    changes = config_src.config_changelog(spark).collect()
    shuffled = list(changes)
    rnd.shuffle(shuffled)
    df = spark.createDataFrame(shuffled, config_src.config_changelog(spark).schema)
    a = sorted(tuple(r) for r in config_dim.fold(df).collect())
    b = sorted(tuple(r) for r in config_dim.fold(config_src.config_changelog(spark)).collect())
    assert a == b and len(a) == 5


def test_cell_merge_latest_wins_regardless_of_input_order(spark):
    rows = [("t", "k", "c", f"v{i}", i, 0, i) for i in range(20)]
    random.Random(0).shuffle(rows)
    df = spark.createDataFrame(rows, "sink_table string, row_key string, column string, "
                                     "value string, ts long, part int, offset long")
    assert dim_store.merge(df).first()["value"] == "v19"


def test_preload_last_row_wins(spark):
    from parcelstream import schemas
    rows = [("t", "s1", "", "id", "id", None), ("u", "s2", "", "id", "id", None),
            ("t", "s3", "", "id,x", "id", None)]
    got = {r["source_table"]: r["sink_table"] for r in
           config_dim.preload(spark.createDataFrame(rows, schemas.CONFIG)).collect()}
    assert got == {"t": "s3", "u": "s2"}


def test_configuration_is_read_from_paths(spark, scratch):
    rows = [(*r, i) for i, r in enumerate(config_src.CONFIG_ROWS)]
    rows += [(*config_src.CONFIG_ROWS[3][:3], "id", "id", None, 99)]  # a later row of base_dic
    spark.createDataFrame(rows, config_dim.T.StructType(
        config_dim.schemas.CONFIG.fields + [config_dim.T.StructField("row_no", config_dim.T.LongType())])
    ).repartition(3).write.parquet(f"{scratch}/config")
    config_src.config_records(spark).repartition(2).write.parquet(f"{scratch}/changes")
    got = config_dim.preload(config_dim.read_config(spark, f"{scratch}/config"))
    assert got.count() == 6
    assert got.filter("source_table = 'base_dic'").first()["sink_columns"] == "id"
    changes = config_dim.read_config_changes(spark, f"{scratch}/changes")
    want = config_src.config_changelog(spark)
    assert changes.exceptAll(want).count() == 0 and want.exceptAll(changes).count() == 0
    folded = {r["source_table"]: r["sink_columns"] for r in config_dim.fold(changes).collect()}
    assert "base_dic" not in folded and folded["user_info"] == "id,login_name,region_id"


def test_store_errors_are_not_an_empty_store(spark, scratch):
    import pytest
    assert dim_store.read_current(spark, f"{scratch}/none", "t") is None
    spark.range(1).write.parquet(f"{scratch}/bad/_cells")
    with pytest.raises(Exception):
        dim_store.read_current(spark, f"{scratch}/bad", "t").count()
