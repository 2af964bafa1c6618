"""Start modes with records captured meanwhile, and the incremental state of the
configuration."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from parcelstream import apps
from parcelstream.operators import config_dim, ods
from parcelstream.sources import config as config_src
from parcelstream.streaming import config_state, handover, jobs

RAW = "part int, offset long, value string"


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def envelope(op, ts, key, v, table="user_info"):
    image = {"id": key, "login_name": v}
    return json.dumps({"op": op, "ts_ms": ts, "before": image if op in "ud" else None,
                       "after": None if op == "d" else image, "source": {"table": table}})


def history(rnd, n, start):
    """Records of ``n`` changes, over two partitions; a row stays in its own."""
    out = []
    for i in range(start, start + n):
        key = rnd.choice("abcdefgh")
        part = ord(key) % 2
        kind = rnd.random()
        out.append((part, i, "broken" if kind < 0.05 else envelope(
            "d" if kind < 0.2 else rnd.choice("cu"), 1000 + i // 3, key, f"v{i}",
            rnd.choice(["user_info", "base_dic"]))))
    return out


def replay(records):
    """{(table, id): value} after all records, by time and position."""
    rows = {}
    for part, offset, value in records:
        if value == "broken":
            continue
        e = json.loads(value)
        image = e["after"] or e["before"]
        key = (e["source"]["table"], image["id"])
        at = (e["ts_ms"], part, offset)
        if at > rows.get(key, ((-1,),))[0]:
            rows[key] = (at, None if e["op"] == "d" else image["login_name"])
    return {k: v for k, (_, v) in rows.items() if v is not None}


def write(spark, records, path):
    spark.createDataFrame(records, RAW).coalesce(1).write.mode("append").parquet(path)


def run(spark, scratch, mode):
    s = jobs.StreamSettings(source_path=f"{scratch}/raw", start_mode=mode)
    jobs.ods_query(spark, s, f"{scratch}/ods", f"{scratch}/ck", True, f"{scratch}/start").awaitTermination(200)
    rows = ods.parse_ods_records(spark.read.parquet(f"{scratch}/ods"))
    return rows.select("part", "offset", "op", "ts", "table", ods.record_id(rows).alias("id"),
                       ods.vget(F.col("after"), "login_name").alias("v")).collect()


@pytest.mark.parametrize("seed", [1, 2])
def test_snapshot_then_changes_loses_and_doubles_nothing(spark, scratch, monkeypatch, seed):
    rnd = random.Random(seed)
    before, during, later = history(rnd, 60, 0), history(rnd, 20, 60), history(rnd, 20, 80)
    write(spark, before, f"{scratch}/raw")
    made = handover.snapshot

    def meanwhile(log):       # records are captured while the snapshot is taken
        write(spark, during, f"{scratch}/raw")
        return made(log)

    monkeypatch.setattr(handover, "snapshot", meanwhile)
    run(spark, scratch, "snapshot")
    write(spark, later, f"{scratch}/raw")
    rows = run(spark, scratch, "snapshot")      # a restart: neither snapshot nor positions move
    monkeypatch.undo()

    snap = {(r.table, r.id): r.v for r in rows if r.op == "r"}
    assert snap == replay(before) and sum(r.op == "r" for r in rows) == len(snap)
    changes = sorted((r.part, r.offset) for r in rows if r.op != "r")
    assert changes == sorted((p, o) for p, o, v in during + later
                             if v != "broken" and json.loads(v)["op"] != "d")
    assert len({(r.part, r.offset) for r in rows}) == len(rows)
    # snapshot and changes together lead where the whole log leads
    seen = [(r.part, r.offset, envelope("c", r.ts, r.id, r.v, r.table)) for r in rows]
    gone = [r for r in during + later if r[2] != "broken" and json.loads(r[2])["op"] == "d"]
    assert replay(seen + gone) == replay(before + during + later)


def test_latest_leaves_what_is_there(spark, scratch):
    rnd = random.Random(5)
    before, later = history(rnd, 30, 0), history(rnd, 20, 30) + [(7, 0, envelope("c", 1, "new", "part"))]
    write(spark, before, f"{scratch}/raw")
    assert run_count(spark, scratch, "latest") == []
    write(spark, later, f"{scratch}/raw")
    assert run_count(spark, scratch, "latest") == sorted(
        (p, o) for p, o, v in later if v != "broken" and json.loads(v)["op"] != "d")


def run_count(spark, scratch, mode):
    s = jobs.StreamSettings(source_path=f"{scratch}/raw", start_mode=mode)
    jobs.ods_query(spark, s, f"{scratch}/ods", f"{scratch}/ck", True, f"{scratch}/start").awaitTermination(200)
    files = [f for _, _, fs in os.walk(f"{scratch}/ods") for f in fs if f.endswith(".parquet")]
    return sorted((r.part, r.offset) for r in spark.read.parquet(f"{scratch}/ods").collect()) if files else []


def test_a_crash_between_positions_and_snapshot_repeats_the_same(spark, scratch, monkeypatch):
    rnd = random.Random(9)
    before, during = history(rnd, 40, 0), history(rnd, 20, 40)
    write(spark, before, f"{scratch}/raw")
    with monkeypatch.context() as patch:
        patch.setattr(handover, "snapshot", lambda log: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            run_count(spark, scratch, "snapshot")
    write(spark, during, f"{scratch}/raw")
    run_count(spark, scratch, "snapshot")
    snap = spark.read.parquet(f"{scratch}/start/snapshot").collect()
    assert {r.offset for r in snap} <= {o for _, o, _ in before}


def test_unknown_start_mode(spark):
    with pytest.raises(ValueError):
        handover.stream(spark, None, None, "sometimes", "x")


def test_app_snapshot_mode_keeps_malformed_records_for_the_quarantine(spark, scratch):
    records = [(0, 0, envelope("c", 1, "a", "x")), (0, 1, envelope("u", 2, "a", "y")), (0, 2, "broken"),
               (0, 3, envelope("d", 3, "b", "z"))]
    write(spark, records, f"{scratch}/raw")
    apps.main(["ods", "--source", f"{scratch}/raw", "--sink", f"{scratch}/ods", "--checkpoint", f"{scratch}/ck",
               "--available-now", "--start-mode", "snapshot"])
    assert [(r.offset, r.key) for r in spark.read.parquet(f"{scratch}/ods").collect()] == [(1, "a")]
    bad = spark.read.parquet(f"{scratch}/ods_quarantine").collect()
    assert [(r.offset, r.reason) for r in bad] == [(2, "malformed")]


# ---------------------------------------------------------- configuration ---
def test_config_state_reads_new_changes_only(spark, scratch):
    rows = config_src.config_records(spark).orderBy("offset").collect()
    read = []
    apply = config_state.apply

    def counted(batch, batch_id, root, keep_ms):
        read.append(batch.count())
        apply(batch, batch_id, root, keep_ms)

    config_state.apply = counted
    try:
        for i in range(0, len(rows), 3):
            spark.createDataFrame(rows[i:i + 3], RAW).coalesce(1).write.mode("append").parquet(f"{scratch}/log")
            got = config_state.refresh(spark, f"{scratch}/log", f"{scratch}/state", keep_ms=None)
            want = config_dim.parse_config_changes(spark.createDataFrame(rows[:i + 3], RAW))
            assert got.select(want.columns).exceptAll(want).count() == 0 and got.count() == want.count()
        assert config_state.refresh(spark, f"{scratch}/log", f"{scratch}/state").count() == len(rows)
    finally:
        config_state.apply = apply
    assert read == [3] * (len(rows) // 3) + ([len(rows) % 3] if len(rows) % 3 else [])
    assert len([n for n in os.listdir(f"{scratch}/state/state") if n.startswith("batch=")]) <= 2


def test_config_state_stays_small_and_routes_like_the_whole_log(spark, scratch):
    """Hundreds of changes of one table: what is kept is bounded, and records within
    the kept time are routed as by the whole log."""
    row = lambda i: ("user_info", f"dim_{i}", "info", "id", "id", None)
    image = config_dim.schemas.CONFIG.simpleString()
    df = spark.createDataFrame([("u", 1000 * i, i, row(i)) for i in range(300)],
                               f"op string, ts_ms bigint, offset bigint, after {image}")
    log = df.select(F.lit(0).alias("part"), "offset", F.to_json(F.struct("op", "ts_ms", "after")).alias("value"))
    for i in range(3):
        log.filter(F.floor(F.col("offset") / 100) == i).coalesce(1).write.mode("append").parquet(f"{scratch}/log")
        kept = config_state.refresh(spark, f"{scratch}/log", f"{scratch}/state", keep_ms=20_000)
        assert kept.count() == 21
    pre = config_src.config_table(spark)
    whole = config_dim.config_versions(spark, pre, config_dim.parse_config_changes(log))
    small = config_dim.config_versions(spark, pre, kept)
    at = spark.createDataFrame([("user_info", 1000 * t + 1) for t in range(280, 305)], "table string, ts long")
    routed = lambda v: sorted((r.ts, r.cfg.sink_table) for r in config_dim.route(at, v).collect())
    assert routed(whole) == routed(small) and len(routed(small)) == 25


def test_a_repeated_config_batch_makes_the_same_state(spark, scratch):
    rows = config_src.config_records(spark)
    for _ in range(2):
        config_state.apply(rows.filter("offset < 4"), 0, scratch, None)
        config_state.apply(rows.filter("offset >= 4"), 1, scratch, None)
        assert config_state.changes(spark, scratch).count() == rows.count()
    config_state.apply(rows.filter("offset >= 4"), 1, scratch, None)
    assert config_state.changes(spark, scratch).count() == rows.count()
