"""The dimension store: folding, crashes between its steps, replays, and lookups
at a point in time."""

import os
import random

import pytest

from parcelstream.operators import dim_store, lookups, upsert_store

CELLS = "sink_table string, row_key string, column string, value string, ts long, part int, offset long"


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def cells(spark, rows):
    return spark.createDataFrame(rows, CELLS)


def random_batches(rnd, n=6, rows=40):
    offset, out = 0, []
    for _ in range(n):
        batch = []
        for _ in range(rows):
            offset += 1
            batch.append((rnd.choice(["t1", "t2", "t3"]), rnd.choice("abc"), rnd.choice(["x", "y"]),
                          f"v{offset}", rnd.randrange(20), 0, offset))
        out.append(batch)
    return out


def current(rows):
    best = {}
    for t, k, c, v, ts, part, off in rows:
        best[t, k, c] = max(best.get((t, k, c), (-1,)), (ts, part, off, v))
    return {key: v[3] for key, v in best.items()}


def stored(spark, root):
    rows = upsert_store.read(spark, dim_store.store(root)).collect()
    return {(r.sink_table, r.row_key, r.column): r.value for r in rows}


def test_reads_touch_the_base_and_newer_batches_only(spark, scratch):
    batches = random_batches(random.Random(1))
    for i, rows in enumerate(batches):
        dim_store.append_cells(cells(spark, rows), scratch, i)
        if i in (2, 4):
            dim_store.fold(spark, scratch, upto=i - 1)
        assert stored(spark, scratch) == current(sum(batches[:i + 1], []))
    m = upsert_store.manifest(spark, dim_store.store(scratch))
    assert m.version == 2 and m.folded == {"dim": 3}
    for table in ("t1", "t2", "t3"):
        got = dim_store.read_current(spark, scratch, table)
        files = {f.split(scratch)[1].split("/part-")[0] for f in got.inputFiles()}
        assert files <= {f"/{m.base[table]}/sink_table={table}",
                         *(f"/_cells/stream=dim/batch={b}/sink_table={table}" for b in (4, 5))}
        want = {k: v for k, v in current(sum(batches, [])).items() if k[0] == table}
        assert {(r.sink_table, r.row_key, r.column): r.value for r in got.collect()} == want
        every = dim_store.read_history(spark, scratch, table)
        assert sorted(map(tuple, every.collect())) == sorted(r for b in batches for r in b if r[0] == table)


def test_a_fold_rewrites_the_tables_it_touches_only(spark, scratch):
    dim_store.append_cells(cells(spark, [("t1", "a", "x", "1", 1, 0, 1), ("t2", "a", "x", "2", 1, 0, 2)]),
                           scratch, 0)
    first = dim_store.fold(spark, scratch, upto=0)
    dim_store.append_cells(cells(spark, [("t2", "a", "x", "3", 2, 0, 3)]), scratch, 1)
    second = dim_store.fold(spark, scratch, upto=1)
    assert second.base["t1"] == first.base["t1"] and second.base["t2"] != first.base["t2"]
    assert stored(spark, scratch) == {("t1", "a", "x"): "1", ("t2", "a", "x"): "3"}
    assert dim_store.fold(spark, scratch, upto=1) == second     # nothing new: nothing done


def test_replayed_batch_replaces_all_it_wrote(spark, scratch):
    dim_store.append_cells(cells(spark, [("t1", "a", "x", "old", 1, 0, 1), ("t2", "a", "x", "gone", 1, 0, 2)]),
                           scratch, 0)
    for _ in range(2):
        dim_store.append_cells(cells(spark, [("t1", "a", "x", "new", 1, 0, 1)]), scratch, 0)
        assert stored(spark, scratch) == {("t1", "a", "x"): "new"}


def test_late_rows_and_ties_of_several_streams(spark, scratch):
    """A row older than the folded one doesn't come back; streams are numbered
    on their own."""
    dim_store.append_cells(cells(spark, [("t", "a", "x", "5", 5, 0, 5)]), scratch, 7, stream="one")
    upsert_store.fold(spark, dim_store.store(scratch), {"one": 7})
    dim_store.append_cells(cells(spark, [("t", "a", "x", "4", 4, 0, 4), ("t", "b", "x", "1", 1, 0, 1)]),
                           scratch, 0, stream="two")
    assert stored(spark, scratch) == {("t", "a", "x"): "5", ("t", "b", "x"): "1"}
    upsert_store.fold(spark, dim_store.store(scratch), {"one": 9, "two": 0})
    assert stored(spark, scratch) == {("t", "a", "x"): "5", ("t", "b", "x"): "1"}


@pytest.mark.parametrize("step", ["_publish", "_sweep"])
def test_a_crash_between_steps_loses_nothing(spark, scratch, monkeypatch, step):
    batches = random_batches(random.Random(2), n=4)
    for i, rows in enumerate(batches[:2]):
        dim_store.append_cells(cells(spark, rows), scratch, i)
    dim_store.fold(spark, scratch, upto=0)
    dim_store.append_cells(cells(spark, batches[2]), scratch, 2)
    want = current(sum(batches[:3], []))
    calls = []

    def crash(*args):
        calls.append(args)
        if step == "_publish" or len(calls) == 2:      # a fold sweeps before and after
            raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(upsert_store, step, crash)
        with pytest.raises(RuntimeError):
            dim_store.fold(spark, scratch, upto=1)
    assert stored(spark, scratch) == want
    dim_store.append_cells(cells(spark, batches[2]), scratch, 2)      # the stream replays its batch
    dim_store.fold(spark, scratch, upto=1)
    dim_store.append_cells(cells(spark, batches[3]), scratch, 3)
    dim_store.fold(spark, scratch, upto=2)
    assert stored(spark, scratch) == current(sum(batches, []))
    m = upsert_store.manifest(spark, dim_store.store(scratch))
    before = [f for f in os.listdir(f"{scratch}/_base")]
    assert len(before) <= 2 and m.folded == {"dim": 2}                # what the crash left is gone
    every = [r for t in ("t1", "t2", "t3") for r in dim_store.read_history(spark, scratch, t).collect()]
    assert sorted(map(tuple, every)) == sorted(sum(batches, []))


def test_a_batch_killed_while_writing_is_invisible(spark, scratch, monkeypatch):
    dim_store.append_cells(cells(spark, [("t", "a", "x", "1", 1, 0, 1)]), scratch, 0)
    with monkeypatch.context() as patch:
        patch.setattr(upsert_store.Files, "move", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            dim_store.append_cells(cells(spark, [("t", "a", "x", "2", 2, 0, 2)]), scratch, 1)
    assert stored(spark, scratch) == {("t", "a", "x"): "1"}


# -------------------------------------------------- lookups at a point in time
def plain_as_of(history, key, ts, columns):
    out = []
    for c in columns:
        told = [(r[4], r[5], r[6], r[3]) for r in history if r[1] == key and r[2] == c
                and ts is not None and r[4] <= ts]
        out.append(max(told)[3] if told else None)
    return tuple(out)


def point_in_time(spark, history, facts, bucket_ms=None):
    f = spark.createDataFrame(facts, "id long, k string, at long, x string")
    return f, sorted((r.id, (r.one, r.two)) for r in lookups.as_of(
        f, "k", "at", cells(spark, history), {"x": "one", "y": "two"}, bucket_ms=bucket_ms).collect())


def test_as_of_equals_plain(spark):
    rnd = random.Random(4)
    history = [("t", rnd.choice("abc"), rnd.choice("xyz"), f"v{i}", rnd.randrange(100), rnd.randrange(3), i)
               for i in range(120)]
    facts = [(i, rnd.choice(["a", "b", "c", "d", None]), rnd.choice([*range(-5, 110), None]), "own")
             for i in range(400)]
    want = sorted((i, plain_as_of(history, k, at, "xy")) for i, k, at, _ in facts)
    for bucket_ms in (None, 7):
        assert point_in_time(spark, history, facts, bucket_ms)[1] == want


def test_as_of_with_one_busy_key(spark):
    """Half the facts and puts on one key, cut into time slices."""
    rnd = random.Random(8)
    key = lambda: "hot" if rnd.random() < 0.5 else f"k{rnd.randrange(50)}"
    history = [("t", key(), rnd.choice("xy"), f"v{i}", rnd.randrange(1000), 0, i) for i in range(300)]
    facts = [(i, key(), rnd.randrange(1000), None) for i in range(1500)]
    want = sorted((i, plain_as_of(history, k, at, "xy")) for i, k, at, _ in facts)
    assert point_in_time(spark, history, facts, 20)[1] == want


def test_intervals_and_stream_lookup_equal_as_of(spark, scratch):
    rnd = random.Random(5)
    history = [("t", rnd.choice("abc"), rnd.choice("xy"), f"v{i}", rnd.randrange(60), 0, i) for i in range(60)]
    facts = [(i, rnd.choice("abcd"), rnd.randrange(-2, 70), "own") for i in range(200)]
    f, want = point_in_time(spark, history, facts)
    intervals = lookups.validity(cells(spark, history), ["x", "y"], bucket_ms=9)
    per_key = {}
    for r in intervals.collect():
        per_key.setdefault(r.row_key, []).append((r.valid_from, r.valid_to))
    for spans in per_key.values():     # without gaps or overlaps, the last one open
        spans.sort()
        assert [a[1] for a in spans] == [b[0] for b in spans[1:]] + [None]

    f.repartition(3).write.parquet(f"{scratch}/facts")
    intervals.write.parquet(f"{scratch}/intervals")
    stream = spark.readStream.schema(f.schema).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/facts")
    out = lookups.as_of_intervals(stream, "k", "at", spark.read.parquet(f"{scratch}/intervals"),
                                  {"x": "one", "y": "two"})
    q = (out.writeStream.format("memory").queryName("as_of_stream").outputMode("append")
         .option("checkpointLocation", f"{scratch}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination(200)
    got = sorted((r.id, (r.one, r.two)) for r in spark.table("as_of_stream").collect())
    assert got == want


def test_no_broadcast_or_cross_join_hints_in_the_lookup_plan(spark):
    f = spark.createDataFrame([(1, "a", 5, "o")], "id long, k string, at long, x string")
    plan = lookups.as_of(f, "k", "at", cells(spark, [("t", "a", "x", "1", 1, 0, 1)]), {"x": "one"})
    text = plan._jdf.queryExecution().toString()
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_declared_keys_with_missing_targets(spark):
    rows = [("dim_u", "1", "region_id", "r1", 1, 0, 1), ("dim_u", "2", "region_id", "r9", 1, 0, 2),
            ("dim_u", "1", "other", "z", 1, 0, 3), ("dim_base_region_info", "r1", "name", "North", 1, 0, 4),
            ("dim_u", "3", "strange_id", "q", 1, 0, 5)]
    keys = spark.createDataFrame([("dim_u", "region_id"), ("dim_u", " strange_id")],
                                 "sink_table string, fk_column string")
    got = {(r.id, r.fk_column): (r.fk_value, r.target_table, r.target_name)
           for r in lookups.declared_keys(cells(spark, rows), keys).collect()}
    assert got == {("1", "region_id"): ("r1", "dim_base_region_info", "North"),
                   ("2", "region_id"): ("r9", "dim_base_region_info", None),
                   ("3", "strange_id"): ("q", None, None)}
