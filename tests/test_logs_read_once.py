"""Logs are read as they are derived: no query writes them out, and scans of short
keys move their rows once."""

import contextlib
import datetime as dt
import io

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from parcelstream import session
from parcelstream.operators import keyed_scan, ods, transit
from parcelstream.plans import materialize


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.fixture(scope="module")
def tiny(spark, tmp_path_factory):
    """Tables of a few rows."""
    d, at = str(tmp_path_factory.mktemp("tiny")), dt.datetime(2024, 1, 1, 10)
    tables = {
        "region": ([(0, "R")], "r_regionkey long, r_name string"),
        "nation": ([(0, "N", 0)], "n_nationkey long, n_name string, n_regionkey long"),
        "customer": ([(i, f"C{i}", 0, -300.0 * i, "M") for i in range(4)],
                     "c_custkey long, c_name string, c_nationkey long, c_acctbal double, c_mktsegment string"),
        "supplier": ([(0, "S", 0)], "s_suppkey long, s_name string, s_nationkey long"),
        "part": ([(0, "P", "B", "T", 1)],
                 "p_partkey long, p_name string, p_brand string, p_type string, p_size int"),
        "orders": ([(i, i, "O", 1.5, at, "1-X") for i in range(4)],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                   "o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": ([(i, 0, 0, 1, 2.0, 3.5, "FO"[i % 2], at) for i in range(4)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                     "l_extendedprice double, l_linestatus string, l_shipdate timestamp_ntz"),
        "events": ([(i, at + dt.timedelta(seconds=i), i % 2, kind, 1.0, f'{{"k": {i}}}') for i, kind in
                    enumerate(["signup", "signup", "purchase", "view", "view", "error", "click"])],
                   "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
                   "props string"),
    }
    for name, (rows, ddl) in tables.items():
        spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{d}/{name}.parquet")
    return d


def stored() -> set[str]:
    """The derived tables written since ``forget``."""
    return {k[1] for k in materialize._MEMO}


@pytest.mark.parametrize("name, rows", [
    ("dwd_bound_inbound", 4), ("dwd_bound_sort", 4), ("dwd_bound_outbound", 2), ("dwd_trans_finish", 4),
    ("dws_bound_org_sort_day", 1), ("dws_trans_org_truck_model_finish_day", 1), ("ods_clean", 30),
    ("dwd_decode_order", 9), ("dwd_decode_cargo", 5), ("ods_sink_record", 30),
    ("per_key_ordered_changes", 30), ("fn_json_extract", 33), ("cdc_changelog_scan", 33)])
def test_no_query_writes_out_a_log(spark, tiny, name, rows):
    materialize.forget()
    assert E.queries()[name](spark, tiny).count() == rows
    assert not stored() & {"captured_log", "ods_topic", "transit_topic"}


def test_dim_queries_do_not_read_the_facts(spark, tiny):
    materialize.forget()
    assert E.queries()["dim_upsert_cell_merge"](spark, tiny).count()
    assert stored() == {"dim_topic"}


def test_facts_decode_the_fields_they_read(spark, tiny):
    """The narrow images give what the full ones give."""
    make = {"dwd_bound_inbound": transit.bound_inbound, "dwd_bound_sort": transit.bound_sort,
            "dwd_bound_outbound": transit.bound_outbound, "dwd_trans_finish": transit.trans_finish}
    image = ('{"id":"1","order_id":"2","org_id":"3","inbound_time":"2024-01-01T00:00:00Z",'
             '"order_num":%s,"actual_distance":1.5,"truck_id":"9"%s}')
    t = ',"sort_time":"2024-01-01T02:00:00Z","outbound_time":"2024-01-01T05:00:00Z",' \
        '"actual_start_time":"2024-01-01T00:00:00Z","actual_end_time":"2024-01-01T03:00:00Z"'
    values = [f'{{"op":"{op}","ts_ms":1,"before":{b},"after":{a},"source":{{"table":"{table}"}}}}'
              for table in ("order_org_bound", "transport_task") for op in "cu"
              for b in ("null", "7", image % (1, ""), image % ('"no"', t), image % ('"no"', ""), image % (1, t))
              for a in (image % (1, t), image % ('"no"', t), image % (1, ""))]
    raw = spark.createDataFrame([(0, i, v) for i, v in enumerate(values)], "part int, offset long, value string")
    clean = ods.clean(raw)
    for fact, table in transit.FACT_TABLE.items():
        full = sorted(map(str, make[fact](transit.typed_log(clean, table)).collect()))
        assert full and sorted(map(str, make[fact](transit.fact_log(clean, fact)).collect())) == full


def test_partitioned_writes_do_not_sort(spark, scratch):
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "0")
    with session.open_writers(spark):
        assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "64"
        spark.range(90).withColumn("t", F.col("id") % 3).write.partitionBy("t").parquet(f"{scratch}/t")
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    assert spark.read.parquet(f"{scratch}/t").groupBy("t").count().filter("count = 30").count() == 3


@pytest.mark.parametrize("hot, windows", [(0, 1), (40, 2)])
def test_short_keys_take_one_window(spark, hot, windows):
    """Keys within the bound are scanned by one window each; a hot one in slices."""
    rows = [(1000 + i // 3, i, i) for i in range(90)] + [(0, i * 1000, 100 + i) for i in range(hot)]
    df = spark.createDataFrame(rows, "k long, ts long, seq long")
    out = keyed_scan.asof_last(df, "k", ["ts", "seq"], {"p": F.col("seq")}, max_rows=30, keep_bucket=True)
    assert (keyed_scan.WHOLE in out.columns) == (not hot)
    assert plan_text(out).count("+- Window [") + plan_text(out).count(":- Window [") == windows
    last, want = {}, {}
    for k, _, seq in rows:
        want[seq], last[k] = last.get(k), seq
    assert {r.seq: r.p for r in out.collect()} == want
