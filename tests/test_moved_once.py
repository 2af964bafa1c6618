"""The captured log moves the rows it is derived from once, as they are given, and the
same way at every size."""

import datetime as dt
import os
import re

import __spark_entry__ as E
from parcelstream import schemas
from parcelstream.plans import materialize
from parcelstream.sources import changelog, domain
from test_logs_read_once import plan_text, stored, tiny  # noqa: F401


def test_quarantine_moves_orders_and_events_once(spark, tiny):  # noqa: F811
    materialize.forget()
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")     # shows what is moved once and used twice
    try:
        plan = plan_text(E.queries()["ods_malformed_quarantine"](spark, tiny))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert not stored()
    moved = re.findall(r"[+]- Exchange hashpartitioning\((\w+)#", plan)
    # Orders and customers: once for the orders with a key, which events look up as well,
    # and the (few) orders without one.
    assert moved.count("o_custkey") == 2 and moved.count("c_custkey") == 1
    assert len(re.findall(r"ReusedExchange \[o_orderkey", plan)) == 1
    # Events once, for the scan and the join; line items and parts once, at any size.
    assert moved.count("order_key") == 2 and plan.count("__scan_whole") and moved.count("l_partkey") == 1
    events = next(x for x in plan.splitlines() if "Project [event_id" in x and "user_id" in x)
    assert "CASE" not in events and "date_format" not in events


def test_log_of_orders_without_key_customer_or_event(spark, tiny, scratch):  # noqa: F811
    """Keys that repeat, are null or unknown: the images are those of the joined rows."""
    at, d = dt.datetime(2024, 1, 1, 10), f"{scratch}/t"
    os.mkdir(d)
    for name in os.listdir(tiny):
        if name not in ("orders.parquet", "events.parquet"):
            os.symlink(f"{tiny}/{name}", f"{d}/{name}")
    spark.createDataFrame(
        [(1, 1, "O", 1.5, at, "1-X"), (1, 2, "F", 2.5, at, "2-X"), (2, 99, "O", 3.5, at, "3-X"),
         (None, 3, "F", 4.5, at, "4-X"), (3, 3, "F", 5.5, at, "5-X"), (4, None, "F", 6.5, at, "5-X")],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(f"{d}/orders.parquet")
    spark.createDataFrame(
        [(i, at + dt.timedelta(milliseconds=i), user, kind, 1.0, f'{{"k": {i}}}') for i, (user, kind) in enumerate(
            [(1, "signup"), (1, "view"), (2, "view"), (None, "view"), (None, "click"), (7, "purchase"), (2, "click")])],
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
        "props string").write.parquet(f"{d}/events.parquet")
    codes = schemas.STATUS_CODES
    for merge in (False, True):
        log = domain.order_change_log(spark, d, merge=merge).select(
            "seq", "status", "before_status", "order_after.amount", "order_after.collect_type",
            "order_after.update_time", "cargo_after.order_id")
        got = sorted((r.seq, r.status, r.before_status, r.amount and float(r.amount), r.collect_type, r.update_time,
                      r.order_id) for r in log.collect())
        t = "2024-01-01T10:00:00Z"
        assert got == [(0, codes[0], None, 1.5, "2", t, None), (0, codes[0], None, 2.5, "1", t, None),
                       (1, codes[1], codes[0], 1.5, "2", t, None), (1, codes[1], codes[0], 2.5, "1", t, None),
                       (2, codes[2], None, None, None, t, None), (3, codes[3], None, None, None, t, None),
                       (4, codes[4], codes[3], None, None, t, None), (5, codes[5], None, None, None, None, "7"),
                       (6, codes[6], codes[2], None, None, t, None)]
    records = changelog.captured_log(spark, d).filter("part = 0").select("offset").collect()
    assert sorted(str(r.offset) for r in records) == ["1", "1", "3", "None"]
    reasons = {(r.reason, r["table"]): r.n for r in E.queries()["ods_malformed_quarantine"](spark, d).collect()}
    # The order without a key, and events (two a repeated order) of no known order.
    assert reasons[("no_key", "order_info")] == 5
