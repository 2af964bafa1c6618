"""Golden rules of the per-order state machine on tiny literal logs."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelstream import schemas
from parcelstream.operators import orders

LOG_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()), T.StructField("ts_ms", T.LongType()),
    T.StructField("op", T.StringType()), T.StructField("table", T.StringType()),
    T.StructField("order_key", T.LongType()), T.StructField("status", T.StringType()),
    T.StructField("before_status", T.StringType()),
    T.StructField("order_after", schemas.ORDER_INFO),
    T.StructField("cargo_after", schemas.ORDER_CARGO)])

_seq = iter(range(1, 10_000))


def _order(key, ts, op, status, before=None, name="张三丰"):
    img = {f.name: None for f in schemas.ORDER_INFO.fields}
    img.update(id=str(key), status=status, sender_name=name, receiver_name="",
               update_time="2024-01-01T00:00:00Z", estimate_arrive_time=0)
    return (next(_seq), ts, op, "order_info", key, status, before, img, None)


def _cargo(key, ts, cid):
    img = {f.name: None for f in schemas.ORDER_CARGO.fields}
    img.update(id=cid, order_id=str(key), create_time="2024-01-01T00:00:00Z")
    return (next(_seq), ts, "c", "order_cargo", key, None, None, None, img)


def _log(spark):
    rows = [
        # 1: order first; cargo inside the window joins, cargo after it does not
        _order(1, 1000, "c", "60010"), _cargo(1, 3000, "c1a"), _cargo(1, 7000, "c1b"),
        # 2: cargo first; the order joins the latest cargo once and is not stored
        _cargo(2, 0, "c2a"), _cargo(2, 500, "c2b"), _order(2, 1000, "c", "60010"),
        _cargo(2, 2000, "c2c"),
        # 3: two cargo rows inside the window both join the stored order
        _order(3, 0, "c", "60010"), _cargo(3, 100, "c3a"), _cargo(3, 200, "c3b"),
        # 4: every transition; sign clears the detail
        _cargo(4, 0, "c4"),
        _order(4, 10, "u", "60020", "60010"), _order(4, 20, "u", "60030", "60020"),
        _order(4, 30, "u", "60040", "60030"), _order(4, 40, "u", "60050", "60040"),
        _order(4, 50, "u", "60060", "60050"), _order(4, 60, "u", "60070", "60060"),
        _order(4, 70, "u", "60080", "60070"), _order(4, 80, "u", "60999", "60080"),
        _order(4, 90, "u", "60999", "60999"),
        # 5: updates without cargo / without a previous status
        _order(5, 0, "u", "60020", "60010"), _order(5, 5, "u", "60030", None),
        # 6: cancel from several statuses, new cargo in between
        _cargo(6, 0, "c6a"), _order(6, 10, "u", "60999", "60020"), _cargo(6, 20, "c6b"),
        _order(6, 30, "u", "60999", "60050"),
    ]
    return spark.createDataFrame(rows, LOG_SCHEMA)


def test_place_order_both_arrival_orders(spark):
    sm = orders.order_state_machine(_log(spark), window_ms=5000)
    got = sorted((r["order_id"], r["id"]) for r in orders.place_order_from_state(sm).collect())
    assert got == [("1", "c1a"), ("2", "c2b"), ("3", "c3a"), ("3", "c3b")]


def test_transition_routes_and_clear(spark):
    sm = orders.order_state_machine(_log(spark), window_ms=5000)
    counts = {}
    for fact in orders.FACT_TIME:
        rows = orders.transition_facts(sm, fact).collect()
        counts[fact] = sorted((r["order_id"], r["id"]) for r in rows)
    assert counts["dwd_trade_pay_suc_detail"] == [("4", "c4")]
    assert counts["dwd_trans_receive_detail"] == [("4", "c4")]
    assert counts["dwd_trans_dispatch_detail"] == [("4", "c4")]
    assert counts["dwd_trans_bound_finish_detail"] == [("4", "c4")]
    assert counts["dwd_trans_deliver_detail"] == [("4", "c4")]
    assert counts["dwd_trans_sign_detail"] == [("4", "c4")]
    assert counts["dwd_trade_cancel_detail"] == [("6", "c6a"), ("6", "c6b")]


def test_quarantine(spark):
    sm = orders.order_state_machine(_log(spark), window_ms=5000)
    got = sorted((r["order_key"], r["reason"]) for r in orders.orders_without_detail(sm).collect())
    assert got == [(4, "no_detail"), (5, "no_before_status"), (5, "no_detail")]


def test_expired_without_cargo(spark):
    rows = [_order(7, 0, "c", "60010"), _order(7, 100, "c", "60010"),   # first replaced
            _cargo(7, 200, "c7"),                                         # joins the second
            _order(8, 0, "c", "60010"), _cargo(8, 9000, "c8")]            # cargo too late
    sm = orders.order_state_machine(spark.createDataFrame(rows, LOG_SCHEMA), window_ms=5000)
    got = sorted((r["order_key"], r["ts_ms"]) for r in orders.orders_without_detail(sm)
                 .filter("reason = 'expired_without_cargo'").collect())
    assert got == [(7, 0), (8, 0)]


def test_fact_has_28_columns_and_masked_names(spark):
    sm = orders.order_state_machine(_log(spark), window_ms=5000)
    f = orders.transition_facts(sm, "dwd_trans_sign_detail")
    assert len(f.columns) == 28 and f.columns[7] == "sign_time"
    r = f.first()
    assert r["sender_name"] == "张**" and r["receiver_name"] == ""


def test_route_column_matches_python_twin(spark):
    from parcelstream.streaming.order_state import route_of
    codes = list(schemas.STATUS_CODES) + [None]
    pairs = [(a, b) for a in codes for b in codes]
    df = spark.createDataFrame(pairs, "b string, s string")
    got = df.select("b", "s", orders.route_column(F.lit("u"), F.lit("order_info"), F.col("b"),
                                                  F.col("s")).alias("r")).collect()
    for r in got:
        assert r["r"] == route_of(r["b"], r["s"]), (r["b"], r["s"])


def _order_first_log(spark, plan):
    """plan: list of (order_key, order_ts, [cargo offsets]) with offsets in
    (0, window) — every cargo arrives inside the order's waiting window."""
    rows, infos, cargos = [], [], []
    for key, ts, offsets in plan:
        o = _order(key, ts, "c", "60010")
        rows.append(o)
        infos.append(o[7])
        for i, off in enumerate(offsets):
            c = _cargo(key, ts + off, f"k{key}-{i}")
            rows.append(c)
            cargos.append(c[8])
    return rows, infos, cargos


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10_000), st.lists(st.integers(1, 4_999), max_size=4)),
                min_size=1, max_size=6))
def test_state_rules_equal_equi_join_inside_window(spark, orders_plan):
    plan = [(k + 100, ts, offs) for k, (ts, offs) in enumerate(orders_plan)]
    rows, infos, cargos = _order_first_log(spark, plan)
    log = spark.createDataFrame(rows, LOG_SCHEMA)
    by_state = orders.place_order_from_state(orders.order_state_machine(log, window_ms=5000))
    info_df = spark.createDataFrame(infos, schemas.ORDER_INFO)
    cargo_df = spark.createDataFrame(cargos, schemas.ORDER_CARGO) if cargos else \
        spark.createDataFrame([], schemas.ORDER_CARGO)
    by_join = orders.place_order_facts(info_df, cargo_df)
    assert by_state.exceptAll(by_join).count() == 0
    assert by_join.exceptAll(by_state).count() == 0
