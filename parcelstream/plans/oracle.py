"""DuckDB oracle SQL for the registered queries.

Each query is written independently of the Spark code, from plain columns of
the pre-registered views, with the same derivation rules (README, "Test-data
mapping").  Shared derivations are CTE snippets composed per query.
"""

from __future__ import annotations

ISO = "'%Y-%m-%dT%H:%M:%SZ'"
YMDHMS = "'%Y-%m-%d %H:%M:%S'"


def ms(ts_expr: str) -> str:
    """Epoch millis of a timestamp, floored like Spark's ``unix_millis``."""
    return f"(epoch_us({ts_expr}) // 1000)"


def local_text(ts_expr: str) -> str:
    return f"strftime({ts_expr} + INTERVAL 8 HOUR, {YMDHMS})"


def local_day(ms_expr: str) -> str:
    return f"strftime(epoch_ms({ms_expr}) + INTERVAL 8 HOUR, '%Y-%m-%d')"


def iso_ms(text_expr: str) -> str:
    return ms(f"strptime({text_expr}, {ISO})")


def iso_local(text_expr: str) -> str:
    return local_text(f"strptime({text_expr}, {ISO})")


def mask(x: str) -> str:
    return f"(substring({x}, 1, 1) || regexp_replace(substring({x}, 2), '.', '*', 'g'))"


def iso(ts_expr: str) -> str:
    return f"strftime({ts_expr}, {ISO})"


STATUS_CODES = ["60010", "60020", "60030", "60040", "60050", "60060", "60070", "60080",
                "60999"]

ORDER_ATTR = f"""
order_attr AS (
  SELECT o.o_orderkey AS order_key,
    CAST(o.o_orderkey AS VARCHAR) AS id,
    'WB' || lpad(CAST(o.o_orderkey AS VARCHAR), 10, '0') AS order_no,
    '60010' AS status,
    CASE WHEN o.o_orderstatus = 'O' THEN '2' ELSE '1' END AS collect_type,
    CAST(o.o_custkey AS VARCHAR) AS user_id,
    CAST(o.o_custkey AS VARCHAR) AS receiver_complex_id,
    CAST(n.n_regionkey AS VARCHAR) AS receiver_province_id,
    CAST(c.c_nationkey AS VARCHAR) AS receiver_city_id,
    CAST(c.c_nationkey AS VARCHAR) AS receiver_district_id,
    c.c_mktsegment AS receiver_name,
    CAST(o.o_custkey AS VARCHAR) AS sender_complex_id,
    CAST(n.n_regionkey AS VARCHAR) AS sender_province_id,
    CAST(c.c_nationkey AS VARCHAR) AS sender_city_id,
    CAST(c.c_nationkey AS VARCHAR) AS sender_district_id,
    c.c_name AS sender_name,
    o.o_orderpriority AS payment_type,
    CAST(substring(o.o_orderpriority, 1, 1) AS INTEGER) AS cargo_num,
    CAST(o.o_totalprice AS DECIMAL(16,2)) AS amount,
    {ms('o.o_orderdate')} + 259200000 AS estimate_arrive_time,
    CAST(abs(c.c_acctbal) AS DECIMAL(16,2)) AS distance,
    {iso('o.o_orderdate')} AS create_time,
    {iso('o.o_orderdate')} AS update_time,
    '0' AS is_deleted,
    {ms('o.o_orderdate')} AS ts_ms
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

CARGO_ID = ("concat_ws('-', CAST(l.l_orderkey AS VARCHAR), CAST(l.l_partkey AS VARCHAR), "
            "CAST(l.l_suppkey AS VARCHAR), CAST(l.l_linenumber AS VARCHAR), "
            "CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) AS VARCHAR))")

ORDER_CARGO = f"""
order_cargo AS (
  SELECT {CARGO_ID} AS id,
    CAST(l.l_orderkey AS VARCHAR) AS order_id,
    p.p_type AS cargo_type,
    CAST(p.p_size AS INTEGER) AS volumn_length,
    CAST(l.l_linenumber AS INTEGER) AS volumn_width,
    CAST(l.l_quantity AS INTEGER) AS volumn_height,
    CAST(l.l_quantity AS DECIMAL(16,2)) AS weight,
    {iso('l.l_shipdate')} AS create_time,
    {iso('l.l_shipdate')} AS update_time,
    '0' AS is_deleted,
    {ms('l.l_shipdate')} AS ts_ms
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)"""


def fact_select(c: str, o: str, time_name: str, time_src: str) -> str:
    """The 28 fact columns from cargo alias ``c`` and order alias ``o``
    (order names not yet masked)."""
    return f"""
    {c}.id AS id, {c}.order_id AS order_id, {c}.cargo_type AS cargo_type,
    {c}.volumn_length AS volume_length, {c}.volumn_width AS volume_width,
    {c}.volumn_height AS volume_height, {c}.weight AS weight,
    {iso_local(time_src)} AS {time_name},
    {o}.order_no AS order_no, {o}.status AS status, {o}.collect_type AS collect_type,
    {o}.user_id AS user_id, {o}.receiver_complex_id AS receiver_complex_id,
    {o}.receiver_province_id AS receiver_province_id, {o}.receiver_city_id AS receiver_city_id,
    {o}.receiver_district_id AS receiver_district_id,
    {mask(o + '.receiver_name')} AS receiver_name,
    {o}.sender_complex_id AS sender_complex_id, {o}.sender_province_id AS sender_province_id,
    {o}.sender_city_id AS sender_city_id, {o}.sender_district_id AS sender_district_id,
    {mask(o + '.sender_name')} AS sender_name,
    {o}.payment_type AS payment_type, {o}.cargo_num AS cargo_num, {o}.amount AS amount,
    {local_text(f'epoch_ms({o}.estimate_arrive_time - 28800000)')} AS estimate_arrive_time,
    {o}.distance AS distance,
    {iso_ms(time_src)} AS ts"""


PLACE_FACTS = f"""
place_facts AS (
  SELECT {fact_select('c', 'o', 'order_time', 'c.create_time')}
  FROM order_cargo c JOIN order_attr o ON c.order_id = o.id)"""

BASE_DIC = """
base_dic AS (SELECT DISTINCT p_type AS id, lower(p_type) AS name FROM part)"""

REGION_INFO = """
region_info AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name,
         'R' || CAST(n_regionkey AS VARCHAR) AS parent_id FROM nation
  UNION ALL
  SELECT 'R' || CAST(r_regionkey AS VARCHAR), r_name, CAST(NULL AS VARCHAR) FROM region)"""

ORGAN = """
organ AS (
  SELECT 'C' || CAST(n_nationkey AS VARCHAR) AS id, n_name || ' centre' AS org_name,
         CAST(NULL AS VARCHAR) AS org_parent_id, CAST(n_nationkey AS VARCHAR) AS region_id
  FROM nation
  UNION ALL
  SELECT CAST(s_suppkey AS VARCHAR), s_name, 'C' || CAST(s_nationkey AS VARCHAR),
         CAST(s_nationkey AS VARCHAR)
  FROM supplier)"""

TRUCK_INFO = """
truck_info AS (SELECT CAST(p_partkey AS VARCHAR) AS id, p_brand AS truck_model_id FROM part)"""

TRUCK_MODEL = """
truck_model AS (SELECT DISTINCT p_brand AS id, lower(p_brand) AS model_name FROM part)"""


def with_(*ctes: str, body: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


def q_place_facts() -> str:
    return with_(ORDER_ATTR, ORDER_CARGO, PLACE_FACTS, body="SELECT * FROM place_facts")


def q_cargo_type_order_day() -> str:
    return with_(ORDER_ATTR, ORDER_CARGO, PLACE_FACTS, BASE_DIC, body=f"""
SELECT a.cur_date, a.cargo_type, d.name AS cargo_type_name, a.order_amount_base,
       a.order_count_base, a.ts
FROM (SELECT {local_day('ts')} AS cur_date, cargo_type,
             CAST(sum(amount) AS DECIMAL(38,2)) AS order_amount_base,
             count(*) AS order_count_base, max(ts) AS ts
      FROM place_facts GROUP BY 1, 2) a
LEFT JOIN base_dic d ON a.cargo_type = d.id""")


def q_mask_names() -> str:
    return with_(ORDER_ATTR, body=f"""
SELECT id, {mask('sender_name')} AS sender_name, {mask('receiver_name')} AS receiver_name
FROM order_attr""")




# ------------------------------------------------------------------------
# Order life-cycle change log from events, and the per-order state rules
# ------------------------------------------------------------------------
def _codes_array() -> str:
    return "[" + ", ".join(f"'{c}'" for c in STATUS_CODES) + "]"


EV_LOG = f"""
ev0 AS (
  SELECT event_id AS seq, {ms('ts')} AS ts_ms, {iso('ts')} AS change_time,
    user_id AS order_key,
    CASE event_type WHEN 'purchase' THEN 'order_cargo' ELSE 'order_info' END AS tbl,
    CASE event_type WHEN 'signup' THEN 'c' WHEN 'purchase' THEN 'c' ELSE 'u' END AS op,
    {_codes_array()}[(CAST(json_extract_string(props, '$.k') AS INTEGER) % 9 + 9) % 9 + 1]
      AS status,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, value
  FROM events WHERE event_type <> 'error'),
ev AS (
  SELECT *, last_value(CASE WHEN tbl = 'order_info' THEN status END IGNORE NULLS) OVER (
      PARTITION BY order_key ORDER BY ts_ms, seq
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before_status
  FROM ev0),
ev_cargo AS (
  SELECT seq, CAST(seq AS VARCHAR) AS id, CAST(order_key AS VARCHAR) AS order_id,
    'K' || CAST(k AS VARCHAR) AS cargo_type, k AS volumn_length,
    CAST(NULL AS INTEGER) AS volumn_width, CAST(NULL AS INTEGER) AS volumn_height,
    CAST(value AS DECIMAL(16,2)) AS weight, change_time AS create_time
  FROM ev WHERE tbl = 'order_cargo'),
ev_order AS (
  SELECT e.seq, a.order_no, e.status, a.collect_type, a.user_id, a.receiver_complex_id,
    a.receiver_province_id, a.receiver_city_id, a.receiver_district_id, a.receiver_name,
    a.sender_complex_id, a.sender_province_id, a.sender_city_id, a.sender_district_id,
    a.sender_name, a.payment_type, a.cargo_num, a.amount, a.estimate_arrive_time, a.distance,
    e.change_time AS update_time
  FROM ev e LEFT JOIN order_attr a ON a.order_key = e.order_key
  WHERE e.tbl = 'order_info')"""

ROUTES = [("60010 -> 60020", "dwd_trade_pay_suc_detail", "pay_time"),
          ("60020 -> 60030", "dwd_trans_receive_detail", "receive_time"),
          ("60040 -> 60050", "dwd_trans_dispatch_detail", "dispatch_time"),
          ("60050 -> 60060", "dwd_trans_bound_finish_detail", "bound_finish_time"),
          ("60060 -> 60070", "dwd_trans_deliver_detail", "deliver_time"),
          ("60070 -> 60080", "dwd_trans_sign_detail", "sign_time")]
CANCEL = ("dwd_trade_cancel_detail", "cancel_time")
FACT_TIME = {f: t for _, f, t in ROUTES}
FACT_TIME[CANCEL[0]] = CANCEL[1]


def _route_case() -> str:
    whens = " ".join(f"WHEN '{lab}' THEN '{f}'" for lab, f, _ in ROUTES)
    return (f"CASE WHEN tbl = 'order_info' AND op = 'u' AND before_status IS NOT NULL "
            f"AND status IS NOT NULL AND before_status <> status THEN "
            f"CASE before_status || ' -> ' || status {whens} "
            f"ELSE CASE WHEN status = '60999' THEN '{CANCEL[0]}' END END END")


def state_machine(window_ms: int = 5000) -> str:
    return f"""
sm0 AS (SELECT *, {_route_case()} AS route FROM ev),
sm1 AS (
  SELECT *, last_value(CASE WHEN tbl = 'order_cargo' AND op = 'c' THEN seq
                            WHEN route IN ('dwd_trans_sign_detail', '{CANCEL[0]}') THEN -1
                       END IGNORE NULLS) OVER (
      PARTITION BY order_key ORDER BY ts_ms, seq
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS dref
  FROM sm0),
sm2 AS (
  SELECT *, CASE WHEN dref >= 0 THEN dref END AS detail_seq FROM sm1),
sm3 AS (
  SELECT *, last_value(CASE WHEN tbl = 'order_info' AND op = 'c' AND detail_seq IS NULL
                            THEN seq END IGNORE NULLS) OVER (
      PARTITION BY order_key ORDER BY ts_ms, seq
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS stored_ref
  FROM sm2),
sm AS (
  SELECT s.*, CASE WHEN s.tbl = 'order_cargo' AND s.op = 'c'
                    AND s.ts_ms < st.ts_ms + {window_ms} THEN s.stored_ref END AS stored_seq
  FROM sm3 s LEFT JOIN sm3 st ON st.seq = s.stored_ref)"""


def q_transition_fact(fact: str) -> str:
    return with_(ORDER_ATTR, EV_LOG, state_machine(), body=f"""
SELECT {fact_select('c', 'o', FACT_TIME[fact], 'o.update_time')}
FROM sm s JOIN ev_cargo c ON c.seq = s.detail_seq JOIN ev_order o ON o.seq = s.seq
WHERE s.route = '{fact}'""")


def q_place_from_state(window_ms: int) -> str:
    return with_(ORDER_ATTR, EV_LOG, state_machine(window_ms), body=f"""
SELECT {fact_select('c', 'o', 'order_time', 'c.create_time')}
FROM sm s JOIN ev_cargo c ON c.seq = s.seq JOIN ev_order o ON o.seq = s.stored_seq
UNION ALL
SELECT {fact_select('c', 'o', 'order_time', 'c.create_time')}
FROM sm s JOIN ev_cargo c ON c.seq = s.detail_seq JOIN ev_order o ON o.seq = s.seq
WHERE s.tbl = 'order_info' AND s.op = 'c'""")


def q_status_change_filter() -> str:
    return with_(EV_LOG, body="""
SELECT seq, CAST(order_key AS VARCHAR) AS order_id, before_status, status, ts_ms
FROM ev WHERE tbl = 'order_info' AND op = 'u' AND before_status <> status""")


def q_status_transition_label() -> str:
    return with_(EV_LOG, body=f"""
SELECT seq, CAST(order_key AS VARCHAR) AS order_id,
       before_status || ' -> ' || status AS change_label, {_route_case()} AS route
FROM ev WHERE tbl = 'order_info' AND op = 'u' AND before_status <> status""")


def q_status_route_counts() -> str:
    return with_(EV_LOG, body=f"""
SELECT coalesce(route, 'unrouted') AS route, count(*) AS n
FROM (SELECT {_route_case()} AS route FROM ev
      WHERE tbl = 'order_info' AND op = 'u' AND before_status <> status) t
GROUP BY 1""")


def q_status_asof_detail() -> str:
    return with_(ORDER_ATTR, EV_LOG, state_machine(), body="""
SELECT s.seq, CAST(s.order_key AS VARCHAR) AS order_id, s.route, c.id AS detail_id,
       c.weight AS detail_weight
FROM sm s LEFT JOIN ev_cargo c ON c.seq = s.detail_seq
WHERE s.route IS NOT NULL""")


def q_orders_without_detail() -> str:
    return with_(ORDER_ATTR, EV_LOG, state_machine(), body="""
SELECT seq, ts_ms, order_key, status, before_status,
       CASE WHEN tbl = 'order_info' AND op = 'u' AND before_status IS NULL
            THEN 'no_before_status' ELSE 'no_detail' END AS reason, route
FROM sm
WHERE (route IS NOT NULL AND detail_seq IS NULL)
   OR (tbl = 'order_info' AND op = 'u' AND before_status IS NULL)
UNION ALL
SELECT w.seq, w.ts_ms, w.order_key, w.status, w.before_status,
       'expired_without_cargo', CAST(NULL AS VARCHAR)
FROM sm w
WHERE w.tbl = 'order_info' AND w.op = 'c' AND w.detail_seq IS NULL
  AND NOT EXISTS (SELECT 1 FROM sm c WHERE c.stored_seq = w.seq)""")


def q_conditional_key() -> str:
    return with_(EV_LOG, body="""
SELECT seq, tbl AS "table", CAST(order_key AS VARCHAR) AS key FROM ev""")


def q_op_dispatch() -> str:
    return with_(EV_LOG, body="""
SELECT tbl AS "table", op,
       CASE WHEN tbl = 'order_info' AND op = 'c' THEN 'place_order'
            WHEN tbl = 'order_info' AND op = 'u' THEN 'transition'
            WHEN tbl = 'order_cargo' AND op = 'c' THEN 'cargo'
            ELSE 'ignored' END AS path,
       count(*) AS n
FROM ev GROUP BY ALL""")


# ------------------------------------------------------------------------
# Daily aggregates
# ------------------------------------------------------------------------
def _centre(district_expr: str) -> str:
    return (f"(SELECT o.id FROM organ o WHERE o.org_parent_id IS NULL "
            f"AND o.region_id = {district_expr})")


def _org_geo(src: str, with_province: bool) -> str:
    """Join org -> name, join org (parent or itself) -> city -> province."""
    prov = ("p.id AS province_id, p.name AS province_name," if with_province else "")
    return f"""
  FROM {src} a
  LEFT JOIN organ og ON og.id = a.org_id
  LEFT JOIN organ jo ON jo.id = coalesce(og.org_parent_id, a.org_id)
  LEFT JOIN region_info ci ON ci.id = jo.region_id
  LEFT JOIN region_info p ON p.id = ci.parent_id"""


def q_org_order_day() -> str:
    return with_(ORDER_ATTR, ORDER_CARGO, PLACE_FACTS, ORGAN, REGION_INFO, body=f"""
SELECT a.cur_date, a.org_id, og.org_name, jo.region_id AS city_id, ci.name AS city_name,
       a.order_amount_base, a.order_count_base, a.ts
FROM (SELECT f.cur_date, c.id AS org_id,
             CAST(sum(f.amount) AS DECIMAL(38,2)) AS order_amount_base,
             count(*) AS order_count_base, max(f.ts) AS ts
      FROM (SELECT {local_day('ts')} AS cur_date, sender_district_id, order_id,
                   max(amount) AS amount, max(ts) AS ts
            FROM place_facts GROUP BY 1, 2, 3) f
      LEFT JOIN organ c ON c.org_parent_id IS NULL AND c.region_id = f.sender_district_id
      GROUP BY 1, 2) a
LEFT JOIN organ og ON og.id = a.org_id
LEFT JOIN organ jo ON jo.id = coalesce(og.org_parent_id, a.org_id)
LEFT JOIN region_info ci ON ci.id = jo.region_id""")


def _transition_facts_cte(fact: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT {fact_select('c', 'o', FACT_TIME[fact], 'o.update_time')}
  FROM sm s JOIN ev_cargo c ON c.seq = s.detail_seq JOIN ev_order o ON o.seq = s.seq
  WHERE s.route = '{fact}')"""


def q_org_receive_day() -> str:
    return with_(ORDER_ATTR, EV_LOG, state_machine(),
                 _transition_facts_cte("dwd_trans_receive_detail", "rf"), ORGAN, REGION_INFO,
                 body=f"""
SELECT a.cur_date, a.org_id, og.org_name, jo.region_id AS city_id, ci.name AS city_name,
       p.id AS province_id, p.name AS province_name, a.receive_order_count_base, a.ts
FROM (SELECT cur_date, c.id AS org_id, count(*) AS receive_order_count_base, max(ts) AS ts
      FROM (SELECT {local_day('ts')} AS cur_date, sender_district_id, order_id,
                   max(ts) AS ts FROM rf GROUP BY 1, 2, 3) f
      LEFT JOIN organ c ON c.org_parent_id IS NULL AND c.region_id = f.sender_district_id
      GROUP BY 1, 2) a
LEFT JOIN organ og ON og.id = a.org_id
LEFT JOIN organ jo ON jo.id = coalesce(og.org_parent_id, a.org_id)
LEFT JOIN region_info ci ON ci.id = jo.region_id
LEFT JOIN region_info p ON p.id = ci.parent_id""")


def q_orders_per_day(fact: str, measure: str) -> str:
    return with_(ORDER_ATTR, EV_LOG, state_machine(), _transition_facts_cte(fact, "f0"),
                 body=f"""
SELECT cur_date, count(*) AS {measure}, max(ts) AS ts
FROM (SELECT {local_day('ts')} AS cur_date, order_id, max(ts) AS ts FROM f0 GROUP BY 1, 2) t
GROUP BY 1""")


def q_org_deliver_suc_day() -> str:
    return with_(ORDER_ATTR, EV_LOG, state_machine(),
                 _transition_facts_cte("dwd_trans_deliver_detail", "df"), ORGAN, REGION_INFO,
                 body=f"""
SELECT a.cur_date, a.org_id, og.org_name, jo.region_id AS city_id, ci.name AS city_name,
       p.id AS province_id, p.name AS province_name, a.deliver_suc_count_base, a.ts
FROM (SELECT {local_day('f.ts')} AS cur_date, c.id AS org_id,
             count(*) AS deliver_suc_count_base, max(f.ts) AS ts
      FROM df f
      LEFT JOIN organ c ON c.org_parent_id IS NULL AND c.region_id = f.receiver_district_id
      GROUP BY 1, 2) a
LEFT JOIN organ og ON og.id = a.org_id
LEFT JOIN organ jo ON jo.id = coalesce(og.org_parent_id, a.org_id)
LEFT JOIN region_info ci ON ci.id = jo.region_id
LEFT JOIN region_info p ON p.id = ci.parent_id""")


def oracle_sql() -> dict[str, str]:
    out = {
        "dwd_trade_order_detail": q_place_facts(),
        "mask_names": q_mask_names(),
        "dws_trade_cargo_type_order_day": q_cargo_type_order_day(),
        "dws_trade_org_order_day": q_org_order_day(),
        "status_change_filter": q_status_change_filter(),
        "status_transition_label": q_status_transition_label(),
        "status_route_counts": q_status_route_counts(),
        "status_asof_detail": q_status_asof_detail(),
        "orders_without_detail": q_orders_without_detail(),
        "dwd_conditional_key": q_conditional_key(),
        "cdc_op_dispatch": q_op_dispatch(),
        "order_cargo_interval_join": q_place_from_state(24 * 60 * 60 * 1000),
        "dws_trans_org_receive_day": q_org_receive_day(),
        "dws_trans_dispatch_day": q_orders_per_day("dwd_trans_dispatch_detail",
                                                   "dispatch_order_count_base"),
        "dws_trans_bound_finish_day": q_orders_per_day("dwd_trans_bound_finish_detail",
                                                       "bound_finish_order_count_base"),
        "dws_trans_org_deliver_suc_day": q_org_deliver_suc_day(),
    }
    for fact in FACT_TIME:
        out[fact] = q_transition_fact(fact)
    return out


def _late_oracles() -> dict[str, str]:
    return {}


# ------------------------------------------------------------------------
# Captured change log (ODS input) and its cleaning
# ------------------------------------------------------------------------
T0, TU, TD = 1704067200000, 1704240000000, 1704326400000

LOG_CLEAN = f"""
clean_rows AS (
  SELECT 'order_info' AS "table", 'c' AS op, ts_ms AS ts, id, 0 AS part FROM order_attr
  UNION ALL SELECT 'order_cargo', 'c', ts_ms, id, 1 FROM order_cargo
  UNION ALL SELECT tbl, op, ts_ms,
      CASE WHEN tbl = 'order_info' THEN CAST(order_key AS VARCHAR) ELSE CAST(seq AS VARCHAR) END,
      2 FROM ev
  UNION ALL SELECT 'user_info', 'r', {T0}, CAST(c_custkey AS VARCHAR), 3 FROM customer
  UNION ALL SELECT 'user_info', 'u', {TU}, CAST(c_custkey AS VARCHAR), 3 FROM customer
      WHERE c_acctbal < 0
  UNION ALL SELECT 'base_organ', 'r', {T0}, id, 4 FROM organ
  UNION ALL SELECT 'base_region_info', 'r', {T0}, id, 5 FROM region_info
  UNION ALL SELECT 'base_dic', 'r', {T0}, id, 6 FROM base_dic
  UNION ALL SELECT 'base_dic', 'u', {TU}, id, 6 FROM base_dic
  UNION ALL SELECT 'truck_info', 'r', {T0}, id, 7 FROM truck_info
  UNION ALL SELECT 'truck_model', 'r', {T0}, id, 8 FROM truck_model
  UNION ALL SELECT 'employee_info', 'r', {T0}, CAST(s_suppkey AS VARCHAR), 9 FROM supplier),
ev_err AS (
  SELECT event_id, {ms('ts')} AS ts_ms,
         CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 AS kind
  FROM events WHERE event_type = 'error'),
deleted_rows AS (
  SELECT 'user_info' AS "table", 'd' AS op, {TD} AS ts, CAST(c_custkey AS VARCHAR) AS id,
         3 AS part
  FROM customer WHERE c_acctbal < -500)"""

LOG_CTES = (ORDER_ATTR, ORDER_CARGO, EV_LOG, ORGAN, REGION_INFO, BASE_DIC, TRUCK_INFO,
            TRUCK_MODEL, LOG_CLEAN)

FACT_TABLES = "('order_info', 'order_cargo', 'transport_task', 'order_org_bound')"
DIM_TABLES = ("('user_info', 'user_address', 'base_complex', 'base_dic', 'base_region_info', "
              "'base_organ', 'express_courier', 'express_courier_complex', 'employee_info', "
              "'line_base_shift', 'line_base_info', 'truck_driver', 'truck_info', "
              "'truck_model', 'truck_team')")


def _all_scanned() -> str:
    """Every record parsed: (table, op, ts_ms, id); unparseable -> nulls."""
    return """
SELECT "table", op, ts AS ts_ms, id FROM clean_rows
UNION ALL SELECT "table", op, ts, id FROM deleted_rows
UNION ALL SELECT CASE WHEN kind = 2 THEN 'order_info' END,
                 CASE WHEN kind = 2 THEN 'u' END,
                 CASE WHEN kind = 2 THEN ts_ms END, CAST(NULL AS VARCHAR)
          FROM ev_err"""


def q_changelog_scan() -> str:
    return with_(*LOG_CTES, body=_all_scanned())


def q_table_group_filter() -> str:
    return with_(*LOG_CTES, body=f"""
SELECT * FROM ({_all_scanned()}) t WHERE "table" IN {FACT_TABLES}""")


def q_initial_snapshot_union() -> str:
    return with_(*LOG_CTES, body=f"""
SELECT "table", op, count(*) AS n FROM ({_all_scanned()}) t
WHERE "table" IN {DIM_TABLES} GROUP BY 1, 2""")


def q_decimal_decode() -> str:
    return with_(*LOG_CTES, body="""
SELECT 'order_info' AS "table", id, 'amount' AS field, amount AS value FROM order_attr
UNION ALL SELECT 'order_info', id, 'distance', distance FROM order_attr
UNION ALL SELECT 'order_info', CAST(e.order_key AS VARCHAR), 'amount', a.amount
  FROM ev e LEFT JOIN order_attr a ON a.order_key = e.order_key WHERE e.tbl = 'order_info'
UNION ALL SELECT 'order_info', CAST(e.order_key AS VARCHAR), 'distance', a.distance
  FROM ev e LEFT JOIN order_attr a ON a.order_key = e.order_key WHERE e.tbl = 'order_info'
UNION ALL SELECT 'order_cargo', id, 'weight', weight FROM order_cargo
UNION ALL SELECT 'order_cargo', CAST(seq AS VARCHAR), 'weight', CAST(value AS DECIMAL(16,2))
  FROM ev WHERE tbl = 'order_cargo'""")


def q_number_text() -> str:
    return f"""SELECT "table", id, field, CAST(CAST(value AS DECIMAL(16,2)) AS VARCHAR) AS value
FROM ({q_decimal_decode()}) t"""


def q_tombstone_filter() -> str:
    return with_(*LOG_CTES, body="""
SELECT part, count(*) AS n FROM (
  SELECT part FROM clean_rows UNION ALL SELECT part FROM deleted_rows
  UNION ALL SELECT 2 FROM ev_err WHERE kind <> 3) t
GROUP BY 1""")


def q_ods_clean() -> str:
    return with_(*LOG_CTES, body='SELECT "table", op, ts, id FROM clean_rows')


def q_quarantine() -> str:
    return with_(*LOG_CTES, body="""
SELECT reason, "table", count(*) AS n FROM (
  SELECT CASE kind WHEN 3 THEN 'tombstone' ELSE 'malformed' END AS reason,
         CASE WHEN kind = 2 THEN 'order_info' END AS "table" FROM ev_err
  UNION ALL SELECT 'delete', "table" FROM deleted_rows) t
GROUP BY 1, 2""")


def q_union_sources() -> str:
    return with_(*LOG_CTES, body=f"""
SELECT CASE WHEN part <= 2 THEN 'dwd' ELSE 'realtime_dim' END AS grp, "table",
       count(*) AS n
FROM clean_rows GROUP BY 1, 2""")


def q_sink_record() -> str:
    return with_(*LOG_CTES, body='SELECT id AS key, op, ts, "table", id FROM clean_rows')


def q_per_key_ordered() -> str:
    return with_(*LOG_CTES, body="""
SELECT id AS key, "table", ts, lag(ts) OVER (PARTITION BY id ORDER BY ts, part) AS prev_ts
FROM clean_rows WHERE id IS NOT NULL""")


def q_dim_stream_project() -> str:
    return with_(*LOG_CTES, body=f"""
SELECT "table", op, ts, id, CASE "table"
    WHEN 'user_info' THEN 'id,login_name,region_id,user_level'
    WHEN 'base_organ' THEN CASE WHEN starts_with(id, 'C') THEN 'id,org_name,region_id'
                               ELSE 'id,org_name,org_parent_id,region_id' END
    WHEN 'base_region_info' THEN CASE WHEN starts_with(id, 'R') THEN 'id,name'
                                      ELSE 'id,name,parent_id' END
    WHEN 'base_dic' THEN 'id,name'
    WHEN 'truck_info' THEN 'id,truck_model_id'
    WHEN 'truck_model' THEN 'id,model_name'
    WHEN 'employee_info' THEN 'emp_name,id' END AS keys
FROM clean_rows WHERE "table" IN {DIM_TABLES}""")


def q_dwd_stream_project() -> str:
    return with_(*LOG_CTES, body=f"""
SELECT "table", op, ts, id, CAST(NULL AS VARCHAR) AS before_status FROM clean_rows
WHERE "table" IN {FACT_TABLES} AND NOT (part = 2 AND "table" = 'order_info')
UNION ALL
SELECT 'order_info', op, ts_ms, CAST(order_key AS VARCHAR),
       CASE WHEN op = 'u' THEN before_status END FROM ev WHERE tbl = 'order_info'""")


def q_dwd_table_filter() -> str:
    return with_(*LOG_CTES, body="""
SELECT "table", op, ts, id FROM clean_rows WHERE "table" IN ('order_info', 'order_cargo')""")


ORDER_COLS = ("id, order_no, status, collect_type, user_id, receiver_complex_id, "
              "receiver_province_id, receiver_city_id, receiver_district_id, receiver_name, "
              "sender_complex_id, sender_province_id, sender_city_id, sender_district_id, "
              "sender_name, payment_type, cargo_num, amount, estimate_arrive_time, distance, "
              "create_time, update_time, is_deleted")


def q_decode_order() -> str:
    return with_(*LOG_CTES, body=f"""
SELECT 'c' AS op, {ORDER_COLS} FROM order_attr
UNION ALL
SELECT e.op, CAST(e.order_key AS VARCHAR), a.order_no, e.status, a.collect_type, a.user_id,
  a.receiver_complex_id, a.receiver_province_id, a.receiver_city_id, a.receiver_district_id,
  a.receiver_name, a.sender_complex_id, a.sender_province_id, a.sender_city_id,
  a.sender_district_id, a.sender_name, a.payment_type, a.cargo_num, a.amount,
  a.estimate_arrive_time, a.distance, a.create_time, e.change_time, a.is_deleted
FROM ev e LEFT JOIN order_attr a ON a.order_key = e.order_key WHERE e.tbl = 'order_info'""")


def q_decode_cargo() -> str:
    return with_(*LOG_CTES, body="""
SELECT 'c' AS op, id, order_id, cargo_type, volumn_length, volumn_width, volumn_height, weight,
       create_time, update_time, is_deleted FROM order_cargo
UNION ALL
SELECT 'c', CAST(seq AS VARCHAR), CAST(order_key AS VARCHAR), 'K' || CAST(k AS VARCHAR), k,
       CAST(NULL AS INTEGER), CAST(NULL AS INTEGER), CAST(value AS DECIMAL(16,2)),
       change_time, change_time, '0'
FROM ev WHERE tbl = 'order_cargo'""")


def q_json_extract() -> str:
    return with_(*LOG_CTES, body="""
SELECT c."table", c.op, c.ts AS ts_ms, c.id AS after_id,
       CASE WHEN c."table" = 'order_info' THEN coalesce(e.status, '60010') END AS after_status
FROM clean_rows c
LEFT JOIN ev e ON c.part = 2 AND c."table" = 'order_info' AND e.tbl = 'order_info'
     AND e.seq = -1
WHERE c.part <> 2
UNION ALL
SELECT tbl, op, ts_ms, CASE WHEN tbl = 'order_info' THEN CAST(order_key AS VARCHAR)
                            ELSE CAST(seq AS VARCHAR) END,
       CASE WHEN tbl = 'order_info' THEN status END FROM ev
UNION ALL
SELECT "table", op, ts, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM deleted_rows
UNION ALL
SELECT CASE WHEN kind = 2 THEN 'order_info' END, CASE WHEN kind = 2 THEN 'u' END,
       CASE WHEN kind = 2 THEN ts_ms END, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR)
FROM ev_err""")


def q_json_serialize() -> str:
    return with_(ORDER_CARGO, body="""
SELECT id, to_json({'id': id, 'order_id': order_id, 'cargo_type': cargo_type,
                    'create_time': create_time})::VARCHAR AS json
FROM order_cargo""")


def _ods_oracles() -> dict[str, str]:
    return {
        "cdc_changelog_scan": q_changelog_scan(),
        "cdc_table_group_filter": q_table_group_filter(),
        "cdc_initial_snapshot_union": q_initial_snapshot_union(),
        "cdc_decimal_decode": q_decimal_decode(),
        "cdc_number_text": q_number_text(),
        "cdc_tombstone_filter": q_tombstone_filter(),
        "ods_clean": q_ods_clean(),
        "ods_malformed_quarantine": q_quarantine(),
        "ods_union_sources": q_union_sources(),
        "ods_sink_record": q_sink_record(),
        "per_key_ordered_changes": q_per_key_ordered(),
        "dim_stream_project": q_dim_stream_project(),
        "dwd_stream_project": q_dwd_stream_project(),
        "dwd_table_filter": q_dwd_table_filter(),
        "dwd_decode_order": q_decode_order(),
        "dwd_decode_cargo": q_decode_cargo(),
        "fn_json_extract": q_json_extract(),
        "fn_json_serialize": q_json_serialize(),
    }


def all_oracles() -> dict[str, str]:
    out = oracle_sql()
    out.update(_ods_oracles())
    out.update(_dim_oracles())
    out.update(_late_oracles())
    return out


# ------------------------------------------------------------------------
# Config-driven dimension routing and the cell-merge store
# ------------------------------------------------------------------------
ROUTED = f"""
routed AS (
  SELECT 'user_info' AS "table", 'dim_user_info' AS sink_table, 'id' AS sink_pk,
         CAST(c_custkey AS VARCHAR) AS id, {T0} AS ts, 'preload' AS origin,
         'id,login_name,region_id,user_level' AS columns
  FROM customer
  UNION ALL
  SELECT 'user_info', 'dim_user_info', 'id', CAST(c_custkey AS VARCHAR), {TU}, 'live',
         'id,login_name,region_id'
  FROM customer WHERE c_acctbal < 0
  UNION ALL
  SELECT 'base_organ', 'dim_base_organ', 'id', id, {T0}, 'preload',
         CASE WHEN org_parent_id IS NULL THEN 'id,org_name,region_id'
              ELSE 'id,org_name,org_parent_id,region_id' END
  FROM organ
  UNION ALL
  SELECT 'base_region_info', 'dim_base_region_info', 'id', id, {T0}, 'preload',
         CASE WHEN parent_id IS NULL THEN 'id,name' ELSE 'id,name,parent_id' END
  FROM region_info
  UNION ALL
  SELECT 'base_dic', 'dim_base_dic', 'id', id, {T0}, 'preload', 'id,name' FROM base_dic
  UNION ALL
  SELECT 'truck_info', 'dim_truck_info', 'id', id, {T0}, 'preload', 'id,truck_model_id'
  FROM truck_info
  UNION ALL
  SELECT 'truck_model', 'dim_truck_model', 'id', id, {T0}, 'preload', 'id,model_name'
  FROM truck_model),
dim_cells AS (
  SELECT 'dim_user_info' AS sink_table, CAST(c_custkey AS VARCHAR) AS row_key,
         'login_name' AS "column", c_name AS value, {T0} AS ts FROM customer
  UNION ALL SELECT 'dim_user_info', CAST(c_custkey AS VARCHAR), 'user_level', c_mktsegment, {T0}
  FROM customer
  UNION ALL SELECT 'dim_user_info', CAST(c_custkey AS VARCHAR), 'region_id',
         CAST(c_nationkey AS VARCHAR), {T0} FROM customer
  UNION ALL SELECT 'dim_user_info', CAST(c_custkey AS VARCHAR), 'login_name', upper(c_name), {TU}
  FROM customer WHERE c_acctbal < 0
  UNION ALL SELECT 'dim_user_info', CAST(c_custkey AS VARCHAR), 'region_id',
         CAST(c_nationkey AS VARCHAR), {TU} FROM customer WHERE c_acctbal < 0
  UNION ALL SELECT 'dim_base_organ', id, 'org_name', org_name, {T0} FROM organ
  UNION ALL SELECT 'dim_base_organ', id, 'org_parent_id', org_parent_id, {T0} FROM organ
      WHERE org_parent_id IS NOT NULL
  UNION ALL SELECT 'dim_base_organ', id, 'region_id', region_id, {T0} FROM organ
  UNION ALL SELECT 'dim_base_region_info', id, 'name', name, {T0} FROM region_info
  UNION ALL SELECT 'dim_base_region_info', id, 'parent_id', parent_id, {T0} FROM region_info
      WHERE parent_id IS NOT NULL
  UNION ALL SELECT 'dim_base_dic', id, 'name', name, {T0} FROM base_dic
  UNION ALL SELECT 'dim_truck_info', id, 'truck_model_id', truck_model_id, {T0} FROM truck_info
  UNION ALL SELECT 'dim_truck_model', id, 'model_name', model_name, {T0} FROM truck_model),
merged_cells AS (
  SELECT sink_table, row_key, "column", arg_max(value, ts) AS value
  FROM dim_cells GROUP BY 1, 2, 3)"""

DIM_CTES = (ORGAN, REGION_INFO, BASE_DIC, TRUCK_INFO, TRUCK_MODEL, ROUTED)


def q_dim_config_join() -> str:
    return with_(*DIM_CTES, body='SELECT "table", sink_table, sink_pk, id, ts FROM routed')


def q_dim_column_projection() -> str:
    return with_(*DIM_CTES, body="SELECT sink_table, id, ts, columns FROM routed")


def q_two_level_lookup() -> str:
    return with_(*DIM_CTES, body='SELECT "table", origin, count(*) AS n FROM routed GROUP BY 1, 2')


def q_config_fold() -> str:
    return with_(*LOG_CTES, body="""
SELECT f.source_table, f.sink_table, f.sink_columns, f.sink_pk,
       coalesce(c.n, 0) AS n_records
FROM (VALUES ('user_info', 'dim_user_info', 'id,login_name,region_id', 'id'),
             ('base_organ', 'dim_base_organ', 'id,org_name,org_parent_id,region_id', 'id'),
             ('base_region_info', 'dim_base_region_info', 'id,name,parent_id', 'id'),
             ('truck_info', 'dim_truck_info', 'truck_model_id', 'id'),
             ('truck_model', 'dim_truck_model', 'id,model_name', 'id'))
     AS f(source_table, sink_table, sink_columns, sink_pk)
LEFT JOIN (SELECT "table", count(*) AS n FROM clean_rows GROUP BY 1) c
  ON c."table" = f.source_table""")


def q_route_counts() -> str:
    return with_(*DIM_CTES, body="SELECT sink_table, count(*) AS n FROM routed GROUP BY 1")


def q_cells_exploded() -> str:
    return with_(*DIM_CTES, body='SELECT sink_table, row_key, "column", value, ts FROM dim_cells')


def q_cell_merge() -> str:
    return with_(*DIM_CTES, body='SELECT sink_table, row_key, "column", value FROM merged_cells')


def q_upsert_latest() -> str:
    return with_(*DIM_CTES, body="""
SELECT row_key AS id,
       max(CASE WHEN "column" = 'login_name' THEN value END) AS login_name,
       max(CASE WHEN "column" = 'user_level' THEN value END) AS user_level,
       max(CASE WHEN "column" = 'region_id' THEN value END) AS region_id
FROM merged_cells WHERE sink_table = 'dim_user_info' GROUP BY 1""")


def _dim_oracles() -> dict[str, str]:
    return {
        "dim_config_join": q_dim_config_join(),
        "dim_column_projection": q_dim_column_projection(),
        "config_two_level_lookup": q_two_level_lookup(),
        "config_changelog_fold": q_config_fold(),
        "dim_route_counts": q_route_counts(),
        "dim_cells_exploded": q_cells_exploded(),
        "dim_upsert_cell_merge": q_cell_merge(),
        "dim_upsert_latest": q_upsert_latest(),
    }


# ------------------------------------------------------------------------
# Transit facts, their aggregates, lookups and scalar functions
# ------------------------------------------------------------------------
def _plus_h(ts: str, h: int) -> str:
    return f"({ts} + INTERVAL {h} HOUR)"


def _bound_select(time_col: str, emp_col: str, hours: int, emp_prefix: str) -> str:
    t = _plus_h("l.l_shipdate", hours)
    return f"""
SELECT {CARGO_ID} AS id, CAST(l.l_orderkey AS VARCHAR) AS order_id,
       CAST(l.l_suppkey AS VARCHAR) AS org_id, {local_text(t)} AS {time_col},
       '{emp_prefix}' || CAST(l.l_suppkey AS VARCHAR) AS {emp_col}, {ms(t)} AS ts
FROM lineitem l"""


def q_bound_inbound() -> str:
    return _bound_select("inbound_time", "inbound_emp_id", 0, "E")


def q_bound_sort() -> str:
    return _bound_select("sort_time", "sorter_emp_id", 2, "S")


def q_bound_outbound() -> str:
    return _bound_select("outbound_time", "outbound_emp_id", 5, "O") + \
        " WHERE l.l_linestatus = 'F'"


TRANS_FINISH = f"""
finish AS (
  SELECT {CARGO_ID} AS id, 'SH' || CAST(l.l_linenumber AS VARCHAR) AS shift_id,
    'LN' || CAST(l.l_suppkey AS VARCHAR) AS line_id, CAST(l.l_suppkey AS VARCHAR) AS start_org_id,
    CAST(NULL AS VARCHAR) AS start_org_name, CAST(NULL AS VARCHAR) AS end_org_id,
    CAST(NULL AS VARCHAR) AS end_org_name, CAST(l.l_quantity AS INTEGER) AS order_num,
    'D' || CAST(l.l_suppkey AS VARCHAR) AS driver1_emp_id, CAST(NULL AS VARCHAR) AS driver1_name,
    CAST(NULL AS VARCHAR) AS driver2_emp_id, CAST(NULL AS VARCHAR) AS driver2_name,
    CAST(l.l_partkey AS VARCHAR) AS truck_id, 'TRK' || CAST(l.l_partkey AS VARCHAR) AS truck_no,
    {local_text('o.o_orderdate')} AS actual_start_time,
    {local_text('l.l_shipdate')} AS actual_end_time,
    {ms('l.l_shipdate')} - {ms('o.o_orderdate')} AS transport_time,
    CAST(l.l_extendedprice AS DECIMAL(16,2)) AS actual_distance,
    {ms('l.l_shipdate')} AS ts
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""


def q_trans_finish() -> str:
    return with_(TRANS_FINISH, body="SELECT * FROM finish")


ORG_GEO = """
LEFT JOIN organ og ON og.id = a.org_id
LEFT JOIN organ jo ON jo.id = coalesce(og.org_parent_id, a.org_id)
LEFT JOIN region_info ci ON ci.id = jo.region_id
LEFT JOIN region_info p ON p.id = ci.parent_id"""


def q_org_sort_day() -> str:
    return with_(ORGAN, REGION_INFO, f"\nsorts AS ({_bound_select('sort_time', 'sorter_emp_id', 2, 'S')})",
                 body=f"""
SELECT a.cur_date, a.org_id, og.org_name, jo.region_id AS city_id, ci.name AS city_name,
       p.id AS province_id, p.name AS province_name, a.sort_count_base, a.ts
FROM (SELECT {local_day('ts')} AS cur_date, org_id, count(*) AS sort_count_base, max(ts) AS ts
      FROM sorts GROUP BY 1, 2) a {ORG_GEO}""")


def q_truck_model_finish_day() -> str:
    return with_(ORGAN, REGION_INFO, TRUCK_INFO, TRUCK_MODEL, TRANS_FINISH, body=f"""
SELECT a.cur_date, a.org_id, og.org_name, a.truck_model_id, m.model_name AS truck_model_name,
       jo.region_id AS city_id, ci.name AS city_name, a.trans_finish_count_base,
       a.trans_finish_distance_base, a.trans_finish_dur_time_base, a.ts
FROM (SELECT {local_day('f.ts')} AS cur_date, f.start_org_id AS org_id, t.truck_model_id,
             count(*) AS trans_finish_count_base,
             CAST(sum(f.actual_distance) AS DECIMAL(38,2)) AS trans_finish_distance_base,
             CAST(sum(f.transport_time) AS BIGINT) AS trans_finish_dur_time_base,
             max(f.ts) AS ts
      FROM finish f LEFT JOIN truck_info t ON t.id = f.truck_id
      GROUP BY 1, 2, 3) a
LEFT JOIN truck_model m ON m.id = a.truck_model_id {ORG_GEO}""")


def q_dim_lookup_join() -> str:
    return with_(ORDER_ATTR, ORDER_CARGO, PLACE_FACTS, BASE_DIC, body="""
SELECT f.id, f.cargo_type, d.name AS cargo_type_name
FROM place_facts f LEFT JOIN base_dic d ON d.id = f.cargo_type""")


def q_dim_hierarchy_join() -> str:
    return with_(ORGAN, REGION_INFO, body=f"""
SELECT a.org_id, og.org_name, coalesce(og.org_parent_id, a.org_id) AS join_org_id,
       jo.region_id AS city_id, ci.name AS city_name, p.id AS province_id,
       p.name AS province_name
FROM (SELECT id AS org_id FROM organ) a {ORG_GEO}""")


def q_dim_fk_lookup() -> str:
    return with_(*DIM_CTES, body="""
SELECT m.sink_table, m.row_key AS id, m."column" AS fk_column, m.value AS fk_value,
       k.target_table, t.value AS target_name
FROM merged_cells m
JOIN (VALUES ('dim_user_info', 'region_id', 'dim_base_region_info', 'name'),
             ('dim_base_organ', 'org_parent_id', 'dim_base_organ', 'org_name'),
             ('dim_base_organ', 'region_id', 'dim_base_region_info', 'name'),
             ('dim_base_region_info', 'parent_id', 'dim_base_region_info', 'name'),
             ('dim_truck_info', 'truck_model_id', 'dim_truck_model', 'model_name'))
     AS k(sink_table, fk_column, target_table, name_column)
  ON m.sink_table = k.sink_table AND m."column" = k.fk_column
LEFT JOIN merged_cells t
  ON t.sink_table = k.target_table AND t.row_key = m.value AND t."column" = k.name_column""")


def q_dim_asof_lookup() -> str:
    return f"""
WITH e AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, user_id AS k,
         CAST(epoch_ms(ts) AS BIGINT) AS ts FROM events)
SELECT event_id, user_id,
       CASE WHEN ts >= {TU} AND c_acctbal < 0 THEN upper(c_name) WHEN ts >= {T0} THEN c_name END
         AS login_name,
       CASE WHEN ts >= {T0} THEN c_mktsegment END AS user_level,
       CASE WHEN ts >= {T0} THEN CAST(c_nationkey AS VARCHAR) END AS region_id
FROM e LEFT JOIN customer ON c_custkey = k"""


def q_dim_asof_intervals() -> str:
    return f"""
SELECT CAST(c_custkey AS VARCHAR) AS row_key, {T0} AS valid_from,
       CASE WHEN c_acctbal < 0 THEN {TU} END AS valid_to, c_name AS login_name,
       c_mktsegment AS user_level, CAST(c_nationkey AS VARCHAR) AS region_id
FROM customer
UNION ALL
SELECT CAST(c_custkey AS VARCHAR), {TU}, NULL, upper(c_name), c_mktsegment,
       CAST(c_nationkey AS VARCHAR)
FROM customer WHERE c_acctbal < 0"""


def q_fn_to_ts() -> str:
    return f"""
SELECT CAST(o_orderkey AS VARCHAR) AS id, {ms('o_orderdate')} - 28800000 AS full_ms,
       {ms("date_trunc('day', o_orderdate)")} - 28800000 AS date_ms
FROM orders"""


def q_fn_events(col: str, fmt: str) -> str:
    return f"""
SELECT event_id, strftime(epoch_ms({ms('ts')}) + INTERVAL 8 HOUR, '{fmt}') AS {col}
FROM events"""


def q_fn_iso_event_time() -> str:
    return with_(ORDER_CARGO, body=f"""
SELECT id, {iso_ms('create_time')} AS ts, {iso_local('create_time')} AS local_time
FROM order_cargo""")


def q_fn_estimate_arrive() -> str:
    return with_(ORDER_ATTR, body=f"""
SELECT id, {local_text('epoch_ms(estimate_arrive_time - 28800000)')} AS estimate_arrive_time
FROM order_attr""")


def _late_oracles() -> dict[str, str]:  # noqa: F811
    return {
        "dwd_bound_inbound": q_bound_inbound(),
        "dwd_bound_sort": q_bound_sort(),
        "dwd_bound_outbound": q_bound_outbound(),
        "dwd_trans_finish": q_trans_finish(),
        "dws_bound_org_sort_day": q_org_sort_day(),
        "dws_trans_org_truck_model_finish_day": q_truck_model_finish_day(),
        "dim_lookup_join": q_dim_lookup_join(),
        "dim_hierarchy_join": q_dim_hierarchy_join(),
        "dim_fk_lookup": q_dim_fk_lookup(),
        "dim_store_folded": q_cell_merge(),
        "dim_asof_lookup": q_dim_asof_lookup(),
        "dim_asof_intervals": q_dim_asof_intervals(),
        "fn_to_ts": q_fn_to_ts(),
        "fn_to_date": q_fn_events("d", "%Y-%m-%d"),
        "fn_to_partition_date": q_fn_events("dt", "%Y%m%d"),
        "fn_to_ymd_hms": q_fn_events("local_time", "%Y-%m-%d %H:%M:%S"),
        "fn_iso_event_time": q_fn_iso_event_time(),
        "fn_estimate_arrive": q_fn_estimate_arrive(),
    }
