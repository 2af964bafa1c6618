"""Fixed record schemas of the change streams and of the declared outputs."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L = T.StringType(), T.IntegerType(), T.LongType()
MONEY = T.DecimalType(16, 2)


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Row images ("after"/"before") per source table.
ORDER_INFO = _struct(
    ("id", S), ("order_no", S), ("status", S), ("collect_type", S), ("user_id", S),
    ("receiver_complex_id", S), ("receiver_province_id", S), ("receiver_city_id", S),
    ("receiver_district_id", S), ("receiver_name", S),
    ("sender_complex_id", S), ("sender_province_id", S), ("sender_city_id", S),
    ("sender_district_id", S), ("sender_name", S),
    ("payment_type", S), ("cargo_num", I), ("amount", MONEY), ("estimate_arrive_time", L),
    ("distance", MONEY), ("create_time", S), ("update_time", S), ("is_deleted", S),
)

ORDER_CARGO = _struct(
    ("id", S), ("order_id", S), ("cargo_type", S),
    ("volumn_length", I), ("volumn_width", I), ("volumn_height", I),
    ("weight", MONEY), ("create_time", S), ("update_time", S), ("is_deleted", S),
)

ORDER_ORG_BOUND = _struct(*[(n, S) for n in (
    "id", "order_id", "org_id", "status", "inbound_time", "inbound_emp_id", "sort_time",
    "sorter_emp_id", "outbound_time", "outbound_emp_id", "create_time", "update_time",
    "is_deleted")])

TRANSPORT_TASK = _struct(
    ("id", S), ("shift_id", S), ("line_id", S), ("start_org_id", S), ("start_org_name", S),
    ("end_org_id", S), ("end_org_name", S), ("order_num", I),
    ("driver1_emp_id", S), ("driver1_name", S), ("driver2_emp_id", S), ("driver2_name", S),
    ("truck_id", S), ("truck_no", S), ("actual_start_time", S), ("actual_end_time", S),
    ("actual_distance", MONEY),
)

CONFIG = _struct(("source_table", S), ("sink_table", S), ("sink_family", S),
                 ("sink_columns", S), ("sink_pk", S), ("foreign_keys", S))

# The captured configuration table's name; pass the deployment's own name to
# ``ods.table_group`` where it differs.
CONFIG_TABLE = "dim_config"

# Table groups a change-log reader selects.
TABLE_GROUPS = {
    "dwd": ("order_info", "order_cargo", "transport_task", "order_org_bound"),
    "realtime_dim": ("user_info", "user_address", "base_complex", "base_dic",
                     "base_region_info", "base_organ", "express_courier",
                     "express_courier_complex", "employee_info", "line_base_shift",
                     "line_base_info", "truck_driver", "truck_info", "truck_model",
                     "truck_team"),
    "config_dim": (CONFIG_TABLE,),
}

# Order status codes and the transitions that produce facts.
ST_CREATED, ST_PAID, ST_RECEIVED, ST_DISPATCH_WAIT, ST_DISPATCHED = (
    "60010", "60020", "60030", "60040", "60050")
ST_BOUND_DONE, ST_DELIVERED, ST_SIGNED, ST_CANCELLED = "60060", "60070", "60080", "60999"
STATUS_CODES = ("60010", "60020", "60030", "60040", "60050", "60060", "60070", "60080",
                "60999")
# transition label -> (fact output name, event-time column)
TRANSITION_FACTS = {
    "60010 -> 60020": ("dwd_trade_pay_suc_detail", "pay_time"),
    "60020 -> 60030": ("dwd_trans_receive_detail", "receive_time"),
    "60040 -> 60050": ("dwd_trans_dispatch_detail", "dispatch_time"),
    "60050 -> 60060": ("dwd_trans_bound_finish_detail", "bound_finish_time"),
    "60060 -> 60070": ("dwd_trans_deliver_detail", "deliver_time"),
    "60070 -> 60080": ("dwd_trans_sign_detail", "sign_time"),
}
CANCEL_FACT = ("dwd_trade_cancel_detail", "cancel_time")
PLACE_FACT = ("dwd_trade_order_detail", "order_time")
