"""Transit facts: bound inbound / sort / outbound and transport finish.

Each fact is a filter on the change log plus a projection: inbound is the
creation of a bound row; sort, outbound and transport finish are the
updates whose time column goes from null to set.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelstream import schemas
from parcelstream.functions.timefn import DEFAULT_TZ, iso_to_millis, iso_to_local_text
from parcelstream.operators import ods


def became_set(col: str) -> Column:
    return (F.col("op") == "u") & F.col(f"before.{col}").isNull() & \
        F.col(f"after.{col}").isNotNull()


def _bound_fact(df: DataFrame, time_col: str, emp_col: str, tz: str) -> DataFrame:
    a = lambda n: F.col(f"after.{n}")
    return df.select(a("id").alias("id"), a("order_id").alias("order_id"),
                     a("org_id").alias("org_id"),
                     iso_to_local_text(a(time_col), tz).alias(time_col),
                     a(emp_col).alias(emp_col), iso_to_millis(a(time_col)).alias("ts"))


def bound_inbound(log: DataFrame, tz: str = DEFAULT_TZ) -> DataFrame:
    return _bound_fact(log.filter(F.col("op") == "c"), "inbound_time", "inbound_emp_id", tz)


def bound_sort(log: DataFrame, tz: str = DEFAULT_TZ) -> DataFrame:
    return _bound_fact(log.filter(became_set("sort_time")), "sort_time", "sorter_emp_id", tz)


def bound_outbound(log: DataFrame, tz: str = DEFAULT_TZ) -> DataFrame:
    return _bound_fact(log.filter(became_set("outbound_time")), "outbound_time",
                       "outbound_emp_id", tz)


TASK_OUT = ["id", "shift_id", "line_id", "start_org_id", "start_org_name", "end_org_id",
            "end_org_name", "order_num", "driver1_emp_id", "driver1_name", "driver2_emp_id",
            "driver2_name", "truck_id", "truck_no"]


def trans_finish(log: DataFrame, tz: str = DEFAULT_TZ) -> DataFrame:
    f = log.filter(became_set("actual_end_time"))
    a = lambda n: F.col(f"after.{n}")
    start_ms, end_ms = iso_to_millis(a("actual_start_time")), iso_to_millis(a("actual_end_time"))
    return f.select(*[a(n).alias(n) for n in TASK_OUT],
                    iso_to_local_text(a("actual_start_time"), tz).alias("actual_start_time"),
                    iso_to_local_text(a("actual_end_time"), tz).alias("actual_end_time"),
                    (end_ms - start_ms).alias("transport_time"),
                    a("actual_distance").alias("actual_distance"), end_ms.alias("ts"))


# The table that each fact's changes come from.
FACT_TABLE = {"dwd_bound_inbound": "order_org_bound", "dwd_bound_sort": "order_org_bound",
              "dwd_bound_outbound": "order_org_bound", "dwd_trans_finish": "transport_task"}


def typed_log(clean: DataFrame, table: str, before: Sequence[str] | None = None,
              after: Sequence[str] | None = None) -> DataFrame:
    """One table's clean change records with typed row images: op, before, after.
    ``before`` and ``after`` name the fields to decode, all by default."""
    schema = {"order_org_bound": schemas.ORDER_ORG_BOUND,
              "transport_task": schemas.TRANSPORT_TASK}[table]
    some = lambda names: schema if names is None else T.StructType([schema[n] for n in names])
    return clean.filter(F.col("table") == table).select(
        "op", ods.decode(F.col("before"), some(before)).alias("before"),
        ods.decode(F.col("after"), some(after)).alias("after"))


def sorts(clean: DataFrame) -> DataFrame:
    """What the daily sorts need of the sort facts: ``org_id, ts``."""
    log = typed_log(clean, "order_org_bound", ["sort_time"], ["org_id", "sort_time"])
    return log.filter(became_set("sort_time")).select(
        F.col("after.org_id").alias("org_id"), iso_to_millis(F.col("after.sort_time")).alias("ts"))


def finishes(clean: DataFrame) -> DataFrame:
    """What the daily transports need of the finish facts."""
    fields = ["start_org_id", "truck_id", "actual_start_time", "actual_end_time", "actual_distance"]
    log = typed_log(clean, "transport_task", ["actual_end_time"], fields)
    a = lambda n: F.col(f"after.{n}")
    end_ms = iso_to_millis(a("actual_end_time"))
    return log.filter(became_set("actual_end_time")).select(
        a("start_org_id").alias("start_org_id"), a("truck_id").alias("truck_id"),
        a("actual_distance").alias("actual_distance"),
        (end_ms - iso_to_millis(a("actual_start_time"))).alias("transport_time"), end_ms.alias("ts"))


# The fields that each fact reads of ``before`` and ``after``.  Fields that are no
# text stay among them: an image in which one can't be read is null as a whole.
FACT_FIELDS = {
    "dwd_bound_inbound": ((), ("id", "order_id", "org_id", "inbound_time", "inbound_emp_id")),
    "dwd_bound_sort": (("sort_time",), ("id", "order_id", "org_id", "sort_time", "sorter_emp_id")),
    "dwd_bound_outbound": (("outbound_time",),
                           ("id", "order_id", "org_id", "outbound_time", "outbound_emp_id")),
    "dwd_trans_finish": (("order_num", "actual_distance", "actual_end_time"),
                         (*TASK_OUT, "actual_start_time", "actual_end_time", "actual_distance")),
}


def fact_log(clean: DataFrame, fact: str) -> DataFrame:
    """The typed change records of a fact's table, with the fields that it reads."""
    before, after = FACT_FIELDS[fact]
    return typed_log(clean, FACT_TABLE[fact], before or ("id",), after)


def facts_of(clean: DataFrame, tz: str = DEFAULT_TZ) -> dict[str, DataFrame]:
    """The four facts from clean records (batch, or one micro-batch)."""
    make = {"dwd_bound_inbound": bound_inbound, "dwd_bound_sort": bound_sort,
            "dwd_bound_outbound": bound_outbound, "dwd_trans_finish": trans_finish}
    return {fact: make[fact](fact_log(clean, fact), tz) for fact in FACT_TABLE}
