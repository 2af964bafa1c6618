"""Plan-shape checks that guard the scale properties of key queries."""

import contextlib
import io
import re

import __spark_entry__ as E
from parcelstream.operators import ods
from parcelstream.plans import catalog

from conftest import SF_SMALL


def plan_text(df, mode="simple") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_envelope_parsed_once_per_record(spark):
    p = plan_text(ods.clean(catalog.raw_log(spark, SF_SMALL)))
    assert p.count("from_json(") == 1


def test_dim_consumer_prunes_ods_partitions(spark):
    p = plan_text(E.queries()["dim_config_join"](spark, SF_SMALL))
    assert re.search(r"PartitionFilters: \[[^\]]*table", p)


def test_chained_scans_share_one_partitioning(spark):
    p = plan_text(E.queries()["order_cargo_interval_join"](spark, SF_SMALL))
    # the second scan's window sits on the first one's output, no exchange between
    lines = [ln.strip() for ln in p.splitlines()]
    windows = [i for i, ln in enumerate(lines) if ln.startswith("+- Window") or
               ln.startswith(":- Window") or ln.startswith(": +- Window") or "Window [" in ln]
    assert any("Window [" in lines[j] and not any("Exchange" in lines[k] for k in range(i + 1, j))
               for i, j in zip(windows, windows[1:]))


def test_scans_read_only_needed_columns(spark):
    p = plan_text(E.queries()["dws_trade_cargo_type_order_day"](spark, SF_SMALL))
    m = re.search(r"FileScan parquet \[([^\]]*)\][^\n]*lineitem", p)
    # the cargo id, sizes and weight are not used by this aggregate: not read
    assert m and set(c.split("#")[0] for c in m.group(1).split(",")) == {
        "l_orderkey", "l_partkey", "l_shipdate"}


def test_daily_aggregate_pre_aggregates_before_shuffle(spark):
    p = plan_text(E.queries()["dws_bound_org_sort_day"](spark, SF_SMALL))
    i_partial = p.find("partial_count")
    assert i_partial > 0 and p.find("Exchange hashpartitioning") < i_partial
