"""Dimension lookups (the declared ``DimJoinFunction`` surface).

A lookup is a left equi-join of a fact (or an aggregate) with a dimension
on one key column.  No broadcast is forced: Catalyst broadcasts a side whose
estimated size is under ``spark.sql.autoBroadcastJoinThreshold`` and AQE
re-plans to a broadcast at run time from the real size, otherwise the join
stays a sort-merge join — the dimension never has to fit in memory.
Lookups run after aggregation wherever the grain allows, so they touch one
row per group instead of one per fact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelstream.operators.keyed_scan import BUCKET, asof_last


def dim_lookup(fact: DataFrame, key_col: str, dim: DataFrame, dim_key: str,
               attrs: dict[str, str]) -> DataFrame:
    """``fact LEFT JOIN dim ON fact[key_col] = dim[dim_key]`` adding
    ``attrs`` (dim column -> output name)."""
    d = dim.select(F.col(dim_key).alias("__dk"),
                   *[F.col(src).alias(dst) for src, dst in attrs.items()])
    return fact.join(d, fact[key_col] == d["__dk"], "left").drop("__dk")


def org_city_province(fact: DataFrame, org_col: str, organ: DataFrame, region: DataFrame,
                      prefix: str = "") -> DataFrame:
    """Org -> org name, the org used for geography (its parent transit centre
    for a station, itself for a centre) -> city -> province."""
    fact = dim_lookup(fact, org_col, organ, "id",
                      {"org_name": f"{prefix}org_name", "org_parent_id": "__parent"})
    fact = fact.withColumn(f"{prefix}join_org_id", F.coalesce(F.col("__parent"), F.col(org_col)))
    fact = dim_lookup(fact.drop("__parent"), f"{prefix}join_org_id", organ, "id",
                      {"region_id": "__city"})
    return city_province(fact, "__city", region, prefix).drop("__city")


def city_province(fact: DataFrame, city_col: str, region: DataFrame, prefix: str = "") -> DataFrame:
    """City id -> city name, parent province id and name (self-join of the
    region hierarchy)."""
    fact = fact.withColumn(f"{prefix}city_id", F.col(city_col))
    fact = dim_lookup(fact, f"{prefix}city_id", region, "id",
                      {"name": f"{prefix}city_name", "parent_id": f"{prefix}province_id"})
    return dim_lookup(fact, f"{prefix}province_id", region, "id",
                      {"name": f"{prefix}province_name"})


def centre_of_district(fact: DataFrame, district_col: str, organ: DataFrame,
                       out: str = "org_id") -> DataFrame:
    """District -> the level-1 organisation (transit centre) serving it.  Should
    several serve one, the smallest id stands for the district, so that a
    measure is never counted twice."""
    centres = organ.filter(F.col("org_parent_id").isNull()).groupBy("region_id").agg(
        F.min("id").alias("id"))
    return dim_lookup(fact, district_col, centres, "region_id", {"id": out})


# The dimension that a declared key points to, and the column by
# which that dimension's rows are named.
KEY_TARGETS = {"region_id": "dim_base_region_info", "parent_id": "dim_base_region_info",
               "org_parent_id": "dim_base_organ", "truck_model_id": "dim_truck_model"}
NAME_COLUMNS = {"dim_base_region_info": "name", "dim_base_organ": "org_name",
                "dim_truck_model": "model_name"}


def declared_keys(cells: DataFrame, keys: DataFrame, targets: dict[str, str] | None = None,
                  names: dict[str, str] | None = None) -> DataFrame:
    """Lookup through all declared foreign keys at once: merged ``cells`` of all
    dimensions and ``keys(sink_table, fk_column)`` -> ``sink_table, id,
    fk_column, fk_value, target_table, target_name`` (null where the target row
    or its name is missing).  The declared columns are cells like any other, so
    one join picks them and one finds their targets, however many there are."""
    spark = cells.sparkSession
    pair = lambda d, a, b: spark.createDataFrame(sorted(d.items()), f"{a} string, {b} string")
    declared = keys.select("sink_table", F.trim("fk_column").alias("column")).distinct()
    declared = declared.join(pair(targets or KEY_TARGETS, "column", "target_table"), "column", "left")
    refs = cells.join(declared, ["sink_table", "column"]).select(
        "sink_table", F.col("row_key").alias("id"), F.col("column").alias("fk_column"),
        F.col("value").alias("fk_value"), "target_table")
    named = cells.join(pair(names or NAME_COLUMNS, "sink_table", "column"), ["sink_table", "column"])
    named = named.select(F.col("sink_table").alias("target_table"), F.col("row_key").alias("fk_value"),
                         F.col("value").alias("target_name"))
    return refs.join(named, ["target_table", "fk_value"], "left").select(
        "sink_table", "id", "fk_column", "fk_value", "target_table", "target_name")


# ------------------------------------------------ lookups at a point in time --
def puts(history: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cell versions of one dimension -> one row a put: ``row_key, ts, part,
    offset`` and the columns it carried (null: not carried)."""
    return history.filter(F.col("column").isin(*columns)).groupBy(
        "row_key", "ts", "part", "offset").agg(
        *[F.max(F.when(F.col("column") == c, F.col("value"))).alias(c) for c in columns])


def as_of(fact: DataFrame, key_col: str, ts_col: str, history: DataFrame,
          attrs: dict[str, str], bucket_ms: int | None = None) -> DataFrame:
    """``fact`` with the attributes of its dimension row as they stood at the
    fact's own time: for each column the value of the last put at or before it
    that carried the column.  ``attrs``: dimension column -> output name.

    Facts and puts go through one scan per key, cut into time slices, so a key
    that a third of all facts name is spread like any other (no interval join).
    A fact without key or time, or before the first put, gets nulls."""
    cols = list(attrs)
    row = F.struct(*[F.col(f"`{c}`") for c in fact.columns])
    none = lambda c, t: F.lit(None).cast(t).alias(c)
    asks = fact.select(
        F.col(f"`{key_col}`").cast("string").alias("__k"), F.col(f"`{ts_col}`").cast("long").alias("__t"),
        F.lit(1).alias("__side"), none("part", "int"), none("offset", "long"), row.alias("__row"),
        *[none(f"__p{i}", "string") for i in range(len(cols))])
    told = puts(history, cols).select(
        F.col("row_key").alias("__k"), F.col("ts").alias("__t"), F.lit(0).alias("__side"), "part",
        "offset", F.lit(None).cast(asks.schema["__row"].dataType).alias("__row"),
        *[F.col(f"`{c}`").alias(f"__p{i}") for i, c in enumerate(cols)])
    known = F.col("__k").isNotNull() & F.col("__t").isNotNull()
    scanned = asof_last(told.unionByName(asks.filter(known)), "__k",
                        ["__t", "__side", "part", "offset"],
                        {f"__a{i}": F.col(f"__p{i}") for i in range(len(cols))}, bucket_ms=bucket_ms)
    found = scanned.filter("__side = 1").select(
        "__row.*", *[F.col(f"__a{i}").alias(attrs[c]) for i, c in enumerate(cols)])
    lone = asks.filter(~known).select("__row.*", *[none(attrs[c], "string") for c in cols])
    return found.unionByName(lone)


def validity(history: DataFrame, columns: Sequence[str], bucket_ms: int | None = None) -> DataFrame:
    """Validity intervals of a dimension: ``row_key, valid_from, valid_to`` (null:
    until now) and its columns as they stood in between."""
    last = history.filter(F.col("column").isin(*columns)).groupBy("row_key", "ts", "column").agg(
        F.max_by("value", F.struct("part", "offset")).alias("value"))
    at = last.groupBy("row_key", "ts").agg(
        *[F.max(F.when(F.col("column") == c, F.col("value"))).alias(f"__p{i}")
          for i, c in enumerate(columns)])
    rows = asof_last(at, "row_key", ["ts"], {c: F.col(f"__p{i}") for i, c in enumerate(columns)},
                     inclusive=True, bucket_ms=bucket_ms, keep_bucket=True).drop(BUCKET)
    # The next change is the last one before in reversed time.
    rows = asof_last(rows.withColumn("__back", -F.col("ts")), "row_key", ["__back"],
                     {"valid_to": F.col("ts")}, bucket_ms=bucket_ms)
    return rows.select("row_key", F.col("ts").alias("valid_from"), "valid_to",
                       *[F.col(f"`{c}`") for c in columns])


def as_of_intervals(fact: DataFrame, key_col: str, ts_col: str, intervals: DataFrame,
                    attrs: dict[str, str]) -> DataFrame:
    """The stream-static form of :func:`as_of`: a stream of facts against stored
    validity intervals (one row of a key matches a time, so nothing multiplies)."""
    d = intervals.select(F.col("row_key").alias("__k"), F.col("valid_from").alias("__f"),
                         F.col("valid_to").alias("__u"),
                         *[F.col(f"`{c}`").alias(out) for c, out in attrs.items()])
    when = (fact[key_col].cast("string") == d["__k"]) & (fact[ts_col] >= d["__f"]) & (
        d["__u"].isNull() | (fact[ts_col] < d["__u"]))
    return fact.join(d, when, "left").drop("__k", "__f", "__u")
