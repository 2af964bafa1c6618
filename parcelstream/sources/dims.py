"""Dimension tables derived from the given tables.

* ``base_region_info`` — nations (city level) under regions (province level)
* ``base_organ``       — one transit centre per nation (level 1) and one
  station per supplier under its nation's centre (level 2)
* ``base_dic``         — cargo type catalogue from ``part.p_type``
* ``truck_info``       — one truck per part, model = ``p_brand``
* ``truck_model``      — model catalogue from ``part.p_brand``
* ``user_info``        — customers

Catalogue tables built with ``distinct`` are aggregated map-side first, so
their cost is one partial aggregation of ``part``, not a full shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelstream.sources.tables import read


def _s(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def base_region_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    r = read(spark, sf_dir, "region", "r_regionkey", "r_name")
    cities = n.select(_s("n_nationkey").alias("id"), F.col("n_name").alias("name"),
                      F.concat(F.lit("R"), _s("n_regionkey")).alias("parent_id"))
    provinces = r.select(F.concat(F.lit("R"), _s("r_regionkey")).alias("id"),
                         F.col("r_name").alias("name"), F.lit(None).cast("string").alias("parent_id"))
    return cities.unionByName(provinces)


def base_organ(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "nation", "n_nationkey", "n_name")
    s = read(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey")
    centres = n.select(F.concat(F.lit("C"), _s("n_nationkey")).alias("id"),
                       F.concat(F.col("n_name"), F.lit(" centre")).alias("org_name"),
                       F.lit(None).cast("string").alias("org_parent_id"),
                       _s("n_nationkey").alias("region_id"))
    stations = s.select(_s("s_suppkey").alias("id"), F.col("s_name").alias("org_name"),
                        F.concat(F.lit("C"), _s("s_nationkey")).alias("org_parent_id"),
                        _s("s_nationkey").alias("region_id"))
    return centres.unionByName(stations)


def base_dic(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part", "p_type").distinct()
    return p.select(F.col("p_type").alias("id"), F.lower("p_type").alias("name"))


def truck_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part", "p_partkey", "p_brand")
    return p.select(_s("p_partkey").alias("id"), F.col("p_brand").alias("truck_model_id"))


def truck_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part", "p_brand").distinct()
    return p.select(F.col("p_brand").alias("id"), F.lower("p_brand").alias("model_name"))


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer", "c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    return c.select(_s("c_custkey").alias("id"), F.col("c_name").alias("login_name"),
                    F.col("c_mktsegment").alias("user_level"),
                    _s("c_nationkey").alias("region_id"))
