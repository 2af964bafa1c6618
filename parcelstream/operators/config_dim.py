"""Configuration-driven dimension routing (DIM layer).

The configuration table says, per source table, which sink table receives
its rows, which columns are kept and which column is the row key.  It is
preloaded at start-up and then followed as a change log.  A dimension
record is routed by the configuration in force at its time:

    live state (config changes up to the record's time)  ->  else preload

A configuration delete removes the entry from both levels.  Records of
unconfigured tables are dropped (inner join).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelstream import schemas

CFG_FIELDS = [f.name for f in schemas.CONFIG.fields]


def read_config(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The configuration table as the start-up scan reads it; rows may carry
    ``row_no``, their place in the table."""
    df = spark.read.format(fmt).schema(
        T.StructType(schemas.CONFIG.fields + [T.StructField("row_no", T.LongType())])).load(path)
    return df


def parse_config_changes(records: DataFrame) -> DataFrame:
    """Captured configuration envelopes (``part, offset, value`` as JSON text) ->
    ``op, ts, part, seq, source_table, after`` (after null for a delete).  Records
    without a source table on either side are no configuration changes."""
    row = schemas.CONFIG.simpleString()
    e = F.from_json("value", f"op string, ts_ms bigint, before {row}, after {row}")
    r = records.select("part", "offset", e.alias("e"))
    return r.select(
        F.col("e.op").alias("op"), F.col("e.ts_ms").alias("ts"), "part",
        F.col("offset").alias("seq"),
        F.coalesce("e.after.source_table", "e.before.source_table").alias("source_table"),
        F.when(F.col("e.op") != "d", F.col("e.after")).alias("after")).filter(
            "source_table is not null")


def read_config_changes(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return parse_config_changes(
        spark.read.format(fmt).schema("part int, offset long, value string").load(path))


def preload(cfg: DataFrame) -> DataFrame:
    """Start-up scan keyed by ``source_table``: the row with the highest
    ``row_no`` wins (a table without that column must not repeat a key; should
    it, the greatest row wins, whatever files it came in)."""
    row = F.struct(*[F.col(c) for c in CFG_FIELDS])
    place = F.struct(F.col("row_no"), row) if "row_no" in cfg.columns else row
    return cfg.groupBy("source_table").agg(F.max_by(row, place).alias("r")).select("r.*")


def fold(changes: DataFrame) -> DataFrame:
    """Configuration state after the whole change log: latest change per
    ``source_table`` by ``(ts, seq)``; a final delete removes the entry."""
    last = changes.groupBy("source_table").agg(
        F.max_by(F.struct("op", "after"), F.struct("ts", "seq")).alias("last"))
    return last.filter(F.col("last.op") != "d").select("last.after.*")


def config_versions(spark: SparkSession, cfg: DataFrame, changes: DataFrame) -> DataFrame:
    """Configuration validity intervals per source table:
    ``source_table, valid_from, valid_to, origin, cfg`` (cfg null when the
    table is deleted).  The preload is valid from the beginning until the
    first live change of that table."""
    pre = cfg.select("source_table", F.lit(None).cast("long").alias("valid_from"),
                     F.lit("preload").alias("origin"),
                     F.struct(*[F.col(c) for c in CFG_FIELDS]).alias("cfg"),
                     F.lit(-1).cast("long").alias("seq"))
    live = changes.select("source_table", F.col("ts").alias("valid_from"),
                          F.lit("live").alias("origin"),
                          F.when(F.col("op") != "d", F.col("after")).alias("cfg"), "seq")
    allv = pre.unionByName(live)
    w = Window.partitionBy("source_table").orderBy(
        F.col("valid_from").asc_nulls_first(), "seq")
    return allv.withColumn("valid_to", F.lead("valid_from").over(w)).drop("seq")


def route(records: DataFrame, versions: DataFrame) -> DataFrame:
    """Attach the configuration in force at each record's ``ts`` (inner:
    unconfigured or deleted tables drop out).  Adds ``cfg`` and ``origin``.
    The join has no hint: from the sizes it measures, the planner broadcasts the
    configuration, or joins by table and splits a hot table's partition."""
    in_force = ((F.col("ts") >= F.coalesce(F.col("valid_from"), F.lit(-(1 << 62))))
                & (F.col("ts") < F.coalesce(F.col("valid_to"), F.lit(1 << 62))))
    v = versions.withColumnRenamed("source_table", "__src")
    j = records.join(v, (F.col("table") == F.col("__src")) & in_force)
    return j.filter(F.col("cfg").isNotNull()).drop("__src", "valid_from", "valid_to")


def row_map(after: Column) -> Column:
    """Generic row image: column name -> value text (exact numbers)."""
    return F.try_variant_get(after, "$", "map<string,string>")


def project_columns(m: Column, sink_columns: Column, sink_pk: Column) -> Column:
    """Keep the configured columns (split on ',', exact match) and always the
    row key, so a configuration that omits the key still routes."""
    cols = F.split(sink_columns, ",")
    return F.map_filter(m, lambda k, v: F.array_contains(cols, k) | (k == sink_pk))


def routed_rows(records: DataFrame, versions: DataFrame) -> DataFrame:
    """Routed dimension rows: ``part, offset, ts, table, origin, sink_table,
    sink_pk, row_key, columns, after_map`` and ``row`` (the projected map).

    ``row`` is only computed where it is selected (a map lambda runs
    interpreted); the cell path uses ``after_map`` + ``columns`` with plain,
    code-generated expressions instead."""
    r = route(records, versions)
    m = row_map(F.col("after"))
    return r.select(
        "part", "offset", "ts", "table", "origin",
        F.col("cfg.sink_table").alias("sink_table"), F.col("cfg.sink_pk").alias("sink_pk"),
        F.element_at(m, F.col("cfg.sink_pk")).alias("row_key"),
        F.split(F.col("cfg.sink_columns"), ",").alias("columns"),
        m.alias("after_map"),
        project_columns(m, F.col("cfg.sink_columns"), F.col("cfg.sink_pk")).alias("row"))


def table_plan(changes: DataFrame) -> DataFrame:
    """Create-if-absent plan from configuration snapshot/create rows: one row
    per (sink table, column family); an empty family means ``info``."""
    c = changes.filter(F.col("op").isin("r", "c"))
    fam = F.when(F.coalesce(F.col("after.sink_family"), F.lit("")) == "", F.lit("info")) \
        .otherwise(F.col("after.sink_family"))
    return c.select(F.col("after.sink_table").alias("sink_table"),
                    F.explode(F.split(fam, ",")).alias("family")).distinct()


def fk_columns(cfg: DataFrame) -> DataFrame:
    """Foreign-key columns declared per source table."""
    return cfg.filter(F.col("foreign_keys").isNotNull()).select(
        "source_table", "sink_table",
        F.explode(F.split("foreign_keys", ",")).alias("fk_column"))
