"""Sample configuration: the rows a start-up scan finds, and the change log that
follows it, as typed rows and as the captured JSON envelopes they come in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelstream import schemas
from parcelstream.operators.config_dim import parse_config_changes

DAY_MS = 86_400_000
SNAPSHOT_MS = 1704067200000              # dimension snapshot capture time
CONFIG_SNAPSHOT_MS = SNAPSHOT_MS + 3_600_000
CONFIG_CHANGE_MS = SNAPSHOT_MS + DAY_MS

# Initial configuration rows
# (source_table, sink_table, sink_family, sink_columns, sink_pk, foreign_keys).
CONFIG_ROWS = [
    ("user_info", "dim_user_info", "info", "id,login_name,user_level,region_id", "id",
     "region_id"),
    ("base_organ", "dim_base_organ", "", "id,org_name,org_parent_id,region_id", "id",
     "org_parent_id,region_id"),
    ("base_region_info", "dim_base_region_info", "info", "id,name,parent_id", "id", "parent_id"),
    ("base_dic", "dim_base_dic", "info", "id,name", "id", None),
    ("truck_info", "dim_truck_info", "info,ext", "truck_model_id", "id", "truck_model_id"),
    ("truck_model", "dim_truck_model", None, "id,model_name", "id", None),
]
# Configuration changes after start-up
# (op, ts, source_table, new row or None for a delete).
CONFIG_CHANGES = [
    ("u", CONFIG_CHANGE_MS, "user_info",
     ("user_info", "dim_user_info", "info", "id,login_name,region_id", "id", "region_id")),
    ("d", CONFIG_CHANGE_MS, "base_dic", None),
]

def config_table(spark: SparkSession) -> DataFrame:
    """The configuration table as the start-up scan reads it."""
    return spark.createDataFrame(CONFIG_ROWS, schemas.CONFIG)


def config_records(spark: SparkSession) -> DataFrame:
    """The captured configuration change log: the snapshot (``op='r'``) that the
    change stream delivers after start-up, then the later changes."""
    rows = [("r", CONFIG_SNAPSHOT_MS, i, None, r) for i, r in enumerate(CONFIG_ROWS)]
    old = {r[0]: r for r in CONFIG_ROWS}
    rows += [(op, ts, len(rows) + i, old[src], row)
             for i, (op, ts, src, row) in enumerate(CONFIG_CHANGES)]
    image = schemas.CONFIG.simpleString()
    df = spark.createDataFrame(
        rows, f"op string, ts_ms bigint, offset bigint, before {image}, after {image}")
    return df.select(F.lit(12).alias("part"), "offset", F.to_json(F.struct(
        "op", "ts_ms", "before", "after",
        F.struct(F.lit(schemas.CONFIG_TABLE).alias("table")).alias("source"))).alias("value"))


def config_changelog(spark: SparkSession) -> DataFrame:
    """The same, parsed: ``op, ts, part, seq, source_table, after``."""
    return parse_config_changes(config_records(spark))
