"""The configuration's live state, kept up by its own small stream.

Each refresh reads the part of the captured configuration log that is new since the
last one (the file source's own record of files read) and folds it into the state
stored beside the dimension store.  The state holds, for every source table, the
changes of the last ``keep_ms`` and the one in force before them, so that records
up to that much late are routed by the configuration of their time; neither the
state nor what a refresh reads grows with the history of the log.

A state is published by a rename, under the id of the batch that made it from the
state before; a batch repeated after a crash makes the same state again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelstream import schemas
from parcelstream.operators import config_dim
from parcelstream.operators.upsert_store import Files

STATE_DDL = (f"op string, ts bigint, part int, seq bigint, source_table string, "
             f"after {schemas.CONFIG.simpleString()}")
DAY_MS = 86_400_000


def pruned(changes: DataFrame, keep_ms: int | None) -> DataFrame:
    """The changes of the last ``keep_ms`` before the newest one, and of each table
    the last change before those; all of them where ``keep_ms`` is None."""
    if keep_ms is None:
        return changes
    newest = changes.agg(F.max("ts")).first()[0]
    recent = F.col("ts") > F.lit(newest) - keep_ms
    older = changes.filter(~recent).groupBy("source_table").agg(F.max_by(
        F.struct(*changes.columns), F.struct("ts", "seq", "part")).alias("m")).select("m.*")
    return changes.filter(recent).unionByName(older)


def _batches(files: Files) -> list[int]:
    return sorted(int(n.split("=", 1)[1]) for n in files.names("state") if n.startswith("batch="))


def _read(spark: SparkSession, files: Files, batch: int | None) -> DataFrame:
    if batch is None:
        return spark.createDataFrame([], STATE_DDL)
    schema = spark.createDataFrame([], STATE_DDL).schema
    return spark.read.schema(schema).parquet(f"{files.root}/state/batch={batch}")


def apply(batch: DataFrame, batch_id: int, root: str, keep_ms: int | None) -> None:
    """``foreachBatch`` body: the state after this batch of captured records."""
    spark = batch.sparkSession
    files = Files(spark, root)
    before = [b for b in _batches(files) if b < batch_id]
    old = _read(spark, files, before[-1] if before else None)
    new = config_dim.parse_config_changes(batch).select(*old.columns)
    aside = f"aside/{uuid.uuid4().hex}"
    # At most a row a change in the window: one small file.
    pruned(old.unionByName(new).distinct(), keep_ms).coalesce(1).write.parquet(f"{files.root}/{aside}")
    files.remove(f"state/batch={batch_id}")
    files.move(aside, f"state/batch={batch_id}")
    for b in before[:-1]:   # readers of the state before may still be at work
        files.remove(f"state/batch={b}")


def refresh(spark: SparkSession, log_path: str, root: str, fmt: str = "parquet",
            keep_ms: int | None = 7 * DAY_MS) -> DataFrame:
    """The configuration changes in the state, after all that the log holds now:
    ``op, ts, part, seq, source_table, after``."""
    log = spark.readStream.format(fmt).schema("part int, offset long, value string").load(log_path)
    q = (log.writeStream.option("checkpointLocation", f"{root.rstrip('/')}/checkpoint")
         .trigger(availableNow=True)
         .foreachBatch(lambda batch, batch_id: apply(batch, batch_id, root, keep_ms)).start())
    q.awaitTermination()
    return changes(spark, root)


def changes(spark: SparkSession, root: str) -> DataFrame:
    """The state as it stands."""
    files = Files(spark, root)
    done = _batches(files)
    return _read(spark, files, done[-1] if done else None)
