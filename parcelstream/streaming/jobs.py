"""Streaming jobs: the batch functions applied to unbounded inputs.

* ODS:  captured records -> clean -> keyed records, exactly-once via the
  checkpointed file sink (or a Kafka topic when the connector is present).
* DIM:  clean dimension records -> ``foreachBatch``: the configuration's state is
  refreshed every micro-batch (live configuration), new tables are created, rows
  are routed and projected, and the batch's cells are appended to the store (a
  replay replaces the batch); older batches are folded, readers merge cell-wise.
* DWD:  clean order/cargo records -> per-order state -> one output per fact.

Source and sink formats are settings: ``parquet``/``json``/``text`` files
for tests, ``kafka`` on a cluster that ships the connector (not part of
this environment, so that path is untested here).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelstream.operators import config_dim, dim_store, dim_tables, ods, transit
from parcelstream.operators.upsert_store import Files
from parcelstream.streaming import handover, order_state

RAW_DDL = "part int, offset long, value string"


@dataclass
class StreamSettings:
    source_format: str = "parquet"
    source_path: str | None = None
    kafka_servers: str | None = None      # one field for source and sink
    topic: str = "ods_changes"            # raw records; the clean ones go to ``clean_topic``
    start_mode: str = "latest"            # or "initial": what is already there, then changes;
    #                                       files also "snapshot": rows as they stand, then changes
    trigger_seconds: int = 6              # reference checkpoint interval
    max_files_per_trigger: int | None = None
    options: dict = field(default_factory=dict)
    exact_numbers: bool = False           # row images keep the text of their numbers

    @property
    def clean_topic(self) -> str:
        """Where ODS writes and DIM and DWD read."""
        return f"{self.topic}_clean"

    @property
    def starting_offsets(self) -> str:
        return {"latest": "latest", "initial": "earliest", "snapshot": "earliest"}[self.start_mode]

    @property
    def handover(self) -> str:
        """The start mode of a file source."""
        return {"initial": "earliest"}.get(self.start_mode, self.start_mode)


def read_raw(spark: SparkSession, s: StreamSettings, topic: str | None = None,
             with_time: bool = False) -> DataFrame:
    """Captured records as a stream of ``part, offset, value`` (and the topic's own
    ``timestamp``)."""
    if s.source_format == "kafka":
        df = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", s.kafka_servers)
              .option("subscribe", topic or s.topic)
              .option("startingOffsets", s.starting_offsets)
              .options(**s.options).load())
        return df.select(F.col("partition").alias("part"), "offset",
                         F.col("value").cast("string").alias("value"),
                         *(["timestamp"] if with_time else []))
    reader = spark.readStream.format(s.source_format).schema(RAW_DDL)
    if s.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", s.max_files_per_trigger)
    return reader.options(**s.options).load(s.source_path)


def read_started(spark: SparkSession, s: StreamSettings, root: str) -> DataFrame:
    """Captured records from where the start mode says; ``root`` keeps the positions
    (and the snapshot) of the first start.  A topic has offsets of its own."""
    if s.source_format == "kafka" and s.start_mode != "snapshot":
        return read_raw(spark, s)

    def log() -> DataFrame:
        if s.source_format == "kafka":
            df = (spark.read.format("kafka").option("kafka.bootstrap.servers", s.kafka_servers)
                  .option("subscribe", s.topic).options(**s.options).load())
            return df.select(F.col("partition").alias("part"), "offset",
                             F.col("value").cast("string").alias("value"))
        return spark.read.format(s.source_format).schema(RAW_DDL).options(**s.options).load(s.source_path)

    return handover.stream(spark, read_raw(spark, s), log, s.handover, root)


def ods_records(clean: DataFrame, for_topic: bool) -> DataFrame:
    """Sink records.  A topic partitions by key, and one writer a key and
    micro-batch keeps a key's records together; consumers order by time and
    position.  A file sink keeps the source position and the table, by which it
    is partitioned, so a consumer reads its own tables only."""
    if for_topic:
        return ods.sink_record(clean.repartition(ods.record_id(clean)), position_in_value=True)
    return ods.sink_record(clean, with_position=True, with_table=True)


def topic_writer(write, ledger: str):
    """``foreachBatch`` body of a topic sink.  A batch that the ledger lists has been
    written whole and is not written again; one that was cut off is, and its consumers
    take each source position once (:func:`ods.once`), so every record counts once."""
    def run(batch: DataFrame, batch_id: int) -> None:
        files = Files(batch.sparkSession, ledger)
        if not files.exists(f"batch={batch_id}"):
            write(batch)
            files.write(f"batch={batch_id}", "written")
    return run


def ods_query(spark: SparkSession, s: StreamSettings, sink_path: str, checkpoint: str,
              available_now: bool = False, start_root: str | None = None):
    """``start_root``: where the first start is recorded, for start modes other than
    reading everything."""
    raw = read_started(spark, s, start_root) if start_root else read_raw(spark, s)
    records = ods_records(ods.clean(raw, s.exact_numbers),
                          for_topic=s.source_format == "kafka")
    w = records.writeStream.option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else \
        w.trigger(processingTime=f"{s.trigger_seconds} seconds")
    if s.source_format == "kafka":
        def write(batch: DataFrame) -> None:
            (batch.write.format("kafka").option("kafka.bootstrap.servers", s.kafka_servers)
             .option("topic", s.clean_topic).save())
        return w.foreachBatch(topic_writer(write, f"{checkpoint.rstrip('/')}_ledger")).start()
    return w.format("parquet").option("path", sink_path).partitionBy("table").start()


def ods_quarantine_query(spark: SparkSession, s: StreamSettings, path: str, checkpoint: str,
                         available_now: bool = False, start_root: str | None = None):
    """What :func:`ods_query` doesn't forward, with the reason: a consumer of
    its own with its own checkpoint, so either can be restarted alone."""
    raw = read_started(spark, s, start_root) if start_root else read_raw(spark, s)
    w = ods.quarantine(raw).writeStream.option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else \
        w.trigger(processingTime=f"{s.trigger_seconds} seconds")
    return w.format("parquet").option("path", path).start()


def dim_batch_writer(spark: SparkSession, store_root: str, config_fn, config_changes_fn,
                     fold_every: int = 50, database: str | None = None):
    """``foreachBatch`` body of the DIM job: the configuration as it is now creates the
    tables that are new (given a ``database``), routes each record by the one in force
    at its time, and the batch's cells are appended.  Every ``fold_every`` batches those
    before are folded (they can't be replayed any more) and the tables are published."""
    def run(batch: DataFrame, batch_id: int) -> None:
        config, changes = config_dim.preload(config_fn()), config_changes_fn()
        if database:
            named = config.select("source_table", "sink_table", "sink_family").unionByName(
                changes.filter("after is not null").select(
                    "source_table", "after.sink_table", "after.sink_family"))
            dim_tables.create(spark, named, store_root, database)
        versions = config_dim.config_versions(spark, config, changes)
        dims_ = ods.table_group(batch, "realtime_dim")
        dim_store.append_cells(dim_store.cells(config_dim.routed_rows(dims_, versions)),
                               store_root, batch_id)
        if batch_id and batch_id % fold_every == 0:
            done = dim_store.fold(spark, store_root, upto=batch_id - 1)
            for table in done.base if database else ():
                dim_tables.publish(spark, store_root, table, database)
    return run


def dim_query(spark: SparkSession, clean_stream: DataFrame, store_root: str, checkpoint: str,
              config_fn, config_changes_fn, available_now: bool = False, fold_every: int = 50,
              database: str | None = None):
    w = clean_stream.writeStream.option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="6 seconds")
    return w.foreachBatch(dim_batch_writer(spark, store_root, config_fn, config_changes_fn,
                                           fold_every, database)).start()


def dwd_query(order_log_stream: DataFrame, checkpoint: str, query_name: str,
              window_ms: int = 5000, time_mode: str = "EventTime",
              watermark: str | None = None):
    """Per-order state over a clean order change-log stream; the raw
    processor output goes to a memory table (tests) — facts are typed with
    :func:`order_state.facts_from_output`."""
    out = order_state.apply_state(order_state.stream_input(order_log_stream), window_ms,
                                  watermark, time_mode)
    return (out.writeStream.format("memory").queryName(query_name)
            .option("checkpointLocation", checkpoint).outputMode("append").start())


def dwd_facts_writer(root: str):
    """``foreachBatch`` body splitting the processor output into one table
    per fact (and the quarantine).  The batch is persisted once and read by
    every output that has rows in it (none for an empty one); each is written under ``batch=<id>`` with
    overwrite, so a replayed batch replaces its own files."""
    from parcelstream.operators import orders as _orders

    facts = [order_state.PLACE] + list(_orders.FACT_TIME)
    rejected = [order_state.NO_DETAIL, order_state.NO_BEFORE, order_state.EXPIRED]

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            found = {r["route"] for r in batch.select("route").distinct().collect()}  # ten at most
            path = f"{root.rstrip('/')}/{{}}/batch={batch_id}"
            for fact in facts:
                if fact in found:
                    order_state.facts_from_output(batch, fact).write.mode("overwrite").parquet(
                        path.format(fact))
            if found & set(rejected):
                batch.filter(F.col("route").isin(rejected)).write.mode("overwrite").parquet(
                    path.format("quarantine"))
        finally:
            batch.unpersist()
    return run


def dwd_facts_query(order_log_stream: DataFrame, root: str, checkpoint: str,
                    window_ms: int = 5000, available_now: bool = True,
                    watermark: str | None = None):
    out = order_state.apply_state(order_state.stream_input(order_log_stream), window_ms, watermark)
    w = out.writeStream.option("checkpointLocation", checkpoint).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="6 seconds")
    return w.foreachBatch(dwd_facts_writer(root)).start()


def transit_writer(root: str):
    """``foreachBatch`` body: bound and transport facts of a batch of clean
    records, one table per fact, under ``batch=<id>`` with overwrite."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()   # read and parsed once for the four facts
        try:
            for fact, rows in transit.facts_of(batch).items():
                if not rows.isEmpty():
                    rows.write.mode("overwrite").parquet(
                        f"{root.rstrip('/')}/{fact}/batch={batch_id}")
        finally:
            batch.unpersist()
    return run


def transit_query(clean_stream: DataFrame, root: str, checkpoint: str,
                  available_now: bool = False, trigger_seconds: int = 6):
    rows = ods.table_group(clean_stream, "dwd").filter(
        F.col("table").isin("order_org_bound", "transport_task"))
    w = rows.writeStream.option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else \
        w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.foreachBatch(transit_writer(root)).start()


def rejects_query(clean_stream: DataFrame, path: str, checkpoint: str,
                  available_now: bool = False, trigger_seconds: int = 6):
    """Order and cargo records that have no key for the per-order state."""
    w = order_state.order_log_rejects(clean_stream).writeStream.option(
        "checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else \
        w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.format("parquet").option("path", path).start()
