"""A topic written at least once counts each record once downstream; the topic is a
folder of message files here, as no broker is at hand."""

import pytest
from pyspark.sql import functions as F

from parcelstream.operators import ods
from parcelstream.sources import changelog
from parcelstream.streaming import jobs

from conftest import SF_SMALL


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def consumed(spark, topic, scratch, name):
    raw = spark.readStream.schema("key string, value string, part int, offset long").option(
        "maxFilesPerTrigger", 1).parquet(topic).withColumn(
            "arrived", F.col("_metadata.file_modification_time"))
    out = ods.parse_ods_records(ods.once(raw, "arrived", "1 hour"))
    q = (out.select("part", "offset", "op", "ts", "table", ods.record_id(out).alias("id"))
         .writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", f"{scratch}/{name}").trigger(availableNow=True).start())
    q.awaitTermination(300)
    return spark.table(name)


def test_a_batch_killed_half_way_counts_once(spark, scratch):
    raw = changelog.dim_records(spark, SF_SMALL)
    raw.repartition(3).write.parquet(f"{scratch}/raw")
    s = jobs.StreamSettings(source_path=f"{scratch}/raw", max_files_per_trigger=1)
    topic, written = f"{scratch}/topic", []

    def write(batch):
        messages = batch.withColumns({"part": F.lit(0), "offset": F.monotonically_increasing_id()})
        written.append(messages.count())
        if len(written) == 2:      # the second batch: half of it, then the end
            messages.limit(written[-1] // 2).write.mode("append").parquet(topic)
            raise RuntimeError("killed")
        messages.write.mode("append").parquet(topic)

    def run():
        records = jobs.ods_records(ods.clean(jobs.read_raw(spark, s)), for_topic=True)
        q = (records.writeStream.option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True)
             .foreachBatch(jobs.topic_writer(write, f"{scratch}/ledger")).start())
        q.awaitTermination(300)

    with pytest.raises(Exception, match="killed"):
        run()
    run()
    want = ods.clean(raw)
    want = want.select("part", "offset", "op", "ts", "table", ods.record_id(want).alias("id"))
    assert spark.read.parquet(topic).count() > want.count()       # some were written twice
    got = consumed(spark, topic, scratch, "topic_once")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_a_batch_in_the_ledger_is_not_written_again(spark, scratch):
    written = []
    run = jobs.topic_writer(lambda batch: written.append(batch.count()), f"{scratch}/ledger")
    batch = spark.range(5)
    for batch_id in (0, 1, 1, 0, 2):
        run(batch, batch_id)
    assert written == [5, 5, 5]
