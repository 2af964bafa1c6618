"""Session policy: scale settings only fill gaps; checkpoint folder kept."""

from parcelstream.session import SCALE_CONF, configure_for_scale, ensure_checkpoint_dir


def test_configure_for_scale_keeps_local_partitions_and_fills_gaps(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    configure_for_scale(spark)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before   # local master
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == \
        SCALE_CONF["spark.sql.adaptive.advisoryPartitionSizeInBytes"]
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_checkpoint_dir_is_reused(spark):
    first = ensure_checkpoint_dir(spark)
    assert ensure_checkpoint_dir(spark) == first and first
