"""Tables created from the configuration, before and with data."""

import uuid

import pytest
from pyspark.sql import functions as F

from parcelstream.operators import dim_store, dim_tables
from parcelstream.sources import changelog
from parcelstream.sources import config as config_src
from parcelstream.streaming import jobs

from conftest import SF_SMALL


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture()
def database(spark):
    name = f"dims_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name}")
    return name


def rows(spark, *data):
    return spark.createDataFrame(data, "source_table string, sink_table string, sink_family string")


def test_a_new_configuration_row_makes_a_readable_empty_table(spark, scratch, database):
    first = rows(spark, ("a", "dim_a", "info,ext"), ("b", "dim_b", ""), ("c", "dim_c", None))
    assert dim_tables.create(spark, first, scratch, database) == ["dim_a", "dim_b", "dim_c"]
    assert spark.table(f"{database}.dim_a").columns == ["row_key", "info", "ext"]
    assert spark.table(f"{database}.dim_b").columns == spark.table(f"{database}.dim_c").columns == [
        "row_key", "info"]
    assert spark.table(f"{database}.dim_a").count() == 0
    dim_tables.publish(spark, scratch, "dim_a", database)        # nothing stored yet
    assert spark.table(f"{database}.dim_a").count() == 0


def test_replay_leaves_tables_and_rows_alone(spark, scratch, database):
    config = rows(spark, ("a", "dim_a", "info,ext"))
    dim_tables.create(spark, config, scratch, database)
    cells = spark.createDataFrame([("dim_a", "1", "x", "v", 1, 0, 1), ("dim_a", "1", "y", "w", 1, 0, 2),
                                   ("dim_a", "2", "x", "u", 1, 0, 3)], dim_store.CELL_DDL)
    dim_store.append_cells(cells, scratch, 0)
    for _ in range(2):
        dim_tables.publish(spark, scratch, "dim_a", database)
        assert dim_tables.create(spark, config, scratch, database) == []
        got = {r.row_key: (r.info, r.ext) for r in spark.table(f"{database}.dim_a").collect()}
        assert got == {"1": ({"x": "v", "y": "w"}, {}), "2": ({"x": "u"}, {})}
    spark.sql(f"DROP TABLE {database}.dim_a")      # another session's catalog: same files
    assert dim_tables.create(spark, config, scratch, database) == ["dim_a"]
    assert spark.table(f"{database}.dim_a").count() == 2


def test_several_sources_of_one_table_and_bad_names(spark, scratch, database):
    both = rows(spark, ("a", "dim_x", "f1"), ("b", "dim_x", "f2,f1"))
    dim_tables.create(spark, both, scratch, database)
    assert spark.table(f"{database}.dim_x").columns == ["row_key", "f1", "f2"]
    for bad in (("a", "dim x; drop", "f"), ("a", "dim_y", "f`g")):
        with pytest.raises(ValueError):
            dim_tables.create(spark, rows(spark, bad), scratch, database)


def test_the_job_creates_folds_and_publishes(spark, scratch, database):
    """The DIM writer over four batches: tables from the first one on, folded and
    published on the way, the current state in the store throughout."""
    from parcelstream.operators import ods, upsert_store
    clean = ods.clean(changelog.dim_records(spark, SF_SMALL)).cache()
    write = jobs.dim_batch_writer(spark, scratch, lambda: config_src.config_table(spark),
                                  lambda: config_src.config_changelog(spark), fold_every=3,
                                  database=database)
    write(clean.limit(0), 0)
    assert spark.table(f"{database}.dim_user_info").count() == 0
    parts = F.pmod(F.hash("part", "offset"), F.lit(4))
    for i in range(4):
        write(clean.filter(parts == i), i + 1)
    assert upsert_store.manifest(spark, dim_store.store(scratch)).folded == {"dim": 2}
    names = sorted(t.name for t in spark.catalog.listTables(database))
    assert names == ["dim_base_dic", "dim_base_organ", "dim_base_region_info", "dim_truck_info",
                     "dim_truck_model", "dim_user_info"]
    published = spark.table(f"{database}.dim_truck_info").count()
    stored = dim_store.read_current(spark, scratch, "dim_truck_info").select("row_key").distinct().count()
    assert 0 < published <= stored == spark.read.parquet(f"{SF_SMALL}/part.parquet").count()
    clean.unpersist()
