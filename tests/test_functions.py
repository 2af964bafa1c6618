"""Scalar helpers on literals: masking, time conversions, exact decimals."""

from decimal import Decimal

from pyspark.sql import functions as F

from parcelstream.functions import text, timefn
from parcelstream.operators import ods


def test_mask_name(spark):
    df = spark.createDataFrame([("张三丰",), ("a",), ("",), (None,), ("Customer#01",)], "n string")
    got = [r[0] for r in df.select(text.mask_name("n")).collect()]
    assert got == ["张**", "a", "", None, "C**********"]


def test_local_time_crosses_midnight_at_16_utc(spark):
    df = spark.createDataFrame([("2023-05-27T15:59:59Z",), ("2023-05-27T16:00:00Z",)], "s string")
    rows = df.select(timefn.iso_to_millis("s").alias("ms"),
                     timefn.iso_to_local_text("s").alias("t"),
                     timefn.millis_to_date(timefn.iso_to_millis("s")).alias("d"),
                     timefn.millis_to_partition_date(timefn.iso_to_millis("s")).alias("p")).collect()
    assert rows[0]["t"] == "2023-05-27 23:59:59" and rows[0]["d"] == "2023-05-27"
    assert rows[1]["t"] == "2023-05-28 00:00:00" and rows[1]["d"] == "2023-05-28"
    assert rows[1]["p"] == "20230528"
    assert rows[1]["ms"] == 1685203200000


def test_iso_instant_and_text_roundtrip(spark):
    df = spark.createDataFrame([("2023-05-27T20:00:00Z",)], "s string")
    r = df.select(timefn.iso_to_millis("s").alias("ms"), timefn.iso_to_local_text("s").alias("t")).first()
    assert r["ms"] == 1685217600000 and r["t"] == "2023-05-28 04:00:00"


def test_text_to_millis_full_and_date_and_dirty(spark):
    df = spark.createDataFrame([("2023-05-28 04:00:00", "2023-05-28"), ("bad", "x")], "a string, b string")
    rows = df.select(timefn.text_to_millis("a").alias("f"),
                     timefn.text_to_millis("b", full=False).alias("d")).collect()
    assert rows[0]["f"] == 1685217600000
    assert rows[0]["d"] == 1685203200000
    assert rows[1]["f"] is None and rows[1]["d"] is None


def test_estimate_arrive_shifts_back_eight_hours(spark):
    df = spark.createDataFrame([(1685217600000,)], "ms long")
    r = df.select(timefn.estimate_arrive_text("ms")).first()[0]
    assert r == "2023-05-27 20:00:00"


def test_decimals_survive_decode_exactly(spark):
    raw = spark.createDataFrame(
        [(0, 1, '{"op":"c","ts_ms":1,"after":{"id":"1","weight":1.50,"amount":12345678901234567.89},'
                '"source":{"table":"order_cargo"}}')], "part int, offset long, value string")
    c = ods.clean(raw)
    r = c.select(ods.vget(F.col("after"), "weight", "decimal(16,2)").alias("w"),
                 ods.vget(F.col("after"), "amount", "decimal(20,2)").alias("a")).first()
    assert r["w"] == Decimal("1.50")
    assert r["a"] == Decimal("12345678901234567.89")
