"""The salted as-of scan equals a plain per-key window, hot keys included."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from parcelstream.operators import keyed_scan
from parcelstream.operators.keyed_scan import asof_last


def asof_last_window(df, key, order, values, inclusive=False):
    """The plain form of ``asof_last``: one window per key."""
    frame = (Window.partitionBy(key).orderBy(*order)
             .rowsBetween(Window.unboundedPreceding,
                          Window.currentRow if inclusive else -1))
    tmp = df.withColumns({f"__v_{n}": c for n, c in values.items()})
    tmp = tmp.withColumns({n: F.last(f"__v_{n}", ignorenulls=True).over(frame) for n in values})
    return tmp.drop(*[f"__v_{n}" for n in values])


def _rows(n, hot_share, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = 0 if rnd.random() < hot_share else rnd.randint(1, 20)
        rows.append((key, rnd.randint(0, 50_000), i, rnd.choice([None, rnd.randint(0, 9)])))
    return rows


def _compare(spark, rows, bucket_ms, inclusive):
    df = spark.createDataFrame(rows, "k long, ts long, seq long, v int")
    vals = {"x": F.when(F.col("v").isNotNull(), F.struct(F.col("v").alias("v")))}
    a = asof_last(df, "k", ["ts", "seq"], vals, inclusive=inclusive, bucket_ms=bucket_ms) \
        .select("seq", F.col("x.v").alias("a"))
    b = asof_last_window(df, "k", ["ts", "seq"], vals, inclusive=inclusive) \
        .select("seq", F.col("x.v").alias("b"))
    bad = a.join(b, "seq").filter(~F.col("a").eqNullSafe(F.col("b")))
    assert bad.count() == 0


def test_hot_key_third_of_rows(spark):
    _compare(spark, _rows(3000, 0.34, 1), bucket_ms=1000, inclusive=False)


def test_inclusive_and_tiny_buckets(spark):
    _compare(spark, _rows(1500, 0.5, 2), bucket_ms=7, inclusive=True)


@settings(max_examples=5, deadline=None)
@given(st.integers(min_value=0, max_value=10_000), st.sampled_from([1, 100, 5000, 10**9]))
def test_property_any_bucket_width(spark, seed, bucket):
    _compare(spark, _rows(300, 0.4, seed), bucket_ms=bucket, inclusive=False)


def test_hot_key_is_split_across_buckets(spark):
    rows = _rows(4000, 0.34, 3)
    df = spark.createDataFrame(rows, "k long, ts long, seq long, v int")
    groups = df.filter("k = 0").groupBy(F.floor(F.col("ts") / 1000)).count().collect()
    assert len(groups) > 20 and max(r["count"] for r in groups) < 0.1 * len(rows)


def _busy(n, share, seed, times):
    """``share`` of all rows on one key, at ``times`` different moments of one hour."""
    rnd = random.Random(seed)
    return [(0 if i < share * n else rnd.randint(1, 9), rnd.randrange(times), i,
             rnd.choice([None, None, rnd.randint(0, 9)])) for i in range(n)]


def _cut(spark, rows, max_rows):
    df = spark.createDataFrame(rows, "k long, ts long, seq long, v int")
    sliced = df.withColumn("__b", F.floor(F.col("ts") / 3_600_000).cast("long"))
    return keyed_scan.cut_busy(sliced, "k", ["ts", "seq"], max_rows)


@settings(max_examples=4, deadline=None)
@given(st.integers(0, 1000), st.sampled_from([1, 2, 500, 3_000_000]))
def test_one_key_and_one_hour_with_half_the_rows(spark, seed, times):
    """The largest slice is bounded though one key, one hour (even one
    millisecond) holds half the rows; the scan equals a plain window."""
    rows, most = _busy(3000, 0.5, seed, times), 100
    cut = _cut(spark, rows, most)
    sizes = [r["count"] for r in cut.groupBy("k", "__b").count().collect()]
    assert sum(sizes) == len(rows) and max(sizes) <= 3 * most
    # parts of a bucket hold consecutive rows
    spans = {}
    for r in cut.filter("k = 0").collect():
        spans.setdefault(r["__b"], []).append((r.ts, r.seq))
    ends = sorted((b, min(v), max(v)) for b, v in spans.items())
    assert all(a[2] < b[1] for a, b in zip(ends, ends[1:]))
    df = spark.createDataFrame(rows, "k long, ts long, seq long, v int")
    vals = {"x": F.when(F.col("v").isNotNull(), F.struct(F.col("v").alias("v")))}
    a = asof_last(df, "k", ["ts", "seq"], vals, max_rows=most, keep_bucket=True)
    a = asof_last(a, "k", ["ts", "seq"], {"y": F.col("x")})       # a second scan keeps the slices
    b = asof_last_window(asof_last_window(df, "k", ["ts", "seq"], vals), "k", ["ts", "seq"],
                         {"y": F.col("x")})
    a, b = a.select("k", "seq", "x.v", "y"), b.select("k", "seq", "x.v", "y")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_inputs_without_a_busy_slice_are_left_alone(spark):
    for most, rows in ((5000, 3000), (1000, 3000)):
        cut = _cut(spark, _busy(rows, 0.01, 4, 3_000_000), most)
        assert dict(cut.dtypes)["__b"] == "bigint"
