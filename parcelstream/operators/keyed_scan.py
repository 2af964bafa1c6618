"""Skew-safe "last value so far per key" scans.

The order state machine needs, for every change row, the latest earlier
value of some state within the same order (previous status, latest cargo
row, the order waiting for cargo).  ``Window.partitionBy(key)`` would put
every row of a hot key into one task, so where a key has more than ``MAX_ROWS`` rows
(counted first) the scan is salted by time:

1. rows are grouped by ``(key, bucket)`` with ``bucket = time // bucket_ms``
   (a deterministic salt that keeps the order: a hot key's history is cut
   into consecutive time slices held by different tasks);
2. a window over ``(key, bucket)`` computes the scan inside each slice;
3. each slice's end state (last non-null value) is reduced to one row per
   ``(key, bucket)`` — the data is already partitioned that way, so this
   aggregation adds no shuffle;
4. a window over that summary, per key ordered by bucket, gives each slice
   its carry-in (for a hot key that is one row per slice, not per change);
5. the carry is joined back on ``(key, bucket)`` — the big side keeps its
   partitioning, only the summary moves — and fills rows whose slice had no
   earlier value.

A slice that holds more than ``MAX_ROWS`` rows of one key (an order busy within
one hour) is cut further, at points taken from a range partitioning of the busy
slices' rows by the scan's own order, so equal times are cut by what comes after
them.  Inputs without such a slice are only counted.

Everything is built-in expressions, so the scan stays JVM-side.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelstream.session import ensure_checkpoint_dir

DEFAULT_BUCKET_MS = 60 * 60 * 1000
MAX_ROWS = 1 << 20        # rows of one key in one slice
MAX_CUTS = 1 << 16        # cut points, which are broadcast: some 50 bytes each
# Session setting overriding the bucket width (busier slices are cut further).
BUCKET_CONF = "spark.parcelstream.scan.bucketMs"


def bucket_width(df: DataFrame, default: int | None = None) -> int:
    conf = df.sparkSession.conf.get(BUCKET_CONF, None)
    return int(conf) if conf else (default or DEFAULT_BUCKET_MS)


BUCKET = "__scan_bucket"
WHOLE = "__scan_whole"    # stands for the bucket where no key is sliced


def whole(key: Column, slice_: Column | None = None) -> Column:
    """Rows with a key are in one part each; the ones without are no one's: theirs are
    sliced.  A table with one row per key joined on the key and this finds the scan's
    rows where they are."""
    return F.when(key.isNull(), F.lit(-1) if slice_ is None else slice_).otherwise(0).cast("long")


def _slice(order: Sequence[str], bucket_ms: int) -> Column:
    return F.floor(F.col(order[0]) / F.lit(bucket_ms)).cast("long")


def _cell(*keys: str) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(MAX_CUTS)).cast("int")


def full_cells(df: DataFrame, keys: Sequence[str], max_rows: int | None, folder: str):
    """The cells ``__c`` that may hold a group of more than ``max_rows`` rows, None if
    there is none, and the bound, at which at most MAX_CUTS groups are that busy.

    Groups are counted together, MAX_CUTS cells of them, in one pass that moves no
    rows; a busy group makes its cell full, whatever else is in it."""
    cells = df.groupBy(_cell(*keys).alias("__c")).agg(F.count(F.lit(1)).alias("n"))
    cells.write.parquet(f"{folder}/cells")
    cells = df.sparkSession.read.schema(cells.schema).parquet(f"{folder}/cells")
    total, most = cells.agg(F.sum("n"), F.max("n")).first()
    max_rows = max(max_rows or MAX_ROWS, -(-2 * (total or 0) // MAX_CUTS))
    return (cells.filter(F.col("n") > max_rows).select("__c") if (most or 0) > max_rows else None), max_rows


def short_keys(df: DataFrame, key: str, max_rows: int | None = None) -> bool:
    """Whether no key has more rows than a slice may hold."""
    folder = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/scans/{uuid.uuid4().hex}"
    return full_cells(df, (key,), max_rows, folder)[0] is None


def cut_busy(df: DataFrame, key: str, order: Sequence[str], max_rows: int | None = None) -> DataFrame:
    """``df`` with its bucket ``__b`` made a (bucket, part): the parts of a bucket
    hold consecutive rows of a key, about ``max_rows`` of them at most.  Unchanged
    where no bucket holds more."""
    folder = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/scans/{uuid.uuid4().hex}"
    full, max_rows = full_cells(df, (key, "__b"), max_rows, folder)
    if full is None:
        return df
    some = df.withColumn("__c", _cell(key, "__b")).join(F.broadcast(full), "__c", "left_semi")
    busy = some.groupBy(key, "__b").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > max_rows)
    busy.write.parquet(f"{folder}/busy")
    busy = df.sparkSession.read.schema(busy.schema).parquet(f"{folder}/busy")
    rows = busy.agg(F.sum("n")).first()[0]
    if not rows:
        return df
    mine = df.join(F.broadcast(busy.select(key, "__b")), [key, "__b"]).select(key, "__b", *order)
    ranged = mine.repartitionByRange(-(-rows // max_rows) + 1, key, "__b", *order)
    first = ranged.groupBy(F.spark_partition_id().alias("p")).agg(
        F.min(F.struct(key, "__b", F.struct(*order).alias("at"))).alias("m"))
    # Stored, so that every reader of the plan cuts at the same points.
    first.select("m.*").write.parquet(f"{folder}/cuts")
    cuts = df.sparkSession.read.parquet(f"{folder}/cuts").groupBy(key, "__b").agg(
        F.collect_list("at").alias("__cuts"))
    part = F.size(F.filter("__cuts", lambda c: c <= F.struct(*order)))
    joined = df.join(F.broadcast(cuts), [key, "__b"], "left")
    return joined.withColumn("__b", F.struct(
        F.col("__b").alias("bucket"), F.when(F.col("__cuts").isNull(), 0).otherwise(part).alias("part"))
    ).drop("__cuts")


def asof_last(df: DataFrame, key: str, order: Sequence[str],
              values: Mapping[str, Column], inclusive: bool = False,
              bucket_ms: int | None = None, keep_bucket: bool = False,
              max_rows: int | None = None) -> DataFrame:
    """Add one column per ``values`` entry: the last non-null value of that
    expression among rows with the same ``key`` that come before the row in
    ``order`` (``inclusive=True`` also counts the row itself).

    ``order[0]`` is the event time in epoch millis; ``order`` must make rows
    of one key unique (e.g. ``(ts_ms, seq)``); ``key`` must be non-null.  Wrap a possibly-null payload
    in a struct to make "present" explicit.

    Where no key has more rows than a slice may hold, one window per key does it;
    ``bucket_ms`` (or the session's setting) asks for slices anyway.

    ``keep_bucket=True`` leaves the bucket column on the output; a following
    scan over the same key then reuses it and inherits the partitioning by
    ``(key, bucket)`` instead of shuffling the data again.
    """
    names = list(values)
    ordcols = [F.col(c) for c in order]
    wide = bucket_ms is None and df.sparkSession.conf.get(BUCKET_CONF, None) is None
    if BUCKET not in df.columns and (WHOLE in df.columns or (wide and short_keys(df, key, max_rows))):
        if WHOLE not in df.columns:  # moved here, before columns are added
            df = df.withColumn(WHOLE, whole(F.col(key), _slice(order, bucket_width(df))))
            df = df.repartition(key, WHOLE)
        frame = (Window.partitionBy(key, WHOLE).orderBy(*ordcols)
                 .rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1))
        out = df.withColumns({f"__v_{n}": values[n] for n in names})
        out = out.withColumns({n: F.last(f"__v_{n}", ignorenulls=True).over(frame) for n in names})
        return out.drop(*[f"__v_{n}" for n in names], *([] if keep_bucket else [WHOLE]))

    bucket_ms = bucket_ms or bucket_width(df)
    if BUCKET not in df.columns:
        sliced = df.withColumn("__b", _slice(order, bucket_ms))
        sliced = cut_busy(sliced, key, order, max_rows)
    else:
        sliced = df.withColumnRenamed(BUCKET, "__b")
    tmp = sliced.withColumns({f"__v_{n}": values[n] for n in names})

    frame = (Window.partitionBy(key, "__b").orderBy(*ordcols)
             .rowsBetween(Window.unboundedPreceding,
                          Window.currentRow if inclusive else -1))
    local = tmp.withColumns(
        {f"__l_{n}": F.last(f"__v_{n}", ignorenulls=True).over(frame) for n in names})

    ordk = F.struct(*ordcols)
    ends = local.groupBy(key, "__b").agg(*[
        F.max_by(F.col(f"__v_{n}"), F.when(F.col(f"__v_{n}").isNotNull(), ordk))
        .alias(f"__e_{n}") for n in names])
    before = (Window.partitionBy(key).orderBy("__b")
              .rowsBetween(Window.unboundedPreceding, -1))
    carry = ends.select(
        F.col(key).alias("__ck"), F.col("__b").alias("__cb"),
        *[F.last(f"__e_{n}", ignorenulls=True).over(before).alias(f"__c_{n}") for n in names])

    # Plain equality keeps the join co-partitioned with ``local`` (rows with
    # a null key are quarantined upstream and never reach the state rules).
    joined = local.join(
        carry, (local[key] == carry["__ck"]) & (local["__b"] == carry["__cb"]), "left")
    out = joined.withColumns(
        {n: F.coalesce(F.col(f"__l_{n}"), F.col(f"__c_{n}")) for n in names})
    drop = ["__ck", "__cb"] + [f"__{p}_{n}" for p in "vlc" for n in names]
    out = out.drop(*drop)
    return out.withColumnRenamed("__b", BUCKET) if keep_bucket else out.drop("__b")
