"""Mixing sources to target weights by systematic sampling.

A source's target shares out all words by weight, stopping at ``MOST`` times
what the source holds, with the excess reshared by weight (a water level, in
closed form over the sources).  Documents then get copies: within a source the
expected copies are summed in order, one random offset is added, and a document
is emitted once for each integer boundary its own part crosses.

The order goes by size, largest first, in levels (a document's size against
its source's target, halved from level to level).  A level's documents expect
what is still missing from the target over what is left to take from, so the
whole-document rounding of large documents is made up for by smaller ones; the
running sum and its one offset go on through all levels of a source.

No group meets in one task: a running position inside a (source, level) is the
count of the hash buckets before, plus the place inside the bucket, and only
one row per source meets in the single-task windows over the sources.

Defined cases: null text has size 0 and is taken as often as any document of its
level; null is a source of its own, ordered last; rows that repeat an id are
separate documents; a source without words has target 0 and an expected copy
count of 0; an empty table gives an empty result.  ``mix`` reads only the
source and text columns and passes all columns through; its own names are
prefixed, so clashing names do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelstream.llm import common

WEIGHTS = (5, 2, 1)   # by source in code point order, repeating
MOST = 3              # a target's bound, as a multiple of the source's size
LEVELS = 12           # the last one holds sizes up to 1/2048 of the target
BUCKETS = 4096        # hash buckets of a (source, level)
SEED = 20

WORD = r"[^\x20\x09-\x0D]+"


def words(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from ``sizes(source, source_size)``."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)),
                          (F.row_number().over(order) - 1) % len(WEIGHTS) + 1)
    big = lambda c: c.cast("decimal(38,0)")
    rows = sizes.withColumn("weight", weight).withColumn("most", MOST * F.col("source_size"))
    # The sources that the water level reaches first stop first.
    by_level = Window.orderBy((F.col("most") / F.col("weight")), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    none = F.lit(0).cast("long")
    rows = (rows.withColumn("left", F.sum("source_size").over(every)
                            - F.coalesce(F.sum("most").over(before), none))
            .withColumn("share", F.sum("weight").over(every)
                        - F.coalesce(F.sum("weight").over(before), none))
            .withColumn("full", big(F.col("most")) * big(F.col("share"))
                        <= big(F.col("weight")) * big(F.col("left"))))
    rows = (rows.withColumn("left", F.sum("source_size").over(every) - F.coalesce(
                F.sum(F.when(F.col("full"), F.col("most"))).over(every), none))
            .withColumn("share", F.sum(F.when(~F.col("full"), F.col("weight"))).over(every)))
    return rows.select("source", "source_size", F.when(F.col("full"), F.col("most").cast("double"))
                       .otherwise((F.col("weight") * F.col("left")).cast("double")
                                  / F.col("share")).alias("target"))


def level(size: Column, target: Column) -> Column:
    """0 for sizes above half the target, one more for each halving."""
    ratio = F.when(size > 0, F.floor(F.log2(target / size))).otherwise(LEVELS)
    return F.greatest(F.lit(0), F.least(F.coalesce(ratio, F.lit(LEVELS)).cast("int"),
                                        F.lit(LEVELS - 1)))


def _bucket(key: Column, size: Column) -> Column:
    return F.pmod(F.xxhash64(key, size, F.lit(SEED)), F.lit(BUCKETS)).cast("int")


def _same(a: DataFrame, b: DataFrame, *also: str) -> DataFrame:
    """``a`` with the columns of ``b`` by source, null being equal to null."""
    side = b.withColumnsRenamed({c: f"{c}__b" for c in ("source", *also)})
    on = a["source"].eqNullSafe(side["source__b"])
    for c in also:
        on &= a[c] == side[f"{c}__b"]
    return a.join(side, on).drop(*[f"{c}__b" for c in ("source", *also)])


def _copies(rank: Column) -> Column:
    at = lambda k: F.floor(F.col("offset") + F.col("rate") * k)
    return (at(rank) - at(rank - 1)).cast("int")


def placed(rows: DataFrame, before: DataFrame) -> DataFrame:
    """``rows`` (source, level, key, size, ...) with ``rank``, from 1, inside
    each (source, level); ``before(source, level, bucket, before)``."""
    rows = rows.withColumn("bucket", _bucket(F.col("key"), F.col("size")))
    rows = rows.withColumn("place", F.row_number().over(
        Window.partitionBy("source", "level", "bucket").orderBy("key", "size")))
    return _same(rows, before, "level", "bucket").withColumn("rank", F.col("place") + F.col("before"))


def rates(sized: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """From ``sized(key, source, size)``: the sources' targets, each (source,
    level)'s rate and offset, and the rows before each bucket."""
    goal = common.stored(targets(sized.groupBy("source").agg(
        F.sum("size").alias("source_size"))), "targets")
    rows = _same(sized, goal).withColumn("level", level(F.col("size"), F.col("target")))
    rows = rows.select("key", "source", "size", "level")
    counts = (rows.withColumn("bucket", _bucket(F.col("key"), F.col("size")))
              .groupBy("source", "level", "bucket")
              .agg(F.count("*").alias("rows"), F.sum("size").alias("words")))
    counts = common.stored(counts, "buckets")
    before = counts.select("source", "level", "bucket", F.coalesce(F.sum("rows").over(
        Window.partitionBy("source", "level").orderBy("bucket").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).cast("long").alias("before"))
    held = counts.groupBy("source", "level").agg(F.sum("words").alias("words"),
                                                 F.sum("rows").alias("rows"))
    heads = common.stored(rows.filter(F.col("level") < LEVELS - 1), "heads")
    present = {r["level"] for r in counts.select("level").distinct().collect()}

    # One random offset a source; the running sum goes on from level to level.
    start = F.pmod(F.xxhash64("source", F.lit(SEED)), F.lit(1 << 20)) / (1 << 20)
    state = goal.select("source", F.col("target").alias("missing"),
                        F.col("source_size").alias("words"), start.alias("offset"))
    found = []
    for n in sorted(present):
        own = held.filter(F.col("level") == n).select("source", F.col("words").alias("own"),
                                                      F.col("rows").alias("own_rows"))
        rate = state.withColumn("rate", F.when(F.col("words") > 0, F.greatest(F.lit(0.0), F.least(
            F.lit(float(MOST)), F.col("missing") / F.col("words")))).otherwise(0.0))
        rate = common.stored(rate.select(
            "source", F.lit(n).alias("level"), "rate", "offset", "missing", "words"), "rate")
        found.append(rate.select("source", "level", "rate", "offset"))
        if n < max(present):
            took = _same(placed(heads.filter(F.col("level") == n), before),
                         rate.select("source", "rate", "offset"))
            took = took.groupBy("source").agg(
                F.sum(_copies(F.col("rank")) * F.col("size")).alias("took"))
            both = own.join(took.withColumnRenamed("source", "s"),
                            F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
            both = both.withColumnRenamed("source", "s")
            state = (rate.join(both, F.col("source").eqNullSafe(F.col("s")), "left")
                     .select("source", (F.col("missing") - F.coalesce("took", F.lit(0))).alias("missing"),
                             (F.col("words") - F.coalesce("own", F.lit(0))).alias("words"),
                             ((F.col("offset") + F.col("rate") * F.coalesce("own_rows", F.lit(0)))
                              % 1.0).alias("offset")))
    every = found[0] if found else state.select(
        "source", F.lit(0).alias("level"), F.lit(0.0).alias("rate"), F.lit(0.0).alias("offset"))
    for more in found[1:]:
        every = every.unionByName(more)
    return goal, every, before


def copies(sized: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """``rows`` (by default ``sized``: key, source, size, and more columns) with
    source_size, target and copies."""
    goal, rate, before = rates(sized)
    rows = _same(sized if rows is None else rows, goal)
    rows = rows.withColumn("level", level(F.col("size"), F.col("target")))
    return (_same(placed(rows, before), rate, "level")
            .withColumn("copies", _copies(F.col("rank")))
            .drop("level", "bucket", "place", "before", "rank", "rate", "offset"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """The mix itself: every document as often as it was drawn, all columns.
    Copies are worked out on hashes and sizes alone and joined to the rows, which
    move once, by their place in a stored table."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = common.stored(docs.select(F.monotonically_increasing_id().alias("place"),
                                     whole.alias("row")), "rows")
    field = lambda c: F.col("row").getField(c)
    sized = common.stored(rows.select(
        "place", F.xxhash64(field(id_col), field(text_col)).alias("key"),
        field(source_col).alias("source"), words(field(text_col)).alias("size")), "sizes")
    narrow = sized.select("key", "source", "size", F.col("place").alias("row_place"))
    drawn = copies(sized, narrow).filter("copies > 0").select(
        F.col("row_place").alias("place"), "copies")
    return (rows.join(drawn, "place")
            .select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
            .select("row.*"))
