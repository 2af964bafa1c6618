"""ODS layer: decode, clean and route captured change-log records.

Each record is parsed **once** into an envelope whose row images are
VARIANT: numbers keep their exact decimal text (a string or
``map<string,string>`` field would turn ``12345678901234567.89`` into a
double), and every later step — typed decode of a fact table, map form of a
dimension row — reads the same parsed value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelstream import schemas

ENVELOPE_DDL = ("op string, ts_ms bigint, before variant, after variant, "
                "source struct<table:string>")
# What the quarantine needs: no ``before`` image is built.
CLASSIFY_DDL = "op string, ts_ms bigint, after variant, source struct<table:string>"

# Quarantine reasons (a record that is not forwarded has exactly one).
TOMBSTONE, MALFORMED, DELETE, NO_AFTER, NO_KEY = (
    "tombstone", "malformed", "delete", "no_after", "no_key")


def is_object(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>").isNotNull()


# A number outside of string literals, after what lies before it since the last one.
_NUMBER = (r'\G([^"\d-]*+(?:"[^"\\]*+(?:\\.[^"\\]*+)*+"[^"\d-]*+)*+)(-?\d[\d.eE+-]*+)')


def quoted_numbers(text: Column) -> Column:
    """JSON text whose numbers stand as strings, digit for digit: ``1.50`` stays
    ``1.50`` where a parsed number would become ``1.5``."""
    return F.regexp_replace(text, _NUMBER, '$1"$2"')


def parse(raw: DataFrame, value: str = "value", ddl: str = ENVELOPE_DDL,
          exact_numbers: bool = False) -> DataFrame:
    """Add the parsed envelope ``e`` (PERMISSIVE: bad text gives nulls).

    The text is parsed exactly once per record.  A plain projection would
    let predicate pushdown substitute ``from_json`` into every later filter
    (one parse per predicate); producing ``e`` from a one-row generator is a
    barrier the optimizer does not inline through, while nested-field
    pruning still narrows the parse schema to the fields used.

    ``exact_numbers`` keeps numbers (``e.ts_ms`` as well) as the text they came
    in; typed decoding reads the same values from it."""
    text = F.col(value)
    if exact_numbers:
        text, ddl = quoted_numbers(text), ddl.replace("ts_ms bigint", "ts_ms string")
    parsed = F.struct(F.from_json(text, ddl).alias("e"))
    return raw.select("*", F.inline(F.array(parsed)))


def reason(e: Column | None = None, value: Column | None = None) -> Column:
    """Why a record is not forwarded, null when it is.

    Empty or non-JSON text, a non-object ``after`` and a record without a
    table are malformed (the reference's parse raised); a null record is a
    tombstone; ``op='d'`` and a missing ``after`` are dropped by the clean
    step (a null ``op`` passes); a row without ``after.id`` has no partition
    key and is quarantined instead of failing the keyed sink."""
    e = F.col("e") if e is None else e
    value = F.col("value") if value is None else value
    after = e.getField("after")
    parsed = e.isNotNull() & e.getField("source").getField("table").isNotNull()
    missing = after.isNull() | F.is_variant_null(after)      # absent or JSON null
    no_id = F.try_variant_get(after, "$.id", "string").isNull()
    # Only a row image without ``id`` can be a non-object (a scalar has no
    # fields): the costlier object test runs for those rows alone.
    bad_after = ~missing & no_id & ~is_object(after)
    return (F.when(value.isNull(), F.lit(TOMBSTONE))
            .when(~parsed | bad_after, F.lit(MALFORMED))
            .when(e.getField("op").eqNullSafe(F.lit("d")), F.lit(DELETE))
            .when(missing, F.lit(NO_AFTER))
            .when(no_id, F.lit(NO_KEY)))


def forwarded(e: Column | None = None) -> Column:
    """Whether :func:`reason` is null, with one look into the row image: where
    ``after.id`` is a text, ``after`` is there and an object (and a null record
    has no table)."""
    e = F.col("e") if e is None else e
    return (e.getField("source").getField("table").isNotNull()
            & ~e.getField("op").eqNullSafe(F.lit("d"))
            & F.try_variant_get(e.getField("after"), "$.id", "string").isNotNull())


def clean(raw: DataFrame, exact_numbers: bool = False) -> DataFrame:
    """Forwarded records: ``part, offset, op, ts, table, before, after``
    (``ts_ms`` renamed to ``ts``; ``source`` lifted to ``table``;
    ``transaction`` dropped)."""
    p = parse(raw, exact_numbers=exact_numbers)
    return p.filter(forwarded()).select(
        "part", "offset", F.col("e.op").alias("op"), F.col("e.ts_ms").try_cast("bigint").alias("ts"),
        F.col("e.source.table").alias("table"), F.col("e.before").alias("before"),
        F.col("e.after").alias("after"))


def quarantine(raw: DataFrame) -> DataFrame:
    """Records that are not forwarded, with their reason and source table
    (null when unparseable)."""
    p = parse(raw, ddl=CLASSIFY_DDL)
    return p.withColumn("reason", reason()).filter(F.col("reason").isNotNull()).select(
        "part", "offset", "reason", F.col("e.source.table").alias("table"), "value")


def drop_tombstones(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("value").isNotNull())


def vget(v: Column, path: str, dtype: str = "string") -> Column:
    return F.try_variant_get(v, f"$.{path}", dtype)


def record_id(clean_df: DataFrame) -> Column:
    return vget(F.col("after"), "id")


def dim_project(clean_df: DataFrame) -> DataFrame:
    """DIM stream shape: ``op, ts, after, table`` (``before`` dropped)."""
    return clean_df.select("part", "offset", "op", "ts", "after", "table")


def dwd_project(clean_df: DataFrame) -> DataFrame:
    """DWD stream shape: like :func:`dim_project` but keeps ``before``."""
    return clean_df.select("part", "offset", "op", "ts", "before", "after", "table")


def dwd_filter(df: DataFrame) -> DataFrame:
    return df.filter(F.col("table").isin("order_info", "order_cargo"))


def decode(v: Column, schema: T.StructType) -> Column:
    """Typed row image from a VARIANT (exact decimals)."""
    return F.try_variant_get(v, "$", schema.simpleString())


def table_group(df: DataFrame, option: str, config_table: str | None = None) -> DataFrame:
    """Rows of one reader table group; an unknown option is an error.  The
    configuration group's table may have another name in a deployment."""
    if option not in schemas.TABLE_GROUPS:
        raise ValueError(f"unknown table group {option!r}")
    if option == "config_dim" and config_table:
        return df.filter(F.col("table") == config_table)
    return df.filter(F.col("table").isin(*schemas.TABLE_GROUPS[option]))


def sink_record(clean_df: DataFrame, with_position: bool = False,
                with_table: bool = False, position_in_value: bool = False) -> DataFrame:
    """Message layout for the ODS topic: key = ``after.id`` so one row's
    changes stay in one partition; value = the cleaned envelope as JSON.
    ``with_position`` keeps the source ``part, offset`` (file sinks; a
    Kafka consumer gets its own partition/offset); ``with_table`` keeps the
    table, to partition files by; ``position_in_value`` puts the source position
    into the message, by which a consumer tells a record written twice."""
    own = [F.struct("part", "offset").alias("pos")] if position_in_value else []
    value = F.to_json(F.struct("op", "ts", "before", "after", F.struct(
        F.col("table").alias("table")).alias("source"), *own))
    pos = ["part", "offset"] if with_position else []
    pos += ["table"] if with_table else []
    return clean_df.select(record_id(clean_df).alias("key"), value.alias("value"), *pos)


ODS_RECORD_DDL = ("op string, ts bigint, before variant, after variant, "
                  "source struct<table:string>, pos struct<part:int,offset:bigint>")


def once(records: DataFrame, arrived: str, within: str) -> DataFrame:
    """Messages of a topic that is written at least once, each source position once
    (the stream keeps positions for ``within`` of ``arrived``, the time of arrival,
    which must cover the time a batch may take to be written again).  Rows without a
    position pass."""
    pos = F.from_json("value", "pos struct<part:int,offset:bigint>").getField("pos")
    told = records.withColumn("__pos", pos)
    seen = (told.filter("__pos is not null").withWatermark(arrived, within)
            .dropDuplicatesWithinWatermark(["__pos"]))
    return seen.unionByName(told.filter("__pos is null").withWatermark(arrived, within)).drop("__pos")


def parse_ods_records(records: DataFrame, group: str | None = None) -> DataFrame:
    """Consumer side of the ODS topic (``key, value`` [+ ``part, offset``]):
    the cleaned envelope back as ``part, offset, op, ts, table, before,
    after`` — parsed once, same single-parse barrier as :func:`parse`."""
    if group and "table" in records.columns:  # files are partitioned by table: read its own only
        records = table_group(records, group)
    parsed = F.struct(F.from_json(F.col("value"), ODS_RECORD_DDL).alias("r"))
    r = records.select("*", F.inline(F.array(parsed)))
    # The source position, where the message carries it, orders a row's changes.
    return r.filter(F.col("r").isNotNull()).select(
        F.coalesce("r.pos.part", "part").alias("part"),
        F.coalesce("r.pos.offset", "offset").alias("offset"),
        F.col("r.op").alias("op"), F.col("r.ts").alias("ts"),
        F.col("r.source.table").alias("table"), F.col("r.before").alias("before"),
        F.col("r.after").alias("after"))
