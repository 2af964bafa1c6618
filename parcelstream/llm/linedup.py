"""Lines that many documents share, by range-partitioned hashes.

A line's key is the line without blanks (``[\\x20\\x09-\\x0D]``) at both ends, A-Z
lower-cased.  A key of at least ``min_chars`` code points found in at least
``min_docs`` documents is kept in one document only, the one with the largest
id (``keep="document"``: all its lines there; ``keep="line"``: the first one).

1. Every line long enough gives a row of hashes and places, without its text.
2. The rows are range-partitioned by hash and sorted by hash, then document
   (largest id first) and position; one pass over each run of equal hashes
   streams the first occurrence and marks all later ones.
3. Keys holding more than one row in ``1 / HOT_SHARE`` never enter that sort:
   there are at most ``HOT_SHARE`` of them, so their counts and first places,
   combined in every task before any shuffle, are broadcast to their lines.
4. A document's marked positions become its keep bitmap, run-length coded:
   ``keep`` lists (first, lines) of each run of kept lines.

Only built-in functions take part.  A document is identified by its id and a
digest of its text, so bitmaps fit the text they were made from.

Defined cases: null or empty text is one empty line, which stays; a null id
counts as one document smaller than all others; rows that repeat an id with
other texts count as one document and keep their own bitmaps; equal rows share
a bitmap; an empty table gives an empty result; columns other than id and text
are not read, so clashing names do no harm.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelstream.llm import common

MIN_CHARS, MIN_DOCS = 20, 3
HOT_SHARE = 1000
BLANKS = " \t\n\x0b\x0c\r"


def split_lines(text: str | Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _lower(text: Column) -> Column:
    """A-Z only; the fast built-in does the same to texts of ASCII alone."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def _named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.unhex(F.md5(text)).alias("digest"),
                       text.alias("text"))


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``value`` as a column that lambdas read without working it out again for
    each element: a generator of one row keeps the planner from inlining it."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def line_rows(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(h1, h2, id, digest, n_lines, pos) of every line of at least ``min_chars``."""
    rows = _once(_named(docs, id_col, text_col), "lines", split_lines(_lower(F.col("text"))))
    rows = rows.select("id", "digest", F.size("lines").alias("n_lines"),
                       F.posexplode("lines").alias("pos", "line"))
    rows = rows.withColumn("line", F.btrim("line", F.lit(BLANKS))).filter(
        F.length("line") >= min_chars)
    return rows.select(F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(12), "line").alias("h2"),
                       "id", "digest", "n_lines", "pos")


def dropped_lines(rows: DataFrame, min_docs: int, keep: str) -> DataFrame:
    """(id, digest, n_lines, pos) of the lines that go."""
    one = keep == "line"
    total = rows.count()
    hot = [r["h1"] for r in rows.groupBy("h1").agg(F.count("*").alias("n"))
           .filter(F.col("n") * HOT_SHARE > total).filter("n >= 1024").select("h1").collect()]
    is_hot = F.col("h1").isin(hot) if hot else F.lit(False)
    order = [F.col("id").desc_nulls_last()]
    run = Window.partitionBy("h1", "h2")
    by_doc, by_line = run.orderBy(*order), run.orderBy(*order, "pos", "digest")
    cold = (rows.filter(~is_hot).repartitionByRange("h1", "h2")
            .withColumn("line_no", F.row_number().over(by_line))
            .withColumn("doc_no", F.dense_rank().over(by_doc))
            .withColumn("docs", F.max("doc_no").over(run)))
    later = F.col("line_no" if one else "doc_no") > 1
    gone = cold.filter((F.col("docs") >= min_docs) & later).select("id", "digest", "n_lines", "pos")
    if not hot:
        return gone
    # At most HOT_SHARE keys: sums and extremes are combined in each task first.
    mine = rows.filter(is_hot)
    firsts = mine.groupBy("h1", "h2", "id").agg(F.min(F.struct("pos", "digest")).alias("at"))
    firsts = firsts.groupBy("h1", "h2").agg(
        F.count("*").alias("docs"), F.max("id").alias("top"),
        F.max_by("at", F.coalesce(F.col("id"), F.lit(-(1 << 63)))).alias("at"))
    firsts = F.broadcast(firsts.filter(F.col("docs") >= min_docs))
    at_top = F.col("id").eqNullSafe(F.col("top"))
    if one:
        at_top &= F.struct("pos", "digest") == F.col("at")
    hot_gone = mine.join(firsts, ["h1", "h2"]).filter(~at_top)
    return gone.unionByName(hot_gone.select("id", "digest", "n_lines", "pos"))


def _runs(edges: str) -> Column:
    """Sorted dropped positions, then the number of lines -> runs (first, lines)
    of what stays."""
    first = lambda i: F.coalesce(F.get(edges, i - 1) + 1, F.lit(0))
    runs = F.transform(edges, lambda p, i: F.struct(
        first(i).alias("first"), (p - first(i)).alias("lines")))
    return F.filter(runs, lambda r: r["lines"] > 0)


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                 keep: str = "document") -> DataFrame:
    """(id, digest, n_lines, n_dropped, keep) of every document that loses a
    line; a document without a row keeps all."""
    if keep not in ("document", "line"):
        raise ValueError(f"keep must be 'document' or 'line', not {keep!r}")
    rows = common.stored(line_rows(docs, id_col, text_col, min_chars), "lines")
    gone = dropped_lines(rows, min_docs, keep).groupBy("id", "digest").agg(
        F.max("n_lines").alias("n_lines"), F.sort_array(F.collect_set("pos")).alias("gone"))
    gone = _once(gone, "edges", F.concat("gone", F.array("n_lines")))
    return gone.select("id", "digest", F.col("n_lines").cast("long").alias("n_lines"),
                       F.size("gone").cast("long").alias("n_dropped"), _runs("edges").alias("keep"))


def cleaned(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """(id, n_lines, n_dropped, text) of every row, its bitmap applied."""
    named = _named(docs, id_col, text_col)
    b = bitmaps.select(F.col("id").alias("b_id"), F.col("digest").alias("b_digest"),
                       "n_dropped", "keep")
    joined = named.join(b, named["id"].eqNullSafe(b["b_id"]) & (named["digest"] == b["b_digest"]),
                        "left")
    joined = _once(joined, "lines", split_lines(F.col("text")))
    some = F.flatten(F.transform("keep", lambda r: F.slice("lines", r["first"] + 1, r["lines"])))
    return joined.select("id", F.size("lines").cast("long").alias("n_lines"),
                         F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"),
                         F.when(F.col("keep").isNull(), F.col("text"))
                         .otherwise(F.array_join(some, "\n")).alias("text"))
