"""Personal data: base spans by fixed rules, further spans by boosted trees.

Generators with high recall propose spans, overlapping ones included.  A
candidate that meets a base rule is a finding.  Every other candidate gets
features of its format and of the characters around it; boosted trees score
them, and a threshold calibrated per kind selects.  Accepted candidates that
overlap a base span are dropped, so base spans always stay as they are.

Everything is column expressions on one row: no Python on the executors, no
shuffle, and arrays in proportion to the row's own candidates.  Positions count
code points, ends are exclusive.

Defined cases: null text is empty and has no spans; a null id stays null; rows
that repeat give equal results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelstream.llm import boosted

KINDS = ["email", "ip", "card", "phone", "id", "iban"]
BASE = KINDS[:4]

# (kind, base rule or not, what a text must contain, pattern).  Runs are
# possessive and start at a run's first character, so long texts take linear
# time; \G lets a match start inside a run that the last match has cut.
GENERATORS = [
    ("email", True, "@",
     r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("ip", True, r"[0-9]\.[0-9]", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"),
    ("card", True, r"[0-9]", r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++"),
    ("phone", True, r"\+", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ("email", False, r"(?i)[\[({]\x20?at\x20?[\])}]",
     r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?[\[({]\x20?(?i:at)\x20?[\])}]\x20?"
     r"[A-Za-z0-9-]{1,63}(?:(?:\x20?[\[({]\x20?(?i:dot)\x20?[\])}]\x20?|\.)[A-Za-z0-9-]{1,63}){1,6}"),
    # National numbers: 3-3-4 with or without a 1 before it, else 7-15 digits with
    # separators whose last group has two and more; the trees do the rejecting.
    ("phone", False, r"[0-9](?:[\x20()./-]{0,2}[0-9]){6}",
     r"(?<![0-9+])(?<![0-9][.-])(?:(?:1[\x20.-])?\(?[0-9]{3}\)?[\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}"
     r"|\(?[0-9](?:[\x20()./-]{0,2}[0-9]){6,14}(?<=[0-9]{2}))(?![0-9]|[.-][0-9])"),
    ("id", False, r"[0-9]-[0-9]{2}-[0-9]", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    ("iban", False, r"[A-Z]{2}[0-9]{2}",
     r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
]
CONTEXT = 32          # characters kept on either side of a candidate
FAR = 1 << 40         # beyond any position
BLOCK = 256           # elements a running sum handles at a time

# Fixed cue words, looked for next to a candidate.
CUES = {
    "email": r"(?i)\b(e-?mail|mail|contact|write to|reach)\b",
    "ip": r"(?i)\b(ip|host|address|server|login from)\b",
    "card": r"(?i)\b(card|visa|mastercard|amex|credit|debit|cvv|cvc|expir\w*)\b",
    "phone": r"(?i)\b(tel|telephone|phone|call|mobile|cell|fax|whatsapp|sms|dial)\b",
    "id": r"(?i)\b(ssn|social security|passport|national id|tax id|id number|insurance)\b",
    "iban": r"(?i)\b(iban|account|bank|bic|swift|konto|transfer)\b",
}
AGAINST = (r"(?i)(\b(order|invoice|version|serial|part|isbn|issue|page|lot|ref|ticket|build|"
           r"tracking|sku|model|total|date|no)\b|#)")
# Dates, spans of years and dotted quads; for phones also the grouping of ids.
FORMATS = (r"^(?:(?:19|20)[0-9]{2}([./\x20-])[0-9]{1,2}\1[0-9]{1,2}\b|"
           r"[0-9]{1,2}([./\x20-])[0-9]{1,2}\2(?:19|20)[0-9]{2}\b|"
           r"(?:19|20)[0-9]{2}\x20?-\x20?(?:19|20)[0-9]{2}$|[0-9]{1,3}(?:\.[0-9]{1,3}){3}$)")
ID_FORMAT = r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"

Lambda = Callable[[Column], Column]


def scan(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Inclusive running ``combine`` of an array of longs, in blocks, so that
    long arrays don't copy themselves once an element."""

    def run(block: Column, first: Column) -> Column:
        out = F.aggregate(block, F.array(first),
                          lambda acc, v: F.concat(acc, F.array(combine(F.element_at(acc, -1), v))))
        return F.slice(out, F.lit(2), F.size(block))

    zero = F.lit(0).cast("long")
    size = F.size(values)
    blocks = F.transform(F.sequence(F.lit(0), F.floor((size - 1) / BLOCK).cast("int")),
                         lambda b: F.slice(values, b * BLOCK + 1, F.lit(BLOCK)))
    done = F.aggregate(
        blocks, F.struct(zero.alias("last"), F.array().cast("array<array<bigint>>").alias("out")),
        lambda acc, x: F.struct(
            F.element_at(run(x, acc["last"]), -1).alias("last"),
            F.concat(acc["out"], F.array(run(x, acc["last"]))).alias("out")))
    return F.when(size == 0, F.array().cast("array<bigint>")).otherwise(F.flatten(done["out"]))


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check-digit rule."""

    def worth(i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).when(d < 5, 2 * d).otherwise(2 * d - 9)

    total = F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), worth),
                        F.lit(0), lambda a, b: a + b)
    return F.when(F.length(digits).between(1, 30), total % 10 == 0).otherwise(False)


def base_rule(kind: str) -> Lambda:
    """What a base generator's match must pass."""
    if kind == "email":
        return lambda t: F.lit(True)
    if kind == "ip":
        part = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9]|(?<=0))"
        return lambda t: t.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return lambda t: F.length(_digits(t)).between(14, 19) & luhn(_digits(t))
    return lambda t: F.length(_digits(t)).between(10, 15)


FEATURES = ["rank", "length", "digits", "separators", "digit_share", "luhn", "cue_left",
            "cue_right", "against", "touches", "repeats", "other_format"]


def features(kind: Column, text: Column, left: Column, right: Column) -> list[Column]:
    """Format and context of a candidate, as numbers in the order of FEATURES."""
    n = F.length(_digits(text))
    cue = lambda c: F.coalesce(*[F.when(kind == k, c.rlike(p)) for k, p in CUES.items()],
                               F.lit(False))
    rank = F.coalesce(*[F.when(kind == k, F.lit(float(i))) for i, k in enumerate(KINDS)])
    cast = lambda c: c.cast("double")
    return [rank, cast(F.length(text)), cast(n),
            cast(F.length(F.regexp_replace(text, "[A-Za-z0-9]", ""))),
            cast(n) / F.greatest(F.length(text), F.lit(1)), cast(luhn(_digits(text))),
            cast(cue(left)), cast(cue(right)), cast(left.rlike(AGAINST)),
            cast(left.rlike("[A-Za-z0-9_=]$") | right.rlike("^[A-Za-z0-9_]")),
            cast(text.rlike(r"([0-9])\1{4}")),
            cast(text.rlike(FORMATS) | ((kind == "phone") & text.rlike(ID_FORMAT)))]


# ---- the model -----------------------------------------------------------
TRAIN_ROWS = 4_000    # generated labelled candidates, the bound of the fit
MIN_PRECISION = 0.97  # what a kind's threshold must reach on rows held back
_MODEL: dict = {}


def labelled(spark: SparkSession) -> DataFrame:
    """Generated candidates (kind, text, left, right, label): formats and cue
    words of personal data, and look-alikes (order numbers, versions, dates,
    serials, plain numbers) with theirs.  A quarter of either has no cue."""
    rnd = lambda salt, n: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n))
    num = lambda salt, n: F.lpad(rnd(salt, 10 ** n).cast("string"), n, "0")
    pick = lambda salt, xs: F.element_at(F.array(*map(F.lit, xs)), (rnd(salt, len(xs)) + 1).cast("int"))
    shape = lambda salt, xs: F.element_at(F.array(*xs), (rnd(salt, len(xs)) + 1).cast("int"))
    sep = pick(11, ["-", ".", " "])
    name = F.concat(pick(12, ["anna", "j.miller", "info", "sales.team", "kim77"]), num(13, 2))
    host = F.concat(pick(14, ["mailbox", "post", "corp", "web"]), num(15, 2))
    value = {
        "email": F.concat(name, pick(16, [" [at] ", " (at) ", "[AT]"]), host,
                          pick(17, [" [dot] ", ".", " (dot) "]), pick(18, ["com", "org", "net"])),
        "ip": F.concat_ws(".", num(21, 3), num(22, 3), num(23, 3), num(24, 3)),
        "card": F.concat(num(31, 4), sep, num(32, 4), sep, num(33, 4), sep, num(34, 4)),
        "phone": shape(40, [
            F.concat(F.lit("("), num(41, 3), F.lit(") "), num(42, 3), sep, num(43, 4)),
            F.concat(num(41, 3), sep, num(42, 3), sep, num(43, 4)),
            F.concat(F.lit("1"), sep, num(41, 3), sep, num(42, 3), sep, num(43, 4)),
            F.concat(F.lit("0"), num(44, 2), sep, num(45, 7)),
            F.concat(F.lit("0"), num(44, 3), F.lit("/"), num(45, 7)),
            F.concat_ws(" ", F.concat(F.lit("0"), num(44, 1)), num(46, 2), num(47, 2), num(48, 2), num(49, 2)),
            F.concat(F.lit("0"), num(44, 3), sep, num(42, 3), sep, num(41, 3), sep, num(46, 2)),
            F.concat(F.lit("(0"), num(44, 2), F.lit(") "), num(43, 4), sep, num(40, 4)),
            F.concat(num(42, 3), sep, num(43, 4)), num(39, 10), F.concat(F.lit("0"), num(39, 11))]),
        "id": F.concat(num(51, 3), F.lit("-"), num(52, 2), F.lit("-"), num(53, 4)),
        "iban": F.concat(pick(61, ["DE", "FR", "ES", "GB"]), num(62, 2), F.lit(" "), num(63, 4),
                         F.lit(" "), num(64, 4), F.lit(" "), num(65, 4), F.lit(" "), num(66, 4)),
    }
    other = {
        "email": F.concat(F.lit("look"), F.lit(" (at) "), pick(71, ["home", "noon", "page"]),
                          F.lit("."), pick(72, ["Then", "It", "3"])),
        "ip": F.concat_ws(".", num(73, 3), num(74, 1), num(75, 4), num(76, 3)),
        "card": num(77, 16),
        "phone": shape(92, [
            F.concat(num(78, 3), sep, num(79, 3), sep, num(80, 4)),
            F.concat(F.lit("20"), num(93, 2), sep, pick(94, ["01", "07", "12"]), sep, pick(95, ["03", "14", "28"])),
            F.concat(pick(95, ["3", "14", "28"]), sep, pick(94, ["1", "07", "12"]), sep, F.lit("20"), num(93, 2)),
            F.concat(F.lit("19"), num(93, 2), F.lit("-"), F.lit("20"), num(78, 2)),
            F.concat(num(78, 3), F.lit("-"), num(93, 2), F.lit("-"), num(80, 4)), num(79, 8)]),
        "id": F.concat(num(81, 3), F.lit("-"), num(82, 2), F.lit("-"), num(83, 4)),
        "iban": F.concat(pick(84, ["AB", "SN", "ZX"]), num(85, 2), num(86, 4), num(87, 4), num(88, 4)),
    }
    cues = {"email": ["email me at ", "contact: "], "ip": ["login from ip ", "host "],
            "card": ["visa card ", "credit card no: "], "phone": ["call ", "phone: ", "tel "],
            "id": ["ssn ", "social security "], "iban": ["iban ", "bank account "]}
    plain = ["", "the ", "and of ", "it was in ", "see ", "a "]
    against = ["order ", "invoice #", "version ", "serial ", "part no ", "tracking ", "ref "]
    rows = spark.range(TRAIN_ROWS, numPartitions=1)
    kind = F.element_at(F.array(*map(F.lit, KINDS)), (rnd(1, len(KINDS)) + 1).cast("int"))
    label = rnd(2, 2) == 1
    by_kind = lambda xs: F.coalesce(*[F.when(F.col("kind") == k, x) for k, x in xs.items()])
    rows = rows.withColumn("kind", kind).withColumn("label", label.cast("double"))
    cue = by_kind({k: pick(3, v) for k, v in cues.items()})
    # Without any cue, only a format that is rarely something else counts.
    bare = F.col("kind").isin("email", "iban")
    left = (F.when((F.col("label") == 1) & (~bare | (rnd(4, 4) > 0)), cue)
            .when(F.col("label") == 1, pick(5, plain))
            # Dates and ids follow cues of phones too.
            .when((F.col("kind") == "phone") & (rnd(7, 2) == 1) & rnd(92, 6).between(1, 4)
                  & (rnd(96, 2) == 0), cue)
            .when(rnd(4, 2) == 0, pick(6, against)).otherwise(pick(5, plain)))
    text = F.when(F.col("label") == 1, by_kind(value)).when(
        (rnd(7, 2) == 0) & ~bare, by_kind(value)).otherwise(by_kind(other))
    return rows.select("id", "kind", "label", left.alias("left"), text.alias("text"),
                       pick(8, [" and", ".", ", the", " or later", ""]).alias("right"))


def model(spark: SparkSession) -> tuple[list, dict[str, float]]:
    """The compiled trees and the threshold of each kind, fitted once a process."""
    if not _MODEL:
        cols = features(F.col("kind"), F.col("text"), F.col("left"), F.col("right"))
        rows = labelled(spark).select("id", "kind", "label",
                                      *[c.alias(n) for c, n in zip(cols, FEATURES)]).cache()
        held = F.pmod(F.xxhash64("id", F.lit(99)), F.lit(4)) == 0
        trees = boosted.train(rows.filter(~held), FEATURES, "label", trees=10)
        scored = rows.filter(held).select(
            "kind", "label", boosted.score(trees, [F.col(n) for n in FEATURES]).alias("p"))
        grid = scored.select("kind", "label", "p", F.explode(F.expr(
            "transform(sequence(10, 19), x -> x / 20.0D)")).alias("t")).filter("p >= t")
        table = grid.groupBy("kind", "t").agg(F.avg("label").alias("precision")).collect()
        found: dict[str, float] = {}
        for r in sorted(table, key=lambda r: -r["t"]):
            if r["precision"] >= MIN_PRECISION and found.get(r["kind"], 2) > 0:
                found[r["kind"]] = r["t"]
        rows.unpersist()
        _MODEL["trees"], _MODEL["at"] = trees, found
    return _MODEL["trees"], _MODEL["at"]


# ---- spans ---------------------------------------------------------------
def _found(text: Column, guard: str, pattern: str) -> Column:
    """[(piece, match)] in text order: what precedes each match, and the match."""
    none = F.array().cast("array<struct<piece:string,match:string>>")
    has = text.contains(guard) if guard == "@" else text.rlike(guard)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(has, F.arrays_zip(
        F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches)).alias("piece"),
        matches.alias("match"))).otherwise(none)


def with_spans(docs: DataFrame, text_col: str, out: str) -> DataFrame:
    """``docs`` with a column ``out``: all spans as an array of structs (start,
    rank, end, base) in order; rank is the kind's place in KINDS."""
    spark = docs.sparkSession
    trees, at = model(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    hits = [f"{out}__hits{i}" for i in range(len(GENERATORS))]
    ends = [f"{out}__ends{i}" for i in range(len(GENERATORS))]
    df = docs.withColumns({h: _found(text, g[2], g[3]) for h, g in zip(hits, GENERATORS)})
    df = df.withColumns({e: scan(F.transform(h, lambda z: (
        F.length(z["piece"]) + F.length(z["match"])).cast("long")), lambda a, b: a + b)
        for h, e in zip(hits, ends)})

    def candidates(i: int) -> Column:
        kind, is_base, *_ = GENERATORS[i]
        after = F.concat(F.col(hits[i]), F.array(F.lit(None).cast("struct<piece:string,match:string>")))
        follow = F.slice(after, F.lit(2), F.size(hits[i]))
        before = F.concat(F.array(F.lit(None).cast("struct<piece:string,match:string>")), F.col(hits[i]))
        zipped = F.arrays_zip(F.col(hits[i]).alias("at"), F.col(ends[i]).alias("end"),
                              follow.alias("next"),
                              F.slice(before, F.lit(1), F.size(hits[i])).alias("last"))
        # Numbers of all groupings come close together: the cue may be before the last one.
        near = lambda z: z["at"]["piece"] if kind != "phone" or is_base else F.concat(
            F.coalesce(F.substring(z["last"]["piece"], -CONTEXT, CONTEXT), F.lit("")),
            F.coalesce(z["last"]["match"], F.lit("")), z["at"]["piece"])
        return F.transform(zipped, lambda z: F.struct(
            (z["end"] - F.length(z["at"]["match"])).alias("start"),
            F.lit(KINDS.index(kind)).alias("rank"), z["end"].alias("end"),
            (base_rule(kind)(z["at"]["match"]) if is_base else F.lit(False)).alias("base"),
            z["at"]["match"].alias("match"),
            F.substring(near(z), -CONTEXT, CONTEXT).alias("left"),
            F.substring(F.coalesce(z["next"]["piece"], F.lit("")), 1, CONTEXT).alias("right")))

    def measured(c: Column) -> Column:
        kind = F.element_at(F.array(*map(F.lit, KINDS)), c["rank"] + 1)
        return F.struct(*slim(c), F.array(*features(
            kind, c["match"], c["left"], c["right"])).alias("x"))

    def chosen(c: Column) -> Column:
        cut = F.element_at(F.array(*[F.lit(at.get(k, 2.0)) for k in KINDS]), c["rank"] + 1)
        return boosted.score(trees, [c["x"][i] for i in range(len(FEATURES))]) >= cut

    def slim(c: Column) -> list[Column]:
        return [c[f].alias(f) for f in ("start", "rank", "end", "base")]

    # Number runs too long or short for a card are no candidates for scoring.
    open_ = lambda c: ~c["base"] & (
        (c["rank"] != 2) | F.length(_digits(c["match"])).between(13, 19))
    every, base, extra = f"{out}__all", f"{out}__base", f"{out}__extra"
    df = df.withColumn(every, F.concat(*[candidates(i) for i in range(len(GENERATORS))]))
    df = df.withColumns({
        base: F.transform(F.filter(every, lambda c: c["base"]), lambda c: F.struct(*slim(c))),
        extra: F.transform(F.filter(every, open_), measured)})
    df = df.withColumn(extra, F.transform(F.filter(extra, chosen), lambda c: F.struct(*slim(c))))
    # In order of start: the furthest end of a base span so far, and (counted
    # down from FAR) the nearest start of one from here on.
    both, pre, post = f"{out}__both", f"{out}__pre", f"{out}__post"
    df = df.withColumn(both, F.array_sort(F.concat(F.col(base), F.col(extra))))
    df = df.withColumns({
        pre: scan(F.transform(both, lambda c: F.when(c["base"], c["end"]).otherwise(F.lit(0).cast("long"))),
                  F.greatest),
        post: F.reverse(scan(F.reverse(F.transform(both, lambda c: F.when(
            c["base"], FAR - c["start"]).otherwise(F.lit(0).cast("long")))), F.greatest))})
    df = df.withColumn(out, F.transform(F.filter(
        F.arrays_zip(F.col(both).alias("c"), F.col(pre).alias("pre"), F.col(post).alias("post")),
        lambda z: z["c"]["base"] | ((z["pre"] <= z["c"]["start"])
                                    & (FAR - z["post"] >= z["c"]["end"]))), lambda z: z["c"]))
    return df.drop(*hits, *ends, every, base, extra, both, pre, post)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, found): the spans of every text."""
    return with_spans(docs.select(id_col, text_col), text_col, "found").select(id_col, "found")


def redact(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``docs`` with every span replaced by its kind, like ``[EMAIL]``; spans
    that overlap become one mark.  All columns pass through in order."""
    spans, top, marks = "__pii_spans", "__pii_top", "__pii_marks"
    df = with_spans(docs, text_col, spans)
    # Where earlier spans end, so that overlapping ones are cut once.
    df = df.withColumn(top, scan(F.transform(spans, lambda s: s["end"]), F.greatest))
    before = F.concat(F.array(F.lit(0).cast("long")), F.col(top))
    df = df.withColumn(marks, F.arrays_zip(F.col(spans).alias("s"), F.slice(
        before, F.lit(1), F.size(spans)).alias("from")))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    block = 64

    def cut(b: Column) -> Column:
        part = F.slice(F.col(marks), b * block + 1, F.lit(block))
        first = F.element_at(part, 1)["from"]
        last = F.element_at(part, -1)["s"]["start"]
        own = F.substring(F.col(text_col), (first + 1).cast("int"),
                          F.greatest(last - first, F.lit(0)).cast("int"))
        return F.array_join(F.transform(F.arrays_zip(
            part.alias("m"), F.array_repeat(own, F.size(part)).alias("own")), lambda z: F.when(
                z["m"]["s"]["start"] >= z["m"]["from"],
                F.concat(F.substring(z["own"], (z["m"]["from"] - first + 1).cast("int"),
                                     (z["m"]["s"]["start"] - z["m"]["from"]).cast("int")),
                         F.element_at(names, z["m"]["s"]["rank"] + 1))).otherwise("")), "")

    body = F.array_join(F.transform(F.sequence(
        F.lit(0), F.floor((F.size(marks) - 1) / block).cast("int")), cut), "")
    rest = F.substring(F.col(text_col), (F.element_at(F.col(top), -1) + 1).cast("int"),
                       F.length(text_col))
    new = F.when(F.size(marks) == 0, F.col(text_col)).otherwise(F.concat(body, rest))
    df = df.withColumn(text_col, new)
    if chars_col in docs.columns:
        kind = dict(docs.dtypes)[chars_col]
        df = df.withColumn(chars_col, F.when(F.size(spans) == 0, F.col(chars_col)).otherwise(
            F.length(text_col).cast(kind)))
    return df.select(*[F.col(f"`{c}`") for c in docs.columns])
