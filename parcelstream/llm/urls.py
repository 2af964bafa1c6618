"""URL verdicts: rules first, then naive Bayes over segmented host words.

A rule fits its host and all subdomains, on paths that start with the rule's;
the longest rule wins.  Urls without a rule go to a multinomial naive Bayes model
that learns from all urls with one.  Its tokens are the words of the host and of
the path; runs of letters in the host are split into words by Viterbi over
unigram counts of all words in the pages' own text; an unknown piece of any
length is one word, which costs more the longer it is.

Only the counts of words that occur inside some host name reach the splitting,
by a join on the names' substrings of the lengths that words have, and each distinct name is split once however
many pages it has.  Tokens are hashed to ``BUCKETS`` places, which bounds the
model whatever the vocabulary.

Defined cases: a null url, or one without ``://``, has an empty host and path
and no tokens, so the model's prior decides; with no rule hit anywhere, and on
equal scores, the verdict is allow; rows that repeat are judged alike; a null
page id stays; columns other than id, url and html are not read.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelstream.llm import common

# Fixed rules: verdict, host, path.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
BUCKETS = 1 << 16
SMOOTH = 0.1           # added to the counts of the places that some url with a rule has
LETTER = math.log(1 / 20)  # what each letter of an unknown piece costs
RUNS = r"\p{L}+|#"


def host(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1)
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def rule(host_: Column, path_: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule text, its verdict), null where none fits; the longest first."""
    text = verdict = None
    for says, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host_ == h) | host_.endswith("." + h)) & path_.startswith(p)
        text = F.when(fits, h + p) if text is None else text.when(fits, h + p)
        verdict = F.when(fits, says) if verdict is None else verdict.when(fits, says)
    return text, verdict


def runs(text: Column) -> Column:
    """Runs of letters, and # for each run of digits."""
    return F.regexp_extract_all(F.regexp_replace(F.lower(text), "[0-9]+", "#"), F.lit(RUNS), F.lit(0))


def split_name(name: str, pieces: list[tuple[int, int, int]], total: int) -> list[str]:
    """The likeliest words of ``name``: ``pieces`` are (start, length, count) of
    its substrings that are words.  Of equal splits the one with fewer words."""
    logs: dict[int, list[tuple[int, float]]] = {}
    for start, length, count in pieces:
        logs.setdefault(start + length, []).append((start, math.log(count / total)))
    opened = math.log(1.0 / (total + 1))
    # Per end, the best split as (log, minus words, start of its last piece).  The
    # last piece is a word or an unknown run; two runs side by side cost more than one.
    best: list[tuple[float, int, int]] = [(0.0, 0, 0)]
    run = (-math.inf, 0, 0)
    for end in range(1, len(name) + 1):
        log, words, _ = best[end - 1]
        run = max((log + opened + LETTER, words - 1, end - 1), (run[0] + LETTER, *run[1:]))
        options = [(best[s][0] + p, best[s][1] - 1, s) for s, p in logs.get(end, ())]
        best.append(max([run, *options]))
    words, end = [], len(name)
    while end:
        start = best[end][2]
        words.append(name[start:end])
        end = start
    return words[::-1]


def word_counts(pages: DataFrame, html_col: str, longest: int) -> DataFrame:
    """(word, count) over the text of all pages, of words that fit into a name."""
    text = F.lower(F.regexp_replace(F.coalesce(html_col, F.lit("")), r"<[^>]*+>", " "))
    return (pages.select(F.explode(F.split(text, r"\P{L}+")).alias("word"))
            .filter(F.length("word").between(1, longest))
            .groupBy("word").agg(F.count("*").alias("count")))


def segmented(named: DataFrame, pages: DataFrame, html_col: str) -> DataFrame:
    """(host, words): every run of letters of ``named(host, name)`` split into
    words.  A name is cut at each place into substrings of the lengths that words
    have, which are no longer than the longest name."""
    names = named.select("name").distinct()
    longest = names.agg(F.max(F.length("name"))).first()[0] or 0
    counts = common.stored(word_counts(pages, html_col, longest), "words")
    sizes = [r[0] for r in counts.select(F.length("word")).distinct().collect()]  # up to ``longest``
    subs = (names.select("name", F.explode(F.expr("sequence(1, length(name))")).alias("start"))
            .select("name", "start", F.explode(F.lit(sizes or [1])).alias("length"))
            .filter("start + length - 1 <= length(name)")
            .withColumn("word", F.expr("substring(name, start, length)")))
    total = counts.agg(F.sum("count")).first()[0] or 1
    found = (names.join(subs.join(counts, "word").groupBy("name").agg(F.collect_list(
        F.struct(F.col("start") - 1, "length", "count")).alias("pieces")), "name", "left"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [split_name(name, [tuple(p.values()) for p in pieces or ()], total)
                   for name, pieces in zip(b.column("name").to_pylist(), b.column("pieces").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("name"), pa.array(out, pa.list_(pa.string()))],
                                             names=["name", "words"])

    words = found.mapInArrow(run, "name string, words array<string>")
    return named.join(words, "name").groupBy("host").agg(F.flatten(F.collect_list("words")).alias("words"))


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
          rules=RULES, learn: Column | None = None) -> DataFrame:
    """(id, host, path, rule, verdict, score) of every page; the score is the
    model's log odds of allow.  ``learn`` narrows down the pages with a rule that
    the model learns from."""
    common.bound_batches(pages.sparkSession)
    h, p = host(F.col(url_col)), path(F.col(url_col))
    learn = F.lit(True) if learn is None else F.coalesce(learn, F.lit(False))
    rows = pages.select(F.col(id_col).alias("id"), h.alias("host"), p.alias("path"), learn.alias("learn"))
    text, says = rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": text, "says": says})
    named = common.stored(rows.select("host").distinct().select(
        "host", F.explode(runs(F.col("host"))).alias("name")), "names")
    hosts = common.stored(segmented(named, pages, html_col), "hosts")
    place = lambda ws: F.transform(ws, lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int"))
    none = F.array().cast("array<string>")
    rows = common.stored(rows.join(hosts, "host", "left").select(
        "id", "host", "path", "rule", "says", "learn",
        place(F.concat(F.coalesce("words", none), runs(F.col("path")))).alias("places")), "urls")

    known = rows.filter("says is not null and learn")
    seen = known.select("says", F.explode("places").alias("place")).groupBy("place", "says").agg(
        F.count("*").alias("n")).collect()  # two rows a bucket at most
    prior = dict(known.groupBy("says").count().collect())
    n = {k: np.zeros(BUCKETS) for k in ("allow", "block")}
    for r in seen:
        n[r["says"]][r["place"]] += r["n"]
    # Only places that some url with a rule has are smoothed and weighed: a token
    # seen in neither class says nothing, and a class's size plays no part in it.
    used = (n["allow"] + n["block"]) > 0
    share = {k: (v[used] + SMOOTH) / (v.sum() + SMOOTH * used.sum()) for k, v in n.items()}
    odds = np.zeros(BUCKETS)
    odds[used] = np.log(share["allow"]) - np.log(share["block"])
    first = math.log((prior.get("allow", 0) + SMOOTH) / (prior.get("block", 0) + SMOOTH))
    model = pages.sparkSession.sparkContext.broadcast((first, odds))  # BUCKETS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, weight = model.value
        for b in batches:
            places = b.column("places")
            flat = weight[places.flatten().to_numpy()]
            ends = np.cumsum(pa.compute.list_value_length(places).to_numpy())
            sums = [part.sum() for part in np.split(flat, ends[:-1])] if len(ends) else []
            score = pa.array(start + np.array(sums, np.float64), pa.float64())
            keep = [b.column(c) for c in ("id", "host", "path", "rule", "says")]
            yield pa.RecordBatch.from_arrays([*keep, score],
                                             names=["id", "host", "path", "rule", "says", "score"])

    kind = dict(pages.dtypes)[id_col]
    scored = rows.mapInArrow(run, f"id {kind}, host string, path string, rule string, says string, "
                                  "score double")
    return scored.select(
        F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("says", F.when(
            F.col("score") < 0, "block").otherwise("allow")).alias("verdict"), "score")
