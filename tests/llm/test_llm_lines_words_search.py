"""Line dedup, spelling variants and ranked search against plain Python
versions, with null, empty, long, repeated and clashing inputs, and the queries
that SQL can express against DuckDB on whole tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parcelstream.llm import linedup, registry, search, variants
from parcelstream.plans.verify import compare, duck

SF = "/root/testdata/sf0.001"
LOW = {i: i + 32 for i in range(65, 91)}


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("name", sorted(registry.oracles()))
def test_query_equals_sql(spark, name):
    ok, message = compare(registry.queries()[name](spark, SF), duck(SF), registry.oracles()[name])
    assert ok, message


def docs_of(spark, rows):
    """Rows of (id, text), and columns whose names the operators use themselves."""
    return spark.createDataFrame(
        [(i, t, 1, "x", 2, "w") for i, t in rows],
        "doc_id long, text string, h1 int, id string, n int, word string")


# ------------------------------------------------------------------ lines ---
def plain_lines(rows, min_docs=3, min_chars=20, one=False):
    """[(id, n_lines, n_dropped, text)] of the rows, in their order."""
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOW)
    order = lambda i: -math.inf if i is None else i
    held = collections.defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            held[key(line)].add(i)
    first = {}
    for i, t in rows:
        for at, line in enumerate((t or "").split("\n")):
            k, digest = key(line), hashlib.md5((t or "").encode()).digest()
            if i == max(held[k], key=order):
                first[k] = min(first.get(k, (at, digest)), (at, digest))
    out = []
    for i, t in rows:
        lines, kept = (t or "").split("\n"), []
        for at, line in enumerate(lines):
            k = key(line)
            shared = len(k) >= min_chars and len(held[k]) >= min_docs
            top = i == max(held[k], key=order)
            if one:
                top &= (at, hashlib.md5((t or "").encode()).digest()) == first[k]
            if not shared or top:
                kept.append(line)
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def cleaned(spark, rows, **how):
    docs = docs_of(spark, rows)
    out = linedup.cleaned(docs, linedup.keep_bitmaps(docs, **how)).collect()
    return sorted(map(tuple, out), key=repr)


S, T = "A line that several documents share", "another line of some documents"
LINE_ROWS = [
    (1, f"{S}\nown\n  {S.upper()}\t\n{T}"), (2, f"x\n{S}"), (3, f"{S}\n{S}\nend\n"), (4, T),
    (5, None), (6, ""), (7, "\n\n"), (None, f"{S}\nno id"), (None, T), (8, f"{T}\nß {T}"),
    (9, "É" + S), (10, "é" + S), (11, "é" + S), (12, "short"), (13, "short"), (14, "short"),
    (8, f"{T}\nother text of eight"), (2, f"x\n{S}"), (15, "z" * 100_000), (16, "z" * 100_000),
    (17, "Z" * 100_000 + "\n" * 3000 + S),
]


@pytest.mark.parametrize("one", [False, True])
def test_lines_edges(spark, one):
    rows = [r for r in LINE_ROWS if r != (2, f"x\n{S}")] if one else LINE_ROWS
    got = cleaned(spark, rows, keep="line" if one else "document")
    assert got == sorted(plain_lines(rows, one=one), key=repr)


def test_lines_of_empty_tables_and_parameters(spark):
    assert cleaned(spark, []) == []
    rows = [(1, "aa\nbb"), (2, "aa\ncc"), (3, "cc\naa")]
    assert cleaned(spark, rows, min_chars=2, min_docs=2) == [(1, 2, 1, "bb"), (2, 2, 2, ""), (3, 2, 0, "cc\naa")]
    with pytest.raises(ValueError):
        linedup.keep_bitmaps(docs_of(spark, rows), keep="first")


def test_bitmaps_are_runs_of_kept_lines(spark):
    rows = [(i, f"a\n{S}\nb\nc\n{S}") for i in range(3)]
    got = {r.id: [tuple(k) for k in r.keep] for r in linedup.keep_bitmaps(docs_of(spark, rows)).collect()}
    assert got == {0: [(0, 1), (2, 2)], 1: [(0, 1), (2, 2)]}


def test_lines_with_a_hot_one(spark):
    """One line in every document: counted without the sort."""
    rnd = random.Random(3)
    rows = [(i, "\n".join([S, f"only here and nowhere else {i}", *rnd.choices([S, T, "own"], k=2)]))
            for i in range(3000)]
    assert cleaned(spark, rows) == sorted(plain_lines(rows), key=repr)
    assert cleaned(spark, rows, keep="line") == sorted(plain_lines(rows, one=True), key=repr)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "B", "ab", " a", "", "b\t", "Ab"]), max_size=6), max_size=12))
def test_lines_random(spark, texts):
    rows = [(i % 7, "\n".join(t)) for i, t in enumerate(texts)]
    assert cleaned(spark, rows, min_chars=1, min_docs=2) == sorted(
        plain_lines(rows, min_docs=2, min_chars=1), key=repr)


# ------------------------------------------------------------------ words ---
def plain_counts(rows):
    n = collections.Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate(LOW)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    return {w: k for w, k in n.items() if k >= 3 and len(w) >= 5}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return (a[at + 1:] == b[at + 1:] and len(a) == len(b)) or (
        a[at + 1:] == b[at:] or a[at:] == b[at + 1:])


def plain_variants(n):
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    top = {w: min(near[w], key=lambda v: (-n[v], v), default=None) for w in n}
    form = {w: t if t and n[t] >= 2 * n[w] else None for w, t in top.items()}
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, n[w], len(near[w]), form[w], n.get(form[w]), root))
    return out


WORD_ROWS = [
    (1, "letter letter letter LETTER Letters letters letters"), (2, "lettr lettr lettr leter leter leter leter"),
    (3, "letterr letterr letterr lettter lettter lettter etter etter etter xetter xetter xetter"),
    (4, "aaaaa aaaaa aaaaa aaaaaa aaaaaa aaaaaa aaaaaaa aaaaaaa aaaaaaa baaaaa baaaaa baaaaa"),
    (5, "größe größe größe grösse grösse grösse GRÖSSE GRÖSSE GRÖSSE grÖsse"), (6, None), (7, ""),
    (None, "letter letters"), (1, "letter 日本語 letter×letter ÷÷÷÷÷ ÷÷÷÷÷ ÷÷÷÷÷"),
    (8, " ".join(["q" * 31, "q" * 32, "q" * 33, "q" * 34, "r" + "q" * 32] * 3)),
    (9, " ".join(["ab" * 2500, "ab" * 2499 + "a", "ab" * 2499 + "aa", "b" + "ab" * 2499 + "a"] * 3)),
]


def test_words_edges(spark):
    n = plain_counts(WORD_ROWS)
    assert max(map(len, n)) == 5000
    assert set(map(tuple, _variants(spark, WORD_ROWS))) == plain_variants(n)
    assert _variants(spark, []) == []
    with pytest.raises(ValueError):
        variants.words(docs_of(spark, WORD_ROWS), min_letters=3)


def _variants(spark, rows):
    return variants.variants(docs_of(spark, rows)).select(
        "word", "n", "n_near", "form", "form_n", "root").collect()


def test_words_of_one_family(spark):
    """A third of all states at one node, and chains of forms."""
    rnd = random.Random(5)
    words = ["prefix" + "".join(rnd.choices("abc", k=rnd.randrange(1, 6))) for _ in range(1500)]
    words += ["prefixaaa"] * 40 + ["prefixaab"] * 12 + ["prefixabb"] * 6
    rows = [(i, " ".join(words[i::20] * 3)) for i in range(20)]
    assert set(map(tuple, _variants(spark, rows))) == plain_variants(plain_counts(rows))


@settings(max_examples=2, deadline=None)
@given(st.lists(st.text(alphabet="abÀ", min_size=4, max_size=8), max_size=40))
def test_words_random(spark, words):
    rows = [(i, f"{w} {w} {w}") for i, w in enumerate(words)]
    assert set(map(tuple, _variants(spark, rows))) == plain_variants(plain_counts(rows))


# ----------------------------------------------------------------- search ---
PLAIN_TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_search(docs, items, k=10):
    found = [(i, collections.Counter(PLAIN_TERM.findall((t or "").translate(LOW)))) for i, t in docs]
    size = [sum(c.values()) for _, c in found]
    N, L = sum(map(bool, size)), sum(size)
    df = collections.Counter(t for _, c in found for t in c)
    out = []
    for item, text in {(i, t) for i, t in items}:
        scored = []
        for (i, c), n in zip(found, size):
            m = 100 - 75 + (75 * n * N) // L if L else 0
            score = sum(
                times * math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1)))
                * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
                for t, times in collections.Counter(PLAIN_TERM.findall((text or "").translate(LOW))).items()
                if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def searched(spark, docs, items, **how):
    items = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, score int")
    return sorted(map(tuple, search.search(docs_of(spark, docs), items, **how).collect()), key=repr)


def test_search_edges(spark):
    docs = [(1, "The cat sat"), (2, "the CAT, the cat; Katze-käfer"), (3, None), (4, ""), (5, "!!"),
            (None, "the cat sat"), (6, "the cat sat"), (6, "the cat sat"), (7, "dog " * 20_000 + "cat"),
            (8, "Käfer 中文 42"), (9, "KÄFER")]
    items = [(1, "cat sat"), (2, None), (3, "..."), (4, "unheard of"), (5, "cat CAT cat käfer"),
             (5, "dog"), (None, "42 中文"), (1, "cat sat")]
    assert searched(spark, docs, items) == plain_search(docs, items)
    assert searched(spark, docs, items, k=2) == plain_search(docs, items, 2)
    assert searched(spark, [], items) == [] and searched(spark, docs, []) == []


@pytest.mark.parametrize("shard, block", [(50, 1 << 18), (1 << 20, 4)])
def test_search_in_shards_and_blocks(spark, monkeypatch, shard, block):
    monkeypatch.setattr(search, "SHARD", shard)
    monkeypatch.setattr(search, "BLOCK_TERMS", block)
    rnd = random.Random(7)
    words = [f"w{i}" for i in range(30)]
    weights = [1 / (i + 1) for i in range(30)]
    text = lambda n: " ".join(rnd.choices(words, weights, k=n))
    docs = [(i // 2, text(rnd.randrange(1, 40))) for i in range(300)]
    items = [(i, text(rnd.randrange(1, 12))) for i in range(12)]
    assert searched(spark, docs, items) == plain_search(docs, items)


def test_search_stops_early():
    """Where few documents hold the rare terms, the lists' lower parts stay unread."""
    rnd = np.random.default_rng(1)
    docs = 20_000
    parts = [(np.arange(docs), np.zeros(docs), rnd.integers(1, 100, docs)),
             (np.arange(0, 400, 2), np.ones(200), rnd.integers(5000, 9000, 200))]
    doc, term, impact = (np.concatenate(c).astype(np.int64) for c in zip(*parts))
    shard = search.Shard(np.arange(docs), doc, term, impact)
    read = []
    unique, search.np.unique = np.unique, lambda a, **k: (read.append(len(a)), unique(a, **k))[1]
    try:
        ids, scores = shard.top(np.array([0, 1]), np.array([1, 1]), 10, 1)
    finally:
        search.np.unique = unique
    total = np.zeros(docs, np.int64)
    np.add.at(total, doc, impact)
    want = np.lexsort((np.arange(docs), -total))[:10]
    assert list(search._best(ids, scores, 10)[0]) == list(want)
    assert sum(read) < 2000


def test_whole_tables_fit_together(spark):
    """The digest columns come from the operator's own texts."""
    docs = registry.common.table(spark, SF, "documents")
    texts = linedup.cleaned(docs, linedup.keep_bitmaps(docs))
    a = {(r.id, r.n_dropped, hashlib.sha256(r.text.encode()).hexdigest()) for r in texts.collect()}
    b = registry.op12_range_line_dedup(spark, SF).select("doc_id", "n_dropped", F.col("kept_sha256"))
    assert a == set(map(tuple, b.collect()))
