"""The pipeline stage by stage, and as a whole, against what the operators'
plain versions promise."""

import re

import corpus_pipeline as P
from parcelstream.llm import bpe, common, registry

from test_llm_corpus_ops import plain_components

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = common.table(spark, SF, "documents")
    columns = docs.columns
    seen = {}
    for name, stage in P.STAGES:
        docs = common.stored(stage(spark, docs, SF), f"test-{name}")
        seen[name] = docs
        if name != "bpe":
            assert docs.columns == columns

    kept = {r.doc_id for r in registry.op7_quality_rules(spark, SF).filter("kept").collect()}
    clean = [(r.doc_id, r.text) for r in seen["quality_rules"].collect()]
    assert {i for i, _ in clean} == kept

    known = plain_components(clean, P.NEAR_PERCENT)
    assert {r.doc_id for r in seen["near_dedup"].collect()} == {i for i in known if known[i] == i}

    redacted = seen["pii"].collect()
    assert len(redacted) == seen["near_dedup"].count()
    assert not [r for r in redacted if re.search(r"[A-Za-z0-9]@[a-z0-9-]+\.[a-z]", r.text)]
    assert all(r.n_chars == len(r.text) for r in redacted)

    texts = {r.doc_id: r.text for r in redacted}
    drawn = seen["mix"].collect()
    assert all(r.text == texts[r.doc_id] for r in drawn)
    ids = [r.doc_id for r in drawn]
    assert max(map(ids.count, set(ids))) <= 3

    path, pattern = registry.tokenizer()
    encoder = bpe.Encoder(bpe.read_ranks(bpe.vocabulary(path)), pattern)
    out = seen["bpe"].collect()
    assert sorted(r.doc_id for r in out) == sorted(ids)
    assert all(r.ids == encoder.ids(texts[r.doc_id]).tolist() and r.n_tokens == len(r.ids) for r in out)


def through(spark, docs):
    """Each stage's rows, all of them in memory."""
    seen = {}
    for name, stage in P.STAGES:
        docs = common.stored(stage(spark, docs, ""), f"test-{name}")
        seen[name] = docs.collect()
    return seen


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_on_an_empty_table(spark):
    seen = through(spark, spark.createDataFrame([], SCHEMA))
    assert seen == {name: [] for name, _ in P.STAGES}


def test_stages_on_null_empty_and_repeated_rows(spark):
    good = " ".join(f"{w} stands in sentence {i} of this clean text," for i, w in enumerate(
        "alpha beta gamma delta epsilon zeta eta theta iota kappa".split())) + " and ends."
    other = good.replace("clean", "plain").replace("sentence", "line")
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, good, "en", None, len(good)),
            (3, good, "en", None, len(good)), (None, other, None, "a", None), (4, good, "en", "b", 1)]
    seen = through(spark, spark.createDataFrame(rows, SCHEMA))
    assert sorted(r.doc_id for r in seen["quality_rules"] if r.text == good) == [3, 3, 4]
    assert sorted((r.doc_id for r in seen["near_dedup"]), key=repr) == [3, None]
    assert {r.doc_id for r in seen["mix"]} <= {3, None}
    assert all(r.n_tokens == len(r.ids) for r in seen["bpe"])


def test_run_and_rerun_agree(spark):
    first = sorted((r.doc_id, r.n_tokens, r.decoded_sha256) for r in P.run(spark, SF).collect())
    assert first and first == sorted(
        (r.doc_id, r.n_tokens, r.decoded_sha256) for r in P.run(spark, SF).collect())
