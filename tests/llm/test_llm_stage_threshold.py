"""The pipeline's near-duplicate stage links at a similarity of 0.8."""

import itertools
import random

import corpus_pipeline as P
from parcelstream.llm import common

from test_llm_corpus_ops import frame, shingles


def test_stage_links_at_80_percent(spark):
    rnd = random.Random(6)
    rows, share = [], []
    for f in range(30):
        words = [f"f{f}x{rnd.randrange(10 ** 6)}" for _ in range(204)]
        edited = list(words)
        for at in rnd.sample(range(20, 180, 12), 4):  # each edit takes five windows
            edited[at] += "e"
        rows += [(2 * f, " ".join(words)), (2 * f + 1, " ".join(edited))]
        a, b = shingles(rows[-2][1]), shingles(rows[-1][1])
        share.append(len(a & b) / len(a | b))
    assert all(0.8 <= s < 0.85 for s in share)
    rows.append((100, " ".join(w + "z" * (i % 4 == 0) for i, w in enumerate(rows[0][1].split()))))
    kept = sorted(r.doc_id for r in P.near_dedup_stage(spark, frame(spark, rows), "").collect())
    assert kept == [2 * f for f in range(30)] + [100]


def test_stage_equals_brute_force_at_80_percent(spark):
    docs = common.table(spark, "/root/testdata/sf0.001", "documents")
    sets = {r.doc_id: shingles(r.text) for r in docs.collect()}
    group = {i: {i} for i in sets}
    for i, j in itertools.combinations(sets, 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= 80 * len(a | b) and group[i] is not group[j]:
            group[i] |= group[j]
            for k in group[j]:
                group[k] = group[i]
    assert {r.doc_id for r in P.near_dedup_stage(spark, docs, "").collect()} == {min(g) for g in group.values()}
