"""Lines of any length by the quality rules."""

import random

from parcelstream.llm import common, quality

from test_llm_text_ops import PROSE


def prose(n, seed=1):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(3000)]
    weights = [1 / (i + 30) for i in range(3000)]
    return " ".join(rnd.choices(vocab, weights, k=n)) + "."


def judged(text):
    found = quality.judge(text.encode(), common.WordHashes(), quality.Rules())
    return found[7], found[6], found[8].decode()


def test_clean_lines_of_every_length_stay():
    for n in (50, 150, 1_000, 20_000, 100_000):
        text = prose(n)
        assert len(set(text.split())) < 0.3 * n or n < 20_000
        assert judged(text) == (True, n, text), n


def test_repetitive_lines_go():
    for line in ("same words here again ok " * 20, "same words here again ok " * 20_000,
                 (prose(200, 2) + " ") * 50, (prose(60, 3) + " ") * 300):
        assert judged(line)[1] == 0
        text = prose(100_000) + "\n" + PROSE + "\n" + line
        assert judged(text)[2] == prose(100_000) + "\n" + PROSE
