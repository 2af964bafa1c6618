"""Quality rules, line first: every line is judged on its own (punctuation,
navigation, shouting, repetition, boilerplate), failing lines are removed, and
a document that loses too much of its text goes.

Words are maximal runs of characters other than space and \\t..\\r.  A null or
empty text has no words and is rejected by the word minimum.  A line without a
word is neither judged nor counted as lost.  Equal rows get equal verdicts,
whatever other columns they carry; only the id and the text are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from parcelstream.llm import common

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\r\x0b\x0c"
# Fixed phrases of page furniture, looked for in lower-cased short lines.
BOILERPLATE = re.compile(
    rb"cookie policy|cookie settings|accept (?:all )?cookies|all rights reserved|"
    rb"terms of (?:use|service)|privacy policy|sign up for|subscribe to our|"
    rb"click here|read more|skip to (?:main )?content|back to top|javascript is disabled|"
    rb"enable javascript|share on (?:facebook|twitter)|log in to|lorem ipsum")
SEPARATORS = frozenset([b"|", b">", b"<", b"/", b"-", b"*", b"\xc2\xbb", b"\xe2\x80\xba",
                        b"\xe2\x80\xa2", b"\xc2\xb7"])
TERMINAL = (b".", b"!", b"?", b":", b";", b'"', b"'", b")", b"]", b"\xe2\x80\xa6",
            b"\xe2\x80\x9d", b"\xc2\xbb", b"\xe3\x80\x82")


@dataclass(frozen=True)
class Rules:
    """Line and document thresholds."""
    min_words: int = 10                 # documents: fewer words fail
    max_repeat_percent: int = 20        # documents: words in repeated 5-word windows
    max_lost_percent: int = 50          # documents: words on removed lines
    max_separator_percent: int = 20     # lines: words that only separate others
    max_symbol_percent: int = 30        # lines: symbol characters per word
    max_upper_percent: int = 80         # lines of 5 and more words: ASCII letters in capitals
    min_distinct_percent: int = 30      # lines of 20 and more words: distinct words of a stretch
    boilerplate_words: int = 30         # lines up to this length are searched for phrases
    fragment_words: int = 3             # shorter lines without end punctuation fail


def _stretches(n: int, size: int) -> Iterator[tuple[int, int]]:
    """n words in equal parts of about ``size``."""
    parts = max(1, round(n / size))
    return ((n * i // parts, n * (i + 1) // parts) for i in range(parts))


def repetitive(words: list[bytes], cache: common.WordHashes, rules: Rules) -> bool:
    """Whether a line has few distinct words.  Clean prose of any length has fewer
    the longer it is, so they are counted in stretches of ``STRETCH`` words, and
    what recurs later than that as 5-word windows in stretches of ``FAR_STRETCH``."""
    n = len(words)
    if 100 * sum(len(set(words[a:b])) for a, b in _stretches(n, STRETCH)) < rules.min_distinct_percent * n:
        return True
    if n <= STRETCH:
        return False
    hashes = cache.array(words)
    again = sum(repeated_words(hashes[a:b]) for a, b in _stretches(n, FAR_STRETCH))
    return 100 * again > (100 - rules.min_distinct_percent) * n


def line_fails(line: bytes, words: list[bytes], cache: common.WordHashes, rules: Rules) -> bool:
    n = len(words)
    if n < rules.fragment_words and not words[-1].endswith(TERMINAL):
        return True
    if n > 1 and 100 * sum(w in SEPARATORS for w in words) > rules.max_separator_percent * n:
        return True
    if 100 * (len(line) - len(line.translate(None, SYMBOLS))) > rules.max_symbol_percent * n:
        return True
    if n >= 5:
        upper = len(line) - len(line.translate(None, _UPPER))
        lower = len(line) - len(line.translate(None, _LOWER))
        if 100 * upper > rules.max_upper_percent * (upper + lower):
            return True
    if n >= 20 and repetitive(words, cache, rules):
        return True
    return n <= rules.boilerplate_words and bool(BOILERPLATE.search(line.lower()))


STRETCH, FAR_STRETCH = 100, 1000  # words within which a line's repetition is judged
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))


def repeated_words(hashes: np.ndarray) -> int:
    """Words covered by 5-word windows that occur twice or more."""
    w = common.five_word_windows(hashes)
    s = np.sort(w)
    twice = s[1:][s[1:] == s[:-1]]
    if not len(twice):
        return 0
    hit = np.isin(w, twice)
    edge = np.zeros(len(hashes) + 1, np.int64)
    at = np.flatnonzero(hit)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + 5, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def judge(text: bytes, cache: common.WordHashes, rules: Rules):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept_words, kept, cleaned text)."""
    seen: set[bytes] = set()
    good: list[bytes] = []
    n_words = n_dup = kept_words = 0
    for line in text.split(b"\n"):
        words = line.split()
        if not words:
            good.append(line)
            continue
        n_words += len(words)
        if line in seen:
            n_dup += 1
        elif not line_fails(line, words, cache, rules):
            kept_words += len(words)
            good.append(line)
        seen.add(line)
    word_chars = len(text.translate(None, SPACES).decode("utf-8", "replace"))
    n_symbols = len(text) - len(text.translate(None, SYMBOLS))
    n_repeat = repeated_words(cache.array(text.split()))
    base_failed = n_words < rules.min_words or 100 * n_repeat > rules.max_repeat_percent * n_words
    kept = not base_failed and 100 * (n_words - kept_words) <= rules.max_lost_percent * n_words
    return (n_words, word_chars, n_symbols, n_dup, n_repeat, base_failed, kept_words, kept,
            b"\n".join(good))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            rules: Rules = Rules()) -> DataFrame:
    """One row per document: the counts, the verdict, and the words kept."""
    common.bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = common.kept(("words",), common.WordHashes)
        for b in batches:
            rows = [judge(t, cache, rules)[:8] for t in common.texts(b, text_col)]
            cols = list(zip(*rows)) if rows else [[]] * 8
            types = [pa.int64()] * 5 + [pa.bool_(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [b.column(id_col), *(pa.array(c, t) for c, t in zip(cols, types))], names=names)

    names = [id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
             "base_failed", "kept_words", "kept"]
    kind = dict(docs.dtypes)[id_col]
    schema = (f"`{id_col}` {kind}, n_words long, word_chars long, n_symbols long, "
              "n_dup_lines long, n_repeat_words long, base_failed boolean, kept_words long, "
              "kept boolean")
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def clean(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars",
          rules: Rules = Rules()) -> DataFrame:
    """The documents that stay, with their failing lines removed; all columns
    of ``docs`` pass through, and the character count follows the text."""
    common.bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = common.kept(("words",), common.WordHashes)
        for b in batches:
            found = [judge(t, cache, rules) for t in common.texts(b, text_col)]
            keep = pa.array([f[7] for f in found], pa.bool_())
            new = {text_col: [f[8].decode("utf-8", "replace") for f in found]}
            if chars_col in b.schema.names:
                new[chars_col] = [len(t) for t in new[text_col]]
            cols = [pa.array(new[f.name], f.type) if f.name in new else b.column(i)
                    for i, f in enumerate(b.schema)]
            yield pa.RecordBatch.from_arrays(cols, schema=b.schema).filter(keep)

    return docs.mapInArrow(run, docs.schema)
