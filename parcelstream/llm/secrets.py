"""Secret scans: fixed rules, and novelty under dictionary-primed zstandard.

The rules find assignments to secret-like names, access keys and long hex runs.
The method proposes every other token of at least ``SHORT`` characters, whatever
they are (without a letter: ``NUMBER``, as shorter ones are times and telephone
numbers; dates are none), within ``REACH`` characters after a sensitive word.  It
measures the token twice, each time against what a random token of the same
alphabet and length costs:

* the marginal bytes under a dictionary made of common identifiers and the
  token's own surroundings, beyond what an empty text costs;
* the bits under a model of neighbouring characters in identifiers, as short
  texts give zstandard nothing to count.

A token whose two shares together reach ``NOVELTY`` is reported, so neither
decides alone; words, paths, identifiers and repeated strings don't reach it.
Tokens over ``PIECE`` characters are measured in pieces, and adjacent novel
pieces are one span.  A hit at the end of a line extends over directly following
lines that are nothing but a novel token, and over a shorter last one.

Positions count code points, ends are exclusive.  Defined cases: null text is
empty; texts are read whole; repeated rows give equal results; only the id and
the text are read, so other columns play no part.
"""

from __future__ import annotations

import functools
import random
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from parcelstream.llm import common

KINDS = ["assign", "access", "hex", "novel"]
BASE = KINDS[:3]

# Fixed patterns of the rules.  Letters of the names match in either ASCII case.
ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
                    r"([A-Za-z0-9+/_.=-]+)", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # of a run, all of it: as with + and a length test

SENSITIVE = re.compile(r"(?i:bearer|authorization|credential|private|client_?secret|passphrase|"
                       r"access_?key|api_?key|signature|auth|passwd|password|secret|token)", re.ASCII)
# A text without any of these, lower-cased, has no sensitive word.
STEMS = ("bearer", "auth", "credential", "private", "secret", "pass", "access", "api",
         "signature", "token")
SHORT, NUMBER = 12, 16
TOKEN = re.compile(r"[A-Za-z0-9+/_=!@#$%^&*()~-]{12,}")
DATE = re.compile(r"[0-9]{4}-[0-9]{2}-[0-9]{2}")
REACH = 128            # characters after a sensitive word within which a token begins
AROUND = 256           # characters of surroundings on either side
NOVELTY = 1.72         # of the two shares' sum, 2 being that of a random token
PIECE = 4096           # characters measured at a time
# What follows a hit on the next line: a token alone, indented or not.
NEXT_LINE = re.compile(r"\r?\n[\x20\t]*+([A-Za-z0-9+/_=-]++)(?=[\x20\t\r]*+(?:\n|\Z))")
WRAPPED = 32           # width from which on a line may be followed by a shorter last one

# Fixed list of identifiers that code is full of.
IDENTIFIERS = """
abstract access_token account action address application argument array assert async attribute
authorization await background base boolean boundary break buffer button callback catch character
class client client_secret collection column component config configuration connection console
const constructor container content context continue controller counter create current database
default define delete description destination dictionary directory document element else empty
encoding environment error event example exception execute export extends false field file filter
final finally float function getElementById global handler header height hidden identifier image
implements import include index init input instance integer interface iterator javascript key label
length library license list local localhost logger main manager message method module name
namespace native node null number object offset operator option output package parameter parent
parse password path pattern position prefix print private process production property protected
protocol public query reader register remove render replace request require resource response
result return scheduler schema script search select server service session settings static status
storage stream string struct style super switch system table target template thread throw
timestamp token true type undefined update username validate value variable version virtual void
while width window writer
""".strip().encode()


# Alphabets of keys, smallest first; a token counts as drawn from the first that has all of it.
ALPHABETS = [string.digits, string.digits + "abcdef", string.digits + "ABCDEF", string.ascii_lowercase,
             string.ascii_uppercase, string.digits + string.ascii_lowercase,
             string.digits + string.ascii_uppercase, string.ascii_letters,
             string.digits + string.ascii_letters, string.digits + string.ascii_letters + "+/_=-",
             string.digits + string.ascii_letters + "+/_=-!@#$%^&*()~"]


def _alphabet(token: str) -> str:
    own = set(token)
    return next(a for a in ALPHABETS if own <= set(a))


def _neighbours() -> np.ndarray:
    """Bits of each character after each other one, in identifiers of usual styles."""
    words = IDENTIFIERS.decode().replace("_", " ").split()
    pairs = list(zip(words, words[1:] + words[:1]))
    texts = [f"{a}{sep}{b}" for a, b in pairs for sep in "_-/"]
    texts += [a + b.title() for a, b in pairs] + [a.title() + b.title() for a, b in pairs]
    texts += [f"{a}_{b}".upper() for a, b in pairs] + [f"{a}{i % 10}" for i, (a, _) in enumerate(pairs)]
    counts = np.zeros((128, 128))
    chars = [ord(c) for c in ALPHABETS[-1]]
    counts[np.ix_(chars, chars)] = 0.5
    for t in texts:
        raw = np.frombuffer(t.encode(), np.uint8)
        np.add.at(counts, (raw[:-1], raw[1:]), 1)
    total = counts.sum(1, keepdims=True)
    return -np.log2(np.maximum(counts, 1e-9) / np.maximum(total, 1e-9))


class Novelty:
    """What a token costs under a primed dictionary and after its neighbours,
    as shares of what random tokens of its alphabet and length cost."""

    def __init__(self) -> None:
        self.plain = len(zstandard.ZstdCompressor(level=3).compress(b""))
        self.bits = _neighbours()
        self.random = functools.lru_cache(4096)(self._random)

    def cost(self, token: bytes, around: bytes) -> int:
        primed = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(
            IDENTIFIERS + b" " + around, dict_type=zstandard.DICT_TYPE_RAWCONTENT))
        return len(primed.compress(token)) - self.plain

    def letters(self, token: bytes) -> float:
        raw = np.frombuffer(token, np.uint8)
        return float(self.bits[raw[:-1], raw[1:]].mean())

    def _random(self, alphabet: str, length: int) -> tuple[float, float]:
        draw = random.Random(length)
        drawn = ["".join(draw.choices(alphabet, k=length)).encode() for _ in range(3)]
        chars = [ord(c) for c in alphabet]
        return (sum(self.cost(t, b"") for t in drawn) / 3,
                float(self.bits[np.ix_(chars, chars)].mean()))

    def shares(self, text: str, start: int, end: int) -> tuple[float, float]:
        token = text[start:end]
        around = text[max(0, start - AROUND):start] + " " + text[end:end + AROUND]
        bytes_, bits = self.random(_alphabet(token), len(token))
        raw = token.encode()
        return (self.cost(raw, around.encode("utf-8", "replace")) / bytes_, self.letters(raw) / bits)

    def novel(self, text: str, start: int, end: int) -> bool:
        return sum(self.shares(text, start, end)) >= NOVELTY

    def spans(self, text: str, start: int, end: int) -> list[tuple[int, int]]:
        """The novel parts of a token: all of it or nothing up to ``PIECE``."""
        out: list[tuple[int, int]] = []
        pieces = max(1, round((end - start) / PIECE))
        cuts = [start + (end - start) * i // pieces for i in range(pieces + 1)]
        for a, b in zip(cuts, cuts[1:]):
            if self.novel(text, a, b):
                out[-1:] = [(out[-1][0], b)] if out and out[-1][1] == a else [*out[-1:], (a, b)]
        return out


def _mixed(token: str) -> bool:
    """Letters and at least one more kind of character, upper and lower case
    counting as two."""
    kinds = [any(c.islower() for c in token), any(c.isupper() for c in token),
             any(c.isdigit() for c in token), any(not c.isalnum() for c in token)]
    return any(kinds[:2]) and sum(kinds) >= 2


def _bare(text: str, start: int, end: int) -> tuple[int, int]:
    """The token without brackets that only enclose it."""
    while end > start and text[end - 1] == ")" and text.count(")", start, end) > text.count("(", start, end):
        end -= 1
    while end > start and text[start] == "(" and text.count("(", start, end) > text.count(")", start, end):
        start += 1
    return start, end


def _extended(text: str, start: int, end: int, limit: int, novelty: Novelty) -> int:
    """Where a hit ends that goes on over directly following lines, before ``limit``."""
    width = end - start
    while (m := NEXT_LINE.match(text, end)) and m.end() <= limit:
        size = len(m[1])
        if size >= 16 and novelty.spans(text, *m.span(1)) == [m.span(1)]:
            end, width = m.end(), size
        else:
            short = size < width and width >= WRAPPED and (m[1][-1] == "=" or _mixed(m[1]))
            return m.end() if short and (size < 16 or m[1][-1] == "=") else end
    return end


def scan(text: str, novelty: Novelty) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans, further spans) of one text, as (start, kind, end) in order."""
    low = text.lower()
    cued = any(stem in low for stem in STEMS)
    base = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6] if cued else []
    base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    base += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    base.sort()
    more, seen, at, reach = [], 0, 0, 0
    for cue in SENSITIVE.finditer(text) if cued else ():
        last = cue.end() + REACH
        while m := TOKEN.search(text, max(cue.end(), seen), last + SHORT):
            m = TOKEN.match(text, m.start())  # all of it, beyond the reach too
            seen = m.end()
            start, end = _bare(text, *m.span())
            number = not any(map(str.isalpha, text[start:end]))
            if end - start < (NUMBER if number else SHORT) or DATE.match(text, start):
                continue
            while at < len(base) and base[at][0] < end:
                reach = max(reach, base[at][2])
                at += 1
            if reach > start:
                continue
            spans = novelty.spans(text, start, end)
            if spans and spans[-1][1] == m.end():
                limit = base[at][0] if at < len(base) else len(text)
                seen = _extended(text, start, end, limit, novelty)
                spans[-1] = (spans[-1][0], seen)
            more += [(a, 3, b) for a, b in spans]
    return base, more


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, found): all spans of every text in order, with kind and rule or not."""
    common.bound_batches(docs.sparkSession)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("rank", pa.int32()), ("end", pa.int64()),
                               ("base", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty()
        for b in batches:
            out = []
            for text in b.column(text_col).to_pylist():
                base, more = scan(text or "", novelty)
                rows = sorted([(*s, True) for s in base] + [(*s, False) for s in more])
                out.append([dict(zip(("start", "rank", "end", "base"), r)) for r in rows])
            yield pa.RecordBatch.from_arrays([b.column(id_col), pa.array(out, kind)],
                                             names=[id_col, "found"])

    id_type = dict(docs.dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {id_type}, "
             "found array<struct<start:bigint,rank:int,end:bigint,base:boolean>>")
