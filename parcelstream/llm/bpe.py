"""Byte-level BPE: merges as a lazily determinised transducer, and streaming
decoding through an incremental UTF-8 machine.

Every prefix of a piece has one BPE encoding, and dropping that encoding's last
token gives the encoding of a shorter prefix.  So the encoding of a prefix is
known from its last token, and a token may follow another exactly if no merge
across their border would come before the merges that make the two.  The
transducer reads bytes; its state is the longest beginning of a token that the
bytes read so far end with, so there are no more states than such beginnings.  A
transition carries the tokens that may end there, longest first, and the first
that may follow the last token of the prefix before it is the last token of the
prefix read so far; such checks are remembered by pair of tokens.  Where no
beginning is open, nothing can reach back any more, and the tokens up to here
are emitted.  A beginning is shorter than the longest token, which bounds the
lookahead.  Transitions are made when first needed; a worker forgets them beyond
``MOVES`` and pairs beyond ``PAIRS``, which are made again when needed.

Text is split by the tokenizer's pattern and each piece goes through the
transducer on its own; special-token strings are ordinary text.

Defined cases: null and empty text give no tokens; ids outside the vocabulary
raise; decoding gives back the exact bytes, and ``Utf8Stream`` hands on complete
characters only, keeping an incomplete tail for the next chunk.  Rows pass one
by one, so repeated rows, ids and other columns play no part.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from parcelstream.llm import common

MOVES = 300_000        # transitions a worker remembers
PAIRS = 400_000        # pairs of tokens whose check a worker remembers
WORDS = 250_000        # short words whose tokens a worker remembers
WORD_CHARS = 40        # longer words are encoded anew each time


def read_ranks(data: bytes) -> dict[bytes, int]:
    """The vocabulary of a rank file: one base64 token and its rank a line."""
    return {base64.b64decode(t): int(r) for t, r in
            (line.split() for line in data.splitlines() if line)}


def last_merge(ranks: dict[bytes, int], token: bytes) -> list[bytes]:
    """The two parts that plain merging, lowest rank first, joins last to make
    ``token``; the parts left over should it not be able to."""
    parts = [token[i:i + 1] for i in range(len(token))]
    while len(parts) > 2:
        best = min(range(len(parts) - 1),
                   key=lambda i: ranks.get(parts[i] + parts[i + 1], 1 << 60))
        if parts[best] + parts[best + 1] not in ranks:
            break
        parts[best:best + 2] = [parts[best] + parts[best + 1]]
    return parts


_LAST = 20                    # bits of a pair's right token; above them, the left one
_NONE = (1 << _LAST) - 1      # at the start there is none
_EVER = 1 << 60


class Transducer:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = {i: t for t, i in ranks.items()}
        self.size = {i: len(t) for t, i in ranks.items()}
        self.begins = {t[:i] for t in ranks for i in range(len(t))}
        self.edges: dict[int, tuple[list, list] | None] = {}
        self.pairs: dict[int, bool] = {}
        self.single = {c: (ranks[c.encode()],) for c in ".,;:!?"}
        self.reset()

    def reset(self) -> None:
        """Forgets the determinised part: state 0 has read nothing that is open."""
        self.state: dict[bytes, int] = {b"": 0}
        self.spelled = [b""]
        self.moves: dict[int, tuple[int, tuple]] = {}

    def _move(self, state: int, byte: int) -> tuple[int, tuple]:
        """(next state, tokens that may end here as (size, token), longest first):
        the next state is the longest beginning of a token that ends here."""
        read = self.spelled[state] + bytes((byte,))
        ends = [read[i:] for i in range(len(read) + 1)]
        open_part = next(e for e in ends if e in self.begins)
        to = self.state.setdefault(open_part, len(self.spelled))
        if to == len(self.spelled):
            self.spelled.append(open_part)
        tokens = tuple((len(e), self.ranks[e]) for e in ends if e in self.ranks)
        move = self.moves[(state << 8) + byte] = (to, tokens)
        return move

    def _sides(self, token: int) -> tuple[list, list] | None:
        """The parts at the token's left and right border while it is made, as
        (bytes, made at, consumed at); None if merging can't make it."""
        if token not in self.edges:
            sides: tuple[list, list] | None = ([], [])
            for side, end in ((sides[0], 0), (sides[1], -1)):
                part, until = self.bytes[token], _EVER
                while sides is not None:
                    made = self.ranks[part] if len(part) > 1 else -1
                    side.append((part, made, until))
                    if len(part) == 1:
                        break
                    parts = last_merge(self.ranks, part)
                    if len(parts) > 2:
                        sides = None
                    part, until = parts[end], made
            self.edges[token] = sides
        return self.edges[token]

    def _apart(self, last: int, token: int) -> bool:
        """Whether ``token`` may follow ``last``: no merge across their border
        comes before those that make the two."""
        right = self._sides(token)
        if right is None or last == _NONE:
            return right is not None
        for a, made_a, until_a in self._sides(last)[1]:
            for b, made_b, until_b in right[0]:
                rank = self.ranks.get(a + b)
                if rank is not None:
                    when = max(rank, made_a, made_b)
                    # Of equal ranks the merge further left comes first.
                    if when < until_a and when <= until_b and (
                            made_a < until_b and made_b < until_a):
                        return False
        return True

    def encode(self, piece: bytes) -> list[int]:
        if piece in self.ranks:
            return [self.ranks[piece]]
        if len(self.moves) > MOVES:
            self.reset()
        if len(self.pairs) > PAIRS:
            self.pairs.clear()
        moves, pairs, out = self.moves, self.pairs, []
        ends = [_NONE]        # the last token at each position not yet emitted
        state = 0
        for byte in piece:
            move = moves.get((state << 8) + byte) or self._move(state, byte)
            state, tokens = move
            for size, token in tokens:
                last = ends[-size]
                key = (last << _LAST) + token
                fits = pairs.get(key)
                if fits is None:
                    fits = pairs[key] = self._apart(last, token)
                if fits:
                    ends.append(token)
                    break
            if not state:     # no beginning is open: all tokens up to here are decided
                out += self._trace(ends)
                ends = [token]
                if len(moves) > 2 * MOVES or len(pairs) > 2 * PAIRS:  # one very long piece
                    self.reset()
                    moves = self.moves
                    pairs.clear()
        return out + self._trace(ends)

    def _trace(self, ends: list[int]) -> list[int]:
        out, at, size = [], len(ends) - 1, self.size
        while at:
            token = ends[at]
            out.append(token)
            at -= size[token]
        return out[::-1]


class Encoder(dict):
    """A word after a single space -> its ids with the space, remembering short
    ones; None where the word starts or ends with white space or is empty.

    The pattern never matches across a place before a space that stands between
    two other characters, so words cut there are encoded on their own; a text
    with any other white space around its spaces is split as a whole."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        super().__init__()
        self.machine, self.find = Transducer(ranks), regex.compile(pattern).findall

    def _ids(self, text: str) -> tuple[int, ...]:
        encode = self.machine.encode
        return tuple(i for piece in self.find(text) for i in encode(piece.encode("utf-8")))

    def __missing__(self, word: str) -> tuple[int, ...] | None:
        core = word[:-1]
        if word.isalpha():  # one piece, letters being the same to the pattern
            ids = tuple(self.machine.encode(b" " + word.encode("utf-8")))
        elif core.isalpha() and word[-1] in ".,;:!?":  # two; the core is remembered
            return self[core] + self.machine.single[word[-1]]
        elif not word or word[0].isspace() or word[-1].isspace():
            ids = None
        else:
            ids = self._ids(" " + word)
        if len(word) <= WORD_CHARS and len(self) < WORDS:
            self[word] = ids
        return ids

    def ids(self, text: str) -> np.ndarray:
        first, *words = text.split(" ")
        if words and first and not first[-1].isspace():
            parts = list(map(self.__getitem__, words))
            if None not in parts:
                    return np.fromiter(chain(self._ids(first), chain.from_iterable(parts)), np.int32)
        return np.array(self._ids(text), np.int32)


# Fixed values, the well-formed UTF-8 sequences: lead bytes from and to, bytes
# that follow, and the range of the first of them (the others: 80 to BF).
UTF8 = [(0xC2, 0xDF, 1, 0x80, 0xBF), (0xE0, 0xE0, 2, 0xA0, 0xBF), (0xE1, 0xEC, 2, 0x80, 0xBF),
        (0xED, 0xED, 2, 0x80, 0x9F), (0xEE, 0xEF, 2, 0x80, 0xBF), (0xF0, 0xF0, 3, 0x90, 0xBF),
        (0xF1, 0xF3, 3, 0x80, 0xBF), (0xF4, 0xF4, 3, 0x80, 0x8F)]
_AFTER = {lead: (more, low, high) for first, last, more, low, high in UTF8
          for lead in range(first, last + 1)}
_DONE = (0, 0, 0)


class Utf8Stream:
    """Bytes in, complete characters out.  The state is what an open character
    still needs: how many bytes, and the range of the next one.  Bytes that are
    no part of a character pass through as they are.  Of a chunk only its first
    bytes, which may close an open character, and its last character are
    stepped through; what lies between is complete."""

    def __init__(self) -> None:
        self.tail, self.state = b"", _DONE

    @property
    def missing(self) -> int:
        return self.state[0]

    def _step(self, byte: int) -> bool:
        """Moves on by one byte; whether it belongs to the open character."""
        more, low, high = self.state
        if more and low <= byte <= high:
            self.state = (more - 1, 0x80, 0xBF) if more > 1 else _DONE
            return True
        self.state = _AFTER.get(byte, _DONE)
        return False

    def feed(self, chunk: bytes) -> bytes:
        at, head = 0, self.tail
        while self.state != _DONE and at < len(chunk):
            if not self._step(chunk[at]):
                self.state = _DONE   # the open one was none; this byte is looked at below
                break
            at += 1
        if self.state != _DONE:
            self.tail = head + chunk
            return b""
        data = head + chunk
        begin = next((i for i in range(len(data) - 1, max(len(data) - 4, -1), -1)
                      if data[i] & 0xC0 != 0x80), len(data))
        for byte in data[begin:]:
            self._step(byte)
        keep = begin if self.state != _DONE else len(data)
        self.tail = data[keep:]
        return data[:keep]

    def close(self) -> bytes:
        tail, self.tail, self.state = self.tail, b"", _DONE
        return tail


def vocabulary(path: str) -> bytes:
    with open(path, "rb") as f:  # the tokenizer's own file, read by the driver
        return f.read()


def _encoding(file, pattern: str, id_col: str, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = hashlib.sha256(file.value + pattern.encode()).hexdigest()
        encoder = common.kept(("bpe", name), lambda: Encoder(read_ranks(file.value), pattern))
        for b in batches:
            ids = [encoder.ids(t or "") for t in b.column(text_col).to_pylist()]
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            flat = np.concatenate([*ids, np.empty(0, np.int32)])
            yield pa.RecordBatch.from_arrays(
                [b.column(id_col), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                names=[id_col, "ids"])

    return run


def _decoding(file, id_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {i: t for t, i in read_ranks(file.value).items()}
        for b in batches:
            out = []
            for ids in b.column("ids"):
                ids = ids.values.to_numpy() if ids.is_valid else np.empty(0, np.int32)
                stream, parts = Utf8Stream(), []
                for i in range(0, len(ids), 4096):
                    parts.append(stream.feed(b"".join(
                        map(token.__getitem__, ids[i:i + 4096].tolist()))))
                out.append(b"".join([*parts, stream.close()]))
            yield pa.RecordBatch.from_arrays(
                [b.column(id_col), b.column("ids"), pa.array(out, pa.binary())],
                names=[id_col, "ids", "decoded"])

    return run


def _file(df: DataFrame, path: str):
    """The vocabulary for the executors: below 1 MB, whatever the corpus."""
    common.bound_batches(df.sparkSession)
    return df.sparkSession.sparkContext.broadcast(vocabulary(path))


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(id, ids): the tokens of every text."""
    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(
        _encoding(_file(docs, path), pattern, id_col, text_col),
        f"`{id_col}` {kind}, ids array<int>")


def decode(tokens: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, ids, decoded): the bytes of every list of tokens, decoded in chunks."""
    kind = dict(tokens.dtypes)[id_col]
    return tokens.select(id_col, "ids").mapInArrow(
        _decoding(_file(tokens, path), id_col), f"`{id_col}` {kind}, ids array<int>, decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """(id, ids, decoded): ``encode`` and then ``decode``, batch by batch in one
    worker, so that only one of the two holds memory beside the other's rows."""
    file = _file(docs, path)
    first, then = _encoding(file, pattern, id_col, text_col), _decoding(file, id_col)
    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(
        lambda batches: then(first(batches)), f"`{id_col}` {kind}, ids array<int>, decoded binary")
