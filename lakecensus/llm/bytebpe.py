"""Byte-level BPE: encoding by a lazily determinised transducer, streaming decoding.

**Encoding.** A sequence of tokens is what the merges make of a piece exactly if the merges leave
each two neighbours as they are (``fits``; the pieces of a text are the matches of the split
pattern). So the merges are compiled into a nondeterministic transducer whose states are (last
token, node of the vocabulary's trie): a byte goes down the trie; a node that spells a token which
fits the last one may close it. For each place of the piece one state at most began there, so few
are alive. The transducer is determinised while it reads: a deterministic state is the set of the
live states, each with the tokens that it has closed and the others haven't. A token is emitted as
soon as all live states agree on it, after a bounded lookahead; the work is linear in the piece,
however long it is. States and steps are kept for the next pieces, up to ``MAX_STATES``.

**Decoding.** An incremental UTF-8 state machine reads one token's bytes after the other; its state
is what has come of an unfinished character. What a token gives in a state is worked out once.
Bytes that are no UTF-8 give U+FFFD for each maximal part, as Unicode advises.

Defined cases: null and empty texts have no tokens and decode to an empty text; a text may be as
long as a row can be; repeated rows are encoded like any other; every column is kept as it is,
except that one named like the new column is replaced; an empty table gives no rows. Vocabularies
must hold all 256 single bytes. Unknown ids are an error.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

MAX_STATES = 250_000  # deterministic states that a worker keeps, and twice as many steps
MAX_PIECES = 300_000  # pieces whose ids a worker keeps
LONGEST_KEPT = 32  # characters of such a piece
LONG_TEXT = 1 << 20  # from here on the pieces of a text aren't listed at once
ROOT = START = 0
_LOADED: dict[tuple[str, str], "Transducer"] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merge(ranks: dict[bytes, int], data: bytes, never: int = -1) -> list[bytes]:
    """The merges themselves: the first pair of the lowest rank becomes one part, until none has a
    rank (other than ``never``). Quadratic: for tokens and pairs of tokens."""
    parts, none = [data[i:i + 1] for i in range(len(data))], 1 << 62
    while len(parts) > 1:
        found = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:])]
        rank = min(none if r == never else r for r in found)
        if rank == none:
            break
        i = found.index(rank)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts


class Transducer:
    """Bytes of one piece in, token ids out."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        if not all(bytes([b]) in ranks for b in range(256)):
            raise ValueError("the vocabulary doesn't hold all 256 single bytes")
        self.ranks, self.max_states = ranks, max_states
        self.bytes_of = {i: token for token, i in ranks.items()}
        self.down: dict[int, int] = {}  # node << 8 | byte -> node
        self.spelt: dict[int, int] = {}  # node -> token
        nodes = 1
        for token, i in ranks.items():
            node = ROOT
            for byte in token:
                below = self.down.get(node << 8 | byte)
                if below is None:
                    below = self.down[node << 8 | byte] = nodes
                    nodes += 1
                node = below
            self.spelt[node] = i
        self.parts: dict[bytes, tuple] = {}
        self.plain: dict[bytes, bool] = {}
        self.edges: dict[tuple[bytes, int], list] = {}
        # a live state is last token + 1 << 32 | node
        self.closes: dict[int, int] = {}
        self._forget()

    def _forget(self) -> None:
        self.states: list[tuple] = []  # live state, tokens it holds back, live state, ...
        self.number: dict[tuple, int] = {}
        self.steps: dict[int, tuple[int, tuple]] = {}  # state << 8 | byte -> state, tokens emitted
        self.ends: dict[int, tuple] = {}
        self._state((START, ()))

    def _state(self, live: tuple) -> int:
        n = self.number.setdefault(live, len(self.states))
        if n == len(self.states):
            self.states.append(live)
        return n

    def _tree(self, token: bytes) -> tuple:
        """The two parts that the last merge of a token joins; () where the merges don't make it.
        ``plain`` gets whether each merge of its tree comes after those of its parts."""
        got = self.parts.get(token)
        if got is None:
            ranks, rank = self.ranks, self.ranks[token]
            if len(token) == 1:
                got = (token,)
            else:
                # without its own rank the merges stop at the two parts
                parts = merge(ranks, token, rank)
                got = tuple(parts) if len(parts) == 2 and merge(ranks, token) == [token] else ()
            self.parts[token] = got
            self.plain[token] = len(got) == 1 or len(got) == 2 and all(
                len(x) == 1 or ranks[x] < rank and self._tree(x) and self.plain[x] for x in got)
        return got

    def _edge(self, token: bytes, side: int) -> list[tuple[bytes, int, int]]:
        """What stands at a token's left (0) or right (-1) edge while it is made: part, when it is
        made (a byte: -1), when it is merged into the next (the token itself: never)."""
        got = self.edges.get((token, side))
        if got is None:
            got, part, until = [], token, 1 << 62
            while True:
                rank = self.ranks[part] if len(part) > 1 else -1
                got.append((part, rank, until))
                if rank < 0:
                    break
                part, until = self._tree(part)[side], rank
            self.edges[token, side] = got
        return got

    def fits(self, last: int, token: int) -> bool:
        """Whether the merges leave a token as it is after the last one (-1: at the start).

        Merges act in the order of their ranks, the left one first. So two tokens come apart only
        if some part x at the first one's right edge meets a part y at the second one's left edge,
        their pair has a rank, and its turn comes before x or y is merged into its own token."""
        two = [self.bytes_of[i] for i in (last, token) if i >= 0]
        if not all(map(self._tree, two)):
            return False
        if len(two) == 1:
            return True
        if not (self.plain[two[0]] and self.plain[two[1]]):
            return merge(self.ranks, b"".join(two)) == two
        rank, rights = self.ranks.get, self._edge(two[1], 0)
        for x, made, until in self._edge(two[0], -1):
            for y, made_y, until_y in rights:
                turn = rank(x + y)
                if turn is not None and max(turn, made, made_y) < until and max(turn, made, made_y) <= until_y:
                    return False
        return True

    def _closing(self, one: int) -> int:
        """The token that a live state may close at its node, or -1."""
        last, node = one >> 32, one & 0xFFFFFFFF
        token = self.spelt.get(node, -1)
        if token >= 0 and not self.fits(last - 1, token):
            token = -1
        if len(self.closes) >= 2 * self.max_states:
            self.closes.clear()
        self.closes[one] = token
        return token

    def _step(self, state: int, byte: int) -> tuple[int, tuple]:
        live, down, closes = [], self.down, self.closes
        pairs = iter(self.states[state])
        for one, held in zip(pairs, pairs):
            node = one & 0xFFFFFFFF
            below = down.get(node << 8 | byte)
            if below is not None:
                live += one - node + below, held
            if node:
                token = closes.get(one)
                if token is None:
                    token = self._closing(one)
                if token >= 0:
                    live += (token + 1 << 32) + down[byte], (*held, token)  # the root's children are the single bytes
        held = live[1]
        if held:
            agreed = len(held)
            for other in live[3::2]:
                same = 0
                while same < agreed and same < len(other) and other[same] == held[same]:
                    same += 1
                agreed = same
                if not agreed:
                    break
            held = held[:agreed]
            if agreed:
                live[1::2] = [x[agreed:] for x in live[1::2]]
        if len(self.states) >= self.max_states or len(self.steps) >= 2 * self.max_states:
            self._forget()
            return self._state(tuple(live)), held
        step = self.steps[state << 8 | byte] = (self._state(tuple(live)), held)
        return step

    def _end(self, state: int) -> tuple:
        # the merges of the whole piece are one sequence: one live state can close
        pairs = iter(self.states[state])
        for one, held in zip(pairs, pairs):
            if one & 0xFFFFFFFF and (token := self._closing(one)) >= 0:
                return (*held, token)
        return ()

    def encode(self, piece: bytes) -> list[int]:
        """The piece's ids. A piece that is a token by itself gives that token even where the
        merges can't make it, as rank files are read."""
        out: list[int] = []
        state, steps = 0, self.steps
        for byte in piece:
            step = steps.get(state << 8 | byte)
            if step is None:
                step = self._step(state, byte)
                steps = self.steps
            state, emitted = step
            if emitted:
                out += emitted
        end = self.ends.get(state)
        if end is None:
            end = self.ends[state] = self._end(state)
        out += end
        return [self.ranks[piece]] if len(out) > 1 and piece in self.ranks else out


# Well-formed UTF-8 (fixed values): first byte, bytes that follow, bounds of the second byte
UTF8_LEADS = [(0xC2, 0xDF, 1, 0x80, 0xBF), (0xE0, 0xE0, 2, 0xA0, 0xBF), (0xE1, 0xEC, 2, 0x80, 0xBF),
              (0xED, 0xED, 2, 0x80, 0x9F), (0xEE, 0xEF, 2, 0x80, 0xBF), (0xF0, 0xF0, 3, 0x90, 0xBF),
              (0xF1, 0xF3, 3, 0x80, 0xBF), (0xF4, 0xF4, 3, 0x80, 0x8F)]
_LEAD = {b: (n, lo, hi) for first, last, n, lo, hi in UTF8_LEADS for b in range(first, last + 1)}
REPLACEMENT = "�"


class Utf8Machine:
    """Reads bytes in any portions; ``state`` holds the bytes of an unfinished character."""

    def __init__(self, bytes_of: dict[int, bytes] | None = None):
        self.bytes_of = bytes_of or {}
        self.given: dict[bytes, dict[int, tuple[str, bytes]]] = {b"": {}}
        self.whole: dict[int, str] = {}

    @staticmethod
    def read(state: bytes, data: bytes) -> tuple[str, bytes]:
        """The characters that are finished, and the state after."""
        out = []
        for byte in data:
            if state:
                more, lo, hi = _LEAD[state[0]]
                if len(state) > 1:
                    lo, hi = 0x80, 0xBF
                if lo <= byte <= hi:
                    state += bytes([byte])
                    if len(state) > more:
                        out.append(state.decode())
                        state = b""
                    continue
                out.append(REPLACEMENT)
                state = b""
            if byte < 0x80:
                out.append(chr(byte))
            elif byte in _LEAD:
                state = bytes([byte])
            else:
                out.append(REPLACEMENT)
        return "".join(out), state

    def text(self, ids: list[int]) -> str:
        """A whole text, one token after the other."""
        # tokens of whole characters leave the first state as it is
        chars = [*map(self.whole.get, ids)]
        if None not in chars:
            return "".join(chars)
        state, out, given = b"", [], self.given
        row = given[state]
        for i in ids:
            got = row.get(i)
            if got is None:
                got = row[i] = self.read(state, self.bytes_of[i])
                if not state and not got[1]:
                    self.whole[i] = got[0]
            chars, after = got
            out.append(chars)
            if after != state:
                state = after
                row = given.get(state)
                if row is None:
                    row = given[state] = {}
        return "".join(out) + (REPLACEMENT if state else "")


class Codec(dict):
    """Piece -> its ids as little-endian bytes, remembered up to a bound; texts both ways."""

    def __init__(self, path: str, pattern: str):
        import regex

        super().__init__()
        self.pattern = regex.compile(pattern)
        self.transducer = Transducer(read_ranks(path))
        self.machine = Utf8Machine(self.transducer.bytes_of)

    def __missing__(self, piece: str) -> bytes:
        ids = self.transducer.encode(piece.encode())
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= LONGEST_KEPT:
            if len(self) >= MAX_PIECES:
                self.clear()
            self[piece] = packed
        return packed

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        pieces = self.pattern.findall(text) if len(text) < LONG_TEXT else (m.group() for m in self.pattern.finditer(text))
        return b"".join(map(self.__getitem__, pieces))

    def decode(self, ids: bytes | None) -> str:
        if not ids:
            return ""
        return self.machine.text(np.frombuffer(ids, "<u4").tolist())


def codec(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = Codec(path, pattern)
    return _LOADED[path, pattern]


Batches = Iterator[pa.RecordBatch]


def _with(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    kept = [c for c in batch.schema.names if c != name]
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), values], [*kept, name])


def _each(source: str, target: str, kind: pa.DataType, work: Callable) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            yield _with(batch, target, pa.array([work(x) for x in batch.column(source).to_pylist()], kind))

    return run


def _schema(df: DataFrame, **new) -> StructType:
    return StructType([*(f for f in df.schema.fields if f.name not in new), *(StructField(c, t) for c, t in new.items())])


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """The rows with their texts' ids (unsigned 32-bit, little-endian, in one binary value)."""
    run = _each(text, ids, pa.binary(), lambda t: codec(path, pattern).encode(t))
    return docs.mapInArrow(run, _schema(docs, **{ids: BinaryType()}))


def decode(rows: DataFrame, path: str, pattern: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """The rows with the texts that their ids decode to."""
    run = _each(ids, text, pa.string(), lambda i: codec(path, pattern).decode(i))
    return rows.mapInArrow(run, _schema(rows, **{text: StringType()}))


def round_trip(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``encode`` and ``decode`` in one pass through Python; the texts themselves don't come back."""
    there = _each(text, "ids", pa.binary(), lambda t: codec(path, pattern).encode(t))
    back = _each("ids", "decoded", pa.string(), lambda i: codec(path, pattern).decode(i))

    def run(batches: Batches) -> Batches:
        for batch in back(there(batches)):
            yield batch.select([c for c in batch.schema.names if c != text])

    kept = docs.drop(text)
    return docs.mapInArrow(run, _schema(kept, ids=BinaryType(), decoded=StringType()))


def digests(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, tokens, SHA-256 of the ids and of the decoded bytes."""
    return round_trip(docs.select(key, text), path, pattern, text).select(
        key, F.expr("length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
