"""Byte-level BPE by a lazily determinised finite-state transducer.

A sequence of tokens is the BPE encoding of its bytes exactly if every two
neighbours are, since merges inside a pair are not changed by what lies outside
it. So the merges compile into a transducer that reads bytes and whose states are
sets of hypotheses: a token begun at some earlier byte, the token before it, and
the output not shared by all hypotheses yet. Transitions are made when first met;
a token is emitted as soon as all hypotheses agree on it, which is at most the
longest token later. Decoding joins token bytes and cuts them into characters by
an incremental UTF-8 state machine.
"""

from __future__ import annotations

import base64
import gc
from array import array
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.frames import col, give_back, slices

STATES = 200_000  # transitions are forgotten beyond this many states
PIECES = 125_000  # and encoded pieces beyond twice this many
NO_RANK = 1 << 60


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to id, from lines of base64 and rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge_bytes(data: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """Encoding by its definition: merge the leftmost pair of lowest rank, again
    and again."""
    parts = [data[i : i + 1] for i in range(len(data))]
    rank_of = ranks.get
    pairs = [rank_of(a + b, NO_RANK) for a, b in zip(parts, parts[1:])]
    while pairs:
        best = min(pairs)
        if best == NO_RANK:
            break
        i = pairs.index(best)
        joined = parts[i] = parts[i] + parts.pop(i + 1)
        del pairs[i]
        if i:
            pairs[i - 1] = rank_of(parts[i - 1] + joined, NO_RANK)
        if i < len(pairs):
            pairs[i] = rank_of(joined + parts[i + 1], NO_RANK)
    return tuple(ranks[p] for p in parts)


class Transducer:
    """Bytes of one piece in, packed token ids out."""

    def __init__(self, ranks: dict[bytes, int], states: int = STATES) -> None:
        self.ranks, self.limit = ranks, states
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.packed = {i: i.to_bytes(4, "little") for i in self.bytes_of}
        self.child: dict[int, int] = {}
        self.token: list[int] = [-1]
        inner = {0}
        for data, rank in ranks.items():
            node = 0
            for byte in data:
                inner.add(node)
                key = node << 8 | byte
                nxt = self.child.get(key)
                if nxt is None:
                    nxt = self.child[key] = len(self.token)
                    self.token.append(-1)
                node = nxt
            self.token[node] = rank
        self.inner = [i in inner for i in range(len(self.token))]
        self._whole: dict[int, bool] = {}
        self._pair: dict[int, bool] = {}
        self._forget()

    def _forget(self) -> None:
        # a state is a flat tuple of three fields for each hypothesis: packed output
        # still to agree on, last token (-1: none), trie node
        start = (b"", -1, 0)
        self._flat = [start]
        self.number = {start: 0}
        # the first transition met from a state is in two arrays: its byte, and the
        # next state, or -1 - i if tokens come out too: the state and the packed
        # tokens of telling[i]; further ones by state times 256 plus byte
        self.first_byte, self.first_next = array("h", [-1]), array("i", [0])
        self.steps: dict[int, int] = {}
        self.telling: list[tuple[int, bytes]] = []
        if len(self._pair) > self.limit:
            self._pair.clear()

    @property
    def states(self) -> list[tuple[tuple[bytes, int, int], ...]]:
        """The hypotheses of every state."""
        return [tuple(zip(flat[::3], flat[1::3], flat[2::3])) for flat in self._flat]

    def _merged(self, token: int) -> bool:
        """Whether the merges make ``token`` out of its bytes."""
        whole = self._whole.get(token)
        if whole is None:
            whole = self._whole[token] = merge_bytes(self.bytes_of[token], self.ranks) == (token,)
        return whole

    def _follows(self, left: int, right: int) -> bool:
        """Whether ``right`` is one merged token and may stand after ``left``."""
        if left < 0 or not self._merged(right):
            return self._merged(right)
        key = left << 32 | right
        good = self._pair.get(key)
        if good is None:
            data = self.bytes_of[left] + self.bytes_of[right]
            joined = self.ranks.get(data)
            # a pair that makes up one merged token is never left apart
            good = (joined is None or not self._merged(joined)) and merge_bytes(data, self.ranks) == (left, right)
            self._pair[key] = good
        return good

    def _step(self, state: int, byte: int) -> int:
        child, token, inner, pair = self.child.get, self.token, self.inner, self._pair.get
        ahead, ended = [], None
        fields = iter(self._flat[state])
        for out, last, node in zip(fields, fields, fields):
            nxt = child(node << 8 | byte)
            if nxt is None:
                continue
            if inner[nxt]:
                ahead += (out, last, nxt)
            if ended is None:
                rank = token[nxt]
                if rank >= 0:
                    fits = pair(last << 32 | rank)
                    if self._follows(last, rank) if fits is None else fits:
                        ended = (out + self.packed[rank] if out else self.packed[rank], rank, 0)
        if ended is None:
            raise ValueError(f"no token for byte {byte}")
        ahead += ended
        agreed = ended[0]
        for out in ahead[::3]:
            while not out.startswith(agreed):
                agreed = agreed[:-4]
            if not agreed:
                break
        if agreed:
            cut = len(agreed)
            ahead[::3] = [out[cut:] for out in ahead[::3]]
        key = tuple(ahead)
        number = self.number.get(key)
        if number is None:
            number = self.number[key] = len(self._flat)
            self._flat.append(key)
            self.first_byte.append(-1)
            self.first_next.append(0)
        if agreed:
            self.telling.append((number, self.packed[int.from_bytes(agreed, "little")] if cut == 4 else agreed))
            number = -len(self.telling)
        if self.first_byte[state] < 0:
            self.first_byte[state], self.first_next[state] = byte, number
        else:
            self.steps[state << 8 | byte] = number
        return number

    def encode(self, data: bytes) -> bytes:
        """Packed ids of one piece; a piece that is a token itself is that token."""
        rank = self.ranks.get(data)
        if rank is not None:
            return self.packed[rank]
        if len(self._flat) > self.limit:
            self._forget()
        out = b""
        state, step, telling = 0, self.steps.get, self.telling
        first_byte, first_next = self.first_byte, self.first_next
        for byte in data:
            if first_byte[state] == byte:
                nxt = first_next[state]
            else:
                nxt = step(state << 8 | byte)
                if nxt is None:
                    nxt = self._step(state, byte)
            if nxt < 0:
                nxt, told = telling[-1 - nxt]
                out += told
            state = nxt
        return out + self._flat[state][-3]


class _Pieces(dict):
    """Piece to its packed ids, made when first met.

    Full, it is set aside and a new one begun; what is met again moves over, so
    that rare pieces go and common ones stay.
    """

    def __init__(self, machine: Transducer, most: int) -> None:
        super().__init__()
        self.machine, self.most = machine, most
        self.aside: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.aside.pop(piece, None)
        if ids is None:
            ids = self.machine.encode(piece.encode())
        if len(self) >= self.most:
            self.aside = dict(self)
            self.clear()
        if len(piece) <= 64:
            self[piece] = ids
        return ids


class Encoder:
    """Whole texts to ids: every match of ``pattern`` is encoded by itself."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.pieces = _Pieces(Transducer(ranks), PIECES)
        self.find = regex.compile(pattern).findall

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian 32-bit numbers; none for a null or empty text."""
        if not text:
            return b""
        return b"".join(map(self.pieces.__getitem__, self.find(text)))


def _utf8_table() -> np.ndarray:
    """Next state by state and byte; 0 between characters, -1 for a wrong byte.

    States 1 to 3 wait for as many more bytes of any kind; the others wait for a
    second byte of a narrower range: no overlong forms, surrogates or values
    beyond the last code point.
    """
    table = np.full((8, 256), -1, dtype=np.int8)
    table[0, :0x80] = 0
    table[0, 0xC2:0xE0] = 1
    table[0, 0xE0:0xF0] = 2
    table[0, 0xF0:0xF5] = 3
    table[0, 0xE0], table[0, 0xED], table[0, 0xF0], table[0, 0xF4] = 4, 5, 6, 7
    for state, (low, high, after) in {
        1: (0x80, 0xC0, 0),
        2: (0x80, 0xC0, 1),
        3: (0x80, 0xC0, 2),
        4: (0xA0, 0xC0, 1),
        5: (0x80, 0xA0, 1),
        6: (0x90, 0xC0, 2),
        7: (0x80, 0x90, 2),
    }.items():
        table[state, low:high] = after
    return table


UTF8 = _utf8_table()


class StreamDecoder:
    """Ids in any portions in, complete characters out.

    A character cut by the end of a portion is held back until its last byte
    comes. Bytes that are no UTF-8 become U+FFFD, one for each longest part that
    could have begun a character, at the latest by ``finish``.
    """

    def __init__(self, table: Decoder) -> None:
        self.tokens, self.closed, self.table = table.tokens, table.closed, table
        self.state, self.held = 0, b""

    def feed(self, ids: np.ndarray) -> str:
        data = self.table.joined(ids)
        if not self.held and bool(self.closed[ids].all()):
            return data.decode("utf-8")
        return self._feed_open(data, ids)

    def _feed_open(self, data: bytes, ids: np.ndarray) -> str:
        """Walk the machine through the open tokens only."""
        if self.held:
            return self._feed_bytes(data)
        open_at = np.flatnonzero(~self.closed[ids]).tolist()
        tokens, whole, state = self.tokens, ids.tolist(), 0
        k, held = 0, 0
        while k < len(open_at):
            i = open_at[k]
            state, held = 0, 0
            while i < len(whole):
                for byte in tokens[whole[i]]:
                    state = int(UTF8[state, byte])
                    held = held + 1 if state else 0
                    if state < 0:
                        return self._feed_bytes(data)
                i += 1
                if not state:
                    break
            while k < len(open_at) and open_at[k] < i:
                k += 1
        self.state, self.held = state, data[len(data) - held :] if state else b""
        return data[: len(data) - held].decode("utf-8") if state else data.decode("utf-8")

    def _feed_bytes(self, data: bytes) -> str:
        """The same byte by byte, with replacement of what is no UTF-8."""
        out, state, begun = [], self.state, bytearray(self.held)
        for byte in data:
            nxt = int(UTF8[state, byte])
            if nxt < 0 and state:
                out.append("�")
                begun.clear()
                nxt = int(UTF8[0, byte])
            if nxt < 0:
                out.append("�")
                state = 0
                continue
            begun.append(byte)
            state = nxt
            if not state:
                out.append(begun.decode("utf-8"))
                begun.clear()
        self.state, self.held = state, bytes(begun)
        return "".join(out)

    def finish(self) -> str:
        rest = "�" if self.held else ""
        self.state, self.held = 0, b""
        return rest


class Decoder:
    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for data, rank in ranks.items():
            self.tokens[rank] = data
        # tokens that begin and end between characters
        self.closed = np.array([self._closed(t) for t in self.tokens], dtype=bool)
        self.sizes = np.array([len(t) for t in self.tokens], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(self.tokens), dtype=np.uint8)

    def joined(self, ids: np.ndarray) -> bytes:
        """The bytes of the tokens, one after another."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[ids] - ends + sizes, sizes)
        return self.flat[at + np.arange(len(at))].tobytes()

    @staticmethod
    def _closed(token: bytes) -> bool:
        state = 0
        for byte in token:
            state = int(UTF8[state, byte])
            if state < 0:
                return False
        return state == 0

    def stream(self) -> StreamDecoder:
        return StreamDecoder(self)

    def decode(self, ids: bytes | None, portion: int = 65_536) -> str:
        """Text of packed ids, fed in portions; ids must be in the vocabulary."""
        if not ids:
            return ""
        stream, all_ids = self.stream(), np.frombuffer(ids, dtype="<u4")
        parts = [stream.feed(all_ids[i : i + portion]) for i in range(0, len(all_ids), portion)]
        return "".join(parts) + stream.finish()


@contextmanager
def _no_collection() -> Iterator[None]:
    """The caches hold no cycles; looking for some takes longer than the work."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


Arrays = Callable[[Iterator[pa.Array]], Iterator[pa.Array]]


def _letting_go(task: Arrays) -> Arrays:
    """The same work of a task. Its tables and caches end before memory is given back,
    or an idle worker would keep them beside those of the next tasks."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from task(batches)
        gc.collect()
        give_back()

    return run


def encode_text(df: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Add ``out``: the token ids of each text, packed as little-endian unsigned
    32-bit numbers in a binary column.

    ``path`` is the rank file, readable on every machine; ``pattern`` cuts a text
    into pieces that are encoded separately. A null or empty text has no ids.
    Repeated rows stay, an empty table stays empty, a column already called
    ``out`` is replaced. One pass, no shuffle; memory is bounded by the caches
    and one batch of texts.
    """

    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = Encoder(read_ranks(path), pattern).encode
        for texts in slices(batches):
            with _no_collection():
                yield pa.array([encode(t.as_py()) for t in texts], pa.binary())

    return df.withColumn(out, F.arrow_udf(_letting_go(encoded), T.BinaryType())(col(text)))


def decode_ids(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out``: the text of packed ids; null or empty ids give an empty text."""

    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decode = Decoder(read_ranks(path)).decode
        for packed in slices(batches):
            yield pa.array([decode(p.as_py()) for p in packed], pa.string())

    return df.withColumn(out, F.arrow_udf(_letting_go(decoded), T.StringType())(col(ids)))


def round_trip(
    df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", out: str = "decoded"
) -> DataFrame:
    """Add ``ids`` and ``out`` as :func:`encode_text` and :func:`decode_ids` would,
    in one pass: chained, the texts would be encoded once for each.

    A null or empty text has no ids and decodes to an empty text. Repeated rows
    stay, an empty table stays empty, columns already called ``ids`` or ``out`` are
    replaced. Results leave a task in slices, so a task holds one batch of texts,
    one slice of results and the caches, which end with it.
    """

    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ranks = read_ranks(path)
        encode, decode = Encoder(ranks, pattern).encode, Decoder(ranks).decode
        for texts in slices(batches):
            with _no_collection():
                packed = [encode(t.as_py()) for t in texts]
            yield pa.StructArray.from_arrays(
                [pa.array(packed, pa.binary()), pa.array([decode(p) for p in packed], pa.string())], names=["ids", "decoded"]
            )

    kind = T.StructType([T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())])
    found = F.arrow_udf(_letting_go(both), kind)(col(text))
    return df.withColumns({ids: found["ids"], out: found["decoded"]})


def token_count(ids: str = "ids") -> Column:
    return F.floor(F.octet_length(col(ids)) / 4).cast("long")


def unpack_ids(packed: bytes | None) -> list[int]:
    """Packed ids as a list, for readers outside Spark."""
    return np.frombuffer(packed or b"", dtype="<u4").tolist()
