"""Words of many texts at once, as 64-bit hashes in numpy.

A word is a run of bytes outside space and the controls 9 to 13; letters A to Z
count as a to z. In UTF-8 these separators are single bytes, so the bytes of a text
give the same words as its characters. A word is known by a 64-bit hash of all its
bytes; two of a billion different words meet with a chance of about one in forty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 19  # bytes hashed at a time, cut between words


def _tables() -> tuple[np.ndarray, np.ndarray]:
    values = np.random.default_rng(20_240_607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    upper = np.arange(ord("A"), ord("Z") + 1)
    values[upper] = values[upper + 32]
    gap = np.zeros(256, dtype=bool)
    gap[[0x20, *range(0x09, 0x0E)]] = True
    return values, gap


BYTE_VALUE, GAP = _tables()
BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """A permutation of 64-bit numbers that spreads every bit, by a salt."""
    with np.errstate(over="ignore"):
        h = h + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


_POWERS = np.ones(1, dtype=np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        with np.errstate(over="ignore"):
            _POWERS = np.concatenate([[np.uint64(1)], np.cumprod(np.full(max(n, 1024) - 1, BASE, dtype=np.uint64))])
    return _POWERS


def word_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of the words of one text's bytes, in order."""
    if len(data) <= BLOCK:
        return _block_hashes(data)
    out, at = [], 0
    while at < len(data):
        end = min(at + BLOCK, len(data))
        if end < len(data):
            gaps = np.flatnonzero(GAP[data[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
            else:  # one word longer than a block
                more = np.flatnonzero(GAP[data[end:]])
                end = end + int(more[0]) if len(more) else len(data)
        out.append(_block_hashes(data[at:end]))
        at = end
    return np.concatenate(out)


def _edges(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~GAP[data]
    turn = np.diff(inside)
    return np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)


def _block_hashes(data: np.ndarray) -> np.ndarray:
    starts, ends = _edges(data)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    lengths = ends - starts
    offset = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data)))) if starts[0] == 0 else None
    if offset is None:
        offset = np.arange(len(data))
        offset[starts[0] :] -= np.repeat(starts, np.diff(np.append(starts, len(data))))
    inside = ~GAP[data]
    powers = _powers(int(lengths.max()) + 1)
    with np.errstate(over="ignore"):
        terms = np.where(inside, BYTE_VALUE[data] * powers[np.where(inside, offset, 0)], np.uint64(0))
        sums = np.add.reduceat(terms, starts)
        return mix(sums + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def texts_bytes(texts: pa.Array) -> Iterator[np.ndarray]:
    """UTF-8 bytes of each text without a copy; none for a null text."""
    if isinstance(texts, pa.ChunkedArray):
        for chunk in texts.chunks:
            yield from texts_bytes(chunk)
        return
    if pa.types.is_large_string(texts.type) or not pa.types.is_string(texts.type):
        texts = texts.cast(pa.string()) if len(texts) else pa.array([], pa.string())
    _, offsets, data = texts.buffers()
    if not len(texts):
        return
    offsets = np.frombuffer(offsets, dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    valid = texts.is_valid().to_numpy(zero_copy_only=False)
    for i in range(len(texts)):
        yield data[offsets[i] : offsets[i + 1]] if valid[i] else data[:0]


def batch_word_hashes(texts: pa.Array) -> Iterator[np.ndarray]:
    """Word hashes of each text; short texts are hashed many at a time."""
    pending: list[np.ndarray] = []
    size = 0
    for data in texts_bytes(texts):
        if pending and size + len(data) > BLOCK:
            yield from _together(pending)
            pending, size = [], 0
        pending.append(data)
        size += len(data) + 1
    if pending:
        yield from _together(pending)


def _together(parts: list[np.ndarray]) -> Iterator[np.ndarray]:
    if len(parts) == 1:
        yield word_hashes(parts[0])
        return
    gap = np.full(1, 0x20, dtype=np.uint8)
    data = np.concatenate([x for p in parts for x in (p, gap)])
    starts, _ = _edges(data)
    hashes = _block_hashes(data)
    bounds = np.cumsum([len(p) + 1 for p in parts])
    cuts = np.searchsorted(starts, bounds)
    yield from np.split(hashes, cuts[:-1])


def shingle_hashes(words: np.ndarray, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of ``width`` words in a row; with fewer words the
    whole sequence is one; without words there is none."""
    n = len(words)
    if not n:
        return words
    with np.errstate(over="ignore"):
        if n < width:
            h = np.uint64(n)
            for w in words:
                h = mix(np.array([h * BASE + w], dtype=np.uint64), 1)[0]
            return np.array([h], dtype=np.uint64)
        h = words[: n - width + 1].copy()
        for k in range(1, width):
            h = h * BASE + words[k : n - width + 1 + k]
        return np.unique(mix(h, 2))


def word_counts(texts: pa.Array) -> pa.Array:
    """Number of words of each text; none in a null text."""
    out, pending, size = [], [], 0

    def flush() -> None:
        gap = np.full(1, 0x20, dtype=np.uint8)
        data = np.concatenate([x for p in pending for x in (p, gap)])
        inside = ~GAP[data]
        begins = np.concatenate([[0], np.cumsum(inside & ~np.concatenate([[False], inside[:-1]]))])
        bounds = np.cumsum([len(p) + 1 for p in pending])
        out.append(np.diff(begins[np.concatenate([[0], bounds])]))

    for data in texts_bytes(texts):
        if pending and size + len(data) > BLOCK:
            flush()
            pending, size = [], 0
        pending.append(data)
        size += len(data) + 1
    if pending:
        flush()
    return pa.array(np.concatenate(out) if out else np.zeros(0, np.int64), pa.int64())
