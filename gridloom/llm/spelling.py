"""Spelling variants of words, by blocked Gram matrices.

A block holds the words of one length and of the next longer one that share all of
the shorter one's code points but those of one segment. An edit touches one segment,
so two words one edit apart meet in a block. In each, the NumPy product of the words'
letter counts with themselves (the Gram matrix) gives all squared distances; an edit
changes one count by one, or two, so pairs at most two apart are kept, and their edit
is verified code point by code point. Blocks are rows of one shuffle: many small ones
are multiplied at once, and one with too many words is cut into pairs of parts.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.frames import col
from gridloom.plans.joins import join_dimension, settle, store

LETTERS = "a-zÀ-ÿ"
LEAST_CHARS, LEAST_COUNT = 5, 3
SEGMENTS = 3
PART = 4096  # words of a block multiplied at once; larger blocks are cut
STACKED = 64  # blocks up to this size are multiplied together
FLUSH = 200_000  # different words a task counts before it passes them on
PORTION = 1 << 20  # code points of a text searched at a time
VERIFIED = 1 << 22  # code points compared at once

COUNTS = pa.schema([("word", pa.string()), ("n", pa.int64())])
FOUND = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def _portions(text: str, gap: re.Pattern) -> Iterator[str]:
    """The text in parts, cut between words."""
    at = 0
    while at < len(text):
        end = at + PORTION
        if end < len(text):
            cut = gap.search(text, end)
            end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


def count_runs(least: int, damage: int | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Words of key and text, with partial counts."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # shorter runs are no words: a damaged run only gets shorter
        find, gap = re.compile(f"[{LETTERS}]{{{least},}}").findall, re.compile(f"[^{LETTERS}]")
        counts: dict[str, int] = {}
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py()
                if not text:
                    continue
                key = key.as_py()
                seed = zlib.crc32(f"{'' if key is None else key}:".encode())
                # in bytes only A to Z have a lower case
                for part in _portions(text.encode().lower().decode(), gap):
                    for run, n in Counter(find(part)).items():
                        if damage:
                            h = zlib.crc32(run.encode(), seed)
                            if h % damage == 0:
                                at = h % len(run)
                                run = run[:at] + run[at + 1 :]
                                if len(run) < least:
                                    continue
                        counts[run] = counts.get(run, 0) + n
                if len(counts) >= FLUSH:
                    yield pa.record_batch([pa.array(list(counts)), pa.array(list(counts.values()), pa.int64())], schema=COUNTS)
                    counts = {}
        if counts:
            yield pa.record_batch([pa.array(list(counts)), pa.array(list(counts.values()), pa.int64())], schema=COUNTS)

    return counted


def count_words(df: DataFrame, key: str, text: str, least_chars: int, least_count: int, damage: int | None) -> DataFrame:
    """(``word``, ``n``) of all words that occur often enough."""
    rows = df.select(col(key).cast("string").alias("key"), col(text).alias("text"))
    counts = rows.mapInArrow(count_runs(least_chars, damage), "word string, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _cut(base: Column, segment: Column) -> Column:
    return F.floor(base * segment / F.lit(SEGMENTS)).cast("int")


def blocked(words: DataFrame, least_chars: int, part: int = PART) -> DataFrame:
    """Each word once for every block it belongs to: ``key`` names the block, ``base``
    its shorter length, ``segment`` the one that may differ, ``side`` 0 where the
    block is whole, else 1 or 2."""
    n = F.length("word")
    rows = (
        words.withColumn("base", F.explode(F.array(n, n - 1)))
        .where(F.col("base") >= least_chars)
        .withColumn("segment", F.explode(F.array(*[F.lit(i) for i in range(SEGMENTS)])))
    )
    base, segment = F.col("base"), F.col("segment")
    before, after = _cut(base, segment), base - _cut(base, segment + 1)
    # hashes of different blocks that meet only make one block of two
    key = F.xxhash64("base", "segment", F.expr("word").substr(F.lit(1), before), F.col("word").substr(n - after + 1, after))
    rows = rows.withColumn("key", key).withColumn("side", F.lit(0))
    large = settle(rows.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > part))
    if large.isEmpty():
        return rows
    marked = join_dimension(rows, large, ["key"], how="left", settled=True, spread="word")
    parts = F.ceil(F.col("rows") / F.lit(part))
    own = marked.where(F.col("rows").isNotNull()).withColumn("own", F.pmod(F.xxhash64("word"), parts))
    other = own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    pairs = other.withColumn("side", F.when(F.col("own") == F.col("other"), 0).when(F.col("own") == low, 1).otherwise(2))
    pairs = pairs.withColumn("key", F.xxhash64("key", low, high))
    return marked.where(F.col("rows").isNull()).drop("rows").unionByName(pairs.drop("rows", "own", "other"))


def letter_counts(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How often each word has each code point, the words' code points one after
    another, and their lengths."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    lengths = np.array([len(w) for w in words])
    used, column = np.unique(codes, return_inverse=True)
    row = np.repeat(np.arange(len(words)), lengths)
    counts = np.bincount(row * len(used) + column, minlength=len(words) * len(used))
    # squared lengths must be exact
    kind = np.float32 if int(lengths.max(initial=0)) ** 2 < 1 << 22 else np.float64
    return counts.reshape(len(words), -1).astype(kind), codes, lengths


def _close(counts: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs at a squared distance of at most two, of blocks stacked row by row; -1
    is no word."""
    squares = np.append(np.einsum("ij,ij->i", counts, counts), counts.dtype.type(np.inf))
    x, y = (np.where(side[..., None] >= 0, counts[side], 0) for side in (left, right))
    apart = squares[left][:, :, None] + squares[right][:, None, :] - 2 * (x @ y.transpose(0, 2, 1))
    block, i, j = np.nonzero(apart <= 2)
    return left[block, i], right[block, j]


def close_pairs(counts: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows i < j of the same block at a squared distance of at most two."""
    sizes = ends - starts
    left, right = [], []
    width = 2
    while width <= STACKED:
        some = np.flatnonzero((sizes > width // 2) & (sizes <= width) & (sizes > 1))
        per = max(1, (1 << 20) // (width * (width + counts.shape[1])))
        for at in range(0, len(some), per):
            chosen = some[at : at + per]
            rows = starts[chosen][:, None] + np.arange(width)
            rows = np.where(rows < ends[chosen][:, None], rows, -1)
            i, j = _close(counts, rows, rows)
            left.append(i[i < j])
            right.append(j[i < j])
        width *= 2
    for b in np.flatnonzero(sizes > STACKED):
        for s in range(starts[b], ends[b], 1024):
            own = np.arange(s, min(s + 1024, ends[b]))[None, :]
            for t in range(s, ends[b], 1024):
                i, j = _close(counts, own, np.arange(t, min(t + 1024, ends[b]))[None, :])
                left.append(i[i < j])
                right.append(j[i < j])
    none = np.zeros(0, dtype=np.int64)
    return (np.concatenate(left) if left else none), (np.concatenate(right) if right else none)


def _one_edit(codes: np.ndarray, offsets: np.ndarray, lengths: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether ``b``, as long as ``a`` or one longer, is one edit from it, and how many
    last code points they share."""
    size = lengths[a]
    span = np.arange(int(size.max(initial=0)))
    within = span < size[:, None]
    last = len(codes) - 1
    ahead = within & (codes[np.minimum(offsets[a][:, None] + span, last)] == codes[np.minimum(offsets[b][:, None] + span, last)])
    back_a, back_b = (offsets[w] + lengths[w] - 1 for w in (a, b))
    behind = within & (codes[np.maximum(back_a[:, None] - span, 0)] == codes[np.maximum(back_b[:, None] - span, 0)])
    prefix, suffix = (np.where(same.all(axis=1), same.shape[1], same.argmin(axis=1)) for same in (ahead, behind))
    replaced = (lengths[b] == size) & (prefix + suffix == size - 1)
    inserted = (lengths[b] == size + 1) & (prefix + suffix >= size)
    return replaced | inserted, suffix


def near_pairs(words: list[str], key: np.ndarray, base: np.ndarray, segment: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of words one edit apart, each pair in one of the blocks where it meets;
    rows are sorted by ``key``."""
    edges = np.flatnonzero(np.diff(key)) + 1
    starts, ends = np.append(0, edges), np.append(edges, len(key))
    counts, codes, lengths = letter_counts(words)
    offsets = np.cumsum(lengths) - lengths
    a, b = close_pairs(counts, starts, ends)
    swap = lengths[a] > lengths[b]
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    # two longer words meet in the blocks of their own length; parts meet other parts
    fits = (lengths[a] == base[a]) & (lengths[b] <= lengths[a] + 1)
    fits &= (base[a] == base[b]) & (segment[a] == segment[b])
    fits &= (side[a] == 0) | (side[a] != side[b])
    a, b = a[fits], b[fits]
    order = np.argsort(lengths[a], kind="stable")
    a, b = a[order], b[order]
    kept_a, kept_b, at = [], [], 0
    while at < len(a):
        # pairs of about the same length, few enough to lay side by side
        widths = np.maximum(lengths[a[at : at + VERIFIED // 16]], 1) * np.arange(1, min(len(a) - at, VERIFIED // 16) + 1)
        many = max(1, int(np.searchsorted(widths, VERIFIED, side="right")))
        i, j = a[at : at + many], b[at : at + many]
        good, suffix = _one_edit(codes, offsets, lengths, i, j)
        # a pair that meets in two blocks counts in the one of the first segment
        first = (base[i] * segment[i]) // SEGMENTS
        good &= (segment[i] == 0) | (first < base[i] - np.minimum(suffix, base[i]))
        kept_a.append(i[good])
        kept_b.append(j[good])
        at += many
    none = np.zeros(0, dtype=np.int64)
    return (np.concatenate(kept_a) if kept_a else none), (np.concatenate(kept_b) if kept_b else none)


def _best_of(words: list[str], n: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """For each row its number of near words here, and the most frequent of them."""
    own, other = np.concatenate([a, b]), np.concatenate([b, a])
    ranked = sorted(set(other.tolist()), key=lambda r: (-n[r], words[r]))
    place = np.zeros(len(words), dtype=np.int64)
    place[ranked] = np.arange(len(ranked))
    order = np.lexsort((place[other], own))
    own, other = own[order], other[order]
    rows, first, many = np.unique(own, return_index=True, return_counts=True)
    best = other[first]
    return pa.record_batch(
        [
            pa.array([words[r] for r in rows.tolist()], pa.string()),
            pa.array(many, pa.int64()),
            pa.array(n[best], pa.int64()),
            pa.array([words[r] for r in best.tolist()], pa.string()),
        ],
        schema=FOUND,
    )


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words of whole blocks; a block cut by the end of a batch waits for its rest."""

    def found(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        key, base, segment, side, n = (rows[c].to_numpy() for c in ("key", "base", "segment", "side", "n"))
        words = rows["word"].to_pylist()
        a, b = near_pairs(words, key, base, segment, side)
        if len(a):
            yield _best_of(words, n, a, b)

    held: list[pa.Table] = []
    for batch in batches:
        if not len(batch):
            continue
        table = pa.Table.from_batches([batch])
        key = table["key"].to_numpy()
        cut = int(np.searchsorted(key, key[-1], side="left")) if key[0] <= key[-1] else 0
        if cut == 0 and held and held[-1]["key"][-1].as_py() == key[-1]:
            held.append(table)
            continue
        held.append(table.slice(0, cut))
        yield from found(pa.concat_tables(held))
        held = [table.slice(cut)]
    if held:
        yield from found(pa.concat_tables(held))


def near_words(words: DataFrame, least_chars: int = LEAST_CHARS, part: int = PART) -> DataFrame:
    """(``word``, ``n_near``, ``best_n``, ``best``) of every word that has near ones:
    how many, and the most frequent, of two the first in code-point order."""
    rows = blocked(words, least_chars, part).repartition("key").sortWithinPartitions("key")
    found = rows.mapInArrow(_compared, "word string, n_near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word")))
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return found.select("word", "n_near", (-F.col("best.less")).alias("best_n"), F.col("best.word").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """(``word``, ``root``) of words that have a form: the last form reached. Every
    round doubles the way that is behind a word."""
    ways = store(forms.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")))
    while True:
        onward = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = store(ways.join(onward, "root", "left"))
        ways = joined.select("word", F.coalesce("next", "root").alias("root"))
        if joined.where(F.col("next").isNotNull()).isEmpty():
            return ways


def spelling_variants(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least_chars: int = LEAST_CHARS,
    least_count: int = LEAST_COUNT,
    damage: int | None = None,
    part: int = PART,
) -> DataFrame:
    """One row for each word: ``word``, ``n``, ``n_near``, ``form``, ``form_n``, ``root``.

    Words are runs of A to Z, a to z and U+00C0 to U+00FF in the whole texts, with A
    to Z in lower case, of ``least_chars`` code points and ``least_count`` occurrences
    or more. Two are near if one inserted, deleted or replaced code point parts them.
    A word's form is its most frequent near word, of two the first in code-point
    order, if that occurs twice as often or more; its root is where forms lead.
    With ``damage``, a run loses the code point h % length if ``damage`` divides h,
    the CRC-32 of key, colon and run, so that variants are there to be found.

    Null and empty texts have no words, a null key counts as empty, repeated rows
    count each, an empty table gives an empty result, other columns are not read.
    Tasks count before they shuffle; blocks of more than ``part`` words are cut.
    """
    words = store(count_words(df, key, text, least_chars, least_count, damage))
    near = near_words(words, least_chars, part).withColumnRenamed("word", "own")
    joined = words.join(near, words["word"] == near["own"], "left")
    fits = F.col("best_n") >= 2 * F.col("n")
    forms = store(
        joined.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(fits, F.col("best")).alias("form"),
            F.when(fits, F.col("best_n")).alias("form_n"),
        )
    )
    roots = _roots(forms).withColumnRenamed("word", "own")
    return forms.join(roots, forms["word"] == roots["own"], "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )
