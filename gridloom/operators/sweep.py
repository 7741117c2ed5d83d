"""Overlapping spans to disjoint ones, row by row of the grid.

Spans come sorted by row and first cell. The ends of all spans of a batch cut its rows
into pieces; spans are painted on these in the order of their features, so a piece keeps
the highest. Only winning spans leave, and cells are made from them once, not once for
each feature that covers them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.plans.joins import shuffle_partitions

PART_COLUMNS = 4096  # a row is dealt out in parts of so many cells
PIECES = 4_000_000  # painted at once, overlaps counted; more spans are painted in halves


def _painted(row: np.ndarray, c0: np.ndarray, c1: np.ndarray, fid: np.ndarray, pieces: int) -> tuple:
    """Disjoint spans, in order, as the span each is part of, its first and last cell."""
    left = c0.min()
    width = c1.max() - left + 2  # rows do not touch
    start, stop = row * width + (c0 - left), row * width + (c1 - left + 1)
    cuts = np.unique(np.concatenate([start, stop]))
    first = np.searchsorted(cuts, start)
    count = np.searchsorted(cuts, stop) - first
    if count.sum() > pieces and len(row) > 2:
        # what two halves keep is disjoint in each, so that together it overlaps little
        halves = []
        for at in np.array_split(np.arange(len(row)), 2):
            span, a, b = _painted(row[at], c0[at], c1[at], fid[at], pieces)
            halves.append((at[span], a, b))
        span, a, b = (np.concatenate(x) for x in zip(*halves))
        top, a, b = _painted(row[span], a, b, fid[span], max(pieces, 4 * len(span)))
        return span[top], a, b
    order = np.argsort(fid, kind="stable")
    first, count = first[order], count[order]
    before = np.cumsum(count) - count
    top = np.full(len(cuts), -1)
    # of several values for a piece the last one stays, that of the highest feature
    top[np.repeat(first - before, count) + np.arange(count.sum())] = np.repeat(order, count)
    known = np.append(top[:-1] >= 0, False)
    same = known[1:] & known[:-1] & (fid[top[1:]] == fid[top[:-1]])
    begins = np.flatnonzero(known & ~np.insert(same, 0, False))
    ends = np.flatnonzero(known & ~np.append(same, False))
    span = top[begins]
    shift = left - row[span] * width
    return span, cuts[begins] + shift, cuts[ends + 1] + shift - 1


def _rows_of(spans: pa.Table, keys: int) -> np.ndarray:
    """Number of each span's row; spans of a row follow one another."""
    new = np.zeros(spans.num_rows, bool)
    for c in spans.columns[:keys]:
        codes = pc.dictionary_encode(c.combine_chunks(), null_encoding="encode").indices.to_numpy()
        new[1:] |= codes[1:] != codes[:-1]
    return np.cumsum(new)


def _sweep(keys: int, pieces: int = PIECES) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows are ``keys`` key columns, ``c0``, ``c1``, ``fid`` and values, sorted by the
    keys and ``c0``. What is held is a batch and the winners that may still be covered."""

    def swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            spans = pa.Table.from_batches([batch])
            if held is not None:
                spans = pa.concat_tables([held, spans])
            if not spans.num_rows:
                continue
            row = _rows_of(spans, keys)
            c0, c1, fid = (spans.column(keys + i).to_numpy() for i in range(3))
            span, a, b = _painted(row, c0, c1, fid, pieces)
            # spans to come begin at or after the last one, in its row or a later one; a
            # winner that ends right before may still grow
            done = int(np.count_nonzero((row[span] < row[-1]) | (b < c0[-1] - 1)))
            won = spans.take(pa.array(span))
            for i, c in ((keys, a), (keys + 1, b)):
                won = won.set_column(i, won.field(i), pa.array(c, won.field(i).type))
            yield from won.slice(0, done).to_batches()
            held = won.slice(done).combine_chunks()
        if held is not None:
            yield from held.to_batches()

    return swept


def winning_spans(spans: DataFrame, key: list[str], deal: list[str] | None = None) -> DataFrame:
    """Disjoint spans of the same cells, each with the values of the highest ``fid``
    that covers it.

    ``spans`` has ``key`` columns, the last of which tells rows apart, ``c0``, ``c1``,
    ``fid`` and values. Every task first sweeps what it has, so a spot that very many
    features cover sends at most as many spans from a task as it has cells; then the
    spans are dealt out by ``deal``, by default the whole key, and swept again.
    """
    values = [c for c in spans.columns if c not in (*key, "c0", "c1", "fid")]
    ordered = spans.select(*key, "c0", "c1", "fid", *values)
    schema = ordered.schema

    def swept(df: DataFrame) -> DataFrame:
        return df.sortWithinPartitions(*key, "c0").mapInArrow(_sweep(len(key)), schema)

    return swept(swept(ordered).repartition(shuffle_partitions(spans), *(deal or key)))


def cut_rows(spans: DataFrame, columns: int = PART_COLUMNS) -> DataFrame:
    """Spans cut where ``part``, counted in ``columns`` cells, changes."""
    n = F.lit(int(columns)).cast("long")
    parts = F.sequence(F.floor(F.col("c0") / n), F.floor(F.col("c1") / n))
    cut = spans.withColumn("part", F.explode(parts))
    return cut.withColumn("c0", F.greatest("c0", F.col("part") * n)).withColumn(
        "c1", F.least("c1", F.col("part") * n + n - 1)
    )
