"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(name: str) -> Column:
    """A top-level column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def scratch(df: DataFrame, *names: str) -> list[str]:
    """The given names, changed where the table already has such a column."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


SLICE = 256  # texts whose results leave together


def give_back() -> None:
    """Return the memory that Arrow and the C library keep for later: idle Python
    workers stay, beside those of the next stage."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not in every C library
    if trim is not None:
        trim(0)


def slices(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """A batch in parts of few rows, so that results leave before the next part; at
    the end of the task memory is given back."""
    for batch in batches:
        for at in range(0, max(len(batch), 1), SLICE):
            yield batch.slice(at, SLICE)
        del batch
    give_back()


Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def released(fn: Batches) -> Batches:
    """The same function of batches, giving memory back at the end of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches)
        give_back()

    return run
