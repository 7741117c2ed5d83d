"""Document fingerprints: a quartile bucket digest.

Byte triplets of a text, from a window of eight bytes, are hashed into buckets and
counted. The digest holds for each bucket in which quartile of all buckets its count
lies, the length on a logarithmic scale, and how far apart the quartiles are. Two
digests are compared by how much further their quartile codes differ than those of
two unrelated digests of the same make-up would, so that 1 is no difference and 0 as
much as by chance, or more.

To compare every text with what an edit makes of it, the rows are dealt out in
ranges by id and each task streams through its range, holding one row and its
successor. Only the first and last row of a range wait for other tasks.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.frames import SLICE, col, slices
from gridloom.plans.joins import settle, store

BUCKET_BITS = 9
BUCKETS = 1 << BUCKET_BITS
TRIPLETS = ((0, 1, 2), (0, 2, 5), (0, 3, 7))  # places in the window
WINDOW = 8
PORTION = 1 << 20  # bytes counted at a time
LENGTH_STEPS = 8  # for each doubling
FAR_LENGTHS, FAR_QUARTILES = 64.0, 240.0  # header differences that count as a whole


def bucket_counts(data: bytes) -> np.ndarray:
    """How many triplets of the bytes fall into each bucket."""
    counts = np.zeros(BUCKETS, dtype=np.int64)
    whole = np.frombuffer(data, dtype=np.uint8)
    for at in range(0, max(len(whole), 1), PORTION):
        part = whole[at : at + PORTION + WINDOW - 1].astype(np.uint32)
        for kind, (_, j, k) in enumerate(TRIPLETS):
            n = min(PORTION, len(part) - k)
            if n <= 0:
                continue
            h = part[:n] | (part[j : j + n] << np.uint32(8)) | (part[k : k + n] << np.uint32(16))
            h = (h + np.uint32(kind * 0x01000193)) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
            h *= np.uint32(0x85EBCA77)
            counts += np.bincount(h >> np.uint32(32 - BUCKET_BITS), minlength=BUCKETS)
    return counts


def digest(data: bytes) -> bytes:
    """Length, two quartile ratios, and two bits for each bucket."""
    counts = bucket_counts(data)
    first, middle, last = np.partition(counts, [BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1])[
        [BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]
    ]
    codes = (counts > first).astype(np.uint8) + (counts > middle) + (counts > last)
    packed = codes[0::4] << 6 | codes[1::4] << 4 | codes[2::4] << 2 | codes[3::4]
    ratios = (15 * int(first) // int(last)) << 4 | 15 * int(middle) // int(last) if last else 0
    length = min(255, int(round(LENGTH_STEPS * np.log2(1 + len(data)))))
    return bytes([length, ratios]) + packed.astype(np.uint8).tobytes()


def _codes(digests: np.ndarray) -> np.ndarray:
    body = digests[:, 2:]
    return np.stack([body >> 6, body >> 4 & 3, body >> 2 & 3, body & 3], axis=2).reshape(len(body), -1)


def likeness_of(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """From 0 to 1 for each pair of digests; 1 for equal ones."""
    if not left:
        return np.zeros(0)
    a, b = (np.frombuffer(b"".join(side), dtype=np.uint8).reshape(len(side), -1) for side in (left, right))
    x, y = _codes(a), _codes(b)
    own = np.abs(x.astype(np.int8) - y.astype(np.int8)).sum(axis=1)
    shares = [np.stack([(c == k).mean(axis=1) for k in range(4)], axis=1) for c in (x, y)]
    apart = np.abs(np.subtract.outer(np.arange(4.0), np.arange(4.0)))
    chance = BUCKETS * np.einsum("ni,ij,nj->n", shares[0], apart, shares[1])
    body = np.divide(own, chance, out=np.zeros(len(own)), where=chance > 0)
    head = np.abs(a[:, :2].astype(int) - b[:, :2].astype(int))[:, 0] / FAR_LENGTHS
    for shift in (4, 0):
        head += np.abs((a[:, 1] >> shift & 15).astype(int) - (b[:, 1] >> shift & 15)) / FAR_QUARTILES
    return 1.0 - np.minimum(1.0, body + head)


def _written(digests: list[bytes | None]) -> pa.Array:
    return pa.array([None if d is None else base64.urlsafe_b64encode(d).decode() for d in digests], pa.string())


def _read(printed: pa.Array) -> list[bytes]:
    return [base64.urlsafe_b64decode(p) for p in printed.to_pylist()]


def add_fingerprint(df: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """Add ``out``: the digest of each whole text, in URL-safe base64.

    Equal texts have equal digests; a null text has that of an empty one. Repeated
    rows stay, an empty table stays empty, a column already called ``out`` is
    replaced. One pass, no shuffle.
    """

    def printed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in slices(batches):
            yield _written([digest((t.as_py() or "").encode()) for t in texts])

    return df.withColumn(out, F.arrow_udf(printed, T.StringType())(col(text)))


def likeness(left: Column, right: Column) -> Column:
    """Likeness of two fingerprints, from 0 to 1; null if one is null."""

    def compared(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array(likeness_of(_read(a), _read(b)), pa.float64())

    known = left.isNotNull() & right.isNotNull()
    empty = F.lit(base64.urlsafe_b64encode(digest(b"")).decode())
    found = F.arrow_udf(compared, T.DoubleType())(F.coalesce(left, empty), F.coalesce(right, empty))
    return F.when(known, found)


def edited(text: str, following: str) -> str:
    """The last half of the code points, rounded down, replaced by as many first
    ones of the following text, or by all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _result(key: pa.DataType) -> pa.Schema:
    return pa.schema(
        [
            ("key", key),
            ("n_chars", pa.int64()),
            ("edited_sha256", pa.string()),
            ("fingerprint", pa.binary()),
            ("edited_fingerprint", pa.binary()),
            ("near_edited", pa.float64()),
            ("near_next", pa.float64()),
        ]
    )


def _record(key: object, text: str, print_: bytes, following: str, next_print: bytes) -> tuple:
    changed = edited(text, following).encode()
    own = digest(changed)
    near = likeness_of([print_, print_], [own, next_print]).tolist()
    return key, len(text), hashlib.sha256(changed).hexdigest(), print_, own, *near


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of a sorted range but for its last row, which comes with its text, as
    the range's first row does once more, for the ranges beside it."""
    part, rows, before, schema = TaskContext.get().partitionId(), [], None, None
    for batch in batches:
        schema = schema or pa.schema(
            [*_result(batch.schema.field(0).type), ("part", pa.int32()), ("edge", pa.string()), ("text", pa.string())]
        )
        for key, text in zip(batch.column(0), batch.column(1)):
            key, text = key.as_py(), text.as_py() or ""
            now = key, text, digest(text.encode())
            if before is None:
                rows.append((key, len(text), None, now[2], None, None, None, part, "first", text))
            else:
                rows.append((*_record(*before, text, now[2]), part, None, None))
            before = now
            if len(rows) >= SLICE:
                yield _batch(rows, schema)
                rows = []
    if before is not None:
        key, text, own = before
        rows.append((key, len(text), None, own, None, None, None, part, "last", text))
        yield _batch(rows, schema)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The results of last rows, each with the text and digest after it."""
    for batch in batches:
        schema = _result(batch.schema.field(0).type)
        for at in range(0, len(batch), 16):
            rows = batch.slice(at, 16).to_pylist()
            yield _batch([_record(r["key"], r["text"], r["fingerprint"], r["next_text"], r["next_print"]) for r in rows], schema)


def compare_with_edits(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: its fingerprint, that of its edited text, and how
    like its own they and the next document's are.

    The next document is the one after it by ascending ``key``, nulls first, and the
    first after the last; rows of one key stand by a hash of their text, then by the
    text. The edit is that of :func:`edited`. A null text counts as empty, repeated
    rows stay, a single row is its own successor, an empty table gives an empty
    result, other columns are dropped. Columns: ``key``, ``n_chars``,
    ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``,
    ``near_next``. Texts are shuffled once; a task holds a batch of them.
    """
    kind = df.schema[key].dataType
    rows = df.select(col(key).alias("key"), F.coalesce(col(text), F.lit("")).alias("text"))
    mixed = F.xxhash64("text")
    ranged = rows.repartitionByRange(F.col("key").asc_nulls_first(), mixed.asc())
    ordered = ranged.sortWithinPartitions(F.col("key").asc_nulls_first(), mixed.asc(), F.col("text").asc())
    named = f"key {kind.simpleString()}, n_chars bigint, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
    found = store(ordered.mapInArrow(_streamed, f"{named}, part int, edge string, text string"))

    # the last row of a range meets the first of the next range that has rows
    places = settle(
        found.where("edge = 'first'")
        .select("part")
        .withColumn("place", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("part")))
    )
    ranges = places.count()
    last = found.where("edge = 'last'").join(places, "part").select("key", "text", "fingerprint", "place")
    first = (
        found.where("edge = 'first'")
        .join(places, "part")
        .select(
            F.col("text").alias("next_text"),
            F.col("fingerprint").alias("next_print"),
            F.when(F.col("place") == 1, F.lit(ranges)).otherwise(F.col("place") - 1).alias("place"),
        )
    )
    rest = last.join(first, "place").drop("place").mapInArrow(_joined, named)
    both = found.where(F.col("edge").isNull()).drop("part", "edge", "text").unionByName(rest)

    def printed(name: str) -> Column:
        return F.translate(F.base64(name), "+/", "-_").alias(name)

    return both.select(
        F.col("key").alias(key), "n_chars", "edited_sha256", printed("fingerprint"), printed("edited_fingerprint"), "near_edited", "near_next"
    )
