"""Read the open chunked-array folder layout back, as a chunk table.

The consolidated JSON says which arrays there are; their objects are read by Spark's
own reader of binary files, so a store may lie wherever Spark reads. Objects of other
variables, or outside the wanted chunk rows and columns, are left out by their names
and never opened. An object that is absent is all fill, and cells that hold the fill
value are no cells.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.sources.array_store import (
    ALL_FILE,
    ARRAY_FILE,
    ATTRS_FILE,
    DIMENSIONS_KEY,
    DTYPES,
    settle_export,
    shared_uri,
)
from gridloom.sources.folders import Folder

RUN_BYTES = 16 * 1024 * 1024  # of chunk objects in one partition
KINDS = {code: kind for kind, code in DTYPES.items()}


def _documents(spark: SparkSession, uri: str) -> dict[str, dict]:
    return json.loads(Folder(spark, uri).text(ALL_FILE))["metadata"]


def _arrays(spark: SparkSession, uri: str, dimensions: int) -> dict[str, dict]:
    """The arrays with that many dimensions; all of them have to be readable."""
    found = {k.rsplit("/", 1)[0]: v for k, v in _documents(spark, uri).items() if k.endswith("/" + ARRAY_FILE)}
    found = {k: v for k, v in sorted(found.items()) if len(v["shape"]) == dimensions}
    for name, info in found.items():
        if info["compressor"] is not None or info["filters"] or info["order"] != "C" or info["dtype"] not in KINDS:
            raise ValueError(f"array {name!r} is not stored as raw little-endian values")
        if len(set(info["chunks"])) > 1:
            raise ValueError(f"array {name!r} has chunks that are not square")
    return found


def number_globs(low: int, high: int) -> list[str]:
    """Glob patterns that match the numbers from ``low`` to ``high`` and no others."""
    out = []
    while low <= high:
        # the longest block of numbers that begins at low and differs in its last digits only
        free = 0
        while low and low % 10 ** (free + 1) == 0 and low + 10 ** (free + 1) - 1 <= high:
            free += 1
        step = 10**free
        first = low // step % 10
        last = min(9, first + (high - low + 1) // step - 1)
        head = str(low // step // 10) if low // step >= 10 else ""
        out.append(f"{head}[{first}-{last}]" + "[0-9]" * free)
        low += (last - first + 1) * step
    return out


def _box(info: dict, wanted: list[tuple]) -> tuple:
    """First and last chunk that is there and wanted, for each dimension."""
    lasts = [-(-n // size) - 1 for n, size in zip(info["shape"], info["chunks"])]
    return tuple((max(0, low or 0), last if high is None else min(last, high)) for last, (low, high) in zip(lasts, wanted))


def _objects(spark: SparkSession, uri: str, arrays: dict[str, dict], wanted: list[tuple]) -> DataFrame | None:
    """``path, content`` of the arrays' objects in the box, a run of them in a partition."""
    folder = Folder(spark, uri)
    groups: dict[tuple, list[str]] = {}
    for name, info in arrays.items():
        box = _box(info, wanted)
        if folder.exists(name) and all(low <= high for low, high in box):
            groups.setdefault(box, []).append(name)
    out = None
    for box, names in groups.items():
        counted = math.prod(high - low + 1 for low, high in box)
        size = sum(counted * math.prod(arrays[n]["chunks"]) * int(arrays[n]["dtype"][2:]) for n in names)
        objects = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", ".".join("{" + ",".join(number_globs(*b)) + "}" for b in box))
            .load([re.sub(r"([{}\[\]*?\\])", r"\\\1", f"{uri}/{n}") for n in names])
            .select("path", "content")
            .coalesce(max(spark.sparkContext.defaultParallelism, -(-size // RUN_BYTES)))
        )
        out = objects if out is None else out.unionByName(objects)
    return out


def _decoded(objects: DataFrame, root: str, arrays: dict[str, dict], kind: str) -> DataFrame:
    """Chunks of all objects that hold more than fill."""
    code = DTYPES[kind]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                name, _, key = path.as_py()[len(root) + 1 :].rpartition("/")
                info, at = arrays[name], [int(k) for k in key.split(".")]
                chunks = info["chunks"]
                fill = np.array(np.nan if info["fill_value"] == "NaN" else info["fill_value"] or 0).astype(info["dtype"])
                block = np.frombuffer(content.as_buffer(), info["dtype"]).reshape(chunks)
                # the last chunk of an axis reaches beyond it
                block = block[tuple(slice(0, n - a * c) for n, a, c in zip(info["shape"], at, chunks))]
                row, col = np.nonzero(~np.isnan(block) if fill != fill else block != fill)
                if not len(row):
                    continue
                offsets = pa.array([0, len(row)], pa.int32())
                yield pa.record_batch(
                    [
                        pa.array([name]),
                        pa.array([at[0]], pa.int64()),
                        pa.array([at[1]], pa.int64()),
                        pa.array([chunks[1]], pa.int32()),
                        pa.ListArray.from_arrays(offsets, pa.array((row * chunks[1] + col).astype(np.int32))),
                        pa.ListArray.from_arrays(offsets, pa.array(block[row, col].astype(code))),
                    ],
                    names=["var", "chunk_row", "chunk_col", "chunk", "pos", "vals"],
                )

    return objects.mapInArrow(decode, _chunk_schema(kind))


def _chunk_schema(kind: str) -> str:
    return f"var string, chunk_row bigint, chunk_col bigint, chunk int, pos array<int>, vals array<{kind}>"


def read_array_chunks(
    spark: SparkSession,
    path: str,
    variables: list[str] | None = None,
    rows: tuple[int, int] | None = None,
    cols: tuple[int, int] | None = None,
) -> DataFrame:
    """Chunk table ``var, chunk_row, chunk_col, chunk, pos, vals`` of an exported store.

    ``rows`` and ``cols`` are the first and last chunk row and column wanted, as from
    :func:`gridloom.operators.lookup.chunk_bounds`. Rows count from the first of the
    stored axis. Values have the stored type, double if variables differ.
    """
    uri = shared_uri(spark, path).rstrip("/")
    settle_export(spark, uri)
    arrays = _arrays(spark, uri, 2)
    found = {info["dtype"] for info in arrays.values()}
    kind = KINDS[found.pop()] if len(found) == 1 else "double"
    chosen = {n: info for n, info in arrays.items() if not variables or n in variables}
    objects = _objects(spark, uri, chosen, [rows or (0, None), cols or (0, None)])
    if objects is None:
        return spark.createDataFrame([], _chunk_schema(kind))
    return _decoded(objects, Folder(spark, uri).qualified, chosen, kind)


def read_axes(spark: SparkSession, path: str) -> DataFrame:
    """``array, idx, label`` of every axis of an exported store."""
    uri = shared_uri(spark, path).rstrip("/")
    settle_export(spark, uri)
    arrays = _arrays(spark, uri, 1)
    root = Folder(spark, uri).qualified
    planned = spark.createDataFrame(
        [(n, info["shape"][0], info["chunks"][0]) for n, info in arrays.items()], "array string, n bigint, size bigint"
    ).withColumn("k", F.explode(F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col("n") / F.col("size")) - 1)))
    objects = _objects(spark, uri, arrays, [(0, None)])
    if objects is None:
        objects = spark.createDataFrame([], "path string, content binary")
    inside = F.substring("path", len(root) + 2, 1_000_000)
    # the key is what follows the last slash; an array's name may hold others
    named = objects.select(
        F.regexp_replace(inside, "/[0-9]+$", "").alias("array"),
        F.substring_index("path", "/", -1).cast("bigint").alias("k"),
        "content",
    )

    def labels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            for name, k, content in zip(batch["array"].to_pylist(), batch["k"].to_pylist(), batch["content"]):
                info = arrays[name]
                (n,), (size,) = info["shape"], info["chunks"]
                if content.is_valid:
                    block = np.frombuffer(content.as_buffer(), info["dtype"]).astype("f8")
                else:
                    block = np.full(size, np.nan if info["fill_value"] == "NaN" else info["fill_value"] or 0, "f8")
                block = block[: n - k * size]
                idx = np.arange(len(block)) + k * size
                yield pa.record_batch(
                    [pa.array([name] * len(block)), pa.array(idx, pa.int64()), pa.array(block)], names=["array", "idx", "label"]
                )

    return planned.join(named, ["array", "k"], "left").select("array", "k", "content").mapInArrow(
        labels, "array string, idx bigint, label double"
    )


def array_documents(spark: SparkSession, path: str) -> dict[str, dict]:
    """The store's metadata: attributes by array, those of the whole under ''."""
    uri = shared_uri(spark, path).rstrip("/")
    settle_export(spark, uri)
    found = {}
    for key, document in _documents(spark, uri).items():
        name, _, last = key.rpartition("/")
        if last == ATTRS_FILE:
            found[name] = {k: v for k, v in document.items() if k != DIMENSIONS_KEY}
    return found
