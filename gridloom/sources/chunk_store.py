"""Chunk tables on disk: Parquet, with one metadata table beside them.

Every write goes to a version folder of its own. A version counts from the moment its
marker file stands beside the folders, which is the last thing a write does; readers
take the version of the highest marker. So a store is replaced at once or not at all,
and a table read before keeps its files until the version after next.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.sources.folders import Folder

VERSIONS = "versions"
MARKER = "_version-"
KEPT = 2  # versions that stay after a write


def _markers(folder: Folder) -> list[str]:
    """Markers, oldest first; their names hold a number and the version."""
    return [n for n in folder.names() if n.startswith(MARKER)]


def _version(marker: str) -> str:
    return marker.removeprefix(MARKER).split("-", 1)[1]


def current_root(spark: SparkSession, path: str) -> str:
    """Folder of the current version; the store itself if it has no versions."""
    markers = _markers(Folder(spark, path))
    return f"{path}/{VERSIONS}/{_version(markers[-1])}" if markers else path


def write_chunks(chunks: DataFrame, metadata: DataFrame, path: str) -> None:
    """Replace the store at ``path``: chunks by layer and variable, metadata in one
    table. A write that fails leaves the store as it was, and may read from it. Of
    two writes at once the last to end stands."""
    spark, version = chunks.sparkSession, uuid.uuid4().hex
    root = f"{path}/{VERSIONS}/{version}"
    try:
        (
            chunks.repartition("layer", "var", "chunk_row")
            .sortWithinPartitions("layer", "var", "chunk_row", "chunk_col")
            .write.partitionBy("layer", "var")
            .parquet(f"{root}/chunks")
        )
        metadata.write.parquet(f"{root}/metadata")
    except BaseException:
        Folder(spark, root).delete()
        raise
    folder = Folder(spark, path)
    while True:
        markers = _markers(folder)
        number = int(markers[-1].removeprefix(MARKER).split("-", 1)[0]) + 1 if markers else 1
        if folder.mark(f"{MARKER}{number:010d}-{version}"):
            break
    sweep(spark, path)


def sweep(spark: SparkSession, path: str, kept: int = KEPT) -> int:
    """Remove all but the last ``kept`` versions; how many went. Folders without a
    marker are left: a write may be under way."""
    folder = Folder(spark, path)
    old = _markers(folder)[: -max(kept, 1)]
    for marker in old:
        folder.delete(marker)
        folder.delete(f"{VERSIONS}/{_version(marker)}")
    return len(old)


def read_chunks(
    spark: SparkSession,
    path: str,
    layer: str | None = None,
    variables: list[str] | None = None,
    value_type: str | None = None,
) -> DataFrame:
    """Chunk table of the current version; layer and variables prune partitions.
    Values have the stored type unless one is named."""
    root = current_root(spark, path)
    if value_type is None:
        stored = spark.read.parquet(f"{root}/chunks").schema["vals"].dataType
        value_type = stored.elementType.simpleString()
    # the schema is stated so that a layer named like a number stays text
    schema = (
        f"chunk_row bigint, chunk_col bigint, chunk int, pos array<int>, vals array<{value_type}>, "
        "layer string, var string"
    )
    chunks = spark.read.schema(schema).parquet(f"{root}/chunks")
    if layer is not None:
        chunks = chunks.where(F.col("layer") == layer)
    if variables:
        chunks = chunks.where(F.col("var").isin(variables))
    return chunks


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{current_root(spark, path)}/metadata")
