"""Two-pass external shuffle into shards of equal row counts.

Pass one scatters the records uniformly into buckets that fit a task's memory, by
a seeded hash. Pass two shuffles each bucket on its own by Fisher and Yates and
writes it. The buckets in order are one uniform permutation of the table; the
shards are equal cuts of it, so their row counts differ by at most one and a
record's slot is its place in the cut. Only the counts of the written buckets are
added up, so the slots are without gaps whatever a retried task did.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.frames import col
from gridloom.plans.joins import join_dimension, settle, store

BUCKET_BYTES = 16 * 1024 * 1024


def fisher_yates(n: int, seed: list[int]) -> np.ndarray:
    """A uniform permutation of ``range(n)``."""
    order = list(range(n))
    draws = np.random.default_rng(seed).integers(0, np.arange(1, n + 1)) if n else ()
    for i in range(n - 1, 0, -1):
        j = int(draws[i])
        order[i], order[j] = order[j], order[i]
    return np.array(order, dtype=np.int64)


def _shuffle_bucket(seed: int) -> Callable[[pa.Table], pa.Table]:
    def shuffled(group: pa.Table) -> pa.Table:
        group = group.take(pc.sort_indices(group, sort_keys=[("place", "ascending")]))
        order = fisher_yates(len(group), [seed, group["bucket"][0].as_py()])
        group = group.take(pa.array(order))
        return group.set_column(group.column_names.index("place"), "place", pa.array(np.arange(len(group)), pa.int64()))

    return shuffled


def record_bytes(df: DataFrame) -> Column:
    """Bytes of a record: those of its texts, plus eight for every other value."""
    size = F.lit(16)
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(col(f.name)), F.lit(0))
        elif isinstance(f.dataType, T.ArrayType):
            size = size + F.lit(8) * F.greatest(F.size(col(f.name)), F.lit(1))
        else:
            size = size + F.lit(8)
    return size.cast("long")


def shuffle_into_shards(
    df: DataFrame,
    keys: list[str],
    shards: int = 8,
    seed: int = 7,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """All records with ``shard`` (int, from 0) and ``slot`` (long, from 0).

    The written buckets are Parquet files in the session's checkpoint folder; a
    read of one shard is a range of them. A bucket is chosen by ``keys`` and
    the record's place in its input split, so repeated rows, one hot key or null
    keys spread like all others; the same files read by the same splits give the
    same shards again. An empty table gives an empty result. Columns of the table
    called ``shard`` or ``slot`` are replaced.
    """
    df = df.drop("shard", "slot")
    total = df.agg(F.sum(record_bytes(df)).alias("b")).first()["b"] or 0
    buckets = max(1, -(-total // bucket_bytes))
    place = F.monotonically_increasing_id()
    scattered = df.select(
        F.struct(*[col(c) for c in df.columns]).alias("record"),
        place.alias("place"),
        F.pmod(F.xxhash64(F.lit(seed), *[col(k) for k in keys], place), F.lit(buckets)).cast("long").alias("bucket"),
    )
    written = store(scattered.groupBy("bucket").applyInArrow(_shuffle_bucket(seed), scattered.schema))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = settle(written.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")))
    rows = counts.agg(F.sum("n").alias("n")).first()["n"] or 0
    first = counts.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    placed = join_dimension(written, first, ["bucket"], spread="place")
    # the rows of shard s begin at ceil(s * rows / shards)
    placed = placed.withColumn("position", F.col("first") + F.col("place"))
    placed = placed.withColumn("shard", F.expr(f"position * {shards} div {max(rows, 1)}").cast("int"))
    start = F.expr(f"(cast(shard as bigint) * {rows} + {shards - 1}) div {shards}")
    return placed.select("record.*", "shard", (F.col("position") - start).cast("long").alias("slot"))


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder per shard, records in slot order inside each file."""
    placed.repartition("shard", F.floor(col("slot") / F.lit(100_000))).sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).mode("overwrite").parquet(path)
