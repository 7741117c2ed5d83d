"""Joins against small tables whose size is measured, not assumed."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 32 * 1024 * 1024
SALTS = 64
HOT_ROWS = 1_000_000


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the session's checkpoint folder; only a local session gets its own."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master == "local" or sc.master.startswith("local["):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="gridloom-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def settle(df: DataFrame) -> DataFrame:
    """Compute a small table once into the checkpoint folder, cutting its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def store(df: DataFrame) -> DataFrame:
    """The same for a large table, as Parquet, so that readers prune columns.

    The files stay until the checkpoint folder is cleaned.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def measured_bytes(df: DataFrame) -> int:
    """Upper estimate of a table's in-memory size, from its actual values."""
    width = F.lit(16)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(c), F.lit(0)) + F.lit(16)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + F.lit(32)
        else:
            width = width + F.lit(8)
    return df.agg(F.coalesce(F.sum(width.cast("long")), F.lit(0)).alias("b")).first()["b"]


def shuffle_partitions(df: DataFrame) -> int:
    """The session's shuffle width, for stages that grow after the shuffle and
    must not be coalesced by their input size."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def join_dimension(
    fact: DataFrame,
    dim: DataFrame,
    on: list[str],
    how: str = "inner",
    settled: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    spread: str = "fid",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join a large table with a table expected to be small.

    ``dim`` is computed once and measured. Within ``broadcast_bytes`` it is
    broadcast and the fact side is not shuffled, else see :func:`join_skewed`.
    ``how`` is any join that keeps or drops fact rows one by one: ``inner``,
    ``left``, ``left_semi`` or ``left_anti``.
    """
    if not settled:
        dim = settle(dim)
    if measured_bytes(dim) <= broadcast_bytes:
        return fact.join(F.broadcast(dim), on, how)
    return join_skewed(fact, dim, on, how, spread, hot_rows)


def join_skewed(
    fact: DataFrame,
    table: DataFrame,
    on: list[str],
    how: str = "inner",
    spread: str = "fid",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Shuffle join that spreads keys with more than ``hot_rows`` fact rows.

    Neither side's size is known, so neither is broadcast. The fact keys are counted first. Hot keys, if any, are joined on the key and
    a salt taken from the fact column ``spread``; only their few table rows are
    copied to every salt. All other keys are joined as usual.
    """
    hot = settle(
        fact.groupBy(*on).count().where(F.col("count") > hot_rows).select(*on)
    )
    table = table.hint("merge")
    if hot.isEmpty():
        return fact.join(table, on, how)
    if measured_bytes(hot) <= BROADCAST_BYTES:
        hot = F.broadcast(hot)
    flagged = fact.join(hot.withColumn("_hot", F.lit(True)), on, "left")
    calm = flagged.where(F.col("_hot").isNull()).drop("_hot").join(table, on, how)
    salt = F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")
    copies = table.join(hot, on, "left_semi").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    ).hint("merge")
    busy = flagged.where(F.col("_hot")).drop("_hot").withColumn("_salt", salt)
    return calm.unionByName(busy.join(copies, [*on, "_salt"], how).drop("_salt"))
