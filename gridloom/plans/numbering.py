"""Consecutive numbering that does not pull a group into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.plans.joins import join_dimension, settle

WINDOW_ROWS = 500_000


def number_rows(
    df: DataFrame,
    group: list[str],
    order: list[Column],
    name: str,
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Add ``name``: the 1-based position of a row in its group by ``order``.

    ``order`` must be unique within the group. The rows are computed once, so
    the result is cheap to read again. A table of at most
    ``window_rows`` rows is numbered by one window. A larger one is
    range-partitioned on (group, order): each range is numbered on its own and
    shifted by the number of rows its group has in earlier ranges.
    """
    base = settle(df)
    if base.count() <= window_rows:
        return base.withColumn(name, F.row_number().over(_window(group, order)).cast("long"))
    ranged = settle(
        base.repartitionByRange(*[F.col(g) for g in group], *order).withColumn(
            "_range", F.spark_partition_id()
        )
    )
    before = _window(group, [F.col("_range")]).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy(*group, "_range")
        .count()
        .withColumn("_start", F.coalesce(F.sum("count").over(before), F.lit(0)))
        .drop("count")
    )
    local = F.row_number().over(_window(group + ["_range"], order))
    spread = [c for c in df.columns if c not in group][0]
    return (
        join_dimension(
            ranged.withColumn("_local", local), starts, group + ["_range"], spread=spread
        )
        .withColumn(name, (F.col("_start") + F.col("_local")).cast("long"))
        .drop("_range", "_start", "_local")
    )


def _window(group: list[str], order: list[Column]):
    spec = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    return spec.orderBy(*order)
