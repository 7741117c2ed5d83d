"""Masks, lookups, subsets and picks on cell tables."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions import values as V
from gridloom.operators.grid import SPEC_COLUMNS, RasterGrid
from gridloom.plans.joins import join_skewed


def mask_equals(df: DataFrame, variable: str, value: float) -> DataFrame:
    return df.where(F.col(variable) == F.lit(value))


def mask_valid(df: DataFrame, variable: str) -> DataFrame:
    return df.where(V.has_value(F.col(variable)))


def select_band(cells: DataFrame, band: int) -> DataFrame:
    return cells.where(F.col("band") == int(band))


def rename_dims(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def lookup_label(cells: DataFrame, latitude: Column | float, longitude: Column | float) -> DataFrame:
    """Cells with exactly these labels; none gives an empty result."""
    return cells.where((F.col("latitude") == latitude) & (F.col("longitude") == longitude))


def cell_of(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Row and column of a position; needs the grid columns."""
    row = F.floor((F.col("lat_max") - lat) / F.col("dy"))
    col = F.floor((lon - F.col("lon_min")) / F.col("dx"))
    return row, col


def lookup_positions(positions: DataFrame, cells: DataFrame) -> DataFrame:
    """Value under each position ``(lon, lat)``, which carries the grid columns."""
    row, col = cell_of(F.col("lon"), F.col("lat"))
    at = positions.withColumn("row", row).withColumn("col", col).drop(*SPEC_COLUMNS)
    indexed = cells.withColumn("row", F.col("row").cast("long")).withColumn("col", F.col("col").cast("long"))
    return join_skewed(at, indexed, ["row", "col"], spread="fid" if "fid" in at.columns else "lon")


def subset_bbox(cells: DataFrame, west: float, south: float, east: float, north: float) -> DataFrame:
    """Cells whose labels lie in the closed box."""
    return cells.where(
        F.col("latitude").between(south, north) & F.col("longitude").between(west, east)
    )


def chunk_bounds(
    grid: RasterGrid, chunk: int, west: float, south: float, east: float, north: float, ascending: bool = False
) -> tuple[tuple[int, int], tuple[int, int]]:
    """First and last chunk row, and column, that can hold labels of the closed box.

    Two cells of slack on every side cover both kinds of labels and rounding;
    the labels themselves are compared after unpacking.
    """
    col_from = math.floor((west - grid.lon_min) / grid.dx) - 2
    col_to = math.floor((east - grid.lon_min) / grid.dx) + 2
    row_from = math.floor((grid.lat_max - north) / grid.dy) - 2
    row_to = math.floor((grid.lat_max - south) / grid.dy) + 2
    if ascending:
        row_from, row_to = grid.ny - 1 - row_to, grid.ny - 1 - row_from
    return (row_from // chunk, row_to // chunk), (col_from // chunk, col_to // chunk)


def chunk_window(
    grid: RasterGrid, chunk: int, west: float, south: float, east: float, north: float, ascending: bool = False
) -> Column:
    """The same as literal bounds on ``chunk_row, chunk_col``, so they reach a stored
    chunk table's scan."""
    rows, cols = chunk_bounds(grid, chunk, west, south, east, north, ascending)
    return F.col("chunk_row").between(*rows) & F.col("chunk_col").between(*cols)


def index_matches(matches: DataFrame, group: list[str]) -> DataFrame:
    """0-based row-major position ``match`` of each matching cell in its group.

    Rows are counted first and their counts summed up (one record per grid
    row); cells are then numbered row by row, at most one grid row per group.
    """
    before = Window.partitionBy(*group).orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        matches.groupBy(*group, "row")
        .count()
        .withColumn("_start", F.coalesce(F.sum("count").over(before), F.lit(0)))
        .drop("count")
    )
    in_row = F.row_number().over(Window.partitionBy(*group, "row").orderBy("col"))
    return (
        matches.withColumn("_n", in_row)
        .join(starts, [*group, "row"])
        .withColumn("match", (F.col("_start") + F.col("_n") - 1).cast("long"))
        .drop("_start", "_n")
    )


def pick_key(seed: int, *at: str) -> Column:
    """Repeatable pseudo-random order of cells: a digest of the seed and the cell's place."""
    return F.md5(F.concat_ws(":", F.lit(str(int(seed))), *[F.col(c).cast("string") for c in at]))


def sample_cell(matches: DataFrame, seed: int = 0, at: tuple[str, ...] = ("row", "col")) -> DataFrame:
    """One matching cell, every one with the same chance; ``at`` names the columns
    that tell cells apart."""
    return matches.withColumn("_key", pick_key(seed, *at)).orderBy("_key", *at).limit(1).drop("_key")


def variable_max(df: DataFrame, variable: str, group: list[str]) -> DataFrame:
    """Largest value per group; missing values are left out."""
    v = F.col(variable)
    return df.groupBy(*group).agg(F.max(F.when(~F.isnan(v), v)).alias("max_value"))
