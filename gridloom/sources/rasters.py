"""Raster cell tables: ``band, row, col, value``, row 0 in the north."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators.grid import RasterGrid

CELL_COLUMNS = ["band", "row", "col", "value"]


def read_raster(spark: SparkSession, path: str, band: int | None = None, fmt: str = "parquet") -> DataFrame:
    """Read a cell table; a band given reaches the scan. Values keep their type."""
    cells = spark.read.format(fmt).load(path).select(*CELL_COLUMNS)
    return cells if band is None else cells.where(F.col("band") == int(band))


def raster_grid(cells: DataFrame, west: float, south: float, east: float, north: float) -> RasterGrid:
    """Grid of a cell table without a header: its size is the largest index."""
    top = cells.agg(F.max("row").alias("r"), F.max("col").alias("c")).first()
    return RasterGrid(west, south, east, north, int(top["c"]) + 1, int(top["r"]) + 1)


def band_info(cells: DataFrame, descriptions: DataFrame | None = None) -> DataFrame:
    """One row per band with its description, if a table of them is given."""
    bands = cells.groupBy("band").agg(F.count(F.lit(1)).alias("n_cells"))
    if descriptions is None:
        return bands.withColumn("description", F.lit("").cast("string"))
    return bands.join(descriptions.select("band", "description"), "band", "left")
