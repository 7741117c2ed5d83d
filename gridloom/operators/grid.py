"""Grid geometry: bounds, size, cell size, axis labels, tile layout."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions import geometry as G
from gridloom.plans.joins import join_dimension

SPEC_COLUMNS = ["lon_min", "lat_min", "lon_max", "lat_max", "nx", "ny", "dx", "dy"]


def layer_bounds(features: DataFrame) -> DataFrame:
    """Smallest box around all geometry of each layer.

    With stored boxes only those four columns are read, not the geometry.
    """
    x0, y0, x1, y1 = G.box_of(features.columns)
    return features.groupBy("layer").agg(
        F.min(x0).alias("lon_min"),
        F.min(y0).alias("lat_min"),
        F.max(x1).alias("lon_max"),
        F.max(y1).alias("lat_max"),
    )


def grid_spec(bounds: DataFrame, resolution: float) -> DataFrame:
    """Grid size and cell size per layer; a zero extent still gets one cell."""
    res = F.lit(float(resolution))
    size = lambda extent: F.greatest(F.lit(1).cast("long"), F.ceil(extent / res))
    cell = lambda extent, n: F.when(extent > 0, extent / n).otherwise(res)
    lon, lat = F.col("lon_max") - F.col("lon_min"), F.col("lat_max") - F.col("lat_min")
    return (
        bounds.withColumn("nx", size(lon))
        .withColumn("ny", size(lat))
        .withColumn("dx", cell(lon, F.col("nx")))
        .withColumn("dy", cell(lat, F.col("ny")))
    )


def with_grid(features: DataFrame, spec: DataFrame, settled: bool = False) -> DataFrame:
    """Attach each feature's grid by layer."""
    return join_dimension(features, spec.select("layer", *SPEC_COLUMNS), ["layer"], settled=settled)


@dataclass(frozen=True)
class RasterGrid:
    """Grid of one raster, known from its header."""

    lon_min: float
    lat_min: float
    lon_max: float
    lat_max: float
    nx: int
    ny: int

    @property
    def dx(self) -> float:
        return (self.lon_max - self.lon_min) / self.nx

    @property
    def dy(self) -> float:
        return (self.lat_max - self.lat_min) / self.ny

    def columns(self) -> dict[str, Column]:
        return {
            "lon_min": F.lit(float(self.lon_min)),
            "lat_min": F.lit(float(self.lat_min)),
            "lon_max": F.lit(float(self.lon_max)),
            "lat_max": F.lit(float(self.lat_max)),
            "nx": F.lit(int(self.nx)).cast("long"),
            "ny": F.lit(int(self.ny)).cast("long"),
            "dx": F.lit(self.dx),
            "dy": F.lit(self.dy),
        }


def on_raster(df: DataFrame, grid: RasterGrid) -> DataFrame:
    """Attach a raster's grid as literals."""
    return df.withColumns(grid.columns())


def axis_label(index: Column, first: Column, last: Column, n: Column) -> Column:
    """Label ``index`` of ``n`` evenly spaced labels from first to last, 4 decimals."""
    step = F.coalesce(F.try_divide(last - first, (n - 1).cast("double")), F.lit(0.0))
    exact = F.when((index == n - 1) & (n > 1), last).otherwise(index.cast("double") * step + first)
    return F.rint(exact * F.lit(1e4)) / F.lit(1e4)


def latitude_label(row: Column, labels: str = "edges") -> Column:
    """Latitude of a north-up row; needs the grid columns."""
    if labels == "centers":
        return F.col("lat_max") - (row + F.lit(0.5)) * F.col("dy")
    return axis_label(row, F.col("lat_max"), F.col("lat_min"), F.col("ny"))


def longitude_label(col: Column, labels: str = "edges") -> Column:
    if labels == "centers":
        return F.col("lon_min") + (col + F.lit(0.5)) * F.col("dx")
    return axis_label(col, F.col("lon_min"), F.col("lon_max"), F.col("nx"))


def assign_coords(
    cells: DataFrame, spec: DataFrame, labels: str = "edges", settled: bool = False
) -> DataFrame:
    """Add latitude and longitude labels to layered cells by row and col."""
    joined = join_dimension(
        cells, spec.select("layer", *SPEC_COLUMNS), ["layer"], how="left", settled=settled, spread="row"
    )
    return (
        joined.withColumn("latitude", latitude_label(F.col("row"), labels))
        .withColumn("longitude", longitude_label(F.col("col"), labels))
        .drop(*SPEC_COLUMNS)
    )


def ascending_rows(cells: DataFrame, ny: Column) -> DataFrame:
    """Renumber north-up rows to ascending latitude: arithmetic, not a sort."""
    return cells.withColumn("row", (ny - 1 - F.col("row")).cast("long"))


def axis_labels(spec: DataFrame, labels: str = "edges") -> DataFrame:
    """Both axes of each layer as rows ``(layer, axis, idx, label)``."""
    lat = spec.select(
        "layer", *SPEC_COLUMNS, F.explode(F.sequence(F.lit(0).cast("long"), F.col("ny") - 1)).alias("idx")
    ).select("layer", F.lit("latitude").alias("axis"), "idx", latitude_label(F.col("idx"), labels).alias("label"))
    lon = spec.select(
        "layer", *SPEC_COLUMNS, F.explode(F.sequence(F.lit(0).cast("long"), F.col("nx") - 1)).alias("idx")
    ).select("layer", F.lit("longitude").alias("axis"), "idx", longitude_label(F.col("idx"), labels).alias("label"))
    return lat.unionByName(lon)


def tile_grid(spec: DataFrame, tile: int) -> DataFrame:
    """Windows of at most ``tile`` x ``tile`` cells, row-major, with their boxes."""
    n, zero = F.lit(int(tile)), F.lit(0).cast("long")
    return (
        spec.withColumn("row_off", F.explode(F.sequence(zero, F.col("ny") - 1, n.cast("long"))))
        .withColumn("col_off", F.explode(F.sequence(zero, F.col("nx") - 1, n.cast("long"))))
        .withColumn("tile_row", F.floor(F.col("row_off") / n))
        .withColumn("tile_col", F.floor(F.col("col_off") / n))
        .withColumn("height", F.least(n, F.col("ny") - F.col("row_off")).cast("long"))
        .withColumn("width", F.least(n, F.col("nx") - F.col("col_off")).cast("long"))
        .withColumn("west", F.col("lon_min") + F.col("col_off") * F.col("dx"))
        .withColumn("north", F.col("lat_max") - F.col("row_off") * F.col("dy"))
        .withColumn("east", F.col("lon_min") + (F.col("col_off") + F.col("width")) * F.col("dx"))
        .withColumn("south", F.col("lat_max") - (F.col("row_off") + F.col("height")) * F.col("dy"))
        .withColumn(
            "tile_seq",
            F.col("tile_row") * F.ceil(F.col("nx") / n) + F.col("tile_col"),
        )
        .select(
            "layer", "tile_row", "tile_col", "tile_seq", "row_off", "col_off",
            "height", "width", "west", "south", "east", "north",
        )
    )


def infer_resolution(labels: DataFrame, axis: str = "latitude") -> DataFrame:
    """Distance of the two smallest distinct labels."""
    two = labels.select(axis).distinct().orderBy(axis).limit(2)
    return two.agg(F.abs(F.max(axis) - F.min(axis)).alias("resolution"))
