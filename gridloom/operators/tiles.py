"""Tile membership of features, and blocks put side by side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.operators.rasterize import crossings, pair_crossings, pixel_edges, pixel_x, pixel_y


def tile_pairs(
    gridded: DataFrame, tile: int, keep: list[str] | None = None, distinct: bool = True
) -> DataFrame:
    """Every (feature, tile) whose geometry meets the closed tile box.

    Driven by edges, not by boxes of whole features: each edge is clipped to
    the tile rows it passes and yields the tiles it touches there. A polygon
    also meets the tiles wholly inside it; those hold no edge, so testing one
    cell centre per tile finds them. With ``distinct=False`` pairs may repeat.
    """
    keep = keep or []
    n = F.lit(int(tile)).cast("long")
    carried = ["layer", "fid", *keep]
    base = gridded.withColumns(
        {
            "_tiles_x": F.ceil(F.col("nx") / n),
            "_tiles_y": F.ceil(F.col("ny") / n),
            "_width": F.col("nx"),
            "_height": F.col("ny"),
        }
    )
    limits = ["_tiles_x", "_tiles_y", "_width", "_height"]

    outlines = base.where(F.col("geom_type") != "POINT")
    touched = _touched(pixel_edges(outlines, [*carried, *limits]), n)
    lone = base.where(F.col("geom_type") == "POINT").select(
        "*", F.explode(F.flatten("rings")).alias("p")
    ).select(
        *carried, *limits,
        pixel_x(F.col("p.x")).alias("x0"), pixel_y(F.col("p.y")).alias("y0"),
        pixel_x(F.col("p.x")).alias("x1"), pixel_y(F.col("p.y")).alias("y1"),
    )
    parts = touched.unionByName(_touched(lone, n))

    polygons = base.where(F.col("geom_type") == "POLYGON")
    hits = crossings(polygons.select(*carried, *limits, *_grid(base), "rings"), every=tile)
    inner = (
        pair_crossings(hits, [*carried, *limits])
        .withColumn("tile_row", F.floor(F.col("row") / n))
        .withColumn("from", F.ceil(F.col("c0") / n))
        .withColumn("to", F.floor(F.col("c1") / n))
        .where(F.col("to") >= F.col("from"))
        .withColumn("tile_col", F.explode(F.sequence("from", "to")))
    )
    columns = [*carried, "tile_row", "tile_col", "_tiles_x"]
    pairs = parts.select(*columns).unionByName(inner.select(*columns))
    pairs = pairs.withColumn(
        "tile_seq", F.col("tile_row") * F.col("_tiles_x") + F.col("tile_col")
    ).drop("_tiles_x")
    return pairs.distinct() if distinct else pairs


def _grid(df: DataFrame) -> list[str]:
    return [c for c in ("lon_min", "lat_min", "lon_max", "lat_max", "nx", "ny", "dx", "dy") if c in df.columns]


def _tile_range(lo: Column, hi: Column, n: Column, count: Column) -> tuple[Column, Column]:
    """Tiles whose closed interval meets [lo, hi]."""
    first = F.greatest(F.lit(0).cast("long"), F.ceil(lo / n) - 1)
    last = F.least(count - 1, F.floor(hi / n))
    return first, last


def _touched(edges: DataFrame, n: Column) -> DataFrame:
    """Tiles each edge meets; the last row and column of tiles end with the grid."""
    first, last = _tile_range(F.col("y0"), F.col("y1"), n, F.col("_tiles_y"))
    rows = (
        edges.withColumn("_f", first)
        .withColumn("_l", last)
        .where(F.col("_l") >= F.col("_f"))
        .withColumn("tile_row", F.explode(F.sequence("_f", "_l")))
    )
    end = F.least((F.col("tile_row") + 1) * n, F.col("_height")).cast("double")
    top = F.greatest(F.col("y0"), (F.col("tile_row") * n).cast("double"))
    bottom = F.least(F.col("y1"), end)

    def x_at(y: Column) -> Column:
        slope = F.try_divide((y - F.col("y0")) * (F.col("x1") - F.col("x0")), F.col("y1") - F.col("y0"))
        return F.coalesce(F.col("x0") + slope, F.col("x0"))

    clipped = rows.withColumn(
        "_xa", F.when(top == F.col("y0"), F.col("x0")).otherwise(x_at(top))
    ).withColumn("_xb", F.when(bottom == F.col("y1"), F.col("x1")).otherwise(x_at(bottom)))
    # rounding may put a clipped end on the wrong side of a border, so tiles
    # next to it stay candidates until the box test decides
    slack = F.lit(1e-6)
    first, last = _tile_range(
        F.least("_xa", "_xb") - slack, F.greatest("_xa", "_xb") + slack, n, F.col("_tiles_x")
    )
    candidates = (
        clipped.withColumn("_f", first)
        .withColumn("_l", last)
        .where(F.col("_l") >= F.col("_f"))
        .withColumn("tile_col", F.explode(F.sequence("_f", "_l")))
    )
    return candidates.where(_meets_box(n)).drop("_f", "_l", "_xa", "_xb", "x0", "x1", "y0", "y1")


def _meets_box(n: Column) -> Column:
    """Edge against its candidate tile's closed box: they are apart only if an
    axis or the edge's own line separates them."""
    r0, c0 = F.col("tile_row") * n, F.col("tile_col") * n
    r1, c1 = F.least(r0 + n, F.col("_height")), F.least(c0 + n, F.col("_width"))
    x0, y0, x1, y1 = (F.col(c) for c in ("x0", "y0", "x1", "y1"))
    side = lambda r, c: (x1 - x0) * (r - y0) - (y1 - y0) * (c - x0)
    sides = [side(r0, c0), side(r0, c1), side(r1, c0), side(r1, c1)]
    boxes = (F.least(x0, x1) <= c1) & (F.greatest(x0, x1) >= c0) & (y0 <= r1) & (y1 >= r0)
    return boxes & (F.least(*sides) <= 0) & (F.greatest(*sides) >= 0)


def strip_max(cells: DataFrame, variable: str, height: int, group: list[str]) -> DataFrame:
    """Largest value of each strip of ``height`` rows, missing values left out."""
    v = F.col(variable)
    return (
        cells.groupBy(*group, F.floor(F.col("row") / F.lit(int(height))).alias("strip"))
        .agg(F.max(F.when(~F.isnan(v), v)).alias("max_value"))
    )


def beside(blocks: list[tuple[DataFrame, int]]) -> DataFrame:
    """Put blocks side by side along longitude, each at its column offset."""
    return _shifted(blocks, "col")


def stack(strips: list[tuple[DataFrame, int]]) -> DataFrame:
    """Put strips below each other along latitude, each at its row offset."""
    return _shifted(strips, "row")


def _shifted(parts: list[tuple[DataFrame, int]], axis: str) -> DataFrame:
    moved = [df.withColumn(axis, (F.col(axis) + F.lit(off)).cast("long")) for df, off in parts]
    out = moved[0]
    for m in moved[1:]:
        out = out.unionByName(m)
    return out
