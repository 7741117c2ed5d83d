"""Burn polygons, lines and points onto a grid; the last feature wins.

All inputs carry ``layer``, ``fid``, ``rings`` and the grid columns of
:func:`gridloom.operators.grid.with_grid`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions import geometry as G
from gridloom.operators.sweep import PART_COLUMNS, cut_rows, winning_spans
from gridloom.plans.joins import join_dimension, shuffle_partitions, store

# A scanline of one layer with more crossings than this is not kept in one task.
HOT_ROW_CROSSINGS = 2_000_000
# The same for the spans of one tile.
HOT_TILE_SPANS = 1_000_000
# Nor is a scanline or tile that fills more cells than this, overlaps counted.
HOT_CELLS = 200_000_000

GRID_COLUMNS = ["lon_min", "lat_min", "lon_max", "lat_max", "nx", "ny", "dx", "dy"]
GEOMETRY_COLUMNS = [
    "geom_type", "rings", *G.BOX_COLUMNS, G.SIZE_COLUMN, *GRID_COLUMNS,
]


def _carried(features: DataFrame) -> list[str]:
    return [c for c in features.columns if c not in GEOMETRY_COLUMNS]


def pixel_x(x: Column) -> Column:
    return (x - F.col("lon_min")) / F.col("dx")


def pixel_y(y: Column) -> Column:
    return (F.col("lat_max") - y) / F.col("dy")


def first_center(v: Column) -> Column:
    """Index of the first cell whose centre is at or after ``v``."""
    return F.ceil(v - F.lit(0.5))


def pixel_edges(features: DataFrame, keep: list[str]) -> DataFrame:
    """One row per edge in pixel space, oriented from low to high row."""
    pixels = [c for c in ("lon_min", "lat_max", "dx", "dy") if c not in keep]
    ring, e = F.col("ring"), F.col("e")
    # exploding rings and then zipped vertices keeps this within generated code
    ends = (
        features.select(*keep, *pixels, F.explode("rings").alias("ring"))
        .where(F.size(ring) >= 2)
        .select(
            *keep,
            *pixels,
            F.explode(
                F.arrays_zip(
                    F.slice(ring, 1, F.size(ring) - 1).alias("a"),
                    F.slice(ring, 2, F.size(ring) - 1).alias("b"),
                )
            ).alias("e"),
        )
        .select(
            *keep,
            pixel_x(e["a"]["x"]).alias("ax"),
            pixel_y(e["a"]["y"]).alias("ay"),
            pixel_x(e["b"]["x"]).alias("bx"),
            pixel_y(e["b"]["y"]).alias("by"),
        )
    )
    up = F.col("ay") <= F.col("by")
    return ends.select(
        *keep,
        F.when(up, F.col("ax")).otherwise(F.col("bx")).alias("x0"),
        F.least("ay", "by").alias("y0"),
        F.when(up, F.col("bx")).otherwise(F.col("ax")).alias("x1"),
        F.greatest("ay", "by").alias("y1"),
    )


def crossings(features: DataFrame, every: int = 1) -> DataFrame:
    """Where each polygon outline crosses the centre line of every n-th row.

    An edge covers a row if the row's centre lies in the edge's half-open
    height, so horizontal edges cover none and a shared vertex counts once.
    """
    n = F.lit(int(every)).cast("long")
    zero = F.lit(0).cast("long")
    steps = (
        pixel_edges(features, [*_carried(features), "nx", "ny"])
        .where(F.col("y0") < F.col("y1"))
        .withColumn("first", F.ceil(F.greatest(zero, first_center(F.col("y0"))) / n))
        .withColumn("last", F.floor(F.least(F.col("ny") - 1, first_center(F.col("y1")) - 1) / n))
        .where(F.col("last") >= F.col("first"))
        .withColumn("step", F.explode(F.sequence("first", "last")))
        .withColumn("row", F.col("step") * n)
    )
    x = F.col("x0") + (F.col("row") + F.lit(0.5) - F.col("y0")) * (F.col("x1") - F.col("x0")) / (
        F.col("y1") - F.col("y0")
    )
    # clamped to the grid here, so that its width need not be shuffled
    inside = F.least(F.greatest(x, F.lit(0.0)), F.col("nx").cast("double"))
    return steps.select(*_carried(features), "row", inside.alias("start"))


def pair_crossings(hits: DataFrame, carried: list[str]) -> DataFrame:
    """Fill between the 1st and 2nd, 3rd and 4th, ... crossing of a scanline."""
    along = Window.partitionBy("layer", "fid", "row").orderBy("start")
    pairs = (
        hits.withColumn("i", F.row_number().over(along))
        .withColumn("end", F.lead("start").over(along))
        .where(F.col("i") % 2 == 1)
    )
    c0, c1 = first_center(F.col("start")), first_center(F.col("end")) - 1
    return pairs.select(*carried, "row", c0.alias("c0"), c1.alias("c1")).where(
        F.col("c1") >= F.col("c0")
    )


def polygon_spans(features: DataFrame) -> DataFrame:
    """Runs of cells ``row, c0..c1`` whose centres are inside each polygon.

    Even-odd over all rings, so holes and parts need no special case. The one
    shuffle is on (layer, fid, row): a single huge polygon is spread by row.
    """
    return pair_crossings(crossings(features), _carried(features))


def span_cells(spans: DataFrame) -> DataFrame:
    """One row per burned cell."""
    rest = [c for c in spans.columns if c not in ("c0", "c1")]
    return spans.select(*rest, F.explode(F.sequence("c0", "c1")).alias("col"))


def burn_polygons(features: DataFrame) -> DataFrame:
    return span_cells(polygon_spans(features))


def polygon_cells(
    features: DataFrame,
    variables: list[str],
    hot_row: int = HOT_ROW_CROSSINGS,
    hot_cells: int = HOT_CELLS,
) -> DataFrame:
    """Burned cells of polygons, last feature wins, with a single shuffle and without
    Python; :func:`swept_cells` is the better way where features overlap.

    Crossings are shuffled on (layer, row): pairing, filling and the last-wins
    aggregate all keep that layout, so cells are never shuffled. Rows with more
    than ``hot_row`` crossings, or filling possibly more than ``hot_cells``
    cells, take the other way: paired per (layer, fid, row), filled, then merged
    after a partial aggregate.

    An edge crosses a row at most once, and a pair of crossings fills at most
    the width of its feature's box; so rows are only counted if all vertices
    together could make one hot.
    """
    carried = ["layer", "fid", *variables]
    hits = crossings(features.select(*carried, *_present(features)))
    width = shuffle_partitions(features)
    west, _, east, _ = G.box_of(features.columns)
    n, wide = G.vertex_count(features.columns), (east - west) / F.col("dx") + 1
    most = features.agg(F.sum(n).alias("n"), (F.sum(n * wide) / 2).alias("cells")).first()
    hot = None
    if (most["n"] or 0) > hot_row or (most["cells"] or 0) > hot_cells:
        hot = (
            crossings(features.select("layer", "fid", wide.alias("_wide"), *_present(features)))
            .groupBy("layer", "row")
            .agg(F.count(F.lit(1)).alias("n"), (F.sum("_wide") / 2).alias("cells"))
            .where((F.col("n") > hot_row) | (F.col("cells") > hot_cells))
            .select("layer", "row")
        )
    if hot is None or hot.isEmpty():
        return last_wins(span_cells(pair_crossings(hits.repartition(width, "layer", "row"), carried)), variables)
    flagged = join_dimension(
        hits, hot.withColumn("hot", F.lit(True)), ["layer", "row"], how="left"
    )
    calm = flagged.where(F.col("hot").isNull()).drop("hot").repartition(width, "layer", "row")
    busy = flagged.where(F.col("hot")).drop("hot")
    return last_wins(span_cells(pair_crossings(calm, carried)), variables).unionByName(
        last_wins(span_cells(pair_crossings(busy, carried)), variables)
    )


def _present(features: DataFrame) -> list[str]:
    return ["rings", *[c for c in GRID_COLUMNS if c in features.columns]]


def split_spans(spans: DataFrame, tile: int) -> DataFrame:
    """Cut spans at tile borders and add the tile they lie in."""
    n = F.lit(int(tile)).cast("long")
    cut = spans.withColumn("tile_row", F.floor(F.col("row") / n)).withColumn(
        "tile_col", F.explode(F.sequence(F.floor(F.col("c0") / n), F.floor(F.col("c1") / n)))
    )
    return cut.withColumn("c0", F.greatest("c0", F.col("tile_col") * n)).withColumn(
        "c1", F.least("c1", F.col("tile_col") * n + n - 1)
    )


def tiled_cells(
    features: DataFrame,
    variables: list[str],
    tile: int,
    ascending: bool = False,
    hot_tile: int = HOT_TILE_SPANS,
    hot_cells: int = HOT_CELLS,
    geom_types: tuple[str, ...] = ("POLYGON",),
) -> DataFrame:
    """Burned cells partitioned by tile, so packing them needs no shuffle.

    ``ascending`` numbers rows, and so tiles, from the south.

    Spans are cut at tile borders and shuffled on their tile. They are written
    to the checkpoint folder first, and tiles with more than ``hot_tile`` spans
    or ``hot_cells`` filled cells are merged cell by cell with a partial
    aggregate instead.
    """
    tile_key = ["layer", "tile_row", "tile_col"]
    width = shuffle_partitions(features)
    needed = features.select(
        "layer", "fid", "geom_type", *variables, F.col("ny").alias("_ny"), *_present(features)
    )
    spans = _spans(needed, geom_types)
    if ascending:
        spans = spans.withColumn("row", F.col("_ny") - 1 - F.col("row"))
    spans = store(split_spans(spans.drop("_ny"), tile))
    hot = (
        spans.groupBy(*tile_key)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("c1") - F.col("c0") + 1).alias("cells"))
        .where((F.col("n") > hot_tile) | (F.col("cells") > hot_cells))
        .select(*tile_key)
    )

    def winners(s: DataFrame) -> DataFrame:
        return s.groupBy(*tile_key, "row", "col").agg(
            F.max("fid").alias("fid"), *[F.max_by(v, "fid").alias(v) for v in variables]
        )

    if hot.isEmpty():
        return winners(span_cells(spans.repartition(width, *tile_key)))
    flagged = join_dimension(spans, hot.withColumn("hot", F.lit(True)), tile_key, how="left")
    calm = flagged.where(F.col("hot").isNull()).drop("hot").repartition(width, *tile_key)
    busy = flagged.where(F.col("hot")).drop("hot")
    return winners(span_cells(calm)).unionByName(winners(span_cells(busy)))


def burn_points(features: DataFrame) -> DataFrame:
    """A point burns the cell it falls in; outside the grid it is dropped."""
    carried = _carried(features)
    return (
        features.withColumn("p", F.explode(G.vertices(F.col("rings"))))
        .withColumn("row", F.floor(pixel_y(F.col("p.y"))))
        .withColumn("col", F.floor(pixel_x(F.col("p.x"))))
        .where(_inside(F.col("row"), F.col("col")))
        .select(*carried, "row", "col")
    )


def _inside(row: Column, col: Column) -> Column:
    return (row >= 0) & (row < F.col("ny")) & (col >= 0) & (col < F.col("nx"))


def burn_lines(features: DataFrame) -> DataFrame:
    """Step along the longer axis of each segment, one cell per step.

    Step ``m`` samples the segment at the centre of cell ``m`` on that axis,
    clamped to the segment's ends.
    """
    carried = _carried(features)
    e = F.col("e")
    ends = (
        features.withColumn("e", F.explode(G.edges(F.col("rings"))))
        .withColumn("ax", pixel_x(e["a"]["x"]))
        .withColumn("ay", pixel_y(e["a"]["y"]))
        .withColumn("bx", pixel_x(e["b"]["x"]))
        .withColumn("by", pixel_y(e["b"]["y"]))
        .withColumn("wide", F.abs(F.col("bx") - F.col("ax")) >= F.abs(F.col("by") - F.col("ay")))
    )
    major = lambda p: F.when(F.col("wide"), F.col(p + "x")).otherwise(F.col(p + "y"))
    minor = lambda p: F.when(F.col("wide"), F.col(p + "y")).otherwise(F.col(p + "x"))
    forward = major("a") <= major("b")
    oriented = ends.select(
        *carried, "nx", "ny", "wide",
        F.when(forward, major("a")).otherwise(major("b")).alias("m0"),
        F.when(forward, major("b")).otherwise(major("a")).alias("m1"),
        F.when(forward, minor("a")).otherwise(minor("b")).alias("n0"),
        F.when(forward, minor("b")).otherwise(minor("a")).alias("n1"),
    )
    last = F.when(F.col("wide"), F.col("nx")).otherwise(F.col("ny")) - 1
    steps = (
        oriented.withColumn("from", F.greatest(F.lit(0).cast("long"), F.floor("m0")))
        .withColumn("to", F.least(last, F.floor("m1")))
        .where(F.col("to") >= F.col("from"))
        .withColumn("m", F.explode(F.sequence("from", "to")))
    )
    at = F.least(F.col("m1"), F.greatest(F.col("m0"), F.col("m") + F.lit(0.5)))
    slope = F.coalesce(F.try_divide(F.col("n1") - F.col("n0"), F.col("m1") - F.col("m0")), F.lit(0.0))
    n = F.floor(F.col("n0") + (at - F.col("m0")) * slope)
    return (
        steps.withColumn("n", n)
        .withColumn("row", F.when(F.col("wide"), F.col("n")).otherwise(F.col("m")))
        .withColumn("col", F.when(F.col("wide"), F.col("m")).otherwise(F.col("n")))
        .where(_inside(F.col("row"), F.col("col")))
        .select(*carried, "row", "col")
    )


def touched_spans(features: DataFrame) -> DataFrame:
    """Every cell that a line enters, as a span of columns for each segment and row.

    A segment is cut at the borders of the rows it passes; between two borders it runs
    from one column to another. Cells own their upper and left border, as for points, so
    neighbouring segments share the cell of their common vertex.
    """
    carried = _carried(features)
    e = F.col("e")
    ends = (
        features.withColumn("e", F.explode(G.edges(F.col("rings"))))
        .withColumn("a", F.struct(pixel_y(e["a"]["y"]).alias("y"), pixel_x(e["a"]["x"]).alias("x")))
        .withColumn("b", F.struct(pixel_y(e["b"]["y"]).alias("y"), pixel_x(e["b"]["x"]).alias("x")))
        .select(*carried, "nx", "ny", F.least("a", "b").alias("p"), F.greatest("a", "b").alias("q"))
    )
    y0, x0, y1, x1 = F.col("p.y"), F.col("p.x"), F.col("q.y"), F.col("q.x")
    slope = F.coalesce(F.try_divide(x1 - x0, y1 - y0), F.lit(0.0))
    rows = (
        ends.withColumn("from", F.greatest(F.lit(0).cast("long"), F.floor(y0)))
        .withColumn("to", F.least(F.col("ny") - 1, F.floor(y1)))
        .where(F.col("to") >= F.col("from"))
        .withColumn("row", F.explode(F.sequence("from", "to")))
    )
    top, bottom = F.col("row").cast("double"), (F.col("row") + 1).cast("double")
    enter = F.when(top <= y0, x0).otherwise(x0 + (top - y0) * slope)
    leave = F.when(bottom >= y1, x1).otherwise(x0 + (bottom - y0) * slope)
    return (
        rows.withColumn("c0", F.greatest(F.lit(0).cast("long"), F.floor(F.least(enter, leave))))
        .withColumn("c1", F.least(F.col("nx") - 1, F.floor(F.greatest(enter, leave))))
        .where(F.col("c1") >= F.col("c0"))
        .select(*carried, "row", "c0", "c1")
    )


def _spans(features: DataFrame, geom_types: tuple[str, ...]) -> DataFrame:
    """Spans of mixed geometry; points and lines burn spans of one cell."""
    one_cell = {"c0": F.col("col"), "c1": F.col("col")}
    parts = []
    for g in geom_types:
        some = features.where(F.col("geom_type") == g)
        if g == "POLYGON":
            parts.append(polygon_spans(some))
        else:
            burned = (burn_points if g == "POINT" else burn_lines)(some)
            parts.append(burned.withColumns(one_cell).drop("col"))
    spans = parts[0]
    for p in parts[1:]:
        spans = spans.unionByName(p)
    return spans


def geometry_types(features: DataFrame) -> tuple[str, ...]:
    """The (at most three) geometry types present."""
    known = ["POLYGON", "LINE", "POINT"]
    found = {r["geom_type"] for r in features.select("geom_type").where(F.col("geom_type").isin(known)).distinct().collect()}
    return tuple(g for g in known if g in found)


def last_of_equal(features: DataFrame) -> DataFrame:
    """Without the features of which a later one of their layer has the geometry: that
    one covers all their cells, so only the last can be seen."""
    every = F.struct(*[F.col(f"`{c}`") for c in features.columns])
    latest = features.groupBy("layer", "geom_type", G.shape_digest(F.col("rings")).alias("_shape")).agg(
        F.max_by(every, "fid").alias("_last")
    )
    return latest.select("_last.*")


def swept_cells(
    features: DataFrame,
    variables: list[str],
    geom_types: tuple[str, ...] = ("POLYGON",),
    part_columns: int = PART_COLUMNS,
) -> DataFrame:
    """Burned cells, last feature wins, each made once.

    The spans of all features are swept to disjoint ones before they become cells.
    Crossings are computed once and shuffled by feature and row; a row with very many
    spans is dealt out in parts, after every task has swept its own.
    """
    needed = features.select("layer", "fid", "geom_type", *variables, *_present(features))
    spans = cut_rows(_clipped(_spans(needed, geom_types)), part_columns)
    winners = winning_spans(spans.select("layer", "part", "row", "c0", "c1", "fid", *variables), ["layer", "part", "row"])
    return span_cells(winners.drop("part")).select("layer", "row", "col", "fid", *variables)


def swept_tiles(
    features: DataFrame,
    variables: list[str],
    tile: int,
    ascending: bool = False,
    geom_types: tuple[str, ...] = ("POLYGON",),
) -> DataFrame:
    """The same cells partitioned by tile, so packing them needs no shuffle.

    ``ascending`` numbers rows, and so tiles, from the south. Spans are shuffled on
    their tile, cells never.
    """
    tile_key = ["layer", "tile_row", "tile_col"]
    needed = features.select(
        "layer", "fid", "geom_type", *variables, F.col("ny").alias("_ny"), *_present(features)
    )
    spans = _clipped(_spans(needed, geom_types))
    if ascending:
        spans = spans.withColumn("row", F.col("_ny") - 1 - F.col("row"))
    spans = split_spans(spans.drop("_ny"), tile)
    winners = winning_spans(spans, [*tile_key, "row"], tile_key)
    # by tile once more: the sweep's own layout is not known to later steps
    placed = winners.repartition(shuffle_partitions(features), *tile_key)
    return span_cells(placed).select(*tile_key, "row", "col", "fid", *variables)


def _clipped(spans: DataFrame) -> DataFrame:
    return spans.where(F.col("c1") >= F.col("c0")).withColumns({n: F.col(n).cast("long") for n in ("row", "c0", "c1")})


def burn(features: DataFrame, variables: list[str], geom_types: list[str]) -> DataFrame:
    """Last-wins cells of a layer that may mix the named geometry types."""
    if "POLYGON" in geom_types:
        return swept_cells(features, variables, tuple(geom_types))
    parts = []
    for g in geom_types:
        burned = (burn_points if g == "POINT" else burn_lines)(features.where(F.col("geom_type") == g))
        parts.append(last_wins(burned, variables))
    if len(parts) == 1:
        return parts[0]
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.unionByName(p)
    return last_wins(merged, variables)


def last_wins(burns: DataFrame, variables: list[str]) -> DataFrame:
    """Keep, per cell, every variable of the feature with the highest fid.

    Values are numeric, so the aggregate is hash-based with a partial step
    before the shuffle: at most one row per cell leaves a task.
    """
    return burns.groupBy("layer", "row", "col").agg(
        F.max("fid").alias("fid"), *[F.max_by(v, "fid").alias(v) for v in variables]
    )
