"""Zones against features and cells, and the majority inside a zone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.functions import geometry as G
from gridloom.functions import values as V
from gridloom.operators.grid import RasterGrid, on_raster
from gridloom.operators.rasterize import polygon_spans, span_cells
from gridloom.plans.joins import BROADCAST_BYTES, join_dimension, join_skewed, measured_bytes, settle, store


def circle_zones(zones: DataFrame, quarter_segments: int = 16) -> DataFrame:
    """Zones ``(zone_id, cx, cy, radius)`` with a polygon outline."""
    return zones.withColumn(
        "rings", G.circle_rings(F.col("cx"), F.col("cy"), F.col("radius"), quarter_segments)
    )


def features_in_circle(
    zones: DataFrame,
    features: DataFrame,
    bucket: float | None = None,
    same: tuple[str, ...] = (),
    broadcast_bytes: int = BROADCAST_BYTES,
    quarter_segments: int | None = None,
) -> DataFrame:
    """Pairs of a zone and a feature its disc meets; ``same`` names columns the
    two must share. With ``quarter_segments`` the disc is a polygon with that
    many sides per quarter, as buffering libraries make it (16 is usual).

    ``bucket`` is the side of the squares boxes are matched in, by default twice
    the largest radius. Equal discs and equal shapes are compared once, see
    :func:`_touching`; zones and features come in where the pairs are made.
    """
    touching = _touching(zones, features, bucket, same, broadcast_bytes, quarter_segments)
    skip = {"rings", "layer", *G.BOX_COLUMNS, G.SIZE_COLUMN, *zones.columns}
    keep = [c for c in features.columns if c not in skip]
    members = _shaped(features).select("layer", *keep, SHAPE)
    met = join_dimension(members, touching, [SHAPE, *same], settled=True, broadcast_bytes=broadcast_bytes)
    pairs = join_dimension(met, zones, [*DISC, *same], broadcast_bytes=broadcast_bytes)
    return pairs.select(*[c for c in zones.columns if c != "layer"], "layer", *keep)


def majority_in_circle(
    zones: DataFrame,
    features: DataFrame,
    group: list[str],
    value: str,
    nodata: float | None = None,
    bucket: float | None = None,
    same: tuple[str, ...] = (),
    broadcast_bytes: int = BROADCAST_BYTES,
    quarter_segments: int | None = None,
) -> DataFrame:
    """:func:`majority` of the features that each zone's disc meets, without the pairs:
    values are counted by shape, then by disc. ``group`` names columns of ``zones``."""
    touching = _touching(zones, features, bucket, same, broadcast_bytes, quarter_segments)
    valued = _valued(_shaped(features), value, nodata)
    total = lambda df, keys: df.groupBy(*keys, "value").agg(F.sum("n").alias("n"))
    by_shape = total(valued.select(SHAPE, *same, F.col(value).alias("value"), F.lit(1).cast("long").alias("n")), [SHAPE, *same])
    met = join_dimension(by_shape, touching, [SHAPE, *same], settled=True, broadcast_bytes=broadcast_bytes, spread="value")
    by_disc = total(met, [*DISC, *same])
    places = zones.select(*dict.fromkeys([*group, *DISC, *same]))
    counts = join_dimension(by_disc, places, [*DISC, *same], broadcast_bytes=broadcast_bytes, spread="value")
    return most_frequent(total(counts, group), group)


DISC = ["cx", "cy", "radius"]
SHAPE = "_shape"


def _shaped(features: DataFrame) -> DataFrame:
    return features.withColumn(SHAPE, G.shape_digest(F.col("rings")))


def _touching(
    zones: DataFrame,
    features: DataFrame,
    bucket: float | None,
    same: tuple[str, ...],
    broadcast_bytes: int,
    quarter_segments: int | None,
) -> DataFrame:
    """Digest of a shape and a disc that meets it, for all distinct ones.

    Boxes are matched first, without geometry; then the few candidate pairs meet the
    rings of the first feature of each shape, which are read once and copied only for
    actual candidates.
    """
    if "layer" in zones.columns and "layer" not in same:
        raise ValueError("zones with a layer need same=('layer',)")
    if bucket is None:
        widest = zones.agg(F.max("radius").alias("r")).first()["r"]
        bucket = 2.0 * widest if widest else 1.0
    discs = settle(zones.select(*DISC, *same).distinct())
    boxes = {f"_{n}": F.min(c) for n, c in zip(G.BOX_COLUMNS, G.box_of(features.columns))}
    first = F.min(F.struct("layer", "fid")).alias("_first")
    shapes = _shaped(features).groupBy(SHAPE, *same).agg(first, *[c.alias(n) for n, c in boxes.items()])
    shapes = shapes.select("_first.layer", "_first.fid", *[F.col(n).alias(n[1:]) for n in boxes])
    pairs = store(_box_pairs(discs, shapes, bucket, same, broadcast_bytes))
    key = ["layer", "fid"]
    wanted = features.select(*key, "rings")
    if measured_bytes(pairs) <= broadcast_bytes:
        matched = wanted.join(F.broadcast(pairs), key)
    else:
        matched = join_skewed(pairs, wanted, key, spread="cx")
    disc = [F.col(c) for c in DISC]
    if quarter_segments is None:
        touch = G.disc_intersects(F.col("rings"), *disc)
    else:
        touch = G.polygons_intersect(F.col("rings"), G.circle_rings(*disc, quarter_segments))
    return store(_shaped(matched.where(touch)).select(SHAPE, *same, *DISC))


def _box_pairs(
    zones: DataFrame, features: DataFrame, bucket: float, same: tuple[str, ...], broadcast_bytes: int
) -> DataFrame:
    """Zone and feature key wherever the boxes meet.

    Both sides get the square buckets their boxes overlap. A pair sharing
    several buckets is kept only in the one holding the lower left corner of
    the boxes' overlap, so none repeats. Few zones are broadcast.
    """
    b = F.lit(float(bucket))
    cut = lambda v: F.floor(v / b)
    x0, y0, x1, y1 = G.box_of(features.columns)
    boxed = (
        features.select("layer", "fid", x0.alias("_x0"), y0.alias("_y0"), x1.alias("_x1"), y1.alias("_y1"))
        .withColumn("_bx", F.explode(F.sequence(cut(F.col("_x0")), cut(F.col("_x1")))))
        .withColumn("_by", F.explode(F.sequence(cut(F.col("_y0")), cut(F.col("_y1")))))
    )
    discs = (
        zones.withColumn("_zx0", F.col("cx") - F.col("radius"))
        .withColumn("_zy0", F.col("cy") - F.col("radius"))
        .withColumn("_zx1", F.col("cx") + F.col("radius"))
        .withColumn("_zy1", F.col("cy") + F.col("radius"))
        .withColumn("_bx", F.explode(F.sequence(cut(F.col("_zx0")), cut(F.col("_zx1")))))
        .withColumn("_by", F.explode(F.sequence(cut(F.col("_zy0")), cut(F.col("_zy1")))))
    )
    on = ["_bx", "_by", *same]
    if measured_bytes(discs) <= broadcast_bytes:
        joined = boxed.join(F.broadcast(discs), on)
    else:
        joined = join_skewed(boxed, discs, on)
    met = joined.where(
        (F.col("_x0") <= F.col("_zx1"))
        & (F.col("_zx0") <= F.col("_x1"))
        & (F.col("_y0") <= F.col("_zy1"))
        & (F.col("_zy0") <= F.col("_y1"))
        & (F.col("_bx") == cut(F.greatest("_x0", "_zx0")))
        & (F.col("_by") == cut(F.greatest("_y0", "_zy0")))
    )
    return met.select("layer", "fid", *[c for c in zones.columns if c != "layer"])


def cells_in_zone(zones: DataFrame, cells: DataFrame, grid: RasterGrid) -> DataFrame:
    """Cells whose centre lies in each zone (``zone_id``, ``rings``)."""
    placed = on_raster(zones.select(F.lit("zones").alias("layer"), F.col("zone_id").alias("fid"), "rings"), grid)
    covered = span_cells(polygon_spans(placed)).select(F.col("fid").alias("zone_id"), "row", "col")
    target = cells.withColumn("row", F.col("row").cast("long")).withColumn("col", F.col("col").cast("long"))
    return join_skewed(covered, target, ["row", "col"], spread="zone_id")


def majority(df: DataFrame, group: list[str], value: str, nodata: float | None = None) -> DataFrame:
    """Most frequent value per group, the smallest on ties; missing values and
    ``nodata`` are left out.

    Counted per (group, value) first, so a group with many members costs one
    record per distinct value.
    """
    counted = _valued(df, value, nodata).groupBy(*group, F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return most_frequent(counted, group)


def _valued(df: DataFrame, value: str, nodata: float | None) -> DataFrame:
    v = F.col(value)
    floating = isinstance(df.schema[value].dataType, (T.FloatType, T.DoubleType))
    kept = df.where(V.has_value(v) if floating else v.isNotNull())
    return kept if nodata is None else kept.where(v != F.lit(nodata))


def most_frequent(counts: DataFrame, group: list[str], nodata: float | None = None) -> DataFrame:
    """``*group, majority, n`` from ``*group, value, n``: the value that occurs most
    often, the smallest of those; ``nodata`` is left out."""
    if nodata is not None:
        counts = counts.where(F.col("value") != F.lit(nodata))
    best = F.min(F.struct((-F.col("n")).alias("_m"), F.col("value"), F.col("n")))
    return counts.groupBy(*group).agg(best.alias("_b")).select(
        *group, F.col("_b.value").alias("majority"), F.col("_b.n").alias("n")
    )
