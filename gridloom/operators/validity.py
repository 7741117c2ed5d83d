"""Which polygons can be burned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions import geometry as G
from gridloom.plans.joins import join_dimension

# Outlines of at most this many edges are checked pair by pair in their row.
ROW_EDGES = 256


def _rings_ok(rings: Column) -> Column:
    """Closed rings of at least four vertices with some area."""
    return F.coalesce(
        (F.size(rings) > 0)
        & F.forall(
            rings,
            lambda r: (F.size(r) >= 4)
            & (F.element_at(r, 1) == F.element_at(r, -1))
            & (G.signed_area2(r) != 0),
        ),
        F.lit(False),
    )


def valid_geometries(features: DataFrame, row_edges: int = ROW_EDGES) -> DataFrame:
    """Drop polygons with open, tiny, flat or self-crossing rings.

    Small outlines are tested within their row. Larger ones are cut into
    square cells sized so that an average edge touches few of them, and only
    edges meeting in a cell are compared.
    """
    rings = F.col("rings")
    polygon = F.col("geom_type") == "POLYGON"
    small = G.vertex_count(features.columns) <= row_edges
    # bound as one lambda variable, so that the edges are built once per row;
    # each edge is compared only with the later ones
    crosses = F.exists(
        F.array(G.edges(rings)),
        lambda es: F.exists(
            F.sequence(F.lit(0), F.size(es) - 1),
            lambda i: F.exists(F.slice(es, i + 2, F.size(es)), lambda f: G.segments_cross(es[i], f)),
        ),
    )
    sound = features.where(~polygon | _rings_ok(rings))
    easy = sound.where(~polygon | (small & ~crosses))
    large = sound.where(polygon & ~small)
    bad = _large_self_crossing(large)
    return easy.unionByName(join_dimension(large, bad, ["layer", "fid"], how="left_anti"))


def _large_self_crossing(large: DataFrame) -> DataFrame:
    """Keys of large outlines with two crossing edges."""
    rings = F.col("rings")
    split = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(G.vertices(rings)) / F.lit(4.0))))
    extent = lambda lo, hi: F.when(hi > lo, (hi - lo) / split).otherwise(F.lit(1.0))
    parts = large.select(
        "layer", "fid",
        G.x_min(rings).alias("ox"),
        G.y_min(rings).alias("oy"),
        extent(G.x_min(rings), G.x_max(rings)).alias("sx"),
        extent(G.y_min(rings), G.y_max(rings)).alias("sy"),
        F.posexplode(G.edges(rings)).alias("i", "e"),
    )
    e = F.col("e")
    cut = lambda v, o, s: F.floor((v - F.col(o)) / F.col(s))
    celled = (
        parts.withColumn("gx", F.explode(F.sequence(
            cut(F.least(e["a"]["x"], e["b"]["x"]), "ox", "sx"),
            cut(F.greatest(e["a"]["x"], e["b"]["x"]), "ox", "sx"))))
        .withColumn("gy", F.explode(F.sequence(
            cut(F.least(e["a"]["y"], e["b"]["y"]), "oy", "sy"),
            cut(F.greatest(e["a"]["y"], e["b"]["y"]), "oy", "sy"))))
        .select("layer", "fid", "gx", "gy", "i", "e")
    )
    other = celled.select("layer", "fid", "gx", "gy", F.col("i").alias("j"), F.col("e").alias("f"))
    crossing = celled.join(other, ["layer", "fid", "gx", "gy"]).where(
        (F.col("i") < F.col("j")) & G.segments_cross(F.col("e"), F.col("f"))
    )
    return crossing.select("layer", "fid").distinct()
