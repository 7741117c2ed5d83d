"""Column expressions over ring geometry.

A geometry is ``rings ARRAY<ARRAY<STRUCT<x DOUBLE, y DOUBLE>>>``: one array per
ring or part, polygon rings closed (first vertex repeated at the end).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

RINGS_TYPE = "array<array<struct<x:double,y:double>>>"


def vertex(x: Column | float, y: Column | float) -> Column:
    as_col = lambda v: v if isinstance(v, Column) else F.lit(float(v))
    return F.struct(as_col(x).alias("x"), as_col(y).alias("y"))


def box_rings(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Closed four-corner ring, counter-clockwise."""
    return F.array(
        F.array(vertex(x0, y0), vertex(x1, y0), vertex(x1, y1), vertex(x0, y1), vertex(x0, y0))
    )


def vertices(rings: Column) -> Column:
    return F.flatten(rings)


def x_min(rings: Column) -> Column:
    return F.array_min(vertices(rings)["x"])


def x_max(rings: Column) -> Column:
    return F.array_max(vertices(rings)["x"])


def y_min(rings: Column) -> Column:
    return F.array_min(vertices(rings)["y"])


def y_max(rings: Column) -> Column:
    return F.array_max(vertices(rings)["y"])


BOX_COLUMNS = ("xmin", "ymin", "xmax", "ymax")


def box_of(columns: list[str]) -> tuple[Column, Column, Column, Column]:
    """A feature's box: its stored columns if it has them, else from its rings."""
    if all(c in columns for c in BOX_COLUMNS):
        return tuple(F.col(c) for c in BOX_COLUMNS)
    r = F.col("rings")
    return x_min(r), y_min(r), x_max(r), y_max(r)


SIZE_COLUMN = "n_vertices"


def vertex_count(columns: list[str]) -> Column:
    """Number of vertices: the stored column if there is one, else counted."""
    return F.col(SIZE_COLUMN) if SIZE_COLUMN in columns else F.size(vertices(F.col("rings")))


def shape_digest(rings: Column) -> Column:
    """128 bits that tell geometries apart, by vertices and by how many a ring has."""
    cut = F.transform(rings, F.size)
    return F.struct(F.xxhash64(rings, cut).alias("a"), F.xxhash64(F.lit(1), rings, cut).alias("b"))


def edges(rings: Column) -> Column:
    """All consecutive vertex pairs of every ring as ``ARRAY<STRUCT<a, b>>``."""
    drawable = F.filter(rings, lambda r: F.size(r) >= 2)
    return F.flatten(
        F.transform(
            drawable,
            lambda r: F.arrays_zip(
                F.slice(r, 1, F.size(r) - 1).alias("a"),
                F.slice(r, 2, F.size(r) - 1).alias("b"),
            ),
        )
    )


def signed_area2(ring: Column) -> Column:
    """Twice the signed shoelace area of one closed ring, relative to its first
    vertex so that a flat axis-parallel ring gives exactly zero."""
    o = F.element_at(ring, 1)
    pairs = F.arrays_zip(
        F.slice(ring, 1, F.size(ring) - 1).alias("a"),
        F.slice(ring, 2, F.size(ring) - 1).alias("b"),
    )
    term = lambda e: (e["a"]["x"] - o["x"]) * (e["b"]["y"] - o["y"]) - (e["b"]["x"] - o["x"]) * (
        e["a"]["y"] - o["y"]
    )
    return F.aggregate(pairs, F.lit(0.0), lambda s, e: s + term(e))


def segment_distance2(px: Column, py: Column, edge: Column) -> Column:
    """Squared distance of a point from a segment ``STRUCT<a, b>``."""
    ax, ay = edge["a"]["x"], edge["a"]["y"]
    vx, vy = edge["b"]["x"] - ax, edge["b"]["y"] - ay
    length2 = vx * vx + vy * vy
    along = F.coalesce(F.try_divide((px - ax) * vx + (py - ay) * vy, length2), F.lit(0.0))
    t = F.least(F.lit(1.0), F.greatest(F.lit(0.0), along))
    ex, ey = px - (ax + t * vx), py - (ay + t * vy)
    return ex * ex + ey * ey


def crosses_ray(px: Column, py: Column, edge: Column) -> Column:
    """True if the edge crosses the horizontal ray from the point to the west.

    Edges are half-open in y and oriented low to high, so a shared edge gives
    the same crossing for both neighbours.
    """
    up = edge["a"]["y"] <= edge["b"]["y"]
    lx, ly = F.when(up, edge["a"]["x"]).otherwise(edge["b"]["x"]), F.least(edge["a"]["y"], edge["b"]["y"])
    hx, hy = F.when(up, edge["b"]["x"]).otherwise(edge["a"]["x"]), F.greatest(edge["a"]["y"], edge["b"]["y"])
    spans = (ly <= py) & (py < hy)
    return spans & (F.coalesce(F.try_divide((py - ly) * (hx - lx), hy - ly), F.lit(0.0)) + lx <= px)


def contains_point(rings: Column, px: Column, py: Column) -> Column:
    """Even-odd containment over all rings, so holes need no special case."""
    return F.size(F.filter(edges(rings), lambda e: crosses_ray(px, py, e))) % 2 == 1


def disc_intersects(rings: Column, px: Column, py: Column, radius: Column) -> Column:
    """True if the closed disc touches the geometry's edges or lies inside it."""
    near = F.exists(edges(rings), lambda e: segment_distance2(px, py, e) <= radius * radius)
    single = F.exists(
        vertices(rings),
        lambda p: (p["x"] - px) * (p["x"] - px) + (p["y"] - py) * (p["y"] - py) <= radius * radius,
    )
    return near | single | contains_point(rings, px, py)


def segments_touch(e: Column, f: Column) -> Column:
    """True if two closed segments share a point."""
    a, b, c, d = e["a"], e["b"], f["a"], f["b"]
    d1, d2, d3, d4 = _cross(c, d, a), _cross(c, d, b), _cross(a, b, c), _cross(a, b, d)
    apart = lambda u, v: ((u > 0) & (v > 0)) | ((u < 0) & (v < 0))
    over = lambda k: (F.least(a[k], b[k]) <= F.greatest(c[k], d[k])) & (
        F.least(c[k], d[k]) <= F.greatest(a[k], b[k])
    )
    # on one line, boxes decide; otherwise both must reach the other's line
    return over("x") & over("y") & ~apart(d1, d2) & ~apart(d3, d4)


def polygons_intersect(rings: Column, outline: Column) -> Column:
    """True if a geometry meets the polygon ``outline`` (rings)."""
    touch = F.exists(
        F.array(edges(rings)),
        lambda es: F.exists(edges(outline), lambda f: F.exists(es, lambda e: segments_touch(e, f))),
    )
    held = F.exists(vertices(rings), lambda p: contains_point(outline, p["x"], p["y"]))
    corner = F.element_at(vertices(outline), 1)
    return touch | held | contains_point(rings, corner["x"], corner["y"])


def _cross(o: Column, p: Column, q: Column) -> Column:
    return (p["x"] - o["x"]) * (q["y"] - o["y"]) - (p["y"] - o["y"]) * (q["x"] - o["x"])


def segments_cross(e: Column, f: Column) -> Column:
    """True if two segments cross in their interiors."""
    d1, d2 = _cross(e["a"], e["b"], f["a"]), _cross(e["a"], e["b"], f["b"])
    d3, d4 = _cross(f["a"], f["b"], e["a"]), _cross(f["a"], f["b"], e["b"])
    opposite = lambda p, q: ((p > 0) & (q < 0)) | ((p < 0) & (q > 0))
    return opposite(d1, d2) & opposite(d3, d4)


def circle_rings(cx: Column, cy: Column, radius: Column, quarter_segments: int = 16) -> Column:
    """Closed polygon approximating a disc, clockwise from the eastern vertex."""
    n = 4 * quarter_segments
    ring = F.transform(
        F.sequence(F.lit(0), F.lit(n)),
        lambda i: F.struct(
            (cx + radius * F.cos((i % n) * F.lit(2 * math.pi / n))).alias("x"),
            (cy - radius * F.sin((i % n) * F.lit(2 * math.pi / n))).alias("y"),
        ),
    )
    return F.array(ring)
