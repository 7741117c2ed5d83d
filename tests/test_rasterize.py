import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.operators import align, grid, rasterize
from gridloom.operators.grid import RasterGrid
from tests.helpers import features, on_grid, ring, rows_of, square

TEN = RasterGrid(0, 0, 10, 10, 10, 10)


def burned(spark, rows, g=TEN):
    return rasterize.burn_polygons(on_grid(features(spark, rows), g))


def inside(rings, x, y):
    odd = False
    for r in rings:
        for a, b in zip(r, r[1:]):
            lo, hi = (a, b) if a["y"] <= b["y"] else (b, a)
            if lo["y"] <= y < hi["y"]:
                if lo["x"] + (y - lo["y"]) * (hi["x"] - lo["x"]) / (hi["y"] - lo["y"]) <= x:
                    odd = not odd
    return odd


def test_square_burns_its_cells(spark):
    got = rows_of(burned(spark, [(1, [square(2, 3, 2)])]), "row", "col")
    # y 3..5 is rows 5 and 6 counted from the north
    assert got == [(5, 2), (5, 3), (6, 2), (6, 3)]


def test_hole_is_left_out(spark):
    got = rows_of(burned(spark, [(1, [square(1, 1, 5), square(2, 2, 3)])]), "row", "col")
    assert len(got) == 25 - 9
    assert (6, 3) not in got


def test_multipart_needs_no_nesting(spark):
    got = rows_of(burned(spark, [(1, [square(0, 0, 1), square(5, 5, 1)])]), "row", "col")
    assert got == [(4, 5), (9, 0)]


def test_zero_area_and_subcell_shapes_burn_nothing(spark):
    flat = ring((1, 1), (5, 1), (3, 1), (1, 1))
    sliver = ring((1, 1), (5, 5), (1, 1))
    tiny = square(2.6, 2.6, 0.1)
    assert burned(spark, [(1, [flat]), (2, [sliver]), (3, [tiny])]).count() == 0


def test_outside_the_grid_is_clipped(spark):
    got = rows_of(burned(spark, [(1, [square(-5, -5, 7)]), (2, [square(20, 20, 3)])]), "fid", "row", "col")
    assert got == [(1, 8, 0), (1, 8, 1), (1, 9, 0), (1, 9, 1)]


def test_shared_edges_burn_each_cell_once(spark):
    rng = random.Random(5)
    rows = []
    for k in range(40):
        x, y, w = rng.uniform(0, 8), rng.uniform(0, 8), rng.uniform(0.3, 2)
        px, py = x + rng.uniform(0, w), y + rng.uniform(0, w)
        corners = [(x, y), (x + w, y), (x + w, y + w), (x, y + w)]
        # four triangles around an inner point share all their edges
        for i in range(4):
            a, b = corners[i], corners[(i + 1) % 4]
            rows.append((4 * k + i, [ring(a, b, (px, py), a)], "POLYGON", f"p{k}"))
        rows.append((1000 + k, [square(x, y, w)], "POLYGON", f"s{k}"))
    g = RasterGrid(0, 0, 10, 10, 300, 300)
    cells = burned(spark, rows, g)
    parts = cells.where("layer like 'p%'").withColumn("k", F.substring("layer", 2, 9))
    assert parts.groupBy("k", "row", "col").count().where("count > 1").count() == 0
    whole = cells.where("layer like 's%'").withColumn("k", F.substring("layer", 2, 9))
    a, b = parts.select("k", "row", "col"), whole.select("k", "row", "col")
    assert a.exceptAll(b).count() == 0
    # a square is not a union of the same floats, so only its border may differ
    assert b.exceptAll(a).count() == 0


def test_equals_point_in_polygon(spark):
    rng = random.Random(3)
    shapes = []
    for fid in range(30):
        n = rng.randint(3, 9)
        pts = [(rng.uniform(0, 10), rng.uniform(0, 10)) for _ in range(n)]
        shapes.append((fid, [ring(*pts, pts[0])]))
    g = RasterGrid(0, 0, 10, 10, 37, 41)
    got = set(rows_of(burned(spark, shapes, g), "fid", "row", "col"))
    want = set()
    for fid, rings in shapes:
        px = [[{"x": (p["x"] - 0) / g.dx, "y": (10 - p["y"]) / g.dy} for p in r] for r in rings]
        for r in range(g.ny):
            for c in range(g.nx):
                if inside(px, c + 0.5, r + 0.5):
                    want.add((fid, r, c))
    assert got == want


def many(spark, n=300, seed=1):
    rng = random.Random(seed)
    rows = []
    for fid in range(n):
        x, y, w = rng.uniform(0, 9), rng.uniform(0, 9), rng.uniform(0.1, 1.5)
        rows.append((fid, [ring((x, y), (x + w, y + w / 3), (x + w / 4, y + w), (x, y))], "POLYGON", f"l{fid % 2}"))
    return on_grid(features(spark, rows), RasterGrid(0, 0, 10, 10, 200, 200))


def test_last_feature_wins(spark):
    got = rasterize.polygon_cells(many(spark), ["value"]).collect()
    burns = rasterize.burn_polygons(many(spark)).groupBy("layer", "row", "col").agg(F.max("fid").alias("f")).collect()
    assert {(r.layer, r.row, r.col): r.fid for r in got} == {(r.layer, r.row, r.col): r.f for r in burns}
    assert all(r.value == r.fid for r in got)


@pytest.mark.parametrize("hot", [0, 5, 40])
def test_hot_rows_take_another_way_to_the_same_cells(spark, hot):
    g = many(spark)
    names = ("layer", "row", "col", "fid", "value")
    assert rows_of(rasterize.polygon_cells(g, ["value"], hot_row=hot), *names) == rows_of(
        rasterize.polygon_cells(g, ["value"]), *names
    )


@pytest.mark.parametrize("hot_cells", [0, 60, 300])
def test_rows_and_tiles_hot_by_cells(spark, hot_cells):
    g = many(spark)
    names = ("layer", "row", "col", "fid", "value")
    want = rows_of(rasterize.polygon_cells(g, ["value"]), *names)
    assert rows_of(rasterize.polygon_cells(g, ["value"], hot_cells=hot_cells), *names) == want
    assert rows_of(rasterize.tiled_cells(g, ["value"], 40, hot_cells=hot_cells), *names) == want


@pytest.mark.parametrize("tile,hot", [(7, 10**9), (64, 10**9), (500, 10**9), (32, 5), (32, 0)])
def test_tiled_equals_untiled(spark, tile, hot):
    g = many(spark)
    names = ("layer", "row", "col", "fid", "value")
    tiled = rasterize.tiled_cells(g, ["value"], tile, hot_tile=hot)
    assert rows_of(tiled, *names) == rows_of(rasterize.polygon_cells(g, ["value"]), *names)
    assert tiled.where("floor(row / %d) <> tile_row or floor(col / %d) <> tile_col" % (tile, tile)).count() == 0


def test_points_on_the_far_edges_are_dropped(spark):
    rows = [(1, [ring((0, 10))], "POINT"), (2, [ring((10, 5))], "POINT"), (3, [ring((5, 0))], "POINT"),
            (4, [ring((9.99, 0.01))], "POINT"), (5, [ring((1, 1), (2, 2))], "POINT")]
    got = rasterize.burn_points(on_grid(features(spark, rows), TEN))
    assert rows_of(got, "fid", "row", "col") == [(1, 0, 0), (4, 9, 9), (5, 8, 2), (5, 9, 1)]


def test_lines_step_along_the_longer_axis(spark):
    rows = [(1, [ring((0.5, 9.5), (3.5, 9.5))], "LINE"), (2, [ring((0.5, 9.5), (0.6, 6.5))], "LINE"),
            (3, [ring((0.5, 0.5), (2.5, 2.5))], "LINE"), (4, [ring((5, 5), (5, 5))], "LINE")]
    got = rows_of(rasterize.burn_lines(on_grid(features(spark, rows), TEN)), "fid", "row", "col")
    assert [r for r in got if r[0] == 1] == [(1, 0, c) for c in range(4)]
    assert [r for r in got if r[0] == 2] == [(2, r, 0) for r in range(4)]
    assert [r for r in got if r[0] == 3] == [(3, 7, 2), (3, 8, 1), (3, 9, 0)]
    assert [r for r in got if r[0] == 4] == [(4, 5, 5)]


def test_mixed_geometry_keeps_the_last_feature(spark):
    rows = [(1, [square(0, 0, 4)]), (2, [ring((1.5, 1.5))], "POINT"), (3, [ring((0.5, 0.5), (2.5, 0.5))], "LINE")]
    got = rasterize.burn(on_grid(features(spark, rows), TEN), ["value"], ["POLYGON", "POINT", "LINE"])
    by_cell = {(r.row, r.col): r.value for r in got.collect()}
    assert by_cell[(8, 1)] == 2.0 and by_cell[(9, 0)] == 3.0 and by_cell[(6, 3)] == 1.0
    assert len(by_cell) == 16


@pytest.mark.parametrize("hot", [0, 10**9])
def test_mixed_geometry_tiled(spark, hot):
    rows = [(1, [square(0, 0, 4)]), (2, [ring((1.5, 1.5))], "POINT"), (3, [ring((0.5, 0.5), (9.5, 8.5))], "LINE")]
    g = on_grid(features(spark, rows), TEN)
    types = rasterize.geometry_types(g)
    assert types == ("POLYGON", "LINE", "POINT")
    names = ("row", "col", "fid", "value")
    tiled = rasterize.tiled_cells(g, ["value"], 3, hot_tile=hot, geom_types=types)
    assert rows_of(tiled, *names) == rows_of(rasterize.burn(g, ["value"], list(types)), *names)


def test_nan_value_is_burned(spark):
    rows = [(1, [square(0, 0, 2)], "POLYGON", "a", 5.0), (2, [square(0, 0, 1)], "POLYGON", "a", float("nan"))]
    got = {(r.row, r.col): r.value for r in rasterize.polygon_cells(on_grid(features(spark, rows), TEN), ["value"]).collect()}
    assert np.isnan(got[(9, 0)]) and got[(8, 1)] == 5.0


def test_single_point_layer_gets_one_cell(spark):
    pts = features(spark, [(1, [ring((3, 4))], "POINT")])
    spec = grid.grid_spec(grid.layer_bounds(pts), 0.01).first()
    assert (spec.nx, spec.ny, spec.dx, spec.dy) == (1, 1, 0.01, 0.01)


def test_polygon_cells_shuffle_once(spark):
    plan = rasterize.polygon_cells(many(spark), ["value"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_packing_tiled_cells_needs_no_shuffle(spark):
    tiled = rasterize.tiled_cells(many(spark), ["value"], 50)
    packed = align.pack_chunks(tiled, ["value"], 50, placed=True)
    plan = packed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_lines_enter_every_cell_they_touch(spark):
    lines = [((0.5, 9.5), (2.5, 8.2)), ((5.5, 9.5), (5.9, 6.5)), ((3.5, 9.5), (0.5, 9.5)), ((5, 5), (5, 5)),
             ((-2, 9.5), (1.5, 9.5)), ((20, 1), (30, 2)), ((1.5, 8.5), (1.5, 8.5), (3.5, 8.5))]
    rows = [(i, [ring(*line)], "LINE") for i, line in enumerate(lines, 1)]
    got = rows_of(rasterize.touched_spans(on_grid(features(spark, rows), TEN)), "fid", "row", "c0", "c1")
    assert [r for r in got if r[0] < 7] == [
        (1, 0, 0, 1), (1, 1, 1, 2), *[(2, r, 5, 5) for r in range(4)], (3, 0, 0, 3), (4, 5, 5, 5), (5, 0, 0, 1)
    ]
    assert {r for r in got if r[0] == 7} == {(7, 1, 1, 1), (7, 1, 1, 3)}
