import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridloom.operators import align, encode, grid, tiles, validity, zonal
from gridloom.operators.grid import RasterGrid
from gridloom.plans import check
from gridloom.plans import metadata as M
from tests.helpers import exploded_plan, features, on_grid, ring, rows_of, square


def spec_of(spark, g, layer="a"):
    return spark.range(1).select(F.lit(layer).alias("layer")).withColumns(g.columns())


def test_densify_fills_every_gap(spark):
    g = RasterGrid(0, 0, 5, 4, 5, 4)
    cells = spark.createDataFrame([("a", 0, 0, 1.0), ("a", 0, 4, 2.0), ("a", 2, 1, float("nan")), ("a", 2, 2, 0.0)], "layer string, row int, col int, v double")
    dense = align.densify(cells, spec_of(spark, g), ["v"])
    got = {(r.row, r.col): r.v for r in dense.collect()}
    assert dense.count() == 20 and len(got) == 20
    assert got[(0, 0)] == 1.0 and got[(0, 4)] == 2.0 and np.isnan(got[(2, 1)]) and got[(3, 3)] == 0.0
    assert align.densify(cells.where("false"), spec_of(spark, g), ["v"]).where("v = 0").count() == 20


def test_merge_outer_as_in_pandas(spark):
    a = pd.DataFrame({"latitude": [0.0, 0.0, 1.0], "longitude": [5.0, 6.0, 5.0], "u": [1.0, 2.0, np.nan]})
    b = pd.DataFrame({"latitude": [1.0, 2.0], "longitude": [6.0, 7.0], "u": [9.0, 9.0], "w": [3.0, 4.0]})
    merged = align.merge_outer([spark.createDataFrame(a), spark.createDataFrame(b)])
    got = {(r.latitude, r.longitude): (r.u, r.w) for r in merged.collect()}
    assert len(got) == 9
    assert got[(0.0, 6.0)][0] == 2.0 and np.isnan(got[(1.0, 6.0)][0])  # first dataset wins, gaps included
    assert got[(1.0, 6.0)][1] == 3.0 and np.isnan(got[(2.0, 5.0)][1])
    assert "CartesianProduct" not in exploded_plan(merged)


def test_merge_outer_keeps_cells_that_share_rounded_labels(spark):
    nan = float("nan")
    a = pd.DataFrame({"latitude": [0.0, 0.0, 0.0, 1.0], "longitude": [5.0, 5.0, 6.0, 6.0], "u": [1.0, 2.0, 2.0, nan]})
    b = pd.DataFrame({"latitude": [0.0, 0.0, 0.0], "longitude": [5.0, 5.0, 7.0], "w": [3.0, 4.0, nan]})
    got = align.merge_outer([spark.createDataFrame(a), spark.createDataFrame(b)]).toPandas()
    axes = pd.MultiIndex.from_product([[0.0, 1.0], [5.0, 6.0, 7.0]], names=["latitude", "longitude"]).to_frame(index=False)
    want = axes.merge(a, how="left").merge(b, how="left")
    order = ["latitude", "longitude", "u", "w"]
    assert len(got) == 9
    assert got[order].sort_values(order).reset_index(drop=True).equals(want[order].sort_values(order).reset_index(drop=True))


def touches(rings, x0, y0, x1, y1):
    """Closed box against a polygon, by clipping each edge and a corner test."""
    from tests.test_rasterize import inside

    for r in rings:
        for a, b in zip(r, r[1:]):
            t0, t1, ok = 0.0, 1.0, True
            dx, dy = b["x"] - a["x"], b["y"] - a["y"]
            for p, q in ((-dx, a["x"] - x0), (dx, x1 - a["x"]), (-dy, a["y"] - y0), (dy, y1 - a["y"])):
                if p == 0:
                    ok &= q >= 0
                elif p < 0:
                    t0 = max(t0, q / p)
                else:
                    t1 = min(t1, q / p)
            if ok and t0 <= t1:
                return True
    return inside(rings, (x0 + x1) / 2, (y0 + y1) / 2)


def test_tile_pairs_equal_brute_force(spark):
    rng = random.Random(8)
    rows = []
    for fid in range(60):
        n = rng.randint(3, 6)
        cx, cy, s = rng.uniform(0, 40), rng.uniform(0, 40), rng.choice([0.5, 4, 30])
        pts = [(cx + rng.uniform(0, s), cy + rng.uniform(0, s)) for _ in range(n)]
        rows.append((fid, [ring(*pts, pts[0])]))
    rows.append((100, [square(-1, -1, 50), square(9, 9, 14)]))  # covers all tiles but a hole
    rows.append((101, [square(10, 10, 10)]))  # touches tile borders exactly
    g = RasterGrid(0, 0, 47, 47, 47, 47)
    got = rows_of(tiles.tile_pairs(on_grid(features(spark, rows), g), 10), "fid", "tile_row", "tile_col")
    want = []
    for row in rows:
        px = [[{"x": p["x"], "y": 47 - p["y"]} for p in r] for r in row[1]]
        for i in range(5):
            for j in range(5):
                if touches(px, j * 10, i * 10, min(j * 10 + 10, 47), min(i * 10 + 10, 47)):
                    want.append((row[0], i, j))
    assert got == sorted(want)


def test_tile_pairs_of_lines_and_points(spark):
    g = RasterGrid(0, 0, 40, 40, 40, 40)
    rows = [(1, [ring((5, 35), (25, 35))], "LINE"), (2, [ring((20, 20))], "POINT"), (3, [ring((1, 1), (39, 39))], "POINT")]
    got = rows_of(tiles.tile_pairs(on_grid(features(spark, rows), g), 10), "fid", "tile_row", "tile_col")
    assert got == [(1, 0, 0), (1, 0, 1), (1, 0, 2), (2, 1, 1), (2, 1, 2), (2, 2, 1), (2, 2, 2), (3, 0, 3), (3, 3, 0)]


def test_codes_by_tile_order(spark):
    g = RasterGrid(0, 0, 40, 40, 40, 40)
    df = features(spark, [(1, [square(31, 1, 3)]), (2, [square(1, 31, 3)]), (3, [square(2, 32, 3)]), (4, [square(1, 31, 3)])])
    df = df.withColumn("c", F.element_at(F.array(F.lit("z"), F.lit("y"), F.lit("x"), F.lit("0")), F.col("fid").cast("int")))
    codes = encode.codes_by_tile(on_grid(df, g), ["c"], 10)
    assert rows_of(codes, "code", "category") == [(1, "None"), (2, "x"), (3, "y"), (4, "z")]


def random_rings(rng, n):
    pts = [(rng.uniform(0, 10), rng.uniform(0, 10)) for _ in range(n)]
    return [ring(*pts, pts[0])]


def star(n, crossed):
    import math

    pts = [(math.cos(2 * math.pi * i / n) * (5 if i % 2 else 4), math.sin(2 * math.pi * i / n) * (5 if i % 2 else 4)) for i in range(n)]
    if crossed:
        pts[n // 2], pts[n // 2 + 3] = pts[n // 2 + 3], pts[n // 2]
    return [ring(*pts, pts[0])]


@pytest.mark.parametrize("row_edges", [10**6, 0])
def test_validity_both_ways(spark, row_edges):
    rows = [
        (1, [square(0, 0, 2)]),
        (2, [ring((0, 0), (2, 0), (2, 2), (0, 2))]),  # open
        (3, [ring((0, 0), (2, 0), (0, 0))]),  # too short
        (4, [ring((0, 0), (2, 0), (1, 0), (0, 0))]),  # flat
        (5, [ring((0, 0), (2, 2), (2, 0), (0, 1), (0, 0))]),  # bow tie
        (6, [square(0, 0, 9), square(8, 8, 4)]),  # hole across the shell
        (7, star(600, False)),
        (8, star(600, True)),
        (9, []),
        (10, [ring((1, 1))], "POINT"),
    ]
    got = [f for (f,) in rows_of(validity.valid_geometries(features(spark, rows), row_edges), "fid")]
    assert got == [1, 7, 10]


def test_validity_of_random_shapes_agrees(spark):
    rng = random.Random(11)
    df = features(spark, [(i, random_rings(rng, rng.randint(3, 7))) for i in range(120)])
    small = rows_of(validity.valid_geometries(df, 10**6), "fid")
    assert small == rows_of(validity.valid_geometries(df, 0), "fid")
    assert 20 < len(small) < 110


@pytest.mark.parametrize("limit", [0, 10**7])
def test_features_in_circle_equal_brute_force(spark, limit):
    rng = random.Random(6)
    # a third of the features crowd into one bucket
    shapes = []
    for fid in range(90):
        x, y = (rng.uniform(1, 1.2), rng.uniform(1, 1.2)) if fid % 3 == 0 else (rng.uniform(0, 6), rng.uniform(0, 6))
        w = rng.uniform(0.05, 1.5)
        shapes.append((fid, [ring((x, y), (x + w, y + w / 3), (x + w / 4, y + w), (x, y))]))
    zones = spark.createDataFrame([(z, rng.uniform(0, 6), rng.uniform(0, 6), 0.3) for z in range(25)] + [(99, 1.1, 1.1, 0.2)], "zone_id long, cx double, cy double, radius double")
    df = features(spark, shapes)
    from gridloom.functions import geometry as G

    brute = zones.join(df).where(G.disc_intersects(F.col("rings"), F.col("cx"), F.col("cy"), F.col("radius")))
    got = zonal.features_in_circle(zones, df, bucket=0.4, broadcast_bytes=limit)
    assert rows_of(got, "zone_id", "fid") == rows_of(brute, "zone_id", "fid")


@pytest.mark.parametrize(
    "x,y,side,disc,outline",
    [
        (0.1, -0.05, 1, True, True),  # touches the eastern vertex
        (0.0, 0.0, 0.001, True, True),  # inside the disc
        (-5, -5, 10, True, True),  # holds the disc
        (0.2, 0.2, 1, False, False),
        # meets the arc between two vertices but not the chord
        (0.0998, 0.00488, 0.00002, True, False),
    ],
)
def test_disc_and_its_outline(spark, x, y, side, disc, outline):
    df = features(spark, [(1, [square(x, y, side)])])
    zones = spark.createDataFrame([(1, 0.0, 0.0, 0.1)], "zone_id long, cx double, cy double, radius double")
    assert zonal.features_in_circle(zones, df).count() == disc
    assert zonal.features_in_circle(zones, df, quarter_segments=16).count() == outline


def test_category_map_parts(spark):
    codes = spark.createDataFrame([("a", "v", f"c{i:02d}", i + 1) for i in range(25)], "layer string, var string, category string, code long")
    maps = {r.part: r.encoding for r in encode.category_map(codes, 10).collect()}
    assert sorted(maps) == [0, 1, 2] and len(maps[2]) == 5 and maps[1]["c10"] == 11
    assert [r.part for r in encode.category_map(codes, 25).collect()] == [0]


def test_majority_ties_and_missing(spark):
    rows = [("z", 2.0), ("z", 1.0), ("z", float("nan")), ("z", float("nan")), ("z", None), ("y", 5.0), ("y", 5.0), ("y", 3.0), ("x", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    assert rows_of(zonal.majority(df, ["g"], "v"), "g", "majority", "n") == [("y", 5.0, 2), ("z", 1.0, 1)]
    assert rows_of(zonal.majority(df, ["g"], "v", nodata=5.0), "g", "majority") == [("y", 3.0), ("z", 1.0)]


def test_check_conversion_agrees_on_a_clean_layer(spark):
    from gridloom.operators import rasterize

    df = features(spark, [(1, [square(0, 0, 2)], "POLYGON", "a", 2.0), (2, [square(2, 0, 2)], "POLYGON", "a", 7.0)])
    spec = grid.grid_spec(grid.layer_bounds(df), 0.1)
    cells = rasterize.polygon_cells(grid.with_grid(df, spec), ["value"])
    report = check.check_conversion(df, cells, spec, "value", radius=0.01, target=F.col("value") == 2.0).first()
    assert report.same_max and report.source_max == 7.0
    assert report.agrees and report.cell_value == 2.0


def test_status_and_documents(spark):
    df = features(spark, [(1, [square(0, 0, 2)]), (2, [square(2, 0, 2)], "POLYGON", "b")]).withColumn("t", F.array(F.lit(1)))
    status = {(r.layer, r.variable): r.reason for r in M.variable_status(df, ["value", "t", "q"]).collect()}
    assert status == {(l, v): why for l in "ab" for v, why in (("value", "numeric"), ("t", "unsupported type"), ("q", "not in schema"))}


def test_features_that_cannot_be_burned_are_counted(spark):
    df = features(spark, [(1, [square(0, 0, 2)]), (2, [square(2, 0, 2)])]).withColumn(
        "geom_type", F.when(F.col("fid") == 1, F.col("geom_type"))
    )
    assert M.variable_status(df, ["value"]).first()["n_dropped"] == 1


def test_encodings_are_rows_and_not_documents(spark):
    codes = spark.createDataFrame([("a", "k", c, i + 1) for i, c in enumerate("xyz")] + [("b", "s", "x", 1)], "layer string, var string, category string, code long")
    rows = M.encoding_metadata(codes)
    assert M.attribute_documents(rows, "a") == {}
    assert rows_of(M.encoding_rows(rows, "a"), "var", "code", "category") == [("k", 1, "x"), ("k", 2, "y"), ("k", 3, "z")]


def test_codes_beyond_float32_are_refused(spark):
    df = features(spark, [(1, [square(0, 0, 2)])]).withColumn("k", F.lit("x"))
    codes = spark.createDataFrame([("a", "k", "x", (1 << 24) + 1)], "layer string, var string, category string, code long")
    with pytest.raises(ValueError, match="float32"):
        encode.apply_codes(df, codes, ["k"])


def test_majority_of_text(spark):
    df = spark.createDataFrame([("z", "b"), ("z", "a"), ("y", "q"), ("y", "p"), ("y", "q"), ("x", None)], "g string, v string")
    assert rows_of(zonal.majority(df, ["g"], "v"), "g", "majority", "n") == [("y", "q", 2), ("z", "a", 1)]


def test_picks_spread_over_the_grid(spark):
    from gridloom.operators import lookup

    cells = spark.range(400).select((F.col("id") % 20).alias("row"), F.floor(F.col("id") / 20).alias("col"))
    picks = [(r["row"], r["col"]) for s in range(30) for r in lookup.sample_cell(cells, s).collect()]
    assert len(set(picks)) > 25 and (0, 0) not in picks[:1]
    assert len({r for r, _ in picks}) > 8 and len({c for _, c in picks}) > 8


def test_check_of_values_that_are_no_integers(spark):
    from gridloom.operators import rasterize

    df = features(spark, [(1, [square(0, 0, 2)], "POLYGON", "a", 0.1)])
    spec = grid.grid_spec(grid.layer_bounds(df), 0.1)
    cells = rasterize.polygon_cells(grid.with_grid(df, spec), ["value"])
    assert check.check_conversion(df, cells, spec, "value", radius=0.01).first().agrees


def test_discs_of_any_radius_meet_what_they_touch(spark):
    df = features(spark, [(i, [square(i, 0, 0.5)]) for i in range(20)])
    zones = spark.createDataFrame([(1, 0.25, 0.25, 0.01), (2, 10.0, 0.25, 3.0)], "zone_id long, cx double, cy double, radius double")
    near = rows_of(zonal.features_in_circle(zones, df), "zone_id", "fid")
    assert near == [(1, 0)] + [(2, i) for i in range(7, 14)]


def test_unmeasured_joins_broadcast_nothing(spark):
    from gridloom.plans.joins import join_skewed
    from tests.conftest import plan_of

    a = spark.range(100).withColumnRenamed("id", "k").withColumn("fid", F.col("k"))
    assert "Broadcast" not in plan_of(join_skewed(a, spark.range(5).withColumnRenamed("id", "k"), ["k"]))


def test_side_by_side(spark):
    a = spark.createDataFrame([(0, 0, 1.0)], "row long, col long, v double")
    b = spark.createDataFrame([(0, 1, 2.0)], "row long, col long, v double")
    assert rows_of(tiles.beside([(a, 0), (b, 5)]), "row", "col", "v") == [(0, 0, 1.0), (0, 6, 2.0)]
    assert rows_of(tiles.stack([(a, 0), (b, 5)]), "row", "col", "v") == [(0, 0, 1.0), (5, 1, 2.0)]


def test_automatic_chunk_size(spark):
    spec = spark.sql("SELECT 'a' layer, 1000L nx, 300L ny")
    cells = spark.range(3000).selectExpr("'a' layer", "id % 300 row", "id % 1000 col", "cast(id as float) v", "cast(id as double) w")
    size = lambda some, **more: align.auto_chunk(some, spec, ["v", "w"], **more)
    # a hundredth of the cells, 16 bytes each: 100 x 100 cells hold 1,600 bytes
    assert size(cells, target_bytes=1600) == 100
    assert size(cells, target_bytes=1700) == 100  # 103 would leave a last chunk of 73
    assert size(cells) == 1000 and size(cells, target_bytes=1) == 2
    assert size(cells.limit(0)) == 1 and align.auto_chunk(cells, spec.limit(0), ["v"]) == 1
    packed = align.pack_chunks(cells, ["v"], "auto", spec=spec, target_bytes=800)
    assert {r["chunk"] for r in packed.collect()} == {100}
    assert sorted(map(tuple, align.unpack_chunks(packed).select("row", "col", "value").collect())) == sorted((i % 300, i % 1000, float(i)) for i in range(3000))
    with pytest.raises(ValueError):
        align.pack_chunks(cells, ["v"], "auto")


def copied(spark, copies):
    """Discs and shapes, every one ``copies`` times under other ids."""
    rng = random.Random(12)
    places = [(rng.uniform(0, 6), rng.uniform(0, 6), rng.uniform(0.2, 1.5)) for _ in range(40)]
    shapes = [(i * 100 + k, [square(x, y, w)], "POLYGON", "ab"[k % 2], float(k % 3)) for i, (x, y, w) in enumerate(places) for k in range(copies)]
    discs = [(z * 100 + k, rng_x, 6 - rng_x, 0.4) for z, rng_x in enumerate([0.5, 1.5, 3.0, 4.4]) for k in range(copies)]
    return spark.createDataFrame(discs, "zone_id long, cx double, cy double, radius double"), features(spark, shapes)


@pytest.mark.parametrize("limit", [0, 10**7])
def test_copies_of_discs_and_shapes_are_compared_once(spark, monkeypatch, limit):
    from gridloom.functions import geometry as G

    zones, df = copied(spark, 5)
    stored = []
    real = zonal.store
    monkeypatch.setattr(zonal, "store", lambda t: (stored.append(real(t)), stored[-1])[1])
    got = zonal.features_in_circle(zones, df, broadcast_bytes=limit)
    brute = zones.join(df).where(G.disc_intersects(F.col("rings"), F.col("cx"), F.col("cy"), F.col("radius")))
    assert rows_of(got, "zone_id", "layer", "fid", "value") == rows_of(brute, "zone_id", "layer", "fid", "value") != []
    once = zonal.features_in_circle(*copied(spark, 1)).count()
    assert got.count() == 25 * once and stored[0].count() < 4 * once  # candidate pairs, without the copies


@pytest.mark.parametrize("nodata", [None, 1.0])
def test_majority_in_circle_needs_no_pairs(spark, nodata):
    zones, df = copied(spark, 5)
    want = zonal.majority(zonal.features_in_circle(zones, df), ["zone_id"], "value", nodata)
    names = ("zone_id", "majority", "n")
    assert rows_of(zonal.majority_in_circle(zones, df, ["zone_id"], "value", nodata), *names) == rows_of(want, *names) != []
