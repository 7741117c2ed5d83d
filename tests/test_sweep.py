import random

import pytest
from pyspark.sql import functions as F

from gridloom.operators import align, grid, rasterize
from gridloom.operators.grid import RasterGrid
from gridloom.operators.sweep import cut_rows, winning_spans
from tests.helpers import exploded_plan, features, on_grid, ring, rows_of, square

NAMES = ("layer", "row", "col", "fid", "value")
SPANS = "layer string, row long, c0 long, c1 long, fid long, value float, name string"


def spans(spark, rows):
    return spark.createDataFrame([(a, r, c0, c1, f, float(v), n) for a, r, c0, c1, f, v, n in rows], SPANS)


def random_spans(seed, n=3000, rows=7, width=300):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        c0, fid = rng.randrange(width), rng.randrange(200)
        out.append((rng.choice("ab"), rng.randrange(rows), c0, c0 + rng.choice([0, 1, 5, 80]), fid, fid / 2, None if fid % 7 == 0 else f"n{fid}"))
    return out


def painted(rows):
    cells = {}
    for layer, row, c0, c1, fid, value, name in sorted(rows, key=lambda r: r[4]):
        for c in range(c0, c1 + 1):
            cells[layer, row, c] = (fid, value, name)
    return cells


@pytest.mark.parametrize("deal,columns", [(None, None), (["layer"], None), (None, 16)])
def test_winners_are_the_painted_ones(spark, deal, columns):
    rows = random_spans(1)
    df, key = spans(spark, rows).repartition(5), ["layer", "row"]
    if columns:
        df, key = cut_rows(df, columns), ["layer", "part", "row"]
    won = winning_spans(df, key, deal).collect()
    got = {}
    for r in won:
        for c in range(r.c0, r.c1 + 1):
            assert (r.layer, r.row, c) not in got  # disjoint
            got[r.layer, r.row, c] = (r.fid, r.value, r["name"])
    assert got == painted(rows)
    if not columns:
        # no two neighbours that could be one
        ends = {(r.layer, r.row, r.c1 + 1): r.fid for r in won}
        assert all(ends.get((r.layer, r.row, r.c0)) != r.fid for r in won)


def test_one_hot_spot(spark):
    # every feature covers the same cells: a task passes on one span of them
    rows = [("a", 3, 10, 19, f, f, None) for f in range(50_000)]
    won = winning_spans(spans(spark, rows), ["layer", "row"]).collect()
    assert [(r.c0, r.c1, r.fid) for r in won] == [(10, 19, 49_999)]
    assert winning_spans(spans(spark, []), ["layer", "row"]).count() == 0


def overlapping(spark):
    rng = random.Random(8)
    rows = []
    for i in range(150):
        x, y, w = rng.uniform(-5, 95), rng.uniform(-5, 95), rng.uniform(1, 40)
        shape = [square(x, y, w)] if i % 3 else [ring((x, y), (x + w, y + w / 3), (x + w / 4, y + w), (x, y)), square(x + w / 8, y + w / 8, w / 8)]
        rows.append((i, shape, "POLYGON", "ab"[i % 2], float("nan") if i % 11 == 0 else i / 4))
    rows += [(200 + i, [ring((rng.uniform(0, 100), rng.uniform(0, 100)))], "POINT", "a") for i in range(40)]
    rows += [(300 + i, [ring((rng.uniform(0, 100), 50), (50, rng.uniform(0, 100)))], "LINE", "b") for i in range(20)]
    return on_grid(features(spark, rows), RasterGrid(0, 0, 100, 100, 230, 170))


def fixed(rows):
    return [tuple("nan" if v != v else v for v in r) for r in rows]


@pytest.mark.parametrize("part_columns", [7, 4096])
def test_swept_cells_equal_the_cell_by_cell_way(spark, part_columns):
    g = overlapping(spark)
    polygons = g.where("geom_type = 'POLYGON'")
    want = fixed(rows_of(rasterize.polygon_cells(polygons, ["value"]), *NAMES))
    assert sorted(fixed(rows_of(rasterize.swept_cells(polygons, ["value"], part_columns=part_columns), *NAMES)), key=str) == sorted(want, key=str)
    every = rasterize.last_wins(
        rasterize.span_cells(rasterize._spans(g.select("layer", "fid", "geom_type", "value", *rasterize._present(g)), ("POLYGON", "LINE", "POINT"))), ["value"]
    )
    types = ("POLYGON", "LINE", "POINT")
    assert sorted(fixed(rows_of(rasterize.swept_cells(g, ["value"], types), *NAMES)), key=str) == sorted(fixed(rows_of(every, *NAMES)), key=str)


@pytest.mark.parametrize("tile,ascending", [(7, False), (64, True), (500, False)])
def test_swept_tiles_equal_the_cell_by_cell_way(spark, tile, ascending):
    g, types = overlapping(spark), ("POLYGON", "LINE", "POINT")
    names = (*NAMES, "tile_row", "tile_col")
    got = rasterize.swept_tiles(g, ["value"], tile, ascending, types)
    want = rasterize.tiled_cells(g, ["value"], tile, ascending, geom_types=types)
    assert sorted(fixed(rows_of(got, *names)), key=str) == sorted(fixed(rows_of(want, *names)), key=str)


def test_cells_are_made_once_and_not_shuffled(spark):
    g = overlapping(spark).where("geom_type = 'POLYGON'")
    cells = rasterize.swept_cells(g, ["value"])
    # above the last exchange stand the sweep and the making of cells, no aggregate
    top = exploded_plan(cells).split("Exchange")[0]
    assert "MapInArrow" in top and "Generate" in top and "Aggregate" not in exploded_plan(cells)
    packed = align.pack_chunks(rasterize.swept_tiles(g, ["value"], 50), ["value"], 50, placed=True)
    # packing follows the tiles' layout: no exchange between making cells and collecting them
    top = exploded_plan(packed).split("Exchange")[0]
    assert "collect_list" in top and top.count("Generate") == 2


def test_row_with_very_many_spans_is_dealt_out(spark):
    rows = [(i, [square(i / 100, 5, 0.5)]) for i in range(3000)]
    g = on_grid(features(spark, rows), RasterGrid(0, 0, 40, 10, 4000, 10))
    got = rasterize.swept_cells(g, [], part_columns=100).withColumn("p", F.spark_partition_id())
    assert got.where("row = 4").select("p").distinct().count() > 4
    assert rows_of(got, "row", "col", "fid") == rows_of(rasterize.polygon_cells(g, []), "row", "col", "fid")


def test_features_under_an_equal_one_are_not_burned(spark):
    shapes = [square(1, 1, 3), square(2, 2, 3), [*square(1, 1, 3)]]
    rows = [(i, [shapes[i % 3]], "POLYGON", "ab"[i // 6 % 2], i / 2) for i in range(24)]
    every = features(spark, rows)
    last = rasterize.last_of_equal(every)
    assert last.columns == every.columns
    # the first and third shape are the same
    assert sorted((r.layer, r.fid) for r in last.collect()) == [("a", 16), ("a", 17), ("b", 22), ("b", 23)]
    box = RasterGrid(0, 0, 10, 10, 20, 20)
    want = fixed(rows_of(rasterize.polygon_cells(on_grid(every, box), ["value"]), *NAMES))
    assert fixed(rows_of(rasterize.polygon_cells(on_grid(last, box), ["value"]), *NAMES)) == want != []


def test_conversions_burn_the_last_of_equal_features(spark, monkeypatch):
    from gridloom.plans import convert

    rows = [(i, [square(i % 2, 0, 3)], "POLYGON", "a", float(i)) for i in range(20)]
    every = features(spark, rows).withColumn("name", F.concat(F.lit("n"), "fid"))
    burned, valid, burn = [], convert.validity.valid_geometries, convert.rasterize.burn
    monkeypatch.setattr(convert.validity, "valid_geometries", lambda df: burned.append(df.count()) or valid(df))
    monkeypatch.setattr(convert.rasterize, "burn", lambda df, *a: burned.append(df.count()) or burn(df, *a))
    whole = convert.grid_features(every, 0.5, ["value", "name"])
    tiled = convert.grid_features_tiled(every, 0.5, tile=4, chunk=4, variables=["value", "name"])
    assert burned == [2, 2]
    # codes and bounds are those of all features
    assert whole.codes.count() == tiled.codes.count() == 20
    for g in (whole, tiled):
        assert {r.value for r in g.cells.select("value").distinct().collect()} == {18.0, 19.0}
        assert g.spec.first()["nx"] == whole.spec.first()["nx"]


@pytest.mark.parametrize("pieces", [1, 50, 10_000])
def test_sweeps_in_halves_and_over_batches(pieces):
    import pyarrow as pa

    from gridloom.operators.sweep import _sweep

    rows = sorted(random_spans(3), key=lambda r: r[:3])
    names = ["layer", "row", "c0", "c1", "fid", "value", "name"]
    table = pa.table(dict(zip(names, map(list, zip(*rows)))))
    won = pa.Table.from_batches(list(_sweep(2, pieces)(iter(table.to_batches(max_chunksize=61))))).to_pylist()
    got = [((r["layer"], r["row"], c), (r["fid"], r["value"], r["name"])) for r in won for c in range(r["c0"], r["c1"] + 1)]
    assert len(got) == len(dict(got)) and dict(got) == painted(rows)
    ends = {(r["layer"], r["row"], r["c1"] + 1): r["fid"] for r in won}
    assert all(ends.get((r["layer"], r["row"], r["c0"])) != r["fid"] for r in won)
