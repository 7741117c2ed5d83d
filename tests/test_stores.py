import json
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.operators import align, grid, lookup
from gridloom.operators.grid import RasterGrid
from gridloom.plans import convert
from gridloom.sources import array_store, chunk_store, features, files, rasters
from tests.helpers import exploded_plan, features as make, ring, rows_of, square


def cells(spark, n=400, seed=4, side=37):
    rng = random.Random(seed)
    places = rng.sample(range(side * side), n)
    rows = [("a" if i % 2 else "7", p // side, p % side, float(i), float("nan") if i % 9 == 0 else i / 2) for i, p in enumerate(places)]
    return spark.createDataFrame(rows, "layer string, row long, col long, v float, w float")


NAMES = ("layer", "var", "row", "col", "value")


def key(rows):
    return sorted((a, b, c, d, "nan" if e != e else e) for a, b, c, d, e in rows)


def long_form(df):
    return [
        (r.layer, v, r.row, r.col, r[v]) for r in df.collect() for v in ("v", "w")
    ]


@pytest.mark.parametrize("chunk", [1, 5, 37, 100])
def test_pack_then_unpack_is_identity(spark, chunk):
    got = align.unpack_chunks(align.pack_chunks(cells(spark), ["v", "w"], chunk)).collect()
    assert key([tuple(r[n] for n in NAMES) for r in got]) == key(long_form(cells(spark)))


def test_rechunk(spark):
    packed = align.pack_chunks(cells(spark), ["v", "w"], 5)
    again = align.rechunk(packed, 12)
    direct = align.pack_chunks(cells(spark), ["v", "w"], 12)
    cols = ("layer", "var", "chunk_row", "chunk_col", "chunk", "pos")
    pick = lambda df: sorted((r.layer, r.var, r.chunk_row, r.chunk_col, r.chunk, r.pos) for r in df.select(*cols).collect())
    assert pick(again) == pick(direct)


def test_store_round_trip_and_pruning(spark, tmp_path):
    path = str(tmp_path / "s")
    packed = align.pack_chunks(cells(spark), ["v", "w"], 8)
    meta = spark.createDataFrame([("a", "dataset", "title", 0, "t", None)], "layer string, scope string, key string, pos int, text string, number double")
    for _ in range(2):  # writing again replaces the store
        chunk_store.write_chunks(packed, meta, path)
    got = convert.read_cells(spark, path).collect()
    assert key([tuple(r[n] for n in NAMES) for r in got]) == key(long_form(cells(spark)))
    one = chunk_store.read_chunks(spark, path, layer="7", variables=["w"])
    assert "PartitionFilters: [isnotnull(layer" in exploded_plan(one)
    assert {(r.layer, r["var"]) for r in one.collect()} == {("7", "w")}
    assert chunk_store.read_metadata(spark, path).count() == 1


def test_chunk_window_prunes_the_scan(spark, tmp_path):
    g = RasterGrid(0, 0, 37, 37, 37, 37)
    path = str(tmp_path / "s")
    packed = align.pack_chunks(cells(spark), ["v"], 4)
    chunk_store.write_chunks(packed, spark.range(1), path)
    box = (3.0, 20.0, 9.0, 30.0)
    near = chunk_store.read_chunks(spark, path).where(lookup.chunk_window(g, 4, *box))
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = exploded_plan(near)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(chunk_row" in plan and "LessThanOrEqual(chunk_col" in plan
    for labels in ("edges", "centers"):
        def labelled(df):
            return grid.on_raster(df, g).withColumn("latitude", grid.latitude_label(F.col("row"), labels)).withColumn(
                "longitude", grid.longitude_label(F.col("col"), labels))

        part = lookup.subset_bbox(labelled(align.unpack_chunks(near)), *box)
        whole = lookup.subset_bbox(labelled(align.unpack_chunks(packed)), *box)
        assert rows_of(part, "layer", "row", "col", "value") == rows_of(whole, "layer", "row", "col", "value")
        assert part.count() > 0


def read_array(path, name):
    with open(f"{path}/{name}/.zarray") as f:
        info = json.load(f)
    shape, chunks, dtype = info["shape"], info["chunks"], np.dtype(info["dtype"])
    padded = [-(-s // c) * c for s, c in zip(shape, chunks)]
    out = np.zeros(padded, dtype)
    for file in os.listdir(f"{path}/{name}"):
        if file.startswith(".") or file == "encoding":
            continue
        at = [int(k) for k in file.split(".")]
        block = np.fromfile(f"{path}/{name}/{file}", dtype).reshape(chunks)
        out[tuple(slice(a * c, (a + 1) * c) for a, c in zip(at, chunks))] = block
    return out[tuple(slice(0, s) for s in shape)]


def test_conversion_to_arrays(spark, tmp_path):
    rows = [(1, [square(0, 0, 3)], "POLYGON", "a", 4.0), (2, [square(2, 2, 3)], "POLYGON", "a", 9.0),
            (3, [square(0, 0, 1)], "POLYGON", "b", 1.0)]
    df = make(spark, rows).withColumn("kind", F.when(F.col("fid") == 1, "").otherwise("rock"))
    gridded = convert.grid_features(df, 0.5)
    store, out = str(tmp_path / "store"), str(tmp_path / "arrays")
    convert.write_dataset(gridded, store, "parts", "file:///x.zip", "WKT", 0.5, chunk=4, day="2024-01-01")
    convert.export_arrays(store, gridded.spec, "a", out)

    value, kind = read_array(out, "value"), read_array(out, "kind")
    assert value.shape == (10, 10)
    # ascending latitude: row 0 is the south
    want = np.zeros((10, 10), "f4")
    want[:6, :6] = 4
    want[4:, 4:] = 9
    assert np.array_equal(value, want)
    assert kind[0, 0] == 1 and kind[9, 9] == 2
    assert np.allclose(read_array(out, "latitude"), np.round(np.linspace(0, 5, 10), 4))
    assert np.allclose(read_array(out, "longitude"), np.round(np.linspace(0, 5, 10), 4))
    with open(f"{out}/.zmetadata") as f:
        everything = json.load(f)["metadata"]
    assert everything["kind/.zattrs"]["categorical_encoding"] == "kind/encoding"
    kinds = array_store.read_encoding(spark, out, "kind").collect()
    assert {r["category"]: r["code"] for r in kinds} == {"None": 1, "rock": 2}
    assert everything["kind/.zattrs"]["_ARRAY_DIMENSIONS"] == ["latitude", "longitude"]
    assert everything["kind/.zattrs"]["_CRS"] == {"wkt": "WKT"}
    assert everything["latitude/.zattrs"]["step"] == 0.5
    top = everything[".zattrs"]
    assert top["proj:epsg"] == 4326 and top["geographical_extent"] == [0, 0, 5, 5]
    assert top["variables"] == ["value", "kind"] and top["title"] == "parts"


def test_writing_arrays_twice_gives_the_same_objects(spark, tmp_path):
    g = RasterGrid(0, 0, 37, 37, 37, 37)
    spec = spark.range(1).select(F.lit("a").alias("layer")).withColumns(g.columns())
    packed = align.pack_chunks(cells(spark), ["v"], 10)
    out = str(tmp_path / "arrays")
    array_store.write_array_store(packed, spec, "a", {}, out, 10)
    before = {f: os.path.getsize(f"{out}/v/{f}") for f in os.listdir(f"{out}/v")}
    array_store.write_array_store(packed, spec, "a", {}, out, 10)
    assert before == {f: os.path.getsize(f"{out}/v/{f}") for f in os.listdir(f"{out}/v")}
    dense = read_array(out, "v")
    for r in cells(spark).where("layer = 'a'").collect():
        assert dense[r.row, r.col] == r.v
    assert np.count_nonzero(dense) == sum(1 for r in cells(spark).collect() if r.layer == "a" and r.v != 0)


def test_large_encodings_are_exported_whole(spark, tmp_path):
    n = 25_000
    df = spark.range(n).select(
        (F.col("id") + 1).alias("fid"), F.lit("a").alias("layer"), F.lit("POINT").alias("geom_type"),
        F.expr("array(array(named_struct('x', id / 1000D, 'y', (id % 7) / 1D)))").alias("rings"),
        F.concat(F.lit('k"\n'), F.col("id")).alias("kind"),
    )
    gridded = convert.grid_features(df, 1.0)
    store, out = str(tmp_path / "store"), str(tmp_path / "arrays")
    convert.write_dataset(gridded, store, "t", "u", "WKT", 1.0)  # without a chunk size
    convert.export_arrays(store, gridded.spec, "a", out)
    back = {r["code"]: r["category"] for r in array_store.read_encoding(spark, out, "kind").collect()}
    assert back == {i + 1: f'k"\n{i}' for i in range(n)}
    codes = read_array(out, "kind")
    assert set(codes[codes > 0].astype(int)) <= set(back)


def test_an_old_export_is_replaced(spark, tmp_path):
    spec = spark.range(1).select(F.lit("a").alias("layer")).withColumns(RasterGrid(0, 0, 4, 4, 4, 4).columns())
    schema = "layer string, row long, col long, v double"
    full = spark.createDataFrame([("a", r, c, 1.5) for r in range(4) for c in range(4)], schema)
    sparse = spark.createDataFrame([("a", 3, 3, 0.1)], schema)
    out = str(tmp_path / "arrays")
    array_store.write_array_store(align.pack_chunks(full, ["v"], 2), spec, "a", {}, out, 2)
    array_store.write_array_store(align.pack_chunks(sparse, ["v"], 2), spec, "a", {}, out, 2, fill=float("nan"))
    assert sorted(f for f in os.listdir(f"{out}/v") if not f.startswith(".")) == ["1.1"]
    with open(f"{out}/v/.zarray") as f:
        described = json.load(f)
    assert described["dtype"] == "<f8" and described["fill_value"] == "NaN"
    block = np.fromfile(f"{out}/v/1.1", "<f8").reshape(2, 2)
    assert block[1, 1] == 0.1 and np.isnan(block).sum() == 3
    (tmp_path / "other").mkdir()
    (tmp_path / "other" / "file").write_text("x")
    with pytest.raises(ValueError, match="no array store"):
        array_store.write_array_store(align.pack_chunks(sparse, ["v"], 2), spec, "a", {}, str(tmp_path / "other"), 2)


def test_raster_store_keeps_doubles_and_names_its_arrays(spark, tmp_path):
    cells = spark.createDataFrame([(b, r, 0, 0.1 + b + r) for b in (1, 2) for r in range(3)], "band int, row int, col int, value double")
    path = str(tmp_path / "raster")
    convert.write_raster(cells, RasterGrid(0, 0, 1, 3, 1, 3), "depth", 2, "r", "t", "u", path, day="2024-01-01")
    back = {(r["var"], r["row"]): r["value"] for r in convert.read_cells(spark, path).collect()}
    assert back == {(f"depth_{b}", 2 - r): 0.1 + b + r for b in (1, 2) for r in range(3)}
    named = chunk_store.read_metadata(spark, path).where("key = 'standard_name' and scope like 'depth%'")
    assert sorted(r["scope"] for r in named.collect()) == ["depth_1", "depth_2"]


def test_text_geometries_of_all_forms(spark):
    from gridloom.sources.wkt import wkt_parts, wkt_rings, wkt_type

    rows = [
        (1, "POLYGON ((0 0,\n1 0,\t1 1 , 0 0))"),
        (2, "SRID=4326;point(1 2)"),
        (3, "GEOMETRYCOLLECTION (POINT (1 2), POLYGON ((0 0, 1 0, 1 1, 0 0), (0 0, 1 0, 1 1, 0 0)), MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0))))"),
        (4, "srid=1; GeometryCollection(LINESTRING(0 0, 1 1))"),
        (5, "GEOMETRYCOLLECTION EMPTY"),
    ]
    df = spark.createDataFrame(rows, "fid long, t string").select("fid", F.explode(wkt_parts(F.col("t"))).alias("p"))
    got = [(r["fid"], r["kind"], [len(x) for x in r["rings"]]) for r in df.select("fid", wkt_type(F.col("p")).alias("kind"), wkt_rings(F.col("p")).alias("rings")).collect()]
    assert got == [(1, "POLYGON", [4]), (2, "POINT", [1]), (3, "POINT", [1]), (3, "POLYGON", [4, 4]), (3, "POLYGON", [4]), (4, "LINE", [2])]


def test_box_outline(spark):
    from gridloom.functions.geometry import box_rings

    one = spark.range(1).select(box_rings(F.lit(0.0), F.lit(1.0), F.lit(2.0), F.lit(4.0)).alias("r")).first()["r"]
    points = [(p["x"], p["y"]) for p in one[0]]
    assert len(one) == 1 and points[0] == points[-1] and set(points) == {(0, 1), (2, 1), (2, 4), (0, 4)}


def test_match_files(spark, tmp_path):
    for name in ("x/a.tif", "y/a.tif", "y/ba.tif", "z/a.txt"):
        p = tmp_path / name
        p.parent.mkdir(exist_ok=True)
        p.write_bytes(b"12345")
    got = files.match_files(spark, str(tmp_path), ".tif", "a.tif").collect()
    assert [r.path.split("/")[-2:] for r in got] == [["x", "a.tif"], ["y", "a.tif"]]
    assert all(r.length == 5 for r in got)
    assert files.match_files(spark, str(tmp_path), ".tif").count() == 3


def test_feature_scan_prunes_and_pushes(spark, tmp_path):
    path = str(tmp_path / "f")
    df = make(spark, [(1, [ring((0, 0))], "POINT", "a"), (2, [ring((1, 1))], "POINT", "b")])
    features.with_boxes(df.withColumn("other", F.lit("x"))).write.parquet(path)
    some = features.read_features(spark, path, layer="a", columns=["value", "unknown"])
    plan = exploded_plan(some)
    assert "EqualTo(layer,a)" in plan and "other" not in plan.split("ReadSchema")[1]
    assert some.columns == ["fid", "layer", "geom_type", "rings", "value"] and some.count() == 1
    bounds = exploded_plan(grid.layer_bounds(features.read_features(spark, path)))
    assert "rings" not in bounds.split("ReadSchema")[1].split(">")[0]


def test_features_from_json(spark, tmp_path):
    path = tmp_path / "f.json"
    path.write_text('{"fid": 1, "layer": "a", "geom_type": "POINT", "rings": [[{"x": 1.5, "y": 2}]], "v": 3}\n')
    schema = "fid bigint, layer string, geom_type string, rings array<array<struct<x:double,y:double>>>, v int"
    df = features.read_features(spark, str(path), fmt="json", schema=schema)
    gridded = convert.grid_features(df, 1.0)
    assert rows_of(gridded.cells, "layer", "row", "col", "v") == [("a", 0, 0, 3.0)]


def test_raster_read_and_bands(spark, tmp_path):
    path = str(tmp_path / "r")
    df = spark.createDataFrame([(b, r, c, float(b)) for b in (1, 2) for r in range(3) for c in range(2)], "band int, row int, col int, value double")
    df.write.partitionBy("band").parquet(path)
    assert "PartitionFilters: [isnotnull(band" in exploded_plan(rasters.read_raster(spark, path, band=2))
    assert rasters.raster_grid(df, 0, 0, 4, 6) == RasterGrid(0, 0, 4, 6, 2, 3)
    names = spark.createDataFrame([(2, "two")], "band int, description string")
    assert rows_of(rasters.band_info(df), "band", "n_cells", "description") == [(1, 6, ""), (2, 6, "")]
    assert {r.band: r.description for r in rasters.band_info(df, names).collect()} == {1: None, 2: "two"}


def test_raster_conversion_keeps_the_value_type(spark):
    df = spark.createDataFrame([(1, r, c, r * 10 + c) for r in range(3) for c in range(2)], "band int, row int, col int, value int")
    chunks, meta = convert.grid_raster(df, RasterGrid(0, 0, 2, 3, 2, 3), "d", 2, "l", "t", "u", day="2024-01-01")
    assert chunks.schema["vals"].dataType.elementType.typeName() == "integer"
    got = rows_of(align.unpack_chunks(chunks), "var", "row", "col", "value")
    assert got == sorted(("d_1", 2 - r, c, r * 10 + c) for r in range(3) for c in range(2))
    keys = {r.key for r in meta.collect()}
    assert {"band_count", "band_descriptions", "resolution", "units", "variables"} <= keys


def test_folders_match_like_files(spark, tmp_path):
    for name in ("w/a.gdb/part", "w/_b.gdb", "w/.c.gdb/part", "v/a.gdb.txt"):
        p = tmp_path / name
        p.parent.mkdir(exist_ok=True, parents=True)
        p.write_bytes(b"1")
    got = files.match_files(spark, str(tmp_path), ".gdb").collect()
    assert sorted((r.path.split("/")[-1], r.folder, r.length) for r in got) == [(".c.gdb", True, 0), ("_b.gdb", False, 1), ("a.gdb", True, 0)]


def test_the_checkpoint_folder_is_shared_on_a_cluster(spark, tmp_path, monkeypatch):
    """Spark names it ``file:/...``; a bare path is each machine's own."""
    inside = f"{spark.sparkContext.getCheckpointDir()}/export"
    assert inside.startswith("file:/") and "://" not in inside
    monkeypatch.setattr(spark.sparkContext, "master", "local-cluster[2,1,1024]")
    assert array_store.shared_uri(spark, inside) == "file://" + inside.removeprefix("file:")
    assert array_store.shared_uri(spark, f"file://{tmp_path}/x") == f"file://{tmp_path}/x"
    with pytest.raises(ValueError):
        array_store.shared_uri(spark, str(tmp_path / "x"))
