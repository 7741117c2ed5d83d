import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.operators import align, lookup
from gridloom.operators.grid import RasterGrid
from gridloom.plans import convert
from gridloom.sources import array_reader, array_store, chunk_store
from gridloom.sources.folders import Folder
from tests.helpers import rows_of
from tests.test_stores import cells, key

GRID = RasterGrid(0, 0, 37, 37, 37, 37)
NAMES = ("var", "row", "col", "value")


def spec(spark, layer="a"):
    return spark.range(1).select(F.lit(layer).alias("layer")).withColumns(GRID.columns())


def export(spark, path, df, names=("v", "w"), chunk=5, **more):
    array_store.write_array_store(align.pack_chunks(df, list(names), chunk), spec(spark), "a", {"title": "t"}, path, chunk, **more)


def wanted(df, names=("v", "w"), fill=0.0):
    rows = [(n, r.row, r.col, r[n]) for r in df.collect() for n in names]
    return key([("a", *r) for r in rows if not (r[3] == fill or (r[3] != r[3] and fill != fill))])


def got(chunks):
    return key([("a", *(r[n] for n in NAMES)) for r in align.unpack_chunks(chunks).collect()])


@pytest.mark.parametrize("chunk,fill", [(5, 0.0), (37, 0.0), (64, 0.0), (8, float("nan"))])
def test_reads_what_was_written(spark, tmp_path, chunk, fill):
    df = cells(spark).where("layer = 'a'")
    out = str(tmp_path / "arrays")
    export(spark, out, df, chunk=chunk, fill=fill)
    chunks = array_reader.read_array_chunks(spark, out)
    assert chunks.schema["vals"].dataType.elementType.typeName() == "float"
    assert got(chunks) == wanted(df, fill=fill)
    # sorted positions, one row for each chunk that holds something
    assert chunks.where("pos <> array_sort(pos)").count() == 0
    assert chunks.count() == chunks.select("var", "chunk_row", "chunk_col").distinct().count()


def test_objects_outside_the_box_are_not_opened(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(array_reader, "RUN_BYTES", 300)  # three objects to a partition
    df = cells(spark).where("layer = 'a'")
    out = str(tmp_path / "arrays")
    export(spark, out, df, chunk=5)
    box = (6.0, 12.0, 9.0, 20.0)
    rows, cols = lookup.chunk_bounds(GRID, 5, *box)
    near = array_reader.read_array_chunks(spark, out, ["w"], rows, cols)
    whole = align.pack_chunks(df, ["v", "w"], 5).where(lookup.chunk_window(GRID, 5, *box) & (F.col("var") == "w"))
    assert got(near) == got(whole) != []
    # broken objects outside do no harm
    for name in os.listdir(f"{out}/w"):
        if not name.startswith("."):
            r, c = map(int, name.split("."))
            if not (rows[0] <= r <= rows[1] and cols[0] <= c <= cols[1]):
                with open(f"{out}/w/{name}", "wb") as f:
                    f.write(b"broken")
    assert got(near) == got(whole)
    assert near.rdd.getNumPartitions() < array_reader.read_array_chunks(spark, out).rdd.getNumPartitions()


def test_one_read_serves_queries_with_other_conditions(spark, tmp_path):
    df = cells(spark).where("layer = 'a'")
    out = str(tmp_path / "arrays")
    export(spark, out, df)
    chunks = array_reader.read_array_chunks(spark, out)
    every = {(r["var"], r.chunk_row, r.chunk_col) for r in chunks.collect()}
    some = chunks.where("chunk_row % 2 = 1 and var like 'v%' and chunk_col in (1, 3) and chunk_row > 2 and chunk_row <= 6")
    rows = {(r["var"], r.chunk_row, r.chunk_col) for r in some.collect()}
    assert rows == {r for r in every if r[0] == "v" and r[1] in (3, 5) and r[2] in (1, 3)} != set()
    both = chunks.where("var = 'v'").unionByName(chunks.where("var = 'w' and chunk_row = 0"))
    assert both.count() == sum(r[0] == "v" or r[1] == 0 for r in every)
    assert chunks.where("var = 'unknown'").count() == 0 and chunks.count() == len(every)
    assert array_reader.read_array_chunks(spark, out, ["unknown"]).count() == 0
    assert array_reader.read_array_chunks(spark, out, rows=(100, 200)).count() == 0


def test_axes_and_attributes(spark, tmp_path):
    out = str(tmp_path / "arrays")
    export(spark, out, cells(spark).where("layer = 'a'"), variable_attributes={"v": {"units": "m"}})
    axes = array_reader.read_axes(spark, out)
    lat = [r.label for r in axes.where("array = 'latitude'").orderBy("idx").collect()]
    assert np.allclose(lat, np.round(np.linspace(0, 37, 37), 4)) and axes.count() == 74
    documents = array_reader.array_documents(spark, out)
    assert documents["v"] == {"units": "m"} and documents[""] == {"title": "t"}


def test_integers_and_mixed_types(spark, tmp_path):
    out = str(tmp_path / "arrays")
    df = spark.createDataFrame([("a", r, c, r * 40 + c) for r in range(37) for c in range(0, 37, 2)], "layer string, row long, col long, v int")
    export(spark, out, df, names=["v"], chunk=10)
    chunks = array_reader.read_array_chunks(spark, out)
    assert chunks.schema["vals"].dataType.elementType.typeName() == "integer" and got(chunks) == wanted(df, ["v"], 0)


def test_other_layouts_are_refused(spark, tmp_path):
    out = str(tmp_path / "arrays")
    export(spark, out, cells(spark).where("layer = 'a'"))
    with open(f"{out}/.zmetadata") as f:
        everything = json.load(f)
    for change in ({"compressor": {"id": "zlib"}}, {"chunks": [5, 6]}, {"dtype": ">f4"}):
        changed = json.loads(json.dumps(everything))
        changed["metadata"]["v/.zarray"].update(change)
        with open(f"{out}/.zmetadata", "w") as f:
            json.dump(changed, f)
        with pytest.raises(Exception, match="array 'v'"):
            array_reader.read_array_chunks(spark, out).count()


def broken(df):
    """The same rows, but the job fails on the way."""
    return df.withColumn("chunk", F.when(F.col("chunk_row") == 3, F.raise_error(F.lit("halfway")).cast("int")).otherwise(F.col("chunk")))


def test_a_failed_write_leaves_the_chunk_store(spark, tmp_path):
    path, df = str(tmp_path / "s"), cells(spark)
    packed = align.pack_chunks(df, ["v", "w"], 5)
    meta = spark.range(1)
    chunk_store.write_chunks(packed, meta, path)
    before = key([tuple(r[n] for n in ("layer", *NAMES)) for r in convert.read_cells(spark, path).collect()])
    with pytest.raises(Exception, match="halfway"):
        chunk_store.write_chunks(broken(packed), spark.range(5), path)
    with pytest.raises(Exception, match="halfway"):
        chunk_store.write_chunks(packed.limit(1), meta.select(F.raise_error(F.lit("halfway")).alias("id")), path)
    assert key([tuple(r[n] for n in ("layer", *NAMES)) for r in convert.read_cells(spark, path).collect()]) == before
    assert chunk_store.read_metadata(spark, path).count() == 1
    assert len(os.listdir(f"{path}/versions")) == 1


def test_a_store_may_be_rewritten_from_itself_while_others_read(spark, tmp_path):
    path, df = str(tmp_path / "s"), cells(spark)
    chunk_store.write_chunks(align.pack_chunks(df, ["v"], 5), spark.range(1), path)
    earlier = chunk_store.read_chunks(spark, path)
    n = earlier.count()
    chunk_store.write_chunks(earlier.where("chunk_row < 2"), spark.range(2), path)
    assert earlier.count() == n > chunk_store.read_chunks(spark, path).count() > 0
    for k in range(3, 6):
        chunk_store.write_chunks(chunk_store.read_chunks(spark, path), spark.range(k), path)
    assert chunk_store.read_metadata(spark, path).count() == 5
    assert len(os.listdir(f"{path}/versions")) == 2 and chunk_store.sweep(spark, path, 1) == 1
    assert chunk_store.read_metadata(spark, path).count() == 5


def test_a_failed_export_leaves_the_old_one(spark, tmp_path):
    out, df = str(tmp_path / "arrays"), cells(spark).where("layer = 'a'")
    export(spark, out, df, ["v"])
    before = got(array_reader.read_array_chunks(spark, out))
    packed = align.pack_chunks(df.withColumn("v", F.col("v") + 1), ["v"], 5)
    with pytest.raises(Exception, match="halfway"):
        array_store.write_array_store(broken(packed), spec(spark), "a", {}, out, 5)
    assert got(array_reader.read_array_chunks(spark, out)) == before and os.listdir(tmp_path) == ["arrays"]
    export(spark, out, df.where("row < 3"), ["v"])
    assert got(array_reader.read_array_chunks(spark, out)) == wanted(df.where("row < 3"), ["v"]) and os.listdir(tmp_path) == ["arrays"]


def test_a_killed_second_attempt_leaves_whole_objects(spark, tmp_path):
    """A speculative attempt may be ended while it writes an object that is already there."""
    out, df = str(tmp_path / "arrays"), cells(spark).where("layer = 'a'")
    export(spark, out, df, ["v"])
    writer = array_store.array_store_source()({"path": f"file://{out}", "documents": "{}"}).writer(None, False)
    local, root = writer._open()

    class Killed:
        type_name = local.type_name
        create_dir, move = local.create_dir, local.move

        def open_output_stream(self, path):
            with local.open_output_stream(path) as half:
                half.write(b"half")
            raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        writer._put(Killed(), root, "v/0.0", b"whole")
    assert got(array_reader.read_array_chunks(spark, out)) == wanted(df, ["v"])
    writer._put(local, root, "v/0.0", b"whole")
    with open(f"{out}/v/0.0", "rb") as f:
        assert f.read() == b"whole"


def test_a_replacement_that_broke_off_is_finished(spark, tmp_path):
    out, df = str(tmp_path / "arrays"), cells(spark).where("layer = 'a'")
    export(spark, out, df, ["v"])
    new = str(tmp_path / "new")
    export(spark, new, df.where("row < 3"), ["v"])
    # between the two renames: the old one aside, the new one not in place
    Folder(spark, out).rename_to(f"{out}.replaced-x1")
    Folder(spark, new).rename_to(f"{out}.staged-x1")
    assert got(array_reader.read_array_chunks(spark, out)) == wanted(df.where("row < 3"), ["v"]) and os.listdir(tmp_path) == ["arrays"]


def test_stores_without_versions_are_read(spark, tmp_path):
    path, df = str(tmp_path / "s"), cells(spark)
    align.pack_chunks(df, ["v"], 5).write.partitionBy("layer", "var").parquet(f"{path}/chunks")
    assert rows_of(convert.read_cells(spark, path), "layer", "row", "col") == rows_of(df, "layer", "row", "col")


def test_stores_that_only_spark_opens_are_read(spark, tmp_path):
    """No Python process opens the store: objects and JSON come through Spark's file systems."""
    df = cells(spark).where("layer = 'a'")
    export(spark, str(tmp_path / "arrays"), df, names=["v"])
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.exports.link./in", f"file://{tmp_path}")
    out = "viewfs://exports/in/arrays"
    assert got(array_reader.read_array_chunks(spark, out)) == wanted(df, ["v"])
    axes = array_reader.read_axes(spark, out)
    assert axes.count() == 74 and rows_of(axes, "array", "idx") == rows_of(array_reader.read_axes(spark, str(tmp_path / "arrays")), "array", "idx")


def test_absent_axis_objects_are_fill(spark, tmp_path):
    out = tmp_path / "arrays"
    export(spark, str(out), cells(spark).where("layer = 'a'"), names=["v"])
    (out / "longitude" / "1").unlink()
    (out / "latitude" / "99").write_bytes(b"beyond the axis")
    axes = array_reader.read_axes(spark, str(out)).where("array = 'longitude'").orderBy("idx").collect()
    assert [r.idx for r in axes] == list(range(37)) and [r.label for r in axes][5:10] == [0.0] * 5 and axes[10].label > 0
    assert array_reader.read_axes(spark, str(out)).count() == 74


def test_names_are_no_patterns(spark, tmp_path):
    df = cells(spark).where("layer = 'a'")
    named = F.when(F.col("var") == "v", "a[1] b*").otherwise("a1 bc")
    out = str(tmp_path / "arrays")
    array_store.write_array_store(align.pack_chunks(df, ["v", "w"], 5).withColumn("var", named), spec(spark), "a", {}, out, 5)
    for names in (["a[1] b*"], ["a1 bc"], ["a[1] b*", "a1 bc"]):
        back = array_reader.read_array_chunks(spark, out, names).withColumn("var", F.when(F.col("var") == "a1 bc", "w").otherwise("v"))
        assert got(back) == wanted(df, ["w" if n == "a1 bc" else "v" for n in names]) != []


@pytest.mark.parametrize("low,high", [(0, 0), (0, 9), (0, 10), (0, 1234), (7, 7), (7, 13), (10, 99), (98, 1001), (990, 2010), (5, 4)])
def test_number_globs_match_their_range_alone(low, high):
    import re

    globs = array_reader.number_globs(low, high)
    # as a regular expression these patterns mean the same
    assert [n for n in range(3000) if any(re.fullmatch(g, str(n)) for g in globs)] == list(range(low, high + 1))
    assert not any(re.fullmatch(g, f"0{n}") for g in globs for n in range(200)) and len(globs) <= 40
