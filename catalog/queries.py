"""One query per operator over the fixtures, flat scalar columns only."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import fixtures as X
from gridloom.functions import geometry as G
from gridloom.functions import values as V
from gridloom.operators import align, encode, grid, lookup, rasterize, tiles, validity, zonal
from gridloom.operators import runs as zonal_runs
from gridloom.plans import check, convert
from gridloom.plans import metadata as M
from gridloom.plans.joins import ensure_checkpoint_dir, settle, store
from gridloom.sources import array_reader, array_store, chunk_store, features, files, rasters, wkt

RESOLUTION = 0.01
TILE = 200
CHUNK = 20
STRIP = 20
AUTO_BYTES = 4096
WEST, SOUTH, EAST, NORTH = 0.0, 0.0, 10.0, 6.0
WKT = 'GEOGCS["WGS 84",AUTHORITY["EPSG","4326"]]'
DAY = "2024-01-01"

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def fresh_path(spark: SparkSession, name: str) -> str:
    """New folder in the session's shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def shown(c: Column | str) -> Column:
    """Text that may be null, with the null spelled out."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c, F.lit("(null)"))


def as_double(*names: str) -> list[Column]:
    return [F.col(n).cast("double").alias(n) for n in names]


def as_long(*names: str) -> list[Column]:
    return [F.col(n).cast("long").alias(n) for n in names]


# -- polygons on their grids ---------------------------------------------------


def polygon_spec(poly: DataFrame) -> DataFrame:
    return grid.grid_spec(grid.layer_bounds(poly), RESOLUTION)


def gridded_polygons(spark, d, *attributes: Column) -> tuple[DataFrame, DataFrame]:
    poly = X.polygons(spark, d)
    spec = settle(polygon_spec(poly))
    wanted = poly.select("fid", "layer", "geom_type", "rings", *attributes)
    return grid.with_grid(wanted, spec, settled=True), spec


def gridded_points(spark, d) -> tuple[DataFrame, DataFrame]:
    pts = X.points(spark, d)
    spec = settle(polygon_spec(pts))
    return grid.with_grid(pts, spec, settled=True), spec


def raster_on_grid(spark, d) -> tuple[DataFrame, grid.RasterGrid]:
    cells = X.raster(spark, d)
    return cells, rasters.raster_grid(cells, WEST, SOUTH, EAST, NORTH)


def raster_class(v: Column) -> Column:
    return F.when(F.isnan(v), v).otherwise(F.floor(v / F.lit(100000.0)).cast("double"))


# -- scans, sources, sinks -----------------------------------------------------


@query
def scan_features(spark, d):
    p = F.col("price")
    return X.polygons(spark, d).select(
        "fid", "layer", "geom_type", shown("category").alias("category"),
        F.when(p.isNull(), "null").when(F.isnan(p), "nan").otherwise("value").alias("price_state"),
        F.coalesce(F.nanvl(p, F.lit(-1.0)), F.lit(-1.0)).alias("price"),
        *as_long("size"),
        F.size(G.vertices(F.col("rings"))).cast("long").alias("n_vertices"),
    )


@query
def parse_wkt(spark, d):
    ring = lambda r: F.concat(
        F.lit("("), F.array_join(F.transform(r, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))), ", "), F.lit(")")
    )
    text = F.concat(F.lit("Polygon ("), F.array_join(F.transform("rings", ring), ","), F.lit(")"))
    parsed = X.polygons(spark, d).select("fid", text.alias("text")).select(
        "fid", wkt.wkt_type(F.col("text")).alias("geom_type"), wkt.wkt_rings(F.col("text")).alias("rings")
    )
    rings = parsed.select("fid", "geom_type", F.posexplode("rings").alias("ring", "r"))
    return rings.select("fid", "geom_type", "ring", F.posexplode("r").alias("pos", "p")).select(
        "fid", "geom_type", *as_long("ring", "pos"), "p.x", "p.y"
    )


@query
def list_layers(spark, d):
    return features.list_layers(X.polygons(spark, d))


@query
def layer_schema(spark, d):
    return features.layer_schema(X.polygons(spark, d)).select(
        "layer", *as_long("pos"), "variable", "kind", F.col("present").cast("long").alias("present")
    )


@query
def scan_pruned(spark, d):
    return features.prune(X.polygons(spark, d), ["size", "unknown"]).select("fid", "layer", *as_long("size"))


@query
def scan_raster(spark, d):
    return X.raster(spark, d).select(*as_long("band", "row", "col"), "value")


@query
def band_info(spark, d):
    names = X.table(spark, d, "region").select(
        (F.col("r_regionkey") + 1).cast("int").alias("band"), F.col("r_name").alias("description")
    )
    return rasters.band_info(X.raster(spark, d), names).select(*as_long("band", "n_cells"), "description")


def _exported_raster(spark, d) -> tuple[str, grid.RasterGrid]:
    """The raster's bands as variables of an exported array store."""
    cells, g = raster_on_grid(spark, d)
    path = fresh_path(spark, "export")
    chunks = align.pack_chunks(cells, ["value"], CHUNK, ["band"]).withColumns(
        {"layer": F.lit("raster"), "var": F.concat(F.lit("value_"), F.col("band"))}
    )
    spec = spark.range(1).select(F.lit("raster").alias("layer")).withColumns(g.columns())
    array_store.write_array_store(chunks.drop("band"), spec, "raster", {"title": "raster"}, path, CHUNK)
    return path, g


@query
def scan_chunks(spark, d):
    """Every band of an exported store, read back."""
    path, _ = _exported_raster(spark, d)
    band = F.substring_index("var", "_", -1).cast("long").alias("band")
    return align.unpack_chunks(array_reader.read_array_chunks(spark, path)).select(band, *as_long("row", "col"), "value")


@query
def scan_chunks_box(spark, d):
    """One band of an exported store inside a box; objects outside are not opened."""
    path, g = _exported_raster(spark, d)
    box = (2.0, 1.0, 8.0, 5.0)
    near = array_reader.read_array_chunks(spark, path, ["value_2"], *lookup.chunk_bounds(g, CHUNK, *box))
    labelled = grid.on_raster(align.unpack_chunks(near), g).withColumn(
        "latitude", grid.latitude_label(F.col("row"))
    ).withColumn("longitude", grid.longitude_label(F.col("col")))
    return lookup.subset_bbox(labelled, *box).select(*as_long("row", "col"), "latitude", "longitude", "value")


@query
def scan_axes(spark, d):
    """Axis labels of an exported store; latitudes ascend."""
    path, _ = _exported_raster(spark, d)
    return array_reader.read_axes(spark, path)


@query
def write_chunks(spark, d):
    chunks = _raster_chunks(spark, d)
    path = fresh_path(spark, "store")
    layers = chunks.select("layer").distinct()
    chunk_store.write_chunks(chunks, M.crs_metadata(layers, ["value"], WKT), path)
    cells = convert.read_cells(spark, path)
    return cells.select("layer", "var", *as_long("row", "col"), *as_double("value"))


def _raster_chunks(spark, d) -> DataFrame:
    cells = X.raster(spark, d).withColumn("value", F.col("value").cast("float"))
    return align.pack_chunks(cells, ["value"], CHUNK, ["band"]).withColumns(
        {"layer": F.lit("raster"), "var": F.concat(F.lit("value_"), F.col("band"))}
    ).drop("band")


@query
def write_array_store(spark, d):
    """Export, then decode every written object on the executors."""
    cells, g = raster_on_grid(spark, d)
    spec = spark.range(1).select(F.lit("raster").alias("layer")).withColumns(g.columns())
    path = fresh_path(spark, "arrays")
    # a full export first, then the real one over it: only the second may be left
    full = align.pack_chunks(cells.withColumn("value", F.lit(1.0)), ["value"], CHUNK, ["band"]).withColumns(
        {"layer": F.lit("raster"), "var": F.concat(F.lit("value_"), F.col("band"))}
    )
    array_store.write_array_store(full.drop("band"), spec, "raster", {}, path, CHUNK)
    array_store.write_array_store(
        _raster_chunks(spark, d), spec, "raster", {"title": "raster"}, path, CHUNK
    )
    objects = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", "[0-9]*.[0-9]*").load(path).select("path", "content")
    )

    def decode(batches):
        import numpy as np
        import pandas as pd

        for pdf in batches:
            for name, content in zip(pdf["path"], pdf["content"]):
                array, key = name.split("/")[-2:]
                cr, cc = (int(k) for k in key.split("."))
                block = np.frombuffer(content, "<f4").reshape(CHUNK, CHUNK)
                r, c = np.nonzero(block)
                yield pd.DataFrame(
                    {"var": array, "row": r + cr * CHUNK, "col": c + cc * CHUNK, "value": block[r, c].astype("f8")}
                )

    return objects.mapInPandas(decode, "var string, row bigint, col bigint, value double")


@query
def export_encoding(spark, d):
    """Codes of every part's name, exported as objects and read back."""
    named = X.table(spark, d, "part").select(
        F.lit("parts").alias("layer"), F.lit("name").alias("var"), F.concat_ws(" ", "p_name", "p_partkey").alias("category"),
        F.col("p_partkey").cast("long").alias("code"),
    )
    spec = spark.range(1).select(F.lit("parts").alias("layer")).withColumns(raster_on_grid(spark, d)[1].columns())
    path = fresh_path(spark, "encoding")
    chunk = spark.range(1).select(
        F.lit("parts").alias("layer"), F.lit("name").alias("var"), F.lit(0).cast("long").alias("chunk_row"),
        F.lit(0).cast("long").alias("chunk_col"), F.lit(CHUNK).alias("chunk"), F.array(F.lit(0)).alias("pos"),
        F.array(F.lit(1.0).cast("float")).alias("vals"),
    )
    rows = M.encoding_metadata(named)
    array_store.write_array_store(chunk, spec, "parts", {}, path, CHUNK, encodings=M.encoding_rows(rows, "parts"))
    return array_store.read_encoding(spark, path, "name").select("code", "category")


@query
def stack_bands(spark, d):
    """Each band staged as one strip, read again and stacked."""
    g = raster_on_grid(spark, d)[1]
    path = fresh_path(spark, "strips")
    chunk_store.write_chunks(
        _raster_chunks(spark, d), M.crs_metadata(spark.range(1).select(F.lit("raster").alias("layer")), ["value"], WKT), path
    )
    strips = [
        (convert.read_cells(spark, path, variables=[f"value_{b}"]).drop("layer", "var"), (b - 1) * g.ny)
        for b in (1, 2, 3)
    ]
    return tiles.stack(strips).select(*as_long("row", "col"), *as_double("value"))


@query
def match_files(spark, d):
    hit = files.match_paths(X.table(spark, d, "pages"), "url", ".html")
    return hit.select("page_id", files.base_name(F.col("url")).alias("name"))


# -- projections, filters, predicates ------------------------------------------


@query
def select_variables(spark, d):
    poly = X.polygons(spark, d)
    names = encode.select_variables(poly, ["size", "unknown", "price"])
    picked = poly.select("layer", "fid", *names)
    return picked.select("layer", "fid", *as_long("size"), V.nan_to_zero(F.col("price")).cast("double").alias("price"))


@query
def clean_basic(spark, d):
    return X.polygons(spark, d).select("fid", shown(V.clean_basic(F.col("category"))).alias("category"))


@query
def clean_zero(spark, d):
    return X.polygons(spark, d).select("fid", shown(V.clean_zero(F.col("category"))).alias("category"))


@query
def clean_strip(spark, d):
    return X.polygons(spark, d).select("fid", shown(V.clean_strip(F.col("category"))).alias("category"))


@query
def fill_category(spark, d):
    return X.polygons(spark, d).select("fid", V.category(F.col("category")).alias("category"))


@query
def cast_numeric(spark, d):
    p = F.col("price")
    return X.polygons(spark, d).select(
        "fid",
        V.to_float32(p).cast("double").alias("price"),
        V.to_float32(p, "zero").cast("double").alias("price_zero"),
        V.to_float32(F.col("size")).cast("double").alias("size"),
    )


@query
def nan_to_zero(spark, d):
    return X.polygons(spark, d).select("fid", V.nan_to_zero(F.col("price").cast("float")).cast("double").alias("price"))


@query
def classify_columns(spark, d):
    poly = X.polygons(spark, d)
    kinds = encode.variable_kinds(poly)
    entry = lambda v, k: F.struct(F.lit(v).alias("variable"), F.lit(k).alias("kind"), F.col(v).alias("n_values"))
    counts = poly.groupBy("layer").agg(*[F.count(v).alias(v) for v in kinds])
    return counts.select("layer", F.explode(F.array(*[entry(v, k) for v, k in kinds.items()])).alias("s")).select(
        "layer", "s.*"
    )


@query
def valid_geometries(spark, d):
    return validity.valid_geometries(X.polygons(spark, d)).select("layer", "fid")


@query
def mask_equals(spark, d):
    g, _ = gridded_polygons(spark, d, V.to_float32(F.col("size")).alias("size"))
    cells = rasterize.polygon_cells(g, ["size"])
    return lookup.mask_equals(cells, "size", 2.0).select("layer", *as_long("row", "col"))


@query
def mask_valid(spark, d):
    return lookup.mask_valid(X.raster(spark, d), "value").select(*as_long("band", "row", "col"))


@query
def rename_dims(spark, d):
    cells, g = raster_on_grid(spark, d)
    placed = grid.on_raster(cells, g)
    xy = placed.withColumn("x", grid.longitude_label(F.col("col"), "centers")).withColumn(
        "y", grid.latitude_label(F.col("row"), "centers")
    )
    named = lookup.rename_dims(xy, {"x": "longitude", "y": "latitude", "value": "depth_ratio"})
    return named.select(*as_long("band"), "latitude", "longitude", "depth_ratio")


@query
def select_band(spark, d):
    return lookup.select_band(X.raster(spark, d), 1).select(*as_long("row", "col"), "value")


@query
def lookup_label(spark, d):
    cells, g = raster_on_grid(spark, d)
    labelled = grid.on_raster(cells, g).withColumn(
        "latitude", grid.latitude_label(F.col("row"), "centers")
    ).withColumn("longitude", grid.longitude_label(F.col("col"), "centers"))
    north = F.lit(NORTH) - (F.lit(3) + F.lit(0.5)) * F.lit(g.dy)
    east = F.lit(WEST) + (F.lit(7) + F.lit(0.5)) * F.lit(g.dx)
    return lookup.lookup_label(labelled, north, east).select(*as_long("band", "row", "col"), "value")


@query
def lookup_position(spark, d):
    """Positions are gathered by chunk and looked up in a stored band."""
    chunks, g = _stored_bands(spark, d, ["value_1"])
    p = F.col("rings")[0][0]
    at = X.points(spark, d).select("fid", p["x"].alias("lon"), p["y"].alias("lat"))
    found = zonal_runs.positions_in_chunks(at, chunks.drop("band"), g, CHUNK)
    return found.select("fid", *as_long("row", "col"), "value")


@query
def subset_bbox(spark, d):
    """Chunks outside the box are left out before unpacking."""
    box = (2.0, 1.0, 8.0, 5.0)
    cells, g = raster_on_grid(spark, d)
    packed = align.pack_chunks(cells, ["value"], CHUNK, ["band"])
    near = align.unpack_chunks(packed.where(lookup.chunk_window(g, CHUNK, *box)))
    labelled = grid.on_raster(near, g).withColumn(
        "latitude", grid.latitude_label(F.col("row"))
    ).withColumn("longitude", grid.longitude_label(F.col("col")))
    return lookup.subset_bbox(labelled, *box).select(
        *as_long("band", "row", "col"), "latitude", "longitude"
    )


@query
def assign_coords(spark, d):
    g, spec = gridded_points(spark, d)
    cells = rasterize.last_wins(rasterize.burn_points(g), [])
    return grid.assign_coords(cells, spec).select("layer", *as_long("row", "col"), "latitude", "longitude")


# -- joins -----------------------------------------------------------------------


@query
def tile_join(spark, d):
    g, _ = gridded_polygons(spark, d)
    return tiles.tile_pairs(g, TILE).select("layer", "fid", *as_long("tile_row", "tile_col", "tile_seq"))


@query
def rasterize_polygons(spark, d):
    g, _ = gridded_polygons(spark, d)
    return rasterize.burn_polygons(g).select("layer", "fid", *as_long("row", "col"))


@query
def rasterize_points(spark, d):
    g, _ = gridded_points(spark, d)
    return rasterize.burn_points(g).select("layer", "fid", *as_long("row", "col"), "value")


@query
def rasterize_lines(spark, d):
    lines = X.lines(spark, d)
    g = grid.with_grid(lines, polygon_spec(lines))
    return rasterize.burn_lines(g).select("fid", *as_long("row", "col"))


@query
def rasterize_lines_touched(spark, d):
    """Every cell a line enters, as spans of columns."""
    lines = X.lines(spark, d)
    g = grid.with_grid(lines, polygon_spec(lines))
    return rasterize.touched_spans(g).select("fid", *as_long("row", "c0", "c1"))


@query
def apply_codes(spark, d):
    poly = X.polygons(spark, d)
    codes = encode.codes_first_seen(poly, ["category"])
    coded = encode.apply_codes(poly, codes, ["category"])
    return coded.select("layer", "fid", F.col("category").cast("double").alias("code"))


def _shifted_band(cells: DataFrame, g: grid.RasterGrid, band: int, name: str, shift: float) -> DataFrame:
    label = lambda v: F.rint(v * F.lit(1e4)) / F.lit(1e4)
    return grid.on_raster(lookup.select_band(cells, band), g).select(
        label(grid.latitude_label(F.col("row"), "centers")).alias("latitude"),
        label(grid.longitude_label(F.col("col"), "centers") + F.lit(shift)).alias("longitude"),
        F.col("value").alias(name),
    )


def _three_datasets(spark, d) -> list[DataFrame]:
    cells, g = raster_on_grid(spark, d)
    return [
        _shifted_band(cells, g, 1, "first", 0.0),
        _shifted_band(cells, g, 2, "second", 1.0),
        _shifted_band(cells, g, 3, "first", 2.0),
    ]


@query
def merge_outer(spark, d):
    return align.merge_outer(_three_datasets(spark, d))


@query
def merge_variables(spark, d):
    poly = X.polygons(spark, d)
    encoded, _ = encode.encode(poly, ["category", "price", "size"])
    cells = rasterize.burn(grid.with_grid(encoded, polygon_spec(poly)), ["category", "price", "size"], ["POLYGON"])
    return cells.select("layer", *as_long("row", "col"), *as_double("category", "price", "size"))


@query
def features_in_circle(spark, d):
    hits = zonal.features_in_circle(X.zones(spark, d), X.polygons(spark, d))
    return hits.select("zone_id", "layer", "fid")


def _stored_bands(spark, d, variables: list[str] | None = None) -> tuple[DataFrame, grid.RasterGrid]:
    """Chunks of the stored raster with their band."""
    _, g = raster_on_grid(spark, d)
    chunks = chunk_store.read_chunks(spark, X.raster_store(spark, d, CHUNK), "raster", variables)
    return chunks.withColumn("band", F.substring_index("var", "_", -1).cast("long")).drop("layer", "var"), g


@query
def cells_in_zone(spark, d):
    """Zones meet the chunks of a stored raster; cells come out, but do not move."""
    chunks, g = _stored_bands(spark, d)
    inside = zonal_runs.cells_in_zone(zonal.circle_zones(X.zones(spark, d)), chunks, g, CHUNK)
    return inside.select("zone_id", *as_long("band", "row", "col"))


@query
def compare_stores(spark, d):
    source = X.raster(spark, d)
    stored = align.unpack_chunks(
        align.pack_chunks(source.withColumn("value", F.col("value").cast("float")), ["value"], CHUNK, ["band"])
    )
    keyed = source.select("band", *as_long("row", "col"), "value")
    return check.compare_cells(stored, keyed, ["band", "row", "col"]).select(
        *as_long("band", "row", "col"), *as_double("store_value", "source_value"),
        F.col("is_close").cast("long").alias("is_close"),
    )


# -- aggregations ----------------------------------------------------------------


@query
def layer_bounds(spark, d):
    return grid.layer_bounds(X.polygons(spark, d))


@query
def distinct_categories(spark, d):
    return encode.categories(X.polygons(spark, d), ["category"]).select("layer", "category", "first_fid")


@query
def burn_replace(spark, d):
    g, _ = gridded_polygons(spark, d)
    return rasterize.swept_cells(g, []).select("layer", *as_long("row", "col"), "fid")


def _raster_labels(spark, d) -> DataFrame:
    cells, g = raster_on_grid(spark, d)
    spec = cells.select(F.col("band").cast("string").alias("layer")).distinct().withColumns(g.columns())
    return grid.axis_labels(spec)


@query
def axis_extent(spark, d):
    return M.axis_extent(_raster_labels(spark, d))


@query
def axis_step(spark, d):
    return M.axis_step(M.axis_extent(_raster_labels(spark, d))).select("layer", "axis", "step")


@query
def variable_max(spark, d):
    return lookup.variable_max(X.raster(spark, d), "value", ["band"]).select(*as_long("band"), "max_value")


@query
def strip_max(spark, d):
    return tiles.strip_max(X.raster(spark, d), "value", STRIP, ["band"]).select(*as_long("band", "strip"), "max_value")


@query
def majority_features(spark, d):
    """Most frequent size among the features each disc meets."""
    sized = X.polygons(spark, d).withColumn("size", F.col("size").cast("double"))
    return zonal.majority_in_circle(X.zones(spark, d), sized, ["zone_id"], "size")


@query
def zonal_majority(spark, d):
    """Most frequent class in each zone, from the counts each chunk passes on."""
    chunks, g = _stored_bands(spark, d)
    classes = chunks.withColumn("vals", F.transform("vals", raster_class))
    counts = zonal_runs.zonal_counts(zonal.circle_zones(X.zones(spark, d)), classes, g, CHUNK, ["band"])
    return zonal.most_frequent(counts, ["zone_id", "band"], nodata=0.0).select(
        "zone_id", *as_long("band"), "majority", "n"
    )


@query
def feature_count(spark, d):
    return features.feature_count(X.points(spark, d))


@query
def densify(spark, d):
    cells, g = raster_on_grid(spark, d)
    spec = cells.select(F.col("band").cast("string").alias("layer")).distinct().withColumns(g.columns())
    sparse = cells.where(F.col("value") > 250000).withColumn("layer", F.col("band").cast("string"))
    return align.densify(sparse, spec, ["value"]).select("layer", *as_long("row", "col"), "value")


@query
def pack_chunks(spark, d):
    packed = align.pack_chunks(X.raster(spark, d), ["value"], CHUNK, ["band"])
    wider = align.rechunk(packed, 2 * CHUNK, ["band"])
    return wider.select(
        "band", "chunk_row", "chunk_col", F.explode(F.arrays_zip(F.col("pos").alias("pos"), F.col("vals").alias("value"))).alias("c")
    ).select(*as_long("band", "chunk_row", "chunk_col"), F.col("c.pos").cast("long").alias("pos"), "c.value")


@query
def pack_chunks_auto(spark, d):
    """Chunks of a size that follows the cells' width, their density and the grid."""
    cells, g = raster_on_grid(spark, d)
    spec = spark.range(1).select(F.lit("raster").alias("layer")).withColumns(g.columns())
    packed = align.pack_chunks(cells, ["value"], "auto", ["band"], spec=spec, target_bytes=AUTO_BYTES)
    return packed.select(
        *as_long("band", "chunk", "chunk_row", "chunk_col"), F.explode(F.arrays_zip(F.col("pos").alias("pos"), F.col("vals").alias("value"))).alias("c")
    ).select("band", "chunk", "chunk_row", "chunk_col", F.col("c.pos").cast("long").alias("pos"), "c.value")


@query
def category_map(spark, d):
    maps = encode.category_map(encode.codes_first_seen(X.polygons(spark, d), ["category"]), part_size=10)
    return maps.select("layer", "var", F.explode("encoding").alias("category", "code"))


@query
def infer_resolution(spark, d):
    cells, g = raster_on_grid(spark, d)
    return grid.infer_resolution(
        grid.on_raster(cells, g).select(grid.latitude_label(F.col("row")).alias("latitude"))
    )


# -- numbering, sorts, limits ------------------------------------------------------


@query
def codes_first_seen(spark, d):
    return encode.codes_first_seen(X.polygons(spark, d), ["category"]).select("layer", "category", "code")


@query
def codes_sorted(spark, d):
    return encode.codes_sorted(X.polygons(spark, d), ["category"]).select("layer", "category", "code")


@query
def codes_by_tile(spark, d):
    g, _ = gridded_polygons(spark, d, F.col("category"))
    return encode.codes_by_tile(g, ["category"], TILE).select("layer", "category", "code")


@query
def index_matches(spark, d):
    valid = lookup.mask_valid(X.raster(spark, d), "value")
    return lookup.index_matches(valid, ["band"]).select(*as_long("band", "row", "col", "match"))


@query
def sort_latitude(spark, d):
    cells, g = raster_on_grid(spark, d)
    return grid.ascending_rows(cells, F.lit(g.ny)).select(*as_long("band", "row", "col"), "value")


@query
def sample_cell(spark, d):
    """One cell of all bands for each of several seeds."""
    valid = lookup.mask_valid(X.raster(spark, d), "value")
    picks = [
        lookup.sample_cell(valid, seed, ("band", "row", "col")).select(
            F.lit(seed).cast("long").alias("seed"), *as_long("band", "row", "col"), "value"
        )
        for seed in (0, 7, 8)
    ]
    return picks[0].unionByName(picks[1]).unionByName(picks[2])


# -- set operations ------------------------------------------------------------------


@query
def concat_tiles(spark, d):
    cells, g = raster_on_grid(spark, d)
    blocks = [(lookup.select_band(cells, b).drop("band"), (b - 1) * g.nx) for b in (1, 2, 3)]
    return tiles.beside(blocks).select(*as_long("row", "col"), "value")


@query
def concat_strips(spark, d):
    cells, g = raster_on_grid(spark, d)
    strips = [(lookup.select_band(cells, b).drop("band"), (b - 1) * g.ny) for b in (1, 2, 3)]
    return tiles.stack(strips).select(*as_long("row", "col"), "value")


@query
def union_axes(spark, d):
    datasets = _three_datasets(spark, d)
    axis = lambda name: align.union_axes(datasets, name).select(F.lit(name).alias("axis"), F.col(name).alias("label"))
    return axis("latitude").unionByName(axis("longitude"))


# -- grid functions --------------------------------------------------------------------


@query
def grid_spec(spark, d):
    return polygon_spec(X.polygons(spark, d)).select(
        "layer", "lon_min", "lat_min", "lon_max", "lat_max", *as_long("nx", "ny"), "dx", "dy"
    )


@query
def axis_labels(spark, d):
    return grid.axis_labels(polygon_spec(X.polygons(spark, d)))


@query
def tile_grid(spark, d):
    return grid.tile_grid(polygon_spec(X.polygons(spark, d)), TILE)


@query
def circle_zone(spark, d):
    zones = zonal.circle_zones(X.zones(spark, d))
    return zones.select("zone_id", F.posexplode(F.col("rings")[0]).alias("pos", "p")).select(
        "zone_id", *as_long("pos"),
        (F.rint(F.col("p.x") * F.lit(1e9)) / F.lit(1e9)).alias("x"),
        (F.rint(F.col("p.y") * F.lit(1e9)) / F.lit(1e9)).alias("y"),
    )


@query
def values_close(spark, d):
    near = F.col("value") * (F.lit(1.0) + (F.col("col") % 4).cast("double") * F.lit(4e-6))
    return X.raster(spark, d).select(
        *as_long("band", "row", "col"), V.values_close(F.col("value"), near).cast("long").alias("is_close")
    )


@query
def title_of(spark, d):
    return X.table(spark, d, "pages").select("page_id", V.title_of(F.col("url")).alias("title"))


@query
def provenance(spark, d):
    pages = X.table(spark, d, "pages")
    return pages.select("page_id", V.provenance(V.title_of(F.col("url")), F.col("url"), F.lit(DAY)).alias("history"))


# -- metadata and quality ----------------------------------------------------------------


def _attributes(rows: DataFrame) -> DataFrame:
    return rows.select(
        "layer", "scope", "key", *as_long("pos"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce("number", F.lit(-1.0)).alias("number"),
    )


@query
def axis_metadata(spark, d):
    return _attributes(M.axis_metadata(grid.axis_labels(polygon_spec(X.polygons(spark, d)))))


@query
def dataset_metadata(spark, d):
    labels = grid.axis_labels(polygon_spec(X.polygons(spark, d)))
    rows = M.dataset_metadata(labels, F.concat(F.lit("parts_"), F.col("layer")), "file:///parts.zip", DAY, RESOLUTION)
    return _attributes(rows)


@query
def crs_metadata(spark, d):
    layers = features.list_layers(X.polygons(spark, d))
    return _attributes(M.crs_metadata(layers, ["category", "price", "size"], WKT))


@query
def variable_metadata(spark, d):
    poly = X.polygons(spark, d)
    names = encode.attribute_names(poly)
    bands = rasters.band_info(
        X.raster(spark, d),
        X.table(spark, d, "region").select(
            (F.col("r_regionkey") + 1).cast("int").alias("band"), F.col("r_name").alias("description")
        ),
    )
    return _attributes(
        M.variable_metadata(features.list_layers(poly), names).unionByName(M.band_metadata(bands, "raster"))
    )


@query
def variable_status(spark, d):
    poly = X.polygons(spark, d).withColumn("tags", F.array(F.col("category")))
    empty = F.when(F.col("layer") == "PROMO", F.lit(None)).otherwise(F.col("size"))
    return M.variable_status(
        poly.withColumn("partial", empty), ["category", "price", "size", "partial", "tags", "unknown"]
    )


@query
def check_conversion(spark, d):
    g, spec = gridded_polygons(spark, d, V.to_float32(F.col("size")).alias("size"))
    cells = store(rasterize.swept_cells(g, ["size"]))
    report = check.check_conversion(X.polygons(spark, d), cells, spec, "size", target=F.col("size") == 20)
    flag = lambda n: F.col(n).cast("long").alias(n)
    return report.select(
        "layer", "source_max", "grid_max", flag("same_max"), "latitude", "longitude", "cell_value",
        F.coalesce("majority", F.lit(-1.0)).alias("majority"), flag("agrees"),
    )


# -- whole conversions -------------------------------------------------------------------


def category_grid(spark: SparkSession, d: str) -> DataFrame:
    """Which category covers each cell: bounds, codes, burn, last feature wins."""
    gridded = convert.grid_features(X.polygons(spark, d), RESOLUTION, ["category"])
    return gridded.cells.select("layer", *as_long("row", "col"), F.col("category").cast("double").alias("code"))


@query
def convert_layers(spark, d):
    return category_grid(spark, d)


@query
def convert_layers_tiled(spark, d):
    """Tiled flow, packed into chunks and read back."""
    gridded = convert.grid_features_tiled(
        X.polygons(spark, d), RESOLUTION, tile=TILE, chunk=100, variables=["category", "price", "size"]
    )
    cells = align.unpack_chunks(gridded.chunks())
    return cells.select("layer", "var", *as_long("row", "col"), *as_double("value"))


@query
def convert_raster(spark, d):
    cells, g = raster_on_grid(spark, d)
    path = fresh_path(spark, "raster")
    convert.write_raster(cells, g, "depth_ratio", CHUNK, "raster", "orders", "file:///orders.zip", path, day=DAY)
    return convert.read_cells(spark, path).select("layer", "var", *as_long("row", "col"), "value")
