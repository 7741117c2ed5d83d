"""Feature and raster tables derived from the test tables (see FIXTURES.md)."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridloom.functions.geometry import RINGS_TYPE, vertex
from gridloom.operators.align import pack_chunks
from gridloom.plans.joins import ensure_checkpoint_dir
from gridloom.sources.chunk_store import write_chunks
from gridloom.sources.features import with_boxes

_STORED: dict[tuple[str, str, str], tuple[str, StructType]] = {}


def raster_store(spark: SparkSession, sf_dir: str, chunk: int) -> str:
    """The raster as a stored dataset, a variable ``value_<band>`` for each band.

    Written once per application, into the shared checkpoint folder.
    """
    ensure_checkpoint_dir(spark)
    sc = spark.sparkContext
    key = (sc.applicationId, sf_dir, f"raster-{chunk}")
    if key not in _STORED or not _exists(spark, _STORED[key][0]):
        path = f"{sc.getCheckpointDir()}/raster-{uuid.uuid4().hex}"
        chunks = pack_chunks(raster(spark, sf_dir), ["value"], chunk, ["band"]).withColumns(
            {"layer": F.lit("raster"), "var": F.concat(F.lit("value_"), F.col("band"))}
        )
        write_chunks(chunks.drop("band"), spark.range(1).select(F.lit("raster").alias("layer")), path)
        _STORED[key] = (path, chunks.schema)
    return _STORED[key][0]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _stored(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A feature table as a user would have it: written with boxes, then read.

    Written once per application, into the shared checkpoint folder.
    """
    ensure_checkpoint_dir(spark)
    sc = spark.sparkContext
    key = (sc.applicationId, sf_dir, name)
    if key not in _STORED or not _exists(spark, _STORED[key][0]):
        path = f"{sc.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
        table = with_boxes(build()).repartition(sc.defaultParallelism, "fid")
        table.write.parquet(path)
        _STORED[key] = (path, table.schema)
    path, schema = _STORED[key]
    return spark.read.schema(schema).parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "polygons", lambda: derive_polygons(spark, sf_dir))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "points", lambda: derive_points(spark, sf_dir))


def _hundredths(key: Column, factor: int, modulus: int) -> Column:
    return ((key * factor) % modulus).cast("double") / F.lit(100.0)


def derive_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    w = F.col("p_size").cast("double") / F.lit(100.0)
    x0, y0 = _hundredths(key, 37, 1000), _hundredths(key, 61, 600)
    at = lambda ax, bx, ay, by: vertex(x0 + w * ax / bx, y0 + w * ay / by)
    ring = lambda *corners: F.array(*[at(*c) for c in corners])
    # corners as (x numerator, x denominator, y numerator, y denominator) of w
    triangle = ring((0, 1, 0, 1), (1, 1, 1, 3), (1, 4, 1, 1), (0, 1, 0, 1))
    box = ring((0, 1, 0, 1), (1, 1, 0, 1), (1, 1, 1, 1), (0, 1, 1, 1), (0, 1, 0, 1))
    hole = ring((1, 4, 1, 4), (3, 4, 1, 4), (3, 4, 3, 4), (1, 4, 3, 4), (1, 4, 1, 4))
    flat = ring((0, 1, 0, 1), (1, 1, 0, 1), (1, 2, 0, 1), (0, 1, 0, 1))
    bow = ring((0, 1, 0, 1), (1, 1, 1, 1), (1, 1, 0, 1), (0, 1, 1, 2), (0, 1, 0, 1))
    rings = (
        F.when(key % 17 == 0, F.array(flat))
        .when(key % 19 == 0, F.array(bow))
        .when(key % 4 == 1, F.array(box))
        .when(key % 4 == 2, F.array(box, hole))
        .otherwise(F.array(triangle))
    )
    category = (
        F.when(key % 11 == 0, F.lit(""))
        .when(key % 11 == 1, F.lit(" "))
        .when(key % 11 == 2, F.lit("0"))
        .when(key % 11 == 3, F.lit("nan"))
        .when(key % 11 == 4, F.lit(None).cast("string"))
        .when(key % 11 == 5, F.lit("   "))
        .otherwise(F.col("p_brand"))
    )
    price = (
        F.when(key % 13 == 0, F.lit(None).cast("double"))
        .when(key % 13 == 1, F.lit(float("nan")))
        .otherwise(F.col("p_retailprice"))
    )
    return part.select(
        key.alias("fid"),
        F.col("p_type").alias("layer"),
        F.lit("POLYGON").alias("geom_type"),
        rings.cast(RINGS_TYPE).alias("rings"),
        category.alias("category"),
        price.alias("price"),
        F.col("p_size").cast("int").alias("size"),
    )


def derive_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    lon = ((F.col("user_id") * 37 + F.col("event_id") * 13) % 1000).cast("double") / F.lit(100.0)
    lat = ((F.col("user_id") * 61 + F.col("event_id") * 7) % 600).cast("double") / F.lit(100.0)
    return e.select(
        F.col("event_id").alias("fid"),
        F.col("event_type").alias("layer"),
        F.lit("POINT").alias("geom_type"),
        F.array(F.array(vertex(lon, lat))).cast(RINGS_TYPE).alias("rings"),
        F.col("event_type").alias("category"),
        F.col("value"),
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    rings = F.array(
        F.array(
            vertex(_hundredths(k, 37, 1000), _hundredths(k, 61, 600)),
            vertex(_hundredths(k, 53, 1000), _hundredths(k, 29, 600)),
        )
    )
    return s.select(
        k.alias("fid"),
        F.concat(F.lit("lines_"), (k % 2).cast("string")).alias("layer"),
        F.lit("LINE").alias("geom_type"),
        rings.cast(RINGS_TYPE).alias("rings"),
        F.col("s_acctbal").alias("value"),
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select(
        k.alias("zone_id"),
        _hundredths(k, 37, 1000).alias("cx"),
        _hundredths(k, 61, 600).alias("cy"),
        F.lit(0.1).alias("radius"),
    )


def raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    k = F.floor(key / F.lit(3))
    return o.select(
        (key % 3 + 1).cast("int").alias("band"),
        F.floor(k / F.lit(50)).cast("int").alias("row"),
        (k % 50).cast("int").alias("col"),
        F.when(key % 17 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice")).alias("value"),
    )
