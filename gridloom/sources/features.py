"""Feature tables: geometry plus attributes, one row per feature.

A feature table has ``fid BIGINT`` (file order, unique within a layer),
``layer``, ``geom_type`` (POINT, LINE or POLYGON), ``rings`` and attributes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import geometry as G
from gridloom.operators.encode import attribute_names, variable_kind

KEYS = ["fid", "layer", "geom_type", "rings"]


def read_features(
    spark: SparkSession,
    path: str,
    layer: str | None = None,
    columns: list[str] | None = None,
    fmt: str = "parquet",
    schema: str | None = None,
) -> DataFrame:
    """Read a feature table; ``layer`` and ``columns`` reach the scan. Text
    formats should be given a schema."""
    reader = spark.read.format(fmt)
    df = (reader.schema(schema) if schema else reader).load(path)
    if layer is not None:
        df = df.where(F.col("layer") == layer)
    return df if columns is None else prune(df, columns)


def prune(features: DataFrame, columns: list[str]) -> DataFrame:
    """Key, geometry and the named attributes only."""
    keys = [k for k in KEYS if k in features.columns]
    return features.select(*keys, *[c for c in columns if c in features.columns and c not in keys])


def list_layers(features: DataFrame) -> DataFrame:
    return features.select("layer").distinct()


def layer_schema(features: DataFrame) -> DataFrame:
    """Attributes of every layer: name, type and how it is put on a grid.

    All layers share the table's schema; an attribute belongs to a layer if
    any of its features has a value for it.
    """
    names = attribute_names(features)
    present = features.groupBy("layer").agg(
        *[F.max(F.col(n).isNotNull()).alias(n) for n in names]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("pos"),
                F.lit(n).alias("variable"),
                F.lit(variable_kind(features.schema[n].dataType)).alias("kind"),
                F.col(n).alias("present"),
            )
            for i, n in enumerate(names)
        ]
    )
    return present.select("layer", F.explode(rows).alias("r")).select("layer", "r.*")


def with_boxes(features: DataFrame) -> DataFrame:
    """Add each feature's box and vertex count, for tables about to be stored.

    Parquet statistics on the box prune scans, and bounds, skew checks and box
    joins then read these columns instead of the geometry.
    """
    r = F.col("rings")
    return features.withColumns(
        {
            **dict(zip(G.BOX_COLUMNS, (G.x_min(r), G.y_min(r), G.x_max(r), G.y_max(r)))),
            G.SIZE_COLUMN: F.size(G.vertices(r)),
        }
    )


def feature_count(features: DataFrame) -> DataFrame:
    return features.groupBy("layer").agg(F.count(F.lit(1)).alias("n"))
