"""Dataset, axis and variable attributes as rows.

Every attribute is ``(layer, scope, key, pos, text, number)``; a list has one
row per element, numbered by ``pos``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions import values as V
from gridloom.operators.encode import variable_kind

ATTRIBUTE = "struct<scope:string,key:string,pos:int,text:string,number:double>"

# Attribute names and values of the climate-and-forecast convention.
AXES = {
    "latitude": {"_CoordinateAxisType": "Lat", "axis": "Y", "long_name": "latitude",
                 "standard_name": "latitude", "units": "degrees_north"},
    "longitude": {"_CoordinateAxisType": "Lon", "axis": "X", "long_name": "longitude",
                  "standard_name": "longitude", "units": "degrees_east"},
}
GEOMETRY_TYPES = ("POLYGON", "LINE", "POINT")
CONVENTIONS = "CF-1.8"
DEFAULT_EPSG = 4326


def _text(scope, key: str, value, pos: int = 0) -> Column:
    value = value if isinstance(value, Column) else F.lit(value)
    scope = scope if isinstance(scope, Column) else F.lit(scope)
    return F.struct(scope, F.lit(key), F.lit(pos), value.cast("string"), F.lit(None).cast("double")).cast(ATTRIBUTE)


def _number(scope: str, key: str, value: Column, pos: int = 0) -> Column:
    return F.struct(F.lit(scope), F.lit(key), F.lit(pos), F.lit(None).cast("string"), value.cast("double")).cast(ATTRIBUTE)


def _rows(df: DataFrame, attributes: list[Column]) -> DataFrame:
    return df.select("layer", F.explode(F.array(*attributes)).alias("a")).select("layer", "a.*")


def axis_extent(labels: DataFrame) -> DataFrame:
    """Smallest and largest label and their number, per layer and axis."""
    return labels.groupBy("layer", "axis").agg(
        F.min("label").alias("min_label"), F.max("label").alias("max_label"), F.count(F.lit(1)).alias("n")
    )


def axis_step(extent: DataFrame) -> DataFrame:
    """Extent divided by the number of labels (not by the gaps between them)."""
    return extent.withColumn(
        "step", F.coalesce(F.try_divide(F.col("max_label") - F.col("min_label"), F.col("n")), F.lit(0.0))
    )


def axis_metadata(labels: DataFrame) -> DataFrame:
    """Attributes of both axes of every layer."""
    stepped = axis_step(axis_extent(labels))
    parts = None
    for axis, fixed in AXES.items():
        attributes = [_text(axis, k, v) for k, v in fixed.items()] + [
            _number(axis, "max", F.col("max_label")),
            _number(axis, "min", F.col("min_label")),
            _number(axis, "step", F.col("step")),
        ]
        rows = _rows(stepped.where(F.col("axis") == axis), attributes)
        parts = rows if parts is None else parts.unionByName(rows)
    return parts


def dataset_metadata(
    labels: DataFrame,
    title: Column | str,
    url: Column | str,
    day: str,
    resolution: float | None = None,
    epsg: int = DEFAULT_EPSG,
) -> DataFrame:
    """Attributes of the dataset of each layer: reference system, title, extent,
    conventions, provenance and, if given, resolution.

    Provenance is given under all the names in use: ``History``, ``history`` and
    ``Comment``.
    """
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    origin = V.provenance(as_col(title), as_col(url), F.lit(day))
    lat, lon = F.col("axis") == "latitude", F.col("axis") == "longitude"
    extent = labels.groupBy("layer").agg(
        F.min(F.when(lon, F.col("label"))).alias("west"),
        F.min(F.when(lat, F.col("label"))).alias("south"),
        F.max(F.when(lon, F.col("label"))).alias("east"),
        F.max(F.when(lat, F.col("label"))).alias("north"),
    )
    sides = ["west", "south", "east", "north"]
    attributes = [
        _number("dataset", "proj:epsg", F.lit(int(epsg))),
        _text("dataset", "title", as_col(title)),
        *[_number("dataset", "geographical_extent", F.col(s), i) for i, s in enumerate(sides)],
        _text("dataset", "Conventions", CONVENTIONS),
        _text("dataset", "History", origin),
        _text("dataset", "history", F.concat(F.lit("Converted on "), F.lit(day))),
        _text("dataset", "Comment", origin),
        _number("dataset", "geospatial_lat_min", F.col("south")),
        _number("dataset", "geospatial_lat_max", F.col("north")),
        _number("dataset", "geospatial_lon_min", F.col("west")),
        _number("dataset", "geospatial_lon_max", F.col("east")),
    ]
    if resolution is not None:
        attributes.append(_number("dataset", "resolution", F.lit(float(resolution))))
    return _rows(extent, attributes)


def crs_metadata(layers: DataFrame, variables: list[str], wkt: str) -> DataFrame:
    """The reference system's text on each variable of each layer."""
    return _rows(layers.select("layer"), [_text(v, "_CRS", wkt) for v in variables])


def variable_metadata(layers: DataFrame, variables: list[str]) -> DataFrame:
    """Names: the dataset's variable list and each variable's standard name."""
    attributes = [_text("dataset", "variables", v, i) for i, v in enumerate(variables)]
    attributes += [_text(v, "standard_name", v) for v in variables]
    return _rows(layers.select("layer"), attributes)


def band_metadata(bands: DataFrame, layer: str) -> DataFrame:
    """Number of bands and their descriptions in band order."""
    count = bands.agg(F.count(F.lit(1)).alias("n")).withColumn("layer", F.lit(layer))
    described = bands.select(
        F.lit(layer).alias("layer"),
        F.lit("dataset").alias("scope"),
        F.lit("band_descriptions").alias("key"),
        (F.col("band") - 1).cast("int").alias("pos"),
        F.coalesce("description", F.lit("")).alias("text"),
        F.lit(None).cast("double").alias("number"),
    )
    return _rows(count, [_number("dataset", "band_count", F.col("n"))]).unionByName(described)


def encoding_metadata(codes: DataFrame) -> DataFrame:
    """Category codes as rows, one per category, numbered by code."""
    return codes.select(
        "layer",
        F.col("var").alias("scope"),
        F.lit("categorical_encoding").alias("key"),
        F.col("code").cast("int").alias("pos"),
        F.col("category").alias("text"),
        F.col("code").cast("double").alias("number"),
    )


def variable_status(features: DataFrame, wanted: list[str]) -> DataFrame:
    """What happens to each wanted variable in each layer, and why.

    ``converted``; ``skipped`` when the attribute does not exist, cannot be put
    on a grid or has no value in that layer. ``n_dropped`` counts the layer's
    features whose geometry type cannot be burned; they are on no grid.
    """
    known = {v: variable_kind(features.schema[v].dataType) for v in wanted if v in features.columns}
    burned = F.col("geom_type").isin(*GEOMETRY_TYPES) if "geom_type" in features.columns else F.lit(True)
    lost = F.count(F.when(~F.coalesce(burned, F.lit(False)), 1))
    counts = features.groupBy("layer").agg(
        F.count(F.lit(1)).alias("_all"), lost.alias("_lost"), *[F.count(v).alias(v) for v in known]
    )

    def entry(v: str) -> Column:
        if v not in known:
            reason, filled = F.lit("not in schema"), F.lit(0).cast("long")
        elif known[v] == "unsupported":
            reason, filled = F.lit("unsupported type"), F.col(v)
        else:
            filled = F.col(v)
            reason = F.when(filled == 0, "no values").otherwise(known[v])
        fine = reason.isin("categorical", "numeric")
        return F.struct(
            F.lit(v).alias("variable"),
            F.when(fine, "converted").otherwise("skipped").alias("status"),
            reason.alias("reason"),
            filled.alias("n_values"),
            F.col("_all").alias("n_features"),
            F.col("_lost").alias("n_dropped"),
        )

    return counts.select("layer", F.explode(F.array(*[entry(v) for v in wanted])).alias("s")).select(
        "layer", "s.*"
    )


def encoding_rows(metadata: DataFrame, layer: str) -> DataFrame:
    """One layer's category encodings: ``var, code, category``, a row per category."""
    mine = metadata.where((F.col("layer") == layer) & (F.col("key") == "categorical_encoding"))
    return mine.select(
        F.col("scope").alias("var"), F.col("number").cast("long").alias("code"), F.col("text").alias("category")
    )


def attribute_documents(metadata: DataFrame, layer: str) -> dict[str, dict]:
    """One layer's attributes as nested dictionaries ``{scope: {key: value}}``.

    This is what goes into the JSON files of an array store. Category encodings
    are data-sized and not part of it, see :func:`encoding_rows`.
    """
    mine = metadata.where((F.col("layer") == layer) & (F.col("key") != "categorical_encoding"))
    documents: dict[str, dict] = {}
    lists = {"geographical_extent", "variables", "band_descriptions"}
    for r in mine.orderBy("scope", "key", "pos").collect():
        scope = documents.setdefault(r["scope"], {})
        value = r["text"] if r["text"] is not None else r["number"]
        if r["key"] == "_CRS":
            scope[r["key"]] = {"wkt": value}
        elif r["key"] == "proj:epsg":
            scope[r["key"]] = int(value)
        elif r["key"] in lists:
            scope.setdefault(r["key"], []).append(value)
        else:
            scope[r["key"]] = value
    return documents
