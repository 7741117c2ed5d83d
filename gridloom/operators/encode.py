"""Integer codes for categorical attributes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.functions import values as V
from gridloom.functions.geometry import BOX_COLUMNS, SIZE_COLUMN
from gridloom.operators.tiles import tile_pairs
from gridloom.plans.joins import join_dimension, settle
from gridloom.plans.numbering import WINDOW_ROWS, number_rows

FLOAT32_CODES = 1 << 24
KEY_COLUMNS = ("fid", "layer", "geom_type", "rings", *BOX_COLUMNS, SIZE_COLUMN)


def attribute_names(features: DataFrame) -> list[str]:
    """Attribute columns: everything but key and geometry."""
    return [c for c in features.columns if c not in KEY_COLUMNS]


def select_variables(features: DataFrame, wanted: list[str] | None = None) -> list[str]:
    """Wanted attributes in the order asked for, all if none are named; unknown
    names are left out."""
    have = attribute_names(features)
    return [c for c in wanted if c in have] if wanted else have


def variable_kind(dtype: T.DataType) -> str:
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return "categorical"
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return "numeric"
    return "unsupported"


def variable_kinds(features: DataFrame, wanted: list[str] | None = None) -> dict[str, str]:
    """How each variable is encoded, decided from the schema."""
    return {c: variable_kind(features.schema[c].dataType) for c in select_variables(features, wanted)}


def categories(features: DataFrame, variables: list[str], clean: str = "basic") -> DataFrame:
    """Distinct cleaned categories with the first feature that has each."""
    pairs = F.array(
        *[
            F.struct(F.lit(v).alias("var"), V.category(F.col(v), clean).alias("category"))
            for v in variables
        ]
    )
    return (
        features.select("layer", "fid", F.explode(pairs).alias("p"))
        .groupBy("layer", F.col("p.var").alias("var"), F.col("p.category").alias("category"))
        .agg(F.min("fid").alias("first_fid"))
    )


def codes_first_seen(
    features: DataFrame, variables: list[str], clean: str = "basic", window_rows: int = WINDOW_ROWS
) -> DataFrame:
    """Codes 1, 2, 3 ... in order of first appearance."""
    seen = categories(features, variables, clean)
    numbered = number_rows(seen, ["layer", "var"], [F.col("first_fid")], "code", window_rows)
    return numbered.select("layer", "var", "category", "code")


def codes_sorted(
    features: DataFrame, variables: list[str], clean: str = "zero", window_rows: int = WINDOW_ROWS
) -> DataFrame:
    """The missing category is always 1, the others follow sorted from 2."""
    seen = categories(features, variables, clean).select("layer", "var", "category")
    missing = features.select("layer").distinct().select(
        "layer",
        F.explode(F.array(*[F.lit(v) for v in variables])).alias("var"),
        F.lit(V.MISSING).alias("category"),
    )
    every = seen.unionByName(missing).distinct().withColumn("rest", F.col("category") != V.MISSING)
    numbered = number_rows(
        every, ["layer", "var"], [F.col("rest"), F.col("category")], "code", window_rows
    )
    return numbered.select("layer", "var", "category", "code")


def codes_by_tile(
    gridded: DataFrame,
    variables: list[str],
    tile: int,
    clean: str = "strip",
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """New categories numbered tile by tile in row-major order, sorted in a tile.

    A category belongs to the tiles its features intersect, burned or not.
    """
    pairs = F.array(
        *[
            F.struct(F.lit(v).alias("var"), V.category(F.col(v), clean).alias("category"))
            for v in variables
        ]
    )
    first = (
        tile_pairs(gridded, tile, keep=variables, distinct=False)
        .select("layer", "tile_seq", F.explode(pairs).alias("p"))
        .groupBy("layer", F.col("p.var").alias("var"), F.col("p.category").alias("category"))
        .agg(F.min("tile_seq").alias("tile_seq"))
    )
    numbered = number_rows(
        first, ["layer", "var"], [F.col("tile_seq"), F.col("category")], "code", window_rows
    )
    return numbered.select("layer", "var", "category", "code")


def apply_codes(
    features: DataFrame,
    codes: DataFrame,
    variables: list[str],
    clean: str = "basic",
    settled: bool = False,
) -> DataFrame:
    """Replace each categorical variable by its float32 code.

    Codes beyond the integers that float32 tells apart are an error.
    """
    table = codes if settled else settle(codes)
    most = table.agg(F.max("code").alias("m")).first()["m"] or 0
    if most > FLOAT32_CODES:
        raise ValueError(f"{most} categories; float32 tells only {FLOAT32_CODES} codes apart")

    def one(df: DataFrame, v: str) -> DataFrame:
        dim = table.where(F.col("var") == v).select(
            "layer", F.col("category").alias("_category"), F.col("code").cast("float").alias("_code")
        )
        keyed = df.withColumn("_category", V.category(F.col(v), clean))
        joined = join_dimension(keyed, dim, ["layer", "_category"], how="left", settled=True)
        return joined.withColumn(v, F.col("_code")).drop("_category", "_code")

    order = features.columns
    return reduce(one, variables, features).select(*order)


def category_map(codes: DataFrame, part_size: int) -> DataFrame:
    """Maps ``category -> code`` per layer and variable, for metadata.

    Codes are consecutive; map ``part`` holds those from ``part * part_size + 1``
    on, at most ``part_size`` of them, so no map grows with the encoding.
    """
    part = F.floor((F.col("code") - 1) / F.lit(part_size)).cast("int").alias("part")
    return codes.groupBy("layer", "var", part).agg(
        F.map_from_entries(
            F.sort_array(F.collect_list(F.struct("category", "code")))
        ).alias("encoding")
    )


def encode(
    features: DataFrame,
    variables: list[str],
    clean: str = "basic",
    codes: str = "first_seen",
    null_policy: str = "nan",
) -> tuple[DataFrame, DataFrame | None]:
    """All variables as float32, with the code table of the categorical ones."""
    kinds = variable_kinds(features, variables)
    unsupported = [v for v, k in kinds.items() if k == "unsupported"]
    if unsupported:
        raise TypeError(f"cannot put on a grid: {', '.join(unsupported)}")
    text = [v for v, k in kinds.items() if k == "categorical"]
    numeric = [v for v, k in kinds.items() if k == "numeric"]
    table = None
    if text:
        make = {"first_seen": codes_first_seen, "sorted": codes_sorted}[codes]
        table = make(features, text, clean)
        features = apply_codes(features, table, text, clean, settled=True)
    return features.withColumns({v: V.to_float32(F.col(v), null_policy) for v in numeric}), table
