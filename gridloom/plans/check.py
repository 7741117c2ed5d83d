"""Does a grid agree with its source?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions import geometry as G
from gridloom.functions import values as V
from gridloom.operators.grid import assign_coords
from gridloom.operators.lookup import pick_key, variable_max
from gridloom.operators.zonal import features_in_circle, majority
from gridloom.plans.joins import join_dimension, settle


def compare_cells(store: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """All cells of two tables side by side; close within tolerance or not."""
    a = store.select(*keys, F.col("value").alias("store_value"))
    b = source.select(*keys, F.col("value").alias("source_value"))
    return a.join(b, keys, "full_outer").withColumn(
        "is_close", V.values_close(F.col("store_value"), F.col("source_value"))
    )


def sample_per_layer(cells: DataFrame, variable: str, seed: int = 0) -> DataFrame:
    """One pseudo-random cell of each layer with its value.

    The lowest key is found first, so only cells with that key are compared.
    """
    keyed = cells.select(
        "layer", "row", "col", variable, pick_key(seed, "row", "col").alias("_key")
    )
    lowest = keyed.groupBy("layer").agg(F.min("_key").alias("_lowest"))
    near = join_dimension(keyed, lowest, ["layer"], spread="row").where(F.col("_key") == F.col("_lowest"))
    best = F.min(F.struct("row", "col", variable)).alias("b")
    return near.groupBy("layer").agg(best).select("layer", "b.*")


def check_conversion(
    features: DataFrame,
    cells: DataFrame,
    spec: DataFrame,
    variable: str,
    radius: float = 0.1,
    target: Column | None = None,
    seed: int = 0,
) -> DataFrame:
    """One report row per layer.

    Compares the largest value of features and cells, then picks a cell (among
    those satisfying ``target``), finds the features within ``radius`` of its
    label and compares their majority with the cell's value. ``cells`` has
    north-up rows and float values.
    """
    v = F.col(variable)
    source = variable_max(
        features.select("layer", v.cast("float").alias(variable)), variable, ["layer"]
    ).withColumnRenamed("max_value", "source_max")
    gridded = variable_max(cells, variable, ["layer"]).withColumnRenamed("max_value", "grid_max")

    good = cells.where(V.has_value(v))
    if target is not None:
        good = good.where(target)
    at = assign_coords(sample_per_layer(good, variable, seed), spec)
    # one record per layer, needed several times
    zones = settle(
        at.select(
            "layer",
            F.col("longitude").alias("cx"),
            F.col("latitude").alias("cy"),
            F.lit(float(radius)).alias("radius"),
            v.alias("cell_value"),
        )
    )
    boxes = [c for c in G.BOX_COLUMNS if c in features.columns]
    around = features.select("fid", "layer", "rings", *boxes, v.cast("double").alias("_near"))
    near = features_in_circle(zones, around, same=("layer",))
    common = majority(near, ["layer"], "_near").select("layer", "majority")
    return (
        source.join(gridded, "layer", "left")
        .join(zones, "layer", "left")
        .join(common, "layer", "left")
        .select(
            "layer",
            F.col("source_max").cast("double").alias("source_max"),
            F.col("grid_max").cast("double").alias("grid_max"),
            F.coalesce(F.col("source_max") == F.col("grid_max"), F.lit(False)).alias("same_max"),
            F.col("cy").alias("latitude"),
            F.col("cx").alias("longitude"),
            F.col("cell_value").cast("double").alias("cell_value"),
            "majority",
            V.values_close(F.col("cell_value"), F.col("majority").cast("float")).alias("agrees"),
        )
    )
