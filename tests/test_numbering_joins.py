import random

import pytest
from pyspark.sql import functions as F

from gridloom.operators import encode, lookup
from gridloom.plans.joins import join_dimension, join_skewed, measured_bytes
from gridloom.plans.numbering import number_rows
from tests.helpers import exploded_plan, rows_of


@pytest.fixture(scope="module")
def keyed(spark):
    # one group holds a third of all rows
    rng = random.Random(2)
    rows = [("hot" if i % 3 == 0 else f"g{i % 7}", i, rng.random()) for i in range(3000)]
    return spark.createDataFrame(rows, "g string, fid long, v double").repartition(6)


def want_numbers(df):
    groups = {}
    for r in df.collect():
        groups.setdefault(r.g, []).append(r.fid)
    return sorted((g, f, i + 1) for g, fs in groups.items() for i, f in enumerate(sorted(fs)))


@pytest.mark.parametrize("window_rows", [10**9, 10])
def test_numbering_both_ways(spark, keyed, window_rows):
    got = number_rows(keyed, ["g"], [F.col("fid")], "n", window_rows)
    assert rows_of(got, "g", "fid", "n") == want_numbers(keyed)


@pytest.mark.parametrize("window_rows", [10**9, 10])
def test_numbering_without_group(spark, keyed, window_rows):
    got = number_rows(keyed.select("fid"), [], [F.col("fid").desc()], "n", window_rows)
    assert rows_of(got, "n", "fid") == [(i + 1, 2999 - i) for i in range(3000)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_broadcast(spark, keyed, how):
    dim = spark.createDataFrame([("hot", 1.0), ("g1", 2.0)], "g string, w double")
    small = join_dimension(keyed, dim, ["g"], how)
    for hot_rows in (10**9, 500, 0):
        large = join_dimension(keyed, dim, ["g"], how, broadcast_bytes=0, hot_rows=hot_rows)
        assert small.columns == large.columns
        assert small.exceptAll(large).count() == 0 and large.exceptAll(small).count() == 0
    assert "BroadcastHashJoin" in exploded_plan(small)


def test_salted_join_spreads_the_hot_key(spark, keyed):
    dim = spark.createDataFrame([("hot", 1.0)], "g string, w double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = join_dimension(keyed, dim, ["g"], broadcast_bytes=0, hot_rows=500)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == 1000 and max(sizes) < 500


def test_skewed_keys_against_a_large_table(spark, keyed):
    table = spark.createDataFrame([("hot", i) for i in range(3)] + [("x", 9)], "g string, b long")
    for hot_rows in (10**9, 500):
        got = join_skewed(keyed, table, ["g"], hot_rows=hot_rows)
        assert got.count() == 3000 and got.select("fid", "b").distinct().count() == 3000


def test_measured_bytes_grow_with_text(spark):
    short = spark.createDataFrame([("a",)], "s string")
    long = spark.createDataFrame([("a" * 1000,)], "s string")
    assert measured_bytes(long) - measured_bytes(short) == 999
    assert measured_bytes(short.where("false")) == 0


@pytest.mark.parametrize("window_rows", [10**9, 1])
def test_code_orders(spark, window_rows):
    rows = [(3, "a", "z"), (1, "a", "m"), (2, "a", None), (4, "a", "m"), (5, "b", "0"), (6, "a", "0")]
    df = spark.createDataFrame(rows, "fid long, layer string, c string").withColumn(
        "geom_type", F.lit("POINT")
    )
    first = encode.codes_first_seen(df, ["c"], window_rows=window_rows)
    assert rows_of(first, "layer", "code", "category") == [
        ("a", 1, "m"), ("a", 2, "None"), ("a", 3, "z"), ("a", 4, "0"), ("b", 1, "0")
    ]
    ordered = encode.codes_sorted(df, ["c"], window_rows=window_rows)
    assert rows_of(ordered, "layer", "code", "category") == [
        ("a", 1, "None"), ("a", 2, "m"), ("a", 3, "z"), ("b", 1, "None")
    ]


def test_encode_policies(spark):
    rows = [(1, "a", "x", None, True), (2, "a", "nan", float("nan"), False), (3, "a", "x", 16777217.0, None)]
    df = spark.createDataFrame(rows, "fid long, layer string, c string, n double, b boolean")
    enc, codes = encode.encode(df, ["c", "n", "b"])
    got = {r.fid: r for r in enc.collect()}
    assert [got[i].c for i in (1, 2, 3)] == [1.0, 2.0, 1.0]
    assert got[1].n != got[1].n and got[2].n != got[2].n and got[3].n == 16777216.0
    assert (got[1].b, got[2].b) == (1.0, 0.0) and got[3].b != got[3].b
    zero, _ = encode.encode(df, ["n"], null_policy="zero")
    assert [r.n for r in zero.orderBy("fid").collect()] == [0.0, 0.0, 16777216.0]
    with pytest.raises(TypeError):
        encode.encode(df.withColumn("t", F.array("c")), ["t"])


def test_index_and_sample(spark):
    cells = spark.createDataFrame(
        [(1, r, c) for r in range(5) for c in range(4) if (r + c) % 2], "band int, row long, col long"
    )
    got = rows_of(lookup.index_matches(cells, ["band"]), "match", "row", "col")
    assert got == [(i, r, c) for i, (_, r, c) in enumerate(sorted((1, r.row, r.col) for r in cells.collect()))]
    picks = {tuple(lookup.sample_cell(cells, s).select("row", "col").first()) for s in range(12)}
    assert len(picks) > 3
    assert lookup.sample_cell(cells, 3).collect() == lookup.sample_cell(cells.repartition(3), 3).collect()
