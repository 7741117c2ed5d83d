import os

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridloom.functions import geometry as G
from gridloom.functions import values as V
from gridloom.operators.grid import axis_label
from gridloom.sources import wkt

QUIET = settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def column(spark, values, type_, expr):
    df = spark.createDataFrame([(v,) for v in values], f"v {type_}")
    return [r.out for r in df.select(expr(F.col("v")).alias("out")).collect()]


def test_cleaning_rules(spark):
    raw = ["", " ", "nan", "0", "   ", "\t", None, "x", " x"]
    assert column(spark, raw, "string", V.clean_basic) == ["None", "None", "None", "0", "   ", "\t", None, "x", " x"]
    assert column(spark, raw, "string", V.clean_zero) == ["None"] * 4 + ["   ", "\t", None, "x", " x"]
    assert column(spark, raw, "string", V.clean_strip) == ["None", "None", "nan", "None", "None", "None", None, "x", " x"]
    assert column(spark, raw, "string", V.category)[6] == "None"


@QUIET
@given(st.lists(st.tuples(st.floats(), st.floats()), min_size=1, max_size=40))
def test_values_close_as_in_numpy(spark, pairs):
    pairs = pairs + [(1.0, 1.0 + 1e-5), (float("nan"), float("nan")), (float("inf"), float("inf")), (1.0, float("inf"))]
    df = spark.createDataFrame(pairs, "a double, b double")
    got = [r.out for r in df.select(V.values_close(F.col("a"), F.col("b")).alias("out")).collect()]
    with np.errstate(all="ignore"):
        want = [bool(np.isclose(a, b)) for a, b in pairs]
    assert got == want


def test_values_close_with_null(spark):
    df = spark.createDataFrame([(1.0, None), (None, None)], "a double, b double")
    assert [r.o for r in df.select(V.values_close(F.col("a"), F.col("b")).alias("o")).collect()] == [False, False]


@QUIET
@given(st.floats(-180, 180), st.floats(-180, 180), st.integers(1, 400))
def test_labels_as_in_numpy(spark, a, b, n):
    df = spark.range(n).select(axis_label(F.col("id"), F.lit(a), F.lit(b), F.lit(n).cast("long")).alias("l"))
    got = np.sort([r.l for r in df.collect()])
    want = np.sort(np.round(np.linspace(a, b, n), 4))
    assert np.array_equal(got, want)


def test_titles(spark):
    paths = ["/a/b/x.tif", "x.tar.gz", ".hidden", "a..b", "/a.d/plain", "", "..c", "/end/", ".a.b"]
    want = [os.path.splitext(os.path.basename(p))[0] for p in paths]
    assert column(spark, paths, "string", V.title_of) == want


def test_wkt(spark):
    texts = [
        "POLYGON ((0 0, 4 0, 4 4, 0 0), (1 1,2 1,2 2,1 1))",
        "multipolygon(((0 0,1 0,1 1,0 0)),((5 5,6 5,6 6,5 5)))",
        "POINT (1.5 -2e1)",
        "LINESTRING Z (0 0 9, 1 1 9)",
        "POINT (a b)",
        "GEOMETRYCOLLECTION (POINT (1 1))",
        None,
        "POLYGON EMPTY",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(wkt.wkt_type(F.col("t")).alias("g"), wkt.wkt_rings(F.col("t")).alias("r")).collect()
    assert [r.g for r in got] == ["POLYGON", "POLYGON", "POINT", "LINE", "POINT", None, None, "POLYGON"]
    assert [len(x) for x in got[0].r] == [4, 4] and len(got[1].r) == 2
    assert (got[2].r[0][0].x, got[2].r[0][0].y) == (1.5, -20.0)
    assert [(p.x, p.y) for p in got[3].r[0]] == [(0, 0), (1, 1)]
    assert got[4].r is None and got[6].r is None and got[7].r == []


@pytest.mark.parametrize("x,y,want", [(0.5, 0.5, True), (2, 2, False), (3.5, 3.9, True), (5, 5, False)])
def test_containment(spark, x, y, want):
    from tests.helpers import features, square

    df = features(spark, [(1, [square(0, 0, 4), square(1, 1, 2)])])
    assert df.select(G.contains_point(F.col("rings"), F.lit(float(x)), F.lit(float(y))).alias("o")).first().o is want


@pytest.mark.parametrize(
    "cx,cy,r,want",
    [(5, 2, 1.0, True), (5.1, 2, 1.0, False), (2, 2, 0.9, False), (2, 2, 1.0, True), (0.5, 0.5, 0.01, True)],
)
def test_disc(spark, cx, cy, r, want):
    from tests.helpers import features, square

    df = features(spark, [(1, [square(0, 0, 4), square(1, 1, 2)])])
    lit = lambda v: F.lit(float(v))
    assert df.select(G.disc_intersects(F.col("rings"), lit(cx), lit(cy), lit(r)).alias("o")).first().o is want
