import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.llm import whitening as W
from gridloom.llm.queries import QUERIES
from tests.llm.helpers import clashing

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, vectors, ids=None):
    ids = ids if ids is not None else range(len(vectors))
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 0) for i, v in zip(ids, vectors)], SCHEMA)


def plain(vectors):
    """Whole numbers, exact deviations, eigenvalues and eigenvectors by definition."""
    x = [[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x]
    centred = np.array([[(n * c - s) / n for c, s in zip(row, sums)] for row in x])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    return n, deviation, centred, values[::-1], axes[:, ::-1].T


def same(rows, vectors, ids, most=8):
    n, deviation, centred, values, axes = plain(vectors)
    got = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(got) == len(rows) == len(vectors) * most
    trace = values.sum()
    for c in range(most):
        want = centred @ axes[c] / math.sqrt(values[c])
        own = np.array([got[i, c + 1]["whitened"] for i in ids])
        assert min(np.abs(own - want).max(), np.abs(own + want).max()) < 1e-8
        assert all(abs(got[i, c + 1]["explained"] - values[c] / trace) < 1e-10 for i in ids)
    for k, i in enumerate(ids):
        assert int(got[i, 1]["deviation"]) == deviation[k] and got[i, 1]["n"] == n
    assert {r["identity_error"] for r in rows} == {rows[0]["identity_error"]} and rows[0]["identity_error"] < 1e-9


def test_equals_the_eigenvectors(spark):
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(700, 12)) * np.linspace(0.2, 3, 12) + rng.normal(size=12)).astype("f4")
    rows = W.whitened_components(clashing(table(spark, vectors.tolist()))).collect()
    same(rows, vectors, list(range(700)))


def test_other_rows_take_no_part(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(90, 9)).astype("f4") * np.arange(1, 10)
    odd = [None, [], [None] * 9, [float("nan")] + [1.0] * 8, [float("inf")] * 9, [1e30] * 9, [1.0] * 4]
    df = table(spark, vectors.tolist() + odd)
    same(W.whitened_components(df).collect(), vectors, list(range(90)))


def test_repeated_rows_and_null_ids(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(60, 8)).astype("f4") * np.arange(1, 9)
    twice = np.concatenate([vectors, vectors[:20], vectors[:5]])
    ids = [*range(60), *range(20), *[None] * 5]
    rows = W.whitened_components(table(spark, twice.tolist(), ids)).collect()
    assert len(rows) == 85 * 8 and rows[0]["n"] == 85
    _, _, _, values, _ = plain(twice)
    assert max(abs(r["explained"] - values[r["component"] - 1] / values.sum()) for r in rows) < 1e-10
    assert sum(r["vec_id"] is None for r in rows) == 40


def test_equal_variances_are_all_found(spark):
    # six directions of one variance, two of none: a single start vector meets one of the six
    points = [s * 2.0 * np.eye(8)[i] for i in range(6) for s in (1, -1)]
    rows = W.whitened_components(table(spark, [p.tolist() for p in points])).collect()
    assert {r["component"] for r in rows} == set(range(1, 7))
    assert all(abs(r["explained"] - 1 / 6) < 1e-9 for r in rows) and rows[0]["identity_error"] < 1e-9


def test_no_variance_and_no_rows(spark):
    for df in (table(spark, [[1.0, 2.0]] * 4), table(spark, [[1.0, 2.0]]), table(spark, []), table(spark, [None])):
        out = W.whitened_components(df)
        assert out.count() == 0 and "identity_error" in out.columns


def test_few_steps_stop_when_the_wanted_ones_stand(spark):
    rng = np.random.default_rng(6)
    scale = np.concatenate([[60, 40, 25], np.full(37, 0.5)])
    df = table(spark, (rng.normal(size=(500, 40)) * scale).tolist())
    fit = W.fit_whitening(df, components=3, steps=30)
    full = W.fit_whitening(df, components=3)
    assert np.allclose(fit.values, full.values, rtol=1e-10) and np.allclose(np.abs(fit.components @ full.components.T), np.eye(3), atol=1e-6)


def test_exact_beyond_long_numbers():
    x = np.array([[2**40, -(2**41)], [3, 2**50]], dtype=np.int64)
    n, sums = 10**9, [10**15, -(10**16)]
    d = W.scaled_deviations(x, n, sums)
    assert W.exact_squares(d) == [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x]


def test_query(spark, sf_dir):
    rows = QUERIES["op11_whitening"](spark, sf_dir).collect()
    read = spark.read.parquet(f"{sf_dir}/embeddings.parquet").where(F.col("embedding").isNotNull()).collect()
    same(rows, [r["embedding"] for r in read], [r["vec_id"] for r in read])
    assert isinstance(rows[0]["deviation"], int)


@pytest.mark.parametrize("rows", [1, 3])
def test_steps_are_few(rows):
    # a left vector is never longer than what the driver keeps
    fn = W._step_of(2, np.ones(2), np.zeros((2, 0)))
    import pyarrow as pa

    block = np.arange(2.0 * rows).reshape(rows, 2)
    out = list(fn(iter([pa.record_batch([pa.array([block.tobytes()], pa.binary())], names=["block"])])))
    assert np.allclose(out[0]["value"].to_numpy()[:2], block.T @ (block @ np.ones(2)))
