import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.llm import ann
from gridloom.llm import embed_dedup as E
from tests.llm.helpers import clashing, groups

VECTORS = "vec_id long, embedding array<float>, label int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)


def clustered(seed, groups_of, extra, width=32, spread=0.05):
    rng = np.random.default_rng(seed)
    out = []
    for n in groups_of:
        centre = rng.normal(size=width)
        centre /= np.linalg.norm(centre)
        for _ in range(n):
            out.append(centre + rng.normal(size=width) * spread / math.sqrt(width) * rng.uniform(0.2, 2))
    out += list(rng.normal(size=(extra, width)))
    out = [np.float32(v).astype(float).tolist() for v in out]
    return [(int(i), out[k]) for k, i in enumerate(rng.permutation(len(out)))]


def truth(rows, query, k):
    x = np.array([v for _, v in rows])
    ids = np.array([i for i, _ in rows])
    d = np.sqrt(((x - x[list(ids).index(query)]) ** 2).sum(1))
    order = [j for j in np.lexsort((ids, d)) if ids[j] != query][:k]
    return [(int(ids[j]), float(d[j])) for j in order]


def test_rotation_keeps_lengths():
    x = np.random.default_rng(1).normal(size=(5, 48))
    turned = ann.rotated(x, 3, 9)
    assert turned.shape == (5, 64)
    assert np.allclose(np.linalg.norm(turned, axis=1), np.linalg.norm(x, axis=1))
    axes = ann.nearest_axes(turned, 1)[:, 0]
    best = np.abs(turned).argmax(axis=1)
    assert (axes // 2 == best).all() and ((axes % 2 == 0) == (turned[np.arange(5), best] > 0)).all()


def test_recall_and_exact_scores(spark):
    rows = clustered(2, [30, 5, 40], 600)
    df = clashing(frame(spark, rows))
    asks = F.col("vec_id") % 20 == 0
    got = ann.nearest_neighbours(df, asks)
    hit = total = 0
    for q, part in got.toPandas().groupby("query_id"):
        part = part.sort_values("rank")
        want = truth(rows, q, 10)
        assert list(part["rank"]) == list(range(1, 11))
        assert list(zip(part.score, part.vec_id)) == sorted(zip(part.score, part.vec_id))
        exact = dict(truth(rows, q, len(rows)))
        assert all(abs(exact[v] - s) < 1e-12 for v, s in zip(part.vec_id, part.score))
        hit += len({i for i, _ in want} & set(part.vec_id))
        total += 10
    assert total == 10 * len([i for i, _ in rows if i % 20 == 0]) and hit / total >= 0.9
    assert abs(ann.recall(df, got, asks) - hit / total) < 1e-9


def test_ties_repeats_and_blocks(spark):
    same = [1.0, 2.0, 3.0]
    rows = [(i, same) for i in range(100)] + [(i, [1.0, 2.0, 3.0 + i]) for i in range(100, 130)] + [(0, same)]
    got = ann.nearest_neighbours(frame(spark, rows), F.col("vec_id") % 50 == 0, block=16).collect()
    by = {(r["query_id"], r["rank"]): r["vec_id"] for r in got}
    assert [by[0, k] for k in range(1, 11)] == list(range(1, 11))
    assert [by[50, k] for k in range(1, 11)] == list(range(10))


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [0.0, 0.0], [nan, 1.0], [inf, 1.0], [None, 1.0]]
    rows = [(i, v) for i, v in enumerate(bad)] + [(10, [1.0, 0.0]), (20, [0.0, 1.0]), (30, [1.0, 1.0, 1.0]), (None, [1.0, 0.0])]
    df = frame(spark, rows)
    got = ann.nearest_neighbours(df, F.col("vec_id") % 10 == 0).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got] == [(10, 1, 20), (20, 1, 10)] or {(r["query_id"], r["vec_id"]) for r in got} == {(10, 20), (20, 10)}
    assert ann.nearest_neighbours(df.limit(0), F.lit(True)).count() == 0
    found = {r["vec_id"]: r for r in E.near_duplicate_vectors(df).collect()}
    for i in range(6):
        assert (found[i]["n_links"], found[i]["component_id"], found[i]["kept"]) == (0, i, True)
    assert found[10]["n_links"] == 1 and found[10]["component_id"] == 10 and found[20]["n_links"] == 0
    assert E.near_duplicate_vectors(df.limit(0)).count() == 0


@pytest.mark.parametrize("threshold", [0.9, 0.7])
def test_links_against_all_pairs(spark, threshold):
    rows = clustered(5, [2] * 15 + [3, 20, 60, 150], 250, spread=0.3)
    rows += [(10_000 + k, rows[k][1]) for k in range(25)]  # equal vectors
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    ids = [i for i, _ in rows]
    order = np.argsort(ids)
    place = {int(k): p for p, k in enumerate(order)}
    roots = groups(len(ids), [(place[int(a)], place[int(b)]) for a, b in zip(*np.nonzero(near))])
    got = {r["vec_id"]: r for r in E.near_duplicate_vectors(clashing(frame(spark, rows)), threshold=threshold).collect()}
    for k, i in enumerate(ids):
        least = ids[order[roots[place[k]]]]
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (near[k].sum(), least, least == i)


def cone(seed, n, pairs, width=64):
    """Distinct vectors around one axis, few of them with a near copy."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width)) * 0.5 / np.sqrt(width)
    x[:, 0] += 0.93
    x[-pairs:] = x[:pairs] + rng.normal(size=(pairs, width)) * 0.3 / np.sqrt(width)
    return [(i, v.tolist()) for i, v in enumerate(x)]


def check_cone(spark, n, pairs, **options):
    rows = cone(7, n, pairs)
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    assert pairs <= near.sum() // 2 < 4 * pairs
    got = {r["vec_id"]: r["n_links"] for r in E.near_duplicate_vectors(frame(spark, rows), **options).collect()}
    assert [got[i] for i in range(n)] == near.sum(axis=1).tolist()


def test_rare_links_in_a_hot_bucket(spark, monkeypatch):
    monkeypatch.setattr(E, "BUCKET", 16)
    monkeypatch.setattr(E, "AUDITED", 8)
    check_cone(spark, 800, 8)


def test_all_compared_when_rounds_run_out(spark, monkeypatch):
    monkeypatch.setattr(E, "_audit", lambda *_: False)
    monkeypatch.setattr(E, "_start", lambda nodes, *_: nodes.selectExpr("node", "node as near", "1D as cos").limit(0))
    monkeypatch.setattr(E, "EXACT_BLOCK", 100)
    check_cone(spark, 300, 8, rounds=1)


def test_codes_and_probes():
    x = np.random.default_rng(3).normal(size=(40, 12))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for axes in (1, 2, 3):
        codes = ann.own_codes(x, 2, axes, 7)
        for y, own in zip(x[:5], codes):
            probes = ann.probed(y, 2, axes, 200, 7)
            # a vector's own code is probed first, none twice, nearest ones first
            assert probes[0].tolist() == own.tolist() and len(np.unique(probes, axis=0)) == len(probes)
            near = sum(ann._signed(y[None, :], 2, j, 7)[0][probes[:, j]] for j in range(axes))
            assert (np.diff(near) <= 1e-12).all()
        # the rank at which a neighbour is met is where its code stands among the probes
        ranks = ann.reached_at(x[0], x[1:], 3, axes, 7)
        for k in range(1, 40):
            at = []
            for t in range(3):
                probes = ann.probed(x[0], t, axes, 32**axes, 7)
                hit = np.flatnonzero((probes == ann.own_codes(x[k : k + 1], t, axes, 7)[0]).all(axis=1))
                at += (hit + 1).tolist()
            assert ranks[k - 1] == min(at)


def test_more_rows_get_longer_codes():
    assert [ann.axes_for(n, 64) for n in (0, 100, 2_000, 51_282, 2_000_000, 10**9)] == [1, 1, 2, 2, 3, 4]


@pytest.mark.parametrize("rows", [400, 3000])
def test_probes_reach_the_target(spark, rows):
    data = clustered(rows, [], rows, width=24)
    df, asks = frame(spark, data), F.col("vec_id") % 10 == 0
    got = ann.nearest_neighbours(df, asks, sample=30, block=500)
    assert ann.recall(df, got, asks, block=500) >= 0.9
    exact = ann.nearest_neighbours(df, asks, probes=0, block=500).collect()
    for q in (0, 10, 20):
        assert [(r["vec_id"], round(r["score"], 9)) for r in sorted(exact, key=lambda r: r["rank"]) if r["query_id"] == q] == [
            (i, round(d, 9)) for i, d in truth(data, q, 10)
        ]


def test_many_queries_of_one_place_are_cut(spark, monkeypatch):
    monkeypatch.setattr(ann, "ASKED", 7)
    rows = [(i, [1.0, 2.0, 3.0 + i % 3]) for i in range(200)]
    df, asks = frame(spark, rows), F.col("vec_id") < 90
    got = ann.nearest_neighbours(df, asks, block=20)
    assert got.count() == 900 and ann.recall(df, got, asks) == 1.0


def test_recall_on_the_given_vectors(spark, sf_dir):
    from gridloom.llm.queries import QUERIES

    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    assert ann.recall(df, QUERIES["op4_neighbours"](spark, sf_dir), F.col("vec_id") % 100 == 0) >= 0.9


def test_sql_on_planted_near_duplicates(spark, tmp_path):
    import duckdb

    from gridloom.llm.oracles import EMBEDDING_DUPLICATES

    rows = clustered(21, [60, 25, 8, 3, 2, 2], 900, spread=0.35)
    path = str(tmp_path / "embeddings.parquet")
    frame(spark, rows).write.parquet(path)
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{path}/*.parquet')")
    want = {r[0]: r[1:] for r in db.execute(f"SELECT vec_id, n_links, component_id, kept FROM ({EMBEDDING_DUPLICATES})").fetchall()}
    got = E.near_duplicate_vectors(spark.read.parquet(path), threshold=0.9).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got} == want
    # the planted clusters are there: some rows are linked, some go
    assert sum(n > 0 for n, _, _ in want.values()) > 50 and any(not kept for _, _, kept in want.values())
