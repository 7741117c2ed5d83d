import numpy as np
import pytest

from gridloom.llm import mixing as X
from tests.llm.helpers import clashing, docs, words


def water(sizes, weights):
    """Targets by repeated sharing."""
    total, stopped = sum(sizes), set()
    while True:
        left = total - sum(3 * sizes[i] for i in stopped)
        open_now = [i for i in range(len(sizes)) if i not in stopped]
        w = sum(weights[i] for i in open_now)
        new = {i for i in open_now if left * weights[i] / w > 3 * sizes[i]}
        if not new:
            return [3 * sizes[i] if i in stopped else left * weights[i] / w for i in range(len(sizes))]
        stopped |= new


def text(n, salt):
    return " ".join(f"w{salt}" for _ in range(n))


def make(spark, counts, seed=0):
    rng = np.random.default_rng(seed)
    texts, sources = [], []
    for s, n in counts.items():
        for k in range(n):
            texts.append(text(int(rng.integers(0, 60)) if k else 7, k))
            sources.append(s)
    return docs(spark, texts, sources)


@pytest.mark.parametrize("block", [30, 20_000])
def test_targets_and_takes(spark, block):
    df = make(spark, {"b": 400, "a": 300, "ä": 20, None: 100, "Z": 3})
    plan = X.mix_plan(clashing(df), block_units=block).toPandas()
    names = ["Z", "a", "b", "ä", None]
    sizes = [sum(len(words(r["text"])) for r in df.collect() if r["source"] == n) for n in names]
    targets = water(sizes, [5, 2, 1, 5, 2])
    assert len(plan) == df.count() and plan.copies.between(0, 3).all()
    for n, s, t in zip(names, sizes, targets):
        own = plan[plan.source.isna()] if n is None else plan[plan.source == n]
        assert (own.source_size == s).all() and np.allclose(own.target, t)
        assert abs((own["size"] * own.copies).sum() - t) <= 20
    again = X.mix_plan(df.repartition(7), block_units=block).toPandas()
    key = ["doc_id", "copies"]
    assert plan[key].sort_values(key).to_numpy().tolist() == again[key].sort_values(key).to_numpy().tolist()


def test_expectation_is_kept():
    size = np.array([50, 3, 9, 27, 14, 8, 100, 1, 1, 30])
    taken = np.zeros(10)
    for s in range(3000):
        rng = np.random.default_rng(s)
        p = X.flight(np.full(10, 0.4), size, rng)
        assert ((p > 0) & (p < 1)).sum() <= 2
        assert abs((p * size).sum() - 0.4 * size.sum()) < 1e-6 and abs(p.sum() - 4) < 1e-6
        taken += p
    assert np.abs(taken / 3000 - 0.4).max() < 0.04


def test_repeated_and_odd_rows(spark):
    texts = ["a b c"] * 40 + [None, "", " "]
    df = docs(spark, texts, ["s"] * 20 + ["t"] * 20 + [None] * 3, ids=[5] * 40 + [None, None, 6])
    plan = X.mix_plan(df)
    rows = plan.toPandas()
    assert len(rows) == 43 and set(rows["size"]) == {0, 3}
    taken = X.take_mix(clashing(df), plan).toPandas()
    assert len(taken) == rows.copies.sum() and "dotted.name" in taken.columns
    assert X.mix_plan(df.limit(0)).count() == 0
    assert X.take_mix(df.limit(0), X.mix_plan(df.limit(0))).count() == 0
