import math
import random

import numpy as np

from gridloom.llm import minhash as M
from gridloom.llm.components import components
from gridloom.llm.words import batch_word_hashes, shingle_hashes, word_hashes
from tests.llm.helpers import clashing, docs, groups, shingles, words


def varied(seed, n, vocabulary=400):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(vocabulary)]
    out = []
    for _ in range(n):
        base = [rnd.choice(vocab) for _ in range(rnd.randint(1, 120))]
        out.append(" ".join(base))
        for _ in range(rnd.randint(0, 4)):
            copy = list(base)
            for _ in range(rnd.choice([0, 1, 1, 2, 5])):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocab)
            out.append(rnd.choice([" ", "\n", "\t "]).join(copy).upper() if rnd.random() < 0.2 else " ".join(copy))
    return out


def expected(texts, percent):
    sets = [shingles(t) for t in texts]
    linked = []
    for a in range(len(texts)):
        for b in range(a):
            k = len(sets[a] & sets[b])
            if k and 100 * k >= percent * len(sets[a] | sets[b]):
                linked.append((a, b))
    return groups(len(texts), linked), sets


def check(spark, texts, percent=85):
    got = {r["doc_id"]: r for r in M.near_duplicates(clashing(docs(spark, texts)), percent=percent).collect()}
    roots, sets = expected(texts, percent)
    for i in range(len(texts)):
        assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (len(sets[i]), roots[i], roots[i] == i), texts[i]


def test_words_of_odd_texts():
    import pyarrow as pa

    texts = ["The  Quick\x0bfox", "", None, " \n", "ÉÉ éé x", "quick the", "x"]
    seen = {}
    for t, h in zip(texts, batch_word_hashes(pa.array(texts))):
        assert len(h) == len(words(t))
        for w, v in zip(words(t), h):
            assert seen.setdefault(w, v) == v
    assert len(set(seen.values())) == len(seen)


def test_blocks_do_not_change_words(monkeypatch):
    data = np.frombuffer(("abc de " * 500 + "z" * 999 + " q").encode(), "u1")
    whole = word_hashes(data)
    monkeypatch.setattr("gridloom.llm.words.BLOCK", 64)
    assert (word_hashes(data) == whole).all()


def test_sketch_fills_every_coordinate_and_estimates():
    rng = np.random.default_rng(1)
    errors = []
    for n in (1, 2, 7, 60, 1000):
        base = rng.integers(0, 2**63, 2 * n, dtype=np.uint64)
        a, b = np.unique(base[: max(1, n + n // 2)]), np.unique(base[n // 2 :])
        s = M.similarity_sketches([a, b, np.array([], dtype=np.uint64)])
        assert (s[:2] != M.UNFILLED).all() and (s[2] == M.UNFILLED).all()
        if n == 1000:
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            errors.append(abs((s[0] == s[1]).mean() - true))
    assert max(errors) < 0.15
    # a set's sketch does not depend on what else is sketched
    assert (M.similarity_sketches([a])[0] == s[0]).all()


def test_pairs_at_the_threshold_pass_the_sketch_filter():
    for percent in (50, 60, 70, 80, 85, 90, 95):
        p, cut = percent / 100, round(M.least_share(percent) * M.BINS)
        chance = [math.comb(M.BINS, k) * p**k * (1 - p) ** (M.BINS - k) for k in range(cut + 1)]
        assert sum(chance[:-1]) <= M.MISS < sum(chance)


def test_against_all_pairs(spark):
    check(spark, varied(1, 60))


def test_another_threshold(spark):
    check(spark, varied(2, 40), percent=60)


def test_large_group_with_chains(spark):
    rnd = random.Random(3)
    base = [f"v{i}" for i in range(150)]
    texts = []
    for k in range(250):  # each differs from the next by one more word
        copy = list(base)
        copy[k % 150] = f"x{k}"
        texts.append(" ".join(copy))
    chain = [f"c{i}" for i in range(300)]
    texts += [" ".join(chain[i : i + 200]) for i in range(0, 100, 7)]
    texts += [" ".join(base + [f"tail{rnd.random()}" for _ in range(200)]) for _ in range(40)]
    check(spark, texts)


def test_links_of_other_members_than_the_nearest(spark):
    rnd = random.Random(8)
    texts = []
    for g in range(6):
        base = [f"g{g}w{i}" for i in range(204)]
        for k in range(40):  # each has its own edit, so that all are linked with each other
            copy = list(base)
            copy[5 + 5 * k % 195] = f"own{g}x{k}"
            texts.append(" ".join(copy))
        for k in range(40):  # linked only with the copy whose edit it shares, if with any
            copy = texts[g * 80 + k].split(" ")
            far = [p for p in range(5, 200, 5) if p != 5 + 5 * k % 195]
            for p in rnd.sample(far, 3):
                copy[p] = f"far{g}x{k}p{p}"
            texts.append(" ".join(copy))
    check(spark, texts, percent=86)


def test_odd_rows(spark):
    texts = [None, "", " ", "one two", "One\ttwo", "one two", "one two three four five", "one two three four five"]
    check(spark, texts)
    df = docs(spark, ["same words here in this text", "same words here in this text", None], ids=[None, 4, 4])
    got = M.near_duplicates(df).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"]), r["kept"]) for r in got) == [("4", "4", True), ("4", "4", True), ("None", "None", True)]
    assert M.near_duplicates(df.limit(0)).count() == 0
    twice = docs(spark, ["a b c d e f", "a b c d e f", "a b c d e f", None, None], ids=[7, 7, 9, 1, 1])
    assert sorted(r["doc_id"] for r in M.drop_near_duplicates(twice).collect()) == [1, 7]


def test_components_of_shapes(spark):
    path = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 50)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(path + star + [(5, 5), (3, 2)], "a long, b long")).collect()}
    assert len({got[i] for i in range(61)}) == 1 and len({got[1000 + i] for i in range(50)}) == 1
    assert got[0] != got[1000]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
