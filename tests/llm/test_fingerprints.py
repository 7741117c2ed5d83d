import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.llm import fingerprints as P
from gridloom.llm.queries import QUERIES
from tests.llm.helpers import clashing, docs


def slow_digest(text):
    """The same by loops over the bytes."""
    data, counts = text.encode(), [0] * P.BUCKETS
    for kind, (_, j, k) in enumerate(P.TRIPLETS):
        for i in range(len(data) - k):
            h = data[i] | data[i + j] << 8 | data[i + k] << 16
            h = (h + kind * 0x01000193) * 0x9E3779B1 % 2**32
            h = (h ^ h >> 15) * 0x85EBCA77 % 2**32
            counts[h >> 32 - P.BUCKET_BITS] += 1
    marks = sorted(counts)
    a, b, c = marks[P.BUCKETS // 4 - 1], marks[P.BUCKETS // 2 - 1], marks[3 * P.BUCKETS // 4 - 1]
    codes = [(n > a) + (n > b) + (n > c) for n in counts]
    body = bytes(codes[i] * 64 + codes[i + 1] * 16 + codes[i + 2] * 4 + codes[i + 3] for i in range(0, P.BUCKETS, 4))
    return bytes([min(255, int(round(8 * np.log2(1 + len(data))))), 16 * (15 * a // c) + 15 * b // c if c else 0]) + body


def slow_likeness(a, b):
    def codes(d):
        return [x >> s & 3 for x in d[2:] for s in (6, 4, 2, 0)]

    x, y = codes(a), codes(b)
    chance = sum(abs(p - q) for p in x for q in y) / P.BUCKETS
    body = sum(abs(p - q) for p, q in zip(x, y)) / chance if chance else 0
    head = abs(a[0] - b[0]) / 64 + (abs(a[1] // 16 - b[1] // 16) + abs(a[1] % 16 - b[1] % 16)) / 240
    return 1 - min(1, body + head)


def random_texts(n, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice("abcdefghij äß€😀 \n") for _ in range(rnd.choice([0, 1, 2, 5, 40, 900]))) for _ in range(n)]


def test_digest_and_likeness_equal_the_loops():
    texts = random_texts(25, 1)
    prints = [P.digest(t.encode()) for t in texts]
    assert prints == [slow_digest(t) for t in texts]
    got = P.likeness_of(prints, prints[1:] + prints[:1])
    assert np.allclose(got, [slow_likeness(a, b) for a, b in zip(prints, prints[1:] + prints[:1])])
    assert (P.likeness_of(prints, prints) == 1).all() and ((0 <= got) & (got <= 1)).all()


def test_long_texts_are_counted_whole(monkeypatch):
    data = bytes(random.Random(2).choices(range(256), k=5000))
    whole = P.bucket_counts(data)
    monkeypatch.setattr(P, "PORTION", 64)
    assert (P.bucket_counts(data) == whole).all() and whole.sum() == sum(5000 - k for _, _, k in P.TRIPLETS)


def check(spark, df, texts):
    """Against the same over a sorted list; ids are the places in it."""
    got = {r["doc_id"]: r for r in P.compare_with_edits(df).collect()}
    assert sorted(got) == list(range(len(texts)))
    texts = [t or "" for t in texts]
    own = [P.digest(t.encode()) for t in texts]
    for i, t in enumerate(texts):
        j = (i + 1) % len(texts)
        half = len(t) // 2
        changed = "".join([*t[: len(t) - half], *texts[j][:half]])
        r = got[i]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert P._read(P.pa.array([r["fingerprint"], r["edited_fingerprint"]])) == [own[i], P.digest(changed.encode())]
        assert r["near_edited"] == pytest.approx(slow_likeness(own[i], slow_digest(changed)))
        assert r["near_next"] == pytest.approx(slow_likeness(own[i], own[j]))


@pytest.mark.parametrize("parts", ["1", "3", "40"])
def test_edits_across_ranges(spark, parts):
    texts = random_texts(30, 7) + [None, "", "same", "same"]
    df = clashing(docs(spark, texts)).repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check(spark, df, texts)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_one_row_and_none(spark):
    check(spark, docs(spark, ["only this one"]), ["only this one"])
    assert P.compare_with_edits(docs(spark, [])).count() == 0


def test_repeated_and_null_ids(spark):
    texts = ["b b b b", "a a a a", "a a a a", "c c c c", None]
    df = docs(spark, texts, ids=[None, 1, 1, 1, 2])
    rows = P.compare_with_edits(df).collect()
    assert sorted((r["doc_id"] or 0, r["n_chars"]) for r in rows) == [(0, 7), (1, 7), (1, 7), (1, 7), (2, 0)]
    again = P.compare_with_edits(df.repartition(3)).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, again), key=str)


def test_column_forms(spark):
    df = P.add_fingerprint(clashing(docs(spark, ["some text here", "some text here", None, ""])))
    prints = [r["fingerprint"] for r in df.orderBy("doc_id").collect()]
    assert prints[0] == prints[1] and prints[2] == prints[3] != prints[0]
    pair = df.select(P.likeness(F.col("fingerprint"), F.col("fingerprint")).alias("x"), P.likeness(F.lit(None).cast("string"), F.col("fingerprint")).alias("y"))
    assert {tuple(r) for r in pair.collect()} == {(1.0, None)}


def test_query(spark, sf_dir):
    rows = QUERIES["op13_fingerprints"](spark, sf_dir).collect()
    own = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    texts = [r["text"] or "" for r in own]
    want = {}
    for i, r in enumerate(own):
        changed = texts[i][: len(texts[i]) - len(texts[i]) // 2] + texts[(i + 1) % len(own)][: len(texts[i]) // 2]
        want[r["doc_id"]] = (len(texts[i]), hashlib.sha256(changed.encode()).hexdigest())
    assert {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in rows} == want
    # half of a text shows more than a text that only follows
    assert np.mean([r["near_edited"] > r["near_next"] for r in rows if r["n_chars"] >= 20]) > 0.97
