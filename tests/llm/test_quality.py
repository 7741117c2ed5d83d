import random

import numpy as np

from gridloom.llm import quality as Q
from tests.llm.helpers import clashing, docs


def slow_logit(net, text):
    """The network by its definition, one window at a time."""
    data = list((text or "").encode())
    blocks = max(1, -(-max(len(data), 1) // Q.HOP))
    data += [0] * (blocks * Q.HOP + net.width - len(data))
    peaks = []
    for p in range(blocks * Q.HOP):
        x = net.embed[data[p : p + net.width]]
        peaks.append(np.einsum("we,wef->f", x, net.kernel))
    peaks = np.array(peaks).reshape(blocks, Q.HOP, -1).max(axis=1)
    if blocks > 1:
        peaks = np.maximum(peaks[:-1], peaks[1:])
    return float((np.maximum(peaks + net.shift, 0) @ net.head).mean() + net.offset)


def test_forward_pass_by_definition():
    net = Q.ByteConvNet.fresh(3, filters=5)
    net.shift[:] = np.linspace(-0.2, 0.3, 5)
    for t in (None, "", "a", "é" * 200, "words and words " * 60):
        assert abs(net.logit(t) - slow_logit(net, t)) < 1e-3
    whole = net.chunk_maxima(np.frombuffer(b"abcdefg" * 900, "u1"))
    assert np.allclose(whole, net.chunk_maxima(np.frombuffer(b"abcdefg" * 900, "u1"), most=Q.HOP * 2))


def test_late_bytes_count():
    net = Q.ByteConvNet.fresh(4)
    assert net.logit("a" * 300_000) != net.logit("a" * 299_990 + "ZQXJ#######")


def table(spark, n, seed=0):
    rnd = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        good = rnd.random() < 0.7
        w = ["".join(rnd.choice("aeiounrst") for _ in range(rnd.randint(2, 8))) for _ in range(rnd.randint(5, 200))]
        texts.append(" ".join(w) if good else " ".join(x + rnd.choice(["%%%", "###", "$$$"]) for x in w))
        labels.append(int(good))
    return docs(spark, texts), spark.createDataFrame(list(enumerate(labels)), "doc_id long, quality int"), labels


def test_held_out_accuracy_and_repeatability(spark):
    df, labels, truth = table(spark, 500)
    net = Q.train(df, labels)
    rows = Q.score_quality(clashing(df), net, out="p").select("doc_id", "p", Q.held_out("doc_id").alias("h")).collect()
    held = [r for r in rows if r["h"]]
    assert len(held) > 80 and np.mean([(r["p"] >= 0.5) == truth[r["doc_id"]] for r in held]) > 0.95
    again = Q.train(df.repartition(3), labels)
    assert np.array_equal(net.kernel, again.kernel)
    # labels of the held-out fold are not read
    from pyspark.sql import functions as F

    turned = labels.withColumn("quality", F.when(Q.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert np.array_equal(net.kernel, Q.train(df, turned).kernel)


def test_odd_tables(spark):
    df, labels, _ = table(spark, 20)
    odd = docs(spark, [None, "", "x", "x"], ids=[None, 1, 2, 2])
    for lab in (labels.limit(0), labels.where("quality = 1"), labels.selectExpr("doc_id", "cast(null as int) quality")):
        net = Q.train(df, lab)
        scores = [r["score"] for r in Q.score_quality(odd, net).collect()]
        assert len(scores) == 4 and all(0 <= s <= 1 for s in scores)
    assert Q.score_quality(df.limit(0), net).count() == 0
    assert Q.train(df.limit(0), labels).offset == 0.0


def test_on_the_tables(spark, sf_dir):
    big = sf_dir.replace("0.001", "0.01")
    from gridloom.llm.queries import op10_quality, table as read

    got = {r["doc_id"]: r for r in op10_quality(spark, big).collect()}
    held = [r for r in read(spark, big, "labels").collect() if got[r["doc_id"]]["held_out"]]
    right = [got[r["doc_id"]]["predicted"] == r["quality"] for r in held]
    assert len(got) == 1000 and np.mean(right) > 0.9
