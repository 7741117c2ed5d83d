import zlib

from pyspark.sql import functions as F

from gridloom.llm import shards as S
from tests.llm.helpers import clashing, docs


def test_fisher_yates_is_a_permutation_and_uniform():
    seen = {}
    for s in range(6000):
        p = tuple(S.fisher_yates(3, [s]))
        seen[p] = seen.get(p, 0) + 1
    assert len(seen) == 6 and all(850 < n < 1150 for n in seen.values())
    assert list(S.fisher_yates(0, [1])) == [] and list(S.fisher_yates(1, [1])) == [0]


def placed(df, **more):
    out = S.shuffle_into_shards(df, ["doc_id"], 8, **more).toPandas()
    sizes = out.groupby("shard").size().reindex(range(8), fill_value=0)
    assert sizes.max() - sizes.min() <= 1 and sizes.sum() == len(out)
    for s, part in out.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    return out


def test_equal_counts_and_whole_rows(spark):
    texts = [f"text {i} " * (i % 50) for i in range(1003)]
    df = clashing(docs(spark, texts))
    out = placed(df, bucket_bytes=20_000)
    assert sorted(out.doc_id) == list(range(1003)) and set(df.columns) <= set(out.columns)
    assert all(t == texts[i] for i, t in zip(out.doc_id, out.text))
    again = placed(df, bucket_bytes=20_000)
    assert dict(zip(out.doc_id, zip(out.shard, out.slot))) == dict(zip(again.doc_id, zip(again.shard, again.slot)))
    other = placed(df, bucket_bytes=20_000, seed=8)
    moved = out.set_index("doc_id").slot.sort_index() != other.set_index("doc_id").slot.sort_index()
    assert moved.mean() > 0.9


def test_hot_keys_and_odd_rows(spark):
    # one key and text in a third of the rows still fills many buckets
    df = docs(spark, ["same text"] * 300 + [None, ""] + ["other"] * 400, ids=[1] * 300 + [None, None] + list(range(400)))
    out = placed(df, bucket_bytes=4000)
    assert len(out) == 702
    shares = out[out.doc_id == 1].groupby("shard").size()
    assert len(shares) == 8 and shares.max() < 70
    placed(df.limit(3))
    placed(df.limit(0))


def test_written_shards(spark, tmp_path):
    df = docs(spark, [f"t{i}" for i in range(50)])
    path = str(tmp_path / "out")
    S.write_shards(S.shuffle_into_shards(df, ["doc_id"], 8), path)
    back = spark.read.parquet(path)
    assert back.count() == 50 and back.agg(F.countDistinct("shard")).first()[0] == 8


def test_query_columns(spark, sf_dir):
    from gridloom.llm.queries import op6_shards

    got = op6_shards(spark, sf_dir).toPandas().set_index("doc_id")
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        data = (r["text"] or "").encode()
        assert got.loc[r["doc_id"], "size"] == len(data) + 1 and got.loc[r["doc_id"], "text_crc32"] == zlib.crc32(data)
