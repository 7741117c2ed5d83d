import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline as C
from gridloom.llm import bpe
from gridloom.llm.oracles import EMBEDDING_DUPLICATES
from gridloom.llm.queries import ORACLES, QUERIES
from gridloom.llm.secrets import find_secrets
from gridloom.plans.joins import store
from tests.llm.helpers import groups, shingles, words


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = [spark.read.parquet(f"{sf_dir}/documents.parquet")]
    for _, stage in C.STAGES:
        docs.append(store(stage(spark, docs[-1], sf_dir)))
    return [d.toPandas() for d in docs]


def test_order_and_columns(stages):
    assert [n for n, _ in C.STAGES] == ["quality classifier", "near-dedup", "secret scan", "source mix", "byte-level BPE"]
    for d in stages[1:-1]:
        assert list(d.columns) == list(stages[0].columns) and len(d)


def test_rejects_go(stages, spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas().set_index("doc_id").quality
    kept = set(stages[1].doc_id)
    right = [(i in kept) == bool(q) for i, q in labels.items()]
    assert sum(right) / len(right) > 0.9


def test_one_of_each_group_stays(stages):
    before, after = stages[1], set(stages[2].doc_id)
    ids, sets = list(before.doc_id), [shingles(t) for t in before.text]
    order = sorted(range(len(ids)), key=lambda k: ids[k])
    ids, sets = [ids[k] for k in order], [sets[k] for k in order]
    linked = [(a, b) for a in range(len(ids)) for b in range(a) if 100 * len(sets[a] & sets[b]) >= C.SIMILARITY * len(sets[a] | sets[b]) > 0]
    roots = groups(len(ids), linked)
    assert after == {ids[k] for k in range(len(ids)) if roots[k] == k}


def test_no_secret_stays(stages):
    assert set(stages[3].doc_id) == set(stages[2].doc_id)
    assert any(find_secrets(t) for t in stages[2].text) and not any(find_secrets(t) for t in stages[3].text)
    assert (stages[3].n_chars == stages[3].text.str.len()).all()


def test_mix_takes_whole_documents(stages):
    before, after = stages[3], stages[4]
    assert set(after.doc_id) <= set(before.doc_id) and after.groupby("doc_id").size().max() <= 3
    size = lambda d: sum(len(words(t)) for t in d.text)
    assert abs(size(after) - size(before)) < 0.05 * size(before)


def test_tokens_are_those_of_the_library(stages):
    ranks = bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = dict(zip(stages[4].doc_id, stages[4].text))
    assert stages[5].decodes.all() and len(stages[5]) == len(stages[4])
    for r in stages[5].itertuples():
        assert bpe.unpack_ids(r.ids) == enc.encode_ordinary(texts[r.doc_id])


def test_run_gives_the_last_stage(spark, sf_dir, stages):
    assert C.run(spark, sf_dir).count() == len(stages[-1])


def test_empty_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in C.STAGES:
        docs = store(stage(spark, docs, sf_dir))
    assert docs.count() == 0


@pytest.mark.parametrize("name", list(ORACLES))
def test_queries_equal_sql(spark, sf_dir, name):
    from catalog.compare import connect, difference

    assert difference(QUERIES[name](spark, sf_dir).toPandas(), connect(sf_dir).execute(ORACLES[name]).df()) is None


def test_vector_sql_has_no_links_below(sf_dir):
    from catalog.compare import connect

    assert connect(sf_dir).execute(f"SELECT count(*) FROM ({EMBEDDING_DUPLICATES})").fetchone()[0] > 0


@pytest.mark.parametrize("name", ["op1_byte_bpe", "op3_mix", "op4_neighbours", "op8_main_text"])
def test_queries_cover_their_table(spark, sf_dir, name):
    rows = QUERIES[name](spark, sf_dir).count()
    read = spark.read.parquet
    want = {
        "op4_neighbours": 10 * read(f"{sf_dir}/embeddings.parquet").where("vec_id % 100 = 0").count(),
        "op8_main_text": read(f"{sf_dir}/pages.parquet").count(),
    }.get(name, read(f"{sf_dir}/documents.parquet").count())
    assert rows == want
