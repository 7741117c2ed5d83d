import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from gridloom.llm import bpe
from tests.llm.helpers import clashing, docs

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(PATH)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rnd = random.Random(4)
    chars = [chr(i) for i in [*range(0, 0x600), *range(0x4E00, 0x4E40), *range(0x1F600, 0x1F620), 0x85, 0xA0, 0x2028]]
    out = ["", " ", "a", "The quick's 12345  brown\n\n fox!!", "<|endoftext|>", "é" * 50, " " * 300 + "x", "ab" * 2000]
    for _ in range(600):
        pool = chars if rnd.random() < 0.5 else "  \n\t'tsre abcdefghi\x1c\x1d"
        out.append("".join(rnd.choice(pool) for _ in range(rnd.randint(0, 40))))
    return out


def test_ids_are_those_of_the_library(ranks, library):
    encoder = bpe.Encoder(ranks, P.PATTERN)
    for t in texts():
        assert bpe.unpack_ids(encoder.encode(t)) == library.encode_ordinary(t)


def test_transducer_equals_the_merges(ranks):
    rnd = random.Random(5)
    machine = bpe.Transducer(ranks, states=50)  # forgets again and again
    for _ in range(400):
        data = bytes(rnd.choice(b"theaing \xc3\xa9re0") for _ in range(rnd.randint(1, 25)))
        if data not in ranks:
            assert bpe.unpack_ids(machine.encode(data)) == list(bpe.merge_bytes(data, ranks))


def test_tokens_come_out_before_the_end(ranks):
    machine = bpe.Transducer(ranks)
    state, early = 0, 0
    for byte in b"abcdefghij" * 30:
        state = machine._step(state, byte)
        if state < 0:
            state, out = machine.telling[-1 - state]
            early += len(out) // 4
        assert max(len(h[0]) for h in machine.states[state]) // 4 < 16
    assert early > 50


def test_decoder_in_any_portions(ranks):
    decoder, rnd = bpe.Decoder(ranks), random.Random(6)
    single = [ranks[bytes([b])] for b in range(256)]
    for _ in range(1500):
        data = bytes(rnd.choice([0x41, 0xC3, 0xA9, 0xE2, 0x82, 0xAC, 0xF0, 0x9F, 0x98, 0x80, 0xED, 0xA0, 0xFF, 0xF4, 0x90]) for _ in range(rnd.randint(0, 14)))
        ids, stream, got = np.array([single[b] for b in data], dtype="<u4"), decoder.stream(), ""
        while len(ids):
            n = rnd.randint(1, 4)
            got, ids = got + stream.feed(ids[:n]), ids[n:]
        assert got + stream.finish() == data.decode("utf-8", "replace")


def test_round_trip_in_spark(spark):
    df = clashing(docs(spark, [None, "", "Hello  wörld 😀", "Hello  wörld 😀", "x" * 100_000]))
    out = bpe.decode_ids(bpe.encode_text(df, PATH, P.PATTERN, out="packed"), PATH, "packed").collect()
    assert [r["decoded"] for r in sorted(out, key=lambda r: r["doc_id"])] == ["", "", "Hello  wörld 😀", "Hello  wörld 😀", "x" * 100_000]
    both = bpe.round_trip(df, PATH, P.PATTERN, ids="packed", out="decoded").collect()
    assert sorted((r["doc_id"], bytes(r["packed"]), r["decoded"]) for r in both) == sorted((r["doc_id"], bytes(r["packed"]), r["decoded"]) for r in out)
    assert bpe.encode_text(df.limit(0), PATH, P.PATTERN).count() == 0


def test_caches_end_before_memory_is_given_back(spark, monkeypatch):
    import weakref

    import pyarrow as pa

    from gridloom.llm import frames

    tasks, made, left = [], weakref.WeakSet(), []
    real_udf, real_init = bpe.F.arrow_udf, bpe.Encoder.__init__

    def init(self, *a):
        real_init(self, *a)
        made.add(self)

    monkeypatch.setattr(bpe.F, "arrow_udf", lambda fn, kind: (tasks.append(fn), real_udf(fn, kind))[1])
    monkeypatch.setattr(bpe.Encoder, "__init__", init)
    for module in (frames, bpe):
        monkeypatch.setattr(module, "give_back", lambda: left.append(len(made)), raising=False)
    df = spark.createDataFrame([("a b",)], "text string")
    bpe.encode_text(df, PATH, P.PATTERN)
    bpe.round_trip(df, PATH, P.PATTERN)
    for task in tasks:
        assert len(list(task(iter([pa.array(["some text", None])])))) == 1
        assert left[-1] == 0
