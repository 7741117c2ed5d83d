import random
import re
import zlib

import numpy as np
import pytest

from gridloom.llm import spelling as S
from tests.llm.helpers import clashing, docs, lowered


def edits(a, b):
    """Least number of inserted, deleted or replaced code points."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[j - 1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def plain(rows, damage=None):
    """The result by its definition, all words against all."""
    counts = {}
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if damage and h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] = counts.get(run, 0) + 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near = {w: [v for v in counts if abs(len(v) - len(w)) < 2 and edits(v, w) == 1] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (counts[w], len(near[w]), form[w], counts.get(form[w]), root(w)) for w in counts}


def got(df, **more):
    rows = S.spelling_variants(df, **more).collect()
    out = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in rows}
    assert len(out) == len(rows)
    return out


def variants(seed, texts=40, letters="abné"):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice(letters) for _ in range(rnd.randint(4, 9))) for _ in range(60)]
    out = []
    for _ in range(texts):
        line = []
        for _ in range(200):
            w = list(words[min(rnd.randrange(60), rnd.randrange(60))])
            if rnd.random() < 0.5:
                at = rnd.randrange(len(w))
                w[at : at + rnd.randint(0, 1)] = rnd.choice([[], [rnd.choice(letters)]])
            line.append("".join(w))
        out.append(rnd.choice([" ", ", ", "-", "3", "\n"]).join(line))
    return out


@pytest.mark.parametrize("damage", [None, 5])
def test_equals_all_against_all(spark, damage):
    texts = [*variants(1), None, "", "ÀÀÀÀÀ Àbcdef àbcdef ÀBCDEF" * 3, "× ÷ı"]
    rows = list(enumerate(texts))
    want = plain(rows, damage)
    assert len(want) > 200 and sum(f is not None for _, _, f, _, _ in want.values()) > 50
    assert any(r != f and f for _, _, f, _, r in want.values())
    assert got(clashing(docs(spark, texts)), damage=damage) == want


def test_large_blocks_are_cut(spark):
    texts = variants(2, letters="ab")
    want = plain(enumerate(texts))
    for part in (3, 17):
        assert got(docs(spark, texts), part=part) == want


def test_repeated_rows_null_keys_and_no_rows(spark):
    texts = ["bcdef bcdef bcdeg"] * 3 + [None]
    df = docs(spark, texts, ids=[None, None, 4, 4])
    assert got(df, damage=2) == plain([(None, texts[0]), (None, texts[0]), (4, texts[0])], 2)
    assert got(docs(spark, [])) == {} and got(docs(spark, [None, ""])) == {}


def test_long_words_and_long_texts(spark):
    long = "x" * 30_000
    texts = [f"{long} {long}y {long[1:]}z", " ".join(["lengthy"] * 400_000 + ["lengthi"] * 3)] * 3
    assert got(docs(spark, texts)) == plain_long(texts)


def plain_long(texts):
    a, b, c = texts[0].split()
    # a and b differ by one insertion, a and c by their last letter, b and c by more
    return {a: (3, 2, None, None, a), b: (3, 1, None, None, b), c: (3, 1, None, None, c), "lengthy": (1_200_000, 1, None, None, "lengthy"), "lengthi": (9, 1, "lengthy", 1_200_000, "lengthy")}


def test_portions_cut_between_words(monkeypatch):
    monkeypatch.setattr(S, "PORTION", 7)
    text = "one three  sevens nineteen x elevens eleven"
    parts = list(S._portions(text, re.compile(f"[^{S.LETTERS}]")))
    assert "".join(parts) == text and [w for p in parts for w in re.findall(r"\w+", p)] == text.split()


def test_distances_of_blocks():
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcd") for _ in range(rnd.randint(3, 6))) for _ in range(400)]
    starts = np.array([0, 1, 3, 10, 90, 92])
    ends = np.append(starts[1:], 400)
    counts, _, _ = S.letter_counts(words)
    i, j = S.close_pairs(counts, starts, ends)
    want = set()
    for s, e in zip(starts, ends):
        for x in range(s, e):
            for y in range(x + 1, e):
                if sum((words[x].count(c) - words[y].count(c)) ** 2 for c in "abcd") <= 2:
                    want.add((x, y))
    assert set(zip(i.tolist(), j.tolist())) == want and len(i) == len(want)
