"""Small frames and brute-force forms."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(lowered(text))


def shingles(text, width=5):
    w = words(text)
    if not w:
        return set()
    if len(w) < width:
        return {tuple(w)}
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def groups(n, linked):
    """Smallest member of the component of each of n nodes."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, sources=None, ids=None):
    sources = sources or ["s"] * len(texts)
    ids = ids if ids is not None else list(range(len(texts)))
    rows = [(i, t, "en", s, len(t or "")) for i, t, s in zip(ids, texts, sources)]
    return spark.createDataFrame(rows, DOCS)


def clashing(df):
    """The frame with columns named as the operators name theirs."""
    from pyspark.sql import functions as F

    names = ["key", "row", "size", "bucket", "place", "copy", "copies", "digest", "node", "ids", "score", "named", "marked", "query", "n", "secret_spans", "root", "dotted.name"]
    for n in names:
        df = df.withColumn(n, F.lit("x"))
    return df
