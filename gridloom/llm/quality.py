"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded and read by learned filters; their responses are max-pooled
over overlapping chunks that cover the whole document, each chunk gives one
logit, and the mean of the logits gives the document's probability. The network
is fitted on a bounded sample of labelled documents and applied to every byte of
every document inside Spark tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.frames import col, slices

CHUNK, HOP = 512, 256
SAMPLE_DOCS = 3000  # labelled documents a fit reads at most
SAMPLE_CHUNKS = 8  # chunks of each, evenly spread over the document
STEPS = 700  # updates a fit makes at least


@dataclass
class ByteConvNet:
    """Weights of the network, and its forward pass over whole documents."""

    embed: np.ndarray  # 256 x e
    kernel: np.ndarray  # width x e x filters, width even
    shift: np.ndarray  # filters
    head: np.ndarray  # filters
    offset: float
    _pairs: list[np.ndarray] = field(default_factory=list, repr=False)

    @classmethod
    def fresh(cls, seed: int, embed: int = 8, width: int = 6, filters: int = 16) -> ByteConvNet:
        rng = np.random.default_rng(seed)
        return cls(
            rng.normal(0, 0.5, (256, embed)).astype("f4"),
            rng.normal(0, (width * embed) ** -0.5, (width, embed, filters)).astype("f4"),
            np.zeros(filters, "f4"),
            rng.normal(0, 0.3, filters).astype("f4"),
            0.0,
        )

    @property
    def width(self) -> int:
        return self.kernel.shape[0]

    def _tables(self) -> list[np.ndarray]:
        """Response of two neighbouring bytes at each even place of a filter."""
        if not self._pairs:
            for k in range(0, self.width, 2):
                one, two = self.embed @ self.kernel[k], self.embed @ self.kernel[k + 1]
                # low byte of the index first
                self._pairs.append((two[:, None, :] + one[None, :, :]).reshape(65536, -1).astype("f4"))
        return self._pairs

    def chunk_maxima(self, data: np.ndarray, most: int = 32_768) -> np.ndarray:
        """Max of every filter in each chunk; the last chunk is padded by zeros."""
        tables, n = self._tables(), max(len(data), 1)
        blocks = -(-n // HOP)
        padded = np.zeros(blocks * HOP + self.width, "u1")
        padded[: len(data)] = data
        top = np.empty((blocks, self.kernel.shape[2]), "f4")
        step = most // HOP
        for b in range(0, blocks, step):
            stop = min(b + step, blocks)
            part = padded[b * HOP : stop * HOP + self.width].astype("u2")
            pair, size = part[:-1] | part[1:] << 8, (stop - b) * HOP
            y = tables[0][pair[:size]]
            for k, t in enumerate(tables[1:], 1):
                y += t[pair[2 * k : 2 * k + size]]
            top[b:stop] = y.reshape(stop - b, HOP, -1).max(axis=1)
        return np.maximum(top[:-1], top[1:]) if blocks > 1 else top

    def logit(self, text: str | None) -> float:
        maxima = self.chunk_maxima(np.frombuffer((text or "").encode("utf-8", "replace"), "u1"))
        return float((np.maximum(maxima + self.shift, 0) @ self.head).mean() + self.offset)

    def score(self, text: str | None) -> float:
        """Probability of the better label; an empty or null text counts as a
        chunk of zero bytes."""
        return 1.0 / (1.0 + float(np.exp(-min(max(self.logit(text), -500.0), 500.0))))


def fit(
    chunks: list[list[bytes]],
    labels: list[int],
    seed: int = 11,
    epochs: int = 14,
    per_doc: int = 4,
    batch: int = 32,
    rate: float = 0.01,
    decay: float = 1e-4,
) -> ByteConvNet:
    """Fit on documents given by some of their chunks, by Adam on the log loss of
    the documents' mean logits. With one class only, or no document, the network
    answers the smoothed share of label 1."""
    net, rng = ByteConvNet.fresh(seed), np.random.default_rng(seed)
    y = np.array(labels, "f8")
    if len(set(labels)) < 2:
        net.head[:] = 0
        p = (y.sum() + 1) / (len(y) + 2)
        net.offset = float(np.log(p / (1 - p)))
        return net
    w = net.width
    docs = [np.frombuffer(b"".join(c.ljust(CHUNK + w, b"\0") for c in cs), "u1").reshape(len(cs), -1) for cs in chunks]
    net.offset = float(np.log(y.mean() / (1 - y.mean())))
    names = ["embed", "kernel", "shift", "head"]
    first = {k: np.zeros_like(getattr(net, k)) for k in names} | {"offset": 0.0}
    second = {k: np.zeros_like(getattr(net, k)) for k in names} | {"offset": 0.0}
    step = 0
    # few documents are gone over more often
    epochs = max(epochs, -(-STEPS // -(-len(docs) // batch)))
    for epoch in range(epochs):
        lr = rate * (1 - epoch / epochs) + rate / 20
        order = rng.permutation(len(docs))
        for lo in range(0, len(order), batch):
            ids = order[lo : lo + batch]
            picks = [docs[i][rng.permutation(len(docs[i]))[:per_doc]] for i in ids]
            owner = np.repeat(np.arange(len(ids)), [len(p) for p in picks])
            x = np.concatenate(picks)
            share = 1.0 / np.bincount(owner)[owner]
            seen = net.embed[x]  # chunks x bytes x e
            y_all = sum(seen[:, k : k + CHUNK] @ net.kernel[k] for k in range(w)) + net.shift
            at = y_all.argmax(axis=1)  # chunks x filters
            rows = np.arange(len(x))[:, None]
            peak = np.take_along_axis(y_all, at[:, None, :], 1)[:, 0]
            h = np.maximum(peak, 0)
            z = np.bincount(owner, (h @ net.head) * share) + net.offset
            p = 1 / (1 + np.exp(-np.clip(z, -60, 60)))
            dz = (p - y[ids]) / len(ids)
            dchunk = (dz[owner] * share)[:, None]
            grad = {"head": (h * dchunk).sum(0) + decay * net.head, "offset": dz.sum()}
            dpeak = dchunk * net.head * (peak > 0)
            grad["shift"] = dpeak.sum(0)
            window = x[rows[:, :, None], at[:, :, None] + np.arange(w)]  # chunks x filters x width
            grad["kernel"] = np.einsum("nf,nfwe->wef", dpeak, net.embed[window]) + decay * net.kernel
            back = np.einsum("nf,wef->nfwe", dpeak, net.kernel)
            grad["embed"] = decay * net.embed
            flat, back = window.reshape(-1), back.reshape(-1, net.embed.shape[1])
            for e in range(net.embed.shape[1]):
                grad["embed"][:, e] += np.bincount(flat, back[:, e], minlength=256)
            step += 1
            for k, g in grad.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                move = lr * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
                setattr(net, k, (getattr(net, k) - move) if k == "offset" else (getattr(net, k) - move).astype("f4"))
    net.offset = float(net.offset)
    return net


def held_out(key: str, folds: int = 4, fold: int = 2) -> Column:
    """Whether a row must not be learned from."""
    return F.coalesce(F.crc32(col(key).cast("string")) % folds == fold, F.lit(False))


def _spread_chunks(text: Column, width: int) -> Column:
    """Up to ``SAMPLE_CHUNKS`` chunks evenly spread over the whole text."""
    data = F.encode(F.coalesce(text, F.lit("")), "UTF-8")
    size = F.octet_length(data)
    count = F.least(F.greatest(F.ceil(size / F.lit(CHUNK)), F.lit(1)), F.lit(SAMPLE_CHUNKS)).cast("int")
    room = F.greatest(size - F.lit(CHUNK), F.lit(0))
    return F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda i: F.substring(
            data,
            (F.floor(room * i / F.greatest(count - 1, F.lit(1))) + 1).cast("int"),
            F.lit(CHUNK + width),
        ),
    )


def train(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample: int = SAMPLE_DOCS,
    seed: int = 11,
) -> ByteConvNet:
    """Fit on at most ``sample`` labelled documents outside the held-out fold.

    The sample is the labelled ids of smallest hash, so it is the same in every
    run. A document labelled twice takes the mean label, rounded up; labels that
    are null or of documents not in the table are not used.
    """
    net = ByteConvNet.fresh(seed)
    known = (
        labels.select(col(key).alias("_key"), col(label).cast("double").alias("_label"))
        .where(col("_key").isNotNull() & col("_label").isin(0.0, 1.0) & ~held_out("_key"))
        .groupBy("_key")
        .agg((F.avg("_label") >= 0.5).cast("int").alias("_label"))
        .orderBy(F.xxhash64(F.lit(seed), "_key"), "_key")
        .limit(sample)
    )
    wanted = known.collect()  # at most `sample` ids and labels
    if not wanted:
        return fit([], [])
    kept = docs.sparkSession.createDataFrame(wanted, known.schema)
    rows = (
        docs.select(col(key).alias("_key"), col(text).alias("_text"))
        .join(F.broadcast(kept), "_key")
        .withColumn("_chunks", _spread_chunks(F.col("_text"), net.width))
        .groupBy("_key")
        .agg(F.min(F.struct("_chunks", "_label")).alias("_row"))
        .orderBy("_key")
        .select("_row.*")
        .collect()
    )
    return fit([[bytes(c) for c in r["_chunks"]] for r in rows], [r["_label"] for r in rows], seed)


def score_quality(df: DataFrame, net: ByteConvNet, text: str = "text", out: str = "score") -> DataFrame:
    """Add ``out``: the network's probability for each whole text.

    Null and empty texts have a score too. Repeated rows stay, an empty table
    stays empty, a column already called ``out`` is replaced. One pass, no
    shuffle; memory is bounded by a slice of one text.
    """
    weights = (net.embed, net.kernel, net.shift, net.head, net.offset)

    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        loaded = ByteConvNet(*weights)
        for texts in slices(batches):
            yield pa.array([loaded.score(t.as_py()) for t in texts], pa.float64())

    return df.withColumn(out, F.arrow_udf(scored, T.DoubleType())(col(text)))
