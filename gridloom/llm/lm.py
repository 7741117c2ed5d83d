"""Language-model scores from tries of three words in Elias-Fano form.

A first pass counts the words of all documents. Frequent words, a bounded number, are
known to every task with their counts; the others share 65,536 classes by hash, whose
sums are known too. So every task knows the lowest order of the model.

One shuffle then brings every token, with the two words before it, to the part of the
word right before it. A part holds the counts of the training documents as a trie of
compact levels: words; contexts; the words that follow a context and the words that
come before it, each relative to the context; and the words that follow both. Sorted
levels are reached by monotone pointers and searched for successors among the entries
of their parent. Discounted shares are kept in 16 bits. All tokens of a part, training
and held-out, are looked up there, equal ones of a batch once, and only sums per
document leave it.

Each order is interpolated with the one below, so probabilities add up to one: a seen
word has its discounted share, and every word has the discounted mass times its
probability one order down. The lowest order gives a frequent word its count plus one,
and shares a class's count evenly among its words and one that was never seen. A
context of very many tokens is cut into slices by the classes of the words that follow;
there the slice is predicted first, then the word among those of its slice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.eliasfano import Arena, EliasFano
from gridloom.llm.frames import col, give_back
from gridloom.llm.words import batch_word_hashes, mix
from gridloom.plans.joins import store

DISCOUNT = 0.75
STEP = 2048.0  # quantised values per unit of log10
PART_TOKENS = 1_000_000  # tokens one part looks up, about
BATCH_TOKENS = 600_000
BATCH_DOCS = 30_000
LOOKUPS = 300_000  # tokens looked up at a time
CLASSES = 1 << 16  # of words that are not frequent
SHARE, RARE = 1 << 20, 16  # a frequent word has more than RARE and one of SHARE tokens
BEGIN, END = np.uint64(0x0123456789ABCDEF), np.uint64(0xFEDCBA9876543210)

PIECES = "part long, sub long, keys array<{key}>, data binary"
FOUND = "sub long, keys array<{key}>, data binary"


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays one after another; the bytes of integers of up to four are compressed
    place by place, as the higher ones repeat."""
    out = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        out += [a.dtype.str.encode(), len(a).to_bytes(8, "little")]
        if a.dtype.kind == "f" or a.dtype.itemsize == 8:
            out.append(a.tobytes())
            continue
        for plane in np.ascontiguousarray(a.view("u1").reshape(len(a), a.dtype.itemsize).T):
            small = pa.compress(plane, codec="zstd", asbytes=True)
            out += [len(small).to_bytes(4, "little"), small]
    return b"".join(out)


def unpack(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        kind, n = np.dtype(data[at : at + 3].decode()), int.from_bytes(data[at + 3 : at + 11], "little")
        at += 11
        if kind.kind == "f" or kind.itemsize == 8:
            out.append(np.frombuffer(data, kind, n, at))
            at += n * kind.itemsize
            continue
        planes = np.empty((n, kind.itemsize), "u1")
        for k in range(kind.itemsize):
            size = int.from_bytes(data[at : at + 4], "little")
            planes[:, k] = np.frombuffer(pa.decompress(data[at + 4 : at + 4 + size], n, codec="zstd"), "u1") if n else 0
            at += 4 + size
        out.append(planes.reshape(-1).view(kind))
    return out


def narrow(x: np.ndarray) -> np.ndarray:
    """Numbers from 0 on in as few bytes as they need."""
    top = x.max() if len(x) else 0
    return x.astype("u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4")


def steps(x: np.ndarray) -> np.ndarray:
    return narrow(np.diff(x, prepend=0))


def quantise(x: np.ndarray) -> np.ndarray:
    return np.clip(np.round(x * STEP), -32768, 32767).astype(np.int16)


def class_of(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(48)).astype(np.int64)


class Vocabulary:
    """What every task knows of the words: frequent ones with their counts, the
    classes of the others, and the contexts that are cut into slices."""

    def __init__(self, words, train, seen, class_count, class_words, trained, documents, cap) -> None:
        """``words``: sorted frequent words, seen ``train`` times in training and
        ``seen`` times in all; tokens and known words of each class; training and all
        documents; a context of more than ``cap`` tokens is cut."""
        self.words, self.train = words, train
        weight = np.asarray(class_count + class_words + 1, "f8")
        self.total = float(np.sum(train + 1.0) + weight.sum())
        self.exact = (train + 1.0) / self.total
        self.shared = weight / (class_words + 1.0) / self.total
        self.mass = weight / self.total
        np.add.at(self.mass, class_of(words), self.exact)
        self.trained = trained
        cut = seen > cap
        some = np.append(words[cut], BEGIN)
        order = np.argsort(some)
        size = np.append(seen[cut], documents)[order]
        self.spread = some[order]
        self.spread_train = np.append(train[cut], trained)[order]
        parts = np.maximum(size / max(cap, 1), 1.0)
        self.slices = np.minimum(2 ** np.ceil(np.log2(parts)).astype(np.int64), CLASSES)

    @staticmethod
    def _find(values: np.ndarray, keys: np.ndarray) -> np.ndarray:
        if not len(values):
            return np.full(len(keys), -1, np.int64)
        at = np.minimum(np.searchsorted(values, keys), len(values) - 1)
        return np.where(values[at] == keys, at, -1)

    def frequent(self, words: np.ndarray) -> np.ndarray:
        """Places among the frequent words, or -1."""
        return self._find(self.words, words)

    def low(self, words: np.ndarray) -> np.ndarray:
        """The lowest order's probability of each word."""
        at = self.frequent(words)
        out = self.shared[class_of(words)]
        out[at >= 0] = self.exact[at[at >= 0]]
        return out

    def slices_of(self, context: np.ndarray) -> np.ndarray:
        """In how many slices each context is cut."""
        at = self._find(self.spread, context)
        return np.where(at >= 0, self.slices[np.maximum(at, 0)], 1)

    def slice_mass(self, context: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lowest order's probability of a context's slice, and the context's
        training tokens; for contexts that are known here."""
        at = self._find(self.spread, context)
        mass = np.empty(len(context))
        for n in np.unique(self.slices[at]):
            of = self.slices[at] == n
            mass[of] = self.mass.reshape(-1, n).sum(axis=0)[which[of]]
        return mass, self.spread_train[at]


class WordTrie:
    """Words, contexts, followers, words before, and the words that follow both."""

    def __init__(self, words: np.ndarray, context: np.ndarray, which: np.ndarray, word: np.ndarray, before: np.ndarray, weight: np.ndarray) -> None:
        """Places among the sorted ``words`` of the training tokens' context, word and
        word before the context, the context's slice, and how often each occurs; they
        may repeat, and words that occur nowhere are left out."""
        used = np.zeros(len(words), bool)
        for x in (context, word, before):
            used[x] = True
        known, rank = words[used], np.cumsum(used, dtype=np.uint64) - np.uint64(1)
        w, v = rank[word], rank[before]
        self.width = np.uint64(max(len(known), 1))
        contexts, at = np.unique(rank[context] << np.uint64(16) | which.astype(np.uint64), return_inverse=True)
        at = at.astype(np.uint64)
        followers, f = np.unique(at * self.width + w, return_inverse=True)
        befores, b = np.unique(at * self.width + v, return_inverse=True)
        thirds, t = np.unique(b.astype(np.uint64) * self.width + w, return_inverse=True)
        self.total = np.bincount(at.astype(np.int64), weight, len(contexts))
        parts = [EliasFano(x) for x in (known, contexts, followers, befores, thirds)]
        levels = []
        for keys, count, parents in (
            (followers, np.bincount(f, weight, len(followers)), len(contexts)),
            (thirds, np.bincount(t, weight, len(thirds)), len(befores)),
        ):
            of = (keys // self.width).astype(np.int64)
            kinds = np.bincount(of, minlength=parents)
            total = np.maximum(np.bincount(of, count, parents), 1)
            parts.append(EliasFano(np.concatenate([[0], np.cumsum(kinds)]).astype(np.uint64)))
            levels += [quantise(np.log10((count - DISCOUNT) / total[of])), quantise(np.log10(DISCOUNT * np.maximum(kinds, 1) / total))]
        of = (befores // self.width).astype(np.int64)
        parts.append(EliasFano(np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(contexts)))]).astype(np.uint64)))
        views = Arena([a for p in parts for a in p.levels] + levels).views
        for p in parts:
            p.open(views[: len(p.levels)])
            views = views[len(p.levels) :]
        self.words, self.contexts, self.followers, self.befores, self.thirds = parts[:5]
        # pointers are read in one go: all are needed, most of them many times
        self.to_followers, self.to_thirds, self.to_befores = (p.get(np.arange(p.n)).astype(np.int64) for p in parts[5:])
        self.share, self.left, self.third_share, self.third_left = views

    def _below(self, level: EliasFano, pointers: np.ndarray, parent: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Places of words among the entries of their parents, or -1."""
        ok = (parent >= 0) & (word >= 0)
        if not ok.any():
            return np.full(len(parent), -1, np.int64)
        at, w = np.where(ok, parent, 0), np.where(ok, word, 0)
        first, stop = pointers[at], pointers[at + 1]
        found = level.find(at.astype(np.uint64) * self.width + w.astype(np.uint64), first, np.where(ok, stop, first))
        return np.where(ok, found, -1)

    def find_contexts(self, place: np.ndarray, which: np.ndarray) -> np.ndarray:
        key = np.maximum(place, 0).astype(np.uint64) << np.uint64(16) | which.astype(np.uint64)
        distinct, at = np.unique(key, return_inverse=True)
        return np.where(place >= 0, self.contexts.find(distinct)[at], -1)

    def probability(self, at: np.ndarray, word: np.ndarray, before: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Of each word, after the context at a place (-1: unknown) and a word before
        it, given the lowest order's; words by their places in the trie, or -1."""
        out = low
        for level, pointers, parent, share, left in (
            (self.followers, self.to_followers, at, self.share, self.left),
            (self.thirds, self.to_thirds, self._below(self.befores, self.to_befores, at, before), self.third_share, self.third_left),
        ):
            if not level.n:
                continue
            found = self._below(level, pointers, parent, word)
            seen = np.where(found >= 0, 10.0 ** (share[np.maximum(found, 0)] / STEP), 0)
            out = np.where(parent >= 0, seen + 10.0 ** (left[np.maximum(parent, 0)] / STEP) * out, out)
        return out

    def log_probability(
        self, vocabulary: Vocabulary, words: np.ndarray, context: np.ndarray, which: np.ndarray, word: np.ndarray, before: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Of each word after a context and a word before it, all places among
        ``words``; and how often the context's slice occurs in training."""
        place = self.words.find(words)
        at = self.find_contexts(place[context], which)
        total = np.where(at >= 0, self.total[np.maximum(at, 0)], 0) if len(self.total) else np.zeros(len(at))
        low, chance = vocabulary.low(words)[word], np.ones(len(word))
        cut = np.flatnonzero((vocabulary.slices_of(words) > 1)[context])
        if len(cut):
            mass, tokens = vocabulary.slice_mass(words[context[cut]], which[cut])
            low[cut] /= mass
            chance[cut] = (total[cut] + mass) / (tokens + 1.0)
        value = np.empty(len(word))
        for lo in range(0, len(word), LOOKUPS):
            some = slice(lo, lo + LOOKUPS)
            value[some] = self.probability(at[some], place[word[some]], place[before[some]], low[some])
        return np.log10(value * chance), total


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of the documents, and an end for each: how often they occur in training
    and in all."""
    for batch in batches:
        held = batch["held_out"].to_numpy(zero_copy_only=False).astype(bool)
        parts, size, first = [], 0, 0
        for i, w in enumerate(batch_word_hashes(batch["text"])):
            parts.append(w)
            size += len(w) + 1
            if size >= BATCH_TOKENS or i + 1 == len(held):
                for some in (False, True):
                    of = [x for p, h in zip(parts, held[first : i + 1]) if h == some for x in (p, np.array([END]))]
                    if of:
                        word, m = np.unique(np.concatenate(of), return_counts=True)
                        columns = (word.astype("i8"), np.zeros_like(m) if some else m, m)
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["w", "n", "m"])
                parts, size, first = [], 0, i + 1
    give_back()


def _cut(known, parts: int, key_type: pa.DataType) -> Callable[[Iterator], Iterator]:
    """Documents to the pieces of each part, and a piece with their own data;
    ``known`` is the broadcast vocabulary."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = known.value
        for batch in batches:
            words, lo = [], 0
            size = 0
            for i, w in enumerate(batch_word_hashes(batch["text"])):
                words.append(w)
                size += len(w) + 1
                if size >= BATCH_TOKENS or len(words) >= BATCH_DOCS:
                    yield from pieces(vocabulary, batch.slice(lo, len(words)), words)
                    lo, words, size = i + 1, [], 0
            if words:
                yield from pieces(vocabulary, batch.slice(lo, len(words)), words)
        give_back()

    def pieces(vocabulary: Vocabulary, docs: pa.RecordBatch, words: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        sub = docs["row"][0].as_py()
        held = docs["held_out"].to_numpy(zero_copy_only=False).astype(bool)
        sizes = np.array([len(w) + 1 for w in words])
        doc = np.repeat(np.arange(len(words)), sizes)
        one, end = np.array([BEGIN]), np.array([END])
        dictionary, ids = np.unique(np.concatenate([x for w in words for x in (one, w, end)]), return_inverse=True)
        # frequent words, which all tasks know, come first
        frequent = vocabulary.frequent(dictionary)
        first_those = np.argsort(frequent < 0, kind="stable")
        dictionary, frequent = dictionary[first_those], frequent[first_those]
        moved = np.empty(len(dictionary), np.int64)
        moved[first_those] = np.arange(len(dictionary))
        ids = moved[ids]
        n_frequent = int((frequent >= 0).sum())
        starts = np.cumsum(sizes + 1) - sizes - 1
        inner = np.ones(len(ids), bool)
        inner[starts] = False
        at = np.flatnonzero(inner)
        w, u, v = ids[at], ids[at - 1], ids[np.maximum(at - 2, 0)]
        opening = ~inner[at - 1]
        v[opening] = u[opening]
        # frequent words and ends are settled here, others where they are a context
        count = np.where(frequent >= 0, vocabulary.train[np.maximum(frequent, 0)], 0) if len(vocabulary.words) else np.zeros(len(dictionary))
        is_end = dictionary == END
        count = np.where(is_end, vocabulary.trained, count)
        settled = (frequent >= 0) | is_end
        base = np.bincount(doc, np.where(settled, np.log10(count + 1.0), 0)[w], len(words))
        known_words = np.bincount(doc, (settled & (count > 0))[w], len(words))
        own = pack(held.astype("u1"), sizes.astype("<i8"), base, known_words.astype("<i8"))
        rows = [(-1 - sub, sub, docs["key"].to_pylist(), own)]

        # contexts in the order of their parts; a slice of a hot one is a context
        slices = vocabulary.slices_of(dictionary)
        hot = np.flatnonzero(slices[u] > 1)
        which = class_of(dictionary)[w[hot]] % slices[u[hot]]
        cut_up, at = np.unique(u[hot] << 16 | which, return_inverse=True)
        context = u.copy()
        context[hot] = len(dictionary) + at
        route = np.concatenate([dictionary, dictionary[cut_up >> 16] + (cut_up & 0xFFFF).astype(np.uint64)])
        route = (mix(route, 32) % np.uint64(parts)).astype(np.int64)
        base_word = np.concatenate([np.arange(len(dictionary)), cut_up >> 16])
        by_part = np.argsort(route, kind="stable")
        rank = np.empty(len(route), np.int64)
        rank[by_part] = np.arange(len(route))
        bits = len(dictionary).bit_length()
        tag = (doc | np.where(held[doc], 0x8000, 0)).astype("<u2")
        if len(route).bit_length() + 2 * bits <= 63:
            whole = rank[context] << 2 * bits | w << bits | v
            order = np.argsort(whole)
            fresh = np.diff(whole[order], prepend=-1) != 0
        else:  # a text of very many different words
            order = np.lexsort((v, w, rank[context]))
            fresh = np.ones(len(order), bool)
            fresh[1:] = (np.diff(rank[context][order]) != 0) | (np.diff(w[order]) != 0) | (np.diff(v[order]) != 0)
        first = np.append(np.flatnonzero(fresh), len(order))
        times, tag, one_each = np.diff(first), tag[order], order[first[:-1]]
        goal, w, v = route[context[one_each]], w[one_each], v[one_each]
        u = base_word[context[one_each]]
        edges = np.append(np.flatnonzero(np.diff(goal, prepend=-1)), len(goal))
        for lo, hi in zip(edges[:-1], edges[1:]):
            n = hi - lo
            used, place = np.unique(np.concatenate([u[lo:hi], w[lo:hi], v[lo:hi]]), return_inverse=True)
            own_frequent = int(np.searchsorted(used, n_frequent))
            data = pack(
                steps(frequent[used[:own_frequent]]), dictionary[used[own_frequent:]], narrow(place[:n]),
                narrow(place[n : 2 * n]), narrow(place[2 * n :]), narrow(times[lo:hi]), tag[first[lo] : first[hi]],
            )
            rows.append((int(goal[lo]), sub, None, data))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array([r[1] for r in rows], pa.int64()),
                pa.array([r[2] for r in rows], pa.list_(key_type)),
                pa.array([r[3] for r in rows], pa.binary()),
            ],
            names=["part", "sub", "keys", "data"],
        )

    return cut


def read_piece(vocabulary: Vocabulary, data: bytes) -> list[np.ndarray]:
    """Words, places of context, word and word before, times and tags of a piece."""
    frequent, rare, u, w, v, times, tags = unpack(data)
    words = np.concatenate([vocabulary.words[np.cumsum(frequent, dtype=np.int64)], rare])
    return [words, u, w, v, times.astype(np.int64), tags]


def _look_up(known, key_type: pa.DataType) -> Callable[[pa.Table], pa.Table]:
    """Build the trie of a part and score its tokens."""

    def look_up(group: pa.Table) -> pa.Table:
        if group["part"][0].as_py() < 0:
            return group.select(["sub", "keys", "data"])
        vocabulary = known.value
        subs = group["sub"].to_pylist()
        got = [read_piece(vocabulary, d.as_py()) for d in group["data"]]
        words, ids = np.unique(np.concatenate([g[0] for g in got]), return_inverse=True)
        start = np.cumsum([0, *[len(g[0]) for g in got]])
        u, w, v = (np.concatenate([ids[lo : lo + len(g[0])][g[k]] for lo, g in zip(start, got)]) for k in (1, 2, 3))
        times = np.concatenate([g[4] for g in got])
        tags = np.concatenate([g[5] for g in got])
        ends = np.cumsum(times)
        weight = np.add.reduceat((tags & 0x8000) == 0, ends - times, dtype=np.int64)
        which = class_of(words)[w] % vocabulary.slices_of(words)[u]
        train = weight > 0
        trie = WordTrie(words, u[train], which[train], w[train], v[train], weight[train])
        value, count = trie.log_probability(vocabulary, words, u, which, w, v)
        # of a context as a word by itself, if that is not settled elsewhere
        other = ((vocabulary.frequent(words) < 0) & (words != BEGIN))[u]
        log_base = np.where(other, np.log10(count + 1.0), 0)
        found, lo = [], 0
        for g in got:
            part = slice(lo, lo + len(g[4]))
            docs, of = np.unique(g[5] & 0x7FFF, return_inverse=True)
            score = np.bincount(of, np.repeat(value[part], g[4]), len(docs))
            rest = np.repeat(other[part], g[4])
            mine, some = np.unique(of[rest], return_inverse=True)
            base = np.bincount(some, np.repeat(log_base[part], g[4])[rest], len(mine))
            hits = np.bincount(some, np.repeat(count[part] > 0, g[4])[rest], len(mine)).astype(np.int64)
            found.append(pack(steps(docs.astype(np.int64)), score.astype("<f4"), steps(mine), base, narrow(hits)))
            lo = part.stop
        nothing = pa.nulls(len(subs), pa.list_(key_type))
        give_back()
        return pa.table({"sub": pa.array(subs, pa.int64()), "keys": nothing, "data": pa.array(found, pa.binary())})

    return look_up


def _assemble(tokens: int, words: int, key_type: pa.DataType) -> Callable[[pa.Table], pa.Table]:
    """Scores of the documents of one batch from what the parts found."""
    base_scale = np.log10(tokens + 1.0 * (words + 1))

    def assemble(group: pa.Table) -> pa.Table:
        own = int(np.flatnonzero(group["keys"].is_valid().to_numpy())[0])
        keys = group["keys"][own].as_py()
        held, sizes, base, known = unpack(group["data"][own].as_py())
        held = held.astype(bool)
        base, known, score = base - sizes * base_scale, known.copy(), np.zeros(len(sizes))
        # in one order, so that reruns add alike
        for data in sorted(d.as_py() for i, d in enumerate(group["data"]) if i != own):
            docs, x, some, y, z = unpack(data)
            docs = np.cumsum(docs, dtype=np.int64)
            some = docs[np.cumsum(some, dtype=np.int64)]
            score[docs] += x
            base[some] += y
            known[some] += z
        return pa.table(
            {
                "key": pa.array(keys, key_type),
                "held_out": pa.array(held),
                "n_tokens": pa.array(sizes, pa.int64()),
                "n_known": pa.array(known, pa.int64()),
                "train_tokens": pa.array(np.full(len(sizes), tokens), pa.int64()),
                "base_score": pa.array(base, pa.float64()),
                "score": pa.array(score, pa.float64()),
            }
        )

    return assemble


def held_out(key: str, folds: int = 7, fold: int = 2) -> Column:
    """Whether a document is kept from the training; a null key is not."""
    return F.coalesce(F.crc32(col(key).cast("string")) % folds == fold, F.lit(False))


def count_words(docs: DataFrame, part_tokens: int) -> tuple[Vocabulary, int, int, int]:
    """The vocabulary, training tokens, distinct training words and all tokens.

    Words are counted over all documents. At most ``SHARE`` frequent words and the
    sums of the classes come to the driver.
    """
    counts = docs.select("held_out", "text").mapInArrow(_count, "w long, n long, m long")
    words = store(counts.groupBy("w").agg(F.sum("n").alias("n"), F.sum("m").alias("m")))
    sums = words.agg(F.sum("n").alias("n"), F.sum("m").alias("m"), F.sum((F.col("n") > 0).cast("long")).alias("v")).first()
    n, m, v = (sums[k] or 0 for k in ("n", "m", "v"))
    is_frequent = F.col("m") > max(m // SHARE, RARE)
    end = F.col("w") == F.lit(int(END.astype("i8")))
    top = words.where(is_frequent | end).select("w", "n", "m").toArrow()
    word = top["w"].to_numpy().astype("u8")
    order = np.argsort(word)
    word, train, seen = word[order], top["n"].to_numpy()[order], top["m"].to_numpy()[order]
    at = np.flatnonzero(word == END)
    trained, documents = (int(train[at[0]]), int(seen[at[0]])) if len(at) else (0, 0)
    rest = words.where(~is_frequent & ~end).groupBy(F.shiftrightunsigned("w", 48).alias("class")).agg(
        F.sum("n").alias("n"), F.sum((F.col("n") > 0).cast("long")).alias("k")
    ).toArrow()
    class_count, class_words = np.zeros(CLASSES), np.zeros(CLASSES)
    where = rest["class"].to_numpy()
    class_count[where], class_words[where] = rest["n"].to_numpy(), rest["k"].to_numpy()
    return Vocabulary(word, train, seen, class_count, class_words, trained, documents, max(1, part_tokens // 4)), n, v, m


def score_documents(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    held: Column | None = None,
    part_tokens: int = PART_TOKENS,
) -> DataFrame:
    """``key``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` and ``score`` of each row.

    Tokens are the words, letters A to Z as a to z, and one end; rows where
    ``held`` (by default a seventh by the key's checksum) is true are scored, but
    not learned from. A null text is empty and has its end only. Rows that repeat
    count and are scored each by itself; without training rows the base spreads
    evenly, and all words are as likely as their class of unseen words. An empty
    table gives an empty result. Other columns are ignored. The counted words are
    stored in the session's checkpoint folder.
    """
    spark = df.sparkSession
    key_type = df.schema[key].dataType
    arrow_key = pa.schema([pa.field("k", _arrow_type(key_type))])[0].type
    docs = df.select(
        col(key).alias("key"),
        F.coalesce(held if held is not None else held_out(key), F.lit(False)).alias("held_out"),
        F.coalesce(col(text), F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    vocabulary, tokens, words, all_tokens = count_words(docs, part_tokens)
    parts = max(1, -(-all_tokens // part_tokens))
    known = spark.sparkContext.broadcast(vocabulary)
    name = key_type.simpleString()
    pieces = docs.mapInArrow(_cut(known, parts, arrow_key), PIECES.format(key=name))
    found = pieces.groupBy("part").applyInArrow(_look_up(known, arrow_key), FOUND.format(key=name))
    schema = f"key {name}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    scored = found.groupBy("sub").applyInArrow(_assemble(tokens, words, arrow_key), schema)
    return scored.withColumnRenamed("key", key) if key != "key" else scored


def _arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
