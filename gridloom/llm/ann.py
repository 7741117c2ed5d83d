"""Approximate nearest neighbours by cross-polytope hashing.

A table rotates unit vectors by rounds of random signs and a fast Hadamard transform,
and files each vector under the signed axis nearest to it; with many rows, under the
axes of several rotations together, so that a code always holds few. A query probes,
in every table, the codes nearest to its own rotations; what it meets there is ranked
by the exact distance of the original vectors. How many codes it probes is measured:
some queries are compared with every row, and it is the rank at which probing reaches
enough of their true neighbours. A query that meets fewer rows than it should, and
every query if probing cannot reach enough, is compared with every row, in blocks.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.frames import col
from gridloom.plans.joins import join_dimension, settle, store

TABLES = 12
BLOCK = 4096  # indexed vectors compared at a time
ASKED = 4096  # queries of a place compared at a time
SAMPLE = 64  # queries compared with every row to choose the number of probes
TARGET = 0.95  # share of their true neighbours that probing must reach
MOST_AXES = 4
LARGEST_ORDER = 1 << 16  # codes of a table a query can order


def hadamard(x: np.ndarray) -> np.ndarray:
    """Rows times the Hadamard matrix, by halves; the width is a power of two."""
    n, width = x.shape
    h = 1
    while h < width:
        x = x.reshape(n, width // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, width)
        h *= 2
    return x / np.sqrt(width)


def rotated(x: np.ndarray, table: int, seed: int) -> np.ndarray:
    """Pseudo-random rotation number ``table`` of the rows, padded to a power of two."""
    width = 1 << max(x.shape[1] - 1, 0).bit_length()
    out = np.zeros((len(x), width))
    out[:, : x.shape[1]] = x
    signs = np.random.default_rng([seed, table, width]).integers(0, 2, (3, width)) * 2.0 - 1
    for s in signs:
        out = hadamard(out * s)
    return out


def nearest_axes(turned: np.ndarray, many: int) -> np.ndarray:
    """The ``many`` nearest signed axes of each row, nearest first: 2 i for the
    positive end of axis i, 2 i + 1 for the negative."""
    both = np.stack([turned, -turned], axis=2).reshape(len(turned), -1)
    many = min(many, both.shape[1])
    return np.argsort(-both, axis=1, kind="stable")[:, :many]


def sound(v: Column) -> Column:
    """Whether a vector can take part: neither null nor zero, all parts finite."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0)


def matrix(vectors: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype("f8")
    return flat.reshape(len(vectors), -1)


def by_length(vectors: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and matrix for each length of vector that occurs."""
    lengths = np.asarray(pc.list_value_length(vectors))
    out = []
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        out.append((rows, matrix(vectors.take(pa.array(rows)))))
    return out


def axis_codes(tables: int, many: int, seed: int) -> Callable[[pa.Array], pa.Array]:
    def codes(vectors: pa.Array) -> pa.Array:
        out: list = [None] * len(vectors)
        for rows, x in by_length(vectors):
            x = x / np.linalg.norm(x, axis=1, keepdims=True)
            for lo in range(0, len(rows), 2048):
                part = x[lo : lo + 2048]
                found = np.stack([nearest_axes(rotated(part, t, seed), many) for t in range(tables)], axis=1)
                for r, c in zip(rows[lo : lo + 2048], found.astype("i4")):
                    out[r] = c.tolist()
        return pa.array(out, pa.list_(pa.list_(pa.int32())))

    return codes


CODES = T.ArrayType(T.ArrayType(T.IntegerType()))


def axes_for(rows: int, dimension: int) -> int:
    """Rotations whose axes make up a code: about as many as leave a row to a code."""
    codes = 2 << max(dimension - 1, 0).bit_length()
    return max(1, min(MOST_AXES, round(np.log(max(rows, 1)) / np.log(codes))))


def _signed(x: np.ndarray, table: int, axis: int, seed: int) -> np.ndarray:
    """How near each row is to each signed axis of one rotation of a table."""
    turned = rotated(x, table * MOST_AXES + axis, seed)
    return np.stack([turned, -turned], axis=2).reshape(len(x), -1)


def own_codes(x: np.ndarray, table: int, axes: int, seed: int) -> np.ndarray:
    """The nearest signed axis of each row in each rotation of a table."""
    return np.stack([_signed(x, table, j, seed).argmax(axis=1) for j in range(axes)], axis=1)


def _fine(codes: np.ndarray, width: int) -> np.ndarray:
    """All axes of a code but the first, as one number."""
    out = np.zeros(len(codes), dtype=np.int64)
    for j in range(1, codes.shape[1]):
        out = out * width + codes[:, j]
    return out


def _orders(x: np.ndarray, table: int, axes: int, seed: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For one query: the nearest axes of each rotation, and how near those are."""
    many = int(LARGEST_ORDER ** (1 / axes) + 1e-9)
    near, value = [], []
    for j in range(axes):
        v = _signed(x[None, :], table, j, seed)[0]
        own = np.argsort(-v, kind="stable")[:many]
        near.append(own)
        value.append(v[own])
    return near, value


def _sums(value: list[np.ndarray]) -> np.ndarray:
    total = value[0]
    for v in value[1:]:
        total = np.add.outer(total, v)
    return total


def probed(x: np.ndarray, table: int, axes: int, probes: int, seed: int) -> np.ndarray:
    """The codes nearest to a query, nearest first, one to a row."""
    near, value = _orders(x, table, axes, seed)
    sums = _sums(value)
    best = np.argsort(-sums.ravel(), kind="stable")[:probes]
    return np.stack([n[i] for n, i in zip(near, np.unravel_index(best, sums.shape))], axis=1)


def reached_at(x: np.ndarray, neighbours: np.ndarray, tables: int, axes: int, seed: int) -> np.ndarray:
    """For each neighbour of a query, how many codes must be probed to meet it in some
    table; infinite if no number does."""
    least = np.full(len(neighbours), np.inf)
    for t in range(tables):
        near, value = _orders(x, t, axes, seed)
        sums, codes = np.sort(_sums(value).ravel()), own_codes(neighbours, t, axes, seed)
        for k, code in enumerate(codes):
            at = [np.flatnonzero(n == c) for n, c in zip(near, code)]
            if all(len(a) for a in at):
                own = sum(v[a[0]] for v, a in zip(value, at))
                # ties may come first
                least[k] = min(least[k], len(sums) - np.searchsorted(sums, own - 1e-12))
    return least


def _units(vectors: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    return [(rows, x / np.linalg.norm(x, axis=1, keepdims=True)) for rows, x in by_length(vectors)]


def _homes(tables: int, axes: dict[int, int], seed: int) -> Callable[[pa.Array], pa.Array]:
    """For each vector its first axis and the number of the others, in every table."""

    def homes(vectors: pa.Array) -> pa.Array:
        out: list = [None] * len(vectors)
        for rows, x in _units(vectors):
            width = 2 << max(x.shape[1] - 1, 0).bit_length()
            for lo in range(0, len(rows), 2048):
                found = []
                for t in range(tables):
                    codes = own_codes(x[lo : lo + 2048], t, axes[x.shape[1]], seed)
                    found.append(np.stack([codes[:, 0], _fine(codes, width)], axis=1))
                for r, c in zip(rows[lo : lo + 2048], np.stack(found, axis=1)):
                    out[r] = [{"tab": t, "code": int(a), "fine": int(b)} for t, (a, b) in enumerate(c)]
        return pa.array(out, pa.list_(pa.struct([("tab", pa.int32()), ("code", pa.int32()), ("fine", pa.int64())])))

    return homes


def _probes(tables: int, axes: dict[int, int], probes: dict[int, int], seed: int) -> Callable[[pa.Array], pa.Array]:
    """For each query the first axes it probes in every table, each with the sorted
    numbers of the others."""
    kind = pa.list_(pa.struct([("tab", pa.int32()), ("code", pa.int32()), ("fines", pa.list_(pa.int64()))]))

    def asked(vectors: pa.Array) -> pa.Array:
        out: list = [None] * len(vectors)
        for rows, x in _units(vectors):
            d, width = x.shape[1], 2 << max(x.shape[1] - 1, 0).bit_length()
            for r, y in zip(rows, x):
                own = []
                for t in range(tables):
                    codes = probed(y, t, axes[d], probes[d], seed)
                    fines = _fine(codes, width)
                    for c in np.unique(codes[:, 0]):
                        own.append({"tab": t, "code": int(c), "fines": np.sort(fines[codes[:, 0] == c]).tolist()})
                out[r] = own
        return pa.array(out, kind)

    return asked


def _ranked(found: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The nearest of one block of indexed vectors for each query that probes it;
    without ``fines`` all of the block are met."""

    def ranked(index: pa.Table, queries: pa.Table) -> pa.Table:
        out_q, out_v, out_s = [], [], []
        if len(index) and len(queries):
            x, ids = matrix(index["vector"]), index["vec"].to_numpy()
            fine = fines = None
            if "fines" in queries.column_names:
                fine, fines = index["fine"].to_numpy(), queries["fines"].to_pylist()
                order = np.argsort(fine, kind="stable")
                x, ids, fine = x[order], ids[order], fine[order]
            for k, (q, y) in enumerate(zip(queries["query"].to_numpy(), matrix(queries["ask"]))):
                met = np.arange(len(ids))
                if fines is not None:
                    starts, ends = (np.searchsorted(fine, fines[k], side) for side in ("left", "right"))
                    met = np.concatenate([met[a:b] for a, b in zip(starts, ends)])
                d = x[met] - y
                distance = np.sqrt(np.einsum("ij,ij->i", d, d))
                if len(met) > found + 1:
                    near = np.flatnonzero(distance <= np.partition(distance, found)[found])
                    met, distance = met[near], distance[near]
                other = np.flatnonzero(ids[met] != q)
                met, distance = met[other], distance[other]
                best = np.lexsort((ids[met], distance))[:found]
                out_q += [q] * len(best)
                out_v += ids[met[best]].tolist()
                out_s += distance[best].tolist()
        return pa.table(
            {"query": pa.array(out_q, pa.int64()), "vec": pa.array(out_v, pa.int64()), "score": pa.array(out_s, pa.float64())}
        )

    return ranked


PAIRS = "query long, vec long, score double"


def _best(pairs: DataFrame, found: int) -> DataFrame:
    """The ``found`` nearest of each query, as an array; first of each share of the
    pairs, then of all."""
    share = F.pmod(F.xxhash64("vec"), F.lit(16))
    nearest = F.slice(F.array_sort(F.collect_set(F.struct("score", "vec"))), 1, found)
    part = pairs.groupBy("query", share.alias("share")).agg(nearest.alias("near"))
    return part.groupBy("query").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("near")))), 1, found).alias("near"))


def _exact(rows: DataFrame, asked: DataFrame, found: int, block: int) -> DataFrame:
    """``query, near`` of each query, compared with every row of its length, in blocks."""
    length = F.size("vector")
    blocks = settle(rows.groupBy(length.alias("length")).agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("blocks")))
    parts = settle(asked.groupBy("length").agg(F.ceil(F.count(F.lit(1)) / F.lit(ASKED)).cast("int").alias("parts")))
    each = asked.select("query", "ask", "length")
    each = join_dimension(join_dimension(each, blocks, ["length"], settled=True, spread="query"), parts, ["length"], settled=True, spread="query")
    each = each.withColumn("part", F.pmod(F.xxhash64("query"), F.col("parts")).cast("int"))
    each = each.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    every = rows.select("vec", "vector", length.alias("length"))
    every = join_dimension(join_dimension(every, blocks, ["length"], settled=True, spread="vec"), parts, ["length"], settled=True, spread="vec")
    every = every.withColumn("block", F.pmod(F.xxhash64("vec"), F.col("blocks")).cast("int"))
    every = every.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    on = ["length", "block", "part"]
    met = (
        every.select(*on, "vec", "vector")
        .groupBy(*on)
        .cogroup(each.select(*on, "query", "ask").groupBy(*on))
        .applyInArrow(_ranked(found), PAIRS)
    )
    return _best(met, found)


def choose_probes(
    rows: DataFrame, asked: DataFrame, axes: dict[int, int], found: int, tables: int, block: int, sample: int, target: float, seed: int
) -> dict[int, int]:
    """For each length of vector, how many codes a query must probe in every table to
    reach ``target`` of the true neighbours of the sampled queries; 0 if no number does.

    At most ``sample`` queries, those of least hash, and their neighbours come to the
    driver.
    """
    some = settle(asked.orderBy(F.xxhash64("query"), "query").limit(sample))
    truth = settle(_exact(rows, some, found, block).select("query", F.explode("near.vec").alias("vec")))
    vectors = join_dimension(rows.select("vec", "vector"), truth, ["vec"], settled=True, spread="vec").collect()
    near: dict[int, list] = {}
    for r in vectors:
        near.setdefault(r["query"], []).append(r["vector"])
    ranks: dict[int, list] = {d: [] for d in axes}
    unit = lambda v: np.asarray(v, dtype="f8") / np.linalg.norm(np.asarray(v, dtype="f8"), axis=-1, keepdims=True)
    for r in some.collect():
        if r["query"] in near:
            ranks[r["length"]].append(reached_at(unit(r["ask"]), unit(near[r["query"]]), tables, axes[r["length"]], seed))
    out = {}
    for d, own in ranks.items():
        order = np.sort(np.concatenate(own)) if own else np.ones(1)
        needed = order[min(len(order) - 1, int(np.ceil(target * len(order))) - 1)]
        out[d] = int(needed) if np.isfinite(needed) else 0
    return out


def nearest_neighbours(
    df: DataFrame,
    queries: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    found: int = 10,
    tables: int = TABLES,
    probes: int | None = None,
    block: int = BLOCK,
    seed: int = 5,
    sample: int = SAMPLE,
    target: float = TARGET,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``key`` and ``score`` (Euclidean distance).

    ``queries`` is a condition on the rows of ``df``; every other row is a
    candidate. Ties go to the smaller key. A vector that is null, zero or has a
    null or non-finite part takes no part, nor does a null key. If a key repeats,
    its least vector counts; a query meets only vectors of its own length. With
    fewer than ``found`` candidates all are returned; an empty table or query set
    gives an empty result. ``key`` is an integer.

    Every query probes ``probes`` codes in each table, by default as many as reach
    ``target`` of the true neighbours of ``sample`` queries; with 0 it is compared
    with every row.
    """
    rows = df.where(sound(col(vector)) & col(key).isNotNull()).select(
        col(key).cast("long").alias("vec"), col(vector).alias("vector"), F.coalesce(queries, F.lit(False)).alias("asks")
    )
    rows = store(rows.groupBy("vec").agg(F.min("vector").alias("vector"), F.max("asks").alias("asks")))
    length = F.size("vector")
    asked = rows.where("asks").select(F.col("vec").alias("query"), F.col("vector").alias("ask"), length.alias("length"))
    counts = {r["length"]: r["n"] for r in rows.groupBy(length.alias("length")).agg(F.count(F.lit(1)).alias("n")).collect()}
    axes = {d: axes_for(n, d) for d, n in counts.items()}
    if probes is None:
        many = choose_probes(rows, asked, axes, found, tables, block, sample, target, seed)
    else:
        many = dict.fromkeys(axes, probes)
    probing = [d for d, p in many.items() if p]
    if probing:
        some = F.col("length").isin(probing)
        best = store(_best(_met(rows, asked.where(some), tables, axes, many, found, block, seed), found))
        # queries that met too few meet every row
        goal = F.lit(0)
        for d in probing:
            goal = F.when(F.col("length") == d, F.least(F.lit(counts[d] - 1), F.lit(found))).otherwise(goal)
        met_of = best.select("query", F.size("near").alias("met"))
        short = asked.join(met_of, "query", "left").where(~some | (F.coalesce("met", F.lit(0)) < goal))
        short = settle(short.select("query", "ask", "length"))
        if not short.isEmpty():
            best = best.join(short.select("query"), "query", "left_anti").unionByName(_exact(rows, short, found, block))
    else:
        best = _exact(rows, asked, found, block)
    return best.select(F.col("query").alias("query_id"), F.posexplode("near").alias("rank", "near")).select(
        "query_id", (F.col("rank") + 1).alias("rank"), F.col("near.vec").alias(key), F.col("near.score").alias("score")
    )


def _met(
    rows: DataFrame, asked: DataFrame, tables: int, axes: dict[int, int], many: dict[int, int], found: int, block: int, seed: int
) -> DataFrame:
    """``query, vec, score`` of what each query meets under the codes it probes, the
    nearest of each block.

    A place is a table and first axis; the other axes of a code are told apart inside.
    """
    kind = T.ArrayType(
        T.StructType([T.StructField("tab", T.IntegerType()), T.StructField("code", T.IntegerType()), T.StructField("fine", T.LongType())])
    )
    wanted = T.ArrayType(
        T.StructType(
            [T.StructField("tab", T.IntegerType()), T.StructField("code", T.IntegerType()), T.StructField("fines", T.ArrayType(T.LongType()))]
        )
    )
    home, near = F.arrow_udf(_homes(tables, axes, seed), kind), F.arrow_udf(_probes(tables, axes, many, seed), wanted)
    own = rows.where(F.size("vector").isin([d for d, p in many.items() if p]))
    index = own.select("vec", "vector", F.size("vector").alias("length"), F.explode(home("vector")).alias("h"))
    index = index.select("vec", "vector", "length", "h.tab", "h.code", "h.fine")
    probing = asked.select("query", "ask", "length", F.explode(near("ask")).alias("h"))
    probing = probing.select("query", "ask", "length", "h.tab", "h.code", "h.fines")
    place = ["length", "tab", "code"]
    # at most two codes per axis, table and length
    blocks = settle(index.groupBy(*place).agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("blocks")))
    parts = settle(probing.groupBy(*place).agg(F.ceil(F.count(F.lit(1)) / F.lit(ASKED)).cast("int").alias("parts")))
    sizes = settle(blocks.join(parts, place))
    index = join_dimension(index, sizes, place, settled=True, spread="vec")
    index = index.withColumn("block", F.pmod(F.xxhash64("vec", "tab"), F.col("blocks")).cast("int"))
    index = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    probing = join_dimension(probing, sizes, place, settled=True, spread="query")
    probing = probing.withColumn("part", F.pmod(F.xxhash64("query"), F.col("parts")).cast("int"))
    probing = probing.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    on = [*place, "block", "part"]
    return (
        index.select(*on, "vec", "vector", "fine")
        .groupBy(*on)
        .cogroup(probing.select(*on, "query", "ask", "fines").groupBy(*on))
        .applyInArrow(_ranked(found), PAIRS)
    )


def recall(df: DataFrame, result: DataFrame, queries: Column, key: str = "vec_id", vector: str = "embedding", found: int = 10, block: int = BLOCK) -> float:
    """Share of the true nearest neighbours, by comparison with every row in
    blocks, that ``result`` holds; 1.0 if there are none."""
    everything = nearest_neighbours(df, queries, key, vector, found, probes=0, block=block)
    truth = everything.select("query_id", key)
    n = truth.count()
    return truth.join(result, ["query_id", key], "left_semi").count() / n if n else 1.0
