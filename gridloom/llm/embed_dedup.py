"""Near-duplicate vectors by NN-descent.

Equal vectors are one node. Every node starts with its nearest among those that
share its nearest signed axes under some rotations. A refinement joins each node's
neighbours, and those that name it as theirs, with each other, and keeps the best
for every list. Threshold edges of the lists make components. A list full of such
edges is saturated: it is enlarged by all that neighbours of neighbours reach, its
component, which is compared in blocks so that only counts leave a task; and the
list itself then takes only nodes of other components. Recall is audited against
every vector on some nodes of all, some that have links and those that nearly have,
and if a link of theirs is missing the descent goes on from further rotations. If
rounds run out before an audit passes, all vectors are compared, in blocks.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.ann import CODES, axis_codes, matrix, sound
from gridloom.llm.components import components
from gridloom.llm.frames import col
from gridloom.plans.joins import join_dimension, settle, store

NEIGHBOURS = 6  # length of a list
TABLES = 6  # rotations a round starts from
ROUNDS, REFINEMENTS = 10, 2
BUCKET = 256  # nodes of a start bucket compared at a time
BLOCK = 512
AUDITED = 256  # nodes of each kind an audit compares with every vector, about
EXACT_BLOCK = 4096  # nodes of a block where all are compared

LISTS = "node long, near long, cos double"


def unit(vectors: pa.Array) -> np.ndarray:
    x = matrix(vectors)
    # by the largest part first: a square may be too large or small for a double
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _best_of_bucket(most: int) -> Callable[[pa.Table], pa.Table]:
    """The nearest, of other components, of each node of two blocks of a bucket in
    the other block."""

    def best(group: pa.Table) -> pa.Table:
        side, node, root = group["side"].to_numpy(), group["node"].to_numpy(), group["root"].to_numpy()
        x = unit(group["vector"])
        left, right = np.flatnonzero(side != 2), np.flatnonzero(side != 1)
        cos = np.where(root[left][:, None] == root[right][None, :], -2, x[left] @ x[right].T)
        ways = [(left, right, cos)]
        if len(left) and side[left[0]] != 0:
            ways.append((right, left, cos.T))
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for own, other, c in ways:
            k = min(most, len(other))
            if not len(own) or not k:
                continue
            near = np.argpartition(-c, k - 1, axis=1)[:, :k]
            top = np.take_along_axis(c, near, 1)
            i, j = np.nonzero(top > -2)
            out.append((node[own[i]], node[other[near[i, j]]], top[i, j]))
        node_, near_, cos_ = (np.concatenate(part) for part in zip(*out)) if out else ([], [], [])
        return pa.table({"node": pa.array(node_, pa.int64()), "near": pa.array(near_, pa.int64()), "cos": pa.array(cos_, pa.float64())})

    return best


JOINED = T.ArrayType(
    T.StructType([T.StructField("node", T.LongType()), T.StructField("near", T.LongType()), T.StructField("cos", T.DoubleType())])
)
ARROW_JOINED = pa.list_(pa.struct([("node", pa.int64()), ("near", pa.int64()), ("cos", pa.float64())]))


def _local_join(groups: pa.Array) -> pa.Array:
    """Pairs within each group of neighbours that would enter a list: of different
    components, and better than the worst the node has."""
    out = []
    for group in groups:
        members = group.values
        node, worst = members.field("node").to_numpy(), members.field("worst").to_numpy()
        root = members.field("root").to_numpy()
        x = unit(members.field("vector"))
        cos = np.where(root[:, None] == root[None, :], -2, x @ x.T)
        i, j = np.nonzero(cos > worst[:, None])
        out.append([{"node": a, "near": b, "cos": c} for a, b, c in zip(node[i].tolist(), node[j].tolist(), cos[i, j].tolist())])
    return pa.array(out, ARROW_JOINED)


def _top(pairs: DataFrame, most: int) -> DataFrame:
    """The best ``most`` of each node."""
    ranked = F.slice(F.sort_array(F.collect_set(F.struct("cos", "near")), asc=False), 1, most)
    lists = pairs.groupBy("node", "near").agg(F.max("cos").alias("cos")).groupBy("node").agg(ranked.alias("l"))
    return lists.select("node", F.explode("l").alias("l")).select("node", "l.near", "l.cos")


def _depth(nodes: DataFrame) -> int:
    """Axes per code, so that a bucket of evenly spread vectors has about ``BUCKET``
    nodes."""
    r = nodes.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.avg(F.size("vector")), F.lit(2)).alias("d")).first()
    return max(1, round(math.log(max(r["n"] / BUCKET, 1)) / math.log(max(2 * r["d"], 2))))


def _start(nodes: DataFrame, most: int, depth: int, seed: int) -> DataFrame:
    codes = F.arrow_udf(axis_codes(TABLES, depth, seed), CODES)
    filed = nodes.select("node", "root", "vector", F.posexplode(codes("vector")).alias("tab", "code"))
    filed = filed.select("node", "root", "vector", F.xxhash64(F.size("vector"), "tab", "code").alias("bucket"), "tab")
    sizes = filed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    sizes = settle(sizes.select("bucket", F.ceil(F.col("size") / BUCKET).cast("int").alias("parts")))
    filed = join_dimension(filed, sizes, ["bucket"], settled=True, spread="node")
    # every part of a bucket meets itself (side 0) and every other once (sides 1 and 2)
    filed = filed.withColumn("part", F.pmod(F.xxhash64("node", "tab", F.lit(seed)), F.col("parts")).cast("int"))
    filed = filed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    lo, hi = F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi")
    side = F.when(F.col("part") == F.col("other"), 0).when(F.col("part") < F.col("other"), 1).otherwise(2).alias("side")
    best = _best_of_bucket(most)
    return filed.select("bucket", lo, hi, side, "node", "root", "vector").groupBy("bucket", "lo", "hi").applyInArrow(best, LISTS)


def _refine(nodes: DataFrame, lists: DataFrame, inner: DataFrame, most: int, seed: int) -> DataFrame:
    """One round of joins between neighbours of neighbours; ``inner`` has neighbours
    of the same component, which only lead to others."""
    named = lists.unionByName(inner)
    forth = named.select(F.col("node").alias("at"), F.col("near").alias("node"))
    # of those that name a node, one for each of `most` places
    place = F.pmod(F.xxhash64("node", F.lit(seed)), F.lit(most)).alias("place")
    back = named.groupBy(F.col("near").alias("at"), place).agg(F.min(F.struct(F.xxhash64("node", F.lit(seed)), "node")).alias("m"))
    back = back.select("at", F.col("m.node").alias("node"))
    own = named.select(F.col("node").alias("at"), "node").distinct()
    around = forth.unionByName(back).unionByName(own).distinct()
    bounds = lists.groupBy("node").agg(F.when(F.count(F.lit(1)) >= most, F.min("cos")).otherwise(-1.5).alias("worst"))
    known = nodes.select("node", "root", "vector").join(bounds, "node", "left").select("node", "root", "vector", F.coalesce("worst", F.lit(-1.5)).alias("worst"))
    met = around.join(known, "node")
    joined = met.groupBy("at", F.size("vector").alias("length")).agg(F.collect_list(F.struct("node", "root", "worst", "vector")).alias("group"))
    pairs = joined.where(F.size("group") > 1).select(F.explode(F.arrow_udf(_local_join, JOINED)("group")).alias("p")).select("p.*")
    return _top(lists.unionByName(pairs), most)


def _counts(threshold: float) -> Callable[[pa.Table], pa.Table]:
    """How many vectors each node of one block links to in another block."""

    def counted(group: pa.Table) -> pa.Table:
        side, node, copies = group["side"].to_numpy(), group["node"].to_numpy(), group["copies"].to_numpy()
        root = group["root"].to_numpy()
        x = unit(group["vector"])
        left, right = np.flatnonzero(side != 2), np.flatnonzero(side != 1)
        near = ((x[left] @ x[right].T) >= threshold) & (root[left][:, None] == root[right][None, :])
        same = side[left[0]] == 0 if len(left) else False
        if same:
            np.fill_diagonal(near, False)
        n = near @ copies[right]
        out_node, out_n = [node[left]], [n]
        if not same and len(left):
            out_node.append(node[right])
            out_n.append(near.T @ copies[left])
        return pa.table({"node": pa.array(np.concatenate(out_node), pa.int64()), "n": pa.array(np.concatenate(out_n).astype("i8"), pa.int64())})

    return counted


def _links_within(nodes: DataFrame, roots: DataFrame, threshold: float) -> DataFrame:
    """Links of every node to the others of its component, counted block by block."""
    sizes = roots.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    sizes = settle(sizes.select("root", "size", F.ceil(F.col("size") / F.lit(BLOCK)).cast("int").alias("blocks")))
    small = sizes.where("blocks = 1").agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()["n"]
    # components of one block share groups, told apart by their root and length
    pack = F.when(F.col("blocks") > 1, F.col("root")).otherwise(-1 - F.pmod(F.xxhash64("root"), F.lit(1 + small // BLOCK)))
    placed = join_dimension(nodes.join(roots, "node"), sizes, ["root"], settled=True, spread="node")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("node", F.lit(9)), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    lo, hi = F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")
    side = F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2).alias("side")
    return (
        placed.select(pack.alias("pack"), F.size("vector").alias("length"), "root", lo, hi, side, "node", "copies", "vector")
        .groupBy("pack", "length", "lo", "hi")
        .applyInArrow(_counts(threshold), "node long, n long")
        .groupBy("node")
        .agg(F.sum("n").alias("n"))
    )


def _exact(nodes: DataFrame, threshold: float) -> DataFrame:
    """Links that connect all that are linked, from comparing all vectors in blocks;
    ``nodes`` have the ``root`` of what is connected already."""

    def joined(group: pa.Table) -> pa.Table:
        side, node = group["side"].to_numpy(), group["node"].to_numpy()
        label = np.unique(group["root"].to_numpy(), return_inverse=True)[1]
        x = unit(group["vector"])
        left, right = np.flatnonzero(side != 2), np.flatnonzero(side != 1)
        found: list[tuple[int, int]] = []
        for at in range(0, len(left), BLOCK):
            rows = left[at : at + BLOCK]
            i, j = np.nonzero((x[rows] @ x[right].T >= threshold) & (label[rows][:, None] != label[right][None, :]))
            for a, b in zip(rows[i], right[j]):
                if label[a] != label[b]:
                    found.append((a, b))
                    label[label == label[b]] = label[a]
        return pa.table({"node": pa.array([node[a] for a, _ in found], pa.int64()), "near": pa.array([node[b] for _, b in found], pa.int64())})

    sizes = nodes.groupBy(F.size("vector").alias("length")).agg(F.ceil(F.count(F.lit(1)) / EXACT_BLOCK).cast("int").alias("blocks"))
    placed = nodes.withColumn("length", F.size("vector")).join(F.broadcast(settle(sizes)), "length")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("node", F.lit(11)), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    lo, hi = F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")
    side = F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2).alias("side")
    placed = placed.select("length", lo, hi, side, "node", "root", "vector")
    return placed.groupBy("length", "lo", "hi").applyInArrow(joined, "node long, near long")


def _audit(nodes: DataFrame, lists: DataFrame, links: DataFrame, linked: DataFrame, threshold: float, seed: int) -> bool:
    """Whether some nodes, compared with every vector, have all their links."""
    total = nodes.count()
    share = max(1, total // AUDITED)
    # bounded samples: about AUDITED nodes of all, of those with links, and of those
    # without the ones whose nearest is closest, however many there are
    any_ = nodes.where(F.pmod(F.xxhash64("node", F.lit(seed)), F.lit(share)) == 0).limit(4 * AUDITED).select("node")
    ends = links.select("node").union(links.select("near")).distinct()
    tied = ends.orderBy(F.xxhash64("node", F.lit(seed))).limit(AUDITED)
    closest = lists.groupBy("node").agg(F.max("cos").alias("cos")).join(ends, "node", "left_anti")
    closest = closest.orderBy(F.desc("cos"), "node").limit(AUDITED).select("node")
    picked = settle(any_.union(tied).union(closest).distinct())
    some = nodes.select("node", "copies", "vector").join(F.broadcast(picked), "node", "left_semi")
    some = some.toArrow()
    if not len(some):
        return True
    by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    lengths = np.array([len(v) for v in some["vector"].to_pylist()])
    for n in np.unique(lengths):
        rows = pa.array(np.flatnonzero(lengths == n))
        by_length[int(n)] = (some["node"].take(rows).to_numpy(), unit(some["vector"].take(rows)))

    def compared(batches):
        for batch in (b.slice(k, BLOCK) for b in batches for k in range(0, len(b), BLOCK)):
            table = pa.Table.from_batches([batch])
            sizes = pc.list_value_length(table["vector"]).to_numpy()
            for n in np.unique(sizes):
                if int(n) not in by_length:
                    continue
                ids, x = by_length[int(n)]
                part = table.take(pa.array(np.flatnonzero(sizes == n)))
                near = unit(part["vector"]) @ x.T >= threshold
                near &= part["node"].to_numpy()[:, None] != ids[None, :]
                yield pa.RecordBatch.from_pydict(
                    {"node": pa.array(ids, pa.int64()), "n": pa.array(part["copies"].to_numpy() @ near, pa.int64())}
                )

    truth = nodes.select("node", "copies", "vector").mapInArrow(compared, "node long, n long").groupBy("node").agg(F.sum("n").alias("truth"))
    got = truth.join(linked, "node", "left").select("truth", F.coalesce("n", F.lit(0)).alias("n"))
    return got.where("n < truth").isEmpty()


def near_duplicate_vectors(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    threshold: float = 0.9,
    rounds: int = ROUNDS,
    seed: int = 3,
) -> DataFrame:
    """One row per row of ``df``: ``key``, ``n_links``, ``component_id``, ``kept``.

    Two rows are linked if the cosine of their vectors, in doubles, is at least
    ``threshold``; ``n_links`` counts the other rows linked directly. A component's
    id is its smallest key. A vector that is null, zero or has a null or non-finite
    part is linked with nothing, nor are vectors of different length; a null key
    has links but a null is no component's id unless all keys of it are null, and
    such a row is kept. Rows that repeat a key count as rows of their own. An empty
    table gives an empty result.
    """
    rows = df.select(col(key).alias("key"), F.when(sound(col(vector)), col(vector)).alias("vector"))
    same = rows.where(F.col("vector").isNotNull()).groupBy("vector").agg(F.min("key").alias("rep"), F.count(F.lit(1)).alias("copies"))
    nodes = store(same.withColumn("node", F.monotonically_increasing_id()))
    depth = _depth(nodes)
    roots = nodes.select("node", F.col("node").alias("root")).limit(0)
    empty = nodes.select("node", F.col("node").alias("near"), F.lit(1.0).alias("cos")).limit(0)
    lists, inner, links = empty, empty, empty
    for r in range(rounds):
        placed = store(nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
        lists = store(_top(_start(placed, NEIGHBOURS, depth, seed + 100 * r).unionByName(lists), NEIGHBOURS))
        for i in range(REFINEMENTS):
            lists = store(_refine(placed, lists, inner, NEIGHBOURS, seed + 100 * r + i))
        links = store(links.unionByName(lists.where(F.col("cos") >= threshold)))
        roots = components(links, "node", "near")
        linked = settle(_links_within(nodes, roots, threshold))
        if _audit(nodes, lists, links, linked, threshold, seed + r):
            break
        # from now on lists are of other components; the nearest links lead on
        inner = store(_top(links, NEIGHBOURS))
        here, there = roots.toDF("node", "ra"), roots.toDF("near", "rb")
        apart = lists.join(here, "node", "left").join(there, "near", "left")
        apart = apart.where(F.coalesce("ra", "node") != F.coalesce("rb", "near"))
        lists = store(apart.select("node", "near", "cos"))
    else:
        placed = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        roots = components(store(links.select("node", "near").unionByName(_exact(placed, threshold))), "node", "near")
        linked = settle(_links_within(nodes, roots, threshold))
    named = nodes.select("node", "rep", "copies", "vector").join(roots, "node", "left").join(linked, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    least = settle(named.groupBy("root").agg(F.min("rep").alias("least")))
    named = join_dimension(named, least, ["root"], settled=True, spread="node").select(
        "vector", "least", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    sane, odd = rows.where(F.col("vector").isNotNull()), rows.where(F.col("vector").isNull())
    found = join_dimension(sane, named, ["vector"], spread="key").select("key", "n_links", "least")
    found = found.unionByName(odd.select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("least")))
    return found.select(
        F.col("key").alias(key),
        "n_links",
        F.col("least").alias("component_id"),
        F.coalesce(F.col("least") == F.col("key"), F.lit(True)).alias("kept"),
    )
