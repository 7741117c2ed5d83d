"""Mixing sources to target weights by balanced sampling with the cube method.

Every document is taken a whole number of times, the same for all of a source, and
once more with the probability that is left. That last choice is balanced: the
flight phase moves the probabilities of three documents at a time along the one
direction that changes neither their expected count nor their expected words, until
one of them is decided. Blocks of a source fly on their own and leave two
undecided documents at most; these fly again together, level by level, until one
block is left for a whole source. There a dozen documents of all lengths wait, and
the landing tries every choice of them and of the two that the flight leaves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.frames import col, scratch, slices
from gridloom.llm.words import word_counts
from gridloom.plans.joins import join_dimension, settle, store
from gridloom.plans.numbering import number_rows

BLOCK_UNITS = 2_000  # documents of one source that fly together
MOST = 3  # a document is taken three times at most
EPS = 1e-9
LANDING = 12  # documents that wait for the landing, beside the two the flight leaves
COUNT_SHARE = 0.02  # weight of a document too many against the words of one


def word_count(text: Column) -> Column:
    """Words of a text; 0 for a null text."""

    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return map(word_counts, slices(batches))

    return F.arrow_udf(counted, T.LongType())(text)


def _move(p: list[float], u: Sequence[float], draw: float) -> list[float]:
    """Go from ``p`` along ``u`` or back until a probability is 0 or 1; the
    direction is drawn so that the expectation stays."""
    up = down = float("inf")
    for x, d in zip(p, u):
        if d > 0:
            up, down = min(up, (1 - x) / d), min(down, x / d)
        elif d < 0:
            up, down = min(up, x / -d), min(down, (1 - x) / -d)
    go = up if draw * (up + down) < down else -down
    return [0.0 if (y := x + go * d) < EPS else 1.0 if y > 1 - EPS else y for x, d in zip(p, u)]


def flight(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Decide all but two documents at most; ``p`` in order of flight."""
    out, live = p.astype("f8").copy(), []
    draws, d = rng.random(len(p) + 8), 0
    sizes = size.astype("f8")
    for i in np.flatnonzero((out > EPS) & (out < 1 - EPS)).tolist():
        live.append(i)
        while len(live) == 3:
            a, b, c = sizes[live[0]], sizes[live[1]], sizes[live[2]]
            # the direction orthogonal to (1, 1, 1) and (a, b, c)
            u = (c - b, a - c, b - a)
            top = max(abs(u[0]), abs(u[1]), abs(u[2]))
            u = (u[0] / top, u[1] / top, u[2] / top) if top > 0 else (1.0, -1.0, 0.0)
            moved = _move([out[j] for j in live], u, draws[d])
            d += 1
            for j, y in zip(live, moved):
                out[j] = y
            live = [j for j in live if 0 < out[j] < 1]
    return out


def landing(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Decide the last documents, a few, by the choice whose words and count come
    nearest to what is expected of them; the words weigh more."""
    out, sizes = p.copy(), size.astype("f8")
    live = np.flatnonzero((out > EPS) & (out < 1 - EPS))
    if len(live):
        chosen = (np.arange(1 << len(live))[:, None] >> np.arange(len(live)) & 1).astype("f8")
        words = chosen @ sizes[live] - out[live] @ sizes[live]
        count = chosen.sum(axis=1) - out[live].sum()
        scale = max(float(sizes[live].mean()), 1.0)
        out[live] = chosen[np.argmin((words / scale) ** 2 + (COUNT_SHARE * count) ** 2)]
    return np.round(out)


def _fly(seed: int, last: bool) -> Callable[[pa.Table], pa.Table]:
    def fly(group: pa.Table) -> pa.Table:
        group = group.sort_by([("size", "descending"), ("order", "ascending"), ("copy", "ascending")])
        first = group.slice(0, 1).to_pylist()[0]
        rng = np.random.default_rng([seed, first["place"], first["block"], len(group)])
        p, size = group["p"].to_numpy().copy(), group["size"].to_numpy()
        if last:
            # documents of all lengths wait for the landing
            live = np.flatnonzero((p > EPS) & (p < 1 - EPS))
            wait = live[np.unique(np.linspace(0, len(live) - 1, LANDING).astype(int))] if len(live) else live
            fly = np.setdiff1d(np.arange(len(p)), wait)
            p[fly] = flight(p[fly], size[fly], rng)
            p = landing(p, size)
        else:
            p = flight(p, size, rng)
        return group.set_column(group.column_names.index("p"), "p", pa.array(p, pa.float64()))

    return fly


def source_targets(sizes: DataFrame, weights: Sequence[float], most: int = MOST) -> DataFrame:
    """``source``, ``source_size``, ``place`` (by code point, null last) and ``target``.

    The targets share the sum of all sizes by weight, the weights repeating in
    order of place; a target stops at ``most`` times its source's size and the rest
    is shared again by weight. Sources are taken as few: one window holds them.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.array(*[F.lit(float(x)) for x in weights])
    known = sizes.withColumn("place", F.row_number().over(by_name) - 1).withColumn(
        "w", F.get(w, F.pmod(F.col("place"), F.lit(len(weights))))
    )
    # sources stop in order of size over weight; the first that does not stop
    # tells how much a unit of weight gets
    by_limit = Window.orderBy("limit", "place")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    filled = (
        known.withColumn("limit", F.lit(float(most)) * F.col("source_size") / F.col("w"))
        .withColumn("stopped", F.coalesce(F.sum(F.lit(float(most)) * F.col("source_size")).over(before), F.lit(0.0)))
        .withColumn("all", F.sum("source_size").over(whole).cast("double"))
        .withColumn("per", (F.col("all") - F.col("stopped")) / F.sum("w").over(onward))
        .withColumn("first", F.min(F.when(F.col("per") <= F.col("limit"), F.struct("limit", "place", "per"))).over(whole))
        .withColumn("per", F.col("first.per"))
    )
    target = F.least(F.lit(float(most)) * F.col("source_size"), F.coalesce(F.col("per") * F.col("w"), F.lit(0.0)))
    return filled.select("source", "source_size", F.col("place").cast("int").alias("place"), target.alias("target"))


def mix_plan(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = (5, 2, 1),
    seed: int = 23,
    block_units: int = BLOCK_UNITS,
) -> DataFrame:
    """How often each document is taken: ``key``, ``source``, ``size``,
    ``source_size``, ``target``, ``copies`` and ``copy``, one row per row of ``df``.

    Rows that agree in key, source and size are counted first and told apart by
    ``copy`` (from 0), so repeated rows and hot keys are spread like others and the
    plan depends on the rows' values only. A null text has size 0, a null source
    is the last source, a null key is a key like others. An empty table gives an
    empty plan. The plan is stored in the session's checkpoint folder.
    """
    rows = df.select(col(key).alias("key"), col(source).alias("source"), word_count(col(text)).alias("size"))
    units = store(rows.groupBy("source", "key", "size").agg(F.count(F.lit(1)).alias("rows")))
    sizes = units.groupBy("source").agg(
        F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.sum("rows").alias("units")
    )
    sizes = settle(sizes)
    targets = source_targets(sizes.drop("units"), weights).withColumnRenamed("source", "_s")
    targets = targets.join(sizes.select(F.col("source").alias("_s2"), "units"), F.col("_s").eqNullSafe(F.col("_s2"))).drop("_s2")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    targets = settle(
        targets.withColumn("rate", F.when(F.abs(rate - F.round(rate)) < 1e-12, F.round(rate)).otherwise(rate))
        .withColumn("_named", F.col("_s").isNotNull())
        .withColumn("_s", F.coalesce("_s", F.lit("")))
    )
    units = units.withColumn("_named", F.col("source").isNotNull()).withColumn("_s", F.coalesce("source", F.lit("")))
    placed = join_dimension(units, targets, ["_s", "_named"], settled=True, spread="key").drop("_s", "_named")
    single = F.explode(F.sequence(F.lit(0), F.col("rows").cast("int") - 1))
    placed = placed.withColumn("copy", single).withColumn("whole", F.floor("rate").cast("int"))
    placed = placed.withColumn("p", F.col("rate") - F.col("whole"))
    order = F.xxhash64(F.lit(seed), "source", "key", "size", "copy")
    blocks = F.ceil(F.col("units") / F.lit(block_units))
    state = placed.withColumn("order", order).withColumn("block", F.pmod(F.col("order"), blocks).cast("long"))
    fields = ["key", "source", "size", "source_size", "target", "copy", "whole", "place", "order", "block", "p"]
    state = state.select(*fields)
    most = targets.agg(F.max(F.ceil(F.col("units") / F.lit(block_units))).alias("b")).first()["b"] or 1

    decided: list[DataFrame] = []
    level = 0
    while True:
        last = most <= 1
        flown = store(state.groupBy("place", "block").applyInArrow(_fly(seed + level, last), state.schema))
        open_now = F.col("p").between(EPS, 1 - EPS)
        decided.append(flown.where(~open_now))
        if last:
            break
        # two of a block are left at most, so ten thousand blocks fit one again
        level, most = level + 1, -(-most // (block_units // 2))
        state = flown.where(open_now).withColumn("block", F.pmod(F.col("block"), F.lit(most)).cast("long"))
    plan = decided[0]
    for more in decided[1:]:
        plan = plan.unionByName(more)
    return plan.select(
        F.col("key").alias(key),
        F.col("source").alias(source),
        "size",
        "source_size",
        "target",
        (F.col("whole") + F.round("p").cast("int")).alias("copies"),
        "copy",
    )


def take_mix(df: DataFrame, plan: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of ``df``, each as often as ``plan`` takes it; the columns of ``df``.

    Which of several rows that agree in key, source and size has which number of
    copies is free; rows of that kind are numbered first, all others are not.
    """
    size, copy, copies, named, marked = scratch(df, "size", "copy", "copies", "named", "marked")
    on = [key, source, size]

    def joinable(frame: DataFrame) -> DataFrame:
        # null keys and sources join like values
        return frame.withColumn(named, F.coalesce(col(key).cast("string"), F.lit(""))).withColumn(
            marked,
            F.concat_ws("|", col(key).isNull().cast("string"), col(source).isNull().cast("string"), F.coalesce(col(source), F.lit(""))),
        )

    wanted = joinable(
        plan.select(col(key), col(source), F.col("size").alias(size), F.col("copy").alias(copy), F.col("copies").alias(copies))
    ).drop(key, source)
    counts = wanted.groupBy(named, marked, size).agg(F.count(F.lit(1)).alias("_rows"))
    repeated = settle(counts.where("_rows > 1").drop("_rows"))
    sized = joinable(df.withColumn(size, word_count(col(text))))
    ids = [named, marked, size]
    if repeated.isEmpty():
        rows = sized.withColumn(copy, F.lit(0))
    else:
        once = join_dimension(sized, repeated, ids, "left_anti", settled=True, spread=text).withColumn(copy, F.lit(0))
        many = join_dimension(sized, repeated, ids, "left_semi", settled=True, spread=text)
        many = number_rows(many.withColumn("_at", F.monotonically_increasing_id()), ids, [F.col("_at")], copy)
        many = many.withColumn(copy, (col(copy) - 1).cast("int")).drop("_at")
        rows = once.unionByName(many)
    taken = join_dimension(rows, wanted.where(col(copies) > 0), [*ids, copy], spread=text)
    return taken.withColumn(copy, F.explode(F.sequence(F.lit(1), col(copies)))).select(*[col(c) for c in df.columns])
