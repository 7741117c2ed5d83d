"""Near-duplicate documents by fast similarity sketches.

A sketch has one coordinate per bin. In each round every element of the set falls
into one bin by its hash, and the smallest hash of a bin stays; bins filled by an
earlier round are not touched again. After as many rounds as bins, round ``k`` puts
all elements into bin ``k``, so every coordinate is filled. Two sets agree on a
coordinate with the chance of their similarity, and the share of equal coordinates
is at least as concentrated as with independent hashes, at the cost of little more
than one hash per element.

Coordinates are cut into bands; documents that share a band are candidates.
Documents with equal sets are one class from the start. Each class is first
compared with the least member of its bands. Bands that still hold more than one
component are compared in blocks by their sketches, which gives groups of components
that may be linked; all their members are compared in blocks again, with the full
sets, but for those of one component. A block emits no more than the links that
connect it. All links are confirmed on the full sets.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.components import components
from gridloom.llm.frames import col, released
from gridloom.llm.words import BASE, batch_word_hashes, mix, shingle_hashes
from gridloom.plans.joins import join_dimension, settle, store

BINS = 125
MISS = 5e-5  # chance that a pair just at the threshold shares no band, and that its sketches seem too far
BLOCK = 512  # sketches compared at a time
UNFILLED = np.uint64(2**64 - 1)
ELEMENTS, BATCH_DOCS = 150_000, 2_000  # elements and documents sketched at a time

def similarity_sketches(sets: list[np.ndarray], bins: int = BINS) -> np.ndarray:
    """One row of ``bins`` coordinates per set; a set without elements stays unfilled."""
    out = np.full(len(sets) * bins, UNFILLED, dtype=np.uint64)
    if not sets:
        return out.reshape(0, bins)
    sizes = np.array([len(s) for s in sets])
    owner, items = np.repeat(np.arange(len(sets)), sizes), np.concatenate(sets)
    for k in range(2 * bins):
        if not len(items):
            break
        h = mix(items, 10 + k)
        if k < bins:
            place = ((h >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
        else:
            place = np.full(len(h), k - bins, dtype=np.uint64)
        slot = owner * bins + place.astype(np.int64)
        if k == 0:
            np.minimum.at(out, slot, h)
        else:
            free = out[slot] == UNFILLED
            np.minimum.at(out, slot[free], h[free])
        if k < 8 or k % 8 == 0:
            lacking = (out.reshape(len(sets), bins) == UNFILLED).any(axis=1)
            stay = lacking[owner]
            owner, items = owner[stay], items[stay]
    return out.reshape(len(sets), bins)


def band_rows(percent: int, bins: int = BINS) -> int:
    """The most coordinates a band may have: five for 80 to 85 percent."""
    good = [r for r in range(1, 21) if (1 - (percent / 100) ** r) ** (bins // r) <= MISS]
    return max(good, default=1)


def least_share(percent: int, bins: int = BINS) -> float:
    """The largest share of equal coordinates that a pair just at the threshold
    falls below with a chance of no more than ``MISS``."""
    p, below, k = percent / 100, 0.0, 0
    while k < bins:
        below += math.comb(bins, k) * p**k * (1 - p) ** (bins - k)
        if below > MISS:
            break
        k += 1
    return k / bins


def band_keys(sketches: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band, different for every band."""
    parts = sketches[:, : sketches.shape[1] // rows * rows].reshape(len(sketches), -1, rows)
    with np.errstate(over="ignore"):
        h = parts[:, :, 0].copy()
        for r in range(1, parts.shape[2]):
            h = mix(h * BASE + parts[:, :, r], 5)
        return mix(h + np.arange(h.shape[1], dtype=np.uint64)[None, :] * BASE, 6).astype(np.int64)


def set_digest(items: np.ndarray) -> bytes:
    """128 bits that depend on the elements only."""
    with np.errstate(over="ignore"):
        return np.array([mix(items, 7).sum(dtype=np.uint64), mix(items, 8).sum(dtype=np.uint64)], dtype="<u8").tobytes()


def _signatures(width: int, rows: int) -> Callable[[Iterator], Iterator]:
    """Each batch of texts to batches of set size, digest, band keys and the low
    bits of the sketch, a limited number of elements at a time."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets: list[np.ndarray] = []
            lo = size = 0
            for words in batch_word_hashes(batch["text"]):
                sets.append(shingle_hashes(words, width))
                size += len(sets[-1])
                if size > ELEMENTS or len(sets) >= BATCH_DOCS:
                    yield signatures(batch["key"].slice(lo, len(sets)), sets)
                    lo, size, sets = lo + len(sets), 0, []
            if sets:
                yield signatures(batch["key"].slice(lo, len(sets)), sets)

    def signatures(keys: pa.Array, sets: list[np.ndarray]) -> pa.RecordBatch:
        sketches = similarity_sketches(sets)
        bands = band_keys(sketches, rows)
        short = (sketches & np.uint64(0xFFFF)).astype("<u2")
        filled = [len(s) > 0 for s in sets]
        return pa.RecordBatch.from_arrays(
            [
                keys,
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([set_digest(s) if f else None for s, f in zip(sets, filled)], pa.binary()),
                pa.array([k if f else None for k, f in zip(bands, filled)], pa.list_(pa.int64())),
                pa.array([e.tobytes() if f else None for e, f in zip(short, filled)], pa.binary()),
            ],
            names=["key", "n", "digest", "bands", "sketch"],
        )

    return signed


def _full_sets(width: int) -> Callable[[Iterator], Iterator]:
    """The sets of those texts that still have the digest asked for; a key may
    repeat with another text."""

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, items, size = [], [], 0
            for want, words in zip(batch["want"].to_pylist(), batch_word_hashes(batch["text"])):
                s = shingle_hashes(words, width)
                if set_digest(s) == want:
                    digests.append(want)
                    items.append(s.tobytes())
                    size += len(s)
                if size > ELEMENTS:
                    yield pa.RecordBatch.from_pydict({"digest": pa.array(digests, pa.binary()), "items": pa.array(items, pa.binary())})
                    digests, items, size = [], [], 0
            yield pa.RecordBatch.from_pydict({"digest": pa.array(digests, pa.binary()), "items": pa.array(items, pa.binary())})

    return full


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether 100 times the intersection reaches ``percent`` times the union."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common)


def _linked(percent: int) -> Callable[[Iterator], Iterator]:
    """The pairs whose full sets are similar enough."""

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [
                similar(np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8"), percent)
                for x, y in zip(batch["x"], batch["y"])
            ]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return linked


def _joins(label: np.ndarray, left: np.ndarray, right: np.ndarray, sketch: np.ndarray, least: float, good: Callable[[int, int], bool]) -> list[tuple[int, int]]:
    """Pairs that join different labels: sketches agree on ``least`` of the
    coordinates and ``good`` says so, the most alike first. ``label`` is changed."""
    out = []
    for i in left:
        same = (sketch[right] == sketch[i]).mean(axis=1)
        near = np.flatnonzero((same >= least) & (label[right] != label[i]))
        near = right[near[np.argsort(-same[near], kind="stable")]]
        for j in near:
            if label[j] != label[i] and good(i, j):
                out.append((i, j))
                label[label == label[j]] = label[i]
    return out


def _sides(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    side = group["side"].to_numpy()
    sketch = np.frombuffer(b"".join(group["sketch"].to_pylist()), "<u2").reshape(len(group), -1)
    label = np.unique(np.array(group["root"].to_pylist(), dtype=object), return_inverse=True)[1]
    return np.flatnonzero(side != 2), np.flatnonzero(side != 1), sketch, label


def _pairs(group: pa.Table, name: str, found: list[tuple[int, int]]) -> pa.Table:
    names = group[name].to_pylist()
    return pa.table({"a": pa.array([names[i] for i, _ in found], pa.binary()), "b": pa.array([names[j] for _, j in found], pa.binary())})


def _likely(least: float) -> Callable[[pa.Table], pa.Table]:
    """Of two blocks of a band, pairs of components that connect all that have
    members whose sketches are close."""

    def likely(group: pa.Table) -> pa.Table:
        left, right, sketch, label = _sides(group)
        return _pairs(group, "root", _joins(label, left, right, sketch, least, lambda i, j: True))

    return likely


def _confirmed(least: float, percent: int) -> Callable[[pa.Table], pa.Table]:
    """Of two blocks of likely groups, links that connect all that are linked,
    each confirmed on the full sets."""

    def confirmed(group: pa.Table) -> pa.Table:
        left, right, sketch, label = _sides(group)
        items, pack = group["items"], np.array(group["likely"].to_pylist(), dtype=object)
        whole = [np.frombuffer(items[k].as_buffer(), "<u8") for k in range(len(group))]

        def linked(i: int, j: int) -> bool:
            return similar(whole[i], whole[j], percent)

        found: list[tuple[int, int]] = []
        for one in dict.fromkeys(pack):
            inside = pack == one
            found += _joins(label, left[inside[left]], right[inside[right]], sketch, least, linked)
        return _pairs(group, "digest", found)

    return confirmed


def _blocked(members: DataFrame, key: str) -> DataFrame:
    """Each member of a ``key`` with several components once for every block it is
    compared with: a block meets itself (side 0) and every other block once (sides 1
    and 2), but blocks of one component do not meet. A component of more than
    ``BLOCK`` members has blocks of its own; the others share theirs."""
    sized = members.groupBy(key, "root").agg(F.count(F.lit(1)).alias("size"))
    sized = store(sized.withColumn("unit", F.when(F.col("size") > BLOCK, F.col("root")).otherwise(F.lit(b""))))
    units = sized.groupBy(key, "unit").agg(F.count(F.lit(1)).alias("roots"), F.ceil(F.sum("size") / BLOCK).alias("blocks"))
    of_key = Window.partitionBy(key)
    first = F.sum("blocks").over(of_key.orderBy("unit")) - F.col("blocks")
    units = units.select(key, "unit", "blocks", first.alias("first"), F.sum("blocks").over(of_key).alias("total"), F.sum("roots").over(of_key).alias("roots"))
    units = settle(units.where("roots > 1").drop("roots"))
    places = settle(join_dimension(sized.select(key, "root", "unit"), units, [key, "unit"], settled=True, spread="root"))
    here = join_dimension(members, places, [key, "root"], settled=True, spread="digest")
    block = F.col("first") + F.pmod(F.xxhash64("digest", F.lit(3)), F.col("blocks"))
    foreign = (F.col("unit") == F.lit(b"")) | (F.col("other") < F.col("first")) | (F.col("other") >= F.col("first") + F.col("blocks"))
    here = here.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("total") - 1))).where(foreign)
    side = F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2)
    return here.withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other")).withColumn("side", side)


def _rest(members: DataFrame, stands: DataFrame, sets: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Links between the components that share a band."""
    least = least_share(percent)
    own = roots.withColumnRenamed("node", "digest")
    placed = members.join(own, "digest", "left").withColumn("root", F.coalesce("root", "digest"))
    here = settle(_blocked(placed, "key"))
    wanted = settle(placed.select("digest", "root").distinct())
    sketches = join_dimension(stands.select("digest", "sketch"), wanted.select("digest"), ["digest"], settled=True, spread="digest")
    sketches = store(sketches.dropDuplicates(["digest"]))
    near = (
        here.join(sketches.hint("merge"), "digest")
        .select("key", "lo", "hi", "side", "digest", "root", "sketch")
        .groupBy("key", "lo", "hi")
        .applyInArrow(_likely(least), "a binary, b binary")
    )
    # components with a link between them are in one likely group with all their
    # members, and there all pairs of different components are tried
    likely = settle(components(near).select(F.col("node").alias("root"), F.col("root").alias("likely")))
    named = store(join_dimension(wanted, likely, ["root"], settled=True, spread="digest"))
    small = named.groupBy("likely").count().where(F.col("count") <= BLOCK).agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n")).first()["n"]
    pack = F.when(F.col("total") > 1, F.xxhash64("likely")).otherwise(F.pmod(F.xxhash64("likely"), F.lit(1 + small // BLOCK)))
    full = sketches.join(sets, "digest")
    return (
        _blocked(named, "likely")
        .withColumn("pack", pack)
        .join(full.hint("merge"), "digest")
        .select("pack", "lo", "hi", "side", "likely", "digest", "root", "sketch", "items")
        .groupBy("pack", "lo", "hi")
        .applyInArrow(_confirmed(least, percent), "a binary, b binary")
    )


def near_duplicates(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    percent: int = 85,
    width: int = 5,
) -> DataFrame:
    """One row per row of ``df``: its ``key``, ``n_shingles``, ``component_id``, ``kept``.

    Two documents are linked if 100 times the size of their sets' intersection is
    at least ``percent`` times that of the union. A component's id is the smallest
    key in it, and the row with that key is kept. A document without words, or with
    a null text or a null key, is linked with nothing; a null key is its own
    component, null, and kept. Rows that repeat a key and its text have the same
    set and component; rows that repeat a key with another text are judged by
    their own texts. An empty table gives an empty result.
    """
    docs = df.select(col(key).alias("key"), col(text).alias("text"))
    fields = f"key {df.schema[key].dataType.simpleString()}, n long, digest binary, bands array<long>, sketch binary"
    signed = store(docs.mapInArrow(released(_signatures(width, band_rows(percent))), fields))
    classes = signed.where(F.col("digest").isNotNull() & F.col("key").isNotNull())
    classes = settle(classes.groupBy("digest").agg(F.min("key").alias("rep")))
    # a row that repeats stands for its class twice, which changes nothing below
    stands = signed.withColumnRenamed("key", "rep")
    stands = join_dimension(stands, classes, ["digest", "rep"], "left_semi", settled=True, spread="rep")
    exploded = stands.select("digest", F.explode("bands").alias("key"))
    shared = exploded.groupBy("key").agg(F.min("digest").alias("leader"), F.max("digest").alias("other"))
    shared = settle(shared.where("leader != other").select("key", "leader"))
    members = store(join_dimension(exploded, shared, ["key"], settled=True, spread="digest"))
    first = members.where("digest != leader").groupBy("digest").agg(F.min("leader").alias("a"))
    first = settle(first.select("a", F.col("digest").alias("b")))
    involved = settle(members.select("digest").distinct())

    wanted = join_dimension(classes, involved, ["digest"], settled=True, spread="rep")
    wanted = settle(wanted.select(F.col("rep").alias("key"), F.col("digest").alias("want")))
    sets = join_dimension(docs, wanted, ["key"], settled=True, spread="text").select("want", "text")
    sets = sets.mapInArrow(released(_full_sets(width)), "digest binary, items binary")
    sets = store(sets.groupBy("digest").agg(F.min("items").alias("items")))

    def confirmed(pairs: DataFrame) -> DataFrame:
        one = sets.select(F.col("digest").alias("a"), F.col("items").alias("x"))
        two = sets.select(F.col("digest").alias("b"), F.col("items").alias("y"))
        both = pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y")
        return settle(both.mapInArrow(released(_linked(percent)), "a binary, b binary"))

    links = confirmed(first)
    roots = components(links)
    rest = settle(_rest(members.select("key", "digest"), stands, sets, roots, percent))
    if not rest.isEmpty():
        roots = components(links.unionByName(rest))

    grouped = classes.select("digest", "rep").join(roots.withColumnRenamed("node", "digest"), "digest")
    grouped = settle(grouped)
    least = grouped.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = grouped.join(least, "root").select("digest", "component_id")
    named = classes.select("digest", "rep").join(named, "digest", "left").select(
        "digest", F.coalesce("component_id", "rep").alias("component_id")
    )
    rows = join_dimension(signed.select("key", "n", "digest"), named, ["digest"], "left", spread="key")
    component = F.when(F.col("key").isNotNull(), F.coalesce("component_id", "key"))
    return rows.select(
        F.col("key").alias(key),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        (component.isNull() | (component == F.col("key"))).alias("kept"),
    )


def drop_near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 85, width: int = 5) -> DataFrame:
    """The rows of ``df`` without those whose component has a smaller key; all its
    columns.

    Rows with a null key, and rows without words, stay. Of rows that repeat both
    key and text one stays. A key that repeats with other texts goes only if every
    row of it would.
    """
    judged = near_duplicates(df, key, text, percent, width)
    keys = store(judged.where(col(key).isNotNull()).groupBy(col(key)).agg(F.max("kept").alias("stays"), F.count(F.lit(1)).alias("rows")))
    gone = settle(keys.where(~F.col("stays")).select(key))
    left = join_dimension(df, gone, [key], "left_anti", settled=True, spread=text)
    repeated = settle(keys.where(F.col("stays") & (F.col("rows") > 1)).select(key))
    if repeated.isEmpty():
        return left
    once = join_dimension(left, repeated, [key], "left_anti", settled=True, spread=text)
    return once.unionByName(join_dimension(left, repeated, [key], "left_semi", settled=True, spread=text).dropDuplicates([key, text]))
