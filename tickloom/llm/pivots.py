"""Near-duplicate vectors by a pivot-permutation index.

Each vector is described by its nearest reference points (pivots) in their order.
Inverted lists hold the vectors under every two of their first pivots, so that two
vectors meet in as many lists as they share pairs of pivots; the number of pivots
shared follows from it. Vectors that meet are verified by their cosine.

Pivots are vectors of the table that lie apart, so that a dense group shares its
pivots. Their number grows with the square root of the
table, which keeps lists short. A list is compared block by block on arrays: links
are counted and spanned by a forest inside a block pair, never emitted pair by pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.blocks import RUN, block_pairs, dealt_in_runs, runs
from tickloom.llm.common import let, ship_code, stored
from tickloom.llm.components import components

COSINE = 0.93
#: First pivots kept of a vector's order, and how many two vectors must share.
PREFIX, SHARED = 6, 2
PAIRS = PREFIX * (PREFIX - 1) // 2
#: Pivots for one vector and beyond: LEAST + FACTOR * sqrt(vectors), MOST at most. The
#: bound keeps what every task needs of pivots under some MB; lists only grow beyond.
LEAST_PIVOTS, PIVOT_FACTOR, MOST_PIVOTS = 64, 1.0, 4096


def choose_pivots(vectors: DataFrame, seed: int = 0) -> np.ndarray:
    """Pivots by a hash of ids: a bounded sample, the same on every run."""
    total = vectors.count()
    wanted = min(int(LEAST_PIVOTS + PIVOT_FACTOR * math.sqrt(total)), MOST_PIVOTS)
    # Twice as many are drawn, as those of dense groups are thinned.
    order = F.xxhash64(F.lit(seed), F.col("vec_id"))
    rows = vectors.select("v", order.alias("o"), "vec_id").orderBy("o", "vec_id").limit(2 * wanted)
    found = [r[0] for r in rows.select("v").collect()]
    width = max(map(len, found), default=0)
    same = [v for v in found if len(v) == width]
    return thinned(normalised(np.array(same, np.float64).reshape(len(same), width)), wanted)


def thinned(drawn: np.ndarray, wanted: int, cosine: float = COSINE) -> np.ndarray:
    """The first ``wanted`` of the pivots drawn that lie apart.

    Members of a dense group that filled up with pivots would share too few of their
    nearest ones. Apart is beyond twice the angle of a link, or less where that leaves
    too few to tell vectors apart.
    """
    angle = 2 * math.acos(cosine)
    for apart in (angle, angle / 2, angle / 4):
        kept = np.empty_like(drawn)
        count = 0
        for v in drawn:
            if count < wanted and (kept[:count] @ v < math.cos(apart)).all():
                kept[count] = v
                count += 1
        if count >= min(wanted, 4 * PREFIX):
            return kept[:count]
    return drawn[:wanted]


def normalised(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision; scaled first, so that squares stay in range."""
    vectors = vectors.astype(np.float64)
    vectors /= np.abs(vectors).max(axis=1, keepdims=True, initial=0)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def usable(table: DataFrame) -> DataFrame:
    """Rows (vec_id, label, v) that can link: finite, not zero, with a label."""
    fine = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")),
    )
    rows = table.where(
        F.col("label").isNotNull() & F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
    ).where(F.size("embedding") > 0).where(fine)
    return rows.where(F.exists("embedding", lambda x: x != 0)).select(
        "vec_id", "label", F.col("embedding").alias("v")
    )


def direction(v: Column) -> Column:
    """A digest of the unit vector."""
    doubles = F.transform(v, lambda x: x.cast("double"))
    top = F.array_max(F.transform(doubles, lambda x: F.abs(x)))
    scaled = let(top, lambda t: F.transform(doubles, lambda x: x / t))

    def unit(s: Column) -> Column:
        norm = F.sqrt(F.aggregate(s, F.lit(0.0), lambda a, x: a + x * x))
        return let(norm, lambda n: F.transform(s, lambda x: x / n))

    return F.sha2(F.to_json(let(scaled, unit)), 256)


def nearest(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The first pivots of each vector, nearest first."""
    scores = vectors @ pivots.T
    count = min(PREFIX, pivots.shape[0])
    some = np.argpartition(-scores, count - 1, axis=1)[:, :count]
    order = np.argsort(-np.take_along_axis(scores, some, 1), axis=1, kind="stable")
    return np.take_along_axis(some, order, 1)


def describe(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Adds ``prefix``: the numbers of the first pivots in order.

    Vectors of another length than the pivots share one prefix, so all of them meet.
    """
    ship_code(vectors.sparkSession)
    sent = vectors.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points = sent.value
        for batch in batches:
            lists = batch.column(2)
            sizes = np.diff(lists.offsets.to_numpy())
            prefix: list[list[int]] = [[0] * PREFIX] * batch.num_rows
            same = np.flatnonzero(sizes == points.shape[1])
            if len(same) and len(points) > 1:
                flat = lists.take(pa.array(same)).flatten().to_numpy()
                found = nearest(normalised(flat.reshape(len(same), -1)), points).tolist()
                for i, p in zip(same.tolist(), found):
                    prefix[i] = p
            names = [*batch.schema.names, "prefix"]
            column = pa.array(prefix, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names)

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema.fields]
    return vectors.mapInArrow(run, ", ".join([*fields, "prefix array<int>"]))


def _own_list(left: np.ndarray, right: np.ndarray, pair: tuple[int, int]) -> np.ndarray:
    """Whether the list's two pivots are the least two that vectors share."""
    one, two = pair
    low = np.intersect1d(*(x[(x < two) & (x != one)] for x in (left, right)))
    if not len(low):
        return np.ones((len(left), len(right)), bool)
    has = [(x[:, :, None] == low).any(axis=1).astype(np.float32) for x in (left, right)]
    return has[0] @ has[1].T == 0


def linked_in_block(pair: tuple[int, int], left: dict, right: dict | None, cosine: float) -> list[tuple]:
    """Links of two blocks (or of one with itself) that belong to this list.

    A link is counted in the list of the least two pivots both vectors have, so in one
    list only. Returns (ids, links, roots) for each side: links weighs the other side
    by copies, and a root is a linked vector's least id reachable inside the blocks.
    """
    other = right or left
    match = left["unit"] @ other["unit"].T >= cosine
    if right is None:
        np.fill_diagonal(match, False)
    rows, columns = np.flatnonzero(match.any(axis=1)), np.flatnonzero(match.any(axis=0))
    if not len(rows):
        return []
    match = match[np.ix_(rows, columns)]
    match &= _own_list(left["prefix"][rows], other["prefix"][columns], pair)
    a, b = left["vec_id"][rows], other["vec_id"][columns]
    roots_a, roots_b, far = a, b, np.iinfo(np.int64).max
    while True:
        next_a = np.minimum(roots_a, np.where(match, roots_b[None, :], far).min(axis=1))
        next_b = np.minimum(roots_b, np.where(match, next_a[:, None], far).min(axis=0))
        if (next_a == roots_a).all() and (next_b == roots_b).all():
            break
        roots_a, roots_b = next_a, next_b
    out = [(a, match @ other["copies"][columns], roots_a)]
    if right is not None:
        out.append((b, match.T @ left["copies"][rows], roots_b))
    return out


def near_vectors(table: DataFrame, cosine: float = COSINE, seed: int = 0) -> DataFrame:
    """(vec_id, n_links, component_id) of every row.

    Only vectors of one label link. Null, empty and zero vectors, those with null or
    non-finite components, and rows without label or id link with nothing. Vectors of
    different lengths never link. Copies of a vector (equal in direction
    to the last bit) are one representative until the end, and count as links of each
    other. An id should name one vector; rows that repeat it get the same result.
    """
    base = table.select("vec_id", "label", "embedding")
    vectors = stored(usable(base), "vectors")
    # Copies: one representative per label and unit vector.
    keyed = vectors.withColumn("copy_key", direction(F.col("v")))
    groups = keyed.groupBy("label", "copy_key").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("copies")
    )
    owned = stored(keyed.drop("v").join(groups, ["label", "copy_key"]), "owned")
    chosen = owned.where("vec_id = rep").select("vec_id", "label", "copies").distinct()
    reps = vectors.join(chosen, ["vec_id", "label"]).dropDuplicates(["vec_id", "label"]).select(
        "vec_id", "label", "v", "copies"
    )
    described = stored(describe(reps, choose_pivots(vectors, seed)), "described")
    numbers = F.sort_array("prefix")
    combos = F.flatten(
        F.transform(
            numbers,
            lambda x, i: F.transform(
                F.slice(numbers, i + 2, F.greatest(F.size(numbers) - i - 1, F.lit(0))),
                lambda y: x.cast("long") * F.lit(1 << 20) + y,
            ),
        )
    )
    listed = described.withColumn("keys", F.array_distinct(combos))
    slim = listed.select("vec_id", "label", F.explode("keys").alias("key"))
    # Only lists with company carry vectors.
    shared = slim.groupBy("label", "key").count().where("count > 1").select("label", "key")
    wanted = slim.join(shared, ["label", "key"]).join(
        described.select("vec_id", "label", "v", "prefix", "copies"), ["vec_id", "label"]
    )
    one_list = F.struct("label", F.size("v").alias("width"), "key")
    rows = wanted.withColumn("list", one_list).drop("label")
    ship_code(table.sparkSession)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, out, size = ("vec_id", "links", "root"), [], 0
        for run in runs(batches):
            if len(run["side"]) < 2:
                continue
            run["unit"] = normalised(run["v"])
            key, first = int(run["key"][0]), run["side"] == 0
            left = {n: run[n][first] for n in ("vec_id", "copies", "unit", "prefix")}
            right = None if first.all() else {n: run[n][~first] for n in left}
            if not len(left["vec_id"]):
                continue
            found = linked_in_block((key >> 20, key & 0xFFFFF), left, right, cosine)
            out += found
            size += sum(len(ids) for ids, _, _ in found)
            if size > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names)

    dealt = dealt_in_runs(block_pairs(rows, "list", "vec_id"))
    numeric = dealt.select(*RUN, "side", "key", "vec_id", "copies", "v", "prefix")
    found = stored(
        numeric.mapInArrow(compare, "vec_id bigint, links bigint, root bigint"), "vector_links"
    )
    links = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    per_rep = (
        owned.select("rep").distinct()
        .join(links.withColumnRenamed("vec_id", "rep"), "rep", "left")
        .join(roots.withColumnRenamed("id", "rep"), "rep", "left")
    )
    per_vector = owned.join(per_rep, "rep").select(
        F.col("vec_id").alias("known"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
        F.coalesce("component", "rep").alias("root"),
    )
    per_vector = per_vector.groupBy("known").agg(F.max("links").alias("links"), F.min("root").alias("root"))
    return base.join(per_vector, F.col("vec_id") == F.col("known"), "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("root", "vec_id").alias("component_id"),
    )
