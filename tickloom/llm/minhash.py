"""Near-duplicate documents by b-bit MinHash.

A document's set is its distinct shingles of five lower-cased words. Documents with
equal sets are one class. Signatures of 128 minima give band keys; documents that
share one are candidates. Of each minimum only four bits are kept, packed into eight
numbers, and counting equal nibbles, corrected for chance, estimates the similarity;
pairs far below the threshold go. All others are confirmed on their full sets.

Candidates are not paired within a bucket. First every member meets the bucket's
smallest member, and confirmed links are joined into components. Buckets that still
hold several components are then compared in full, small ones by a join, large ones
block by block; members of one component need no comparison.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tickloom.llm.blocks import grouped_pairs
from tickloom.llm.common import ship_code, stored
from tickloom.llm.components import components

WORDS = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 75
BANDS, ROWS, BITS = 32, 4, 4
HASHES = BANDS * ROWS
LANES = HASHES * BITS // 64
#: Estimates have a deviation of 0.04 at the threshold; five of them are let through.
MARGIN = 0.20
#: Buckets up to this size are paired by a join.
SMALL_BUCKET = 8
CHUNK_BYTES = 2_000_000

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    big = 1 << 64
    return (
        rng.integers(0, big, 256, np.uint64),
        rng.integers(0, big, WORDS, np.uint64) | np.uint64(1),
        rng.integers(0, 1 << 32, HASHES, np.uint32) | np.uint32(1),
        rng.integers(0, 1 << 32, HASHES, np.uint32),
    )


BYTE_VALUES, PLACES, FACTORS, SHIFTS = _tables()
_STEP = 0x9E3779B97F4A7C15
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _step_powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(21, count.bit_length())
    if size not in _powers:
        _powers.clear()
        both = []
        for base in (_STEP, pow(_STEP, -1, 1 << 64)):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            both.append(np.cumprod(factors))
        _powers[size] = (both[0], both[1])
    return _powers[size]


def shingle_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, joined; counts; words per text.

    A text with one to four words has its whole sequence as its only shingle; a text
    without words has none.
    """
    joined = _LOWER[np.frombuffer(b" ".join(texts), np.uint8)]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    text_starts = np.cumsum(sizes + 1) - (sizes + 1)
    inside = ~_WHITE[joined]
    edges = np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    up, down = _step_powers(len(joined) + 1)
    sums = np.zeros(len(joined) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[joined] * up[: len(joined)], out=sums[1:])
    words = _mixed((sums[ends] - sums[starts]) * down[starts])
    first = np.searchsorted(starts, text_starts)
    n_words = np.diff(np.append(first, len(starts)))
    # Every position gets a shingle; those that reach into the next text go.
    padded = np.concatenate((words, np.zeros(WORDS, np.uint64)))
    shingles = np.zeros(len(words), np.uint64)
    for k in range(WORDS):
        shingles += padded[k : k + len(words)] * PLACES[k]
    shingles = _mixed(shingles)
    sets, counts = [], np.zeros(len(texts), np.int64)
    for i, (a, n) in enumerate(zip(first.tolist(), n_words.tolist())):
        if n >= WORDS:
            own = np.unique(shingles[a : a + n - WORDS + 1])
        elif n:
            whole = (words[a : a + n] * PLACES[:n]).sum(dtype=np.uint64, keepdims=True)
            own = _mixed(whole ^ np.uint64(n))
        else:
            continue
        sets.append(own)
        counts[i] = len(own)
    flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    return flat, counts, n_words


def minima(flat: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """128 minima (rows) of each set that is not empty (columns)."""
    starts = np.cumsum(counts) - counts
    starts = starts[counts > 0]
    short = (flat >> np.uint64(32)).astype(np.uint32)
    out = np.empty((HASHES, len(starts)), np.uint32)
    for k in range(HASHES):
        np.minimum.reduceat(short * FACTORS[k] + SHIFTS[k], starts, out=out[k])
    return out


def packed_bits(low: np.ndarray) -> np.ndarray:
    """Four bits of each minimum, sixteen to a number: (sets, 8) of int64."""
    bits = _mixed(low.astype(np.uint64) + (np.arange(HASHES, dtype=np.uint64) << np.uint64(32))[:, None])
    bits = (bits >> np.uint64(60)).reshape(LANES, 16, -1)
    shift = (np.arange(16, dtype=np.uint64) * np.uint64(BITS))[None, :, None]
    return (bits << shift).sum(axis=1, dtype=np.uint64).T.astype(np.int64)


def band_keys(low: np.ndarray) -> np.ndarray:
    """A key per band: (sets, 32) of int64."""
    keys = np.zeros((BANDS, low.shape[1]), np.uint64)
    for r in range(ROWS):
        keys = _mixed(keys ^ low[r::ROWS].astype(np.uint64)) + np.uint64(r + 1)
    keys += np.arange(BANDS, dtype=np.uint64)[:, None] * np.uint64(_STEP)
    return keys.T.astype(np.int64)


def _groups(texts: list[bytes]) -> Iterator[list[bytes]]:
    group, size = [], 0
    for t in texts:
        if group and size + len(t) > CHUNK_BYTES:
            yield group
            group, size = [], 0
        group.append(t)
        size += len(t)
    if group:
        yield group


def _lists(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _raw(batch: pa.RecordBatch) -> list[bytes]:
    return [x or b"" for x in batch.column(1).cast(pa.binary()).to_pylist()]


def signatures(docs: DataFrame) -> DataFrame:
    """(id, n_shingles, set_key, bits, bands) of rows (id, text)."""
    ship_code(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in _groups(_raw(batch)):
                ids = batch.column(0).slice(at, len(texts))
                at += len(texts)
                flat, counts, _ = shingle_sets(texts)
                ends = np.cumsum(counts).tolist()
                keys = [
                    hashlib.md5(flat[e - n : e].tobytes()).digest() if n else None
                    for e, n in zip(ends, counts.tolist())
                ]
                has = (counts > 0).astype(np.int64)
                low = minima(flat, counts) if len(flat) else np.empty((HASHES, 0), np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(counts),
                        pa.array(keys, pa.binary()),
                        _lists(packed_bits(low).ravel(), has * LANES),
                        _lists(band_keys(low).ravel(), has * BANDS),
                    ],
                    ["id", "n_shingles", "set_key", "bits", "bands"],
                )

    schema = "id bigint, n_shingles bigint, set_key binary, bits array<bigint>, bands array<bigint>"
    return docs.mapInArrow(run, schema)


def full_sets(docs: DataFrame) -> DataFrame:
    """(id, shingles) of rows (id, text)."""
    ship_code(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in _groups(_raw(batch)):
                ids = batch.column(0).slice(at, len(texts))
                at += len(texts)
                flat, counts, _ = shingle_sets(texts)
                yield pa.RecordBatch.from_arrays(
                    [ids, _lists(flat.astype(np.int64), counts)], ["id", "shingles"]
                )

    return docs.mapInArrow(run, "id bigint, shingles array<bigint>")


def estimate(a: Column, b: Column) -> Column:
    """Similarity from two packed signatures, corrected for nibbles equal by chance."""

    def unequal(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        d = d.bitwiseOR(F.shiftrightunsigned(d, 2))
        d = d.bitwiseOR(F.shiftrightunsigned(d, 1))
        return F.bit_count(d.bitwiseAND(F.lit(0x1111111111111111)))

    lanes = [unequal(F.get(a, F.lit(i)), F.get(b, F.lit(i))) for i in range(LANES)]
    equal = 1 - sum(lanes[1:], lanes[0]) / F.lit(float(HASHES))
    chance = 1 / (1 << BITS)
    return (equal - chance) / (1 - chance)


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) whose full sets are similar enough."""
    a = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    shared = F.size(F.array_intersect("sa", "sb")).cast("long")
    return (
        pairs.join(a, "a")
        .join(b, "b")
        .withColumn("shared", shared)
        .where(
            100 * F.col("shared")
            >= PERCENT * (F.size("sa").cast("long") + F.size("sb") - F.col("shared"))
        )
        .select("a", "b")
    )


def _estimated(pairs: DataFrame, bits: DataFrame) -> DataFrame:
    a = bits.select(F.col("id").alias("a"), F.col("bits").alias("ba"))
    b = bits.select(F.col("id").alias("b"), F.col("bits").alias("bb"))
    close = estimate(F.col("ba"), F.col("bb")) >= PERCENT / 100 - MARGIN
    return pairs.join(a, "a").join(b, "b").where(close).select("a", "b")


_NIBBLES = np.uint64(0x1111111111111111)
_PAIR = StructType([StructField("a", LongType()), StructField("b", LongType())])


def links_in_block(key: int, left: dict, right: dict | None) -> list[tuple[int, int]]:
    """Links that join components, between two blocks of a bucket or inside one.

    Blocks have id, component, bits, bands and sets. A pair is looked at in the first
    band it shares, so in one bucket only; estimates come before full sets; and a pair
    whose components are joined already is not needed.
    """
    other = right or left
    equal = np.zeros((len(left["id"]), len(other["id"])), np.int64)
    for lane in range(LANES):
        d = left["bits"][:, lane, None] ^ other["bits"][None, :, lane]
        d |= d >> np.uint64(2)
        d |= d >> np.uint64(1)
        equal += 16 - np.bitwise_count(d & _NIBBLES).astype(np.int64)
    chance = 1 / (1 << BITS)
    close = (equal / HASHES - chance) / (1 - chance)
    similar = close >= PERCENT / 100 - MARGIN
    similar &= left["component"][:, None] != other["component"][None, :]
    if right is None:
        similar &= left["id"][:, None] < other["id"][None, :]
    i, j = np.nonzero(similar)
    shared = left["bands"][i] == other["bands"][j]
    own = left["bands"][i, shared.argmax(axis=1)] == key
    i, j = i[own], j[own]
    order = np.argsort(-close[i, j], kind="stable")
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            x = up
        return x

    links = []
    for x, y in zip(i[order].tolist(), j[order].tolist()):
        a, b = root(int(left["component"][x])), root(int(other["component"][y]))
        if a != b:
            one, two = left["sets"][x], other["sets"][y]
            both = len(np.intersect1d(one, two, assume_unique=True))
            if 100 * both >= PERCENT * (len(one) + len(two) - both):
                parent[max(a, b)] = min(a, b)
                links.append((int(left["id"][x]), int(other["id"][y])))
    return links


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64).reshape(-1, width)


def _block_links(rows: DataFrame) -> DataFrame:
    """Links (a, b) of rows (key, id, component, bits, bands, shingles) of buckets."""
    ship_code(rows.sparkSession)

    def compare(table: pa.Table) -> pa.Table:
        sides = []
        for side in (0, 1):
            own = table.filter(pc.equal(table["side"], side))
            lists = own["shingles"].combine_chunks()
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            sides.append(
                {
                    "id": own["id"].to_numpy(),
                    "component": own["component"].to_numpy(),
                    "bits": _matrix(own["bits"], LANES).view(np.uint64),
                    "bands": _matrix(own["bands"], BANDS),
                    "sets": np.split(flat, ends[:-1].astype(np.int64)),
                }
            )
        right = sides[1] if len(sides[1]["id"]) else None
        links = links_in_block(table["bucket"][0].as_py(), sides[0], right)
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()),
                         "b": pa.array([y for _, y in links], pa.int64())})

    return grouped_pairs(rows, "key", "id").applyInArrow(compare, _PAIR)


def near_duplicates(docs: DataFrame, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of every row.

    ``component_id`` is the smallest id reachable over links, the own one included.
    Null text has no shingles and no links. Rows with a null id get one row each with
    a null component. An id that is repeated has a row per repeat and one component
    over all its texts. An empty table gives none.
    """
    rows = docs.select(F.col(row_id).cast("long").alias("id"), F.col(text).alias("text"))
    signed = stored(signatures(rows), "signatures")
    usable = signed.where("id IS NOT NULL AND n_shingles > 0")
    # One row per class, the smallest id with the set.
    signature = F.struct("bits", "bands")
    reps = stored(
        usable.groupBy("set_key")
        .agg(F.min("id").alias("id"), F.min_by(signature, "id").alias("s"))
        .select("set_key", "id", "s.bits", "s.bands"),
        "representatives",
    )
    classes = reps.select("set_key", F.col("id").alias("rep"))
    reps = reps.drop("set_key")
    banded = reps.select("id", F.explode("bands").alias("key"))
    buckets = banded.groupBy("key").agg(F.min("id").alias("centre"), F.count("*").alias("n"))
    # Members of buckets with company.
    members = stored(
        banded.join(buckets.where("n > 1"), "key").select("key", "id", "centre", "n"), "members"
    )
    bits = reps.select("id", "bits")
    stars = members.where("id <> centre").select(F.col("centre").alias("a"), F.col("id").alias("b"))
    stars = stored(_estimated(stars.distinct(), bits), "stars")
    # Full sets of every document in company, made from the texts once.
    wanted = members.select("id").distinct()
    keyed = classes.select(F.col("rep").alias("id")).join(wanted, "id", "left_semi")
    # The ids grow with the corpus, so they are never broadcast.
    texts = rows.join(keyed.hint("merge"), "id", "left_semi")
    sets = stored(
        full_sets(texts.select("id", "text")).where(F.size("shingles") > 0), "sets"
    )
    links = stored(_confirmed(stars, sets), "star_links")
    within = stored(components(links), "within")
    named = members.join(within, "id", "left").select(
        "key", "id", "n", F.coalesce("component", "id").alias("component")
    )
    split = named.groupBy("key").agg(
        F.min("component").alias("least"), F.max("component").alias("most")
    )
    open_ = stored(
        named.join(split.where("least < most").select("key"), "key"), "open_buckets"
    )
    small = open_.where(F.col("n") <= SMALL_BUCKET)
    left = small.select("key", F.col("id").alias("a"), F.col("component").alias("ca"))
    right = small.select("key", F.col("id").alias("b"), F.col("component").alias("cb"))
    joined = left.join(right, "key").where("a < b AND ca <> cb").select("a", "b").distinct()
    rest = _estimated(joined.join(stars, ["a", "b"], "left_anti"), bits)
    large = open_.where(F.col("n") > SMALL_BUCKET).select("key", "id", "component")
    large = large.join(reps, "id").join(sets, "id")
    more = stored(_confirmed(rest, sets).unionByName(_block_links(large)), "more_links")
    # Equal sets, and equal ids with several texts, belong together as well.
    same = usable.join(classes, "set_key").where("id <> rep").select(
        F.col("id").alias("a"), F.col("rep").alias("b")
    )
    if not more.isEmpty():
        # The stars found before stand for their links: fewer rounds to go.
        stars = within.select(F.col("id").alias("a"), F.col("component").alias("b"))
        within = stored(components(stars.unionByName(more)), "within")
    # Classes hang on their representatives, which hang on their components' least.
    roots = classes.select(F.col("rep").alias("id")).distinct().join(within, "id", "left")
    roots = roots.select(F.col("id").alias("rep"), F.coalesce("component", "id").alias("root"))
    hung = same.select(F.col("a").alias("id"), F.col("b").alias("rep")).join(roots, "rep")
    tops = hung.select("id", "root").unionByName(roots.select(F.col("rep").alias("id"), "root"))
    tops = tops.groupBy("id").agg(F.min("root").alias("root"), F.max("root").alias("other"))
    tops = stored(tops, "tops")
    merged = tops.where("root <> other").select(F.col("root").alias("a"), F.col("other").alias("b"))
    if not merged.isEmpty():
        # Only where one id holds several texts: their components are one.
        every = hung.select(F.col("id").alias("a"), F.col("root").alias("b")).unionByName(
            roots.select(F.col("rep").alias("a"), F.col("root").alias("b"))
        )
        tops = stored(components(every), "merged").select("id", F.col("component").alias("root"))
    tops = tops.select(F.col("id").alias("known"), "root")
    return signed.join(tops, F.col("id") == F.col("known"), "left").select(
        "id", "n_shingles", F.coalesce("root", "id").alias("component_id")
    )
