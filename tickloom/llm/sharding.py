"""Uniform sharding with exact shard sizes.

Rows lie in partitions by a hash of all their columns. How many rows each partition sends to
each shard is drawn from the multivariate hypergeometric law that a uniform shuffle
of all rows would follow. Each partition permutes its rows and deals them out by its
row of that matrix; after the exchange each shard is permuted again. Shard sizes are
exact and differ by one row at most.
"""

from __future__ import annotations

import json
import math
import random

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import free_name, stored, whole_row_hash

#: Rows that one partition, or one piece of a shard, should hold.
PARTITION_ROWS = 131_072
PIECE_ROWS = 16_384
LEAST_PARTITIONS = 64
#: The matrix is drawn on the driver; its entries never exceed this, whatever the
#: number of rows. Beyond it partitions grow instead.
MATRIX_ENTRIES = 1_000_000


def hypergeometric(rng: random.Random, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` out of ``good + bad`` are good: inversion from the mode."""
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    total = good + bad
    mode = min(max((draws + 1) * (good + 1) // (total + 2), low), high)

    def log_choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    at_mode = math.exp(
        log_choose(good, mode) + log_choose(bad, draws - mode) - log_choose(total, draws)
    )
    left = right = mode
    p_left = p_right = at_mode
    rest = rng.random() - at_mode
    while rest > 0:
        if right < high:
            p_right *= (good - right) * (draws - right)
            right += 1
            p_right /= right * (bad - draws + right)
            rest -= p_right
            if rest <= 0:
                return right
        if left > low:
            p_left *= left * (bad - draws + left)
            left -= 1
            p_left /= (good - left) * (draws - left)
            rest -= p_left
            if rest <= 0:
                return left
        if (right >= high or p_right < 1e-300) and (left <= low or p_left < 1e-300):
            return mode
    return mode


def communication_matrix(
    rows: dict[int, int], n_shards: int, seed: int
) -> list[tuple[int, list[int]]]:
    """For each partition, how many of its rows go to each shard.

    Row sums are the partitions' sizes; column sums are the shards' sizes, equal but
    for one row.
    """
    total = sum(rows.values())
    room = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    rng = random.Random(seed)
    matrix = []
    for part in sorted(rows):
        left, open_room, row = rows[part], sum(room), []
        for s in range(n_shards):
            open_room -= room[s]
            row.append(hypergeometric(rng, room[s], open_room, left))
            left -= row[-1]
        room = [a - b for a, b in zip(room, row)]
        matrix.append((part, row))
    return matrix


def shard_rows(
    rows: DataFrame, n_shards: int, row_id: str = "doc_id", seed: int = 0
) -> DataFrame:
    """Adds ``shard`` and ``slot``; slots of a shard run from 0 without a gap.

    Any columns are allowed; columns named ``shard`` or ``slot`` are replaced. Rows are
    dealt by a hash of all columns, so that an id that many rows repeat, or none, spreads
    like any other. Rows equal in every column are interchangeable, so the result is the
    same on every run. An empty table stays empty.
    """
    if n_shards < 1:
        raise ValueError("at least one shard")
    rows = rows.drop("shard", "slot")
    helpers = [free_name(rows, f"_{x}") for x in ("part", "order", "piece", "rank", "ends", "first")]
    part, order, piece, rank, ends_of, first = helpers
    spark = rows.sparkSession
    total = rows.count()
    wanted = max(LEAST_PARTITIONS, math.ceil(total / PARTITION_ROWS))
    parts = max(1, min(wanted, max(LEAST_PARTITIONS, MATRIX_ENTRIES // n_shards)))
    pieces = max(1, math.ceil(total / (n_shards * PIECE_ROWS)))
    key = F.col(order)
    dealt = rows.withColumn(order, whole_row_hash(rows))
    dealt = dealt.withColumn(part, F.pmod(F.xxhash64(F.lit(seed), key), F.lit(parts)).cast("int"))
    # At most ``parts`` rows reach the driver.
    sizes = {r[0]: r[1] for r in dealt.groupBy(part).count().collect()}
    matrix = communication_matrix(sizes, n_shards, seed)
    ends = []
    for p, row in matrix:
        run, sums = 0, []
        for n in row:
            run += n
            sums.append(run)
        ends.append([p, *sums])
    text = F.from_json(F.lit(json.dumps(ends)), "array<array<bigint>>")
    table = spark.range(1).select(F.explode(text).alias("_row")).select(
        F.get("_row", F.lit(0)).cast("int").alias(part),
        F.slice("_row", 2, n_shards).alias(ends_of),
    )
    # The id tells rows apart whose hashes are equal by chance.
    local = Window.partitionBy(part).orderBy(F.xxhash64(F.lit(seed + 1), key), key, row_id)
    dealt = (
        dealt.withColumn(rank, F.row_number().over(local))
        .join(table, part)
        .withColumn("shard", F.size(F.filter(ends_of, lambda e: e < F.col(rank))))
        .withColumn(piece, F.pmod(F.xxhash64(F.lit(seed + 2), key), F.lit(pieces)).cast("int"))
        .drop(ends_of, rank, part)
    )
    # Slots need the size of every piece before its own; the stored rows give both.
    dealt = stored(dealt, "sharded")
    before = Window.partitionBy("shard").orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("shard", piece)
        .count()
        .withColumn(first, F.coalesce(F.sum("count").over(before), F.lit(0)))
        .drop("count")
    )
    again = Window.partitionBy("shard", piece).orderBy(F.xxhash64(F.lit(seed + 3), key), key, row_id)
    return (
        dealt.withColumn("slot", F.row_number().over(again) - 1)
        .join(offsets, ["shard", piece])
        .withColumn("slot", F.col("slot") + F.col(first))
        .select(*(c for c, _ in _named(rows)), "shard", "slot")
    )


def _named(rows: DataFrame) -> list[tuple[str, str]]:
    return [(f"`{c.replace('`', '``')}`", t) for c, t in rows.dtypes]
