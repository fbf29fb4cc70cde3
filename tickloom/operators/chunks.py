"""Ordered per-symbol work that does not put one symbol into one task.

A window over ``partitionBy("symbol")`` runs a whole symbol in one task. Here a
symbol is cut into chunks of calendar days, and windows run over (symbol, chunk).
Rows that a frame needs from outside the chunk travel with it as *halo* rows, so
results are the same as over the whole symbol.

Both levels are bounded when (symbol, date) is unique, which every stored table
guarantees: a chunk has at most ``CHUNK_DAYS`` rows, and as a ``date`` column
spans years 1 to 9999 a symbol has at most 3,567 chunks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

CHUNK_DAYS = 1024
CHUNK = "_chunk"
HALO = "_halo"


def chunk_of(day: Column | str = "date", days: int = CHUNK_DAYS) -> Column:
    return F.floor(F.unix_date(day) / F.lit(days)).cast("int")


def within_chunk() -> WindowSpec:
    """Rows of one symbol and chunk in date order."""
    return Window.partitionBy("symbol", CHUNK).orderBy("date")


def across_chunks() -> WindowSpec:
    """Chunk-level rows of one symbol in order; not for plain rows."""
    return Window.partitionBy("symbol").orderBy(CHUNK)


def last_of(items: Column, size: int) -> Column:
    """Up to ``size`` last elements of an array."""
    start = F.greatest(F.size(items) - size + 1, F.lit(1))
    return F.slice(items, start, size)


def rows_before(tails: str, size: int) -> Column:
    """Chunk-level column: the last ``size`` rows before the chunk.

    ``tails`` holds the last ``size`` rows of each chunk. A chunk is never empty,
    so the tails of ``size`` chunks always hold enough rows.
    """
    earlier = across_chunks().rowsBetween(-size, -1)
    return last_of(F.flatten(F.collect_list(tails).over(earlier)), size)


def _neighbour_row(rows: DataFrame, values: Sequence[str], before: bool) -> DataFrame:
    """One halo row per chunk: the row just before (or just after) it."""
    pick = F.max_by if before else F.min_by
    edge_day = F.max if before else F.min
    # The last row of a chunk is wanted by the next chunk, the first by the one before.
    wanted_by = (F.lead if before else F.lag)(CHUNK).over(across_chunks())
    edges = rows.groupBy("symbol", CHUNK).agg(
        edge_day("date").alias("date"), *[pick(v, "date").alias(v) for v in values]
    )
    return edges.withColumn(CHUNK, wanted_by).where(F.col(CHUNK).isNotNull())


def _preceding_rows(rows: DataFrame, values: Sequence[str], size: int) -> DataFrame:
    """Halo rows: the last ``size`` rows before each chunk."""
    latest_first = Window.partitionBy("symbol", CHUNK).orderBy(F.col("date").desc())
    tails = (
        rows.select("symbol", CHUNK, "date", *values)
        .withColumn("_nth", F.row_number().over(latest_first))
        .where(F.col("_nth") <= size)
        .groupBy("symbol", CHUNK)
        .agg(F.sort_array(F.collect_list(F.struct("date", *values))).alias("_tail"))
    )
    before = tails.withColumn("_before", rows_before("_tail", size))
    return before.select("symbol", CHUNK, F.inline("_before"))


def with_halo(
    rows: DataFrame,
    values: Sequence[str],
    back: int = 0,
    ahead: bool = False,
    days: int = CHUNK_DAYS,
) -> DataFrame:
    """``rows`` with a chunk column, plus the neighbours each chunk's frames need.

    Adds the last ``back`` rows before each chunk and, with ``ahead``, the first
    row after it. Halo rows carry ``values`` only and are marked; drop them with
    ``drop_halo`` after the windows.
    """
    rows = rows.withColumn(CHUNK, chunk_of(days=days))
    result = rows.withColumn(HALO, F.lit(False))
    halos = []
    if back == 1:
        halos.append(_neighbour_row(rows, values, before=True))
    elif back > 1:
        halos.append(_preceding_rows(rows, values, back))
    if ahead:
        halos.append(_neighbour_row(rows, values, before=False))
    for halo in halos:
        result = result.unionByName(
            halo.withColumn(HALO, F.lit(True)), allowMissingColumns=True
        )
    return result


def drop_halo(rows: DataFrame) -> DataFrame:
    return rows.where(~F.col(HALO)).drop(HALO, CHUNK)


def attach_per_symbol(rows: DataFrame, per_symbol: DataFrame) -> DataFrame:
    """Left join of one row per symbol, spread so that no symbol is one task's work.

    The small side is repeated once for each chunk its symbol has, and the join
    runs on (symbol, chunk).
    """
    rows = rows.withColumn(CHUNK, chunk_of())
    spread = (
        rows.select("symbol", CHUNK).distinct().join(per_symbol, "symbol", "inner")
    )
    return rows.join(spread, ["symbol", CHUNK], "left").drop(CHUNK)
