"""Keyed writes: the first writer of a key wins, or the last one on request.

A table is a Parquet folder; dated tables are split by year. Parquet has no key
index, so a table takes one writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.ingest import ARRIVAL, absent_rows, first_per_key
from tickloom.schemas import Table
from tickloom.session import scratch_path
from tickloom.sources.tables import YEAR, conform, path_exists, read_range, read_table, shuffles_dropped
from tickloom.sources.versions import current_path, replace_table

# Task output becomes visible only when the whole job commits; figures take less room.
ALL_OR_NOTHING = {"mapreduce.fileoutputcommitter.algorithm.version": "1", "compression": "zstd"}
#: Symbols of a year are written in so many slices, if there are rows enough.
SLICES = 64
SLICE = "_slice"


def write_rows(rows: DataFrame, table: Table, path: str, mode: str) -> None:
    if not table.dated:
        rows.hint("rebalance").write.mode(mode).options(**ALL_OR_NOTHING).parquet(path)
        return
    # Rebalancing gathers the rows of a year and a slice of its symbols into files of even
    # size; what is too large for one task is split, what is too small is merged. So a
    # symbol lies in the files of its slice alone, sorted, and a scan for it passes over
    # the row groups whose dictionary lacks it.
    dealt = rows.withColumns({YEAR: F.year("date"), SLICE: F.pmod(F.xxhash64("symbol"), F.lit(SLICES))})
    even = dealt.hint("rebalance", YEAR, SLICE).sortWithinPartitions(YEAR, "symbol", "date").drop(SLICE)
    with shuffles_dropped(rows.sparkSession):
        even.write.mode(mode).options(**ALL_OR_NOTHING).partitionBy(YEAR).parquet(path)


def insert_if_absent(
    spark: SparkSession,
    batch: DataFrame,
    table: Table,
    path: str,
    dates: tuple | None = None,
    arrival: str = ARRIVAL,
    unique: bool = False,
) -> None:
    """Append the rows whose key the table lacks, as one job.

    Creates the table when it is missing. Inside a batch the first arrival of a key
    wins. ``dates`` is the inclusive range the batch is known to lie in; only those
    years of a dated table are then read for the key check. ``unique`` says that no
    key repeats in the batch, which saves the shuffle that would make sure.
    """
    batch = conform(batch, table)
    existing = None
    if path_exists(spark, path):
        if dates is not None and table.dated:
            existing = read_range(spark, path, table, *dates)
        else:
            existing = read_table(spark, path, table)
    fresh = absent_rows(batch, existing, table.key, arrival, unique)
    write_rows(fresh, table, current_path(spark, path), "append")


def upsert(
    spark: SparkSession,
    batch: DataFrame,
    table: Table,
    path: str,
    arrival: str = ARRIVAL,
) -> None:
    """Rows of the batch replace stored rows of the same key.

    For small tables such as ``model_eval``. The merged table becomes visible at once
    and as a whole; if writing it fails, the stored rows stay as they are.
    """
    fresh = first_per_key(conform(batch, table), table.key, arrival)
    if path_exists(spark, path):
        # The batch is computed once, though the merge reads it twice.
        given = scratch_path(spark, f"{table.name}-batch")
        fresh.write.parquet(given)
        fresh = spark.read.schema(table.schema).parquet(given)
        stored = read_table(spark, path, table)
        kept = stored.join(fresh.select(*table.key), list(table.key), "left_anti")
        fresh = fresh.unionByName(kept.select(*fresh.columns))
    if table.dated:
        raise ValueError(f"{table.name} is split by year; upsert is for undated tables")
    replace_table(fresh.hint("rebalance"), path, **ALL_OR_NOTHING)
