"""Comparing all members of large buckets without emitting pairs of rows.

A bucket is cut into blocks of bounded size. Every pair of blocks is one group: its
rows travel to a task once per partner block, and the task compares them on arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

BLOCK_ROWS = 256


def block_pairs(rows: DataFrame, key: str, row_id: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows of every block pair of every bucket, with ``bucket``, ``pair``, ``side``.

    ``pair`` is the pair of block numbers, the smaller first; ``side`` is 0 or 1 for
    the block a row comes from (0 alone in a pair of one block with itself). Sizes of
    buckets are counted before, so a bucket of n rows is copied n / block_rows times.
    """
    sizes = rows.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n"))
    sizes = sizes.where("_n > 1").withColumn(
        "_blocks", F.ceil(F.col("_n") / F.lit(block_rows)).cast("int")
    )
    block = F.pmod(F.xxhash64(F.lit(11), F.col(row_id)), F.col("_blocks")).cast("int")
    placed = rows.join(sizes, F.col(key) == F.col("_key")).withColumn("_block", block)
    partners = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_other")
    return placed.select(
        *rows.columns,
        F.col("_key").alias("bucket"),
        "_block",
        partners,
    ).select(
        *rows.columns,
        "bucket",
        F.struct(
            F.least("_block", "_other").alias("low"), F.greatest("_block", "_other").alias("high")
        ).alias("pair"),
        F.when(F.col("_block") <= F.col("_other"), 0).otherwise(1).alias("side"),
    )


def grouped_pairs(rows: DataFrame, key: str, row_id: str) -> GroupedData:
    """Block pairs as groups, dealt by bucket and pair.

    The join in ``block_pairs`` leaves rows dealt by the key, which a plain grouping
    would take over: all block pairs of a hot key would be one task.
    """
    return block_pairs(rows, key, row_id).repartition("bucket", "pair").groupBy("bucket", "pair")


RUN = ("_run", "_run_too")


def dealt_in_runs(blocks: DataFrame) -> DataFrame:
    """Rows of a block pair one after the other in one partition, for ``runs``.

    A run is known by 128 bits of hash. Where most pairs are small, this spares the
    call that a grouped map makes for each of them.
    """
    one, two = F.xxhash64("bucket", "pair"), F.xxhash64(F.lit(1), "bucket", "pair")
    named = blocks.withColumns(dict(zip(RUN, (one, two))))
    return named.repartition(*RUN).sortWithinPartitions(*RUN)


def _part(arrays: dict, start: int, stop: int) -> dict[str, np.ndarray]:
    out = {}
    for name, (offsets, values) in arrays.items():
        if offsets is None:
            out[name] = values[start:stop]
        else:
            out[name] = values[offsets[start] : offsets[stop]].reshape(stop - start, -1)
    return out


def _arrays(batch: pa.RecordBatch) -> dict:
    out = {}
    for name, column in zip(batch.schema.names, batch.columns):
        if pa.types.is_list(column.type):
            values = column.values.to_numpy(zero_copy_only=False)
            out[name] = (column.offsets.to_numpy(), values)
        else:
            out[name] = (None, column.to_numpy(zero_copy_only=False))
    return out


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """The columns of each run, lists as matrices; columns are numbers or their lists.

    Runs may go on over batches; only one is held at a time.
    """
    held: list[dict] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        arrays = _arrays(batch)
        a, b = (arrays[name][1] for name in RUN)
        cuts = np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for start, stop in zip(edges, edges[1:]):
            if held and (a[start], b[start]) != last:
                yield _joined(held)
                held = []
            held.append(_part(arrays, start, stop))
            last = (a[start], b[start])
    if held:
        yield _joined(held)


def _joined(parts: list[dict]) -> dict[str, np.ndarray]:
    if len(parts) == 1:
        return parts[0]
    return {name: np.concatenate([p[name] for p in parts]) for name in parts[0]}
