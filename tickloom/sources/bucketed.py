"""Stored tables that joins and key checks meet where they lie.

Rows are dealt into a fixed number of buckets by the hash of their key and stored that
way. Two such tables with one number of buckets join on the key without a shuffle, and
a batch that is checked against the stored keys is the only side that moves. The key is
(symbol, date), so a symbol with a third of all rows is spread over all buckets.

The number of buckets is part of the folder's name, so a table is opened again from its
path alone, in any session: the catalog entry that the planner needs is made anew.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from tickloom.operators.ingest import ARRIVAL, first_per_key
from tickloom.schemas import Table
from tickloom.sources.sinks import ALL_OR_NOTHING
from tickloom.sources.tables import conform, path_exists, shuffles_dropped

#: Buckets of a table unless it is created with another number: a few for every core of
#: the cluster that will join it.
BUCKETS = 32


def _folder(path: str, buckets: int) -> str:
    return f"{path.rstrip('/')}.by{buckets}"


def _entry(spark: SparkSession, table: Table, folder: str, buckets: int) -> str:
    """The catalog's name of the folder; registered once a session."""
    name = f"{table.name}_{hashlib.md5(folder.encode()).hexdigest()[:12]}"
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema.fields)
        key = ", ".join(f"`{k}`" for k in table.key)
        place = folder.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet "
            f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{place}'"
        )
    return name


def open_bucketed(spark: SparkSession, path: str, table: Table, buckets: int = BUCKETS) -> DataFrame:
    """The rows of a bucketed table; a missing one is an error."""
    folder = _folder(path, buckets)
    if not path_exists(spark, folder):
        raise FileNotFoundError(folder)
    name = _entry(spark, table, folder, buckets)
    # Files that another session added are listed again.
    spark.catalog.refreshTable(name)
    return spark.table(name)


def insert_bucketed(
    spark: SparkSession,
    batch: DataFrame,
    table: Table,
    path: str,
    buckets: int = BUCKETS,
    arrival: str = ARRIVAL,
    unique: bool = False,
) -> None:
    """Appends the rows whose key the table lacks, as ``insert_if_absent`` does.

    Stored keys stay where they are; the batch alone is dealt into buckets, once, which
    serves the key check and the write. Creates the table when it is missing.
    """
    folder = _folder(path, buckets)
    fresh = conform(batch, table)
    fresh = fresh if unique else first_per_key(fresh, table.key, arrival)
    fresh = fresh.select(*table.schema.names).repartition(buckets, *table.key)
    if path_exists(spark, folder):
        stored = open_bucketed(spark, path, table, buckets).select(*table.key)
        # A merge join reads both sides as they lie; the batch is never sent around whole.
        fresh = fresh.join(stored.hint("merge"), list(table.key), "left_anti")
    name = _entry(spark, table, folder, buckets)
    writer = fresh.select(*table.schema.names).write.mode("append").options(**ALL_OR_NOTHING)
    with shuffles_dropped(spark):
        writer.format("parquet").bucketBy(buckets, *table.key).sortBy(*table.key).saveAsTable(name)
