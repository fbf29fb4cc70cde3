"""Daily quote pages picked up as they land."""

from __future__ import annotations

import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.scalars import local_time
from tickloom.operators.ingest import ARRIVAL, extract_quotes
from tickloom.schemas import QUOTE_PAGES, TABLES
from tickloom.session import scratch_path
from tickloom.sources.sinks import ALL_OR_NOTHING, insert_if_absent

PRICES = TABLES["stock_prices"]


def page_stream(spark: SparkSession, landing: str, files_per_batch: int | None = None) -> DataFrame:
    """New files of the landing folder, oldest first."""
    reader = spark.readStream.schema(QUOTE_PAGES)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(landing)


def in_time(pages: DataFrame, newest: datetime.datetime | None, late: str) -> DataFrame:
    """Pages that come no more than ``late`` after the newest fetch seen; read before any search."""
    if newest is None:
        return pages
    # To the millisecond, as watermarks are kept.
    newest = newest.replace(microsecond=newest.microsecond // 1000 * 1000)
    return pages.where(F.col("fetched_at") > F.lit(newest) - F.expr(f"INTERVAL '{late}'"))


def unseen_quotes(quotes: DataFrame, seen: DataFrame, newest: datetime.datetime | None) -> DataFrame:
    """Quotes less those that equal a seen one in every column.

    One fetched after the newest seen is new for certain, so that only the others meet
    the seen ones.
    """
    if newest is None:
        return quotes
    is_new = F.col("fetched_at") > F.lit(newest)
    same = [F.col(f"given.{c}").eqNullSafe(F.col(f"seen.{c}")) for c in quotes.columns]
    others = quotes.where(~is_new).alias("given")
    others = others.join(seen.alias("seen"), reduce(Column.__and__, same), "left_anti")
    return quotes.where(is_new).unionByName(others)


class SeenQuotes:
    """Quotes a stream remembers, written anew by every batch: those within ``late`` of the newest.

    A batch reads what the one before it left, so a batch that is repeated after a failure
    finds the same; what came earlier goes.
    """

    def __init__(self, spark: SparkSession, checkpoint: str, late: str):
        self.spark, self.folder, self.late = spark, f"{checkpoint.rstrip('/')}.seen", late

    def path(self, number: int) -> str:
        return f"{self.folder}/{number}"

    def before(self, number: int, like: DataFrame) -> tuple[DataFrame, datetime.datetime | None]:
        """What batch ``number`` finds remembered, and the newest fetch of it."""
        if number == 0:
            return like.limit(0), None
        seen = self.spark.read.schema(like.schema).parquet(self.path(number - 1))
        return seen, seen.agg(F.max("fetched_at")).first()[0]

    def remember(self, number: int, seen: DataFrame, new: DataFrame) -> None:
        rows = seen.unionByName(new)
        newest = rows.agg(F.max("fetched_at")).first()[0]
        kept = in_time(rows, newest, self.late).distinct()
        kept.write.mode("overwrite").options(**ALL_OR_NOTHING).parquet(self.path(number))
        older = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(number - 2))
        older.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(older, True)


def ingest_new_pages(
    spark: SparkSession,
    landing: str,
    table_path: str,
    checkpoint: str,
    files_per_batch: int | None = None,
    late: str | None = None,
) -> None:
    """Insert the quotes of files that arrived since the last call, then stop.

    Each micro-batch is a keyed insert like that of the daily ingest, so both may write
    one table: the first writer of a key wins, and a batch that is repeated after a
    failure adds nothing twice. Inside a batch the page fetched first wins. Keys are
    checked in the years of the batch alone, and without ``late`` no key is kept as state.

    ``late``, such as "7 days", is for landing folders that deliver pages again: those seen
    within that time, kept by ``SeenQuotes`` beside the checkpoint, cost no key check. A page
    that comes later than that is not searched at all and left to the daily ingest, which
    reads all pages. A checkpoint is for one choice.
    """
    remembered = None if late is None else SeenQuotes(spark, checkpoint, late)

    def insert(quotes: DataFrame) -> None:
        # A later fetch is never of an earlier day, so the days of two fetches bound all.
        ends = [F.to_date(local_time(end("fetched_at"))) for end in (F.min, F.max)]
        first, last = quotes.agg(*ends).first()
        if first is None:
            return
        rows = quotes.withColumnRenamed("fetched_at", ARRIVAL)
        insert_if_absent(quotes.sparkSession, rows, PRICES, table_path, dates=(first, last))

    def insert_pages(batch: DataFrame, number: int) -> None:
        insert(extract_quotes(batch))

    def insert_unseen(batch: DataFrame, number: int) -> None:
        seen, newest = remembered.before(number, extract_quotes(batch))
        quotes = extract_quotes(in_time(batch, newest, late))
        # A batch that is checked against seen quotes is computed once, though it is read often.
        given = scratch_path(batch.sparkSession, "unseen-quotes")
        unseen_quotes(quotes, seen, newest).write.parquet(given)
        unseen = batch.sparkSession.read.schema(quotes.schema).parquet(given)
        insert(unseen)
        remembered.remember(number, seen, unseen)

    query = (
        page_stream(spark, landing, files_per_batch)
        .writeStream.foreachBatch(insert_pages if late is None else insert_unseen)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
