"""Stored tables: existence, reading, declared columns."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.schemas import Table
from tickloom.session import scratch_path
from tickloom.sources.versions import current_path

YEAR = "_year"
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table has been written, at its own path or as a version."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(current_path(spark, path))
    filesystem = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return filesystem.exists(hadoop_path)


def read_table(spark: SparkSession, path: str, table: Table | None = None) -> DataFrame:
    """Every row of a Parquet table; a missing table is an error.

    With ``table`` the declared columns are read. Filters on ``date`` reach the
    scan, where row groups and files outside the range are skipped. Of a table that was
    replaced the current version is read.
    """
    path = current_path(spark, path)
    if table is None:
        return spark.read.parquet(path)
    return spark.read.schema(table.schema).parquet(path).select(*table.schema.names)


def read_range(spark: SparkSession, path: str, table: Table, first, last) -> DataFrame:
    """Rows of a dated table between two dates, reading only the years they touch."""
    first, last = F.lit(first).cast("date"), F.lit(last).cast("date")
    schema = table.schema.simpleString()[len("struct<") : -1].replace(":", " ")
    rows = spark.read.schema(f"{schema}, {YEAR} int").parquet(current_path(spark, path))
    return rows.where(
        F.col(YEAR).between(F.year(first), F.year(last))
        & F.col("date").between(first, last)
    ).select(*table.schema.names)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """A write inside removes its shuffle files when it has ended.

    They would stay until the driver's memory is cleared of the plan that made them,
    beside those of every later write.
    """
    before = spark.conf.get(FILE_CLEANUP, None)
    spark.conf.set(FILE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FILE_CLEANUP)
        else:
            spark.conf.set(FILE_CLEANUP, before)


def staged(rows: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read again: for what is read repeatedly."""
    spark = rows.sparkSession
    path = scratch_path(spark, label)
    with shuffles_dropped(spark):
        rows.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def unstaged(rows: DataFrame) -> None:
    """Removes a staged table that nothing reads any more."""
    spark = rows.sparkSession
    for folder in {file.rpartition("/")[0] for file in rows.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def read_jdbc(
    spark: SparkSession,
    url: str,
    name: str,
    properties: Mapping[str, str],
    first_day: str,
    last_day: str,
    partitions: int,
) -> DataFrame:
    """A database table read in parallel, cut by ``date``."""
    return (
        spark.read.format("jdbc")
        .options(**properties)
        .option("url", url)
        .option("dbtable", name)
        .option("partitionColumn", "date")
        .option("lowerBound", first_day)
        .option("upperBound", last_day)
        .option("numPartitions", partitions)
        .load()
    )


def conform(rows: DataFrame, table: Table) -> DataFrame:
    """The declared columns in order and type; a null key or NaN is not stored.

    A null key fails the whole batch. NaN, which stands for a missing figure in
    other tools, becomes null.
    """
    columns = []
    for field in table.schema.fields:
        value = F.col(field.name).cast(field.dataType)
        if field.dataType.typeName() == "double":
            value = F.when(~F.isnan(value), value)
        if field.name in table.key:
            problem = F.lit(f"{table.name}: {field.name} is null")
            value = F.coalesce(value, F.raise_error(problem).cast(field.dataType))
        columns.append(value.alias(field.name))
    kept = [F.col(c) for c in rows.columns if c.startswith("_")]
    return rows.select(*columns, *kept)
