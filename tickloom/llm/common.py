"""Helpers shared by the operators: stored tables, word rules, named values."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.session import scratch_path, ship_code

#: What separates words: space, tab, line feed, vertical tab, form feed, return.
WORD_GAP = r"[\x20\x09-\x0D]+"


#: Folders written inside the open ``scratch`` block, if any.
_WRITTEN: ContextVar[list[str] | None] = ContextVar("written", default=None)


def stored(rows: DataFrame, label: str, compression: str = "snappy", keep: bool = False) -> DataFrame:
    """The rows, written to the shared folder and read again.

    Cuts the lineage: a lost executor repeats no work before the written table. Inside
    a ``scratch`` block the table goes at its end, unless ``keep`` is set.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, label)
    written = _WRITTEN.get()
    if written is not None and not keep:
        written.append(path)
    rows.write.option("compression", compression).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Drops what ``stored`` writes inside, as soon as the block ends or fails.

    What is to be read later is written with ``keep`` as the last step of the block.
    """
    paths: list[str] = []
    token = _WRITTEN.set(paths)
    try:
        yield
    finally:
        _WRITTEN.reset(token)
        for path in paths:
            drop_folder(spark, path)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Removes a written table that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """Words of a text, none for null."""
    words = F.filter(F.split(text, WORD_GAP), lambda w: w != "")
    return F.coalesce(words, F.array().cast("array<string>"))


def free_name(rows: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front until no column has that name."""
    taken = {c.lower() for c in rows.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def whole_row_hash(rows: DataFrame) -> Column:
    """A hash of all columns, for an order among rows that only equal rows tie in."""
    plain = [F.to_json(F.struct(c)) if "map<" in t else F.col(c) for c, t in quoted(rows)]
    return F.xxhash64(*plain)


def packed(rows: DataFrame, *names: str) -> DataFrame:
    """All columns as one struct ``row``, and some of them beside it.

    Helper columns that are added to it cannot clash with those of the input;
    ``select("row.*")`` unpacks.
    """
    return rows.select(F.struct(*(F.col(c) for c, _ in quoted(rows))).alias("row"), *names)


def quoted(rows: DataFrame) -> list[tuple[str, str]]:
    return [(f"`{c.replace('`', '``')}`", t) for c, t in rows.dtypes]
