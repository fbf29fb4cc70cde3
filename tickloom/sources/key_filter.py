"""Key checks that read stored keys only where a key is probably known.

Beside a dated table lies a filter of its keys, split by year like the table: words of
64 bits, of which a key sets a few in the one word its hash names. A key whose bits are
not all set is new for certain and is written without a look at the table; only the
others, known ones and a few by chance, are compared with stored keys, and only those of
their years and days are read. A batch of new keys reads none.

Bits are added before the rows they stand for, so a run that is cut short leaves bits
too many, which cost a look, and never too few. Words are stored only where a bit is
set, so the number of words a year may have costs nothing until they are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.ingest import ARRIVAL, first_per_key
from tickloom.schemas import Table
from tickloom.session import scratch_path
from tickloom.sources.sinks import ALL_OR_NOTHING, write_rows
from tickloom.sources.tables import YEAR, conform, path_exists, read_range, read_table
from tickloom.sources.versions import current_path

#: Words of a year and bits a key sets in its word. With five keys a word one new key in
#: fifty is looked up for nothing; more words lower that for years with more keys.
WORDS = 1 << 25
BITS = 4


def _folder(path: str, words: int) -> str:
    return f"{path.rstrip('/')}.keys{words}"


def _word(key: tuple[str, ...], words: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("word"), *key), F.lit(words))


def _mask(key: tuple[str, ...]) -> Column:
    """The bits of a key, six bits of a second hash for the place of each."""
    places = F.xxhash64(F.lit("bits"), *key)
    mask = F.lit(0).cast("bigint")
    for i in range(BITS):
        place = F.shiftrightunsigned(places, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))
    return mask


def key_bits(rows: DataFrame, table: Table, words: int) -> DataFrame:
    """(year, word, bits) of the keys; copies of a word meet in an aggregate."""
    marked = rows.select(
        F.year("date").alias(YEAR), _word(table.key, words).alias("word"), _mask(table.key).alias("bits")
    )
    return marked.groupBy(YEAR, "word").agg(F.bit_or("bits").alias("bits"))


def add_keys(rows: DataFrame, table: Table, path: str, words: int = WORDS) -> None:
    bits = key_bits(rows, table, words)
    bits.hint("rebalance", YEAR).write.mode("append").options(**ALL_OR_NOTHING).partitionBy(YEAR).parquet(
        _folder(path, words)
    )


def probably_known(keys: DataFrame, table: Table, path: str, words: int = WORDS) -> DataFrame:
    """The keys whose bits are all set; a key that is stored is always among them.

    The filter of the keys' years is read, whose words meet the keys by a join.
    """
    spark = keys.sparkSession
    wanted = keys.select(
        *table.key, F.year("date").alias(YEAR), _word(table.key, words).alias("word"),
        _mask(table.key).alias("mask"),
    )
    years = [r[0] for r in wanted.select(YEAR).distinct().collect()]
    schema = f"word bigint, bits bigint, {YEAR} int"
    held = spark.read.schema(schema).parquet(_folder(path, words)).where(F.col(YEAR).isin(years))
    # A word has a row for every batch that set bits of it. They meet before the keys do, so
    # that the keys move once.
    held = held.groupBy(YEAR, "word").agg(F.bit_or("bits").alias("bits"))
    met = wanted.join(held, [YEAR, "word"])
    return met.where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask")).select(*table.key)


def insert_filtered(
    spark: SparkSession,
    batch: DataFrame,
    table: Table,
    path: str,
    words: int = WORDS,
    arrival: str = ARRIVAL,
    unique: bool = False,
) -> None:
    """Appends the rows whose key the dated table lacks, as ``insert_if_absent`` does.

    A table that has no filter yet gets one of its stored keys. One writer at a time.
    """
    if not table.dated:
        raise ValueError(f"{table.name} has no dates to split a filter by")
    fresh = conform(batch, table)
    fresh = fresh if unique else first_per_key(fresh, table.key, arrival)
    # Read for the filter, for the check and for the write.
    staged = scratch_path(spark, f"{table.name}-batch")
    fresh.select(*table.schema.names).write.parquet(staged)
    fresh = spark.read.schema(table.schema).parquet(staged)
    exists = path_exists(spark, path)
    if exists and not path_exists(spark, _folder(path, words)):
        add_keys(read_table(spark, path, table).select(*table.key), table, path, words)
    if exists:
        found = scratch_path(spark, f"{table.name}-known")
        probably_known(fresh.select(*table.key), table, path, words).write.parquet(found)
        maybe = spark.read.schema(fresh.select(*table.key).schema).parquet(found)
        first, last = maybe.agg(F.min("date"), F.max("date")).first()
        if first is not None:
            stored = read_range(spark, path, table, first, last).select(*table.key)
            known = maybe.join(stored, list(table.key), "left_semi")
            fresh = fresh.join(known, list(table.key), "left_anti").select(*table.schema.names)
    add_keys(fresh.select(*table.key), table, path, words)
    write_rows(fresh, table, current_path(spark, path), "append")
