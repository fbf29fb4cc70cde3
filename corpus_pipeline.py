"""The corpus pipeline: quality rules, line dedup, near-dedup, mixing, token ids.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept.
``run`` writes every stage's rows as Parquet in the shared folder and reads them again;
what a stage wrote for itself goes when its rows are written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import line_edits, minhash, mixing, quality
from tickloom.llm.common import load, packed, scratch, stored
from tickloom.llm.queries import encoded_and_decoded

#: Line dedup and near-dedup decide by edit distance and signatures, which the SQL of
#: the other engine cannot follow on whole tables.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule and no host verdict rejects, with all their columns.

    A null or empty text has no words and goes. A null host gives no verdict. Equal rows
    go or stay together; an empty table stays empty.
    """
    measured = stored(quality.measure(packed(docs, "text", "source")).drop("text"), "measured")
    return quality.judge(measured).where("kept").select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat earlier ones go.

    So do documents that repeat a whole earlier one, and those whose lines go for the
    most part. Null texts stay as they are. Of equal lines the one with the smallest
    (doc_id, line) stays, a null id being smallest; rows that repeat id and text are one
    document and go or stay together. An empty table stays empty.
    """
    gone = line_edits.repeated_lines(docs).unionByName(line_edits.repeated_texts(docs))
    return line_edits.remaining(docs, gone)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every near-duplicate group.

    Null and wordless texts and rows without an id are in no group and stay. Rows that
    repeat an id go or stay together. An empty table stays empty.
    """
    found = minhash.near_duplicates(docs)
    gone = found.where("id <> component_id").select(F.col("id").alias("gone")).distinct()
    rows = packed(docs, F.col("doc_id").alias("id"))
    return rows.join(gone, F.col("id") == F.col("gone"), "left_anti").select("row.*")


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources are repeated towards the target weights; no document is cut.

    A null source is a source of its own; documents without a word are taken once.
    Equal rows are drawn alike. An empty table stays empty.
    """
    mix = mixing.Mix()
    plan = mixing.plan_sources(stored(mixing.slim_rows(docs), "slim"), mix)
    return mixing.mix_rows(packed(docs, "doc_id", "source"), plan, mix).select("row.*")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Counts and digests of the token ids of every document drawn.

    A null or empty text has no ids. Repeated rows stay; an empty table gives none.
    """
    return encoded_and_decoded(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("token_ids", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with scratch(spark):
            docs = stored(stage(spark, docs, sf_dir), name, keep=True)
    return docs
