"""Tables that are replaced as a whole, at once for every reader.

A version is a Parquet folder beside the table's own path, and a small file names the
current one. The file is written under another name and then renamed over the old one,
which file systems do in one step; until then readers see the old version, whatever
becomes of the writer. A table without that file is read at its own path. The version
before the current one stays for readers that are still at it; older ones go.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

POINTER = "_current"


def versions_of(path: str) -> str:
    return f"{path.rstrip('/')}.versions"


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _named(spark: SparkSession, path: str) -> list[str]:
    """The current version and the one before it, as the pointer has them."""
    system, pointer = _file_system(spark, f"{versions_of(path)}/{POINTER}")
    if not system.exists(pointer):
        return []
    stream = system.open(pointer)
    try:
        return bytes(stream.readAllBytes()).decode().split()
    finally:
        stream.close()


def current_path(spark: SparkSession, path: str) -> str:
    """Where the rows of a table are: its current version, or its own path."""
    names = _named(spark, path)
    return f"{versions_of(path)}/{names[0]}" if names else path


def replace_table(rows: DataFrame, path: str, **options: str) -> None:
    """Makes ``rows`` the table. They may come from the version they replace.

    A failure while they are written leaves the old version in place.
    """
    spark = rows.sparkSession
    name = uuid.uuid4().hex
    rows.write.options(**options).parquet(f"{versions_of(path)}/{name}")
    _point(spark, path, name)


def _point(spark: SparkSession, path: str, name: str) -> None:
    before = _named(spark, path)[:1]
    folder = versions_of(path)
    system, draft = _file_system(spark, f"{folder}/{POINTER}-{name}")
    stream = system.create(draft, True)
    try:
        stream.write(bytearray(" ".join([name, *before]).encode()))
    finally:
        stream.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        draft.toUri(), spark._jsc.hadoopConfiguration()
    ) if draft.toUri().getScheme() else jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        spark._jsc.hadoopConfiguration()
    )
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    over = spark.sparkContext._gateway.new_array(rename, 1)
    over[0] = rename.OVERWRITE
    context.rename(draft, jvm.org.apache.hadoop.fs.Path(f"{folder}/{POINTER}"), over)
    kept = {name, *before}
    for entry in system.listStatus(jvm.org.apache.hadoop.fs.Path(folder)):
        if entry.isDirectory() and entry.getPath().getName() not in kept:
            system.delete(entry.getPath(), True)
