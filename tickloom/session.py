"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    # A feature query needs more generated classes than the default cache of 100.
    "spark.sql.codegen.cache.maxEntries": "2000",
    "spark.ui.enabled": "false",
}


def build_session(
    app_name: str = "tickloom", master: str | None = None, **overrides: str
) -> SparkSession:
    """A session with the settings the jobs expect.

    On a cluster leave ``master`` unset; shuffle partitions and memory come from
    the submit command. Keyword names use ``__`` for dots.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULTS)
    settings.update({k.replace("__", "."): v for k, v in overrides.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, from ``spark.checkpoint.dir``.

    A temporary folder is used only in local mode, where driver and executors
    are one process on one machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="tickloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
        return folder
    raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def ship_code(spark: SparkSession) -> None:
    """Sends this package to the Python workers of the session, once."""
    context = spark.sparkContext
    if getattr(context, "_tickloom_shipped", False):
        return
    package = Path(__file__).resolve().parent
    # Written and served by the driver; executors fetch it from there.
    target = Path(tempfile.mkdtemp(prefix="tickloom-code-")) / f"tickloom_{uuid.uuid4().hex}.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent).as_posix())
    context.addPyFile(str(target))
    context._tickloom_shipped = True
