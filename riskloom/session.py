"""Session settings and scratch tables shared by every job."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    # Timestamps are compared and truncated in UTC everywhere.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot join keys are split at run time; the joins here keep the small side unique.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Of long texts and packed rows a few thousand would fill a worker's memory, and the JVM's beside it.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    # Compiled methods that the JVM would never optimise are not used: wide tables take the plain operators instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # What a job has shuffled goes with the job: results that are needed again are written as tables.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


class _Made(threading.local):
    """Scratch tables by thread, so jobs that run side by side do not delete each other's."""

    def __init__(self) -> None:
        self.paths: list[str] = []


_made = _Made()
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application; they need not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="riskloom-package-"), "riskloom.zip")
    with zipfile.ZipFile(archive, "w") as bundle:
        for folder, _, files in os.walk(package):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    bundle.write(path, os.path.relpath(path, os.path.dirname(package)))
    # Spark serves the file to every executor, also to those that join later.
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings and ship the code the operators rely on; cluster sizing is left alone."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    ship_package(spark)
    return spark


def local_session(cores: int | str = "*", app: str = "riskloom", memory: str = "12g") -> SparkSession:
    """Single-machine session for tests and the bench."""
    partitions = "8" if cores == "*" else str(cores)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can read and write, as named by ``spark.checkpoint.dir``.

    Only when the session names none (tests, a laptop) is a temporary folder used, and only on a
    local master.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        # A local cluster's executors have folders of their own.
        if context.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="riskloom-")
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder for a table a job writes and reads back."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _made.paths.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete on leaving the scratch tables written inside; only for work whose results do not read them."""
    before = len(_made.paths)
    try:
        yield
    finally:
        drop_scratch(spark, before)


def scratch_count() -> int:
    """How many scratch tables this thread has written that were not deleted."""
    return len(_made.paths)


def drop_scratch(spark: SparkSession, keep: int = 0, spared: str | None = None) -> int:
    """Delete the scratch tables this thread has written after the first ``keep``, once their results are no
    longer needed; the one at ``spared`` stays."""
    dropped, spare = 0, spared in _made.paths[keep:]
    while len(_made.paths) > keep:
        made = _made.paths.pop()
        if made != spared:
            path = spark._jvm.org.apache.hadoop.fs.Path(made)
            files = path.getFileSystem(spark._jsc.hadoopConfiguration())
            dropped += bool(files.delete(path, True))
    if spare:
        _made.paths.append(spared)
    return dropped


def written_alone(spark: SparkSession, name: str, make: Callable[[], DataFrame], codec: str | None = None) -> DataFrame:
    """The table that ``make`` gives, written; the scratch tables ``make`` needed are deleted. ``codec`` is the session's if None."""
    path = scratch_path(spark, name)
    with scratch_scope(spark):
        make().write.parquet(path, compression=codec)
    return spark.read.parquet(path)


def written_once(df: DataFrame, name: str, codec: str | None = None, group_rows: int | None = None) -> DataFrame:
    """``df`` written as a parquet table in the shared folder, so later passes read only what they need; ``codec`` is the session's if None.
    ``group_rows`` is for rows of megabytes: a task writes and reads that many at a time, whatever the rest of its file holds."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write if group_rows is None else df.write.option("parquet.block.row.count.limit", str(group_rows))
    writer.parquet(path, compression=codec)
    return df.sparkSession.read.parquet(path)
