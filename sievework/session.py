"""Session settings and tables that cut lineage."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sievework")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.files.openCostInBytes", "256k")
        .config("spark.sql.files.minPartitionNum", str(cores))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session.

    The cluster names a shared folder in ``spark.checkpoint.dir``; without one, a
    private folder is made for a local master and any other is an error, as
    executors would not see the driver's disk.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not context.master.split("[")[0] == "local":
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return context.getCheckpointDir()


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the shared folder; it goes when the driver's process ends."""
    folder = f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
    atexit.register(_at_exit, spark, folder)
    return folder


def _at_exit(spark: SparkSession, folder: str) -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone
        drop_folder(spark, folder)


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder of the shared one, if the session still runs."""
    context = spark.sparkContext
    if context._jsc is not None:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows for the jobs that start meanwhile."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def landed(df: DataFrame, purpose: str, rows: int | None = None, codec: str | None = None) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back.

    Cuts the lineage and survives the loss of any executor; unlike
    ``checkpoint()`` the last stage runs once. Meanwhile Python gets batches of at most ``rows`` rows. ``codec`` packs wide texts closer than the session's does.
    """
    folder = new_folder(df.sparkSession, purpose)
    with contextlib.nullcontext() if rows is None else arrow_rows(df.sparkSession, rows):
        df.write.options(**{} if codec is None else {"compression": codec}).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def checkpointed(df: DataFrame, rows: int | None = None, codec: str | None = None) -> DataFrame:
    """Cut the lineage of ``df`` through the shared folder."""
    return landed(df, "table", rows, codec)
