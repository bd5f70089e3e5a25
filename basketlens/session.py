"""Session settings and lineage cutting."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(app: str = "basketlens", cores: str = "*", partitions: int = 8) -> SparkSession:
    """Session for tests and the bench. On a cluster, use the session the cluster gives."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        # a join whose partitions all prove small at run time is hashed instead of sorted
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BASKETLENS_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _checkpoint_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Only a local session without one gets a temporary
    folder; a cluster without one is an error, since a folder on one machine would be lost with it.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if context.master.startswith("local-cluster") or not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder")
            folder = tempfile.mkdtemp(prefix="basketlens-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside are deleted as soon as it has run. Else they stay until the driver collects its
    garbage, and the steps of a query add up on disk."""
    before = spark.conf.get(TIDY, None)
    spark.conf.set(TIDY, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(TIDY)
        else:
            spark.conf.set(TIDY, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write a table that several later steps read to the shared checkpoint folder."""
    _checkpoint_folder(df.sparkSession)
    with tidy(df.sparkSession):
        # the setting holds for plans made while it is on
        return df.select("*").checkpoint()


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``cut_lineage`` that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        file = table._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
        path = spark._jvm.org.apache.hadoop.fs.Path(file.get())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path that all executors share, for tables and files of one run."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or _checkpoint_folder(spark)
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
