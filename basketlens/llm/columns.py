"""Small column and table helpers of the corpus operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def utf8(text: Column) -> Column:
    """The UTF-8 bytes of a text, null as none."""
    return F.coalesce(text.cast("binary"), F.lit(b""))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share, for tables and files of one run.

    Only a session on one machine may do without ``spark.checkpoint.dir``.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        master = spark.sparkContext.master
        if master.startswith("local-cluster") or not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        folder = tempfile.mkdtemp(prefix="basketlens-")
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
