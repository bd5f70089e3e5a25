"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from basketlens.llm.columns import shared_folder


def keep(df: DataFrame, name: str = "table") -> DataFrame:
    """Write a table that several later steps read, and read it back.

    Later steps plan from the written files: a lost executor costs no recomputation, and steps in a loop do
    not carry the plans of the steps before them.
    """
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.kept_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``keep`` that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.kept_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
