"""Readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.functions.columns import trimmed
from basketlens.schema import RATINGS, RAW_RETAIL

# column for lines that do not fit the schema
BROKEN = "broken_line"
TEXT_TIMES = {"timestampFormat": "yyyy-MM-dd HH:mm:ss", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}


def trim_texts(df: DataFrame) -> DataFrame:
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({name: trimmed(F.col(name)) for name in texts})


def read_checked_text(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """Typed rows of delimited text files, with the whole line in ``broken_line`` where it does not fit
    the schema: a value of another type, too few or too many values. Good lines have null there.

    Spark checks only the values that a query asks for, so the mark asks for all of them (the comparison
    holds for every hash).
    """
    marked = T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())])
    settings = {"header": True, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN, "escape": '"', **TEXT_TIMES, **options}
    lines = spark.read.schema(marked).options(**settings).csv(path)
    return lines.withColumn(BROKEN, F.when(F.hash(*schema.names) >= -(2**31), F.col(BROKEN)))


def good_lines(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(BROKEN).isNull()).drop(BROKEN)


def line_report(checked: DataFrame, key: str) -> DataFrame:
    """One row: all lines, the broken ones, and the good ones without a value in ``key``."""
    good = F.col(BROKEN).isNull()
    return checked.agg(
        F.count("*").alias("lines"),
        F.count(BROKEN).alias("broken_lines"),
        F.count_if(good & F.col(key).isNull()).alias("without_key"),
    )


def read_raw_retail(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Raw sales lines with a fixed schema, every text trimmed; lines of text files that do not fit it
    are left out (``read_checked_text`` and ``line_report`` show them)."""
    if fmt == "csv":
        return trim_texts(good_lines(read_checked_text(spark, path, RAW_RETAIL)))
    return trim_texts(spark.read.schema(RAW_RETAIL).format(fmt).load(path))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_ratings(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Ratings with a fixed schema; lines of text files that do not fit it are left out."""
    if fmt == "csv":
        return good_lines(read_checked_text(spark, path, RATINGS))
    return spark.read.schema(RATINGS).format(fmt).load(path)


def save_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def save_text(df: DataFrame, path: str) -> None:
    """Delimited text files with a header line each, as ``read_checked_text`` reads them."""
    df.write.mode("overwrite").options(header=True, escape='"', **TEXT_TIMES).csv(path)
