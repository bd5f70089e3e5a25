"""Descriptive views of the clean sales lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.columns import hour_of, mean_or_null, weekday_name, weekday_number


def top_with_ties(counts: DataFrame, weight: str, n: int) -> DataFrame:
    """The n largest rows and every row that ties with the last of them.

    The cut is the n-th largest weight, found by a distributed top-n; then a filter. A window
    over the whole table would sort it in one task.
    """
    cut = counts.orderBy(F.desc(weight)).limit(n).agg(F.min(weight))
    return counts.filter(F.col(weight) >= cut.scalar())


def item_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("Description").agg(F.count("*").alias("count"))


def best_sellers(df: DataFrame, n: int = 10) -> DataFrame:
    return top_with_ties(item_counts(df), "count", n).orderBy(F.desc("count"), "Description")


def item_shares(df: DataFrame, n: int = 10) -> DataFrame:
    """The n best sellers with their share of all lines, in percent."""
    counts = item_counts(df)
    total = counts.agg(F.sum("count").alias("total"))  # one row
    share = (F.col("count") / F.col("total")) * 100
    top = top_with_ties(counts, "count", n).crossJoin(F.broadcast(total))
    return top.withColumn("pct", share).drop("total").orderBy(F.desc("pct"), "Description")


def lines_by_hour(df: DataFrame) -> DataFrame:
    return df.groupBy(hour_of(F.col("Time")).alias("hour")).agg(F.count("*").alias("count"))


def lines_by_weekday(df: DataFrame) -> DataFrame:
    days = df.groupBy(weekday_number(F.col("Date")).alias("weekday")).agg(F.count("*").alias("count"))
    return days.withColumn("label", weekday_name(F.col("weekday")))


def avg_line_quantity(df: DataFrame) -> DataFrame:
    """Mean quantity of the lines of each invoice."""
    return df.groupBy("InvoiceNo").agg(mean_or_null(F.col("Quantity")).alias("avg_line_quantity"))


def with_value(df: DataFrame) -> DataFrame:
    return df.withColumn("Value", F.col("UnitPrice") * F.col("Quantity"))


def avg_line_value(df: DataFrame) -> DataFrame:
    """Mean value of the lines of each invoice."""
    return with_value(df).groupBy("InvoiceNo").agg(mean_or_null(F.col("Value")).alias("avg_line_value"))


def histogram(df: DataFrame, value: str, bins: int, view: tuple[float, float] = (0.0, 100.0)) -> DataFrame:
    """Equal-width bins over the whole range, then those that touch the viewed part."""
    values = df.select(F.col(value).alias("x")).filter("x is not null")
    ends = values.agg(F.min("x").alias("lo"), ((F.max("x") - F.min("x")) / bins).alias("width"))  # one row
    placed = values.crossJoin(F.broadcast(ends))
    number = F.when(F.col("width") == 0, bins - 1).otherwise(
        F.least(F.floor((F.col("x") - F.col("lo")) / F.col("width")), F.lit(bins - 1))
    )
    left = F.col("lo") + F.col("bin") * F.col("width")
    return (
        placed.withColumn("bin", number.cast("bigint"))
        .groupBy("bin", "lo", "width")
        .agg(F.count("*").alias("count"))
        .select("bin", left.alias("bin_from"), (left + F.col("width")).alias("bin_to"), "count")
        .filter((F.col("bin_to") >= view[0]) & (F.col("bin_from") <= view[1]))
    )


def units_by_country(df: DataFrame) -> DataFrame:
    return df.groupBy("Country").agg(F.sum("Quantity").alias("units"))
