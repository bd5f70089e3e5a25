"""Cleaning of raw sales lines. Every step is a row filter or a projection: no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.columns import is_adjustment, is_cancellation, is_non_product, plain_number


def cancellations(raw: DataFrame) -> DataFrame:
    return raw.filter(is_cancellation(F.col("InvoiceNo")))


def without_cancellations(raw: DataFrame) -> DataFrame:
    return raw.filter(~is_cancellation(F.col("InvoiceNo")))


def positive_quantities(df: DataFrame) -> DataFrame:
    return df.filter(F.col("Quantity") > 0)


def other_quantities(df: DataFrame) -> DataFrame:
    return df.filter(F.col("Quantity") <= 0)


def non_products(df: DataFrame) -> DataFrame:
    return df.filter(is_non_product(F.col("StockCode")))


def without_non_products(df: DataFrame) -> DataFrame:
    return df.filter(~is_non_product(F.col("StockCode")))


def without_adjustments(df: DataFrame) -> DataFrame:
    return df.filter(~is_adjustment(F.col("Description")))


def with_description(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["Description"])


def sold_lines(raw: DataFrame) -> DataFrame:
    """No cancellations, positive quantities."""
    return positive_quantities(without_cancellations(raw))


def product_lines(raw: DataFrame) -> DataFrame:
    """Sold lines whose stock code is a product."""
    return without_non_products(sold_lines(raw))


def typed_lines(df: DataFrame) -> DataFrame:
    """Numeric invoice number (missing where it is no number), date, time of day."""
    return df.withColumns(
        {
            "InvoiceNo": plain_number(F.col("InvoiceNo")),
            "Date": F.to_date("InvoiceDate"),
            "Time": F.date_format("InvoiceDate", "HH:mm:ss"),
        }
    )


def clean_retail(raw: DataFrame) -> DataFrame:
    return typed_lines(with_description(without_adjustments(product_lines(raw))))


def cleaning_counts(raw: DataFrame) -> DataFrame:
    """(step, name, lines): the lines left after each step of the cleaning, all counted in one pass."""
    steps = {
        "raw": F.lit(True),
        "without cancellations": ~is_cancellation(F.col("InvoiceNo")),
        "positive quantities": F.col("Quantity") > 0,
        "without other codes": ~is_non_product(F.col("StockCode")),
        "without adjustments": ~is_adjustment(F.col("Description")),
        "with description": F.col("Description").isNotNull(),
    }
    counts, left = [], F.lit(True)
    for number, (name, kept) in enumerate(steps.items()):
        left = left & kept
        counts.append(F.struct(F.lit(number).alias("step"), F.lit(name).alias("name"), F.count_if(left).alias("lines")))
    return raw.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))


def cancellation_count(raw: DataFrame) -> DataFrame:
    return cancellations(raw).agg(F.count("*").alias("Total"))


def adjustment_audit(raw: DataFrame) -> DataFrame:
    """What the lines without a positive quantity are."""
    return (
        other_quantities(without_cancellations(raw))
        .groupBy("Description", "UnitPrice")
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "Description", "UnitPrice")
    )


def stockcode_audit(raw: DataFrame) -> DataFrame:
    """What the lines with a non-product code are."""
    return (
        non_products(sold_lines(raw))
        .groupBy("StockCode", "Description")
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "StockCode", "Description")
    )
