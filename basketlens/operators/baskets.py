"""Baskets in long form: one row per (order_id, item). No wide matrix is built."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from basketlens.functions.columns import hashed_number


def dedupe_lines(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First line of each key. Spark keeps one row per key and task before the shuffle, so a key
    with very many copies does not fill one task."""
    first = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")


def make_baskets(df: DataFrame, order_id: str, item: str) -> DataFrame:
    return df.select(F.col(order_id).alias("order_id"), F.col(item).alias("item")).distinct()


def item_list(df: DataFrame, item: str = "item") -> DataFrame:
    return df.select(F.col(item).alias("item")).distinct()


def numbered_items(items: DataFrame, seed: int = 0, buckets: int = 1024) -> DataFrame:
    """Items with consecutive numbers from 0, in pseudo-random order.

    Numbers are given inside hash buckets; a bucket starts where the ones before it end. Only the
    bucket sizes, at most ``buckets`` rows, are ever put in one order.
    """
    hashed = items.withColumn("h", hashed_number(seed, F.col("item")))
    # 2^32 numbers in equal ranges, so the bucket order is the number order
    placed = hashed.withColumn("bucket", F.floor(F.col("h") / (2**32 / buckets)))
    sizes = placed.groupBy("bucket").agg(F.count("*").alias("size"))
    before = W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("bucket", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    inside = W.partitionBy("bucket").orderBy("h", "item")
    return placed.join(F.broadcast(starts), "bucket").select(
        "item", (F.col("start") + F.row_number().over(inside) - 1).alias("number")
    )


def basket_table(baskets: DataFrame, items: list[str]) -> DataFrame:
    """Order x item table of 0 and 1, for a small named set of items."""
    wide = baskets.groupBy("order_id").pivot("item", items).agg(F.max(F.lit(1)))
    return wide.fillna(0, subset=items)


def nonzero_cells(wide: DataFrame, key: str) -> DataFrame:
    """Back from the wide table to one row per nonzero cell."""
    columns = [c for c in wide.columns if c != key]
    return wide.unpivot([key], columns, "item", "value").filter("value <> 0").select(key, "item")


def encode_orders(new: DataFrame, items: DataFrame) -> DataFrame:
    """Distinct known items of each new order; unknown texts drop out."""
    return new.select("basket_id", "item").distinct().join(items, "item", "left_semi")


def membership(items: DataFrame, order: DataFrame) -> DataFrame:
    """Every item with 1 if the order holds it, else 0."""
    held = order.select("item").distinct().withColumn("_held", F.lit(1.0))
    return items.join(held, "item", "left").select("item", F.coalesce("_held", F.lit(0.0)).alias("value"))


def append_order(order: DataFrame, past: DataFrame) -> DataFrame:
    return order.select(F.col("basket_id").alias("order_id"), "item").unionByName(past)
