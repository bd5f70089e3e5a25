"""Past orders stored once and asked often.

The orders are written twice, in buckets by item (with the size of their order) and in buckets by order. A
request shuffles the new baskets only: both joins read the past where it lies. The rows of an item in very many
orders are cut into slices by order, so that they fill many buckets.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.functions.metrics import cosine_of_sets
from basketlens.operators import recommend
from basketlens.operators.nearest import neighbour_items, ranked_singles
from basketlens.operators.skew import GROUP_ROWS, TASK_PAIRS, tasks_for
from basketlens.session import cut_lineage

BUCKET_ROWS = 5_000_000


@dataclass(frozen=True)
class StoredOrders:
    by_item: DataFrame  # item, slice, order_id, o_size
    by_order: DataFrame  # order_id, item
    items: DataFrame  # item, slices, n


def _save(df: DataFrame, name: str, path: str, buckets: int, *keys: str) -> None:
    # dealt out as the buckets are, each is one file
    df.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).option("path", path).saveAsTable(name)


def store_orders(past: DataFrame, name: str, folder: str, buckets: int | None = None, slice_rows: int = GROUP_ROWS) -> StoredOrders:
    """Save past orders (order_id, item), and the list of their items, as tables called ``name``_... in a shared folder.

    There are at least as many buckets as shuffle partitions, since Spark would else deal the past out anew.
    """
    spark = past.sparkSession
    past = cut_lineage(past.select("order_id", "item").distinct())
    if buckets is None:
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), past.count() // BUCKET_ROWS + 1)
    slices = F.ceil(F.count("*") / slice_rows).cast("int").alias("slices")
    past.groupBy("item").agg(slices, F.count("*").alias("n")).write.mode("overwrite").option("path", f"{folder}/items").saveAsTable(f"{name}_items")
    sizes = past.groupBy("order_id").agg(F.count("*").alias("o_size"))
    own = F.pmod(F.xxhash64("order_id"), F.col("slices")).cast("int").alias("slice")
    by_item = past.join(sizes, "order_id").join(spark.table(f"{name}_items").drop("n"), "item").select("item", own, "order_id", "o_size")
    _save(by_item, f"{name}_by_item", f"{folder}/by_item", buckets, "item", "slice")
    _save(past, f"{name}_by_order", f"{folder}/by_order", buckets, "order_id")
    return open_orders(spark, name)


def open_orders(spark: SparkSession, name: str) -> StoredOrders:
    return StoredOrders(*(spark.table(f"{name}_{part}") for part in ("by_item", "by_order", "items")))


def nearest_orders(new: DataFrame, orders: StoredOrders, k: int) -> DataFrame:
    """(basket_id, order_id, sim): the k stored orders nearest to each new basket, ties kept.

    ``new`` is (basket_id, item); texts that are no stored item drop out."""
    known = cut_lineage(new.select("basket_id", "item").distinct().join(orders.items, "item"))
    sizes = known.groupBy("basket_id").agg(F.count("*").alias("b_size"))
    every = F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice")
    wanted = known.join(sizes, "basket_id").select("basket_id", "b_size", "item", every)
    met = wanted.join(orders.by_item, ["item", "slice"])
    # dealt once for the sums and the ranking, to as many tasks as the stored counts say that there are pairs
    tasks = tasks_for(known.agg(F.sum("n")).first()[0] or 0, TASK_PAIRS, known)
    pairs = met.repartition(tasks, "basket_id").groupBy("basket_id", "order_id", "b_size", "o_size").agg(F.count("*").alias("overlap"))
    sim = cosine_of_sets(F.col("overlap"), F.col("b_size"), F.col("o_size")).alias("sim")
    return ranked_singles(pairs.select("basket_id", "order_id", sim), k, ties=True).drop("rank")


def score_items(new: DataFrame, orders: StoredOrders, k: int = recommend.NEIGHBOURS) -> DataFrame:
    """As ``recommend.score_items``, from stored orders."""
    return recommend.scored(neighbour_items(nearest_orders(new, orders, k), orders.by_order, k, ties=True))


def recommend_unseen(new: DataFrame, orders: StoredOrders, k: int = recommend.NEIGHBOURS) -> DataFrame:
    return recommend.unseen_only(score_items(new, orders, k), new)
