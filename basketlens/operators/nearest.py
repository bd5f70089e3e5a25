"""Past orders nearest to new baskets, by cosine of their item sets.

The cosine of two sets is overlap / sqrt(size * size). Overlaps come from a join on the item, whose
cost is the number of orders per item, squared. Where an item is *hot* (in very many orders), ``set_search``
finds the same neighbours: it folds equal orders and asks common items only where a neighbour can be.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from basketlens.functions.columns import stable
from basketlens.functions.metrics import cosine_of_sets
from basketlens.operators.blocks import basket_items_in_blocks, blocks_for
from basketlens.operators.set_blocks import items_in_set_blocks
from basketlens.operators.set_search import NearestSets, items_of_neighbours, nearest_sets
from basketlens.operators.skew import GROUP_ROWS, HOT_ROWS, hot_keys, join_in_slices
from basketlens.session import cut_lineage, discard


def _sized(df: DataFrame, row_id: str) -> DataFrame:
    return df.join(df.groupBy(row_id).agg(F.count("*").alias("size")), row_id)


def _pairs(new: DataFrame, past: DataFrame, same_orders: bool, new_rows: DataFrame, rows: DataFrame) -> DataFrame:
    """(basket_id, order_id, sizes, overlap) for baskets and orders with a common item. The last two
    tables have the items of the first two, for counting."""
    if same_orders:
        # new and past are the same table: each unordered pair once, then both directions
        a = past.select("item", F.col("order_id").alias("a"), F.col("size").alias("a_size"), F.col("fold").alias("a_fold"))
        b = past.select("item", F.col("order_id").alias("b"), F.col("size").alias("b_size"), F.col("fold").alias("b_fold"))
        met = join_in_slices(a, b, ["item"], "a", "b", left_rows=rows, right_rows=rows).filter("a < b")
        pairs = met.groupBy("a", "b", "a_size", "b_size").agg(F.count("*").alias("overlap"))

        def seen(x: str, y: str) -> Column:
            return F.struct(
                F.col(x).alias("basket_id"),
                F.col(y).alias("order_id"),
                F.col(x + "_size").alias("b_size"),
                F.col(y + "_size").alias("o_size"),
            )

        both = F.explode(F.array(seen("a", "b"), seen("b", "a"))).alias("p")
        return pairs.select(both, "overlap").select("p.*", "overlap")
    met = join_in_slices(
        new.select("item", "basket_id", F.col("size").alias("b_size"), F.col("fold").alias("b_fold")),
        past.select("item", "order_id", F.col("size").alias("o_size"), F.col("fold").alias("o_fold")),
        ["item"],
        "basket_id",
        "order_id",
        left_rows=new_rows,
        right_rows=rows,
    ).filter("b_fold <> o_fold")
    return met.groupBy("basket_id", "order_id", "b_size", "o_size").agg(F.count("*").alias("overlap"))


def ranked_singles(sims: DataFrame, k: int, ties: bool) -> DataFrame:
    by_sim = W.partitionBy("basket_id").orderBy(F.desc("sim"))
    if ties:
        kept = sims.withColumn("rank", F.rank().over(by_sim)).filter(F.col("rank") <= k)
    else:
        one_by_one = W.partitionBy("basket_id").orderBy(F.desc("sim"), "order_id")
        kept = sims.withColumn("rank", F.row_number().over(one_by_one)).filter(F.col("rank") <= k)
    return kept


def nearest_orders(
    new: DataFrame,
    past: DataFrame,
    k: int,
    *,
    ties: bool = True,
    same_orders: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame | NearestSets:
    """The k past orders nearest to each basket, with ties at the k-th place (``ties``) or cut by
    order id.

    ``new`` is (basket_id, item), ``past`` (order_id, item), both distinct. With a column ``fold``
    in both, a basket sees only orders of other folds. ``same_orders`` says that both are the same
    orders, each of which is compared with all others.
    """
    if "fold" not in past.columns:
        new, past = new.withColumn("fold", F.lit(1)), past.withColumn("fold", F.lit(0))
    if hot_keys(past.select("item"), ["item"], hot_rows) is not None:
        return nearest_sets(new, past, k, same_orders)
    # read several times below: the narrow tables are written once
    past = cut_lineage(_sized(past, "order_id"))
    new = past.withColumnRenamed("order_id", "basket_id") if same_orders else cut_lineage(_sized(new, "basket_id"))
    pairs = _pairs(new, past, same_orders, new.select("item"), past.select("item"))
    sims = pairs.select("basket_id", "order_id", cosine_of_sets(F.col("overlap"), F.col("b_size"), F.col("o_size")).alias("sim"))
    return ranked_singles(sims, k, ties).drop("rank")


def neighbour_items(found: DataFrame | NearestSets, past: DataFrame, k: int, ties: bool) -> DataFrame:
    """(basket_id, item, n, support_sim): neighbours holding the item, and their summed cosine."""
    if isinstance(found, NearestSets):
        return items_of_neighbours(found, k, ties)
    held = found.join(past.select("order_id", "item"), "order_id")
    return held.groupBy("basket_id", "item").agg(F.count("*").alias("n"), stable(F.sum("sim")).alias("support_sim"))


def items_of_nearest(
    new: DataFrame,
    past: DataFrame,
    k: int,
    *,
    ties: bool = True,
    same_orders: bool = False,
    hot_rows: int = HOT_ROWS,
    unseen: bool = False,
    n: int | None = None,
) -> DataFrame:
    """(basket_id, item, n, support_sim) of the items that the k nearest past orders of each basket hold.

    ``unseen`` leaves out the items of the basket. ``n`` says that only the n unseen items with the largest support
    are used: others may be left out. Goes by blocks of baskets and orders; where an item is in very many orders, by
    blocks of baskets and sets, which also give the ``rank`` of the n items; else by ``nearest_orders``.
    """
    hot = hot_keys(past.select("item"), ["item"], hot_rows) is not None
    found = None if hot else _items_in_blocks(new, past, k, ties, same_orders, hot_rows, unseen or n is not None, n)
    # the folded sets leave out nulls, which the join over items keeps
    if found is None and (hot or past.filter("item is null or order_id is null").isEmpty()):
        a, b = (new, past) if "fold" in past.columns else (new.withColumn("fold", F.lit(1)), past.withColumn("fold", F.lit(0)))
        found = items_in_set_blocks(a, b, k, ties, same_orders, unseen, n)
    if found is not None:
        return found
    items = neighbour_items(nearest_orders(new, past, k, ties=ties, same_orders=same_orders, hot_rows=hot_rows), past, k, ties)
    if not unseen:
        return items
    held = (new.withColumnRenamed("order_id", "basket_id") if same_orders else new).select("basket_id", "item")
    return items.join(held, ["basket_id", "item"], "left_anti")


def _items_in_blocks(
    new: DataFrame, past: DataFrame, k: int, ties: bool, same_orders: bool, hot_rows: int, unseen: bool, n: int | None
) -> DataFrame | None:
    if "fold" not in past.columns:
        new, past = new.withColumn("fold", F.lit(1)), past.withColumn("fold", F.lit(0))
    per_order = past.filter("order_id is not null").groupBy("order_id", "fold")
    # a list of structs, since a list of items would leave out nulls
    orders = cut_lineage(per_order.agg(F.collect_list(F.struct("item")).alias("rows")).select("order_id", "fold", F.col("rows.item").alias("items")))
    listed = orders.select(F.explode("items").alias("item"), F.col("order_id").alias("id"), "fold", F.size("items").alias("size"), "items").filter("item is not null")
    if same_orders:
        baskets, rows, spent = listed, listed.withColumns({"own": F.lit(True), "listed": F.lit(True)}), (orders,)
    else:
        sized = cut_lineage(_sized(new.select("item", F.col("basket_id").alias("id"), "fold"), "id"))
        baskets, spent = sized.filter("item is not null"), (orders, sized)
        own = baskets.withColumns({"items": F.lit(None).cast(listed.schema["items"].dataType), "own": F.lit(True), "listed": F.lit(False)})
        rows = listed.withColumns({"own": F.lit(False), "listed": F.lit(True)}).unionByName(own)
    blocks = blocks_for(baskets, listed, ["item"], ["id"], min(GROUP_ROWS, hot_rows))
    if blocks is None:
        discard(*spent)
        return None
    return basket_items_in_blocks(rows, blocks, k, ties, same_orders, unseen, n, spent)
