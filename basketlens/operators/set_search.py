"""Past orders nearest to new baskets where items are in very many orders: an exact search over sets, from the rarest items.

The cosine of two sets is overlap / sqrt(size * size). Three things keep the search from pairing all orders
that share a common item:

1. Orders with the same items are one *set* with a count, and so are baskets. However many orders
   consist of a few common items, their sets are few.
2. Items are numbered by falling rarity and sets list them in that order. A pair is made at its rarest common
   item only, where both lists give the whole overlap at once, so pairs are neither counted nor shuffled.
3. A basket first meets the sets that hold its rarest item, then those with its next rarest ones, then the rest.
   The k-th best so far bounds what it still has to find: a set at that cosine shares so many items
   that one of them is among the first of the basket's list (the prefix), is neither too short nor too long, and has
   enough items left after the common one. Only such pairs are kept, and items after the prefix are not
   asked at all. As long as fewer than k orders are found, nothing bounds the search.

Nothing is left out: a pair that is not made is strictly farther than the k-th best.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from basketlens.functions.columns import stable
from basketlens.functions.metrics import cosine_of_sets
from basketlens.operators.skew import join_in_slices, numbered_in_order
from basketlens.session import cut_lineage

#: Slack of comparisons with a bound, far below the distance of two cosines of sets.
SLACK = 1e-9
#: Places in a basket's list at which a round of questions begins; each round is bounded by those before it.
ROUNDS = [0, 1, 4]


@dataclass(frozen=True)
class NearestSets:
    """Neighbours of each set of baskets with their place in its ranking.

    ``n`` orders of the set ``set_id`` lie at ``sim``; ``better`` orders are strictly nearer, ``upto`` is that number with all ties.
    """

    near: DataFrame  # b_set, fold, set_id, sim, n, better, upto
    baskets: DataFrame  # b_set, basket_id
    sets: DataFrame  # set_id, items
    orders: DataFrame  # order_id, fold, items
    codes: DataFrame  # code, item


def rarity_codes(past: DataFrame) -> DataFrame:
    """(item, code): numbers that rise with the number of orders that hold the item."""
    counts = past.groupBy("item").agg(F.count("*").alias("n"))
    return cut_lineage(counts.orderBy("n", "item").select("item", F.monotonically_increasing_id().alias("code")))


def listed_items(rows: DataFrame, row_id: str, codes: DataFrame) -> DataFrame:
    """(id, fold, size, items): the known items of each row id, rarest first, and the number of all its items."""
    coded = rows.join(codes, "item", "left")
    return coded.groupBy(row_id, "fold").agg(F.count("*").alias("size"), F.sort_array(F.collect_list("code")).alias("items"))


def _met(profiles: DataFrame, sets: DataFrame, same_orders: bool) -> DataFrame:
    """(b_set, fold, set_id, sim, n) of the profile rows (with ``at``, ``code`` and, if bounded, ``kth``) and sets."""
    index = sets.select("set_id", "items", "total", "folds", F.posexplode("items").alias("o_at", "code"))
    met = join_in_slices(profiles, index, ["code"], "b_set", "set_id", left_rows=profiles.select("code"), right_rows=index.select("code"))
    o_size = F.size("items")
    if "kth" in profiles.columns:
        least, theirs = F.coalesce("kth", F.lit(0.0)), F.least(F.size("b_items") - F.col("at"), o_size - F.col("o_at"))
        met = met.filter(
            (o_size >= least * least * F.col("size") - SLACK)
            & (o_size * least * least <= F.col("size") + SLACK)
            & (theirs >= least * F.sqrt((F.col("size") * o_size).cast("double")) - SLACK)
        )
    n = F.col("total") - (F.col("b_items") == F.col("items")).cast("bigint") if same_orders else F.col("total") - F.coalesce(F.col("folds")[F.col("fold")], F.lit(0))
    shared = F.array_intersect("b_items", "items")
    met = met.select("b_set", "fold", "set_id", "code", "size", o_size.alias("o_size"), shared.alias("shared"), n.alias("n"))
    met = met.filter((F.element_at("shared", 1) == F.col("code")) & (F.col("n") > 0))
    return met.select("b_set", "fold", "set_id", cosine_of_sets(F.size("shared"), F.col("size"), F.col("o_size")).alias("sim"), "n")


def _nearest_rows(sims: DataFrame, k: int) -> DataFrame:
    """The rows that can be among the k nearest: each stands for one order at least."""
    return sims.withColumn("rank", F.rank().over(W.partitionBy("b_set").orderBy(F.desc("sim")))).filter(F.col("rank") <= k).drop("rank")


def _placed(near: DataFrame) -> DataFrame:
    nearer = W.partitionBy("b_set").orderBy(F.desc("sim")).rangeBetween(W.unboundedPreceding, 0)
    placed = near.withColumn("upto", F.sum("n").over(nearer))
    return placed.withColumn("better", F.col("upto") - F.sum("n").over(W.partitionBy("b_set", "sim")))


def nearest_sets(new: DataFrame, past: DataFrame, k: int, same_orders: bool = False) -> NearestSets:
    """The k past orders nearest to each basket, with all ties at the k-th place.

    ``new`` is (basket_id, item, fold), ``past`` (order_id, item, fold), both distinct. A basket sees only orders of
    other folds, or with ``same_orders``, where both are the same orders, all but itself.
    """
    codes = rarity_codes(past)
    orders = cut_lineage(listed_items(past, "order_id", codes))
    per_fold = orders.groupBy("items", "fold").agg(F.count("*").alias("n"))
    folded = per_fold.groupBy("items").agg(F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("fold", "n"))).alias("folds"))
    sets = cut_lineage(folded.withColumn("set_id", F.monotonically_increasing_id()))

    baskets = orders.withColumnRenamed("order_id", "basket_id") if same_orders else cut_lineage(listed_items(new, "basket_id", codes))
    look = ["items", "size", "fold"]
    profiles = cut_lineage(baskets.select(*look).distinct().withColumn("b_set", F.monotonically_increasing_id()))
    named = profiles.withColumnRenamed("items", "b_items")
    rows = named.select("*", F.posexplode("b_items").alias("at", "code"))

    near = None
    for low, high in zip(ROUNDS, [*ROUNDS[1:], None], strict=True):
        asked = rows.filter(F.col("at") >= low) if high is None else rows.filter(F.col("at").between(low, high - 1))
        if near is not None:
            kth = _placed(near).filter(F.col("upto") >= k).groupBy("b_set").agg(F.max("sim").alias("kth"))
            prefix = F.size("b_items") - F.ceil(F.col("kth") * F.col("kth") * F.col("size") - SLACK) + 1
            asked = asked.join(kth, "b_set", "left").filter(F.col("kth").isNull() | (F.col("at") < prefix))
        met = _met(asked, sets, same_orders)
        near = cut_lineage(_nearest_rows(met if near is None else near.unionByName(met), k))
    return NearestSets(
        near=cut_lineage(_placed(near).filter(F.col("better") < k)),
        baskets=baskets.join(profiles, look).select("b_set", "basket_id"),
        sets=sets.select("set_id", "items"),
        orders=orders.select("order_id", "fold", "items"),
        codes=codes,
    )


def _cut_ties(found: NearestSets, k: int) -> DataFrame:
    """Neighbours at the similarity where the k-th place falls: as many of each set as have the smallest order ids."""
    edge = found.near.filter((F.col("better") < k) & (F.col("upto") > k)).drop("n", "upto")
    members = found.orders.join(found.sets, "items").select("set_id", F.col("fold").alias("o_fold"), "order_id")
    first = numbered_in_order(members, ["set_id", "o_fold"], [F.asc("order_id")], k, "place")
    listed = join_in_slices(edge, first, ["set_id"], "b_set", "order_id").filter("fold <> o_fold")
    by_id = F.row_number().over(W.partitionBy("b_set").orderBy("order_id"))
    taken = listed.withColumn("place", by_id).filter(F.col("place") <= k).filter(F.col("better") + F.col("place") <= k)
    return taken.groupBy("b_set", "set_id", "sim").agg(F.count("*").alias("n"))


def items_of_neighbours(found: NearestSets, k: int, ties: bool) -> DataFrame:
    """(basket_id, item, n, support_sim): neighbours holding the item, and their summed cosine.

    With ``ties``, all neighbours at the k-th similarity count; without, those with the smallest order ids.
    """
    cells = ["b_set", "set_id", "sim", "n"]
    near = found.near if ties else found.near.filter(F.col("upto") <= k)
    near = near.select(*cells) if ties else near.select(*cells).unionByName(_cut_ties(found, k))
    held = near.join(found.sets, "set_id").select("b_set", F.explode("items").alias("code"), "sim", "n")
    # the same sum whatever the order: terms of one similarity are counted, then multiplied
    per_sim = held.groupBy("b_set", "code", "sim").agg(F.sum("n").alias("n"))
    summed = per_sim.groupBy("b_set", "code").agg(F.sum("n").alias("n"), stable(F.sum(F.col("sim") * F.col("n"))).alias("support_sim"))
    items = summed.join(found.codes, "code").drop("code")
    return join_in_slices(items, found.baskets, ["b_set"], "item", "basket_id").select("basket_id", "item", "n", "support_sim")
