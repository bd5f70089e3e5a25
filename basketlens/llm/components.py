"""Connected components of a table of links, by hooking to the smallest neighbour, shortcutting and contracting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.tables import discard, keep


def shortcut(hooks: DataFrame) -> DataFrame:
    """Hooks (from, to) led to the end of their chains; each step doubles the links that a hook spans."""
    while True:
        ahead = hooks.select(F.col("from").alias("to"), F.col("to").alias("end"))
        if hooks.join(ahead, "to", "left_semi").isEmpty():
            return hooks
        led = keep(hooks.join(ahead, "to", "left").select("from", F.coalesce("end", "to").alias("to")), "hooks")
        discard(hooks)
        hooks = led


def components(links: DataFrame) -> DataFrame:
    """Component of every node that has a link.

    ``links`` has columns ``a`` and ``b`` of one type, without nulls; loops and repeated links do no
    harm. Returns ``node`` and ``component``, the smallest node reachable. In each round every node
    hooks to its smallest neighbour if that is smaller, hooks are followed to their ends, and links are
    contracted to these, so at most half of the nodes that have links stay in the next round, and a chain of any
    length in the order of its nodes takes one round with as many steps as its length has bits. Only
    minima are aggregated, so a node with very many neighbours is combined before the shuffle.
    """
    open_links = keep(links.where("a <> b").select("a", "b").distinct(), "links")
    found = keep(open_links.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("component", F.col("node")), "found")
    while not open_links.isEmpty():
        both = open_links.unionByName(open_links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = shortcut(keep(both.groupBy(F.col("a").alias("from")).agg(F.min("b").alias("to")).where(F.col("to") < F.col("from")), "hooks"))
        named = keep(found.join(hooks, found["component"] == hooks["from"], "left").select("node", F.coalesce("to", "component").alias("component")), "found")
        left = open_links
        for end in ("a", "b"):
            hooked = hooks.select(F.col("from").alias(end), F.col("to").alias(f"{end}_to"))
            left = left.join(hooked, end, "left").withColumn(end, F.coalesce(f"{end}_to", end)).drop(f"{end}_to")
        left = keep(left.where("a <> b").select("a", "b").distinct(), "links")
        discard(found, open_links, hooks)
        found, open_links = named, left
    discard(open_links)
    return found
