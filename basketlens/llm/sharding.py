"""Shards of equal size from sampled splitters, with DataFrame operations only.

Rows are ordered by (digest of the text, key), so copies of a text stand together. A sample in which a row
is drawn with a chance in proportion to its size gives the splitters, its quantiles; they cut the order
into many ranges, each of which one task numbers. A range that turns out overfull is sampled again and
cut further, down to single keys of one text, so a text that a third of all rows share is spread over
many ranges. Sums over the ranges then give every row its exact place in the whole order, in rows and in
bytes, and a shard is a stretch of that order. The result does not depend on the sample; only the work
of the tasks does.

The few rows that are large against a shard (over a hundredth of it; at most 100 per shard) are dealt out
first, by falling size back and forth over the shards; the stretches fill up the rest.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.columns import utf8
from basketlens.session import cut_lineage

#: Rows that a range should hold, and the fewest and most ranges that the first sample makes.
RANGE_ROWS, FEWEST, MOST = 20_000, 64, 4096
#: Sampled keys per range. The sample is sorted in one task: at most MOST * DRAWS keys, whatever the input.
DRAWS = 16
#: A range is overfull beyond so many times its even share of rows or bytes.
OVERFULL = 3
#: A row is large if it has more than one part in so many of a shard.
LARGE = 100


def _chance(seed: int):
    """A number in [0, 1) fixed by the row's place."""
    return F.pmod(F.xxhash64("place", F.lit(seed)), F.lit(1 << 53)) / float(1 << 53)


def _cuts(rows: DataFrame, weight, draws: float, step: int, width: int) -> list[str]:
    """Quantiles of a sample of the rows' places; ``weight`` is a row's share of all weights."""
    drawn = rows.where(_chance(step) < weight * draws).select(F.substring("place", 1, width).alias("place"))
    numbered = drawn.withColumn("number", F.row_number().over(Window.orderBy("place")))
    return [r["place"] for r in numbered.where(F.col("number") % DRAWS == 0).select("place").distinct().collect()]


def _ranges(rows: DataFrame, cuts: list[str]) -> DataFrame:
    """Rows with the number of the range that holds their place.

    A range is met by the first three digits of its places, so that the lookup is a hash join.
    """
    bounds = ["", *sorted(set(cuts)), "g"]
    cells = []
    for number, (low, high) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        last = 0xFFF if high == "g" else int(high[:3], 16)
        cells += [(f"{cell:03x}", low, high, number) for cell in range(int(low[:3] or "0", 16), last + 1)]
    table = rows.sparkSession.createDataFrame(cells, "cell string, low string, high string, range int")
    met = rows.join(F.broadcast(table), F.substring("place", 1, 3) == F.col("cell"))
    return met.where("place >= low AND place < high").drop("cell", "low", "high")


def shard_by_bytes(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Put every row into one of the shards so that their sizes in bytes are nearly equal.

    A row's size is the UTF-8 length of its text plus 1; a null text counts as empty. Returns one row per
    input row: the key, ``size``, ``text_crc32``, ``law`` ("bytes"), ``shard``, ``slot`` (0, 1, ... in each
    shard) and ``grown_shard`` (null under this law). Shards differ by about a hundredth at most, unless a
    single row is larger than a shard. Copies of one text lie in one shard where they make up less than a
    hundredth of it. Rows with null or repeated keys are rows like any other. An empty table gives an
    empty result; extra columns are ignored.
    """
    body = utf8(F.col(f"`{text}`"))
    shifted = F.lpad((F.col(f"`{key}`").cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("string"), 20, "0")
    rows = cut_lineage(
        docs.select(
            F.col(f"`{key}`").alias("id"),
            (F.octet_length(body) + 1).cast("bigint").alias("size"),
            F.crc32(body).alias("crc"),
            F.concat(F.md5(body), F.coalesce(shifted, F.lit(""))).alias("place"),
        )
    )
    number, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()

    is_large = F.col("size") * (LARGE * shards) > total
    order = Window.orderBy(F.desc("size"), "place")
    large = rows.where(is_large).withColumn("turn", F.row_number().over(order) - 1)
    lap, seat = F.floor(F.col("turn") / shards), F.col("turn") % shards
    large = large.select(
        "id", "size", "crc", F.when(lap % 2 == 0, seat).otherwise(shards - 1 - seat).cast("int").alias("shard"), lap.alias("slot")
    )
    filled = {r["shard"]: (r["rows"], r["bytes"]) for r in large.groupBy("shard").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes")).collect()}
    large_rows = sum(f[0] for f in filled.values())
    rest = total - sum(f[1] for f in filled.values())

    small = rows.where(~is_large)
    wanted = max(FEWEST, min(MOST, number // RANGE_ROWS))
    cuts = _cuts(small, F.col("size") / float(max(rest, 1)), wanted * DRAWS, 1, 32) if number else []
    for step in range(2, 6):
        ranged = _ranges(small, cuts)
        sums = ranged.groupBy("range").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"))
        most_rows, most_bytes = OVERFULL * max(number // wanted, 1), OVERFULL * max(rest // wanted, 1)
        overfull = sums.where((F.col("rows") > most_rows) | (F.col("bytes") > most_bytes))
        crowded = ranged.join(F.broadcast(overfull.select("range")), "range").drop("range")
        again = _cuts(crowded, F.lit(1.0 / max(number, 1)), wanted * DRAWS * 4, step, 52) if not overfull.isEmpty() else []
        if not set(again) - set(cuts):
            break
        cuts = sorted({*cuts, *again})

    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        "range", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"), F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before")
    )
    inside = Window.partitionBy("range").orderBy("place")
    same = Window.partitionBy("range", F.substring("place", 1, 32))
    placed = (
        ranged.withColumn("row", F.row_number().over(inside) - 1)
        .withColumn("end", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("group_end", F.max("end").over(same))
        .withColumn("group_start", F.min(F.col("end") - F.col("size")).over(same))
        .join(F.broadcast(starts), "range")
    )
    together = (F.col("group_end") - F.col("group_start")) * (LARGE * shards) <= total
    middle = F.when(together, F.col("group_start") + F.col("group_end")).otherwise(2 * F.col("end") - F.col("size")) + 2 * F.col("bytes_before")
    room = [max(total / shards - filled.get(s, (0, 0))[1], 0) for s in range(shards)]
    scale = rest / (sum(room) or 1)
    edges = [2 * scale * sum(room[: s + 1]) for s in range(shards - 1)]
    shard = reduce(add, [F.when(middle >= edge, 1).otherwise(0) for edge in edges], F.lit(0))
    placed = placed.select("id", "size", "crc", shard.alias("shard"), (F.col("rows_before") + F.col("row")).alias("place"), "range")

    firsts = placed.groupBy("shard").agg(F.min("place").alias("first"))
    taken = rows.sparkSession.createDataFrame([(s, filled.get(s, (0, 0))[0]) for s in range(shards)], "shard int, taken bigint")
    firsts = firsts.join(F.broadcast(taken), "shard")
    placed = placed.join(F.broadcast(firsts), "shard").select("id", "size", "crc", "shard", (F.col("place") - F.col("first") + F.col("taken")).alias("slot"))
    both = placed.unionByName(large) if large_rows else placed
    return both.select(
        F.col("id").alias(key), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"), F.col("slot").cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
