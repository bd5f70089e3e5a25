"""Joins whose output is far larger than their input, and size checks before a broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from basketlens.session import cut_lineage

# rows of one side that one join group may hold before it is split
GROUP_ROWS = 20_000
# joined rows to give one task
TASK_PAIRS = 2_000_000
# joined rows that one join group may give before it is split: a task gets several groups
CELL_PAIRS = TASK_PAIRS // 4
MOST_TASKS = 100_000
# a join key with more rows than this may be hot
HOT_ROWS = 50_000
# keys that can be hot at most
HOT_KEYS = 100_000
# lines that one task puts together
TASK_ROWS = 500_000
# places up to which Spark prunes a ranking window before its shuffle
WINDOW_ROWS = 1_000
# rows a checked broadcast may have
BROADCAST_ROWS = 1_000_000


def tasks_for(rows: int, most: int, df: DataFrame) -> int:
    """Tasks for counted rows, at most ``most`` in each. The session's number would let them grow with the input."""
    return min(max(rows // most + 1, df.sparkSession.sparkContext.defaultParallelism), MOST_TASKS)


def join_small(left: DataFrame, right: DataFrame, keys: list[str], left_id: str, right_id: str, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Inner join with a right side that is broadcast only when a count proves it small; else the
    rows of both sides are sliced, so that a key in very many left rows is no single task."""
    if right.limit(rows + 1).count() <= rows:
        return left.join(F.broadcast(right), keys)
    return join_in_slices(left, right, keys, left_id, right_id)


def numbered_in_order(df: DataFrame, by: list[str], order: list[Column], limit: int, name: str, window_rows: int = WINDOW_ROWS) -> DataFrame:
    """The first ``limit`` rows of each ``by`` group in the given order, with their place from 1.

    A short limit is a window, of which Spark drops all but the first rows before the shuffle.
    Beyond that the rows are range-partitioned: places are given inside each range, and a range
    starts where the ones before it end, so that no group is sorted in one task.
    """
    if limit <= window_rows:
        return df.withColumn(name, F.row_number().over(W.partitionBy(*by).orderBy(*order))).filter(F.col(name) <= limit)
    ranges = cut_lineage(df.repartitionByRange(*by, *order).withColumn("_range", F.spark_partition_id()))
    before = W.partitionBy(*by).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        ranges.groupBy(*by, "_range").agg(F.count("*").alias("_size")).withColumn("_start", F.coalesce(F.sum("_size").over(before), F.lit(0)))
    ).drop("_size")
    inside = F.row_number().over(W.partitionBy(*by, "_range").orderBy(*order))
    placed = ranges.join(starts, [*by, "_range"]).withColumn(name, (F.col("_start") + inside).cast("int"))
    return placed.filter(F.col(name) <= limit).drop("_range", "_start")


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows, and with more than 1 / HOT_KEYS of all rows, so that
    there are never more than HOT_KEYS of them: they may be broadcast. None if there is no such key."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
    size = counts.agg(F.sum("n").alias("rows"), F.max("n").alias("most")).first()
    least = max(hot_rows, (size["rows"] or 0) // HOT_KEYS)
    if (size["most"] or 0) <= least:
        return None
    return cut_lineage(counts.filter(F.col("n") > least).select(*keys))


def join_in_slices(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_id: str,
    right_id: str,
    group_rows: int = GROUP_ROWS,
    left_rows: DataFrame | None = None,
    right_rows: DataFrame | None = None,
    cell_pairs: int = CELL_PAIRS,
) -> DataFrame:
    """Inner equi-join, planned by the number of joined rows instead of the size of its input.

    The rows per key are counted first. They tell how many rows the join will give, and so how many
    tasks it needs; adaptive execution would size the tasks by the small input. A key with more than
    ``group_rows`` rows on a side, or more than ``cell_pairs`` joined rows, is cut into a grid: each side
    by hash of its row id, and every left slice meets every right slice once, in tasks of their own. A
    cell gives about ``cell_pairs`` rows: both sides are cut to the square root of it, or the longer one
    alone if the other is shorter than that. No pair is lost or doubled.

    ``left_rows`` and ``right_rows`` are tables to count instead, if those with the same keys exist
    in a cheaper form.
    """

    def per_key(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.count("*").alias(name))

    n_left = per_key(left if left_rows is None else left_rows, "n_left")
    n_right = per_key(right if right_rows is None else right_rows, "n_right")
    counted = n_left.join(n_right, keys)
    totals = counted.agg(
        F.sum(F.col("n_left").cast("double") * F.col("n_right")).alias("pairs"),
        F.max(F.greatest("n_left", "n_right")).alias("most"),
        F.max(F.col("n_left").cast("double") * F.col("n_right")).alias("most_pairs"),
    ).first()
    spark = left.sparkSession
    wanted = int((totals["pairs"] or 0) / TASK_PAIRS) + 1
    tasks = min(max(wanted, spark.sparkContext.defaultParallelism), MOST_TASKS)
    if (totals["most"] or 0) <= group_rows and (totals["most_pairs"] or 0) <= cell_pairs:
        return left.repartition(tasks, *keys).join(right.repartition(tasks, *keys), keys)

    def cut(own: str, other: str) -> Column:
        kept = F.greatest(F.lit(cell_pairs**0.5), F.lit(float(cell_pairs)) / F.col(other))
        return F.ceil(F.col(own) / F.least(F.lit(float(group_rows)), kept))

    large = (F.greatest("n_left", "n_right") > group_rows) | (F.col("n_left").cast("double") * F.col("n_right") > cell_pairs)
    cuts = counted.filter(large).select(
        *keys, cut("n_left", "n_right").alias("_cut_left"), cut("n_right", "n_left").alias("_cut_right")
    )

    def sliced(df: DataFrame, own: str, other: str, row_id: str) -> DataFrame:
        return (
            df.join(cuts, keys, "left")
            .withColumn("_own" + own, F.pmod(F.xxhash64(row_id), F.coalesce("_cut" + own, F.lit(1))))
            .withColumn("_own" + other, F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("_cut" + other, F.lit(1)) - 1)))
            .drop("_cut_left", "_cut_right")
        )

    pieces = [*keys, "_own_left", "_own_right"]
    return (
        sliced(left, "_left", "_right", left_id)
        .repartition(tasks, *pieces)
        .join(sliced(right, "_right", "_left", right_id).repartition(tasks, *pieces), pieces)
        .drop("_own_left", "_own_right")
    )
