"""Joins and rankings that split hot groups give what the plain ones give."""

import pytest
from pyspark.sql import functions as F

from basketlens.operators import skew


@pytest.fixture(scope="module")
def sides(spark):
    # a third of the left rows and half of the right rows have one key
    left = spark.range(90).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).alias("k"), F.col("id").alias("a"))
    right = spark.range(40).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 5).alias("k"), F.col("id").alias("b"))
    return left, right


def test_sliced_join_is_the_join(sides):
    left, right = sides
    want = sorted(map(tuple, left.join(right, "k").select("a", "b").collect()))
    for rows in (1000, 30, 4):
        joined = skew.join_in_slices(left, right, ["k"], "a", "b", group_rows=rows)
        assert sorted(map(tuple, joined.select("a", "b").collect())) == want
    for rows in (1000, 10):
        assert sorted(map(tuple, skew.join_small(left, right, ["k"], "a", "b", rows).select("a", "b").collect())) == want


def test_cells_are_cut_by_pairs(spark):
    # one key gives 600 x 900 of the rows, and one meets few rows on the other side
    left = spark.range(700).select(F.when(F.col("id") < 600, 0).when(F.col("id") < 603, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("a"))
    right = spark.range(1900).select(F.when(F.col("id") < 900, 0).when(F.col("id") < 1800, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("b"))
    joined = skew.join_in_slices(left, right, ["k"], "a", "b", cell_pairs=10_000)
    plain = left.join(right, "k")
    assert joined.select("a", "b").exceptAll(plain.select("a", "b")).count() == 0
    assert joined.count() == plain.count() == 600 * 900 + 3 * 900
    # cells of at most a hundred rows a side, dealt out over all tasks
    tasks = joined.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(tasks) == spark.sparkContext.defaultParallelism
    assert max(t["count"] for t in tasks) < 0.6 * 600 * 900


def test_hot_keys_are_bounded(sides):
    left, _ = sides
    assert {r.k for r in skew.hot_keys(left, ["k"], 20).collect()} == {0}
    assert skew.hot_keys(left, ["k"], 1000) is None


@pytest.mark.parametrize("limit", [5, 25, 1000])
def test_numbering_by_ranges(sides, limit):
    left, _ = sides
    df = left.select((F.col("a") % 2).alias("g"), (F.col("a") % 10).alias("n"), "a")
    order = [F.desc("n"), F.asc("a")]
    want = sorted(map(tuple, skew.numbered_in_order(df, ["g"], order, limit, "p").collect()))
    assert sorted(map(tuple, skew.numbered_in_order(df, ["g"], order, limit, "p", window_rows=0).collect())) == want
