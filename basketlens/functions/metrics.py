"""Similarity metrics by name.

A metric says what each rating row carries into the pair join (``prepare``), which sums a pair
needs (``sums``) and how they give the similarity (``value``). All are column expressions. In
``sums`` the two sides are the prefixes ``t_`` (target) and ``n_`` (neighbour).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cosine_of_sets(overlap: Column, size_a: Column, size_b: Column) -> Column:
    return overlap / F.sqrt((size_a * size_b).cast("double"))


@dataclass(frozen=True)
class Metric:
    prepare: Callable[[DataFrame, list[str]], DataFrame]
    carried: list[str]
    sums: Callable[[], dict[str, Column]]
    value: Callable[[], Column]
    symmetric: bool = True
    # the similarity is the product of unit vectors: the sum of x * x over common columns
    unit_terms: bool = False
    # the same on arrays, for searches in blocks: terms of two x that are summed, and the similarity of the sum and one x of each side
    terms: Callable | None = None
    finish: Callable | None = None


def _unit_length(ratings: DataFrame, entity: list[str]) -> DataFrame:
    """Ratings over the length of the whole column of their entity."""
    lengths = ratings.groupBy(*entity).agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("_length"))
    return ratings.join(lengths, entity).withColumn("x", F.try_divide("v", "_length")).drop("_length")


def _around_mean(ratings: DataFrame, entity: list[str]) -> DataFrame:
    """Ratings minus the mean of all ratings of their entity."""
    means = ratings.groupBy(*entity).agg(F.avg("v").alias("_mean"))
    return ratings.join(means, entity).withColumn("x", F.col("v") - F.col("_mean")).drop("_mean")


def _with_size(ratings: DataFrame, entity: list[str]) -> DataFrame:
    sizes = ratings.groupBy(*entity).agg(F.count("*").alias("x"))
    return ratings.join(sizes, entity)


def _product() -> Column:
    return F.col("t_x") * F.col("n_x")


COSINE = Metric(
    prepare=_unit_length,
    carried=["x"],
    sums=lambda: {"dot": F.sum(_product())},
    value=lambda: F.col("dot"),
    unit_terms=True,
    terms=lambda t, n: t * n,
    finish=lambda total, t, n: total,
)

# means over all ratings of a column, sums over the common rows only: not the same as F.corr
CORRELATION = Metric(
    prepare=_around_mean,
    carried=["x"],
    sums=lambda: {
        "xy": F.sum(_product()),
        "xx": F.sum(F.col("t_x") * F.col("t_x")),
        "yy": F.sum(F.col("n_x") * F.col("n_x")),
    },
    value=lambda: F.try_divide(F.col("xy"), F.sqrt("xx") * F.sqrt("yy")),
)

JACCARD = Metric(
    prepare=_with_size,
    carried=["x"],
    sums=lambda: {"both": F.count(F.lit(1)), "t_size": F.max("t_x"), "n_size": F.max("n_x")},
    value=lambda: F.col("both") / (F.col("t_size") + F.col("n_size") - F.col("both")),
    terms=lambda t, n: t * 0.0 + 1.0,
    finish=lambda both, t, n: both / (t + n - both),
)

METRICS: dict[str, Metric] = {"cosine": COSINE, "correlation": CORRELATION, "jaccard": JACCARD}


def register_metric(name: str, metric: Metric) -> None:
    METRICS[name] = metric
