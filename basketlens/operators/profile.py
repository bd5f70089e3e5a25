"""Table profiles."""

from __future__ import annotations

from functools import reduce
from math import floor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from basketlens.session import cut_lineage, shared_folder
from basketlens.sources.tables import read_table, save_table

QUARTILES = [0.25, 0.5, 0.75]
# distinct values that one task puts in order
ORDERED_VALUES = 100_000
# parts that a bracket of values is cut into where it holds more
PARTS = 64
BRACKET = "column string, share double, rank double, `from` double, `to` double, values bigint"


def first_rows(df: DataFrame, *order: str, n: int = 6) -> DataFrame:
    return df.orderBy(*order).limit(n)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"))


def schema_view(df: DataFrame) -> DataFrame:
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields, 1)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string")


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One pass over the table, one result row per column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column", "n_null")


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct values per column; missing counts as a value."""

    def distinct(c: str):
        missing = F.coalesce(F.max(F.col(c).isNull().cast("int")), F.lit(0))
        return (F.count_distinct(F.col(c)) + missing).cast("bigint").alias(c)

    return df.agg(*[distinct(c) for c in columns]).unpivot([], columns, "column", "n_distinct")


def _narrowed(counted: DataFrame, brackets: list[tuple]) -> list[tuple]:
    """Brackets around the same ranks with fewer distinct values in them.

    Each bracket is cut at values of its own column into ``PARTS`` parts, the rows of each part and those on
    each cut are counted, and the part or cut that holds the rank is the new bracket. The counts are exact, so
    it does not matter how well the cuts were chosen. Counts are collected: at most two per cut.
    """
    wide = counted.sparkSession.createDataFrame(brackets, BRACKET)
    held = counted.join(F.broadcast(wide), "column").filter("value >= `from` AND value <= `to`")
    shares = [i / PARTS for i in range(1, PARTS)]
    cuts = held.groupBy("column", "share").agg(
        F.array_sort(
            F.array_distinct(F.concat(F.percentile_approx("value", shares, 100 * PARTS), F.array(F.first("from"), F.first("to"))))
        ).alias("cuts")
    )
    # one row per (column, share) and PARTS values in it, so the broadcast is bounded
    placed = counted.join(F.broadcast(cuts), "column").select(
        "column",
        "share",
        "cuts",
        F.size(F.filter("cuts", lambda cut: cut <= F.col("value"))).alias("place"),
        F.array_contains("cuts", F.col("value")).alias("on"),
        "copies",
    )
    counts = placed.groupBy("column", "share", "place", "on").agg(
        F.sum("copies").alias("rows"), F.count("*").alias("values"), F.first("cuts").alias("cuts")
    )
    parts = {}
    for r in counts.collect():
        parts.setdefault((r["column"], r["share"]), []).append((r["place"], not r["on"], r["rows"], r["values"], r["cuts"]))
    found = []
    for column, share, rank, *_ in brackets:
        upto = 0
        for place, between, rows, values, at in sorted(parts[column, share]):
            upto += rows
            if upto > floor(rank):
                break
        found.append((column, share, rank, at[place - 1], at[place] if between else at[place - 1], values + 2 * between))
    return found


def exact_percentiles(df: DataFrame, columns: list[str], shares: list[float], most_values: int = ORDERED_VALUES) -> DataFrame:
    """Exact percentiles, linear between neighbours, without one task holding a whole column.

    Each wanted rank has a bracket of two values of its column. Brackets with more than ``most_values`` distinct
    values are narrowed by counts, all of them in the same jobs, and then the values inside are put in order;
    the rows below a bracket are only counted. Result: (column, share, value).
    """
    long = df.select([F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], columns, "column", "value"
    ).filter("value is not null")
    # read once per narrowing
    counted = cut_lineage(long.groupBy("column", "value").agg(F.count("*").alias("copies")))
    ends = counted.groupBy("column").agg(
        F.sum("copies").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"), F.count("*").alias("values")
    )
    ready, wide = [], [(r["column"], s, s * (r["n"] - 1), r["low"], r["high"], r["values"]) for r in ends.collect() for s in shares]
    while wide:
        ready += [b for b in wide if b[-1] <= max(most_values, 2)]
        wide = [b for b in wide if b[-1] > max(most_values, 2)]
        wide = _narrowed(counted, wide) if wide else []
    # one row per (column, share): as many rows as the caller named, so the broadcast is bounded
    brackets = df.sparkSession.createDataFrame(ready, BRACKET).drop("values")
    placed = counted.join(F.broadcast(brackets), "column")
    value, copies = F.col("value"), F.col("copies")
    outside = placed.groupBy("column", "share").agg(
        F.coalesce(F.sum(F.when(value < F.col("from"), copies)), F.lit(0)).alias("below"),
        F.min(F.when(value > F.col("to"), value)).alias("next"),
    )
    inside = placed.filter("value >= `from` and value <= `to`")
    running = W.partitionBy("column", "share").orderBy("value").rowsBetween(W.unboundedPreceding, 0)
    ranked = (
        inside.withColumn("upto", F.sum("copies").over(running))
        .join(F.broadcast(outside), ["column", "share"])
        .withColumn("last", F.col("below") + F.col("upto") - 1)
        .withColumn("first", F.col("last") - copies + 1)
    )

    def at(rank):
        return F.max(F.when((F.col("first") <= rank) & (rank <= F.col("last")), value))

    # a bracket holds the value at the rank's floor; the one after it may be the nearest value above the bracket
    high = F.coalesce(at(F.ceil("rank")), F.first("next"))
    return (
        ranked.groupBy("column", "share", "rank")
        .agg(at(F.floor("rank")).alias("v0"), high.alias("v1"))
        .select("column", "share", (F.expr("v0 + (v1 - v0) * (rank - floor(rank))")).alias("value"))
    )


def _profile_of(df: DataFrame, c: str, kind: T.DataType) -> DataFrame:
    """One row, from the distinct values of the column with their numbers of rows."""
    counted = df.groupBy(F.col(c).alias("value")).agg(F.count("*").alias("copies"))
    value, copies, given = F.col("value"), F.col("copies"), F.col("value").isNotNull()
    numeric = isinstance(kind, T.NumericType)
    number = value.cast("double") if numeric else F.lit(None).cast("double")
    length = F.char_length("value") if isinstance(kind, T.StringType) else F.lit(None).cast("int")
    dated = isinstance(kind, T.TimestampType | T.TimestampNTZType | T.DateType)
    day = F.date_format("value", "yyyy-MM-dd HH:mm:ss") if dated else F.lit(None).cast("string")
    rows = F.sum(F.when(given, copies))
    mean, spread = F.try_divide(F.sum(number * copies), rows), F.lit(None).cast("double")
    if numeric:
        counted = cut_lineage(counted)  # read for the mean and for the distances from it
        middle = counted.agg(mean).scalar()
        spread = F.sqrt(F.try_divide(F.sum(copies * (number - middle) * (number - middle)), rows - 1))
    return counted.agg(
        F.lit(c).alias("column"),
        F.lit(kind.simpleString()).alias("type"),
        F.coalesce(F.sum(copies), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.when(~given, copies)), F.lit(0)).alias("n_null"),
        F.count("value").alias("n_distinct"),
        F.min(length).cast("double").alias("shortest"),
        F.max(length).cast("double").alias("longest"),
        F.min(day).alias("earliest"),
        F.max(day).alias("latest"),
        mean.alias("mean"),
        spread.alias("sd"),
        F.min(number).alias("min"),
        F.max(number).alias("max"),
    )


def column_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Type, count, nulls, distinct values; for numbers mean, spread and quartiles, for texts the shortest and
    longest length, for dates the earliest and latest. One row per column.

    The columns are written once; each is then read alone and counted by value, since distinct counts of several columns in
    one pass would copy every row for each of them."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    numeric = [f.name for f in df.schema.fields if f.name in columns and isinstance(f.dataType, T.NumericType)]
    if len(columns) > 1:
        path = shared_folder(df.sparkSession, "profile")
        save_table(df.select(*columns), path)
        df = read_table(df.sparkSession, path)
    stacked = reduce(DataFrame.unionByName, [_profile_of(df, c, kinds[c]) for c in columns])
    if not numeric:
        return reduce(lambda d, p: d.withColumn(p, F.lit(None).cast("double")), ["p25", "p50", "p75"], stacked)
    quartiles = (
        exact_percentiles(df, numeric, QUARTILES)
        .groupBy("column")
        .agg(*[F.max(F.when(F.col("share") == s, F.col("value"))).alias(f"p{int(s * 100)}") for s in QUARTILES])
    )
    return stacked.join(F.broadcast(quartiles), "column", "left")
