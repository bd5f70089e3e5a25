"""Inputs of the queries as views over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.operators.baskets import make_baskets
from basketlens.operators.skew import TASK_ROWS, tasks_for
from basketlens.schema import RAW_RETAIL
from basketlens.session import shared_folder
from basketlens.sources.tables import read_table, save_text, trim_texts

# columns that put the sales lines in a fixed order, for keep-first
LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(spark, f"{folder}/{name}.parquet")


def retail_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Raw sales lines with all kinds of lines that cleaning removes, texts trimmed."""
    line = table(spark, folder, "lineitem")
    order = table(spark, folder, "orders")
    part = table(spark, folder, "part")
    customer = table(spark, folder, "customer")
    nation = table(spark, folder, "nation")
    joined = (
        line.join(order, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    )
    cancelled = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)
    stock = (
        F.when(F.col("l_partkey") % 97 == 0, "POST").when(F.col("l_partkey") % 89 == 0, "C2").otherwise(F.col("l_partkey").cast("string"))
    )
    text = (
        F.when(F.col("l_partkey") % 53 == 0, F.lit(None))
        .when(F.col("l_partkey") % 47 == 0, " damaged ")
        .otherwise(F.concat(F.lit(" "), "p_name", F.lit(" ")))
    )
    lines = joined.select(
        F.concat(F.when(cancelled, "C").otherwise(""), F.col("l_orderkey").cast("string")).alias("InvoiceNo"),
        stock.alias("StockCode"),
        text.alias("Description"),
        F.when(F.col("l_linenumber") == 7, -F.col("l_quantity")).otherwise(F.col("l_quantity")).cast("int").alias("Quantity"),
        F.expr("timestampadd(HOUR, CAST(o_orderkey % 24 AS INT), o_orderdate)").alias("InvoiceDate"),
        F.col("p_retailprice").alias("UnitPrice"),
        F.when(F.col("o_custkey") % 10 == 0, F.lit(None)).otherwise(F.col("o_custkey").cast("string")).alias("CustomerID"),
        F.col("n_name").alias("Country"),
        *LINE_ORDER,
    )
    return trim_texts(lines)


def retail_text(spark: SparkSession, folder: str) -> str:
    """Folder of the raw sales lines as text files, some with a quantity that is no number."""
    amount = F.col("Quantity").cast("string")
    lines = retail_raw(spark, folder).withColumn("Quantity", F.when(F.col("l_partkey") % 43 == 0, F.concat(amount, F.lit(" pcs"))).otherwise(amount))
    path = shared_folder(spark, "retail-text")
    save_text(lines.select(*RAW_RETAIL.names), path)
    return path


def part_baskets(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as baskets of parts: many items, each in few orders."""
    return make_baskets(table(spark, folder, "lineitem"), "l_orderkey", "l_partkey")


def name_baskets(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as baskets of part names: few items, each in many orders."""
    lines = table(spark, folder, "lineitem").join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return make_baskets(lines, "l_orderkey", "p_name")


def dated_baskets(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as baskets of part numbers as texts, with the year of the order."""
    line, order = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    # dealt once by order for the join and the distinct rows, to as many tasks as the lines need
    tasks = tasks_for(line.count(), TASK_ROWS, line)
    lines = line.repartition(tasks, "l_orderkey").join(order.repartition(tasks, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.select(
        F.col("l_orderkey").alias("order_id"), F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("item"), F.year("o_orderdate").alias("year")
    ).distinct()


def new_and_past(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The orders of the latest year as new baskets, each with a text that is no item; all earlier orders."""
    dated = dated_baskets(spark, folder)
    latest = F.broadcast(table(spark, folder, "orders").agg(F.year(F.max("o_orderdate")).alias("latest")))  # one row
    marked = dated.crossJoin(latest)
    new = marked.filter("year = latest").select(F.col("order_id").alias("basket_id"), F.explode(F.array("item", F.lit("(no such item)"))).alias("item"))
    return new.distinct(), marked.filter("year < latest").select("order_id", "item")


def part_ratings(spark: SparkSession, folder: str) -> DataFrame:
    """Customer x part ratings from 1 to 5, sparse."""
    lines = table(spark, folder, "lineitem").join(table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    rating = F.avg(1 + F.floor((F.col("l_quantity") - 1) / 10)).alias("rating")
    return lines.groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item")).agg(rating)


def event_ratings(spark: SparkSession, folder: str) -> DataFrame:
    """User x key ratings from 1 to 5 of the events, dense."""
    key = F.get_json_object("props", "$.k").cast("bigint").alias("item")
    rating = F.avg(F.least(F.lit(5), 1 + F.floor(F.col("value") / 25))).alias("rating")
    return table(spark, folder, "events").groupBy("user_id", key).agg(rating)
