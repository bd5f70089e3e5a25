"""Named queries over the given tables. Each runs over the whole of them."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.functions.columns import pasted
from basketlens.operators import baskets as B
from basketlens.operators import cf, clean, evaluate, explore, models, profile, recommend, rules, stored
from basketlens.plans import views as V
from basketlens.schema import RAW_RETAIL
from basketlens.session import shared_folder
from basketlens.sources import tables

Query = Callable[[SparkSession, str], DataFrame]

NAME_HOT_ROWS = 500
RULE_SUPPORT = 0.003
RULE_CONFIDENCE = 0.01
PIVOT_ITEMS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
PROFILED = ["InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country"]
ASKED_USERS = [5, 10, 30]


def rounded(df: DataFrame, digits: int = 6, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n), digits) for n in names})


def clean_lines(spark: SparkSession, folder: str) -> DataFrame:
    return clean.clean_retail(V.retail_raw(spark, folder))


# cleaning ------------------------------------------------------------------------------------


def clean_retail(spark, folder):
    lines = clean_lines(spark, folder)
    return lines.withColumn("InvoiceDate", F.date_format("InvoiceDate", "yyyy-MM-dd HH:mm:ss")).withColumn("Date", F.col("Date").cast("string"))


def cleaning_counts(spark, folder):
    return clean.cleaning_counts(V.retail_raw(spark, folder))


def cancellation_count(spark, folder):
    return clean.cancellation_count(V.retail_raw(spark, folder))


def adjustment_audit(spark, folder):
    return clean.adjustment_audit(V.retail_raw(spark, folder))


def stockcode_audit(spark, folder):
    return clean.stockcode_audit(V.retail_raw(spark, folder))


def product_line_count(spark, folder):
    return profile.row_count(clean.product_lines(V.retail_raw(spark, folder)))


# reading and storing -------------------------------------------------------------------------


def text_lines(spark, folder):
    """Sales lines read from text files, saved as a table, read again."""
    path = shared_folder(spark, "retail-lines")
    tables.save_table(tables.read_raw_retail(spark, V.retail_text(spark, folder)), path)
    return tables.read_table(spark, path).withColumn("InvoiceDate", F.date_format("InvoiceDate", "yyyy-MM-dd HH:mm:ss"))


def text_line_report(spark, folder):
    return tables.line_report(tables.read_checked_text(spark, V.retail_text(spark, folder), RAW_RETAIL), "CustomerID")


def text_ratings(spark, folder):
    path = shared_folder(spark, "ratings-text")
    tables.save_text(V.part_ratings(spark, folder), path)
    return rounded(tables.read_ratings(spark, path, "csv"), 6, "rating")


# profiling -----------------------------------------------------------------------------------


def first_lines(spark, folder):
    raw = V.retail_raw(spark, folder)
    return profile.first_rows(raw.withColumn("InvoiceDate", F.date_format("InvoiceDate", "yyyy-MM-dd HH:mm:ss")), *V.LINE_ORDER)


def null_profile(spark, folder):
    return profile.null_counts(V.retail_raw(spark, folder), PROFILED)


def distinct_with_null(spark, folder):
    return profile.distinct_counts(V.retail_raw(spark, folder), ["InvoiceNo", "CustomerID"])


def column_profile(spark, folder):
    return rounded(
        profile.column_profile(V.retail_raw(spark, folder), PROFILED), 4, "mean", "sd", "min", "max", "p25", "p50", "p75"
    )


def customer_profile(spark, folder):
    return profile.column_profile(V.retail_raw(spark, folder), ["CustomerID"]).select("column", "n", "n_null")


# exploration ---------------------------------------------------------------------------------


def best_sellers_top10(spark, folder):
    return explore.best_sellers(clean_lines(spark, folder))


def item_share_top10(spark, folder):
    return rounded(explore.item_shares(clean_lines(spark, folder)), 6, "pct")


def lines_by_hour(spark, folder):
    return explore.lines_by_hour(clean_lines(spark, folder))


def lines_by_weekday(spark, folder):
    return explore.lines_by_weekday(clean_lines(spark, folder))


def units_by_country(spark, folder):
    return explore.units_by_country(clean_lines(spark, folder))


def avg_line_quantity(spark, folder):
    return rounded(explore.avg_line_quantity(clean_lines(spark, folder)), 6, "avg_line_quantity")


def avg_line_value(spark, folder):
    return rounded(explore.avg_line_value(clean_lines(spark, folder)), 4, "avg_line_value")


def line_quantity_histogram(spark, folder):
    means = explore.avg_line_quantity(clean_lines(spark, folder))
    return rounded(explore.histogram(means, "avg_line_quantity", 100_000), 6, "bin_from", "bin_to")


def basket_value_histogram(spark, folder):
    # values here start far above 100, so the whole range is viewed; rounding settles sums of doubles
    means = rounded(explore.avg_line_value(clean_lines(spark, folder)), 4, "avg_line_value")
    return rounded(explore.histogram(means, "avg_line_value", 200_000, (0.0, 1e9)), 8, "bin_from", "bin_to")


# baskets -------------------------------------------------------------------------------------


def dedupe_lines(spark, folder):
    first = B.dedupe_lines(clean_lines(spark, folder), ["InvoiceNo", "Description"], V.LINE_ORDER)
    return first.select("InvoiceNo", "Description", "Quantity", "UnitPrice", "l_linenumber", "l_partkey")


def retail_baskets(spark, folder):
    return B.make_baskets(clean_lines(spark, folder), "InvoiceNo", "Description")


def item_list(spark, folder):
    return B.item_list(clean_lines(spark, folder), "Description")


def basket_pivot(spark, folder):
    lines = V.table(spark, folder, "lineitem").join(V.table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return B.basket_table(B.make_baskets(lines, "l_orderkey", "p_type"), PIVOT_ITEMS)


def basket_cells(spark, folder):
    return B.nonzero_cells(basket_pivot(spark, folder), "order_id")


def invoice_keys(spark, folder):
    """One text per customer and invoice, a missing customer written out."""
    raw = V.retail_raw(spark, folder)
    return raw.select(pasted(F.col("CustomerID"), F.col("InvoiceNo")).alias("key")).groupBy("key").agg(F.count("*").alias("lines"))


def last_order_membership(spark, folder):
    """All items, marked by whether the order with the largest number holds them."""
    baskets = V.part_baskets(spark, folder)
    last = F.broadcast(baskets.agg(F.max("order_id").alias("order_id")))  # one row
    return B.membership(B.item_list(baskets), baskets.join(last, "order_id"))


def appended_orders(spark, folder):
    new, past = V.new_and_past(spark, folder)
    return B.append_order(new, past)


# basket recommendation -----------------------------------------------------------------------


def basket_recommend_all(spark, folder):
    scored = recommend.score_items_of_orders(V.part_baskets(spark, folder))
    return rounded(scored, 6, "score", "support_sim")


def basket_recommend_unseen(spark, folder):
    return rounded(recommend.recommend_unseen_of_orders(V.part_baskets(spark, folder)), 6, "support_sim")


def name_basket_recommend(spark, folder):
    """The same where few items are each in many orders, so that the search goes over sets of items."""
    found = recommend.recommend_unseen_of_orders(V.name_baskets(spark, folder), hot_rows=NAME_HOT_ROWS)
    return rounded(found, 6, "support_sim")


def new_basket_scores(spark, folder):
    new, past = V.new_and_past(spark, folder)
    return rounded(recommend.score_items(new, past), 6, "score", "support_sim")


def new_basket_recommend(spark, folder):
    new, past = V.new_and_past(spark, folder)
    return rounded(recommend.recommend_unseen(new, past), 6, "support_sim")


def stored_basket_recommend(spark, folder):
    """The same from past orders that were stored once, by item and by order."""
    new, past = V.new_and_past(spark, folder)
    orders = stored.store_orders(past, f"orders_{uuid4().hex}", shared_folder(spark, "orders"))
    return rounded(stored.recommend_unseen(new, orders), 6, "support_sim")


# similarities and predictions ----------------------------------------------------------------


def _plain(ratings: DataFrame) -> DataFrame:
    return ratings.withColumn("v", F.col("rating"))


def item_cosine(spark, folder):
    return rounded(cf.find_similarities(_plain(V.part_ratings(spark, folder)), entity="item", k=20), 6, "sim")


def user_cosine(spark, folder):
    return rounded(cf.find_similarities(_plain(V.part_ratings(spark, folder)), entity="user", k=20), 6, "sim")


def item_correlation(spark, folder):
    return rounded(cf.find_similarities(_plain(V.event_ratings(spark, folder)), entity="item", metric="correlation"), 6, "sim")


def item_products(spark, folder):
    cells = V.event_ratings(spark, folder).select(F.col("user_id").alias("row"), F.col("item").alias("col"), F.col("rating").alias("value"))
    return rounded(cf.sparse_product(cells, cells), 6, "value")


def item_jaccard(spark, folder):
    found = cf.find_similarities(_plain(V.part_ratings(spark, folder)), entity="item", metric="jaccard", k=20)
    return rounded(found, 6, "sim")


def center_ratings(spark, folder):
    return rounded(cf.center_ratings(V.part_ratings(spark, folder)), 6, "rating", "v")


def shifted_similarities(spark, folder):
    centered = cf.center_ratings(V.event_ratings(spark, folder))
    return rounded(cf.find_similarities(centered, entity="item", k=20, shift_positive=True), 6, "sim")


def ibcf_predict(spark, folder):
    found = cf.predict_cf(V.part_ratings(spark, folder), None, entity="item", center=True, k=300)
    return rounded(found, 4, "prediction")


def ibcf_correlation_predict(spark, folder):
    found = cf.predict_cf(
        V.event_ratings(spark, folder), None, entity="item", center=True, metric="correlation", k=20, shift_positive=True
    )
    return rounded(found, 4, "prediction")


def ubcf_predict(spark, folder):
    found = cf.predict_cf(V.part_ratings(spark, folder), None, entity="user", center=True, k=300)
    return rounded(found, 4, "prediction")


def _requested(entity: str) -> Query:
    """All items for a few users given by name, rated or not."""

    def run(spark, folder):
        ratings = V.part_ratings(spark, folder)
        asked = recommend.all_cells(ratings, ratings.filter(F.col("user_id").isin(ASKED_USERS)))
        return rounded(cf.predict_cf(ratings, asked, entity=entity, center=True, k=300), 4, "prediction")

    return run


def rating_cv_predictions(spark, folder):
    found = evaluate.cross_validated_predictions(V.part_ratings(spark, folder), 3, entity="item", center=True, k=300)
    return rounded(found, 4, "prediction", "rating")


def rating_cv_rmse(spark, folder):
    found = evaluate.cross_validated_predictions(V.event_ratings(spark, folder), 10, entity="item", center=True, k=300)
    return rounded(evaluate.rmse(found), 6, "rmse")


# top-N models --------------------------------------------------------------------------------


def rules_mined(spark, folder):
    found = rules.mine_rules(V.name_baskets(spark, folder), RULE_SUPPORT, RULE_CONFIDENCE)
    return rounded(found.withColumn("antecedent", F.array_join("antecedent", ",")), 6, "confidence", "lift", "support")


def _completed(model, digits: int = 6) -> Query:
    """Top 10 for every order with all of its items known."""

    def run(spark, folder):
        train = V.part_baskets(spark, folder)
        given = train.withColumnRenamed("order_id", "basket_id")
        return rounded(model(train, given, 10), digits, "score")

    return run


def rules_recommend(spark, folder):
    train = V.name_baskets(spark, folder)
    given = train.withColumnRenamed("order_id", "basket_id")
    return rounded(rules.by_rules(train, given, 10, support=RULE_SUPPORT, confidence=RULE_CONFIDENCE), 6, "score")


def _held_out(model) -> Query:
    """Top 10 for the remaining items of every order, by a model of the orders of other folds."""

    def run(spark, folder):
        scheme = evaluate.basket_scheme(V.part_baskets(spark, folder))
        return rounded(model(scheme.train, scheme.given, 10, scheme.folds), 6, "score")

    return run


def training_part_lists(spark, folder):
    """One list per test order of the first fold, by a model of the orders of all other folds."""
    scheme = evaluate.basket_scheme(V.part_baskets(spark, folder))
    given = scheme.given.filter("fold = 1").drop("fold")
    lists = models.as_lists(models.item_based(evaluate.training_part(scheme), given, 10))
    return lists.withColumn("items", F.array_join("items", ","))


# evaluation ----------------------------------------------------------------------------------

MODELS = {
    "association rules": partial(rules.by_rules, support=RULE_SUPPORT, confidence=RULE_CONFIDENCE),
    "random items": models.random_items,
    "popular items": models.popular,
    "item-based CF": models.item_based,
    "user-based CF": models.user_based,
}


def _confusions(spark, folder, names) -> DataFrame:
    scheme = evaluate.basket_scheme(V.name_baskets(spark, folder))
    return evaluate.model_confusions(scheme, {n: MODELS[n] for n in names})


def _confusion_of(name: str) -> Query:
    def run(spark, folder):
        numbers = _confusions(spark, folder, [name])
        return rounded(numbers, 6, "TP", "FP", "FN", "TN", "precision", "recall", "TPR", "FPR")

    return run


def _summary(spark, folder) -> DataFrame:
    return evaluate.mean_over_folds(_confusions(spark, folder, list(MODELS)))


def model_summary(spark, folder):
    return rounded(_summary(spark, folder), 6, "precision", "recall", "TPR", "FPR")


def roc_points(spark, folder):
    return rounded(evaluate.roc_points(_summary(spark, folder)), 6, "FPR", "TPR")


def pr_points(spark, folder):
    return rounded(evaluate.precision_recall_points(_summary(spark, folder)), 6, "recall", "precision")


def basket_folds(spark, folder):
    scheme = evaluate.basket_scheme(V.part_baskets(spark, folder))
    return scheme.held


QUERIES: dict[str, Query] = {
    "clean_retail": clean_retail,
    "cleaning_counts": cleaning_counts,
    "cancellation_count": cancellation_count,
    "adjustment_audit": adjustment_audit,
    "stockcode_audit": stockcode_audit,
    "product_line_count": product_line_count,
    "text_lines": text_lines,
    "text_line_report": text_line_report,
    "text_ratings": text_ratings,
    "first_lines": first_lines,
    "null_profile": null_profile,
    "distinct_with_null": distinct_with_null,
    "column_profile": column_profile,
    "customer_profile": customer_profile,
    "best_sellers_top10": best_sellers_top10,
    "item_share_top10": item_share_top10,
    "lines_by_hour": lines_by_hour,
    "lines_by_weekday": lines_by_weekday,
    "units_by_country": units_by_country,
    "avg_line_quantity": avg_line_quantity,
    "avg_line_value": avg_line_value,
    "line_quantity_histogram": line_quantity_histogram,
    "basket_value_histogram": basket_value_histogram,
    "dedupe_lines": dedupe_lines,
    "baskets": retail_baskets,
    "item_list": item_list,
    "basket_pivot": basket_pivot,
    "basket_cells": basket_cells,
    "invoice_keys": invoice_keys,
    "last_order_membership": last_order_membership,
    "appended_orders": appended_orders,
    "basket_recommend_all": basket_recommend_all,
    "basket_recommend_unseen": basket_recommend_unseen,
    "name_basket_recommend": name_basket_recommend,
    "new_basket_scores": new_basket_scores,
    "new_basket_recommend": new_basket_recommend,
    "stored_basket_recommend": stored_basket_recommend,
    "item_cosine": item_cosine,
    "item_jaccard": item_jaccard,
    "item_products": item_products,
    "item_correlation": item_correlation,
    "user_cosine": user_cosine,
    "center_ratings": center_ratings,
    "shifted_similarities": shifted_similarities,
    "ibcf_predict": ibcf_predict,
    "ibcf_correlation_predict": ibcf_correlation_predict,
    "ubcf_predict": ubcf_predict,
    "ibcf_requests": _requested("item"),
    "ubcf_requests": _requested("user"),
    "rating_cv_predictions": rating_cv_predictions,
    "rating_cv_rmse": rating_cv_rmse,
    "rules_mined": rules_mined,
    "rules_recommend": rules_recommend,
    "popular_topn": _completed(models.popular),
    "random_topn": _completed(models.random_items),
    "item_based_topn": _completed(models.item_based),
    "user_based_topn": _held_out(models.user_based),
    "basket_folds": basket_folds,
    "training_part_lists": training_part_lists,
    "model_confusion_rules": _confusion_of("association rules"),
    "model_confusion_random": _confusion_of("random items"),
    "model_confusion_popular": _confusion_of("popular items"),
    "model_confusion_item_based": _confusion_of("item-based CF"),
    "model_confusion_user_based": _confusion_of("user-based CF"),
    "model_summary": model_summary,
    "roc_points": roc_points,
    "pr_points": pr_points,
}
