"""Lists, pairs and counts that are made in the row of a basket or order, and tasks by counted rows."""

import pytest
from pyspark.sql import functions as F

from basketlens.operators import evaluate, models, profile, rules, skew, stored


@pytest.fixture(scope="module")
def orders(spark):
    return spark.createDataFrame([(o, f"i{(o + s) % 7}") for o in range(40) for s in range(1 + o % 4)], "order_id long, item string")


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("model", [models.popular, models.random_items])
def test_lists_need_no_window_and_no_join_with_the_basket(spark, orders, model):
    lists = model(orders, orders.withColumnRenamed("order_id", "basket_id"), 3)
    assert "Window" not in plan(lists).split("Join")[0] and "LeftAnti" not in plan(lists)


def test_held_items_are_drawn_in_the_row_of_the_order(spark, orders):
    scheme = evaluate.basket_scheme(orders)
    assert not any("Join" in plan(t) for t in (scheme.train, scheme.given, scheme.held))


@pytest.mark.parametrize("folds", [1, 3])
def test_item_pairs_are_not_joined(spark, orders, monkeypatch, folds):
    monkeypatch.setattr(models, "join_in_slices", None)
    train = orders.withColumn("fold", (F.col("order_id") % folds).cast("int") + (1 if folds > 1 else 0))
    found = {(r.fold, r["item"], r.neighbour): r.sim for r in models.nearest_items(train, 2, folds).collect()}
    rows = train.collect()
    for (fold, a, b), sim in found.items():
        x, y = ({r.order_id for r in rows if r["item"] == i and r.fold != fold} for i in (a, b))
        assert sim == len(x & y) / len(x | y)
    assert len(found) >= 7 * 2 * folds - folds


def test_equal_orders_are_mined_as_one_set(spark, orders):
    train = orders.withColumn("fold", F.lit(0))
    sets = rules.transaction_sets(train, 1, 0.01)
    distinct = {frozenset(f"i{(o + s) % 7}" for s in range(1 + o % 4)) for o in range(40)}
    assert sets.count() == len(distinct) < 40 and sets.agg(F.sum("n")).first()[0] == 40


def test_a_profile_does_not_copy_rows_per_column(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (4, "bcd")], "x int, t string")
    found = profile.column_profile(df, ["x", "t"])
    assert "Expand" not in plan(found)
    by = {r["column"]: r for r in found.collect()}
    assert (by["x"].n, by["x"].n_distinct, by["x"].mean, by["x"].p50) == (3, 2, 2.0, 1.0) and abs(by["x"].sd - 3**0.5) < 1e-12
    assert (by["t"].n_null, by["t"].n_distinct, by["t"].shortest, by["t"].longest) == (1, 2, 1.0, 3.0)


def test_tasks_follow_the_counted_rows(spark, orders, monkeypatch, tmp_path):
    assert skew.tasks_for(10_000_000, 500_000, orders) == 21
    monkeypatch.setattr(stored, "TASK_PAIRS", 10)
    kept = stored.store_orders(orders, "counted_orders", str(tmp_path / "o"), buckets=2)
    near = stored.nearest_orders(orders.withColumnRenamed("order_id", "basket_id"), kept, 2)
    assert "RepartitionByExpression [basket_id" in plan(near)
    assert "n" in kept.items.columns
