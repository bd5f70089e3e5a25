import pytest
from pyspark.sql import functions as F

from basketlens.operators import blocks, cf, evaluate, models, recommend, rules
from basketlens.session import cut_lineage


def rating_rows(spark):
    rows = [(u, f"i{(u * 7 + j * j) % 31}", float((u + j) % 5 + 1)) for u in range(40) for j in range(u % 6 + 2)]
    return spark.createDataFrame(sorted(set({(u, i): (u, i, r) for u, i, r in rows}.values())), "user_id int, item string, rating double")


def sorted_rows(df, *digits):
    return sorted((tuple(round(v, 8) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)


@pytest.fixture
def joined(monkeypatch):
    """Runs a call with the sliced join in place of blocks."""

    def run(call):
        with monkeypatch.context() as m:
            m.setattr(blocks, "TARGET_PAIRS", 0)
            return sorted_rows(call())

    return run


@pytest.mark.parametrize("metric", ["cosine", "jaccard"])
@pytest.mark.parametrize("entity", ["item", "user"])
def test_blocks_give_the_neighbours_of_the_join(spark, joined, metric, entity, monkeypatch):
    values = rating_rows(spark).withColumn("v", F.col("rating"))
    monkeypatch.setattr(blocks, "STEP_PAIRS", 7)

    def call():
        return cf.find_similarities(values, entity=entity, metric=metric, k=3).select("target", "neighbour", "sim")

    assert sorted_rows(call()) == joined(call)


@pytest.mark.parametrize("entity", ["item", "user"])
@pytest.mark.parametrize("asked", [False, True])
def test_blocks_give_the_predictions_of_the_join(spark, joined, entity, asked, monkeypatch):
    ratings = rating_rows(spark)
    cells = ratings.select("item").crossJoin(spark.createDataFrame([(3,), (11,), (99,)], "user_id int")) if asked else None
    monkeypatch.setattr(blocks, "STEP_PAIRS", 7)

    def call():
        return cf.predict_cf(ratings, cells, entity=entity, center=True, k=4)

    assert sorted_rows(call()) == joined(call)


def test_blocks_give_the_folds_of_the_join(spark, joined):
    ratings = rating_rows(spark)

    def call():
        return evaluate.cross_validated_predictions(ratings, 3, entity="item", center=True, k=4)

    assert sorted_rows(call()) == joined(call)



def test_no_pair_is_a_row_of_a_shuffle(spark):
    found = cf.find_similarities(rating_rows(spark).withColumn("v", F.col("rating")), entity="item", k=3)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "neighbour" not in plan.split("FlatMapGroupsInArrow", 1)[1].split("\n", 1)[1]


def test_blocks_give_the_items_of_the_nearest_orders(spark, joined, monkeypatch):
    rows = [(o, f"i{(o * 5 + j * j) % 23}") for o in range(50) for j in range(o % 5 + 1)]
    orders = spark.createDataFrame([*sorted(set(rows)), (7, None)], "order_id int, item string").withColumn("fold", F.col("order_id") % 3)
    given = orders.withColumnRenamed("order_id", "basket_id")
    monkeypatch.setattr(blocks, "STEP_PAIRS", 7)
    plain = orders.drop("fold")
    for call in (
        lambda: recommend.score_items_of_orders(plain, 2),
        lambda: recommend.recommend_unseen_of_orders(plain, 2),
        lambda: recommend.recommend_unseen(given.drop("fold").filter("basket_id < 9"), plain.filter("order_id >= 9"), 2),
        lambda: models.user_based(orders, given, 3, folds=3, k=4),
    ):
        assert sorted_rows(call()) == joined(call)


def test_rules_of_a_basket_stay_in_its_task(spark):
    rows = [(o, f"i{(o + j) % 6}") for o in range(30) for j in range(o % 2 + 1)]
    train = spark.createDataFrame(rows, "order_id int, item string")
    given = cut_lineage(train.withColumnRenamed("order_id", "basket_id"))
    found = rules.by_rules(train, given, 2, support=0.1)
    # a shuffle of the baskets and one of the rules: none of what the rules give
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert sum("Exchange hashpartitioning" in line for line in plan.split("\n")) == 2
