import pytest
from pyspark.sql import functions as F

from basketlens.operators import blocks, cf, models, recommend, rules
from basketlens.session import cut_lineage, discard
from tests.test_blocks import joined, rating_rows, sorted_rows  # noqa: F401


@pytest.fixture
def waves(monkeypatch):
    """Small waves of small blocks; counts those that are sent."""
    sent = []
    monkeypatch.setattr(blocks, "BLOCK_PAIRS", 20)
    monkeypatch.setattr(blocks, "WAVE_ENTRIES", 1)
    monkeypatch.setattr(blocks, "WAVE_TIMES", 0)
    monkeypatch.setattr(blocks, "TASK_ROWS", 16)
    send = blocks._sent
    monkeypatch.setattr(blocks, "_sent", lambda *a: sent.append(a[3]) or send(*a))
    return sent


def baskets(spark):
    rows = [(o, f"i{(o * 5 + j * j) % 23}") for o in range(50) for j in range(o % 5 + 1)]
    return spark.createDataFrame([*sorted(set(rows)), (7, None)], "order_id int, item string")


def calls(spark):
    ratings, orders = rating_rows(spark), baskets(spark)
    asked = ratings.select("item").crossJoin(spark.createDataFrame([(3,), (11,), (99,), (None,)], "user_id int"))
    folded = orders.withColumn("fold", F.col("order_id") % 3)
    return {
        "cosine": lambda: cf.find_similarities(ratings.withColumn("v", F.col("rating")), entity="item", k=3).select("target", "neighbour", "sim"),
        "predictions": lambda: cf.predict_cf(ratings, None, entity="item", center=True, k=4),
        "requests": lambda: cf.predict_cf(ratings, asked, entity="user", center=True, k=4),
        "all orders": lambda: recommend.score_items_of_orders(orders, 2),
        "new baskets": lambda: recommend.recommend_unseen(orders.withColumnRenamed("order_id", "basket_id").filter("basket_id < 9"), orders.filter("order_id >= 9"), 2),
        "folds": lambda: models.user_based(folded, folded.withColumnRenamed("order_id", "basket_id"), 3, folds=3, k=4),
    }


@pytest.mark.parametrize("name", ["cosine", "predictions", "requests", "all orders", "new baskets", "folds"])
def test_waves_give_the_rows_of_the_join(spark, joined, waves, name):  # noqa: F811
    call = calls(spark)[name]
    found = sorted_rows(call())
    # a block is sent in one wave only, and all of them are not sent at once
    numbers = [set(w[w >= 0].tolist()) for w in waves]
    assert len(numbers) > 1 or name in ("requests", "new baskets")
    assert sum(map(len, numbers)) == len(set().union(*numbers))
    assert found == joined(call)


def test_a_block_with_too_many_entries_is_cut(spark, joined, monkeypatch):  # noqa: F811
    monkeypatch.setattr(blocks, "BLOCK_ENTRIES", 5)
    call = calls(spark)["predictions"]
    assert sorted_rows(call()) == joined(call)


def kept_files(spark):
    return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()


def test_a_written_table_leaves_no_shuffle_files(spark):
    rows = spark.range(1000).withColumn("k", F.col("id") % 7)
    before = kept_files(spark)
    table = cut_lineage(rows.repartition(3, "k").groupBy("k").agg(F.count("*").alias("n")).orderBy("n"))
    assert kept_files(spark) <= before
    assert table.count() == 7


def test_discarded_tables_are_gone(spark):
    table = cut_lineage(spark.range(10))
    file = table._jdf.queryExecution().analyzed().rdd().getCheckpointFile().get()
    path = spark._jvm.org.apache.hadoop.fs.Path(file)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    assert system.exists(path)
    discard(table)
    assert not system.exists(path)


def test_sums_of_near_items_in_waves(spark, waves, monkeypatch):
    orders = baskets(spark).withColumn("fold", F.col("order_id") % 3)
    given = orders.withColumnRenamed("order_id", "basket_id").filter("item is not null")
    given = given.unionByName(spark.createDataFrame([(None, "i1", 1), (None, "i4", 1), (60, "no such item", 2)], given.schema))

    def found():
        return sorted_rows(models.item_based(orders, given, 3, folds=3).select("basket_id", "item", "score", "rank"))

    want = found()
    assert not waves
    monkeypatch.setattr(models, "BROADCAST_ROWS", 0)
    assert found() == want
    assert len(waves) > 1


def test_rows_of_itemsets_are_not_written(spark, monkeypatch):
    written, gone = [], []
    for name, log in (("cut_lineage", written), ("discard", gone)):
        call = getattr(rules, name)
        monkeypatch.setattr(rules, name, lambda *a, call=call, log=log: log.extend(a) or call(*a))
    monkeypatch.setattr(rules, "MADE_ANEW", 100)
    orders = baskets(spark).filter("item is not null")
    found = sorted_rows(rules.mine_rules(orders, 0.02, 0.01))
    assert found
    assert not any("at" in t.columns for t in written)
    monkeypatch.setattr(rules, "MADE_ANEW", 1)
    assert sorted_rows(rules.mine_rules(orders, 0.02, 0.01)) == found
    rows = sum("at" in t.columns for t in written)
    assert rows and len(gone) == rows
