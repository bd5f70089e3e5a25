"""The named queries and their SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from basketlens.plans import oracle, registry
from tests.compare import difference, open_sql

FOLDER = "/root/testdata/sf0.001"
CHECKED = [
    "clean_retail", "column_profile", "item_share_top10", "avg_line_value", "dedupe_lines", "basket_pivot",
    "basket_recommend_all", "item_cosine", "shifted_similarities", "ubcf_predict", "random_topn", "model_confusion_popular",
]


def test_every_query_has_sql():
    assert registry.QUERIES.keys() == oracle.SQL.keys()
    assert registry.QUERIES.keys() <= entry.queries().keys()


def test_entry_gives_unseen_items(spark):
    found = entry.entry(spark)
    assert found.columns == ["basket_id", "Recommendations", "support_sim"]
    assert found.count() > 0


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, name):
    want = open_sql(FOLDER).execute(entry.oracle_sql()[name]).df()
    assert difference(entry.queries()[name](spark, FOLDER).toPandas(), want) is None
