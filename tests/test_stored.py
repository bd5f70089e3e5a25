"""Text files, counts along the cleaning, and stored past orders."""

import random
from datetime import datetime
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from basketlens.operators import clean, evaluate, recommend, stored
from basketlens.schema import RATINGS, RAW_RETAIL
from basketlens.sources import tables

HEADER = ",".join(RAW_RETAIL.names)


def write_text(folder, *lines):
    (folder / "lines.csv").write_text("\n".join(lines) + "\n")
    return str(folder)


def test_broken_lines_are_kept_apart(spark, tmp_path):
    broken = ["2,B,tea,many,2011-03-07 10:00:00,1.0,9,UK", "3,C,tea", "4,D,tea,1,2011-03-07 10:00:00,1.0,9,UK,more", "5,E,tea,1,soon,1.0,9,UK"]
    path = write_text(
        tmp_path, HEADER, '1,A,"  cup, ""blue""  ",6,2011-03-07 12:34:56,2.5,9,UK', *broken, "6,F,,1,2011-03-07 10:00:00,1.0,,UK"
    )
    checked = tables.read_checked_text(spark, path, RAW_RETAIL)
    assert sorted(r[tables.BROKEN] for r in checked.filter(F.col(tables.BROKEN).isNotNull()).collect()) == broken
    assert tables.line_report(checked, "CustomerID").first().asDict() == {"lines": 6, "broken_lines": 4, "without_key": 1}
    kept = sorted(map(tuple, tables.read_raw_retail(spark, path).collect()))
    assert kept == [
        ("1", "A", 'cup, "blue"', 6, datetime(2011, 3, 7, 12, 34, 56), 2.5, "9", "UK"),
        ("6", "F", None, 1, datetime(2011, 3, 7, 10), 1.0, None, "UK"),
    ]


def test_text_and_back(spark, tmp_path):
    rows = [("1", "A", 'say "hi", \\ you', 1, NOON, 0.1, None, "UK"), (None, None, None, None, None, None, None, "UK")]
    tables.save_text(spark.createDataFrame(rows, RAW_RETAIL), str(tmp_path / "text"))
    checked = tables.read_checked_text(spark, str(tmp_path / "text"), RAW_RETAIL)
    assert sorted(map(repr, map(tuple, tables.good_lines(checked).collect()))) == sorted(map(repr, rows))
    assert tables.line_report(checked.limit(0), "CustomerID").first().lines == 0


NOON = datetime(2011, 3, 7, 12, 34, 56)


def test_ratings_of_text(spark, tmp_path):
    path = write_text(tmp_path, "user_id,item,rating", "1,2,3.5", "1,x,3.5", "2,2,")
    assert sorted(map(tuple, tables.read_ratings(spark, path, "csv").collect())) == [(1, 2, 3.5), (2, 2, None)]
    spark.createDataFrame([(1, 2, 3.5)], RATINGS).write.parquet(str(tmp_path / "table"))
    assert tables.read_ratings(spark, str(tmp_path / "table")).collect() == [(1, 2, 3.5)]


def test_counts_are_those_of_the_steps(spark):
    rows = [
        ("1", "A", "cup", 1), ("C1", "A", "cup", 1), (None, "A", "cup", -1), ("2", "POST", "cup", 1), ("3", None, "damaged", 1),
        ("4", "A", None, 1), ("5", "A", "cup", None), ("6", "A", "cup", 3),
    ]
    raw = spark.createDataFrame(rows, "InvoiceNo string, StockCode string, Description string, Quantity int")
    steps = [raw, clean.without_cancellations(raw), clean.sold_lines(raw), clean.product_lines(raw)]
    steps.append(clean.without_adjustments(steps[-1]))
    steps.append(clean.with_description(steps[-1]))
    counted = clean.cleaning_counts(raw).orderBy("step").collect()
    assert [r.lines for r in counted] == [s.count() for s in steps]
    assert [r.lines for r in clean.cleaning_counts(raw.limit(0)).collect()] == [0] * 6


@pytest.fixture(scope="module")
def orders(spark):
    draw = random.Random(3)
    # the first item is in every second order
    rows = {(o, f"i{draw.randrange(1, 30)}") for o in range(80) for _ in range(draw.randrange(1, 6))} | {(o, "i0") for o in range(0, 80, 2)}
    new = {(b, f"i{draw.randrange(0, 34)}") for b in range(1000, 1020) for _ in range(4)} | {(2000, "unknown")}
    return spark.createDataFrame(sorted(new), "basket_id long, item string"), spark.createDataFrame(sorted(rows), "order_id long, item string")


@pytest.mark.parametrize("slice_rows", [1000, 7])
def test_stored_orders_answer_as_the_table_does(spark, orders, tmp_path, slice_rows):
    new, past = orders
    name = f"orders_{uuid4().hex}"
    stored.store_orders(past, name, str(tmp_path), buckets=4, slice_rows=slice_rows)
    kept = stored.open_orders(spark, name)
    assert kept.items.agg(F.max("slices")).first()[0] == -(-40 // slice_rows)
    want = sorted(map(tuple, recommend.recommend_unseen(new, past).collect()))
    assert sorted(map(tuple, stored.recommend_unseen(new, kept).collect())) == want and want
    assert stored.recommend_unseen(new.limit(0), kept).count() == 0


def plan_above_scans(df):
    """Steps of the plan, from each scan of a bucketed table up to the first join."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = [len(x) - len(x.lstrip(" :+-*()0123456789")) for x in lines]
    for at, text in enumerate(lines):
        if "Bucketed: true" in text:
            above, level = [], depth[at]
            for i in range(at - 1, -1, -1):
                if depth[i] < level:
                    level = depth[i]
                    above.append(lines[i])
                    if "Join" in lines[i]:
                        break
            yield above


def test_stored_side_is_not_shuffled(spark, orders, tmp_path):
    new, past = orders
    kept = stored.store_orders(past, f"orders_{uuid4().hex}", str(tmp_path))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (stored.nearest_orders(new, kept, 3), stored.score_items(new, kept)):
            found = list(plan_above_scans(df))
            assert found
            for above in found:
                assert "Join" in above[-1] and not any("Exchange" in step for step in above)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("entity", ["item", "user"])
@pytest.mark.parametrize("center", [True, False])
def test_folds_as_arrays_give_the_rows_of_folds_as_keys(spark, entity, center):
    draw = random.Random(5)
    rows = [(u, i, float(draw.randrange(1, 6))) for u in range(14) for i in range(12) if draw.random() < 0.5]
    rows += [(90, i, 3.0) for i in range(4)] + [(91, 1, 4.0), (92, 70, 2.0), (1, 99, 0.0)]
    ratings = spark.createDataFrame(rows, RATINGS)
    for k in (None, 3):
        plain, keyed = (
            {(r.fold, r.user_id, r.item): (r.prediction, r.rating) for r in found.collect()}
            for found in (
                evaluate.cross_validated_predictions(ratings, 4, entity=entity, center=center, k=k, hot_rows=hot)
                for hot in (1000, 1)
            )
        )
        assert plain.keys() == keyed.keys() and plain
        for key, (value, rating) in plain.items():
            assert value == pytest.approx(keyed[key][0], abs=1e-7) and rating == keyed[key][1]
    none = evaluate.cross_validated_predictions(ratings.limit(0), 4, entity=entity, center=center, k=3)
    assert none.count() == 0
