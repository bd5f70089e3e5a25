from datetime import datetime

import pytest
from pyspark.sql import functions as F

from basketlens.fixed_values import ADJUSTMENT_DESCRIPTIONS, NON_PRODUCT_CODES, SAMPLE_ORDER
from basketlens.functions import columns as C
from basketlens.operators import baskets, clean, explore, profile
from basketlens.schema import RAW_RETAIL
from basketlens.sources import tables

NOON = datetime(2011, 3, 7, 12, 34, 56)  # a Monday


def line(invoice="1", stock="A", text="cup", quantity=1, price=2.0, customer="9", country="UK", at=NOON):
    return (invoice, stock, text, quantity, at, price, customer, country)


@pytest.fixture(scope="module")
def dirty(spark):
    rows = [
        line("C1"), line("1C"), line("A5"), line(None), line("7", quantity=-1), line("8", quantity=0, text="damaged"),
        line("9", stock="C2"), line("10", stock="XC2Y"), line("11", stock=None), line("12", text=" Found by jackie "),
        line("13", text=None), line("14", text="   "), line("15", text="damaged"), line("16", text="  cup\t"),
    ]
    rows += [line(f"s{i}", stock=c) for i, c in enumerate(NON_PRODUCT_CODES)] + [line(f"d{i}", text=d) for i, d in enumerate(ADJUSTMENT_DESCRIPTIONS)]
    return tables.trim_texts(spark.createDataFrame(rows, RAW_RETAIL)).cache()


def test_clean_keeps_missing_keys_and_drops_listed_values(dirty):
    kept = clean.clean_retail(dirty).collect()
    numbers = sorted((r.InvoiceNo is None, r.InvoiceNo or 0, r.Description) for r in kept)
    # A5 and the missing number have no number; the list entry with a trailing blank matches nothing
    # after trimming, so d15 stays too
    assert numbers == [
        (False, 11.0, "cup"), (False, 12.0, "Found by jackie"), (False, 16.0, "cup"),
        (True, 0, "Found by jackie"), (True, 0, "cup"), (True, 0, "cup"),
    ]
    assert {r.Time for r in kept} == {"12:34:56"} and {str(r.Date) for r in kept} == {"2011-03-07"}


def test_audits(dirty):
    assert clean.cancellation_count(dirty).first().Total == 2
    found = {(r.Description, r["count"]) for r in clean.adjustment_audit(dirty).collect()}
    assert found == {("cup", 1), ("damaged", 1)}
    codes = {r.StockCode for r in clean.stockcode_audit(dirty).collect()}
    assert codes == set(NON_PRODUCT_CODES) | {"XC2Y"}


def test_fixed_lists():
    assert len(ADJUSTMENT_DESCRIPTIONS) == 54 and len(set(ADJUSTMENT_DESCRIPTIONS)) == 52
    assert len(NON_PRODUCT_CODES) == 9 and len(SAMPLE_ORDER) == 5


def test_csv_and_parquet_round_trip(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(",".join(RAW_RETAIL.names) + "\n1,A,  tea cup ,2,2011-03-07 12:34:56,1.5,,UK\n")
    raw = tables.read_raw_retail(spark, str(path))
    row = raw.first()
    assert (row.Description, row.Quantity, row.CustomerID) == ("tea cup", 2, None)
    tables.save_table(raw, str(tmp_path / "t"))
    assert tables.read_table(spark, str(tmp_path / "t")).first() == row
    assert tables.read_raw_retail(spark, str(tmp_path / "t"), "parquet").first() == row


def test_profile_views(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b"), (4, None)], "x int, y string")
    assert {r["column"]: r.n_null for r in profile.null_counts(df, ["x", "y"]).collect()} == {"x": 0, "y": 2}
    assert {r["column"]: r.n_distinct for r in profile.distinct_counts(df, ["x", "y"]).collect()} == {"x": 4, "y": 3}
    assert [(r.column, r.type) for r in profile.schema_view(df).collect()] == [("x", "int"), ("y", "string")]
    assert [r.x for r in profile.first_rows(df, "x", n=2).collect()] == [1, 2]
    assert profile.row_count(df).first().n_rows == 4
    rows = {r["column"]: r for r in profile.column_profile(df, ["x", "y"]).collect()}
    assert (rows["x"].mean, rows["x"].p25, rows["x"].p50, rows["x"].p75) == (2.5, 1.75, 2.5, 3.25)
    assert (rows["y"].n, rows["y"].n_null, rows["y"].p50) == (4, 2, None)


@pytest.mark.parametrize("most_values", [2, 10, 300])
def test_percentiles_are_the_same_when_brackets_are_narrowed(spark, most_values):
    rows = spark.range(5000).select(
        F.col("id").cast("double").alias("a"),
        F.pmod(F.xxhash64("id"), F.lit(700)).alias("b"),  # about seven rows a value
        F.when(F.col("id") % 3 != 0, F.lit(4.5)).otherwise(F.col("id")).alias("c"),  # two thirds are one value
        F.lit(None).cast("double").alias("d"),
    )
    shares = [0.0, 0.001, 0.25, 0.5, 0.7, 1.0]
    found = {(r["column"], r.share): r.value for r in profile.exact_percentiles(rows, ["a", "b", "c", "d"], shares, most_values).collect()}
    assert len(found) == 3 * len(shares)
    for c in "abc":
        want = rows.agg(F.percentile(c, F.array(*map(F.lit, shares)))).first()[0]
        assert [found[c, s] for s in shares] == pytest.approx(want)


def test_narrowed_brackets_hold_their_rank_and_fewer_values(spark):
    counted = spark.range(100_000).select(F.lit("a").alias("column"), F.col("id").cast("double").alias("value"), F.lit(2).alias("copies"))
    [(column, share, rank, low, high, values)] = profile._narrowed(counted, [("a", 0.3, 59_999.7, 0.0, 99_999.0, 100_000)])
    assert (column, share, rank) == ("a", 0.3, 59_999.7)
    assert low <= 29_999 <= high and values == high - low + 1 and values < 2 * 100_000 / profile.PARTS


@pytest.mark.parametrize("n", [1, 2, 3, 7, 500])
def test_exact_percentiles_equal_the_builtin(spark, n):
    df = spark.range(n).select(F.pmod(F.xxhash64("id"), F.lit(40)).cast("double").alias("a"), (F.col("id") * F.col("id")).cast("double").alias("b"))
    shares = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    found = {(r["column"], r.share): r.value for r in profile.exact_percentiles(df, ["a", "b"], shares).collect()}
    for c in ("a", "b"):
        want = df.agg(F.percentile(c, F.array(*map(F.lit, shares)))).first()[0]
        assert [found[c, s] for s in shares] == pytest.approx(want)


def test_top_keeps_ties_and_shares_are_of_all_lines(spark):
    sizes = [20, 19, 18, 17, 16, 15, 14, 13, 12, 5, 5, 5, 4]
    lines = spark.createDataFrame([(f"i{i:02d}",) for i, s in enumerate(sizes) for _ in range(s)], "Description string")
    top = explore.best_sellers(lines).collect()
    assert [r["count"] for r in top] == sizes[:12]
    shares = explore.item_shares(lines).collect()
    assert len(shares) == 12 and shares[0].pct == pytest.approx(20 / sum(sizes) * 100)


def test_times_and_means(spark):
    rows = [("1", 2, 3.0, "2011-03-07", "09:10:11"), ("1", 4, 1.0, "2011-03-07", "09:59:00"), ("2", 1, None, "2011-03-13", "23:00:00")]
    df = spark.createDataFrame(rows, "InvoiceNo string, Quantity int, UnitPrice double, d string, Time string").withColumn("Date", F.to_date("d"))
    assert {(r.hour, r["count"]) for r in explore.lines_by_hour(df).collect()} == {(9, 2), (23, 1)}
    assert {(r.weekday, r.label, r["count"]) for r in explore.lines_by_weekday(df).collect()} == {(1, "Mon", 2), (7, "Sun", 1)}
    assert {(r.InvoiceNo, r.avg_line_quantity) for r in explore.avg_line_quantity(df).collect()} == {("1", 3.0), ("2", 1.0)}
    assert {(r.InvoiceNo, r.avg_line_value) for r in explore.avg_line_value(df).collect()} == {("1", 5.0), ("2", None)}


def test_histogram(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (9.9,), (10.0,), (None,)], "x double")
    bins = {(r.bin, r["count"]) for r in explore.histogram(df, "x", 10).collect()}
    assert bins == {(0, 1), (1, 1), (9, 2)}
    flat = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert [(r.bin, r["count"]) for r in explore.histogram(flat, "x", 10).collect()] == [(9, 2)]
    assert explore.histogram(df, "x", 10, (100.0, 200.0)).count() == 0


def test_scalar_columns(spark):
    row = spark.range(1).select(
        C.pasted(F.lit(1), F.lit(None), F.lit("x")).alias("p"),
        C.clamp(F.lit(7.0), 1.0, 5.0).alias("hi"),
        C.clamp(F.lit(-1.0), 1.0, 5.0).alias("lo"),
        C.nonzero(F.lit(0.0)).alias("z"),
        C.is_rated(F.lit(0.0)).alias("m0"),
        C.is_rated(F.lit(2.0)).alias("m1"),
        C.stable(F.lit(0.1) + F.lit(0.2)).alias("s"),
    )
    assert row.first().asDict() == {"p": "1 NA x", "hi": 5.0, "lo": 1.0, "z": 1e-6, "m0": 0.0, "m1": 1.0, "s": 0.3}


def test_keep_first_line(spark):
    rows = [("1", "a", 5, 1), ("1", "a", 7, 2), (None, "a", 1, 3), (None, "a", 2, 4)]
    df = spark.createDataFrame(rows, "InvoiceNo string, Description string, Quantity int, n int")
    kept = baskets.dedupe_lines(df, ["InvoiceNo", "Description"], ["n"])
    assert {(r.InvoiceNo, r.Quantity) for r in kept.collect()} == {("1", 5), (None, 1)}


def test_basket_shapes(spark):
    b = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b")], "order_id long, item string")
    wide = baskets.basket_table(b, ["a", "b"])
    assert {tuple(r) for r in wide.collect()} == {(1, 1, 1), (2, 0, 1)}
    assert {tuple(r) for r in baskets.nonzero_cells(wide, "order_id").collect()} == {tuple(r) for r in b.collect()}
    order = spark.createDataFrame([(0, "b"), (0, "zz")], "basket_id long, item string")
    items = baskets.item_list(b)
    assert {tuple(r) for r in baskets.membership(items, order).collect()} == {("a", 0.0), ("b", 1.0)}
    assert baskets.append_order(order, b).count() == 5
    many = spark.range(300).select(F.col("id").alias("item"))
    numbers = sorted(r.number for r in baskets.numbered_items(many, 1, 16).collect())
    assert numbers == list(range(300))


def test_numbers_written_as_plain_decimals_only(spark):
    texts = ["12D", "12F", "12d", "1e5", "-3", ".5", "5.", "+2.5E-1", "1e", "", " 7 ", "NaN", "Infinity", "0x1A", "1_000", None]
    got = [r.v for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(C.plain_number(F.col("t")).alias("v")).collect()]
    assert got == [None, None, None, 1e5, -3.0, 0.5, 5.0, 0.25, None, None, 7.0, None, None, None, None, None]


def test_profile_of_every_kind_of_column(dirty):
    rows = {r["column"]: r for r in profile.column_profile(dirty, ["Description", "Quantity", "InvoiceDate"]).collect()}
    assert rows["InvoiceDate"]["earliest"] == rows["InvoiceDate"]["latest"] == "2011-03-07 12:34:56"
    assert rows["Description"]["type"] == "string" and rows["Description"]["shortest"] == 1 and rows["Description"]["mean"] is None
    assert rows["Quantity"]["n_distinct"] == 3 and rows["Quantity"]["longest"] is None
