"""Cleaning operators on rows that separate the right reading from a near one."""

import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pixeltally.functions import cleaning as text
from pixeltally.operators import cleaning, reports, reshape


def values(df, *columns):
    return [tuple(row) if len(row) > 1 else row[0] for row in df.select(*columns).collect()]


def column(spark, items, kind="string"):
    return spark.createDataFrame([(i, x) for i, x in enumerate(items)], f"i int, v {kind}").orderBy("i")


@pytest.mark.parametrize(("written", "number"), [
    ("1.5", 1.5), (" 2 ", 2.0), ("1e3", 1000.0), (".5", 0.5), ("+7", 7.0), ("-3.", -3.0), ("inf", math.inf),
    ("-Infinity", -math.inf), ("1,000", None), ("0x10", None), ("1_000", None), ("1d", None), ("3f", None),
    ("true", None), ("tbd", None), ("", None), ("nan", None), (None, None),
])
def test_coerce_numeric(spark, written, number):
    df = column(spark, [written]).withColumnRenamed("v", "total_sales")
    assert values(cleaning.coerce_numeric(df), "total_sales") == [number]


def test_nan_becomes_null(spark):
    df = column(spark, [1.0, math.nan, None], "double").withColumnRenamed("v", "total_sales")
    assert values(cleaning.coerce_numeric(df), "total_sales") == [1.0, None, None]


def test_release_year(spark):
    dates = {
        "2008-11-21": 2008, "2008-1-5": 2008, "2008-01-05 10:00": 2008, "2008-11-21 00:00:00": 2008, "2008-11-21T00:00:00": 2008,
        "2008-11-21T10:11:12.345Z": 2008, "9999-01-01": 9999, "1600-01-01": 1600,
        "11/21/2009": None, "2010": None, "bad": None, "2008-02-30": None, None: None}
    df = column(spark, list(dates)).withColumnRenamed("v", "release_date")
    assert values(cleaning.add_release_year(df).orderBy("i"), "release_year") == list(dates.values())
    given = cleaning.add_release_year(df, ["MM/dd/yyyy", "yyyy"]).filter("release_year IS NOT NULL").orderBy("i")
    assert values(given, "release_date", "release_year") == [("11/21/2009", 2009), ("2010", 2010)]


def test_na_tokens(spark):
    df = column(spark, ["", "NA", "N/A", "null", "NULL", "None", "nan", "<NA>", " n/a", "-", "x"])
    assert values(cleaning.nullify_na_tokens(df), "v") == [None] * 8 + [" n/a", "-", "x"]


def test_normalized_names(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], [" Na Sales ", "Total-Sales(M)", "Édition", "a  b"])
    assert cleaning.normalize_columns(df).columns == ["na_sales", "total_sales_m_", "édition", "a__b"]


def test_names_that_collide(spark):
    with pytest.raises(ValueError, match="na_sales"):
        cleaning.normalize_columns(spark.createDataFrame([(1, 2)], ["NA Sales", "na_sales"]))


def test_keep_first_takes_nulls_as_equal(spark):
    rows = [("a", None, 1), ("a", None, 2), ("a", "x", 3), (None, None, 4), (None, None, 5)]
    df = spark.createDataFrame(rows, "title string, release_date string, n int")
    assert sorted(values(cleaning.keep_first(df, ["title", "release_date"], ["n"]), "n")) == [1, 3, 4]


def test_keep_first_of_a_hot_key(spark):
    df = spark.range(0, 30000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("title"), "id")
    kept = cleaning.keep_first(df, ["title"], ["id"])
    assert kept.count() == 20001
    assert values(kept.filter("title = 'hot'"), "id") == [0]


def test_platform_is_chosen_by_column(spark):
    df = spark.createDataFrame([("x", "p"), (None, "q")], "console string, platform string")
    assert values(cleaning.fill_defaults(df), "platform", "genre") == [("x", "Unknown"), ("Unknown", "Unknown")]
    assert values(cleaning.fill_defaults(df.drop("console")), "platform") == ["p", "q"]
    assert values(cleaning.fill_defaults(df.select(F.lit(1).alias("n"))), "platform") == ["Unknown", "Unknown"]


def test_positive(spark):
    df = column(spark, [1.0, 0.0, -1.0, None, math.nan], "double")
    assert values(df.filter(cleaning.positive("v")), "v") == [1.0]


@pytest.mark.parametrize(("title", "cleaned"), [
    ("Pokémon (2000) Red/Blue", "Pokmon RedBlue"), ("\tFoo: Bar (x", "Foo Bar x"), ("x (a(b)c) y", "xc y"),
    ("(all)", ""), (" a b ", "a b"), ("a\n", "a"), (None, None),
])
def test_clean_title(spark, title, cleaned):
    assert values(column(spark, [title]).select(text.clean_title(F.col("v")).alias("t")), "t") == [cleaned]


def test_round4_is_exact(spark):
    """Python's rounding, also where the decimal text ends in a tie that the binary value misses."""
    random.seed(4)
    ties = [5e-05, 0.00015, 0.00025] + [(random.randrange(10**8) * 10 + 5) / 100000 for _ in range(3000)]
    beside = [math.nextafter(x, to) for x in ties for to in (0.0, math.inf)]
    exact_ties = [random.randrange(2**24) / 32 for _ in range(2000)]
    others = [random.uniform(0, 1e6) for _ in range(2000)] + [0.0, 1e9, 1e15, 123456789.00005]
    # Every size on both sides of a tie, up to where a double has no fourth place.
    sizes = [10.0 ** k for k in range(-5, 16)] + [2.0 ** k for k in range(25, 45)]
    others += [x + t for x in sizes for t in (0.00005, 0.00015, 0.0003, 0.5, 0.00025)] + [1e9 + 0.00005, 2e9 + 0.00015, 1e15 + 0.25]
    others += [random.uniform(1, 10) * x for x in sizes for _ in range(50)]
    others += [math.nextafter(x, to) for x in sizes for to in (0.0, math.inf)] + [2.0 ** k + m / 2 ** 14 for k in range(25, 39) for m in (1, 3, 5, 7)]
    numbers = ties + beside + exact_ties + others
    numbers += [-x for x in numbers]
    df = spark.createDataFrame(pd.DataFrame({"v": numbers}))
    assert [(v, r) for v, r in values(df.select("v", text.round4(F.col("v")).alias("r")), "v", "r") if r != round(v, 4)] == []


def test_group_sums_without_null_keys(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1.0), (None, 5.0)], "k string, total_sales double")
    assert sorted(values(reports.totals_by(df, "k"), "k", "total_sales")) == [("a", 0.0), ("b", 1.0)]


def test_match_rate_of_nothing(spark):
    df = spark.createDataFrame([], "data_source string")
    assert values(reports.match_rate(df), "total", "matched", "match_rate_pct") == [(0, 0, None)]


def test_whole_titles_are_compared(spark):
    rows = [("x" * 300 + "a", 1), ("x" * 300 + "b", 2), (None, 3)]
    df = spark.createDataFrame(rows, "title string, n int")
    clean = cleaning.clean_for_warehouse(df, ["n"])
    assert sorted(values(clean, "title", "n")) == rows[:2]
    assert values(cleaning.truncate_texts(clean, {"title": 300, "no": 1}), "title") == ["x" * 300] * 2


def test_years_outside_the_range_are_left_out_on_request_only(spark):
    rows = [(f"{year}-05-05", 1.0) for year in (1979, 1980, 2000, 2020, 2021)]
    df = spark.createDataFrame(rows, "release_date string, total_sales double")
    assert sorted(values(reports.yearly_totals(df, 1980, 2020), "release_year")) == [1980, 2000, 2020]
    assert sorted(values(reports.yearly_totals(df, 1, 9999), "release_year")) == [1979, 1980, 2000, 2020, 2021]


def test_summary(spark):
    rows = [("a", "P", "G", "C", 2000), ("a", "Q", "G", None, 2001), (None, "P", None, "C", None), ("b", "P", "G", "D", 1999)]
    df = spark.createDataFrame(rows, "title string, platform string, genre string, continent string, release_year int")
    assert reports.dataset_summary(df).collect() == [(4, 2, 2, 1, 2, 1999, 2001)]
    assert reports.dataset_summary(df.limit(0)).collect() == [(0, 0, 0, 0, 0, None, None)]


def test_clean_sales(spark):
    rows = [("a", "PS5", "1.5", "2001-01-01", 1), ("a", "PC", "9", "2001-01-01", 2), ("a", None, "tbd", None, 3), (None, "PC", "1", None, 4)]
    df = spark.createDataFrame(rows, ["Title", "Console", "NA Sales", "Release Date", "n"])
    clean = cleaning.clean_sales(df, ["n"]).orderBy("n")
    assert values(clean, "title", "platform", "genre", "na_sales", "release_year") == [
        ("a", "PS5", "Unknown", 1.5, 2001), ("a", "Unknown", "Unknown", None, None)]


def test_unpivot_keeps_the_sum_and_skips_absent_columns(spark):
    rows = [("a", 1.25, -1.0, None), ("b", 0.0, 2.5, math.nan), ("c", 4.00005, None, 3.0)]
    df = spark.createDataFrame(rows, "title string, na_sales double, pal_sales double, jp_sales double")
    long = reshape.unpivot_sales(df)
    assert long.columns == ["title", "region_code", "region_label", "continent", "sales_millions"]
    assert sorted(values(long, "title", "region_code", "continent", "sales_millions")) == [
        ("a", "NA", "Americas", 1.25), ("b", "EU", "Europe", 2.5), ("c", "JP", "Asia", 3.0), ("c", "NA", "Americas", round(4.00005, 4))]


def test_shares_add_up(spark):
    df = spark.createDataFrame([(1.0, 2.0, None, 4.0)], "na_sales double, pal_sales double, jp_sales double, other_sales double")
    share = reshape.region_share(df)
    assert sum(values(share, "share_pct")) == pytest.approx(100)
    assert dict(values(share, "sales_column", "total_sales_m"))["jp_sales"] == 0.0
