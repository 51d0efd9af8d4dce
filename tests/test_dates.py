"""The form of a column's dates."""

import pytest
from pyspark.sql import functions as F

from pixeltally.functions.cleaning import DATE_SHAPES
from pixeltally.operators import cleaning
from pixeltally.plans import warehouse as loads
from pixeltally.sources.files import write_parquet
from pixeltally.workload.tables import new_warehouse


def years(spark, dates):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(dates)], "i int, release_date string")
    return [r.release_year for r in cleaning.elect_year(cleaning.add_release_year(df, None)).orderBy("i").collect()]


@pytest.mark.parametrize("dates", [
    ["2001-02-03", "2002-12-31 10:00", "2003-01-05T10:11:12.5Z"], ["2/3/2001", "12/31/2002", "01/05/2003"], ["3/2/2001", "31/12/2002", "05/01/2003"],
    ["2-3-2001", "12-31-2002", "01-05-2003"], ["3-2-2001", "31-12-2002", "5-1-2003"], ["2001/02/03", "2002/12/31", "2003/1/5"],
    ["Feb 3, 2001", "Dec 31, 2002", "Jan 5, 2003"], ["February 3, 2001", "December 31, 2002", "May 5, 2003"],
    ["3 Feb 2001", "31 Dec 2002", "5 Jan 2003"]])
def test_each_form(spark, dates):
    assert years(spark, dates) == [2001, 2002, 2003]
    assert years(spark, [None, *dates, "soon", ""]) == [None, 2001, 2002, 2003, None, None]


def test_the_winner_alone_reads(spark):
    # One day over 12 tells that days come first; the month-first date of another file's form gets no year.
    assert years(spark, ["1/2/2001", "13/2/2002", "25/12/2003", "12/25/2004"]) == [2001, 2002, 2003, None]
    # Nothing tells: months come first.
    assert years(spark, ["1/2/2001", "3/4/2002"]) == [2001, 2002]
    assert years(spark, ["2001-01-01", "2002-01-01", "1/2/2003"]) == [2001, 2002, None]


def test_no_dates(spark):
    assert years(spark, [None, None]) == [None, None]
    assert years(spark, []) == []
    with pytest.raises(ValueError, match="none of 2 dates in release_date"):
        years(spark, ["04.05.2001", "soon", None])


def test_a_day_that_does_not_exist_is_no_date(spark):
    assert years(spark, ["2/30/2001", "2/28/2001", "12/31/2001"]) == [None, 2001, 2001]


def test_columns_that_are_dates_already(spark):
    df = spark.sql("SELECT DATE '2004-05-06' AS release_date")
    assert cleaning.elect_year(cleaning.add_release_year(df, None)).first().release_year == 2004
    assert cleaning.elect_year(cleaning.add_release_year(spark.range(1), None)).first().release_year is None


def test_every_shape_is_parsed(spark):
    for form in DATE_SHAPES:
        text = spark.sql("SELECT TIMESTAMP '2001-12-31' AS t").select(F.date_format("t", form.split("[")[0]).alias("release_date"))
        assert cleaning.add_release_year(text, [form]).first().release_year == 2001


SCHEMA = "title string, console string, genre string, critic_score double, release_date string, na_sales double, total_sales double, n int"


@pytest.mark.parametrize("dates", [["2001-03-14", "2002-01-01"], ["3/14/2001", "1/1/2002"], ["14/3/2001", "1/1/2002"]])
def test_loads(spark, tmp_path, dates):
    rows = [(f"g{i}", "PC", "Action", 1.0, d, 1.0, 1.0, i) for i, d in enumerate(dates)]
    sales = spark.createDataFrame(rows, SCHEMA)
    warehouse = new_warehouse(spark)
    loads.load_warehouse(warehouse, sales, ["n"])
    assert sorted(r.release_year for r in warehouse.table("fact_sales").collect()) == [2001, 2002]
    path = str(tmp_path / "week")
    write_parquet(sales, path)
    loads.weekly_refresh(warehouse, path, str(tmp_path / "none.csv"), ["n"])
    assert sorted(r.release_year for r in warehouse.table("fact_sales").collect()) == [2001, 2002]


def test_loads_report_dates_that_none_reads(spark, tmp_path):
    sales = spark.createDataFrame([("g", "PC", "Action", 1.0, "14.3.2001", 1.0, 1.0, 1)], SCHEMA)
    warehouse, path = new_warehouse(spark), str(tmp_path / "week")
    with pytest.raises(ValueError, match="release_date"):
        loads.load_warehouse(warehouse, sales, ["n"])
    write_parquet(sales, path)
    with pytest.raises(ValueError, match="release_date"):
        loads.weekly_refresh(warehouse, path, str(tmp_path / "none.csv"), ["n"])
    loads.load_warehouse(warehouse, sales, ["n"], formats=["d.M.yyyy"])
    assert warehouse.table("fact_sales").first().release_year == 2001
