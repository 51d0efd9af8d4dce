"""Replacements that fail, slices that stay, and loads that are repeated."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from pixeltally.plans import warehouse as loads
from pixeltally.sources import tables
from pixeltally.sources.files import write_parquet
from pixeltally.sources.tables import LOAD, Warehouse
from pixeltally.workload.tables import new_warehouse

SCHEMA = "title string, console string, genre string, critic_score double, release_date string, na_sales double, pal_sales double, total_sales double, n int"


def rows_of(number, amount=1.0):
    return [(f"game {i}", "PS5", "Action", 8.0, "2001-01-01", amount, 2.0, 3.0, i) for i in range(number)]


@pytest.fixture
def sales(spark):
    return lambda rows: spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def warehouse(spark, sales):
    found = new_warehouse(spark)
    loads.load_warehouse(found, sales(rows_of(100)), ["n"])
    return found


@pytest.fixture
def fails_in_the_write(monkeypatch):
    """The rows of one table fail on the executors, while they are written."""
    whole = Warehouse._insert

    def fail(table):
        def insert(self, name, rows, to):
            if to == table:
                column = next(c for c in rows.columns if c not in (LOAD, tables.SLICE, tables.BUCKETED_BY.get(to)))
                broken = F.when(F.hash(column) % 5 == 0, F.raise_error(F.lit("lost")).cast(rows.schema[column].dataType))
                rows = rows.withColumn(column, broken.otherwise(F.col(column)))
            whole(self, name, rows, to)
        monkeypatch.setattr(Warehouse, "_insert", insert)
    yield fail


def contents(warehouse, table="fact_sales"):
    return sorted(map(str, warehouse.table(table).drop("ingested_at", "created_at").collect()))


def files(warehouse, table="fact_sales"):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{warehouse.root.removeprefix('file:')}/{table}/**/*.parquet", recursive=True)}


def weekly(warehouse, sales, tmp_path, name, rows):
    path = str(tmp_path / name)
    write_parquet(sales(rows), path)
    return loads.weekly_refresh(warehouse, path, str(tmp_path / "none.csv"), ["n"])


@pytest.mark.parametrize("table", ["dim_game", "fact_sales"])
def test_a_failed_refresh_leaves_the_rows(warehouse, fails_in_the_write, monkeypatch, table):
    before = contents(warehouse, table)
    fails_in_the_write(table)
    for work in (lambda: warehouse.refresh(warehouse.table(table).limit(40), table), lambda: warehouse.compact(table)):
        with pytest.raises(Exception, match="lost"):
            work()
        assert contents(warehouse, table) == before
    monkeypatch.undo()
    warehouse.compact(table)
    assert contents(warehouse, table) == before
    assert not [t for t in warehouse.spark.catalog.listTables(warehouse.database) if t.name.startswith(f"{table}_")]


@pytest.mark.parametrize("table", ["dim_game", "dim_genre", "fact_sales"])
def test_a_failed_load_leaves_all_tables(warehouse, sales, fails_in_the_write, monkeypatch, table):
    """Ids follow the titles, so facts and games must change together or not at all."""
    names = ("dim_game", "dim_genre", "fact_sales")
    before = [contents(warehouse, t) for t in names]
    fails_in_the_write(table)
    with pytest.raises(Exception, match="lost"):
        loads.load_warehouse(warehouse, sales(rows_of(150, 4.0)), ["n"])
    assert [contents(warehouse, t) for t in names] == before
    monkeypatch.undo()
    counts = dict(loads.load_warehouse(warehouse, sales(rows_of(150, 4.0)), ["n"]).collect())
    assert counts["fact_sales"] == 300


def test_a_failed_merge_leaves_the_facts(warehouse, sales, tmp_path, fails_in_the_write, monkeypatch):
    before = contents(warehouse)
    fails_in_the_write("fact_sales")
    with pytest.raises(Exception, match="lost"):
        weekly(warehouse, sales, tmp_path, "week", rows_of(60, 9.0))
    assert contents(warehouse) == before
    monkeypatch.undo()
    assert all(r.passed for r in weekly(warehouse, sales, tmp_path, "again", rows_of(60, 9.0)).collect())
    amounts = warehouse.table("fact_sales").groupBy("sales_millions").count().collect()
    assert {r.sales_millions: r["count"] for r in amounts} == {9.0: 60, 1.0: 40, 2.0: 100}


def test_a_merge_rewrites_the_touched_slices_alone(spark, sales, tmp_path):
    warehouse = Warehouse(spark, new_warehouse(spark).database + "_wide", str(tmp_path / "star"), buckets=32)
    loads.load_warehouse(warehouse, sales(rows_of(400)), ["n"])
    before = files(warehouse)
    assert len(before) == 64  # of two regions
    # One fact changes, one goes.
    weekly(warehouse, sales, tmp_path, "week", [("game 3", "PS5", "Action", 8.0, "2001-01-01", 5.0, None, 3.0, 1)])
    read = {f.removeprefix("file:").replace("///", "/") for f in spark.table(warehouse.name("fact_sales")).inputFiles()}
    # The slice's two regions.
    assert len(read - set(before)) == 2 and len(read) == 64
    assert all(files(warehouse)[f] == before[f] for f in read & set(before))
    assert warehouse.table("fact_sales").count() == 799
    # New games are appended: no file of before is touched.
    weekly(warehouse, sales, tmp_path, "more", rows_of(402)[400:])
    now = files(warehouse)
    assert read <= set(now) and warehouse.table("fact_sales").count() == 803
    # The replaced slice goes when the table is replaced or vacuumed next.
    warehouse.vacuum("fact_sales")
    assert len(set(before) - set(files(warehouse))) == 2 and warehouse.table("fact_sales").count() == 803


def test_games_of_a_slice_share_buckets(warehouse):
    """A slice is a group of whole buckets, so slices do not multiply files."""
    facts = warehouse.spark.table(warehouse.name("fact_sales"))
    assert facts.select(tables.SLICE).distinct().count() == warehouse.buckets
    assert len(files(warehouse)) == facts.select(tables.SLICE, "region_id").distinct().count()


def test_readers_that_have_begun_go_on(warehouse):
    begun = warehouse.table("dim_game")
    expected = begun.count()
    warehouse.refresh(warehouse.table("dim_game").limit(3), "dim_game")
    assert (begun.count(), warehouse.table("dim_game").count()) == (expected, 3)
    for _ in range(3):
        warehouse.refresh(warehouse.table("dim_game"), "dim_game")
    folders = os.listdir(f"{warehouse.root.removeprefix('file:')}/dim_game")
    assert len(folders) == 2 and warehouse.table("dim_game").count() == 3


# ---- repeated loads ---------------------------------------------------------


@pytest.fixture
def batch(spark):
    rows = spark.createDataFrame([(i, f"t{i}") for i in range(1000, 1020)], "game_id long, title string")
    return rows


def test_a_repeated_load_adds_nothing(warehouse, batch):
    for _ in range(3):
        warehouse.append(batch, "dim_game", load_id="week 1")
    warehouse.append(batch.withColumn("game_id", F.col("game_id") + 100), "dim_game", load_id="week 2")
    assert warehouse.table("dim_game").count() == 140
    assert sorted(r.state for r in warehouse.loads("dim_game").collect()) == ["begun", "begun", "done", "done"]
    assert warehouse.loads("fact_sales").collect() == []


@pytest.mark.parametrize("written", [0, 7, 20])
def test_a_load_killed_between_its_rows_and_the_ledger(warehouse, batch, monkeypatch, written):
    """Killed before, amid and after the write."""
    class Killed(Exception):
        pass

    whole = Warehouse._insert

    def insert(self, name, rows, table):
        whole(self, name, rows.limit(written), table)
        raise Killed

    monkeypatch.setattr(Warehouse, "_insert", insert)
    with pytest.raises(Killed):
        warehouse.append(batch, "dim_game", load_id="week 1")
    monkeypatch.undo()
    assert warehouse.table("dim_game").count() == 100 + written
    for _ in range(2):
        warehouse.append(batch, "dim_game", load_id="week 1")
    rows = warehouse.table("dim_game").filter("game_id >= 1000").select("game_id").collect()
    assert sorted(r.game_id for r in rows) == list(range(1000, 1020))
    assert warehouse.table("dim_game").count() == 120


def test_a_partial_load_of_facts_rewrites_its_slices_alone(warehouse, spark):
    columns = warehouse.table("fact_sales").drop("ingested_at")
    more = columns.limit(30).withColumn("sale_id", F.col("sale_id") + 10_000)
    warehouse.begin("late", "fact_sales")
    one = more.filter(f"game_id = {more.first().game_id}")
    warehouse.append(one.withColumn(LOAD, F.lit("late")), "fact_sales")
    before = files(warehouse)
    warehouse.append(more, "fact_sales", load_id="late")
    assert warehouse.table("fact_sales").count() == 230
    read = spark.table(warehouse.name("fact_sales")).inputFiles()
    kept = {f.removeprefix("file:").replace("///", "/") for f in read} & set(before)
    assert len(kept) == 2 * (warehouse.buckets - 1)  # two regions of all slices but one


def test_the_ledger_survives_compaction(warehouse, batch):
    warehouse.append(batch, "dim_game", load_id="week 1")
    warehouse.compact("dim_game")
    warehouse.append(batch, "dim_game", load_id="week 1")
    assert warehouse.table("dim_game").count() == 120
    assert warehouse.spark.table(warehouse.name("dim_game")).filter(F.col(LOAD) == "week 1").count() == 20
