"""Loading, merging and checking the star schema."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pixeltally import session
from pixeltally.operators import quality
from pixeltally.operators.joins import insert_ignore
from pixeltally.plans import views, warehouse as loads
from pixeltally.schemas import CALENDAR_END, CALENDAR_START
from pixeltally.sources.files import write_parquet
from pixeltally.sources.tables import Warehouse
from pixeltally.workload.tables import new_warehouse

SCHEMA = "title string, console string, genre string, publisher string, critic_score double, release_date string, " \
    "na_sales double, pal_sales double, total_sales double, n int"
WEEK1 = [
    ("a", "PS5", "Action", "P", 8.0, "2001-01-01", 1.0, 2.0, 3.0, 1),
    ("a", "PC", "Action", "P", 9.0, "2001-01-01", 5.0, 5.0, 10.0, 2),
    ("b", "Arcade", "Roguelike", None, None, None, 0.00005, None, 1.0, 3),
]
WEEK2 = [*WEEK1, ("c", "PC", None, "Q", 7.0, "2002-05-05", None, 4.0, 4.0, 4)]


@pytest.fixture
def sales(spark):
    return lambda rows: spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def warehouse(spark):
    return new_warehouse(spark)


def fact_rows(warehouse):
    return sorted(warehouse.table("fact_sales").drop("ingested_at").collect())


def test_load(warehouse, sales):
    counts = dict(loads.load_warehouse(warehouse, sales(WEEK1), ["n"]).collect())
    assert counts == {"dim_game": 2, "dim_genre": 22, "dim_platform": 20, "dim_region": 5, "fact_sales": 3}
    game = {r.title: r for r in warehouse.table("dim_game").collect()}
    assert game["a"].critic_score == 8.0 and game["a"].data_source == "vgchartz" and game["a"].created_at
    genre = {r.genre_name: r for r in warehouse.table("dim_genre").collect()}
    assert (genre["Roguelike"].genre_id, genre["Roguelike"].category) == (22, "Other")
    assert (genre["Sports"].genre_id, genre["Sports"].category) == (12, "Sports")
    facts = {(r.game_id, r.region_id): r for r in warehouse.table("fact_sales").collect()}
    b = facts[game["b"].game_id, 1]
    assert (b.platform_id, b.genre_id, b.release_year, b.sales_millions, b.global_sales) == (None, 22, None, round(0.00005, 4), 1.0)
    assert len({f.sale_id for f in facts.values()}) == 3


def test_refresh_twice(warehouse, sales):
    loads.load_warehouse(warehouse, sales(WEEK2), ["n"])
    before = fact_rows(warehouse), sorted(warehouse.table("dim_game").drop("created_at").collect())
    loads.load_warehouse(warehouse, sales(WEEK2), ["n"])
    assert (fact_rows(warehouse), sorted(warehouse.table("dim_game").drop("created_at").collect())) == before


def test_weekly_refresh_keeps_ids(warehouse, sales, tmp_path):
    def run(rows):
        path = str(tmp_path / f"week{len(rows)}")
        write_parquet(sales(rows).coalesce(1), path)
        checks = loads.weekly_refresh(warehouse, path, str(tmp_path / "none.csv"))
        assert all(r.passed for r in checks.collect())
        return {r.title: r.game_id for r in warehouse.table("dim_game").collect()}

    first = run(WEEK1)
    facts = fact_rows(warehouse)
    assert run(WEEK1) == first and fact_rows(warehouse) == facts
    second = run(WEEK2)
    assert {**first, "c": 3} == second
    assert len(fact_rows(warehouse)) == 4
    assert dict(warehouse.counts(["dim_date", "dim_genre"]).collect()) == {"dim_date": 22280, "dim_genre": 23}


def week(warehouse, sales, tmp_path, name, rows):
    path = str(tmp_path / name)
    write_parquet(sales(rows).coalesce(1), path)
    loads.weekly_refresh(warehouse, path, str(tmp_path / "none.csv"))
    titles = {r.game_id: r.title for r in warehouse.table("dim_game").collect()}
    return {(titles[f.game_id], f.region_id): f.sales_millions for f in warehouse.table("fact_sales").collect()}


def test_weeks_add_up(warehouse, sales, tmp_path):
    first = week(warehouse, sales, tmp_path, "one", WEEK1)
    both = week(warehouse, sales, tmp_path, "two", WEEK2[3:])
    assert both == {**first, ("c", 2): 4.0}
    assert week(warehouse, sales, tmp_path, "again", WEEK2[3:]) == both
    # A later week that has other sales of a known game brings its facts up to date.
    changed = [("a", "PS5", "Action", "P", 8.0, "2001-01-01", 1.5, None, 3.0, 1)]
    assert week(warehouse, sales, tmp_path, "changed", changed) == {
        **{k: v for k, v in both.items() if k[0] != "a"}, ("a", 1): 1.5}
    assert warehouse.table("fact_sales").count() == warehouse.table("fact_sales").select("sale_id").distinct().count()


def test_long_titles_have_games_of_their_own(warehouse, sales, tmp_path):
    rows = [("x" * 300 + end, "PC", "Action", "P", 1.0, "2001-01-01", amount, None, amount, n) for n, (end, amount) in enumerate([("a", 1.0), ("b", 2.0)])]
    assert {(t[-1], v) for (t, _), v in week(warehouse, sales, tmp_path, "long", rows).items()} == {("a", 1.0), ("b", 2.0)}


def test_the_calendar_reaches_as_far_as_the_data(warehouse, sales):
    rows = [("a", "PC", "G", "P", 1.0, "2041-05-05", 1.0, None, 1.0, 1), ("b", "PC", "G", "P", 1.0, "1969-05-05", 1.0, None, 1.0, 2)]
    for _ in range(2):
        loads.load_warehouse(warehouse, sales(rows), ["n"])
    days = warehouse.table("dim_date").agg(F.min("full_date"), F.max("full_date"), F.count("*"), F.countDistinct("full_date")).first()
    assert (days[0], days[1]) == (dt.date(1969, 1, 1), dt.date(2041, 12, 31)) and days[2] == days[3] == (days[1] - days[0]).days + 1


def test_no_scratch_folder_stays(warehouse, sales, tmp_path, monkeypatch):
    scratch = tmp_path / "scratch"
    scratch.mkdir()
    monkeypatch.setattr(session, "scratch_root", lambda spark: str(scratch))
    loads.load_warehouse(warehouse, sales(WEEK1), ["n"])
    week(warehouse, sales, tmp_path, "one", WEEK2)
    assert list(scratch.iterdir()) == []
    # A load that fails leaves none either, and can be run again.
    with pytest.raises(Exception, match="no_such_column"):
        loads.load_warehouse(warehouse, sales(WEEK1), ["no_such_column"])
    assert list(scratch.iterdir()) == []
    assert dict(loads.load_warehouse(warehouse, sales(WEEK1), ["n"]).collect())["fact_sales"] == 3


def test_a_reopened_warehouse_keeps_its_buckets(spark, warehouse, sales):
    loads.load_warehouse(warehouse, sales(WEEK1), ["n"])
    again = Warehouse(spark, warehouse.database, buckets=7)
    assert again.buckets_of("fact_sales") == warehouse.buckets != 7
    before = fact_rows(again)
    again.append(again.table("fact_sales").drop("ingested_at"), "fact_sales")
    again.compact("fact_sales")
    assert fact_rows(again) == sorted(before * 2)


def test_other_settings_are_refused(spark, warehouse, sales, settings):
    settings({"spark.sql.session.timeZone": "Asia/Tokyo"})
    with pytest.raises(RuntimeError, match="timeZone"):
        loads.load_warehouse(warehouse, sales(WEEK1), ["n"])


def test_weekly_refresh_without_source(warehouse, tmp_path):
    with pytest.raises(FileNotFoundError):
        loads.weekly_refresh(warehouse, str(tmp_path / "no"), str(tmp_path / "no.csv"))


def test_a_title_with_two_games_repeats_no_fact(warehouse, sales):
    loads.load_warehouse(warehouse, sales(WEEK1), ["n"])
    clean = loads.clean_for_warehouse(sales(WEEK1), ["n"])
    star = views.star_of(warehouse)
    again = star["dim_game"].withColumn("game_id", F.col("game_id") + 100)
    dimensions = [star[t] for t in ("dim_platform", "dim_genre", "dim_region")]
    facts = loads.build_fact_sales(clean, star["dim_game"].unionByName(again), *dimensions)
    assert sorted(r.game_id for r in facts.collect()) == sorted(r.game_id for r in star["fact_sales"].collect())


def test_facts_without_region_are_left_out(warehouse, sales):
    loads.load_warehouse(warehouse, sales(WEEK1), ["n"])
    star = views.star_of(warehouse)
    clean = loads.clean_for_warehouse(sales(WEEK1), ["n"])
    no_europe = star["dim_region"].filter("region_code <> 'EU'")
    assert loads.build_fact_sales(clean, star["dim_game"], star["dim_platform"], star["dim_genre"], no_europe).count() == 2


def test_views(warehouse, sales):
    loads.load_warehouse(warehouse, sales(WEEK2), ["n"])
    star = views.star_of(warehouse)
    # The platform of "b" is unknown, so it is in no view that names platforms.
    assert {(r.title, r.region_label, r.region_rank) for r in views.game_ranking_by_region(star).collect()} == {
        ("a", "North America", 1), ("c", "Europe", 1), ("a", "Europe", 2)}
    assert [r.title for r in views.top_games_in_region(star, "EU", 1).collect()] == ["c"]
    assert {(r.release_year, r.total_sales_m) for r in views.yearly_global_sales(star).collect()} == {(2001, 3.0), (2002, 4.0)}
    assert {(r.continent, r.genre_name, r.release_year, r.nb_games, r.avg_critic_score) for r in views.sales_continent_genre(star).collect()} == {
        ("Americas", "Action", 2001, 1, 8.0), ("Europe", "Action", 2001, 1, 8.0),
        ("Americas", "Roguelike", None, 1, None), ("Europe", "Unknown", 2002, 1, 7.0)}


def test_calendar(spark):
    days = loads.calendar_dimension(spark, CALENDAR_START, CALENDAR_END)
    assert days.count() == 22280
    day = {r.full_date: r for r in days.filter("full_date IN ('1970-01-01', '2021-01-03')").collect()}
    assert tuple(day[dt.date(1970, 1, 1)]) == (19700101, dt.date(1970, 1, 1), 1970, 1, 1, "January", 1, 4, False)
    assert tuple(day[dt.date(2021, 1, 3)]) == (20210103, dt.date(2021, 1, 3), 2021, 1, 1, "January", 53, 0, True)


def test_insert_ignore(spark):
    existing = spark.createDataFrame([("a",)], "code string")
    rows = spark.createDataFrame([("a", 1), ("b", 3), ("b", 2)], "code string, n int")
    assert insert_ignore(rows, existing, "code", ["n"]).collect() == [("b", 2)]


def test_failing_checks(spark):
    fact = spark.createDataFrame([(1, None, 1), (1, 2.0, None), (5, 2.0, 9)], "game_id int, sales_millions double, region_id int")
    games = spark.createDataFrame([(1, "a", "p"), (2, "a", "p"), (3, "b", None), (4, "b", None)], "game_id int, title string, publisher string")
    checks = {r.check: (r.observed, r.passed) for r in quality.quality_checks(fact, games.limit(0)).collect()}
    assert checks == {"fact_sales_not_empty": (3, True), "null_sales": (1, False), "fact_without_region": (1, False), "dim_game_not_empty": (0, False)}
    assert quality.check_unique(games, ["title", "publisher"], "u").collect() == [("u", 1, 2)]
    assert quality.check_orphans(fact, {"game_id": games, "region_id": games.select(F.lit(1).alias("region_id"))}).collect() == [
        ("fact_sales.game_id", 1), ("fact_sales.region_id", 1)]
    assert sorted(quality.check_domain(games, "g", ["publisher"], {"title": ["a"]}).collect()) == [("g.publisher not null", 2), ("g.title in domain", 2)]
    assert quality.load_progress(fact.limit(0), fact.limit(0)).collect() == [(0, 0, None)]


def test_metrics(spark):
    raw = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", None), (None, None), (None, None)], "title string, release_date string")
    got = dict(quality.stage_metrics(raw, raw.limit(2), raw.limit(1)).collect())
    assert got == {"rows_read": 5, "rows_without_key": 2, "duplicates_removed": 1, "rows_after_clean": 2, "rows_after_unpivot": 1}


def test_a_merge_reads_all_facts_once(warehouse, sales, monkeypatch):
    loads.load_warehouse(warehouse, sales(WEEK2), ["n"])
    readers, plain = [], loads.stored

    def noted(df, name):
        readers.extend([name] if any("/fact_sales/" in path for path in df.inputFiles()) else [])
        return plain(df, name)

    monkeypatch.setattr(loads, "stored", noted)
    changed = [(*row[:6], 7.0, *row[7:]) for row in WEEK1]
    before = fact_rows(warehouse)
    loads.merge_facts(warehouse, loads.clean_for_warehouse(sales([*changed, ("d", *WEEK2[0][1:])]), ["n"]))
    assert readers == ["theirs"]
    titles = {r.game_id: r.title for r in warehouse.table("dim_game").collect()}
    after = {(titles[r.game_id], r.region_id): r.sales_millions for r in warehouse.table("fact_sales").collect()}
    assert len(before) == 4 and after == {("a", 1): 7.0, ("a", 2): 2.0, ("b", 1): 7.0, ("c", 2): 4.0}
