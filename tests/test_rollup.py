"""The rollup against the views, over weeks, and what it reads."""

import pytest

from pixeltally.plans import rollup, views, warehouse as loads
from pixeltally.sources.files import write_parquet
from pixeltally.workload.tables import new_warehouse

SCHEMA = "title string, console string, genre string, critic_score double, release_date string, na_sales double, pal_sales double, total_sales double, n int"
ROWS = [
    (f"game {i}", ("PS5", "PC", "Arcade", None)[i % 4], ("Action", "Puzzle", "Own")[i % 3], i % 7 * 1.0 if i % 5 else None,
     f"200{i % 4}-01-01" if i % 6 else None, 1.0 + i if i % 2 else None, 2.0 if i % 3 else None, 3.0, i) for i in range(80)]


@pytest.fixture
def week(spark, tmp_path):
    def load(warehouse, rows):
        path = str(tmp_path / f"week-{len(list(tmp_path.iterdir()))}")
        write_parquet(spark.createDataFrame(rows, SCHEMA), path)
        loads.weekly_refresh(warehouse, path, str(tmp_path / "none.csv"), ["n"])
    return load


def rows_of(df):
    return sorted(str(sorted((k, round(v, 9) if isinstance(v, float) else v) for k, v in r.asDict().items())) for r in df.collect())


def agree(warehouse):
    star, kept = views.star_of(warehouse), warehouse.table(rollup.TABLE)
    assert rows_of(rollup.sales_continent_genre(kept, star)) == rows_of(views.sales_continent_genre(star))
    assert rows_of(rollup.top_platforms_by_region(kept, star)) == rows_of(views.top_platforms_by_region(star))
    assert rows_of(rollup.yearly_global_sales(kept)) == rows_of(views.yearly_global_sales(star))
    fresh = rollup.build(star["fact_sales"], star["dim_game"])
    assert rows_of(kept.select(fresh.columns)) == rows_of(fresh)


def test_weeks(spark, week, monkeypatch):
    warehouse = new_warehouse(spark)
    week(warehouse, ROWS[:50])
    rollup.refresh_rollup(warehouse)
    agree(warehouse)
    read = []
    monkeypatch.setattr(rollup, "build", lambda facts, games, build=rollup.build: read.append(facts.count()) or build(facts, games))
    week(warehouse, ROWS[50:])
    # New games only: the rollup of the new facts is all that is built.
    assert read == [sum(1 for r in ROWS[50:] for v in (r[5], r[6]) if v)]
    monkeypatch.undo()
    agree(warehouse)
    # Facts that change, go and come, and a repeat of that.
    changed = [(*r[:5], 7.5, None, *r[7:]) for r in ROWS[10:30]]
    for _ in range(2):
        week(warehouse, changed)
        agree(warehouse)
    loads.load_warehouse(warehouse, spark.createDataFrame(ROWS[::2], SCHEMA), ["n"])
    agree(warehouse)


def test_an_interrupted_update_is_made_good(spark, week, monkeypatch):
    warehouse = new_warehouse(spark)
    week(warehouse, ROWS[:30])
    rollup.refresh_rollup(warehouse)

    def killed(*_):
        raise KeyboardInterrupt
    monkeypatch.setattr(rollup, "update_rollup", killed)
    with pytest.raises(KeyboardInterrupt):
        week(warehouse, ROWS[30:40])
    monkeypatch.undo()
    assert not rollup.is_current(warehouse)
    week(warehouse, ROWS[30:40])  # finds no new fact, and builds the rollup
    assert rollup.is_current(warehouse)
    agree(warehouse)


def test_many_blocks_of_games(spark):
    """Ids beyond one bitmap, and a game that a group has in two rows of facts."""
    facts = spark.sql("""SELECT id div 2 * 1000 + 1 AS game_id, 1L AS region_id, 1L AS platform_id, 1L AS genre_id, 2000 AS release_year,
        CAST(id AS DOUBLE) AS sales_millions FROM range(400)""")
    games = facts.selectExpr("game_id", "CAST(NULL AS DOUBLE) AS critic_score").distinct()
    built = rollup.build(facts, games)
    assert built.count() == 7
    parts = [rollup.build(facts.filter(f"sales_millions % 3 = {k}"), games) for k in range(3)]
    assert rollup.yearly_global_sales(rollup.merge(*parts)).collect() == [(2000, 200, 79800.0, 199.5, 399.0)]


def test_facts_of_unknown_games(spark):
    facts = spark.createDataFrame([(1, 1, 1, 1, 2000, 1.0), (9, 1, 1, 1, 2000, 2.0)],
                                  "game_id long, region_id long, platform_id long, genre_id long, release_year int, sales_millions double")
    star = {"fact_sales": facts, "dim_game": spark.createDataFrame([(1, 4.0)], "game_id long, critic_score double"),
            "dim_region": spark.createDataFrame([(1, "R", "C")], "region_id long, region_label string, continent string"),
            "dim_genre": spark.createDataFrame([(1, "G")], "genre_id long, genre_name string")}
    kept = rollup.build(facts, star["dim_game"])
    assert rows_of(rollup.sales_continent_genre(kept, star)) == rows_of(views.sales_continent_genre(star))
    assert rows_of(rollup.yearly_global_sales(kept)) == rows_of(views.yearly_global_sales(star))
