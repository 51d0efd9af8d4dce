"""Loading the star schema."""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from contextlib import nullcontext
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixeltally.operators.cleaning import clean_for_warehouse, distinct_values, elect_year
from pixeltally.operators.joins import not_in
from pixeltally.operators.keys import assign_ids
from pixeltally.operators.quality import quality_checks
from pixeltally.operators.reshape import melt_sales
from pixeltally.plans import rollup
from pixeltally.schemas import (
    CALENDAR_END, CALENDAR_START, NEW_GENRE_CATEGORY, SALES_REGIONS, genre_seed, platform_seed, region_seed,
)
from pixeltally.session import require_settings, scratch_scope
from pixeltally.sources.files import FILE_ORDER, resolve_source, stored
from pixeltally.sources.tables import Warehouse

LOADED_TABLES = ["dim_game", "dim_genre", "dim_platform", "dim_region", "fact_sales"]


def calendar_dimension(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day; ISO week, day of week from 0 for Sunday, month name without padding."""
    days = spark.sql(
        "SELECT explode(sequence(date(:start), date(:end), INTERVAL 1 DAY)) AS full_date",
        {"start": start, "end": end})
    day = F.col("full_date")
    weekday = F.dayofweek(day) - 1
    return days.select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_id"),
        day,
        F.year(day).cast("smallint").alias("year"),
        F.quarter(day).cast("smallint").alias("quarter"),
        F.month(day).cast("smallint").alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).cast("smallint").alias("week"),
        weekday.cast("smallint").alias("day_of_week"),
        weekday.isin(0, 6).alias("is_weekend"))


def games(clean: DataFrame) -> DataFrame:
    return clean.select("title", "publisher", "developer", "critic_score", "user_score")


def genres(clean: DataFrame) -> DataFrame:
    return distinct_values(clean, "genre").select(
        F.col("genre").alias("genre_name"), F.lit(NEW_GENRE_CATEGORY).alias("category"))


def new_rows(rows: DataFrame, existing: DataFrame, key: str, id_column: str) -> DataFrame:
    """The rows to insert: key not in ``existing`` yet, with ids that follow the ids there.

    ``rows`` must be unique by key. The new ones, few after the first load, are stored,
    since numbering reads them twice.
    """
    return assign_ids(stored(not_in(rows, existing, key), "new"), key, id_column, existing)


def build_dim_game(clean: DataFrame) -> DataFrame:
    """All games, numbered; ``clean`` should be stored, since numbering reads it twice."""
    return assign_ids(games(clean), "title", "game_id")


def build_dim_genre(clean: DataFrame, seed: DataFrame) -> DataFrame:
    """The seeded genres with their categories, and the other genres of the data."""
    return seed.unionByName(new_rows(genres(clean), seed, "genre_name", "genre_id"))


def build_fact_sales(
    clean: DataFrame, dim_game: DataFrame, dim_platform: DataFrame, dim_genre: DataFrame, dim_region: DataFrame,
) -> DataFrame:
    """One row per game and region with positive sales.

    Rows without game or region are left out; an unknown platform or genre gives a
    null key. The joins come before the unpivot, on a quarter of the rows. ``clean``
    has one row per title, so game and region tell a row apart, and its id follows
    from the two without another shuffle. Platform, genre and region codes are unique
    in their tables; titles need not be, and the first game of a title counts.
    """
    keyed = (
        clean.join(dim_game.groupBy("title").agg(F.min("game_id").alias("game_id")), "title")
        .join(dim_platform.select(F.col("platform_code").alias("platform"), "platform_id"), "platform", "left")
        .join(dim_genre.select(F.col("genre_name").alias("genre"), "genre_id"), "genre", "left"))
    kept = ["game_id", "platform_id", "genre_id", "release_year", "total_sales"]
    regions = dim_region.select("region_code", "region_id")
    codes = list(SALES_REGIONS.values())
    place = F.array_position(F.array(*map(F.lit, codes)), F.col("region_code"))
    return melt_sales(keyed, kept).join(regions, "region_code").select(
        ((F.col("game_id") - 1) * len(codes) + place).alias("sale_id"),
        "game_id", "platform_id", "genre_id", "region_id", "release_year", "sales_millions",
        F.col("total_sales").alias("global_sales"))


def seed_tables(warehouse: Warehouse) -> None:
    """Create missing tables and give the reference rows to those that have none yet."""
    spark = warehouse.spark
    warehouse.create_tables()
    seeds = {"dim_platform": platform_seed, "dim_region": region_seed, "dim_genre": genre_seed}
    counts = dict(warehouse.counts([*seeds, "dim_date"]).collect())
    for table, rows in seeds.items():
        if not counts[table]:
            warehouse.append(rows(spark), table)
    if not counts["dim_date"]:
        warehouse.append(calendar_dimension(spark, CALENDAR_START, CALENDAR_END), "dim_date")


def extend_calendar(warehouse: Warehouse, clean: DataFrame) -> None:
    """Add the days of the data's years that the calendar doesn't reach."""
    low, high = clean.agg(F.min("release_year"), F.max("release_year")).first()
    first, last = warehouse.table("dim_date").agg(F.min("full_date"), F.max("full_date")).first()
    day = datetime.timedelta(days=1)
    if high is not None and high > last.year:
        warehouse.append(calendar_dimension(warehouse.spark, str(last + day), f"{high:04d}-12-31"), "dim_date")
    if low is not None and low < first.year:
        warehouse.append(calendar_dimension(warehouse.spark, f"{low:04d}-01-01", str(first - day)), "dim_date")


def _facts(warehouse: Warehouse, clean: DataFrame) -> DataFrame:
    dimensions = [warehouse.table(t) for t in ("dim_game", "dim_platform", "dim_genre", "dim_region")]
    return build_fact_sales(clean, *dimensions)


def merge_facts(warehouse: Warehouse, clean: DataFrame) -> None:
    """Bring the facts of the source's games up to date; those of other games stay.

    A fact is told by game and region. Where the source changes or lacks a fact that one of its games has,
    the slices with such facts are written anew and then replaced; no other slice is. All other new facts are
    appended. A failure leaves the former rows of each slice or its new ones, and the same merge goes on
    with what is missing; run again after its end, it finds nothing to do. The rollup, where the warehouse
    keeps one, follows; if that was interrupted, the next merge builds it from all facts.
    """
    key = ["game_id", "sale_id"]
    new = stored(_facts(warehouse, clean), "facts")
    known = warehouse.table("fact_sales")
    games_now = warehouse.table("dim_game").join(clean.select("title"), "title", "left_semi").select("game_id")
    same = reduce(lambda a, b: a & b, [F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in new.columns])
    # The one step that reads all facts; those of other games can neither be outdated nor known already.
    theirs = stored(known.join(games_now, "game_id", "left_semi"), "theirs")
    outdated = stored(theirs.alias("o").join(new.alias("n"), same, "left_anti").select("o.*"), "outdated")
    added = stored(new.join(theirs.join(outdated, key, "left_anti"), key, "left_anti"), "added")
    keeps = rollup.keeps_rollup(warehouse)
    current = keeps and rollup.is_current(warehouse)
    with warehouse.noted(rollup.TABLE) if keeps else nullcontext():
        touched = warehouse.slices_with(outdated, "fact_sales")
        its_slice = warehouse.slice_of("fact_sales", "game_id")
        if touched:
            kept = warehouse.read_slices("fact_sales", touched).join(outdated, key, "left_anti")
            there = added.filter(its_slice.isin(touched)).withColumn("ingested_at", F.current_timestamp())
            warehouse.refresh(kept.unionByName(there, allowMissingColumns=True), "fact_sales", touched)
        warehouse.append(added.filter(~its_slice.isin(touched)) if touched else added, "fact_sales")
        if current:
            rollup.update_rollup(warehouse, added, outdated)
        elif keeps:
            rollup.refresh_rollup(warehouse)


def load_warehouse(
    warehouse: Warehouse, sales: DataFrame, order: Sequence[str], formats: Sequence[str] | None = None,
) -> DataFrame:
    """Full refresh: rebuild games, genres and facts from the sales; returns row counts per table.

    ``formats`` are the forms of dates, tried in turn; without any, the form that reads most dates is
    elected, and dates that none reads are an error.

    All three are written first and made current after that, so a load that fails leaves the former ones.
    """
    require_settings(warehouse.spark)
    seed_tables(warehouse)
    with scratch_scope(warehouse.spark):
        clean = elect_year(stored(clean_for_warehouse(sales, order, formats), "clean"))
        extend_calendar(warehouse, clean)
        game = warehouse.stage(build_dim_game(clean), "dim_game")
        genre = warehouse.stage(build_dim_genre(clean, genre_seed(warehouse.spark)), "dim_genre")
        fixed = [warehouse.table(t) for t in ("dim_platform", "dim_region")]
        facts = warehouse.stage(build_fact_sales(clean, game.rows, fixed[0], genre.rows, fixed[1]), "fact_sales")
        with warehouse.noted(rollup.TABLE) if rollup.keeps_rollup(warehouse) else nullcontext():
            warehouse.publish(game, genre, facts)
            if rollup.keeps_rollup(warehouse):
                rollup.refresh_rollup(warehouse)
    return warehouse.counts(LOADED_TABLES)


def merge_dimensions(warehouse: Warehouse, clean: DataFrame) -> None:
    """Add games and genres that are not known yet; known ones keep their ids and values."""
    warehouse.append(new_rows(games(clean), warehouse.table("dim_game"), "title", "game_id"), "dim_game")
    warehouse.append(new_rows(genres(clean), warehouse.table("dim_genre"), "genre_name", "genre_id"), "dim_genre")


def weekly_refresh(
    warehouse: Warehouse, enriched_path: str, csv_path: str, order: Sequence[str] | None = None,
    formats: Sequence[str] | None = None,
) -> DataFrame:
    """Find the source, add to the dimensions, merge the facts; returns the quality checks.

    Games that this week's source doesn't have keep their facts. Without ``order``, the first
    of several rows of a title is the first in the file. ``formats`` as in ``load_warehouse``.
    """
    require_settings(warehouse.spark)
    sales = resolve_source(warehouse.spark, enriched_path, csv_path, file_order=order is None)
    seed_tables(warehouse)
    with scratch_scope(warehouse.spark):
        clean = elect_year(stored(clean_for_warehouse(sales, order or [FILE_ORDER], formats).drop(FILE_ORDER), "clean"))
        extend_calendar(warehouse, clean)
        merge_dimensions(warehouse, clean)
        merge_facts(warehouse, clean)
    return quality_checks(warehouse.table("fact_sales"), warehouse.table("dim_game"))
