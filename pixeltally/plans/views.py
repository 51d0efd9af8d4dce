"""Analytical views and example queries over the star schema.

A star is a mapping from table name to DataFrame. The functions give unordered
rows; only top-k queries order them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixeltally.operators.ranking import rank_of_values, top_k, with_rank
from pixeltally.sources.files import stored
from pixeltally.sources.tables import Warehouse

Star = Mapping[str, DataFrame]

STAR_TABLES = ["dim_game", "dim_platform", "dim_genre", "dim_region", "fact_sales"]


def star_of(warehouse: Warehouse) -> dict[str, DataFrame]:
    return {t: warehouse.table(t) for t in STAR_TABLES}


def sales_continent_genre(star: Star) -> DataFrame:
    """Games, sales and mean critic score (over sales rows) by continent, genre and year."""
    return (
        star["fact_sales"].join(star["dim_game"], "game_id").join(star["dim_region"], "region_id")
        .join(star["dim_genre"], "genre_id")
        .groupBy("continent", "genre_name", "release_year")
        .agg(F.countDistinct("game_id").alias("nb_games"),
             F.sum("sales_millions").alias("total_sales_m"),
             F.avg("critic_score").alias("avg_critic_score")))


def top_platforms_by_region(star: Star) -> DataFrame:
    """Sales and number of titles by region and platform."""
    return (
        star["fact_sales"].join(star["dim_region"], "region_id").join(star["dim_platform"], "platform_id")
        .groupBy("region_label", "continent", "platform_name", "manufacturer", "generation")
        .agg(F.sum("sales_millions").alias("total_sales_m"),
             F.countDistinct("game_id").alias("nb_titles")))


def yearly_global_sales(star: Star) -> DataFrame:
    """Games, total, mean and largest regional sales by year, rows without year left out."""
    return (
        star["fact_sales"].filter(F.col("release_year").isNotNull()).groupBy("release_year")
        .agg(F.countDistinct("game_id").alias("nb_games_released"),
             F.sum("sales_millions").alias("total_sales_m"),
             F.avg("sales_millions").alias("avg_sales_per_game_m"),
             F.max("sales_millions").alias("max_sales_m")))


KEYS = {"game_id": "dim_game", "region_id": "dim_region", "platform_id": "dim_platform", "genre_id": "dim_genre"}


def _known_sales(star: Star) -> DataFrame:
    """Keys and sales of the facts that every dimension knows.

    No column of a dimension comes along, and no join shuffles the facts: games are bucketed as
    the facts are, the other dimensions are small.
    """
    rows = star["fact_sales"].select(*KEYS, "sales_millions")
    for key, dimension in KEYS.items():
        rows = rows.join(star[dimension].select(key), key, "left_semi")
    return rows


def _described(rows: DataFrame, star: Star) -> DataFrame:
    """Ranked facts with the names of their dimensions."""
    return (
        rows.join(star["dim_region"].select("region_id", "region_label"), "region_id")
        .join(star["dim_platform"].select("platform_id", "platform_name"), "platform_id")
        .join(star["dim_genre"].select("genre_id", "genre_name"), "genre_id")
        .join(star["dim_game"].select("game_id", "title"), "game_id")
        .select("region_label", "title", "platform_name", "genre_name", "sales_millions", "region_rank"))


def game_ranking_by_region(star: Star, store_ranks: bool = False) -> DataFrame:
    """Every game's rank by sales within each region.

    With ``store_ranks`` the ranks of the different sales values are computed and stored
    at once, which saves the shuffle of all rows where they are few. A view to be kept
    goes without, so that it follows its tables.
    """
    rows, ranked = _known_sales(star), ("region_id", "sales_millions", "region_rank")
    ranks = stored(rank_of_values(rows, *ranked, store=True), "ranks") if store_ranks else None
    return _described(with_rank(rows, *ranked, ranks), star)


def top_games_per_region(star: Star, k: int = 10) -> DataFrame:
    """The games ranked ``k`` or better in each region."""
    return _described(top_k(_known_sales(star), "region_id", "sales_millions", "region_rank", k), star)


def top_games_in_region(star: Star, region_code: str, k: int = 10) -> DataFrame:
    """The ``k`` best-selling titles of one region, per platform; ties by title and platform."""
    region = star["dim_region"].filter(F.col("region_code") == region_code)
    return (
        star["fact_sales"].join(region, "region_id").join(star["dim_game"], "game_id")
        .join(star["dim_platform"], "platform_id")
        .groupBy("title", "platform_name").agg(F.sum("sales_millions").alias("sales_m"))
        .orderBy(F.desc("sales_m"), "title", "platform_name").limit(k))


def sales_by_genre_and_continent(star: Star) -> DataFrame:
    return sales_continent_genre(star).orderBy(F.desc("total_sales_m"))


def yearly_between(star: Star, first: int, last: int) -> DataFrame:
    return yearly_global_sales(star).filter(F.col("release_year").between(first, last))


def dominant_platforms(star: Star, k: int = 20) -> DataFrame:
    """The ``k`` region-platform pairs with the highest sales."""
    return (
        top_platforms_by_region(star)
        .orderBy(F.desc("total_sales_m"), "region_label", "platform_name").limit(k))


VIEWS = {
    "vw_sales_continent_genre": sales_continent_genre,
    "vw_top_platforms_by_region": top_platforms_by_region,
    "vw_yearly_global_sales": yearly_global_sales,
    "vw_game_ranking_by_region": game_ranking_by_region,
}


def register_views(star: Star) -> None:
    """Make the tables and views known to ``spark.sql`` by name."""
    for table, rows in star.items():
        rows.createOrReplaceTempView(table)
    for name, view in VIEWS.items():
        view(star).createOrReplaceTempView(name)
