"""A rollup of the facts that answers the analytical views, exact counts of games included.

One row per region, platform, genre, year and block of game ids. Sums, counts and greatest values
add up; the games of a row are a bitmap over the block, so the different games of any coarser group are
the bits of its rows put together. New facts make a rollup of their own that is merged into the kept one, so
a weekly load reads no old fact.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pixeltally.session import scratch_scope
from pixeltally.sources.files import stored
from pixeltally.sources.tables import DONE, Warehouse

TABLE = "sales_rollup"
GROUP = ["region_id", "platform_id", "genre_id", "release_year"]
# The block of ids and whether the game dimension knows the game: the continent view leaves others out.
KEYS = [*GROUP, "known", "block"]


def _measures(facts: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in facts.items()]


def build(facts: DataFrame, games: DataFrame) -> DataFrame:
    """The rollup of facts. Ids of games are dense, so a block of 32,768 of them is a bitmap of 4 KB at most."""
    scored = facts.join(games.select("game_id", "critic_score", F.lit(True).alias("known")), "game_id", "left")
    return (
        scored.withColumns({"known": F.coalesce("known", F.lit(False)), "block": F.bitmap_bucket_number("game_id")})
        .groupBy(*KEYS).agg(*_measures({
            "games": F.bitmap_construct_agg(F.bitmap_bit_position("game_id")),
            "sales": F.sum("sales_millions"), "n_sales": F.count("sales_millions"), "most": F.max("sales_millions"),
            "scores": F.sum("critic_score"), "n_scores": F.count("critic_score")})))


def merge(*rollups: DataFrame) -> DataFrame:
    """One rollup of the facts of several that have no fact in common."""
    return reduce(DataFrame.unionByName, rollups).groupBy(*KEYS).agg(*_measures({
        "games": F.bitmap_or_agg("games"),
        "sales": F.sum("sales"), "n_sales": F.sum("n_sales"), "most": F.max("most"),
        "scores": F.sum("scores"), "n_scores": F.sum("n_scores")}))


def _by(rows: DataFrame, keys: list[str], games: str, **measures: Column) -> DataFrame:
    """Measures by coarser keys; the bits of a block are put together before they are counted."""
    parts = {"sales": F.sum("sales"), "n_sales": F.sum("n_sales"), "most": F.max("most"), "scores": F.sum("scores"), "n_scores": F.sum("n_scores")}
    blocks = rows.groupBy(*keys, "block").agg(F.bitmap_count(F.bitmap_or_agg("games")).alias("_games"), *_measures(parts))
    return blocks.groupBy(*keys).agg(F.sum("_games").alias(games), *_measures(measures))


def _ratio(total: str, count: str) -> Column:
    return F.try_divide(F.sum(total), F.sum(count))


def sales_continent_genre(rollup: DataFrame, star: Mapping[str, DataFrame]) -> DataFrame:
    """As the view of that name."""
    rows = rollup.filter("known").join(star["dim_region"], "region_id").join(star["dim_genre"], "genre_id")
    return _by(rows, ["continent", "genre_name", "release_year"], "nb_games",
               total_sales_m=F.sum("sales"), avg_critic_score=_ratio("scores", "n_scores"))


def top_platforms_by_region(rollup: DataFrame, star: Mapping[str, DataFrame]) -> DataFrame:
    """As the view of that name."""
    rows = rollup.join(star["dim_region"], "region_id").join(star["dim_platform"], "platform_id")
    return _by(rows, ["region_label", "continent", "platform_name", "manufacturer", "generation"], "nb_titles", total_sales_m=F.sum("sales"))


def yearly_global_sales(rollup: DataFrame) -> DataFrame:
    """As the view of that name."""
    return _by(rollup.filter("release_year IS NOT NULL"), ["release_year"], "nb_games_released",
               total_sales_m=F.sum("sales"), avg_sales_per_game_m=_ratio("sales", "n_sales"), max_sales_m=F.max("most"))


# ---- the rollup that a warehouse keeps --------------------------------------


def refresh_rollup(warehouse: Warehouse) -> None:
    """Build the rollup from all facts. From then on loads keep it up to date."""
    warehouse.create_tables([TABLE])
    with warehouse.noted(TABLE):
        warehouse.refresh(build(warehouse.table("fact_sales"), warehouse.table("dim_game")), TABLE)


def keeps_rollup(warehouse: Warehouse) -> bool:
    return warehouse.spark.catalog.tableExists(warehouse.name(TABLE))


def is_current(warehouse: Warehouse) -> bool:
    """Whether the last change of the facts came to the rollup too: the last line of the ledger is an end."""
    last = warehouse.loads(TABLE).orderBy(F.desc("recorded_at")).first()
    return last is not None and last["state"] == DONE


def _same(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])


def update_rollup(warehouse: Warehouse, added: DataFrame, outdated: DataFrame) -> None:
    """Bring the rollup up to date after a merge of facts: ``added`` came, ``outdated`` were replaced or went.

    Added facts are merged in. A bitmap can't tell which other fact still names a game, so the
    rows of the rollup that outdated facts were in are built anew from the facts of their groups; where
    nothing was outdated, no old fact is read.
    """
    changes = not outdated.isEmpty()
    if not changes and added.isEmpty():
        return
    games = warehouse.table("dim_game")
    kept, new = warehouse.table(TABLE), added
    parts = []
    with scratch_scope(warehouse.spark):
        if changes:
            block = F.bitmap_bucket_number("game_id").alias("block")
            keys = [*GROUP, "block"]
            gone = stored(outdated.select(*GROUP, block).distinct(), "groups")
            rebuilt = warehouse.table("fact_sales").withColumn("block", block)
            parts.append(build(rebuilt.alias("a").join(gone.alias("b"), _same(keys), "left_semi"), games))
            kept = kept.alias("a").join(gone.alias("b"), _same(keys), "left_anti")
            new = new.withColumn("block", block).alias("a").join(gone.alias("b"), _same(keys), "left_anti")
        warehouse.refresh(merge(kept, build(new, games), *parts), TABLE)
