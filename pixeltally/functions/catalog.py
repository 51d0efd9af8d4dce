"""Expressions over catalogue responses (JSON with a ``results`` array)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pixeltally.schemas import CATALOG_RESPONSE


def parse_results(payload: Column) -> Column:
    """The candidates of a response, in order; null for text that is no JSON."""
    return F.from_json(payload, CATALOG_RESPONSE)["results"]


def first_result(results: Column) -> Column:
    return F.get(results, F.lit(0))


def best_match(results: Column, title: Column) -> Column:
    """The first candidate whose name contains the title, ignoring case, else the first one."""
    wanted = F.lower(title)
    named = F.filter(results, lambda r: F.lower(F.coalesce(r["name"], F.lit(""))).contains(wanted))
    return F.coalesce(F.get(named, F.lit(0)), first_result(results))


def joined_names(items: Column) -> Column:
    """Names of an array of records as one comma-joined text, empty for none."""
    return F.coalesce(F.array_join(items["name"], ", "), F.lit(""))


def detail_columns(game: Column, tags: int | None = None) -> list[Column]:
    """Rating, genres, tags (all, or the first ones), age rating and picture of a catalogue record."""
    def names(items: Column) -> Column:
        return F.when(game.isNotNull(), joined_names(items))

    return [
        game["id"].alias("rawg_id"),
        game["rating"].alias("rawg_rating"),
        names(game["genres"]).alias("rawg_genres"),
        names(game["tags"] if tags is None else F.slice(game["tags"], 1, tags)).alias("rawg_tags"),
        game["esrb_rating"]["name"].alias("esrb_rating"),
        game["background_image"].alias("background_img"),
    ]


def enrichment_columns(game: Column) -> list[Column]:
    """Release, critic score and developers of a catalogue record."""
    return [
        game["id"].alias("rawg_id"),
        game["released"].alias("rawg_released"),
        game["metacritic"].alias("rawg_metacritic"),
        F.nullif(joined_names(game["developers"]), F.lit("")).alias("rawg_developers"),
    ]
