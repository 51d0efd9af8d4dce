"""Enriching titles from catalogue responses.

Responses are a table (title, payload): one JSON response per title that was looked up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixeltally.functions.catalog import (
    best_match, detail_columns, enrichment_columns, first_result, parse_results,
)
from pixeltally.operators.cleaning import any_null
from pixeltally.operators.joins import enrich_by_title, not_in, tag_source
from pixeltally.schemas import ENRICHMENT
from pixeltally.sources.files import stored

# A row lacks something where one of these is null.
WANTED = ["critic_score", "developer", "release_date"]


def incomplete_rows(sales: DataFrame) -> DataFrame:
    return sales.filter(any_null(WANTED))


def distinct_titles(df: DataFrame) -> DataFrame:
    return df.select("title").dropna().distinct()


def first_titles(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Every title with where it comes first in the input: ``title`` and the columns of ``order``."""
    first = df.dropna(subset=["title"]).groupBy("title").agg(F.min(F.struct(*order)).alias("_first"))
    return first.select("title", "_first.*")


def title_details(responses: DataFrame, titles: DataFrame) -> DataFrame:
    """Rating, genres, tags, age rating and picture of each title's first candidate; nulls where there is none."""
    game = first_result(parse_results(F.col("payload")))
    found = responses.join(titles, "title", "left_semi").select("title", game.alias("game"))
    return found.select("title", *detail_columns(F.col("game")))


def title_matches(responses: DataFrame) -> DataFrame:
    """The best candidate of each response as enrichment columns, nulls where there is none.

    A filter on the candidate would move below the JSON parser and parse every
    response twice; the left join that follows gives nulls for an absent row just as well.
    """
    results = responses.select("title", parse_results(F.col("payload")).alias("results"))
    matched = results.select("title", best_match(F.col("results"), F.col("title")).alias("game"))
    return matched.select("title", *enrichment_columns(F.col("game")))


def known_titles(previous: DataFrame) -> DataFrame:
    """What an earlier enriched table knows: one row per title that was found."""
    found = [c for c in ENRICHMENT.fieldNames() if c != "title"]
    return (
        previous.filter("rawg_id IS NOT NULL").groupBy("title")
        .agg(F.max(F.struct(*found)).alias("found")).select("title", "found.*"))


def titles_to_look_up(sales: DataFrame, order: Sequence[str], previous: DataFrame | None = None) -> DataFrame:
    """Titles with an incomplete row, less those found earlier, and where each comes first.

    A client that can only ask for some takes the first by ``order``; the next run,
    with what it found as ``previous``, goes on with the others.
    """
    titles = first_titles(incomplete_rows(sales), order)
    return titles if previous is None else not_in(titles, known_titles(previous), "title")


def enrich(sales: DataFrame, responses: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """Sales with the catalogue columns and the source tag.

    Results of an earlier run (``previous``, its enriched table) are kept and not
    looked up again. Writing the result over ``previous`` is refused by ``write_parquet``. What was
    found is stored first: it is far smaller than the sales, which then need no shuffle
    where Spark can broadcast it.
    """
    titles = distinct_titles(incomplete_rows(sales))
    if previous is None:
        found = title_matches(responses.join(titles, "title", "left_semi"))
    else:
        known = stored(known_titles(previous), "known")
        # What is asked for is not known yet, so the two results have no title in common.
        new = title_matches(responses.join(not_in(titles, known, "title"), "title", "left_semi"))
        found = known.unionByName(new)
    return tag_source(enrich_by_title(sales, stored(found, "found")))
