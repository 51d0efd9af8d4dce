"""Joins that enrich sales and load dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixeltally.operators.cleaning import keep_first
from pixeltally.schemas import BASE_SOURCE, ENRICHED_SOURCE


def enrich_by_title(sales: DataFrame, metadata: DataFrame) -> DataFrame:
    """Add metadata, one row per title, to every sales row of that title.

    Sales may hold very frequent titles, which Spark's skew-join handling splits. It
    does so only where both sides are shuffled for the join itself; metadata that
    comes out of an aggregate or join by title would skip that shuffle, hence the
    rebalance. A small metadata side is broadcast, by its size.
    """
    return sales.join(metadata.hint("rebalance"), "title", "left")


def tag_source(df: DataFrame) -> DataFrame:
    """Where a row's data come from: the base data alone, or with a catalogue record."""
    tag = F.when(F.col("rawg_id").isNotNull(), ENRICHED_SOURCE).otherwise(BASE_SOURCE)
    return df.withColumn("data_source", tag)


def not_in(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not known yet."""
    return rows.join(known.select(key), key, "left_anti")


def insert_ignore(rows: DataFrame, existing: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The rows an insert that ignores known keys adds: the first of each key that is not known yet."""
    return not_in(keep_first(rows, [key], order), existing, key)


def union_previous(previous: DataFrame, new: DataFrame, key: str = "title") -> DataFrame:
    """Both results; where both know a key, the previous one stays."""
    return previous.unionByName(not_in(new, previous, key))
