"""Operators that turn sales columns into rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pixeltally.functions.cleaning import round4
from pixeltally.operators.cleaning import positive, select_present
from pixeltally.schemas import (
    GAME_COLUMNS, MARKET_LABELS, REGION_SEED, SALES_COLUMNS, SALES_REGIONS, UNKNOWN,
)


def _literal_map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def region_code(sales_column: Column) -> Column:
    return F.element_at(_literal_map(SALES_REGIONS), sales_column)


def add_region_attributes(df: DataFrame, code: str = "region_code") -> DataFrame:
    """Label and continent of a region code; an unknown code labels itself.

    The five regions are literals of the plan, so no join is needed.
    """
    labels = _literal_map({row[0]: row[1] for row in REGION_SEED})
    continents = _literal_map({row[0]: row[2] for row in REGION_SEED})
    return df.withColumns({
        "region_label": F.coalesce(F.element_at(labels, F.col(code)), F.col(code)),
        "continent": F.coalesce(F.element_at(continents, F.col(code)), F.lit(UNKNOWN)),
    })


def melt_sales(df: DataFrame, kept: Sequence[str]) -> DataFrame:
    """One row per input row and sales column with a positive value; no shuffle."""
    present = [c for c in SALES_COLUMNS if c in df.columns]
    cells = df.select(*kept, *[F.col(c).cast("double").alias(c) for c in present])
    long = cells.unpivot(list(kept), present, "_column", "_value")
    return (
        long.filter(positive("_value"))
        .withColumn("region_code", region_code(F.col("_column")))
        .withColumn("sales_millions", round4(F.col("_value")))
        .drop("_column", "_value"))


def unpivot_sales(df: DataFrame) -> DataFrame:
    """The long sales table: game columns, region and sales of each positive cell."""
    kept = select_present(df, GAME_COLUMNS).columns
    return (
        melt_sales(df, kept)
        .transform(add_region_attributes)
        .select(*kept, "region_code", "region_label", "continent", "sales_millions"))


def region_share(df: DataFrame) -> DataFrame:
    """Total of each sales column, and its share of them all in percent."""
    totals = df.agg(*[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in SALES_COLUMNS])
    everything = F.sum("total_sales_m").over(Window.partitionBy())
    return (
        totals.unpivot([], SALES_COLUMNS, "sales_column", "total_sales_m")
        .withColumn("region", F.element_at(_literal_map(MARKET_LABELS), F.col("sales_column")))
        .withColumn("share_pct", F.try_divide(100.0 * F.col("total_sales_m"), everything)))
