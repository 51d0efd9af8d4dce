"""Operators that bring a raw wide sales table into its clean form."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pixeltally.functions.cleaning import (
    DATE_FORMATS, DATE_SHAPES, na_to_null, release_year, to_number, truncate, years_by_form)
from pixeltally.schemas import NUMERIC_COLUMNS, UNKNOWN


def normalized_name(name: str) -> str:
    return re.sub(r"\W", "_", name.strip().lower())


def normalize_columns(df: DataFrame) -> DataFrame:
    """Lower-case column names with every other character as an underscore."""
    names = [normalized_name(name) for name in df.columns]
    twice = sorted({name for name in names if names.count(name) > 1})
    if twice:
        raise ValueError(f"columns share a name after normalisation: {twice}")
    return df.toDF(*names)


def nullify_na_tokens(df: DataFrame) -> DataFrame:
    """Null for missing-value texts, in every string column."""
    texts = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    return df.select(*[
        na_to_null(F.col(f"`{c}`")).alias(c) if c in texts else F.col(f"`{c}`") for c in df.columns])


def conform(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add the listed columns that are missing, as nulls of the given type."""
    missing = {c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def select_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in columns if c in df.columns])


def coerce_numeric(df: DataFrame, columns: Sequence[str] = NUMERIC_COLUMNS) -> DataFrame:
    """Doubles in the listed columns that exist; text that is no number becomes null."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: to_number(F.col(c), df.schema[c].dataType) for c in present}) if present else df


# The years that each form of dates reads, until one form is elected.
YEARS = "_years"


def add_release_year(df: DataFrame, formats: Sequence[str] | None = DATE_FORMATS) -> DataFrame:
    """The year of the release date, by the given forms; without any, what ``elect_year`` chooses from."""
    if "release_date" not in df.columns:
        return conform(df, {"release_year": "int"})
    if formats is None and isinstance(df.schema["release_date"].dataType, T.StringType):
        return df.withColumn(YEARS, years_by_form(F.col("release_date")))
    formats = formats or DATE_FORMATS
    return df.withColumn("release_year", release_year(F.col("release_date"), df.schema["release_date"].dataType, formats))


def elect_form(df: DataFrame) -> int | None:
    """The number of the form that reads most dates, of equal ones the first; null if there is no date.

    Dates that no form reads at all are an error. One aggregate over the years that the forms have read, so
    ``df`` should be a stored table.
    """
    counts = [F.count(F.col(YEARS)[n]).alias(f"n{n}") for n in range(len(DATE_SHAPES))]
    dated, *read = df.agg(F.count("release_date").alias("dated"), *counts).first()
    if dated and not any(read):
        raise ValueError(f"none of {dated} dates in release_date has one of the forms {list(DATE_SHAPES)}")
    return read.index(max(read)) if dated else None


def elect_year(df: DataFrame) -> DataFrame:
    """The release year as the form that fits the column reads it; dates in other forms get none.

    A column is in one form, as a file is: which of them a single date is in often can't be told, but
    a day over 12 anywhere tells months from days for all.
    """
    if YEARS not in df.columns:
        return df
    form = elect_form(df)
    year = F.lit(None).cast("int") if form is None else F.col(YEARS)[form]
    return df.withColumn("release_year", year).drop(YEARS)


def fill_defaults(df: DataFrame) -> DataFrame:
    """Platform from ``console`` if that column exists, else from ``platform``; no null platform or genre.

    The choice is by column, not by row: a null console is unknown even beside a known platform.
    """
    source = next((c for c in ("console", "platform") if c in df.columns), None)
    platform = F.coalesce(F.col(source), F.lit(UNKNOWN)) if source else F.lit(UNKNOWN)
    genre = F.coalesce(F.col("genre"), F.lit(UNKNOWN)) if "genre" in df.columns else F.lit(UNKNOWN)
    return df.withColumns({"platform": platform, "genre": genre})


def drop_null_key(df: DataFrame, key: str = "title") -> DataFrame:
    return df.dropna(subset=[key])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key by ``order``; null keys equal each other.

    Spark cuts each task's rows to one per key before the shuffle (a window group
    limit), so a key that holds a large share of all rows sends one row per task.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")


def truncate_texts(df: DataFrame, widths: Mapping[str, int]) -> DataFrame:
    """Cut the listed columns that exist to their widths: a step of an export to a target that has widths.

    Cut keys can meet, so this comes last, after rows are compared and joined.
    """
    present = {c: truncate(F.col(c), width) for c, width in widths.items() if c in df.columns}
    return df.withColumns(present) if present else df


def any_null(columns: Sequence[str]) -> Column:
    condition = F.lit(False)
    for name in columns:
        condition = condition | F.col(name).isNull()
    return condition


def positive(column: str) -> Column:
    """Not null, not NaN and above zero."""
    return (F.col(column) > 0) & ~F.isnan(F.col(column))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).dropna().distinct()


def clean_sales(
    df: DataFrame, order: Sequence[str], keys: Sequence[str] = ("title", "release_date"),
    formats: Sequence[str] | None = DATE_FORMATS,
) -> DataFrame:
    """The clean wide table of a raw one: one row per key, typed, with year, platform and genre."""
    named = normalize_columns(df)
    return (
        drop_null_key(named)
        .transform(keep_first, [k for k in keys if k in named.columns], order)
        .transform(coerce_numeric)
        .transform(add_release_year, formats)
        .transform(fill_defaults))


def clean_for_warehouse(df: DataFrame, order: Sequence[str], formats: Sequence[str] | None = DATE_FORMATS) -> DataFrame:
    """The wide table as the warehouse takes it: one row per title, the whole of which is its key."""
    return (
        normalize_columns(df)
        .transform(drop_null_key)
        .transform(keep_first, ["title"], order)
        .transform(conform, {"publisher": "string", "developer": "string", "critic_score": "double",
                             "user_score": "double", "total_sales": "double"})
        .transform(coerce_numeric)
        .transform(add_release_year, formats)
        .transform(fill_defaults))
