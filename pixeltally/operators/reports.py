"""Reports over the wide and the long sales table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixeltally.functions.cleaning import release_year
from pixeltally.schemas import SALES_COLUMNS


def totals_by(df: DataFrame, key: str, measure: str = "total_sales") -> DataFrame:
    """Sum per key; null keys are left out, and a key with only nulls sums to zero."""
    return (
        df.filter(F.col(key).isNotNull()).groupBy(key)
        .agg(F.coalesce(F.sum(measure), F.lit(0.0)).alias(measure)))


def top_totals(df: DataFrame, key: str, k: int = 10, measure: str = "total_sales") -> DataFrame:
    """The ``k`` keys with the largest sums, largest first; ties by key."""
    return totals_by(df, key, measure).orderBy(F.desc(measure), key).limit(k)


def yearly_totals(df: DataFrame, first: int, last: int) -> DataFrame:
    """Sales by release year, first and last year included."""
    year = release_year(F.col("release_date"), df.schema["release_date"].dataType)
    years = df.select(year.alias("release_year"), "total_sales")
    return totals_by(years.filter(F.col("release_year").between(first, last)), "release_year")


def sales_by_continent(long: DataFrame) -> DataFrame:
    return totals_by(long, "continent", "sales_millions").orderBy(F.desc("sales_millions"), "continent")


def dataset_summary(long: DataFrame) -> DataFrame:
    """Rows, distinct titles, platforms, genres and continents, and the span of years.

    Rows are counted per title, the one large column; of the small ones only the combinations
    that occur are left after each task's own grouping. Two column-pruned scans, so ``long``
    should be a stored table.
    """
    titles = long.groupBy("title").agg(
        F.count(F.lit(1)).alias("n"), F.min("release_year").alias("first"), F.max("release_year").alias("last"))
    totals = titles.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"), F.count("title").alias("distinct_titles"),
        F.min("first").alias("min_year"), F.max("last").alias("max_year"))
    small = ["platform", "genre", "continent"]
    kinds = long.select(*small).distinct().agg(*[F.countDistinct(c).alias(f"distinct_{c}s") for c in small])
    names = ["total_rows", "distinct_titles", *[f"distinct_{c}s" for c in small], "min_year", "max_year"]
    both = totals.unionByName(kinds, allowMissingColumns=True)
    return both.agg(*[F.max(name).alias(name) for name in names])


def distinct_counts(df: DataFrame, columns: Sequence[str] = ("title", "console", "genre", "publisher")) -> DataFrame:
    """Number of different values per column, nulls not counted."""
    return df.agg(*[F.countDistinct(c).alias(f"distinct_{c}s") for c in columns])


# A sketch keeps 2**LG_K registers of a column, whatever the number of rows is.
LG_K = 12


def distinct_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), lg_k: int = LG_K) -> DataFrame:
    """A sketch of the different values of each column, per group: a few KB each, to be kept and merged."""
    return df.groupBy(*by).agg(*[F.hll_sketch_agg(c, F.lit(lg_k)).alias(c) for c in columns])


def merge_sketches(sketches: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """The sketches of coarser groups, or of several tables put together, from those of finer ones."""
    return sketches.groupBy(*by).agg(*[F.hll_union_agg(c).alias(c) for c in columns])


def sketched_counts(sketches: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """About how many different values each column has; nulls are not counted."""
    return sketches.select(*by, *[F.hll_sketch_estimate(c).alias(f"distinct_{c}s") for c in columns])


def sketch_error(lg_k: int = LG_K) -> float:
    """The relative error of a merged sketch that is exceeded in one of some hundred cases: three standard errors."""
    return 3 * 1.04 / 2 ** (lg_k / 2)


def totals_by_each(df: DataFrame, keys: Sequence[str], measure: str = "sales_millions") -> DataFrame:
    """The sums of each key's values, of all keys in one scan: ``dimension, value, measure``, and a row for the whole.

    Nulls of a key are left out; a value with only null measures sums to zero.
    """
    grouped = df.groupingSets([*[[k] for k in keys], []], *keys).agg(
        F.coalesce(F.sum(measure), F.lit(0.0)).alias(measure), F.grouping_id().alias("_set"))
    # The bits of the set tell which key it is about, the first key in the highest; in the whole, all are set.
    every = 2 ** len(keys) - 1
    named = F.lit("all")
    value = F.lit(None).cast("string")
    for n, key in enumerate(reversed(keys)):
        is_its_set = F.col("_set") == every - 2 ** n
        named = F.when(is_its_set, F.lit(key)).otherwise(named)
        value = F.when(is_its_set, F.col(key).cast("string")).otherwise(value)
    found = grouped.select(named.alias("dimension"), value.alias("value"), measure)
    return found.filter((F.col("dimension") == "all") | F.col("value").isNotNull())


def match_rate(df: DataFrame) -> DataFrame:
    """How many rows the catalogue enriched, and their share in percent (null for no rows)."""
    matched = F.count_if(F.col("data_source").contains("rawg"))
    return df.agg(
        F.count(F.lit(1)).alias("total"), matched.alias("matched"),
        F.try_divide(100.0 * matched, F.count(F.lit(1))).alias("match_rate_pct"))


def null_profile(df: DataFrame, columns: Sequence[str] = SALES_COLUMNS) -> DataFrame:
    """Nulls per column, and their share of all rows; one pass."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return (
        counts.unpivot(["_rows"], list(columns), "column_name", "null_count")
        .select("column_name", "null_count", F.try_divide("null_count", "_rows").alias("null_ratio")))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; nulls are left out."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.orderBy(F.desc("row_count"), column)
