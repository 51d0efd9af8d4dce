"""Data-quality checks: each gives rows to read, none stops a pipeline."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _labelled_counts(df: DataFrame, counts: dict[str, Column], label: str, value: str) -> DataFrame:
    """One pass over ``df``; one row per count."""
    names = [f"`{name}`" for name in counts]
    return df.agg(*[c.alias(n) for n, c in counts.items()]).unpivot([], names, label, value)


def quality_checks(fact: DataFrame, dim_game: DataFrame) -> DataFrame:
    """Counts after a load, what is expected of each (``>0`` or ``=0``), and whether it holds."""
    observed = _union([
        _labelled_counts(fact, {
            "fact_sales_not_empty": F.count(F.lit(1)),
            "null_sales": F.count_if(F.col("sales_millions").isNull()),
            "fact_without_region": F.count_if(F.col("region_id").isNull()),
        }, "check", "observed"),
        _labelled_counts(dim_game, {"dim_game_not_empty": F.count(F.lit(1))}, "check", "observed"),
    ])
    filled = F.col("check").endswith("_not_empty")
    return observed.select(
        "check", "observed",
        F.when(filled, ">0").otherwise("=0").alias("expectation"),
        F.when(filled, F.col("observed") > 0).otherwise(F.col("observed") == 0).alias("passed"))


def check_unique(df: DataFrame, keys: Sequence[str], constraint: str) -> DataFrame:
    """How many keys occur more than once, in how many rows; keys with a null are exempt, as in SQL."""
    repeated = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return repeated.agg(
        F.count(F.lit(1)).alias("duplicate_keys"), F.coalesce(F.sum("_n"), F.lit(0)).alias("duplicate_rows"),
    ).select(F.lit(constraint).alias("constraint"), "duplicate_keys", "duplicate_rows")


def check_star_unique(star: dict[str, DataFrame]) -> DataFrame:
    keys = {
        "dim_game": ["title", "publisher"], "dim_platform": ["platform_code"], "dim_genre": ["genre_name"],
        "dim_region": ["region_code"], "dim_date": ["date_id"],
    }
    return _union([check_unique(star[t], k, f"{t}({','.join(k)})") for t, k in keys.items() if t in star])


def check_orphans(fact: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    """Fact rows whose key is in no dimension row, per key; null keys are exempt, as in SQL.

    Rows are counted per key before the join, so a frequent key is one row in it.
    """
    def orphans(key: str, dimension: DataFrame) -> DataFrame:
        used = fact.dropna(subset=[key]).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        lost = used.join(dimension.select(key), key, "left_anti").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("orphan_rows"))
        return lost.select(F.lit(f"fact_sales.{key}").alias("constraint"), "orphan_rows")

    return _union([orphans(key, dimension) for key, dimension in dimensions.items()])


def check_domain(df: DataFrame, table: str, not_null: Sequence[str] = (), domains: dict[str, list] | None = None) -> DataFrame:
    """Rows that break a NOT NULL or an allowed-values rule, per rule, in one pass."""
    rules = {f"{table}.{c} not null": F.count_if(F.col(c).isNull()) for c in not_null}
    for column, allowed in (domains or {}).items():
        rules[f"{table}.{column} in domain"] = F.count_if(~F.col(column).isin(allowed))
    return _labelled_counts(df, rules, "rule", "violations")


def stage_metrics(raw: DataFrame, clean: DataFrame, long: DataFrame, key: str = "title") -> DataFrame:
    """Rows read, rows without a key, duplicates removed, rows after cleaning and after the unpivot.

    Counts only, so ``clean`` should be a stored table: what cleaning left out follows from them.
    """
    none = F.lit(0).cast("long")
    counts = _union([
        raw.agg(F.count(F.lit(1)).alias("rows_read"), F.count_if(F.col(key).isNull()).alias("rows_without_key"),
                none.alias("rows_after_clean"), none.alias("rows_after_unpivot")),
        clean.agg(none.alias("rows_read"), none.alias("rows_without_key"),
                  F.count(F.lit(1)).alias("rows_after_clean"), none.alias("rows_after_unpivot")),
        long.agg(none.alias("rows_read"), none.alias("rows_without_key"), none.alias("rows_after_clean"),
                 F.count(F.lit(1)).alias("rows_after_unpivot")),
    ])
    names = ["rows_read", "rows_without_key", "rows_after_clean", "rows_after_unpivot"]
    total = counts.agg(*[F.sum(name).alias(name) for name in names])
    removed = F.col("rows_read") - F.col("rows_without_key") - F.col("rows_after_clean")
    names.insert(2, "duplicates_removed")
    return total.withColumn("duplicates_removed", removed).unpivot([], names, "stage", "rows")


def metrics_of(spark: SparkSession, read: int, without_key: int, clean: int, unpivoted: int) -> DataFrame:
    """``stage_metrics`` from counts that are known, as those of observed writes."""
    rows = {"rows_read": read, "rows_without_key": without_key, "duplicates_removed": read - without_key - clean,
            "rows_after_clean": clean, "rows_after_unpivot": unpivoted}
    return spark.createDataFrame(list(rows.items()), "stage string, rows long")


def load_progress(prepared: DataFrame, loaded: DataFrame) -> DataFrame:
    """How many of the prepared rows a table holds, in percent."""
    counts = _union([
        prepared.agg(F.count(F.lit(1)).alias("prepared"), F.lit(0).cast("long").alias("loaded")),
        loaded.agg(F.lit(0).cast("long").alias("prepared"), F.count(F.lit(1)).alias("loaded")),
    ]).agg(F.sum("prepared").alias("prepared"), F.sum("loaded").alias("loaded"))
    return counts.withColumn("percent_loaded", F.try_divide(100.0 * F.col("loaded"), F.col("prepared")))
