"""Ranks within a few large groups, and row numbers over a whole table."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pixeltally.sources.files import stored

# Bands of values that ranks are counted by. A band has about that part of all different values.
BANDS = 1024

# monotonically_increasing_id gives the partition above these bits, and the row in it below.
_ROW_BITS = 33


def _in_ranges(rows: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``rows`` sorted and stored, with ``_part``, the number of the range, and ``_row``, the place in it.

    The ranges are sampled, so they hold about as many rows each however the values are spread.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = stored(ranges.withColumn("_place", F.monotonically_increasing_id()), "ranges")
    return placed.select(
        *rows.columns, F.shiftright("_place", _ROW_BITS).alias("_part"),
        F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_row"))


def number_in_order(rows: DataFrame, order: Sequence[Column], number: str) -> DataFrame:
    """Rows numbered from 1 in a global order, which no task sees whole.

    ``rows`` are read twice, to sample and to sort, so they should be a stored table. The number of
    a row is its place in its range and the sizes of the ranges before: one row per range.
    """
    placed = _in_ranges(rows, order)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")))
    return placed.join(starts, "_part").select(*rows.columns, (F.col("_start") + F.col("_row") + 1).alias(number))


def _value_counts(rows: DataFrame, group: str, value: str) -> DataFrame:
    return rows.groupBy(group, value).agg(F.count(F.lit(1)).alias("_count"))


def bounds_of_bands(values: DataFrame, value: str, bands: int = BANDS) -> list[float]:
    """Ascending values that cut the column into bands of about as many rows each: quantiles, whatever its spread is.

    One pass over ``values``, which should have a row for each different value; at most ``bands`` numbers return.
    """
    numbers = values.select(F.col(value).cast("double").alias("_value"))
    quantiles = numbers.approxQuantile("_value", [k / bands for k in range(1, bands)], 1 / (4 * bands))
    return sorted({q for q in quantiles if math.isfinite(q)})


def _with_band(counts: DataFrame, value: str, bounds: Sequence[float]) -> DataFrame:
    """The band of each value: null for null, the highest for NaN, which Spark puts above all numbers."""
    # Two bands at least: Spark's Bucketizer takes no fewer.
    cut = Bucketizer(splits=[-math.inf, *(bounds or [0.0]), math.inf], inputCol="_number", outputCol="_band", handleInvalid="keep")
    banded = cut.transform(counts.withColumn("_number", F.col(value).cast("double")))
    return banded.withColumn("_band", F.when(F.col(value).isNotNull(), F.col("_band"))).drop("_number")


def rank_of_values(rows: DataFrame, group: str, value: str, rank: str, store: bool = False) -> DataFrame:
    """The descending rank of each different value in its group: (group, value, rank), nulls first.

    A window over the group would bring a third of all rows to one task. Instead
    equal values are counted (mostly before the shuffle), and the rank is one plus
    the counts of the higher bands plus the counts of the higher values in the band. The bounds of the bands
    are quantiles of the values as they are now; any bounds give right ranks, so a view may go on with
    them when its rows change. With ``store`` the counts are stored first, for they are read again.
    """
    counts = _value_counts(rows, group, value)
    if store:
        counts = stored(counts, "values")
    counts = _with_band(counts, value, bounds_of_bands(counts, value))
    bands = counts.groupBy(group, "_band").agg(F.sum("_count").alias("_count"))
    higher_bands = (
        Window.partitionBy(group).orderBy(F.desc_nulls_first("_band"))
        .rowsBetween(Window.unboundedPreceding, -1))
    higher_values = (
        Window.partitionBy(group, "_band").orderBy(F.desc_nulls_first(value))
        .rowsBetween(Window.unboundedPreceding, -1))
    starts = bands.select(
        F.col(group).alias("_group"), F.col("_band").alias("_start_band"),
        F.coalesce(F.sum("_count").over(higher_bands), F.lit(0)).alias("_start"))
    return (
        counts.withColumn("_within", F.coalesce(F.sum("_count").over(higher_values), F.lit(0)))
        .join(starts, (F.col(group) == F.col("_group")) & F.col("_band").eqNullSafe(F.col("_start_band")))
        .select(group, value, (F.col("_start") + F.col("_within") + 1).alias(rank)))


def top_ranks_of_values(rows: DataFrame, group: str, value: str, rank: str, k: int) -> DataFrame:
    """``rank_of_values`` for ranks up to ``k`` only: at most ``k`` rows per group.

    Values are unique per group here, so the row-number limit cuts every task's rows
    to ``k`` per group before the shuffle.
    """
    highest_first = Window.partitionBy(group).orderBy(F.desc_nulls_first(value))
    higher = highest_first.rowsBetween(Window.unboundedPreceding, -1)
    return (
        _value_counts(rows, group, value)
        .withColumn("_position", F.row_number().over(highest_first))
        .filter(F.col("_position") <= k)
        .withColumn(rank, F.coalesce(F.sum("_count").over(higher), F.lit(0)) + 1)
        .filter(F.col(rank) <= k)
        .select(group, value, rank))


def _attach(rows: DataFrame, ranks: DataFrame, group: str, value: str) -> DataFrame:
    renamed = ranks.withColumnsRenamed({group: "_group", value: "_value"})
    same = (F.col(group) == F.col("_group")) & F.col(value).eqNullSafe(F.col("_value"))
    return rows.join(renamed, same).drop("_group", "_value")


def with_rank(rows: DataFrame, group: str, value: str, rank: str, ranks: DataFrame | None = None) -> DataFrame:
    """Add the rank of ``value`` within ``group``, highest first; ties share a rank and leave a gap.

    ``ranks`` are the ``rank_of_values`` where a caller has stored them. They are far
    fewer than the rows, and stored ones have a known size: where it allows, Spark
    broadcasts them and the rows are not shuffled at all. Otherwise the rank side has
    one row per key, so Spark's skew-join handling can split a frequent value.
    """
    if ranks is None:
        ranks = rank_of_values(rows, group, value, rank)
    return _attach(rows, ranks, group, value)


def top_k(rows: DataFrame, group: str, value: str, rank: str, k: int) -> DataFrame:
    """Rows ranked ``k`` or better in their group, ties included.

    The ranks to join are at most ``k`` rows per group; Spark broadcasts them where that is small.
    """
    return _attach(rows, top_ranks_of_values(rows, group, value, rank, k), group, value)
