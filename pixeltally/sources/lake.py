"""The Parquet lake, partitioned by continent and year, and within a folder clustered where that is asked for.

Clustered rows follow a Z-curve of some columns, so each file has a narrow range of all of them. A zone
map beside the lake has the least and the greatest value of each file, and a selective read opens the
files whose ranges its conditions meet.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pixeltally.sources.files import refuse_own_input

PARTITIONS = ["continent", "year"]

# Spark reads no folder whose name begins with an underscore as data.
ZONES = "_zones"

# A column is cut into 2**CURVE_BITS ranges, 2**HALF_BITS of which are found first.
HALF_BITS = 3
CURVE_BITS = 2 * HALF_BITS
SAMPLED_VALUES = 4096

NO_KEY = "continent IS NULL OR release_year IS NULL"


def rows_without_partition(long: DataFrame) -> DataFrame:
    """How many rows the lake leaves out."""
    return long.agg(F.count_if(F.expr(NO_KEY)).alias("row_count"))


def _bounds(rows: DataFrame, column: str) -> list:
    """Values that cut the column's different values into ranges of about as many each, from a bounded sample by hash."""
    different = rows.select(F.col(column).alias("v")).filter(F.col("v").isNotNull()).distinct()
    sample = sorted(row[0] for row in different.orderBy(F.xxhash64("v"), "v").limit(SAMPLED_VALUES).collect())
    ranges = 1 << CURVE_BITS
    return [sample[len(sample) * k // ranges] for k in range(1, ranges)] if sample else []


def _range_of(column: str, bounds: list) -> Column:
    """The number of the range that a value is in, first among each eighth bound and then among the seven before the next."""
    if not bounds:
        return F.lit(0)
    step = 1 << HALF_BITS
    reached = lambda values: F.size(F.filter(values, lambda bound: bound <= F.col(column)))
    first = reached(F.lit(bounds[step - 1::step]))
    rest = reached(F.slice(F.lit(bounds), (first * step + 1).cast("int"), F.lit(step - 1)))
    return F.coalesce(first * step + rest, F.lit(0))


def z_value(rows: DataFrame, columns: Sequence[str]) -> Column:
    """The place of a row on a Z-curve: the bits of its columns' ranges in turn, the highest first."""
    ranges = [_range_of(column, _bounds(rows, column)) for column in columns]
    bits = [
        F.shiftleft(F.shiftright(number, bit).bitwiseAND(1), bit * len(columns) + place)
        for place, number in enumerate(reversed(ranges)) for bit in range(CURVE_BITS)]
    return reduce(lambda a, b: a + b, bits)


def write_lake(long: DataFrame, path: str, keep_null: bool = False, cluster: Sequence[str] = ()) -> None:
    """Write long sales by continent and release year.

    Rows without continent or year are left out unless ``keep_null`` is set; see
    ``rows_without_partition``. Only partitions that occur in ``long`` are replaced.
    Rows are rebalanced on the partition columns first: few files per partition, and
    a partition that holds a large share of the rows is split over tasks. The path
    may be any Hadoop URI.

    With ``cluster`` the rows of a folder are in order of a Z-curve of those columns, and the zone map is
    written; ``long`` should then be a stored table, since it is read for the bounds and for the ranges of tasks too.
    Equal places on the curve are told apart by a hash of the row, so a frequent one is split over tasks.
    """
    # The release year stays in the data files; the folder's year is a copy of it.
    rows = (long if keep_null else long.filter(f"NOT ({NO_KEY})")).withColumn("year", F.col("release_year"))
    data = [c for c in rows.columns if c not in PARTITIONS]
    rows = rows.select(*data, F.col("continent"), F.col("year"))
    if cluster:
        order = [*PARTITIONS, "_z", "_tie"]
        tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        placed = rows.withColumns({"_z": z_value(rows, cluster), "_tie": F.xxhash64(*data)})
        rows = placed.repartitionByRange(tasks, *order).sortWithinPartitions(*order).drop("_z", "_tie")
    else:
        rows = rows.hint("rebalance", *PARTITIONS)
    (
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITIONS).parquet(path))
    if cluster:
        # The schema is known, so an empty lake can be read as well.
        _write_zones(rows.sparkSession.read.schema(rows.schema).parquet(path), path, cluster)


def zones_of(lake: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each file with its rows and the least and greatest value of the columns; those columns alone are read."""
    bounds = [f(c).alias(f"{name}_{c}") for c in columns for name, f in (("least", F.min), ("most", F.max))]
    return lake.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("row_count"), *bounds)


def write_zones(spark: SparkSession, path: str, columns: Sequence[str]) -> None:
    """Write the zone map of the lake as it is now, in place of an earlier one."""
    _write_zones(read_lake(spark, path), path, columns)


def _write_zones(lake: DataFrame, path: str, columns: Sequence[str]) -> None:
    zones_of(lake, columns).write.mode("overwrite").parquet(f"{path}/{ZONES}")


def files_that_may_hold(spark: SparkSession, path: str, conditions: Mapping[str, object]) -> DataFrame:
    """The lake's files whose zones the conditions meet, and those that the zone map doesn't know (yet)."""
    listed = manifest(spark, path).filter(~F.col("path").contains(f"/{ZONES}/")).select("path")
    try:
        zones = spark.read.parquet(f"{path}/{ZONES}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return listed
    meets = F.lit(True)
    for column, (low, high) in _ranges(conditions).items():
        if f"least_{column}" in zones.columns:
            # A file without a value of the column has null bounds and meets nothing.
            within = (F.col(f"most_{column}") >= low) & (F.col(f"least_{column}") <= high)
            meets = meets & F.coalesce(within, F.lit(False))
    # A manifest and the metadata of a read may write one path with one slash more.
    plain = lambda name: F.regexp_replace(name, "^([a-z0-9]+):/+", "$1:/")
    known = zones.select(plain("path").alias("_zone"), meets.alias("_meets"))
    return listed.join(known, plain("path") == F.col("_zone"), "left").filter(F.coalesce("_meets", F.lit(True))).select("path")


def _ranges(conditions: Mapping[str, object]) -> dict[str, tuple]:
    return {c: v if isinstance(v, tuple) else (v, v) for c, v in conditions.items()}


def read_where(spark: SparkSession, path: str, conditions: Mapping[str, object]) -> DataFrame:
    """The lake's rows that meet conditions: a value for a column, or its least and greatest as a pair.

    Only files whose zones allow such rows are opened. Files written since the zone map was are read as well,
    and zones of files that are gone are ignored, so the rows are right whatever the zone map's age is.
    """
    every = read_lake(spark, path)
    names = [row[0] for row in files_that_may_hold(spark, path, conditions).collect()]
    rows = spark.read.schema(every.schema).option("basePath", path).parquet(*names) if names else every.limit(0)
    for column, (low, high) in _ranges(conditions).items():
        rows = rows.filter(F.col(column).between(low, high))
    return rows


def read_lake(spark: SparkSession, path: str) -> DataFrame:
    """The lake with its folder names as columns; filters on them skip folders."""
    return spark.read.parquet(path)


def publish(spark: SparkSession, source: str, target: str, partitions: list[str] | None = None) -> DataFrame:
    """Copy a Parquet dataset to another place, for example an object store, keeping its folders.

    Returns the outcome: per folder the rows of the source, those of the target, and whether
    they agree. A folder that only one side has, has 0 rows on the other.
    """
    rows = spark.read.parquet(source)
    refuse_own_input(rows, target)
    partitions = partitions or []
    if partitions:
        rows.hint("rebalance", *partitions).write.mode("overwrite").partitionBy(*partitions).parquet(target)
    else:
        rows.write.mode("overwrite").parquet(target)
    # The target's schema is the source's, so an empty copy can be read as well.
    copied = spark.read.schema(rows.schema).parquet(target)
    sides = rows.select(*partitions, F.lit(1).alias("s"), F.lit(0).alias("t")).unionByName(
        copied.select(*partitions, F.lit(0).alias("s"), F.lit(1).alias("t")))
    counts = sides.groupBy(*partitions).agg(
        F.coalesce(F.sum("s"), F.lit(0)).alias("source_rows"), F.coalesce(F.sum("t"), F.lit(0)).alias("target_rows"))
    return counts.withColumn("complete", F.col("source_rows") == F.col("target_rows"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Path and size of every Parquet file below a folder; file contents are not read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet").load(path))
    return files.select(
        "path", F.col("length").alias("size_bytes"), F.round(F.col("length") / 1024, 1).alias("size_kb"))


def manifest_totals(files: DataFrame) -> DataFrame:
    return files.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.round(F.sum("size_bytes") / 1024 / 1024, 2), F.lit(0.0)).alias("total_mb"))
