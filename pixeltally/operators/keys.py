"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Hex digits of the key hash that choose a bucket: at most 16**4 = 65,536 buckets.
BUCKET_DIGITS = 4


def assign_ids(rows: DataFrame, key: str, id_column: str, existing: DataFrame | None = None) -> DataFrame:
    """Number the rows, whose ``key`` must be unique, without gaps after the ids in ``existing``.

    A plain ``row_number`` would bring all rows to one task. Here the key's hash
    chooses one of 65,536 even buckets; rows are numbered within their bucket, and a
    running total over the bucket sizes (never more than 65,537 small rows, hence
    the broadcast) tells where each bucket starts. The result depends on the keys only,
    so a task that is run again gives the same ids.
    """
    bucketed = rows.withColumn("_bucket", F.substring(F.md5(F.col(key)), 1, BUCKET_DIGITS))
    sizes = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    if existing is not None:
        taken = existing.agg(F.lit("").alias("_bucket"), F.coalesce(F.max(id_column), F.lit(0)).cast("long").alias("_size"))
        sizes = taken.unionByName(sizes)
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    numbered = bucketed.withColumn("_within", within).join(F.broadcast(starts), "_bucket")
    ids = (F.col("_start") + F.col("_within")).cast("long").alias(id_column)
    return numbered.select(ids, *rows.columns)
