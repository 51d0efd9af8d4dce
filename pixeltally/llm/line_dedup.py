"""Line de-duplication by site-relative frequency.

Pages are grouped by host. A line is boilerplate of a host if the pages of the host that
contain it are more than a given share of all its pages, and it is dropped from them. Copies of a page are one
page in these counts: they repeat a text, not a template, and their lines are no boilerplate for it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pixeltally.llm.common import stored

# Between the shares of plain boilerplate, from 8.6% of a source's documents up, and of other lines,
# at most 4.8%: three standard errors or more from either mean on a host of 500 pages.
RATIO = 0.0625
# On two pages a repeat can't be told from an edited copy of the page.
LEAST_PAGES = 3
NEWLINE = "\n"


def _digest(line: Column) -> Column:
    return F.unhex(F.md5(line.cast("binary")))


def boilerplate(docs: DataFrame, text: str, host: str, ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``host, line`` (as an MD5 digest), for lines on at least ``least_pages`` and over ``ratio`` of a host's different pages."""
    pages = docs.select(F.col(host).alias("host"), F.col(text).alias("text")).distinct()
    lines = pages.select("host", F.explode(F.array_distinct(F.split("text", NEWLINE))).alias("line"))
    pages = pages.groupBy("host").agg(F.count("*").alias("host_pages"))
    counts = (
        lines.filter(F.trim("line") != "").groupBy("host", _digest(F.col("line")).alias("line"))
        .agg(F.count("*").alias("pages")).filter(F.col("pages") >= least_pages)).alias("c")
    return (
        counts.join(pages.withColumnRenamed("host", "h"), F.col("host").eqNullSafe(F.col("h")))
        .filter(F.col("pages") > F.lit(ratio) * F.col("host_pages"))
        .select("host", "line"))


def drop_boilerplate(
    docs: DataFrame, text: str = "text", host: str = "source", doc_id: str = "doc_id",
    ratio: float = RATIO, least_pages: int = LEAST_PAGES, carry: Sequence[str] = (),
) -> DataFrame:
    """One row per document: ``doc_id, host, n_lines, n_removed, text`` and the columns in ``carry``.

    ``text`` is what stays, its lines joined as they were. A null text stays null and has no
    lines, though its page counts for the host; an empty text has one, empty line. Lines of white
    space are never boilerplate. A line counts once per page however often it stands there, and
    all its places go. Null hosts are one host. Equal texts of a host are one page, which all of them
    follow. With fewer than ``least_pages`` different pages a host loses nothing. An empty table gives an empty result.

    Counts are combined before the shuffle, so a line that every page has sends one row per task.
    A host has fewer boilerplate lines than its mean number of distinct lines divided by
    ``ratio``, so they are one row per host, by digest; pages meet it in a join that Spark
    broadcasts if there are few hosts and whose large partitions it splits if there are many.
    """
    found = stored(
        boilerplate(docs, text, host, ratio, least_pages).groupBy(F.col("host").alias("its_host"))
        .agg(F.collect_set("line").alias("drop")), "boilerplate")
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(host).alias("host"), F.split(text, NEWLINE).alias("lines"),
        F.struct(F.lit(0).alias("no_column"), *carry).alias("carry"))
    rows = rows.join(found, F.col("host").eqNullSafe(F.col("its_host")), "left")
    kept = F.when(F.col("drop").isNull(), F.col("lines")).otherwise(
        F.filter("lines", lambda line: ~F.array_contains(F.col("drop"), _digest(line))))
    return rows.withColumn("kept", kept).select(
        "doc_id", "host", F.greatest(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("lines") - F.size("kept"), F.lit(0)).cast("long").alias("n_removed"),
        F.array_join("kept", NEWLINE).alias("text"), *[F.col("carry")[name].alias(name) for name in carry])
