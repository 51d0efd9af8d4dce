"""From a raw CSV to the long sales table and the partitioned lake."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pixeltally.functions.cleaning import DATE_FORMATS, DATE_SHAPES
from pixeltally.operators.cleaning import add_release_year, clean_sales, elect_form, normalize_columns
from pixeltally.operators.joins import enrich_by_title
from pixeltally.operators.quality import metrics_of
from pixeltally.operators.reports import dataset_summary, sales_by_continent
from pixeltally.operators.reshape import unpivot_sales
from pixeltally.plans.enrichment import distinct_titles, title_details
from pixeltally.session import require_settings, scratch_scope
from pixeltally.sources.files import FILE_ORDER, read_csv, read_parquet, stored, write_parquet
from pixeltally.sources.lake import NO_KEY, write_lake


@dataclass
class Staged:
    """What a staging run wrote (the raw copy, the clean table, the long table and the lake), and reports on it."""

    raw: DataFrame
    clean: DataFrame
    long: DataFrame
    lake_path: str
    rows_without_partition: DataFrame
    summary: DataFrame
    continents: DataFrame
    metrics: DataFrame


def stage_sales(
    spark: SparkSession, csv_path: str, root: str, responses: DataFrame | None = None,
    multi_line: bool | None = False, formats: Sequence[str] | None = None,
) -> Staged:
    """Copy the CSV to Parquet, clean and unpivot it, and write the long table and the lake below ``root``.

    Each step reads what the one before wrote, so the CSV is parsed once and rows are
    de-duplicated once. The raw copy has one column more than the CSV, the input order.
    With catalogue ``responses`` the long table gains the details of all titles. ``formats``
    are the forms of dates; without any, the form that reads most dates of the raw copy is elected. If no row has
    a date in one of them, it raises, since the lake would stay empty.

    The writes count their rows as they go, so the metrics and the check of dates need no scan. They count
    at the end of a write, where a task that is repeated counts once.
    """
    require_settings(spark)
    raw_path, clean_path, staged_path, lake_path = f"{root}/raw", f"{root}/clean", f"{root}/staged", f"{root}/partitioned"
    read, kept, out = Observation("raw"), Observation("clean"), Observation("staged")
    rows = F.count(F.lit(1)).alias("rows")
    source = read_csv(spark, csv_path, multi_line, file_order=True)
    write_parquet(source.observe(read, rows, F.count_if(F.col(f"`{_title(source)}`").isNull()).alias("without_key")), raw_path)
    raw = read_parquet(spark, raw_path)
    if formats is None:
        formats = _elected(raw)
    write_parquet(clean_sales(raw, [FILE_ORDER], formats=formats).observe(kept, rows), clean_path)
    clean = read_parquet(spark, clean_path).drop(FILE_ORDER)
    long = unpivot_sales(clean)
    with scratch_scope(spark):
        if responses is not None:
            long = enrich_by_title(long, stored(title_details(responses, distinct_titles(clean)), "details"))
        write_parquet(long.observe(out, rows, F.count_if(F.expr(NO_KEY)).alias("left_out")), staged_path)
    staged = read_parquet(spark, staged_path)
    seen = out.get
    if seen["rows"] and seen["rows"] == seen["left_out"]:
        raise ValueError(f"none of {seen['rows']} rows has a continent and a date in one of the forms {list(formats)}")
    write_lake(staged, lake_path)
    return Staged(
        raw.drop(FILE_ORDER), clean, staged, lake_path, spark.createDataFrame([(seen["left_out"],)], "row_count long"),
        dataset_summary(staged), sales_by_continent(staged),
        metrics_of(spark, read.get["rows"], read.get["without_key"], kept.get["rows"], seen["rows"]))


def _elected(raw: DataFrame) -> Sequence[str]:
    """The form of the raw copy's dates; the ISO one where there are none to elect by."""
    named = normalize_columns(raw.drop(FILE_ORDER))
    if "release_date" not in named.columns:
        return DATE_FORMATS
    try:
        form = elect_form(add_release_year(named.select("release_date"), None))
    except ValueError as error:
        raise ValueError(f"{error}; name the form with formats") from error
    return DATE_FORMATS if form is None else [list(DATE_SHAPES)[form]]


def _title(raw: DataFrame) -> str:
    """The raw name of the title column."""
    return next(c for c in raw.columns if c.strip().lower() == "title")
