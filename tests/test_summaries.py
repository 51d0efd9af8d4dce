"""Sketches, totals in one scan, and counts that writes make."""

import pytest
from pyspark.sql import functions as F

from pixeltally.operators import quality, reports
from pixeltally.plans.staging import stage_sales
from pixeltally.sources.files import stored


@pytest.fixture(scope="module")
def many(spark):
    df = spark.range(120_000).select(
        (F.col("id") % 5).alias("part"), F.concat(F.lit("t"), (F.col("id") * 7919 % 50_021).cast("string")).alias("title"),
        (F.col("id") % 9).alias("kind"), F.when(F.col("id") % 3 == 0, F.col("id") % 700).alias("some"))
    return stored(df, "many")


def test_sketches_merge(many):
    columns = ["title", "kind", "some"]
    exact = many.agg(*[F.countDistinct(c) for c in columns]).first()
    parts = reports.distinct_sketches(many, columns, ["part"])
    once = reports.sketched_counts(reports.merge_sketches(parts, columns), columns).first()
    # Merged once more, with themselves: a sketch counts a value once.
    again = reports.sketched_counts(reports.merge_sketches(parts.unionByName(parts), columns), columns).first()
    assert all(abs(a - b) <= 0.01 * b for a, b in zip(once, again))
    assert all(abs(a - b) <= reports.sketch_error() * b for a, b in zip(once, exact))
    assert (once.distinct_kinds, exact[1]) == (9, 9)
    by_part = reports.sketched_counts(parts, columns, ["part"]).collect()
    assert len(by_part) == 5 and all(abs(r.distinct_titles - 24_000) <= 0.1 * 24_000 for r in by_part)
    assert all(len(bytes(v)) < 8192 for r in parts.select(*columns).collect() for v in r)


def test_sketches_of_nothing(many):
    parts = reports.distinct_sketches(many.limit(0), ["title"])
    assert reports.sketched_counts(parts, ["title"]).collect() == [(0,)]
    assert reports.sketched_counts(reports.distinct_sketches(many.select(F.lit(None).cast("string").alias("title")), ["title"]), ["title"]).collect() == [(0,)]


def test_totals_in_one_scan(spark, plan_of):
    rows = [("a", "x", 1.0), ("a", None, 2.0), ("b", "x", None), (None, "y", 4.0)]
    long = stored(spark.createDataFrame(rows, "genre string, platform string, sales_millions double"), "long")
    found = reports.totals_by_each(long, ["genre", "platform"])
    assert sorted(map(str, (tuple(r) for r in found.collect()))) == sorted(map(str, [
        ("genre", "a", 3.0), ("genre", "b", 0.0), ("platform", "x", 1.0), ("platform", "y", 4.0), ("all", None, 7.0)]))
    plan = plan_of(found)
    assert plan.count("FileScan") == 1 and plan.count("Expand") == 1
    for key in ("genre", "platform"):
        single = {r[key]: r.sales_millions for r in reports.totals_by(long, key, "sales_millions").collect()}
        assert {r.value: r.sales_millions for r in found.filter(F.col("dimension") == key).collect()} == single


CSV = "Title,console,genre,release_date,na_sales,pal_sales\n" + "".join(
    f"{'' if i % 9 == 0 else f'game {i % 40}'},PC,Action,200{i % 4}-01-01,{i % 3}.5,{'' if i % 2 else 1}\n" for i in range(300))


def test_writes_count_what_they_write(spark, tmp_path, plan_of):
    (tmp_path / "sales.csv").write_text(CSV)
    staged = stage_sales(spark, str(tmp_path / "sales.csv"), str(tmp_path / "out"))
    # The counts are there already: nothing is scanned for them.
    for counted in (staged.metrics, staged.rows_without_partition):
        assert "FileScan" not in plan_of(counted)
    scanned = quality.stage_metrics(staged.raw, staged.clean, staged.long, "Title")
    assert "FileScan" in plan_of(scanned)
    assert dict(staged.metrics.collect()) == dict(scanned.collect())
    assert dict(staged.metrics.collect())["rows_without_key"] == 34
