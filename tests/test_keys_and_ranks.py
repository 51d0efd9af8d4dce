"""Distributed numbering and ranking against plain Python."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from pixeltally.operators.keys import assign_ids
from pixeltally.operators import ranking
from pixeltally.operators.ranking import number_in_order, rank_of_values, top_k, with_rank
from pixeltally.plans.warehouse import new_rows


def by_bucket(keys):
    return sorted(keys, key=lambda k: (hashlib.md5(k.encode()).hexdigest()[:4], k))


def test_ids_are_dense_and_repeatable(spark):
    keys = [f"title {i}" for i in range(500)]
    df = spark.createDataFrame([(k,) for k in keys], "title string")
    expected = {k: i for i, k in enumerate(by_bucket(keys), 1)}
    for parts in (1, 7):
        assert dict(assign_ids(df.repartition(parts), "title", "id").select("title", "id").collect()) == expected


def test_new_ids_follow_the_existing(spark):
    existing = spark.createDataFrame([(41, "b"), (7, "a")], "id long, title string")
    df = spark.createDataFrame([("a",), ("c",), ("d",)], "title string")
    added = new_rows(df, existing, "title", "id")
    assert dict(added.select("title", "id").collect()) == {k: 41 + i for i, k in enumerate(by_bucket(["c", "d"]), 1)}


def test_new_ids_of_an_empty_table(spark):
    existing = spark.createDataFrame([], "id long, title string")
    df = spark.createDataFrame([("a",)], "title string")
    assert new_rows(df, existing, "title", "id").collect()[0].asDict() == {"id": 1, "title": "a"}


def python_ranks(rows):
    """1 + the number of rows of the group that come before: greater values, and nulls before all."""
    def above(x, y):
        return (x is None and y is not None) or (x is not None and y is not None and x > y)
    return sorted((g, i, 1 + sum(g == h and above(w, v) for h, _, w in rows)) for g, i, v in rows)


@pytest.fixture(scope="module")
def sales():
    """Most rows in one group, a third of them with one value, several bands, nulls and negatives."""
    random.seed(1)
    value = lambda: random.choice([0.01, 0.01, round(random.uniform(-5, 60), 2), None if random.random() < .05 else 12.5])
    return [(random.choice([1, 1, 1, 2]), i, value()) for i in range(600)]


def test_rank(spark, sales):
    df = spark.createDataFrame(sales, "g int, i int, v double")
    ranked = with_rank(df, "g", "v", "rank")
    assert sorted(map(tuple, ranked.select("g", "i", "rank").collect())) == python_ranks(sales)


def test_null_ranks_first(spark):
    df = spark.createDataFrame([(1, 1.0), (1, None), (1, 2.0)], "g int, v double")
    assert dict(with_rank(df, "g", "v", "rank").select("v", "rank").collect()) == {None: 1, 2.0: 2, 1.0: 3}


@pytest.mark.parametrize("k", [1, 3, 40, 1000])
def test_top_k_keeps_ties(spark, sales, k):
    df = spark.createDataFrame(sales, "g int, i int, v double")
    kept = top_k(df, "g", "v", "rank", k)
    assert sorted(map(tuple, kept.select("g", "i", "rank").collect())) == [r for r in python_ranks(sales) if r[2] <= k]


def test_no_window_holds_a_whole_group(spark, plan_of):
    """Rows reach a window only counted by value, never as they are."""
    df = spark.range(20000).select(F.lit(1).alias("g"), (F.col("id") % 100 / 4).alias("v"))
    plan = plan_of(rank_of_values(df, "g", "v", "rank"))
    for line in plan.split("Window [")[1:]:
        assert "HashAggregate" in line


@pytest.mark.parametrize("spread", ["id * 0.00005", "exp(id / 10000.0)", "-id * 1e-9", "CASE WHEN id % 2 = 0 THEN 5.0 ELSE id / 1e6 END"])
def test_bands_follow_the_values(spark, spread):
    """200,000 values, nearly all different: no band is above three times the median, however they are spread."""
    df = spark.sql(f"SELECT id % 2 AS g, CAST({spread} AS DOUBLE) AS v FROM range(200000)")
    counts = ranking._value_counts(df, "g", "v")
    banded = ranking._with_band(counts, "v", ranking.bounds_of_bands(counts, "v", 64))
    sizes = sorted(r["count"] for r in banded.groupBy("g", "_band").count().collect())
    assert len(sizes) >= 60 and sizes[-1] <= 3 * sizes[len(sizes) // 2]


def test_ranks_of_raw_doubles(spark):
    """Unrounded values, infinities and NaN, which is above all numbers; null first."""
    dice = random.Random(3)
    values = [dice.gauss(0, 1) for _ in range(500)] + [float("inf"), float("-inf"), 0.0, -0.0, 1e-300, None, None]
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(values)] + [(2, 9999, float("nan")), (2, 9998, float("inf"))], "g int, i int, v double")
    found = {r.i: r["rank"] for r in with_rank(df, "g", "v", "rank").collect()}
    assert [(i, found[i]) for i in range(len(values))] == [(i, k) for _, i, k in python_ranks([(1, i, v) for i, v in enumerate(values)])]
    assert (found[9999], found[9998]) == (1, 2)
    stored_ranks = rank_of_values(df, "g", "v", "rank", store=True)
    assert {r.i: r["rank"] for r in with_rank(df, "g", "v", "rank", stored_ranks).collect()} == found


@pytest.mark.parametrize("bounds", [[], [0.0], [-3.0, 11.0, 12.5, 59.0]])
def test_any_bounds_give_right_ranks(spark, sales, monkeypatch, bounds):
    """A view goes on with the bounds of its first rows."""
    monkeypatch.setattr(ranking, "bounds_of_bands", lambda *_: bounds)
    ranked = with_rank(spark.createDataFrame(sales, "g int, i int, v double"), "g", "v", "rank")
    assert sorted(map(tuple, ranked.select("g", "i", "rank").collect())) == python_ranks(sales)


def test_numbers_in_order(spark):
    rows = [(i, i * 7919 % 1000 if i % 10 else None) for i in range(3000)]
    df = spark.createDataFrame(rows, "i int, v int").repartition(5)
    found = number_in_order(df, [F.desc_nulls_last("v"), F.asc("i")], "n").collect()
    expected = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert [(r.i, r.v) for r in sorted(found, key=lambda r: r.n)] == expected
    assert sorted(r.n for r in found) == list(range(1, 3001))
    assert number_in_order(df.limit(0), [F.asc("i")], "n").collect() == []
