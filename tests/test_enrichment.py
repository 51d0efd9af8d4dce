"""Catalogue responses and the enrichment run."""

import json

import pytest
from pyspark.sql import functions as F

from pixeltally.functions import catalog
from pixeltally.operators.joins import enrich_by_title, tag_source
from pixeltally.plans import enrichment


def response(*names, **fields):
    return json.dumps({"results": [{"id": i, "name": n, **fields} for i, n in enumerate(names, 1)]})


@pytest.mark.parametrize(("title", "payload", "found"), [
    ("Zelda", response("Mario", "The ZELDA Tale", "Zelda"), 2),
    ("Zelda", response("Mario", None), 1),
    ("Zelda", '{"results": []}', None),
    ("Zelda", '{"detail": "quota"}', None),
    ("Zelda", "no json", None),
    ("Zelda", None, None),
])
def test_best_match(spark, title, payload, found):
    df = spark.createDataFrame([(title, payload)], "title string, payload string")
    match = catalog.best_match(catalog.parse_results(F.col("payload")), F.col("title"))
    assert df.select(match["id"]).first()[0] == found


def test_projections(spark):
    full = response(
        "x", released="2001-02-03", metacritic=80, developers=[{"name": "D1"}, {"name": "D2"}],
        tags=[{"name": f"t{i}"} for i in range(7)], esrb_rating={"name": "Teen"}, background_image="u")
    empty = response("x", developers=[], tags=[], esrb_rating=None)
    df = spark.createDataFrame([(full,), (empty,)], "payload string")
    game = catalog.first_result(catalog.parse_results(F.col("payload")))
    columns = [*catalog.detail_columns(game), *catalog.enrichment_columns(game)[1:]]
    first, second = df.select(*columns).collect()
    assert first.asDict() == {
        "rawg_id": 1, "rawg_rating": None, "rawg_genres": "", "rawg_tags": "t0, t1, t2, t3, t4, t5, t6", "esrb_rating": "Teen",
        "background_img": "u", "rawg_released": "2001-02-03", "rawg_metacritic": 80, "rawg_developers": "D1, D2"}
    assert (second.rawg_tags, second.rawg_developers, second.esrb_rating) == ("", None, None)
    assert df.select(*catalog.detail_columns(game, tags=2)).first().rawg_tags == "t0, t1"


SALES = [
    ("a", 1.0, None, "2001-01-01", 1), ("b", None, "d", "2001-01-01", 2), ("b", 1.0, "d", "2001-01-01", 3),
    ("c", 1.0, "d", "2001-01-01", 4), (None, None, None, None, 5), ("e", 1.0, "d", None, 6),
]


@pytest.fixture
def sales(spark):
    return spark.createDataFrame(SALES, "title string, critic_score double, developer string, release_date string, n int")


def test_titles_to_look_up(sales):
    titles = enrichment.titles_to_look_up(sales, ["n"])
    assert sorted(titles.collect()) == [("a", 1), ("b", 2), ("e", 6)]


def test_resume_until_nothing_is_left(spark, sales):
    """A client that asks for one title in each run comes to all of them."""
    answers = {t: response(t.upper()) for t in "abce"}
    schema = "title string, payload string"
    enriched = enrichment.enrich(sales, spark.createDataFrame([], schema))
    asked = []
    while (first := enrichment.titles_to_look_up(sales, ["n"], enriched).orderBy("n").first()) is not None:
        asked.append(first.title)
        enriched = enrichment.enrich(sales, spark.createDataFrame([(first.title, answers[first.title])], schema), enriched)
    assert asked == ["a", "b", "e"]
    assert {r.title for r in enriched.filter("rawg_id IS NOT NULL").collect()} == {"a", "b", "e"}


def test_resuming_joins_known_titles_once(spark, sales, plan_of):
    responses = spark.createDataFrame([("a", response("A"))], "title string, payload string")
    first = enrichment.enrich(sales, responses)
    titles = enrichment.titles_to_look_up(sales, ["n"], first)
    assert plan_of(titles).count("LeftAnti") == 1


def test_enrich_and_resume(spark, sales):
    responses = spark.createDataFrame(
        [(t, response(t.upper(), metacritic=50)) for t in "abc"] + [("e", '{"results": []}')], "title string, payload string")
    first = enrichment.enrich(sales, responses.filter("title = 'a'"))
    assert {r.n: r.data_source for r in first.collect()} == {
        1: "vgchartz+rawg", **{n: "vgchartz" for n in (2, 3, 4, 5, 6)}}
    # The second run keeps what the first one found, though the catalogue now says otherwise.
    changed = responses.withColumn("payload", F.replace("payload", F.lit('"id": 1'), F.lit('"id": 9')))
    again = enrichment.enrich(sales, changed, previous=first)
    assert {r.n: r.rawg_id for r in again.collect()} == {1: 1, 2: 9, 3: 9, 4: None, 5: None, 6: None}
    assert again.count() == len(SALES)


def test_enrich_without_any_match(spark, sales):
    none = spark.createDataFrame([], "title string, payload string")
    rows = enrichment.enrich(sales, none).collect()
    assert len(rows) == len(SALES) and {r.data_source for r in rows} == {"vgchartz"}


def test_a_hot_title_is_split(spark, settings, plan_of):
    """A title with a third of all rows: its join partition is read by several tasks."""
    settings({
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB", "spark.sql.shuffle.partitions": "20"})
    sales = spark.range(0, 200000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("t"), F.col("id") % 5000)).alias("title"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"))
    found = sales.select("title").distinct().withColumn("rawg_id", F.length("title").cast("long"))
    joined = tag_source(enrich_by_title(sales, found))
    assert "skew=true" in plan_of(joined)
    assert joined.filter("rawg_id = length(title)").count() == 200000
