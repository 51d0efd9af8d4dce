"""The driver's tables reshaped to the sales model.

``lineitem`` quantities become regional sales of a title (a part) on a console (an
order priority). The wide table, the catalogue responses and the star schema are
written to the scratch folder once per session, as a staged lake would be, and
queries read them there.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pixeltally.plans.views import star_of
from pixeltally.plans.warehouse import load_warehouse
from pixeltally.session import scratch_path
from pixeltally.sources.files import read_parquet, write_parquet
from pixeltally.sources.tables import Warehouse

# Fixed values of the fixture. One console and one genre are not in the seeds.
CONSOLES = {"1-URGENT": "PS5", "2-HIGH": "XSX", "3-MEDIUM": "NS", "4-NOT SPECIFIED": "Arcade", "5-LOW": "PC"}
GENRES = {
    "ECONOMY": "Action", "LARGE": "Sports", "MEDIUM": "Role-Playing",
    "PROMO": "Puzzle", "SMALL": "Shooter", "STANDARD": "Roguelike",
}
MARKETS = {
    "AMERICA": "na_sales", "EUROPE": "pal_sales", "ASIA": "jp_sales",
    "AFRICA": "other_sales", "MIDDLE EAST": "other_sales",
}

# Most lines of orders that a task joins and sums: its memory then stays the same however many there are.
LINES_PER_TASK = 500_000
# Most parts whose candidates a task collects, five of each.
PARTS_PER_TASK = 20_000

_staged: dict[tuple[str, str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _mapped(column: str, values: dict[str, str]) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), F.col(column))


def _unless(condition: str, column: Column) -> Column:
    return F.when(~F.expr(condition), column)


def _dealer(spark: SparkSession, lines: DataFrame) -> Callable[[DataFrame, str], DataFrame]:
    """Deals rows out by a key to as many tasks as the lines need; what the cores take in one go is left to the session.

    Counted in rows, for the session sizes tasks by compressed bytes, of which narrow rows have few.
    Parquet counts without reading rows.
    """
    tasks = math.ceil(lines.count() / LINES_PER_TASK)
    return lambda rows, key: rows.repartition(tasks, key) if tasks > spark.sparkContext.defaultParallelism else rows


def build_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per part and order priority, with a sales column per market."""
    lines = table(spark, sf_dir, "lineitem")
    dealt = _dealer(spark, lines)
    markets = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", _mapped("r_name", MARKETS).alias("market")))
    orders = (
        table(spark, sf_dir, "orders").join(markets, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "o_orderpriority", "o_orderdate", "market"))

    def sold(market: str) -> Column:
        return F.sum(F.when(F.col("market") == market, F.col("l_quantity"))).alias(market)

    # Summed before the parts are joined, so that join is on one row per part and priority.
    sums = (
        dealt(lines.select("l_orderkey", "l_partkey", "l_quantity"), "l_orderkey")
        .join(dealt(orders, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("l_partkey", "o_orderpriority")
        .agg(*map(sold, ["na_sales", "pal_sales", "jp_sales", "other_sales"]),
             F.sum("l_quantity").alias("total_sales"), F.min("o_orderdate").alias("first_order")))
    number = F.substring("o_orderpriority", 1, 1).cast("bigint")
    return sums.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")).select(
        (F.col("p_partkey") * 5 + (F.col("p_partkey") + number) % 5).alias("row_ord"),
        part_title().alias("title"),
        _mapped("o_orderpriority", CONSOLES).alias("console"),
        _unless("p_partkey % 17 = 0", _mapped("p_type", GENRES)).alias("genre"),
        _unless("p_partkey % 13 = 0", F.col("p_brand")).alias("publisher"),
        _unless("p_partkey % 11 = 0", F.concat("p_type", F.lit(" Studio"))).alias("developer"),
        _unless("p_size > 20", F.col("p_size") * 0.5).cast("double").alias("critic_score"),
        _unless("p_partkey % 19 = 0", F.date_format("first_order", "yyyy-MM-dd")).alias("release_date"),
        "na_sales", "pal_sales", "jp_sales", "other_sales", "total_sales")


def part_title() -> Column:
    return F.concat("p_name", F.lit(" ("), F.col("p_partkey").cast("string"), F.lit(")"))


def _once(spark: SparkSession, sf_dir: str, what: str, make) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, what)
    if key not in _staged:
        _staged[key] = make()
    return _staged[key]


def wide_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staged wide table."""
    def make() -> str:
        path = scratch_path(spark, "wide")
        write_parquet(build_wide(spark, sf_dir), path)
        return path
    return read_parquet(spark, _once(spark, sf_dir, "wide", make))


def new_warehouse(spark: SparkSession) -> Warehouse:
    """An empty warehouse below the scratch folder."""
    return Warehouse(spark, f"star_{uuid.uuid4().hex}", scratch_path(spark, "star"))


def star_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse loaded from the wide table."""
    def make() -> str:
        warehouse = new_warehouse(spark)
        load_warehouse(warehouse, wide_sales(spark, sf_dir), ["row_ord"])
        return warehouse.database
    return Warehouse(spark, _once(spark, sf_dir, "star", make))


def star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return star_of(star_warehouse(spark, sf_dir))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staged catalogue responses."""
    def make() -> str:
        path = scratch_path(spark, "responses")
        write_parquet(build_responses(spark, sf_dir), path)
        return path
    return read_parquet(spark, _once(spark, sf_dir, "responses", make))


def build_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalogue response per title: up to five neighbouring parts as candidates.

    Small parts find nothing; those of one brand do not find themselves. Candidate
    names are in upper case, some age ratings and developer lists are missing.
    """
    part = table(spark, sf_dir, "part")
    named = lambda column: F.struct(column.alias("name"))
    record = F.struct(
        F.col("p_partkey").alias("id"),
        F.upper(part_title()).alias("name"),
        (F.col("p_size") * 0.25).cast("double").alias("rating"),
        F.when(F.col("p_size") % 5 != 0, F.concat(F.lit("20"), F.lpad(F.col("p_size").cast("string"), 2, "0"), F.lit("-06-01"))).alias("released"),
        (F.col("p_size") + 50).alias("metacritic"),
        F.concat(F.lit("img/"), F.col("p_partkey").cast("string"), F.lit(".jpg")).alias("background_image"),
        F.when(F.col("p_size") % 4 != 0, named(F.col("p_type"))).alias("esrb_rating"),
        F.array(named(F.col("p_type")), named(F.col("p_brand"))).alias("genres"),
        F.array(*[named(c) for c in (
            F.col("p_name"), F.col("p_brand"), F.col("p_type"), F.lit("fourth"), F.lit("fifth"), F.lit("sixth"))]).alias("tags"),
        F.when(F.col("p_size") % 3 != 0, F.array(named(F.concat("p_brand", F.lit(" Works"))), named(F.col("p_type"))))
        .otherwise(F.expr("array()").cast("array<struct<name:string>>")).alias("developers"))
    # Records are many times as large as the file they come from, by whose size Spark would broadcast them or read them
    # in few tasks: both sides are dealt out by part, and candidates by title before they are collected.
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(part.count() / PARTS_PER_TASK))
    asked = part.filter("p_size > 5").select(
        F.col("p_partkey").alias("asked"), part_title().alias("title"), F.col("p_brand").alias("asked_brand"),
        F.explode(F.sequence(F.lit(-2), F.lit(2))).alias("step"))
    near = (
        asked.filter(~((F.col("step") == 0) & (F.col("asked_brand") == "Brand#7")))
        .select("title", "step", (F.col("asked") + F.col("step")).alias("near")).repartition(tasks, "near"))
    records = part.repartition(tasks, "p_partkey").select("p_partkey", record.alias("record"))
    found = (
        near.join(records.hint("merge"), F.col("near") == F.col("p_partkey"))
        .select("title", "step", "record").repartition(tasks, "title").groupBy("title")
        # At most five candidates per title.
        .agg(F.array_sort(F.collect_list(F.struct("step", "record"))).alias("found"))
        .select("title", F.transform("found", lambda x: x["record"]).alias("results")))
    nothing = part.filter("p_size <= 5").select(
        part_title().alias("title"), F.lit('{"results": []}').alias("payload"))
    return found.select("title", F.to_json(F.struct("results")).alias("payload")).unionByName(nothing)
