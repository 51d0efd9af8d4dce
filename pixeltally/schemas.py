"""Fixed values of the sales model: seeds, code lists, column lists and table layouts."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---- fixed values -----------------------------------------------------------

# Sales column of the wide table -> region code.
SALES_REGIONS = {
    "na_sales": "NA",
    "pal_sales": "EU",
    "jp_sales": "JP",
    "other_sales": "Other",
}
SALES_COLUMNS = list(SALES_REGIONS)
NUMERIC_COLUMNS = [*SALES_COLUMNS, "total_sales", "critic_score", "user_score"]

# Names of the sales columns in the market-share report.
MARKET_LABELS = {
    "na_sales": "Amérique du Nord",
    "pal_sales": "Europe (PAL)",
    "jp_sales": "Japon",
    "other_sales": "Reste du monde",
}

# Columns that describe a game and are kept beside each regional sales row.
GAME_COLUMNS = [
    "title", "platform", "genre", "publisher", "developer",
    "release_year", "critic_score", "user_score",
]

UNKNOWN = "Unknown"
NEW_GENRE_CATEGORY = "Other"
BASE_SOURCE = "vgchartz"
ENRICHED_SOURCE = "vgchartz+rawg"

# Text widths for an export to a warehouse that has some.
TEXT_WIDTHS = {"title": 300, "publisher": 200, "developer": 200, "platform": 20}

# CSV texts read as null (the default list of the pandas CSV reader).
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]

# Platform types the warehouse accepts.
PLATFORM_TYPES = ["console", "handheld", "pc", "mobile", "other"]

# region_code, region_label, continent, continent_code
REGION_SEED = [
    ("NA", "North America", "Americas", "AM"),
    ("EU", "Europe", "Europe", "EU"),
    ("JP", "Japan", "Asia", "AS"),
    ("AF", "Africa", "Africa", "AF"),
    ("Other", "Rest of World", "Various", "XX"),
]

# platform_code, platform_name, manufacturer, platform_type, generation, launch_year
PLATFORM_SEED = [
    ("PS5", "PlayStation 5", "Sony", "console", 9, 2020),
    ("PS4", "PlayStation 4", "Sony", "console", 8, 2013),
    ("PS3", "PlayStation 3", "Sony", "console", 7, 2006),
    ("PS2", "PlayStation 2", "Sony", "console", 6, 2000),
    ("PS", "PlayStation", "Sony", "console", 5, 1994),
    ("XSX", "Xbox Series X/S", "Microsoft", "console", 9, 2020),
    ("XOne", "Xbox One", "Microsoft", "console", 8, 2013),
    ("X360", "Xbox 360", "Microsoft", "console", 7, 2005),
    ("XB", "Xbox", "Microsoft", "console", 6, 2001),
    ("NS", "Nintendo Switch", "Nintendo", "handheld", 9, 2017),
    ("WiiU", "Wii U", "Nintendo", "console", 8, 2012),
    ("Wii", "Wii", "Nintendo", "console", 7, 2006),
    ("GC", "GameCube", "Nintendo", "console", 6, 2001),
    ("N64", "Nintendo 64", "Nintendo", "console", 5, 1996),
    ("3DS", "Nintendo 3DS", "Nintendo", "handheld", 8, 2011),
    ("DS", "Nintendo DS", "Nintendo", "handheld", 7, 2004),
    ("GBA", "Game Boy Advance", "Nintendo", "handheld", 6, 2001),
    ("PC", "PC / Windows", "N/A", "pc", 0, None),
    ("iOS", "iOS / iPhone", "Apple", "mobile", 0, None),
    ("And", "Android", "Google", "mobile", 0, None),
]

# genre_name, category
GENRE_SEED = [
    ("Action", "Action"),
    ("Action-Adventure", "Action"),
    ("Adventure", "Adventure"),
    ("Fighting", "Action"),
    ("Shooter", "Action"),
    ("Platform", "Action"),
    ("Role-Playing", "RPG"),
    ("JRPG", "RPG"),
    ("MMO", "RPG"),
    ("Strategy", "Strategy"),
    ("Simulation", "Simulation"),
    ("Sports", "Sports"),
    ("Racing", "Sports"),
    ("Puzzle", "Puzzle"),
    ("Music", "Casual"),
    ("Party", "Casual"),
    ("Sandbox", "Casual"),
    ("Visual Novel", "Other"),
    ("Board Game", "Other"),
    ("Education", "Other"),
    ("Misc", "Other"),
]

# The calendar covers these days at least, both included, and the years of the data beyond them.
CALENDAR_START = "1970-01-01"
CALENDAR_END = "2030-12-31"

# Warehouse tables: column definitions in Spark SQL.
TABLES = {
    "dim_game": """
        game_id BIGINT NOT NULL, title STRING NOT NULL, publisher STRING, developer STRING,
        esrb_rating STRING, critic_score DOUBLE, user_score DOUBLE, rawg_id BIGINT,
        rawg_rating DOUBLE, rawg_tags STRING, background_img STRING,
        data_source STRING DEFAULT 'vgchartz', created_at TIMESTAMP DEFAULT current_timestamp()""",
    "dim_platform": """
        platform_id BIGINT NOT NULL, platform_code STRING NOT NULL, platform_name STRING,
        manufacturer STRING, platform_type STRING, generation INT, launch_year INT""",
    "dim_genre": "genre_id BIGINT NOT NULL, genre_name STRING NOT NULL, category STRING",
    "dim_region": """
        region_id BIGINT NOT NULL, region_code STRING NOT NULL, region_label STRING,
        continent STRING, continent_code STRING""",
    "dim_date": """
        date_id INT NOT NULL, full_date DATE, year SMALLINT, quarter SMALLINT, month SMALLINT,
        month_name STRING, week SMALLINT, day_of_week SMALLINT, is_weekend BOOLEAN""",
    "fact_sales": """
        sale_id BIGINT NOT NULL, game_id BIGINT NOT NULL, platform_id BIGINT, genre_id BIGINT,
        region_id BIGINT NOT NULL, release_year INT, sales_millions DOUBLE, global_sales DOUBLE,
        ingested_at TIMESTAMP DEFAULT current_timestamp()""",
}

# What the ledger of loads has.
LEDGER = (
    "load_id STRING NOT NULL, table_name STRING NOT NULL, state STRING NOT NULL, "
    "recorded_at TIMESTAMP DEFAULT current_timestamp()")

# Tables that are derived from others, made where they are asked for.
DERIVED = {
    "sales_rollup": """
        region_id BIGINT, platform_id BIGINT, genre_id BIGINT, release_year INT, known BOOLEAN, block BIGINT,
        games BINARY, sales DOUBLE, n_sales BIGINT, most DOUBLE, scores DOUBLE, n_scores BIGINT""",
}

# The parts of a catalogue response that are read.
_NAMED = T.ArrayType(T.StructType([T.StructField("name", T.StringType())]))
CATALOG_RESPONSE = T.StructType([
    T.StructField("results", T.ArrayType(T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("released", T.StringType()),
        T.StructField("metacritic", T.IntegerType()),
        T.StructField("background_image", T.StringType()),
        T.StructField("esrb_rating", T.StructType([T.StructField("name", T.StringType())])),
        T.StructField("genres", _NAMED),
        T.StructField("tags", _NAMED),
        T.StructField("developers", _NAMED),
    ]))),
])

# Columns a title gains by enrichment.
ENRICHMENT = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("rawg_id", T.LongType()),
    T.StructField("rawg_released", T.StringType()),
    T.StructField("rawg_metacritic", T.IntegerType()),
    T.StructField("rawg_developers", T.StringType()),
])

# ---- seeds as DataFrames ----------------------------------------------------


def _numbered(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    # An Arrow table becomes a local relation, whose small size Spark knows when it plans joins.
    columns = zip(*[(i, *row) for i, row in enumerate(rows, 1)])
    names = [field.split()[0] for field in schema.split(", ")]
    return spark.createDataFrame(pa.table(dict(zip(names, map(list, columns)))), schema)


def region_seed(spark: SparkSession) -> DataFrame:
    return _numbered(
        spark, REGION_SEED,
        "region_id bigint, region_code string, region_label string, continent string, continent_code string")


def platform_seed(spark: SparkSession) -> DataFrame:
    return _numbered(
        spark, PLATFORM_SEED,
        "platform_id bigint, platform_code string, platform_name string, manufacturer string, "
        "platform_type string, generation int, launch_year int")


def genre_seed(spark: SparkSession) -> DataFrame:
    return _numbered(spark, GENRE_SEED, "genre_id bigint, genre_name string, category string")
