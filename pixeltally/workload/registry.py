"""One entry per registered query: a Spark callable (spark, sf_dir) and its SQL oracle."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixeltally.functions import catalog, cleaning as text
from pixeltally.operators import cleaning, joins, quality, reports, reshape
from pixeltally.plans import enrichment, rollup, staging, views, warehouse as loads
from pixeltally.schemas import (
    CALENDAR_END, CALENDAR_START, GAME_COLUMNS, PLATFORM_TYPES, SALES_COLUMNS, TEXT_WIDTHS, platform_seed)
from pixeltally.session import scratch_path
from pixeltally.sources import files, lake, tables
from pixeltally.workload.oracles import sql
from pixeltally.workload.tables import (
    build_wide, new_warehouse, responses, star, star_warehouse, table, wide_sales,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

ORDER = ["row_ord"]
WIDE_COLUMNS = [
    "row_ord", "title", "console", "genre", "publisher", "developer", "critic_score", "release_date",
    *SALES_COLUMNS, "total_sales",
]
# Sales released before this day are an earlier load, in queries about incremental loads.
CUTOFF = "1996-01-01"


def query(oracle: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        ORACLES[function.__name__] = sql(oracle)
        return function
    return register


def clean_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_for_warehouse(wide_sales(spark, sf_dir), ORDER)


def long_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshape.unpivot_sales(clean_games(spark, sf_dir))


def facts(df: DataFrame) -> DataFrame:
    return df.drop("ingested_at")


# ---- views and example queries ----------------------------------------------


@query("SELECT * FROM v_continent_genre")
def v_sales_continent_genre(spark, sf_dir):
    return views.sales_continent_genre(star(spark, sf_dir))


@query("SELECT * FROM v_platforms")
def v_top_platforms_by_region(spark, sf_dir):
    return views.top_platforms_by_region(star(spark, sf_dir))


@query("SELECT * FROM v_yearly")
def v_yearly_global_sales(spark, sf_dir):
    return views.yearly_global_sales(star(spark, sf_dir))


@query("SELECT * FROM v_ranking")
def v_game_ranking_by_region(spark, sf_dir):
    return views.game_ranking_by_region(star(spark, sf_dir), store_ranks=True)


@query("SELECT * FROM v_ranking WHERE region_rank <= 10")
def topk_games_per_region(spark, sf_dir):
    return views.top_games_per_region(star(spark, sf_dir), 10)


@query("""
    SELECT title, platform_name, sum(sales_millions) AS sales_m
    FROM fact JOIN game USING (game_id) JOIN seed_platform USING (platform_id) JOIN seed_region USING (region_id)
    WHERE region_code = 'EU' GROUP BY title, platform_name ORDER BY sales_m DESC, title, platform_name LIMIT 10""")
def top_games_in_region(spark, sf_dir):
    return views.top_games_in_region(star(spark, sf_dir), "EU")


@query("SELECT * FROM v_continent_genre ORDER BY total_sales_m DESC")
def sales_by_genre_and_continent(spark, sf_dir):
    return views.sales_by_genre_and_continent(star(spark, sf_dir))


@query("SELECT * FROM v_yearly WHERE release_year BETWEEN 2000 AND 2024")
def yearly_between(spark, sf_dir):
    return views.yearly_between(star(spark, sf_dir), 2000, 2024)


@query("SELECT * FROM v_platforms ORDER BY total_sales_m DESC, region_label, platform_name LIMIT 20")
def dominant_platforms(spark, sf_dir):
    return views.dominant_platforms(star(spark, sf_dir))


@query("""SELECT continent, sum(total_sales_m) AS total_sales_m, CAST(sum(nb_games) AS BIGINT) AS nb_games
    FROM v_continent_genre GROUP BY continent""")
def views_by_sql(spark, sf_dir):
    """The views under their names, asked in SQL."""
    views.register_views(star(spark, sf_dir))
    return spark.sql("""
        SELECT continent, sum(total_sales_m) AS total_sales_m, sum(nb_games) AS nb_games
        FROM vw_sales_continent_genre GROUP BY continent""")


def _rollup(spark, sf_dir) -> DataFrame:
    tables_of = star(spark, sf_dir)
    return rollup.build(tables_of["fact_sales"], tables_of["dim_game"])


@query("SELECT * FROM v_continent_genre")
def rollup_continent_genre(spark, sf_dir):
    """The view from bitmaps of games."""
    return rollup.sales_continent_genre(_rollup(spark, sf_dir), star(spark, sf_dir))


@query("SELECT * FROM v_platforms")
def rollup_platforms(spark, sf_dir):
    return rollup.top_platforms_by_region(_rollup(spark, sf_dir), star(spark, sf_dir))


@query("SELECT * FROM v_yearly")
def rollup_yearly(spark, sf_dir):
    return rollup.yearly_global_sales(_rollup(spark, sf_dir))


@query("""SELECT release_year, count(DISTINCT fact.game_id) AS nb_games_released, sum(amount) AS total_sales_m,
      avg(amount) AS avg_sales_per_game_m, max(amount) AS max_sales_m
    FROM (SELECT *, CASE WHEN row_ord // 5 % 3 = 1 AND region_code = 'NA' THEN sales_millions + 1 ELSE sales_millions END AS amount
      FROM fact JOIN game USING (game_id) JOIN seed_region USING (region_id) JOIN (SELECT title, min(row_ord) AS row_ord FROM wide GROUP BY title) USING (title)
      WHERE NOT (row_ord // 5 % 3 = 1 AND region_code = 'JP')) AS fact
    WHERE release_year IS NOT NULL GROUP BY release_year""")
def rollup_weekly(spark, sf_dir):
    """A kept rollup after a first week, a week of new games, and a week that corrects some of them."""
    root = scratch_path(spark, "rollup-weeks")
    target, wide = new_warehouse(spark), wide_sales(spark, sf_dir)
    part = F.expr("row_ord div 5 % 3")
    corrected = {"na_sales": F.col("na_sales") + 1, "jp_sales": F.lit(None).cast("double")}
    weeks = [wide.filter(part == 0), wide.filter(part > 0), wide.filter(part == 1).withColumns(corrected)]
    for number, week in enumerate(weeks):
        files.write_parquet(week, f"{root}/{number}")
        loads.weekly_refresh(target, f"{root}/{number}", f"{root}/raw.csv", ORDER)
        if number == 0:
            rollup.refresh_rollup(target)
    return rollup.yearly_global_sales(target.table(rollup.TABLE))


# ---- cleaning ---------------------------------------------------------------


@query("SELECT * FROM wide")
def wide_table(spark, sf_dir):
    return build_wide(spark, sf_dir)


@query("""SELECT title, release_date, console, row_ord FROM wide
    QUALIFY row_number() OVER (PARTITION BY title, release_date ORDER BY row_ord) = 1""")
def dedup_title_date(spark, sf_dir):
    first = cleaning.keep_first(wide_sales(spark, sf_dir), ["title", "release_date"], ORDER)
    return first.select("title", "release_date", "console", "row_ord")


@query("SELECT title, console, row_ord FROM wide QUALIFY row_number() OVER (PARTITION BY title ORDER BY row_ord) = 1")
def dedup_title(spark, sf_dir):
    return cleaning.keep_first(wide_sales(spark, sf_dir), ["title"], ORDER).select("title", "console", "row_ord")


@query("SELECT row_ord, publisher FROM wide WHERE publisher IS NOT NULL")
def drop_null_key(spark, sf_dir):
    return cleaning.drop_null_key(wide_sales(spark, sf_dir), "publisher").select("row_ord", "publisher")


@query("""SELECT row_ord, coalesce(CASE WHEN console <> 'PC' THEN console END, 'Unknown') AS platform,
    coalesce(genre, 'Unknown') AS genre FROM wide""")
def default_fill(spark, sf_dir):
    consoles = wide_sales(spark, sf_dir).select(
        "row_ord", "genre", F.nullif("console", F.lit("PC")).alias("console"), F.lit("ignored").alias("platform"))
    return cleaning.fill_defaults(consoles).select("row_ord", "platform", "genre")


@query("""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 3 THEN NULL WHEN 4 THEN NULL ELSE CAST(year(o_orderdate) AS INTEGER) END AS iso_year,
    CASE o_orderkey % 5 WHEN 3 THEN CAST(year(o_orderdate) AS INTEGER) END AS us_year FROM orders""")
def release_year(spark, sf_dir):
    """Dates in three ISO forms, in one that the caller names, and in one that none knows."""
    day = F.col("o_orderdate")
    forms = ["yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss.SSS", "MM/dd/yyyy", "yyyy"]
    written = F.coalesce(*[F.when(F.col("o_orderkey") % 5 == k, F.date_format(day, form)) for k, form in enumerate(forms)])
    dated = table(spark, sf_dir, "orders").select("o_orderkey", written.alias("release_date"))
    iso = cleaning.add_release_year(dated).withColumnRenamed("release_year", "iso_year")
    both = cleaning.add_release_year(iso, ["MM/dd/yyyy"])
    return both.select("o_orderkey", "iso_year", F.col("release_year").alias("us_year"))


@query("""SELECT form, row_ord, release_year FROM (
      SELECT row_ord, CAST(substr(release_date, 1, 4) AS INTEGER) AS release_year, row_ord % 50 = 3 AS odd FROM wide),
      (SELECT unnest(['M/d/yyyy', 'd/M/yyyy', 'MMM d, yyyy', 'yyyy-MM-dd HH:mm']) AS form) WHERE NOT odd
    UNION ALL SELECT form, row_ord, NULL FROM wide, (SELECT unnest(['M/d/yyyy', 'd/M/yyyy', 'MMM d, yyyy', 'yyyy-MM-dd HH:mm']) AS form)
    WHERE row_ord % 50 = 3""")
def elected_year(spark, sf_dir):
    """The same dates in four files, each in a form of its own that no caller names, with some that are in none."""
    wide = wide_sales(spark, sf_dir).select("row_ord", F.to_date("release_date").alias("day"))

    def file(form: str) -> DataFrame:
        text = F.when(F.expr("row_ord % 50 = 3"), F.lit("to be announced")).otherwise(F.date_format("day", form))
        read = files.stored(cleaning.add_release_year(wide.select("row_ord", text.alias("release_date")), None), "years")
        return cleaning.elect_year(read).select(F.lit(form).alias("form"), "row_ord", "release_year")

    return reduce(DataFrame.unionByName, map(file, ["M/d/yyyy", "d/M/yyyy", "MMM d, yyyy", "yyyy-MM-dd HH:mm"]))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, CASE l_linenumber
      WHEN 1 THEN l_quantity WHEN 2 THEN l_quantity WHEN 3 THEN l_quantity * 1000 END AS total_sales
    FROM lineitem""")
def coerce_numeric(spark, sf_dir):
    amount = F.col("l_quantity").cast("int").cast("string")
    written = (
        F.when(F.col("l_linenumber") == 1, amount)
        .when(F.col("l_linenumber") == 2, F.concat(F.lit(" +"), amount, F.lit(".0 ")))
        .when(F.col("l_linenumber") == 3, F.concat(amount, F.lit("e3")))
        .when(F.col("l_linenumber") == 4, F.concat(amount, F.lit("d")))
        .when(F.col("l_linenumber") == 5, F.concat(amount, F.lit(",000")))
        .when(F.col("l_linenumber") == 6, F.lit("tbd"))
        .otherwise(F.lit("nan")))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", written.alias("total_sales"))
    return cleaning.coerce_numeric(rows)


@query("SELECT row_ord, title, critic_score, CAST(NULL AS DOUBLE) AS user_score FROM wide")
def conform_schema(spark, sf_dir):
    rows = wide_sales(spark, sf_dir).select("row_ord", "title", "critic_score")
    return cleaning.conform(rows, {"critic_score": "double", "user_score": "double"})


@query("""SELECT row_ord, title, na_sales AS na_sales, total_sales AS total_sales_m_, jp_sales AS jp__sales FROM wide""")
def normalize_columns(spark, sf_dir):
    messy = wide_sales(spark, sf_dir).select(
        F.col("row_ord").alias("Row-Ord"), F.col("title").alias("  TITLE "), F.col("na_sales").alias(" Na Sales "),
        F.col("total_sales").alias("Total-Sales(M)"), F.col("jp_sales").alias("JP  Sales"))
    return cleaning.normalize_columns(messy)


@query("""SELECT row_ord, substr(repeat(title, 30), 1, 300) AS title, substr(repeat(publisher, 30), 1, 200) AS publisher,
    substr(repeat(developer, 30), 1, 200) AS developer, substr(repeat(console, 30), 1, 20) AS platform FROM wide""")
def truncate_strings(spark, sf_dir):
    rows = wide_sales(spark, sf_dir).select(
        "row_ord", *[F.repeat(F.col(c), F.lit(30)).alias(c) for c in ("title", "publisher", "developer")],
        F.repeat(F.col("console"), F.lit(30)).alias("platform"))
    return cleaning.truncate_texts(rows, TEXT_WIDTHS)


@query("""SELECT l_orderkey, l_linenumber, l_partkey,
      CAST(round(CAST(l_extendedprice * 0.00000123 AS DECIMAL(18, 10)), 4) AS DOUBLE) AS sales_millions
    FROM (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_extendedprice AS DECIMAL(12, 2)) AS l_extendedprice FROM lineitem)""")
def round_sales(spark, sf_dir):
    rounded = text.round4(F.col("l_extendedprice") * 0.00000123)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", rounded.alias("sales_millions"))


@query("""SELECT p_partkey, regexp_replace(p_name, '[^a-zA-Z0-9 ]', '', 'g') || ' ' ||
    regexp_replace(p_brand, '[^a-zA-Z0-9 ]', '', 'g') || ' edition' AS search_title FROM part""")
def clean_title(spark, sf_dir):
    title = F.concat(F.lit("\t "), "p_name", F.lit(": "), "p_brand", F.lit(" ("), F.col("p_partkey").cast("string"), F.lit(") édition!\n"))
    title = F.replace(title, F.lit("é"), F.lit("ée"))
    return table(spark, sf_dir, "part").select("p_partkey", text.clean_title(title).alias("search_title"))


@query("SELECT DISTINCT genre FROM wide WHERE genre IS NOT NULL")
def distinct_genres(spark, sf_dir):
    return cleaning.distinct_values(wide_sales(spark, sf_dir), "genre")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_quantity - 25 AS sales FROM lineitem
    WHERE l_returnflag <> 'R' AND l_quantity > 25""")
def positive_sales(spark, sf_dir):
    sales = F.when(F.col("l_returnflag") == "R", F.lit(float("nan"))).otherwise(F.col("l_quantity") - 25)
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", sales.alias("sales"))
    return rows.filter(cleaning.positive("sales"))


@query("SELECT row_ord, title, critic_score, developer, release_date FROM incomplete")
def find_incomplete(spark, sf_dir):
    rows = enrichment.incomplete_rows(wide_sales(spark, sf_dir))
    return rows.select("row_ord", "title", "critic_score", "developer", "release_date")


@query("SELECT title, min(row_ord) AS row_ord FROM incomplete GROUP BY title")
def first_titles_to_look_up(spark, sf_dir):
    """Every incomplete title, and where it comes first in the input."""
    return enrichment.titles_to_look_up(wide_sales(spark, sf_dir), ORDER)


# ---- reshape ----------------------------------------------------------------


@query("""SELECT title, platform, genre, publisher, developer, release_year, critic_score, CAST(NULL AS DOUBLE) AS user_score,
    region_code, region_label, continent, sales_millions FROM long_sales""")
def unpivot_sales(spark, sf_dir):
    return long_sales(spark, sf_dir)


@query("""SELECT region_code, coalesce(region_label, region_code) AS region_label, coalesce(continent, 'Unknown') AS continent,
      count(*) AS order_count
    FROM (SELECT CASE r_name WHEN 'AMERICA' THEN 'NA' WHEN 'EUROPE' THEN 'EU' WHEN 'ASIA' THEN 'JP' WHEN 'AFRICA' THEN 'AF'
        ELSE r_name END AS region_code
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey) LEFT JOIN seed_region USING (region_code)
    GROUP BY ALL""")
def region_lookup(spark, sf_dir):
    code = (
        F.when(F.col("r_name") == "AMERICA", "NA").when(F.col("r_name") == "EUROPE", "EU")
        .when(F.col("r_name") == "ASIA", "JP").when(F.col("r_name") == "AFRICA", "AF").otherwise(F.col("r_name")))
    placed = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(code.alias("region_code")))
    return (
        reshape.add_region_attributes(placed).groupBy("region_code", "region_label", "continent")
        .agg(F.count(F.lit(1)).alias("order_count")))


@query("""WITH totals AS (
      SELECT 'na_sales' AS sales_column, 'Amérique du Nord' AS region, coalesce(sum(na_sales), 0) AS total_sales_m FROM wide
      UNION ALL SELECT 'pal_sales', 'Europe (PAL)', coalesce(sum(pal_sales), 0) FROM wide
      UNION ALL SELECT 'jp_sales', 'Japon', coalesce(sum(jp_sales), 0) FROM wide
      UNION ALL SELECT 'other_sales', 'Reste du monde', coalesce(sum(other_sales), 0) FROM wide)
    SELECT *, 100.0::DOUBLE * total_sales_m / sum(total_sales_m) OVER () AS share_pct FROM totals""")
def region_share(spark, sf_dir):
    return reshape.region_share(wide_sales(spark, sf_dir))


# ---- warehouse --------------------------------------------------------------


@query("""SELECT 'platform' AS dimension, platform_code AS code, platform_name AS label, platform_type AS category,
      CAST(generation AS INTEGER) AS generation, CAST(launch_year AS INTEGER) AS launch_year, count(sale_id) AS fact_rows
    FROM seed_platform LEFT JOIN fact USING (platform_id) GROUP BY ALL
    UNION ALL SELECT 'genre', genre_name, genre_name, category, NULL, NULL, count(sale_id)
    FROM seed_genre LEFT JOIN fact USING (genre_id) GROUP BY ALL
    UNION ALL SELECT 'region', region_code, region_label, continent || ' ' || continent_code, NULL, NULL, count(sale_id)
    FROM seed_region LEFT JOIN fact USING (region_id) GROUP BY ALL""")
def seed_dimensions(spark, sf_dir):
    """Every reference row of the small dimensions, and how many facts use it."""
    tables = star(spark, sf_dir)
    fact = tables["fact_sales"]

    def used(rows: DataFrame, key: str, *columns) -> DataFrame:
        counts = fact.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        return rows.join(counts, key, "left").select(*columns, F.coalesce("n", F.lit(0)).alias("fact_rows"))

    no_number = F.lit(None).cast("int")
    return reduce(DataFrame.unionByName, [
        used(tables["dim_platform"], "platform_id", F.lit("platform").alias("dimension"),
             F.col("platform_code").alias("code"), F.col("platform_name").alias("label"),
             F.col("platform_type").alias("category"), "generation", "launch_year"),
        used(loads.genre_seed(spark), "genre_id", F.lit("genre").alias("dimension"),
             F.col("genre_name").alias("code"), F.col("genre_name").alias("label"), "category",
             no_number.alias("generation"), no_number.alias("launch_year")),
        used(tables["dim_region"], "region_id", F.lit("region").alias("dimension"),
             F.col("region_code").alias("code"), F.col("region_label").alias("label"),
             F.concat_ws(" ", "continent", "continent_code").alias("category"),
             no_number.alias("generation"), no_number.alias("launch_year")),
    ])


@query("SELECT * FROM game")
def build_dim_game(spark, sf_dir):
    return loads.build_dim_game(files.stored(clean_games(spark, sf_dir), "clean"))


@query("SELECT * FROM genre_dim")
def build_dim_genre(spark, sf_dir):
    return loads.build_dim_genre(clean_games(spark, sf_dir), loads.genre_seed(spark))


@query("SELECT * FROM fact")
def build_fact_sales(spark, sf_dir):
    tables = star(spark, sf_dir)
    dimensions = [tables[t] for t in ("dim_game", "dim_platform", "dim_genre", "dim_region")]
    return loads.build_fact_sales(clean_games(spark, sf_dir), *dimensions)


@query("""WITH long_titles AS (
      SELECT repeat('x', 300) || title AS title, min_by(publisher, row_ord) AS publisher FROM wide GROUP BY ALL)
    SELECT row_number() OVER (ORDER BY substr(md5(title), 1, 4), title) AS game_id, title FROM long_titles""")
def build_dim_game_long_titles(spark, sf_dir):
    """Titles that differ only beyond their first 300 characters are games of their own."""
    wide = wide_sales(spark, sf_dir).withColumn("title", F.concat(F.lit("x" * 300), "title"))
    clean = cleaning.clean_for_warehouse(wide, ORDER)
    return loads.build_dim_game(files.stored(clean, "clean")).select("game_id", "title")


_FIRST_LOAD = f"""
    WITH early AS (
      SELECT * FROM wide WHERE release_date < '{CUTOFF}'
      QUALIFY row_number() OVER (PARTITION BY title ORDER BY row_ord) = 1),
    loaded AS (
      SELECT row_number() OVER (ORDER BY substr(md5(title), 1, 4), title) AS game_id, title, publisher, developer, critic_score
      FROM early),
    missing AS (SELECT clean_games.* FROM clean_games ANTI JOIN loaded USING (title)),
    first_load AS (SELECT count(*) AS n FROM loaded)
    SELECT * FROM loaded UNION ALL
    SELECT n + row_number() OVER (ORDER BY substr(md5(title), 1, 4), title),
      title, publisher, developer, critic_score FROM missing, first_load"""


@query(_FIRST_LOAD)
def merge_insert_new(spark, sf_dir):
    """Games of an earlier load, and those a full load adds to them."""
    wide = wide_sales(spark, sf_dir)
    early = cleaning.clean_for_warehouse(wide.filter(F.col("release_date") < CUTOFF), ORDER)
    target = new_warehouse(spark)
    target.create_tables()
    for batch in (early, cleaning.clean_for_warehouse(wide, ORDER)):
        target.append(loads.new_rows(loads.games(batch), target.table("dim_game"), "title", "game_id"), "dim_game")
    return target.table("dim_game").select("game_id", "title", "publisher", "developer", "critic_score")


@query("""SELECT console AS platform_code, min(row_ord) AS row_ord FROM wide
    WHERE console NOT IN (SELECT platform_code FROM seed_platform) GROUP BY console""")
def insert_ignore(spark, sf_dir):
    """Platforms of the data that the platform dimension does not know."""
    rows = wide_sales(spark, sf_dir).select(F.col("console").alias("platform_code"), "row_ord")
    return joins.insert_ignore(rows, star(spark, sf_dir)["dim_platform"], "platform_code", ORDER)


@query("SELECT game_id, title, publisher, developer, critic_score, 'vgchartz' AS data_source FROM game")
def append_table(spark, sf_dir):
    """Two appends, by whether a critic score is known; the source column takes its default."""
    rows = star(spark, sf_dir)["dim_game"].select("game_id", "title", "publisher", "developer", "critic_score")
    target = new_warehouse(spark)
    target.create_tables()
    target.append(rows.filter("critic_score IS NULL"), "dim_game")
    target.append(rows.filter("critic_score IS NOT NULL"), "dim_game")
    return target.table("dim_game").select(*rows.columns, "data_source")


@query("SELECT game_id, title FROM game")
def full_refresh(spark, sf_dir):
    """A table loaded twice holds the second load only."""
    rows = star(spark, sf_dir)["dim_game"].select("game_id", "title")
    target = new_warehouse(spark)
    target.create_tables()
    target.refresh(rows.withColumn("game_id", -F.col("game_id")), "dim_game")
    target.refresh(rows, "dim_game")
    return target.table("dim_game").select("game_id", "title")


@query("""SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, CAST(d AS DATE) AS full_date,
      CAST(year(d) AS SMALLINT) AS year, CAST(quarter(d) AS SMALLINT) AS quarter, CAST(month(d) AS SMALLINT) AS month,
      monthname(d) AS month_name, CAST(week(d) AS SMALLINT) AS week, CAST(dayofweek(d) AS SMALLINT) AS day_of_week,
      dayofweek(d) IN (0, 6) AS is_weekend, coalesce(n, 0) AS order_count
    FROM (SELECT unnest(generate_series(DATE '1970-01-01', DATE '2030-12-31', INTERVAL 1 DAY)) AS d)
      LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1) USING (d)""")
def calendar_dimension(spark, sf_dir):
    """The calendar, with the number of orders of each day."""
    orders = (
        table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("full_date"))
        .agg(F.count(F.lit(1)).alias("n")))
    return (
        loads.calendar_dimension(spark, CALENDAR_START, CALENDAR_END).join(orders, "full_date", "left")
        .withColumn("order_count", F.coalesce("n", F.lit(0))).drop("n"))


@query("""SELECT 'dim_game' AS table_name, count(*) AS row_count FROM game
    UNION ALL SELECT 'dim_genre', count(*) FROM genre_dim
    UNION ALL SELECT 'dim_platform', count(*) FROM seed_platform
    UNION ALL SELECT 'dim_region', count(*) FROM seed_region
    UNION ALL SELECT 'fact_sales', count(*) FROM fact""")
def table_counts(spark, sf_dir):
    return star_warehouse(spark, sf_dir).counts(loads.LOADED_TABLES)


_QUALITY = """
    SELECT "check", observed, expectation, CASE expectation WHEN '>0' THEN observed > 0 ELSE observed = 0 END AS passed FROM (
      SELECT 'fact_sales_not_empty' AS "check", count(*) AS observed, '>0' AS expectation FROM fact
      UNION ALL SELECT 'dim_game_not_empty', count(*), '>0' FROM game
      UNION ALL SELECT 'null_sales', count(*), '=0' FROM fact WHERE sales_millions IS NULL
      UNION ALL SELECT 'fact_without_region', count(*), '=0' FROM fact WHERE region_id IS NULL)"""


@query(_QUALITY)
def weekly_refresh(spark, sf_dir):
    """Source check, dimensions, facts and quality checks, run twice: the second run changes nothing."""
    root = scratch_path(spark, "sources")
    enriched = f"{root}/enriched"
    files.write_parquet(wide_sales(spark, sf_dir), enriched)
    target = new_warehouse(spark)
    for _ in range(2):
        checks = loads.weekly_refresh(target, enriched, f"{root}/raw.csv", ORDER)
    return checks


@query("""SELECT title, region_code, platform_id, release_year, sales_millions, global_sales
    FROM fact JOIN game USING (game_id) JOIN seed_region USING (region_id)""")
def weekly_loads(spark, sf_dir):
    """Two weeks without a title in common, the second loaded twice: all facts are there, once."""
    root = scratch_path(spark, "weeks")
    target, wide = new_warehouse(spark), wide_sales(spark, sf_dir)
    for week in (0, 1, 1):
        source = f"{root}/{week}"
        if not files.is_complete(spark, source):
            files.write_parquet(wide.filter(F.expr("row_ord div 5 % 2") == week), source)
        loads.weekly_refresh(target, source, f"{root}/raw.csv", ORDER)
    return (
        target.table("fact_sales").join(target.table("dim_game").select("game_id", "title"), "game_id")
        .join(target.table("dim_region").select("region_id", "region_code"), "region_id")
        .select("title", "region_code", "platform_id", "release_year", "sales_millions", "global_sales"))


# Games whose sales a later source corrects.
_CORRECTED = "CAST(regexp_extract(title, '[(]([0-9]+)[)]$', 1) AS BIGINT) % 100 = 7"


@query(f"""SELECT sale_id, game_id, platform_id, region_id, release_year, global_sales,
      CASE WHEN {_CORRECTED} AND region_code = 'NA' THEN sales_millions + 1 ELSE sales_millions END AS sales_millions
    FROM fact JOIN game USING (game_id) JOIN seed_region USING (region_id) WHERE NOT ({_CORRECTED} AND region_code = 'JP')""")
def merge_changed_facts(spark, sf_dir):
    """A full load, then a source of some games: one of their facts has changed, one has gone, the rest stay."""
    root = scratch_path(spark, "corrections")
    target, wide = new_warehouse(spark), wide_sales(spark, sf_dir)
    loads.load_warehouse(target, wide, ORDER)
    corrected = wide.filter(_CORRECTED).withColumns({"na_sales": F.col("na_sales") + 1, "jp_sales": F.lit(None).cast("double")})
    files.write_parquet(corrected, f"{root}/corrected")
    for _ in range(2):
        loads.weekly_refresh(target, f"{root}/corrected", f"{root}/raw.csv", ORDER)
    return facts(target.table("fact_sales")).drop("genre_id")


@query("""SELECT game_id, title, CASE WHEN critic_score IS NULL THEN 'unscored' ELSE 'scored' END AS load_id FROM game""")
def append_once(spark, sf_dir):
    """Two loads with an id, each repeated; one of them was interrupted when a part of its rows was written."""
    rows = star(spark, sf_dir)["dim_game"].select("game_id", "title", "critic_score")
    target = new_warehouse(spark)
    target.create_tables()
    scored, unscored = rows.filter("critic_score IS NOT NULL"), rows.filter("critic_score IS NULL")
    target.begin("scored", "dim_game")
    target.append(scored.filter("game_id % 3 = 0").withColumn(tables.LOAD, F.lit("scored")), "dim_game")
    for _ in range(2):
        target.append(scored, "dim_game", load_id="scored")
        target.append(unscored, "dim_game", load_id="unscored")
    return spark.table(target.name("dim_game")).select("game_id", "title", tables.LOAD)


@query("""SELECT 'dim_game' AS table_name, count(*) AS row_count FROM game
    UNION ALL SELECT 'dim_genre', count(*) FROM genre_dim
    UNION ALL SELECT 'dim_platform', count(*) FROM seed_platform
    UNION ALL SELECT 'dim_region', count(*) FROM seed_region
    UNION ALL SELECT 'fact_sales', count(*) FROM fact""")
def load_warehouse(spark, sf_dir):
    """A full load of an empty warehouse."""
    return loads.load_warehouse(new_warehouse(spark), wide_sales(spark, sf_dir), ORDER)


# ---- reports ----------------------------------------------------------------


def _top(key: str) -> str:
    return f"""SELECT {key}, coalesce(sum(total_sales), 0) AS total_sales FROM wide WHERE {key} IS NOT NULL
        GROUP BY {key} ORDER BY total_sales DESC, {key} LIMIT 10"""


@query(_top("genre"))
def top_genres(spark, sf_dir):
    return reports.top_totals(wide_sales(spark, sf_dir), "genre")


@query(_top("console"))
def top_platforms(spark, sf_dir):
    return reports.top_totals(wide_sales(spark, sf_dir), "console")


@query(_top("title"))
def top_titles(spark, sf_dir):
    return reports.top_totals(wide_sales(spark, sf_dir), "title")


@query("""SELECT CAST(substr(release_date, 1, 4) AS INTEGER) AS release_year, sum(total_sales) AS total_sales FROM wide
    WHERE release_date IS NOT NULL AND substr(release_date, 1, 4) BETWEEN '1980' AND '2020' GROUP BY 1""")
def yearly_totals(spark, sf_dir):
    return reports.yearly_totals(wide_sales(spark, sf_dir), 1980, 2020)


@query("SELECT continent, sum(sales_millions) AS sales_millions FROM long_sales GROUP BY continent ORDER BY 2 DESC")
def sales_by_continent(spark, sf_dir):
    return reports.sales_by_continent(long_sales(spark, sf_dir))


@query("""SELECT count(*) AS total_rows, count(DISTINCT title) AS distinct_titles, count(DISTINCT platform) AS distinct_platforms,
    count(DISTINCT genre) AS distinct_genres, count(DISTINCT continent) AS distinct_continents,
    min(release_year) AS min_year, max(release_year) AS max_year FROM long_sales""")
def dataset_summary(spark, sf_dir):
    return reports.dataset_summary(files.stored(long_sales(spark, sf_dir), "long"))


@query("""SELECT count(DISTINCT title) AS distinct_titles, count(DISTINCT console) AS distinct_consoles,
    count(DISTINCT genre) AS distinct_genres, count(DISTINCT publisher) AS distinct_publishers FROM wide""")
def wide_distinct_counts(spark, sf_dir):
    return reports.distinct_counts(wide_sales(spark, sf_dir))


@query("""SELECT 'title' AS column_name, count(DISTINCT title) AS exact_count, true AS within_error FROM wide
    UNION ALL SELECT 'console', count(DISTINCT console), true FROM wide
    UNION ALL SELECT 'genre', count(DISTINCT genre), true FROM wide
    UNION ALL SELECT 'publisher', count(DISTINCT publisher), true FROM wide""")
def sketched_distinct_counts(spark, sf_dir):
    """Different values by sketches per console, merged, beside the exact counts."""
    columns, wide = ["title", "console", "genre", "publisher"], wide_sales(spark, sf_dir)
    parts = reports.distinct_sketches(wide, columns, [F.expr("row_ord % 7").alias("part"), F.col("console").alias("of")])
    about = reports.sketched_counts(reports.merge_sketches(parts, columns), columns)
    names = [f"distinct_{c}s" for c in columns]
    rows = [df.unpivot([], names, "name", kind) for df, kind in ((reports.distinct_counts(wide, columns), "exact_count"), (about, "estimate"))]
    within = F.abs(F.col("estimate") - F.col("exact_count")) <= reports.sketch_error() * F.col("exact_count")
    return rows[0].join(rows[1], "name").select(
        F.regexp_extract("name", "distinct_(.*)s", 1).alias("column_name"), "exact_count", within.alias("within_error"))


@query("""SELECT 'genre' AS dimension, genre AS value, sum(sales_millions) AS sales_millions FROM long_sales GROUP BY genre
    UNION ALL SELECT 'platform', platform, sum(sales_millions) FROM long_sales GROUP BY platform
    UNION ALL SELECT 'continent', continent, sum(sales_millions) FROM long_sales GROUP BY continent
    UNION ALL SELECT 'release_year', CAST(release_year AS VARCHAR), sum(sales_millions) FROM long_sales WHERE release_year IS NOT NULL GROUP BY release_year
    UNION ALL SELECT 'all', NULL, sum(sales_millions) FROM long_sales""")
def totals_by_each(spark, sf_dir):
    """Totals by genre, platform, continent and year from one scan."""
    return reports.totals_by_each(long_sales(spark, sf_dir), ["genre", "platform", "continent", "release_year"])


def _enriched(spark, sf_dir) -> DataFrame:
    return enrichment.enrich(wide_sales(spark, sf_dir), responses(spark, sf_dir))


@query("""SELECT count(*) AS total, count(rawg_id) AS matched, 100.0::DOUBLE * count(rawg_id) / count(*) AS match_rate_pct
    FROM enriched""")
def match_rate(spark, sf_dir):
    return reports.match_rate(_enriched(spark, sf_dir))


@query(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, (count(*) - count({c}))::DOUBLE / count(*) AS null_ratio FROM wide"
    for c in SALES_COLUMNS))
def null_profile(spark, sf_dir):
    return reports.null_profile(wide_sales(spark, sf_dir))


@query("SELECT data_source, count(*) AS row_count FROM enriched GROUP BY data_source")
def value_counts(spark, sf_dir):
    return reports.value_counts(_enriched(spark, sf_dir), "data_source")


# ---- enrichment -------------------------------------------------------------

_TITLE = "(p_name || ' (' || p_partkey || ')')"


@query("SELECT row_ord, title, rawg_id, rawg_released, rawg_metacritic, rawg_developers FROM wide LEFT JOIN lookups USING (title)")
def enrich_left_join(spark, sf_dir):
    found = enrichment.title_matches(responses(spark, sf_dir))
    return joins.enrich_by_title(wide_sales(spark, sf_dir).select("row_ord", "title"), found)


@query(f"SELECT {_TITLE} AS title, id AS rawg_id, name AS matched_name FROM part LEFT JOIN best ON {_TITLE} = title")
def best_match(spark, sf_dir):
    results = responses(spark, sf_dir).select("title", catalog.parse_results(F.col("payload")).alias("results"))
    game = results.select("title", catalog.best_match(F.col("results"), F.col("title")).alias("game"))
    return game.select("title", F.col("game.id").alias("rawg_id"), F.col("game.name").alias("matched_name"))


@query(f"""WITH firsts AS (SELECT * FROM candidates QUALIFY row_number() OVER (PARTITION BY title ORDER BY step) = 1)
    SELECT {_TITLE} AS title, id AS rawg_id, rating AS rawg_rating, genres AS rawg_genres, tags AS rawg_tags,
      esrb AS esrb_rating, background_image AS background_img, released AS rawg_released, metacritic AS rawg_metacritic,
      developers AS rawg_developers
    FROM part LEFT JOIN firsts ON {_TITLE} = title""")
def parse_catalog_json(spark, sf_dir):
    """Both projections of the first candidate."""
    game = catalog.first_result(catalog.parse_results(F.col("payload")))
    first = responses(spark, sf_dir).select("title", game.alias("game"))
    record = F.col("game")
    return first.select("title", *catalog.detail_columns(record), *catalog.enrichment_columns(record)[1:])


# An earlier run that looked at rows without developer only.
_EARLIER = f"""
    earlier AS (SELECT * FROM lookups WHERE title IN (SELECT title FROM wide WHERE developer IS NULL)),
    now AS (SELECT {_TITLE} AS title, rawg_id, rawg_released, rawg_metacritic, rawg_developers
      FROM part LEFT JOIN lookups ON {_TITLE} = title WHERE {_TITLE} IN (SELECT title FROM incomplete))"""


def _earlier_run(spark, sf_dir) -> DataFrame:
    wide = wide_sales(spark, sf_dir)
    looked_up = wide.filter("developer IS NULL").select("title").distinct()
    found = enrichment.title_matches(responses(spark, sf_dir).join(looked_up, "title", "left_semi"))
    return joins.tag_source(joins.enrich_by_title(wide, found))


@query(f"WITH {_EARLIER} SELECT title, min(row_ord) AS row_ord FROM incomplete ANTI JOIN earlier USING (title) GROUP BY title")
def resume_anti_join(spark, sf_dir):
    return enrichment.titles_to_look_up(wide_sales(spark, sf_dir), ORDER, _earlier_run(spark, sf_dir))


@query(f"""WITH {_EARLIER} SELECT title, rawg_id, rawg_released, rawg_metacritic, 'earlier' AS rawg_developers FROM earlier
    UNION ALL SELECT * FROM now WHERE title NOT IN (SELECT title FROM earlier)""")
def checkpoint_union(spark, sf_dir):
    """Earlier and new results; the earlier ones, marked here, win."""
    earlier = enrichment.known_titles(_earlier_run(spark, sf_dir)).withColumn("rawg_developers", F.lit("earlier"))
    titles = enrichment.distinct_titles(enrichment.incomplete_rows(wide_sales(spark, sf_dir)))
    new = enrichment.title_matches(responses(spark, sf_dir).join(titles, "title", "left_semi"))
    return joins.union_previous(earlier, new)


@query("""SELECT row_ord, CASE WHEN id IS NULL THEN 'vgchartz' ELSE 'vgchartz+rawg' END AS data_source
    FROM wide LEFT JOIN best USING (title)""")
def provenance_tag(spark, sf_dir):
    found = enrichment.title_matches(responses(spark, sf_dir))
    return joins.tag_source(joins.enrich_by_title(wide_sales(spark, sf_dir), found)).select("row_ord", "data_source")


@query("SELECT * FROM enriched")
def enrich_catalog(spark, sf_dir):
    """A first run, written as an enriched dataset, and a second one that resumes from it."""
    wide, answers = wide_sales(spark, sf_dir), responses(spark, sf_dir)
    first = scratch_path(spark, "enriched")
    files.write_parquet(_earlier_run(spark, sf_dir).filter("developer IS NULL"), first)
    return enrichment.enrich(wide, answers, previous=files.read_parquet(spark, first))


# ---- quality ----------------------------------------------------------------


@query(_QUALITY)
def quality_checks(spark, sf_dir):
    tables = star(spark, sf_dir)
    return quality.quality_checks(tables["fact_sales"], tables["dim_game"])


def _repeated(source: str, keys: str, constraint: str) -> str:
    not_null = " AND ".join(f"{k} IS NOT NULL" for k in keys.split(","))
    return f"""SELECT '{constraint}' AS "constraint", count(*) AS duplicate_keys,
        CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows
        FROM (SELECT count(*) AS n FROM {source} WHERE {not_null} GROUP BY {keys} HAVING count(*) > 1)"""


@query(" UNION ALL ".join([
    _repeated("game", "title,publisher", "dim_game(title,publisher)"),
    _repeated("seed_platform", "platform_code", "dim_platform(platform_code)"),
    _repeated("genre_dim", "genre_name", "dim_genre(genre_name)"),
    _repeated("seed_region", "region_code", "dim_region(region_code)"),
    _repeated("wide", "title,publisher", "wide(title,publisher)")]))
def check_unique(spark, sf_dir):
    wide = quality.check_unique(wide_sales(spark, sf_dir), ["title", "publisher"], "wide(title,publisher)")
    return quality.check_star_unique(star(spark, sf_dir)).unionByName(wide)


@query("""SELECT 'fact_sales.game_id' AS "constraint", count(*) AS orphan_rows FROM fact
      WHERE game_id NOT IN (SELECT game_id FROM game WHERE critic_score IS NOT NULL)
    UNION ALL SELECT 'fact_sales.platform_id', count(*) FROM fact WHERE platform_id NOT IN (SELECT platform_id FROM seed_platform)
    UNION ALL SELECT 'fact_sales.genre_id', count(*) FROM fact WHERE genre_id NOT IN (SELECT genre_id FROM seed_genre)
    UNION ALL SELECT 'fact_sales.region_id', count(*) FROM fact WHERE region_id NOT IN (SELECT region_id FROM seed_region)""")
def check_orphans(spark, sf_dir):
    """Facts against dimensions that lack games without score and genres beyond the seeds."""
    tables = star(spark, sf_dir)
    return quality.check_orphans(tables["fact_sales"], {
        "game_id": tables["dim_game"].filter("critic_score IS NOT NULL"), "platform_id": tables["dim_platform"],
        "genre_id": loads.genre_seed(spark), "region_id": tables["dim_region"]})


@query("""SELECT 'wide.title not null' AS rule, count(*) - count(title) AS violations FROM wide
    UNION ALL SELECT 'wide.publisher not null', count(*) - count(publisher) FROM wide
    UNION ALL SELECT 'wide.platform_type in domain', count(*) FROM wide
      LEFT JOIN seed_platform ON console = platform_code
      WHERE coalesce(platform_type, 'arcade') NOT IN ('console', 'handheld', 'pc', 'mobile', 'other')
    UNION ALL SELECT 'fact_sales.game_id not null', count(*) - count(game_id) FROM fact
    UNION ALL SELECT 'fact_sales.region_id not null', count(*) - count(region_id) FROM fact
    UNION ALL SELECT 'fact_sales.platform_id not null', count(*) - count(platform_id) FROM fact""")
def check_domain(spark, sf_dir):
    types = platform_seed(spark).select(F.col("platform_code").alias("console"), "platform_type")
    typed = (
        wide_sales(spark, sf_dir).join(types, "console", "left")
        .withColumn("platform_type", F.coalesce("platform_type", F.lit("arcade"))))
    return quality.check_domain(typed, "wide", ["title", "publisher"], {"platform_type": PLATFORM_TYPES}).unionByName(
        quality.check_domain(star(spark, sf_dir)["fact_sales"], "fact_sales", ["game_id", "region_id", "platform_id"]))


_METRICS = """WITH kept AS (SELECT * FROM wide WHERE title IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY title, release_date ORDER BY row_ord) = 1)
    SELECT 'rows_read' AS stage, count(*) AS "rows" FROM wide
    UNION ALL SELECT 'rows_without_key', count(*) - count(title) FROM wide
    UNION ALL SELECT 'duplicates_removed', (SELECT count(*) FROM wide) - (SELECT count(*) FROM kept)
    UNION ALL SELECT 'rows_after_clean', count(*) FROM kept
    UNION ALL SELECT 'rows_after_unpivot', CAST(sum((coalesce(na_sales, 0) > 0)::INT + (coalesce(pal_sales, 0) > 0)::INT
      + (coalesce(jp_sales, 0) > 0)::INT + (coalesce(other_sales, 0) > 0)::INT) AS BIGINT) FROM kept"""


@query(_METRICS)
def stage_metrics(spark, sf_dir):
    wide = wide_sales(spark, sf_dir)
    clean = files.stored(cleaning.clean_sales(wide, ORDER), "clean")
    return quality.stage_metrics(wide, clean, reshape.unpivot_sales(clean))


@query("""SELECT count(*) AS prepared, (SELECT count(*) FROM fact) AS loaded,
    100.0::DOUBLE * (SELECT count(*) FROM fact) / count(*) AS percent_loaded FROM long_cells""")
def load_progress(spark, sf_dir):
    return quality.load_progress(long_sales(spark, sf_dir), star(spark, sf_dir)["fact_sales"])


# ---- files ------------------------------------------------------------------


def write_raw_csv(spark, sf_dir, path: str) -> None:
    """The wide table as CSV in input order, missing values as various missing-value texts."""
    missing = {"genre": "N/A", "publisher": "null", "developer": "None", "release_date": "NaN", "critic_score": ""}
    rows = wide_sales(spark, sf_dir).select(*[
        F.coalesce(F.col(c).cast("string"), F.lit(missing[c])).alias(c) if c in missing else F.col(c) for c in WIDE_COLUMNS])
    (rows.withColumn("developer", F.concat("developer", F.lit(', "the"')))
     .orderBy("row_ord").write.option("header", True).option("quote", '"').option("escape", '"').csv(path))


_CSV_DEVELOPER = """coalesce(developer, 'None') || ', "the"' AS developer"""


@query(f"""SELECT row_ord, title, console, genre, publisher, {_CSV_DEVELOPER}, critic_score, release_date,
    na_sales, pal_sales, jp_sales, other_sales, total_sales FROM wide""")
def csv_scan(spark, sf_dir):
    path = scratch_path(spark, "raw.csv")
    write_raw_csv(spark, sf_dir, path)
    rows = cleaning.coerce_numeric(files.read_csv(spark, path))
    return rows.withColumn("row_ord", F.col("row_ord").cast("bigint"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate FROM lineitem")
def parquet_scan(spark, sf_dir):
    rows = files.read_parquet(spark, f"{sf_dir}/lineitem.parquet")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate")


@query("SELECT 'csv' AS source, row_ord, title FROM wide UNION ALL SELECT 'enriched', row_ord, title FROM enriched")
def resolve_source(spark, sf_dir):
    """The CSV while there is no enriched dataset, and that dataset once it exists."""
    root = scratch_path(spark, "sources")
    csv, enriched = f"{root}/raw.csv", f"{root}/enriched"
    write_raw_csv(spark, sf_dir, csv)

    def resolved(source: str) -> DataFrame:
        rows = files.resolve_source(spark, enriched, csv)
        return rows.select(F.lit(source).alias("source"), F.col("row_ord").cast("bigint").alias("row_ord"), "title")

    before = resolved("csv")
    files.write_parquet(_enriched(spark, sf_dir), enriched)
    return before.unionByName(resolved("enriched"))


@query("SELECT * FROM wide")
def parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "copy")
    files.write_parquet(wide_sales(spark, sf_dir), path)
    return files.read_parquet(spark, path)


_LONG = "title, platform, genre, publisher, developer, release_year, critic_score, region_code, region_label, sales_millions"


@query(f"""SELECT {_LONG}, continent, release_year AS "year" FROM long_sales WHERE continent = 'Europe' AND release_year = 1997""")
def partitioned_write_prune(spark, sf_dir):
    """The lake, asked for one folder."""
    path = scratch_path(spark, "lake")
    lake.write_lake(long_sales(spark, sf_dir).drop("user_score"), path)
    return lake.read_lake(spark, path).filter("continent = 'Europe' AND year = 1997")


@query(f"""SELECT {_LONG}, continent, release_year AS "year" FROM long_sales
    WHERE release_year IS NOT NULL AND platform = 'PC' AND title BETWEEN 'f' AND 'p'""")
def clustered_read(spark, sf_dir):
    """The lake along a Z-curve of platform and title, asked for a range of both through its zone map."""
    path = scratch_path(spark, "clustered")
    lake.write_lake(files.stored(long_sales(spark, sf_dir).drop("user_score"), "long"), path, cluster=["platform", "title"])
    return lake.read_where(spark, path, {"platform": "PC", "title": ("f", "p")})


@query("""SELECT continent, release_year AS "year", count(*) AS row_count, min(title) AS least_title, max(title) AS most_title,
      min(platform) AS least_platform, max(platform) AS most_platform
    FROM long_sales WHERE release_year IS NOT NULL GROUP BY ALL""")
def zone_map(spark, sf_dir):
    """The zones of all files, put together by folder."""
    path = scratch_path(spark, "clustered")
    lake.write_lake(files.stored(long_sales(spark, sf_dir), "long"), path, cluster=["platform", "title"])
    zones = spark.read.parquet(f"{path}/{lake.ZONES}")
    return zones.groupBy(
        F.url_decode(F.regexp_extract("path", "continent=([^/]+)", 1)).alias("continent"),
        F.regexp_extract("path", "year=([0-9]+)", 1).cast("int").alias("year")).agg(
        F.sum("row_count").alias("row_count"), *[f(f"{n}_{c}").alias(f"{n}_{c}") for c in ("title", "platform") for n, f in (("least", F.min), ("most", F.max))])


@query(f"""SELECT {_LONG}, continent, release_year AS "year" FROM long_sales WHERE release_year IS NOT NULL""")
def publish_lake(spark, sf_dir):
    """The lake copied to another place with its folders."""
    source, target = scratch_path(spark, "lake"), scratch_path(spark, "published")
    lake.write_lake(long_sales(spark, sf_dir).drop("user_score"), source)
    lake.publish(spark, source, target, lake.PARTITIONS)
    return lake.read_lake(spark, target)


@query("""SELECT DISTINCT 'continent=' || continent || '/year=' || release_year AS folder, true AS has_bytes
    FROM long_sales WHERE release_year IS NOT NULL""")
def file_manifest(spark, sf_dir):
    """The lake's folders as its file list shows them; file names and sizes differ from run to run."""
    path = scratch_path(spark, "lake")
    lake.write_lake(long_sales(spark, sf_dir), path)
    folder = F.url_decode(F.regexp_extract("path", "continent=[^/]+/year=[^/]+", 0)).alias("folder")
    return lake.manifest(spark, path).groupBy(folder).agg((F.min("size_bytes") > 0).alias("has_bytes"))


@query("""SELECT 'continent=' || continent || '/year=' || release_year AS folder, true AS files_agree, true AS bytes_agree,
      count(*) AS row_count FROM long_sales WHERE release_year IS NOT NULL GROUP BY ALL""")
def manifest_totals(spark, sf_dir):
    """Files and bytes of each folder in the manifest against those that a read of the rows meets, and the rows."""
    path = scratch_path(spark, "lake")
    lake.write_lake(long_sales(spark, sf_dir), path)

    def folder(name: str):
        return F.url_decode(F.regexp_extract(name, "continent=[^/]+/year=[^/]+", 0)).alias("folder")

    listed = lake.manifest(spark, path).groupBy(folder("path")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("size_bytes").alias("bytes"))
    per_file = lake.read_lake(spark, path).groupBy("_metadata.file_path", "_metadata.file_size").agg(F.count(F.lit(1)).alias("n"))
    met = per_file.groupBy(folder("file_path")).agg(
        F.count(F.lit(1)).alias("met"), F.sum("file_size").alias("size"), F.sum("n").alias("row_count"))
    return listed.join(met, "folder", "full").select(
        "folder", F.col("files").eqNullSafe(F.col("met")).alias("files_agree"),
        F.col("bytes").eqNullSafe(F.col("size")).alias("bytes_agree"), "row_count")


@query("""SELECT continent, release_year AS "year", count(*) AS source_rows, count(*) AS target_rows, true AS complete
    FROM long_sales WHERE release_year IS NOT NULL GROUP BY ALL""")
def publish_outcome(spark, sf_dir):
    source, target = scratch_path(spark, "lake"), scratch_path(spark, "published")
    lake.write_lake(long_sales(spark, sf_dir), source)
    return lake.publish(spark, source, target, lake.PARTITIONS)


@query(f"""WITH kept AS (SELECT * FROM wide WHERE title IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY title, release_date ORDER BY row_ord) = 1),
    cells AS (SELECT *, 'NA' AS region_code, na_sales AS sales_millions FROM kept WHERE na_sales > 0
      UNION ALL SELECT *, 'EU', pal_sales FROM kept WHERE pal_sales > 0
      UNION ALL SELECT *, 'JP', jp_sales FROM kept WHERE jp_sales > 0
      UNION ALL SELECT *, 'Other', other_sales FROM kept WHERE other_sales > 0)
    SELECT title, coalesce(console, 'Unknown') AS platform, coalesce(genre, 'Unknown') AS genre, publisher,
      {_CSV_DEVELOPER}, CAST(substr(release_date, 1, 4) AS INTEGER) AS release_year, critic_score,
      region_code, region_label, continent, sales_millions
    FROM cells JOIN seed_region USING (region_code)""")
def stage_sales(spark, sf_dir):
    """From a raw CSV to the long table, with the raw copy and the lake beside it."""
    root = scratch_path(spark, "staging")
    write_raw_csv(spark, sf_dir, f"{root}/raw.csv")
    staged = staging.stage_sales(spark, f"{root}/raw.csv", f"{root}/out")
    return staged.long.select(*[c for c in GAME_COLUMNS if c != "user_score"], "region_code", "region_label", "continent", "sales_millions")


@query(_METRICS)
def observed_metrics(spark, sf_dir):
    """What the writes of a staging run counted."""
    root = scratch_path(spark, "staging")
    write_raw_csv(spark, sf_dir, f"{root}/raw.csv")
    return staging.stage_sales(spark, f"{root}/raw.csv", f"{root}/out").metrics
