"""The registered queries in SQL, from the driver's tables alone.

Each oracle is a body over shared building blocks; ``sql`` puts the blocks the
body needs in front of it.
"""

from __future__ import annotations

import re

from pixeltally.schemas import GENRE_SEED, PLATFORM_SEED, REGION_SEED
from pixeltally.workload.tables import CONSOLES, GENRES, MARKETS


def _case(column: str, values: dict[str, str]) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items())
    return f"CASE {column} {arms} END"


def _seed(rows: list[tuple], columns: str) -> str:
    def literal(value) -> str:
        return "NULL" if value is None else str(value) if isinstance(value, int) else f"'{value}'"
    values = ", ".join("(" + ", ".join(map(literal, (i, *row))) + ")" for i, row in enumerate(rows, 1))
    return f"SELECT * FROM (VALUES {values}) AS t({columns})"


def _sold(market: str) -> str:
    return f"sum(CASE WHEN {_case('r_name', MARKETS)} = '{market}' THEN l_quantity END) AS {market}"


def _ids(source: str, key: str) -> str:
    """Ids by hash bucket and key, as the library numbers rows."""
    return f"row_number() OVER (ORDER BY substr(md5({key}), 1, 4), {key})"


BLOCKS = {
    "wide": f"""
        SELECT p_partkey * 5 + (p_partkey + CAST(substr(o_orderpriority, 1, 1) AS BIGINT)) % 5 AS row_ord,
          p_name || ' (' || p_partkey || ')' AS title,
          {_case('o_orderpriority', CONSOLES)} AS console,
          CASE WHEN p_partkey % 17 <> 0 THEN {_case('p_type', GENRES)} END AS genre,
          CASE WHEN p_partkey % 13 <> 0 THEN p_brand END AS publisher,
          CASE WHEN p_partkey % 11 <> 0 THEN p_type || ' Studio' END AS developer,
          CASE WHEN p_size <= 20 THEN p_size * 0.5::DOUBLE END AS critic_score,
          CASE WHEN p_partkey % 19 <> 0 THEN strftime(first_order, '%Y-%m-%d') END AS release_date,
          na_sales, pal_sales, jp_sales, other_sales, total_sales
        FROM (
          SELECT l_partkey, o_orderpriority, {', '.join(map(_sold, ['na_sales', 'pal_sales', 'jp_sales', 'other_sales']))},
            sum(l_quantity) AS total_sales, min(o_orderdate) AS first_order
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
            JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
          GROUP BY l_partkey, o_orderpriority) AS sums
        JOIN part ON l_partkey = p_partkey""",
    "clean_games": """
        SELECT row_ord, title, coalesce(console, 'Unknown') AS platform,
          coalesce(genre, 'Unknown') AS genre, publisher, developer, critic_score, CAST(NULL AS DOUBLE) AS user_score,
          release_date, CAST(substr(release_date, 1, 4) AS INTEGER) AS release_year,
          na_sales, pal_sales, jp_sales, other_sales, total_sales
        FROM wide WHERE title IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY title ORDER BY row_ord) = 1""",
    "long_cells": """
        SELECT *, 'NA' AS region_code, na_sales AS sales_millions, 1 AS place FROM clean_games WHERE na_sales > 0
        UNION ALL SELECT *, 'EU', pal_sales, 2 FROM clean_games WHERE pal_sales > 0
        UNION ALL SELECT *, 'JP', jp_sales, 3 FROM clean_games WHERE jp_sales > 0
        UNION ALL SELECT *, 'Other', other_sales, 4 FROM clean_games WHERE other_sales > 0""",
    "seed_region": _seed(REGION_SEED, "region_id, region_code, region_label, continent, continent_code"),
    "seed_platform": _seed(
        PLATFORM_SEED, "platform_id, platform_code, platform_name, manufacturer, platform_type, generation, launch_year"),
    "seed_genre": _seed(GENRE_SEED, "genre_id, genre_name, category"),
    "long_sales": """
        SELECT title, platform, genre, publisher, developer, release_year, critic_score, region_code,
          region_label, continent, sales_millions
        FROM long_cells JOIN seed_region USING (region_code)""",
    "game": f"""
        SELECT {_ids('clean_games', 'title')} AS game_id, title, publisher, developer, critic_score, user_score
        FROM clean_games""",
    "genre_dim": f"""
        SELECT CAST(genre_id AS BIGINT) AS genre_id, genre_name, category FROM seed_genre
        UNION ALL
        SELECT {len(GENRE_SEED)} + {_ids('fresh', 'genre')}, genre, 'Other'
        FROM (SELECT DISTINCT genre FROM clean_games WHERE genre NOT IN (SELECT genre_name FROM seed_genre)) AS fresh""",
    "fact": """
        SELECT (game_id - 1) * 4 + place AS sale_id, game_id, CAST(platform_id AS BIGINT) AS platform_id, genre_id,
          CAST(region_id AS BIGINT) AS region_id, release_year, sales_millions, total_sales AS global_sales
        FROM long_cells AS c JOIN game USING (title) JOIN seed_region USING (region_code)
          LEFT JOIN seed_platform ON platform = platform_code LEFT JOIN genre_dim ON genre = genre_name""",
    "v_continent_genre": """
        SELECT continent, genre_name, release_year, count(DISTINCT fact.game_id) AS nb_games,
          sum(sales_millions) AS total_sales_m, avg(critic_score) AS avg_critic_score
        FROM fact JOIN seed_region USING (region_id) JOIN genre_dim USING (genre_id) JOIN game USING (game_id)
        GROUP BY ALL""",
    "v_platforms": """
        SELECT region_label, continent, platform_name, manufacturer, generation,
          sum(sales_millions) AS total_sales_m, count(DISTINCT game_id) AS nb_titles
        FROM fact JOIN seed_region USING (region_id) JOIN seed_platform USING (platform_id)
        GROUP BY ALL""",
    "v_yearly": """
        SELECT release_year, count(DISTINCT game_id) AS nb_games_released, sum(sales_millions) AS total_sales_m,
          avg(sales_millions) AS avg_sales_per_game_m, max(sales_millions) AS max_sales_m
        FROM fact WHERE release_year IS NOT NULL GROUP BY release_year""",
    "v_ranking": """
        SELECT region_label, title, platform_name, genre_name, sales_millions,
          rank() OVER (PARTITION BY region_id ORDER BY sales_millions DESC NULLS FIRST) AS region_rank
        FROM fact JOIN game USING (game_id) JOIN seed_region USING (region_id)
          JOIN seed_platform USING (platform_id) JOIN genre_dim USING (genre_id)""",
    "candidates": """
        SELECT a.p_name || ' (' || a.p_partkey || ')' AS title, c.p_partkey - a.p_partkey AS step,
          c.p_partkey AS id, upper(c.p_name || ' (' || c.p_partkey || ')') AS name, c.p_size * 0.25::DOUBLE AS rating,
          CASE WHEN c.p_size % 5 <> 0 THEN '20' || lpad(CAST(c.p_size AS VARCHAR), 2, '0') || '-06-01' END AS released,
          c.p_size + 50 AS metacritic, 'img/' || c.p_partkey || '.jpg' AS background_image,
          CASE WHEN c.p_size % 4 <> 0 THEN c.p_type END AS esrb, c.p_type || ', ' || c.p_brand AS genres,
          c.p_name || ', ' || c.p_brand || ', ' || c.p_type || ', fourth, fifth, sixth' AS tags,
          CASE WHEN c.p_size % 3 <> 0 THEN c.p_brand || ' Works, ' || c.p_type END AS developers
        FROM (SELECT *, unnest([-2, -1, 0, 1, 2]) AS offs FROM part WHERE p_size > 5) AS a
          JOIN part AS c ON c.p_partkey = a.p_partkey + a.offs
        WHERE NOT (a.offs = 0 AND a.p_brand = 'Brand#7')""",
    "best": """
        SELECT * FROM candidates
        QUALIFY row_number() OVER (PARTITION BY title ORDER BY NOT contains(lower(name), lower(title)), step) = 1""",
    "incomplete": """
        SELECT * FROM wide WHERE critic_score IS NULL OR developer IS NULL OR release_date IS NULL""",
    "lookups": """
        SELECT title, id AS rawg_id, released AS rawg_released, metacritic AS rawg_metacritic, developers AS rawg_developers
        FROM best""",
    "found": "SELECT * FROM lookups WHERE title IN (SELECT title FROM incomplete)",
    "enriched": """
        SELECT wide.*, rawg_id, rawg_released, rawg_metacritic, rawg_developers,
          CASE WHEN rawg_id IS NULL THEN 'vgchartz' ELSE 'vgchartz+rawg' END AS data_source
        FROM wide LEFT JOIN found USING (title)""",
}


def _needed(text: str) -> list[str]:
    used = [name for name in BLOCKS if re.search(rf"\b{name}\b", text)]
    return [n for name in used for n in [*_needed(BLOCKS[name]), name]]


def sql(body: str) -> str:
    """The body with the blocks it names, each once, before the blocks that use it."""
    names = list(dict.fromkeys(_needed(body)))
    if not names:
        return body
    blocks = ",\n".join(f"{name} AS ({BLOCKS[name]})" for name in names)
    own = body.strip().removeprefix("WITH ")
    return f"WITH {blocks}" + (f",\n{own}" if own != body.strip() else f"\n{body}")
