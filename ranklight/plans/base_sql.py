"""DuckDB twins of the derived tables, as CTE text for the oracle queries.

Each oracle query is ``WITH <the CTEs it needs> SELECT ...``.  They restate
the rules of ``ranklight.sources.tables`` in plain SQL over the driver views.
"""

from __future__ import annotations

from ranklight.functions.columns import SEASON_OF_MONTH
from ranklight.sources.tables import (AGE_RATINGS, RULE_DUP_ID, RULE_DUP_NAME,
                                      RULE_EPISODES_UNKNOWN, RULE_GENRES_NULL,
                                      RULE_NAME_NULL, RULE_SCORE_UNKNOWN,
                                      RULE_TYPE_NULL, SOURCE_BY_SIZE)


def _hit(col: str, rule) -> str:
    return f"({col} % {rule[0]} = {rule[1]})"


_SEASON_CASE = "CASE " + " ".join(
    f"WHEN month(first_ts) = {m} THEN '{w}'" for m, w in SEASON_OF_MONTH.items()) + " END"
_SOURCE_CASE = "CASE " + " ".join(
    (f"WHEN p_size <= {b} THEN '{w}'" if b is not None else f"ELSE '{w}'")
    for b, w in SOURCE_BY_SIZE) + " END"
_AGE_LIST = "[" + ", ".join(f"'{a}'" for a in AGE_RATINGS) + "]"

RATINGS_LOG = """ratings_log AS (
  SELECT o.o_custkey AS user_id, l.l_partkey AS item_id,
         CAST(CAST(l.l_quantity AS BIGINT) % 11 AS DOUBLE) AS rating,
         l.l_shipdate AS event_ts, l.l_orderkey, l.l_linenumber, l.l_extendedprice, l.l_quantity
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

CATALOGUE_RAW = f"""item_activity AS (
  SELECT item_id, count(*) AS members,
         count(CASE WHEN rating > 0 THEN 1 END) AS scored_by,
         count(CASE WHEN rating = 10 THEN 1 END) AS favorites,
         CAST(sum(CASE WHEN rating > 0 THEN CAST(rating AS BIGINT) END) AS BIGINT) AS sum_pos,
         min(event_ts) AS first_ts
  FROM ratings_log GROUP BY item_id),
cat_base AS (
  SELECT p.p_partkey, p.p_name, p.p_brand, p.p_type, p.p_size,
         a.members, a.scored_by, a.favorites, a.first_ts,
         CASE WHEN a.scored_by > 0 THEN (200 * a.sum_pos + a.scored_by) // (2 * a.scored_by) END AS mean_rating
  FROM part p LEFT JOIN item_activity a ON p.p_partkey = a.item_id),
cat_one AS (
  SELECT p_partkey AS item_id,
    CASE WHEN {_hit('p_partkey', RULE_NAME_NULL)} THEN NULL ELSE p_name || ' ' || CAST(p_partkey AS VARCHAR) END AS name,
    CASE WHEN {_hit('p_partkey', RULE_SCORE_UNKNOWN)} OR mean_rating IS NULL THEN 'Unknown'
         ELSE CAST(mean_rating / 100.0 AS VARCHAR) END AS score,
    CASE WHEN {_hit('p_partkey', RULE_GENRES_NULL)} THEN NULL
         ELSE replace(p_name, ' ', ', ') || ', ' || p_type END AS genres,
    CASE WHEN {_hit('p_partkey', RULE_TYPE_NULL)} THEN NULL ELSE p_type END AS type,
    CASE WHEN {_hit('p_partkey', RULE_EPISODES_UNKNOWN)} THEN 'Unknown' ELSE CAST(p_size AS VARCHAR) END AS episodes,
    coalesce(members, 0) AS members, coalesce(favorites, 0) AS favorites, coalesce(scored_by, 0) AS scored_by,
    {_SOURCE_CASE} AS source,
    p_brand AS studios,
    'Producer#' || CAST(p_size % 7 AS VARCHAR) AS producers,
    {_AGE_LIST}[CAST(p_size % {len(AGE_RATINGS)} AS INTEGER) + 1] AS rating,
    CASE WHEN first_ts IS NOT NULL THEN {_SEASON_CASE} || ' ' || CAST(year(first_ts) AS VARCHAR) END AS premiered,
    p_name AS english_name,
    CAST(row_number() OVER (ORDER BY coalesce(members, 0) DESC, p_partkey) AS BIGINT) AS popularity,
    CASE WHEN mean_rating IS NOT NULL THEN
      CAST(row_number() OVER (PARTITION BY mean_rating IS NULL ORDER BY mean_rating DESC, p_partkey) AS BIGINT) END AS rank,
    p_partkey * 3 AS src_row
  FROM cat_base),
catalogue_raw AS (
  SELECT * FROM cat_one
  UNION ALL
  SELECT item_id, name, score, genres, type, episodes, members + 1, favorites, scored_by, source, studios,
         producers, rating, premiered, english_name, popularity, rank, src_row + 1
  FROM cat_one WHERE {_hit('item_id', RULE_DUP_ID)}
  UNION ALL
  SELECT -item_id - 1, upper(name), score, genres, type, episodes, members, favorites, scored_by, source, studios,
         producers, rating, premiered, english_name, popularity, rank, src_row + 2
  FROM cat_one WHERE {_hit('item_id', RULE_DUP_NAME)})"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
