"""Feature-engineering queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ranklight.functions.columns import r6
from ranklight.operators import features
from ranklight.plans import stages
from ranklight.plans.registry import register
from ranklight.plans.stages import CAT_CTES, KEEP_LAST_SQL, RATINGS_CLEAN_SQL, ctes

CAT = ctes(CAT_CTES)
STRIP = "'^\\s+|\\s+$', '', 'g'"


def _rep(col: str, n: int) -> str:
    return f"repeat(coalesce(CAST({col} AS VARCHAR), '') || ' ', {n})"


@register("text_features_weighted", CAT + f"""
SELECT item_id, regexp_replace(regexp_replace(lower(""" + " || ".join(_rep(c, n) for c, n in features.WEIGHTED_TEXT_FIELDS)
          + f"""), {STRIP}), '[^\\p{{L}}\\p{{N}}_\\s]', '', 'g') AS text_features FROM catalogue""")
def text_features_weighted(spark, sf):
    """weighted text of every item."""
    return features.text_features_weighted(stages.catalogue(spark, sf)).select("item_id", "text_features")


@register("text_features_content", CAT + f"""
SELECT item_id, regexp_replace(lower(concat_ws(' ', """ + ", ".join(
    f"coalesce(CAST({c} AS VARCHAR), '')" for c, n in features.CONTENT_TEXT_FIELDS for _ in range(n))
          + f""")), {STRIP}) AS content_text FROM catalogue""")
def text_features_content(spark, sf):
    """content text of every item."""
    return features.text_features_content(stages.catalogue(spark, sf)).select("item_id", "content_text")


@register("numeric_features", CAT + """
SELECT item_id, round(ln(1 + coalesce(episodes, 0)), 6) AS episodes_log, round(ln(1 + coalesce(members, 0)), 6) AS members_log,
       round(ln(1 + coalesce(favorites, 0)), 6) AS favorites_log, round(ln(1 + coalesce(scored_by, 0)), 6) AS scored_by_log,
       round(1 - coalesce(CAST(popularity AS DOUBLE), (SELECT max(popularity) FROM catalogue)) / (SELECT max(popularity) FROM catalogue), 6) AS popularity_normalized,
       round(1 - coalesce(CAST(rank AS DOUBLE), (SELECT max(rank) FROM catalogue)) / (SELECT max(rank) FROM catalogue), 6) AS rank_normalized,
       round(coalesce(score, 0) / 10.0, 6) AS score_normalized FROM catalogue""")
def numeric_features(spark, sf):
    """Log counts, inverse ranks, scaled score."""
    df = features.numeric_features(stages.catalogue(spark, sf))
    cols = ["episodes_log", "members_log", "favorites_log", "scored_by_log", "popularity_normalized",
            "rank_normalized", "score_normalized"]
    return df.select("item_id", *[r6(c).alias(c) for c in cols])


_GENRE_VOCAB = f"""gv AS (SELECT DISTINCT unnest(list_transform(string_split(genres, ','), lambda x: regexp_replace(x, {STRIP}))) AS genre FROM catalogue)"""


@register("genre_onehot", ctes(CAT_CTES) + f"""
SELECT DISTINCT item_id, unnest(list_transform(string_split(genres, ','), lambda x: regexp_replace(x, {STRIP}))) AS genre, 1 AS flag
FROM catalogue""")
def genre_onehot(spark, sf):
    """(item, genre, 1) for every listed genre."""
    return features.genre_long(stages.catalogue(spark, sf), "exact")


@register("genre_onehot_substring", ctes(CAT_CTES, _GENRE_VOCAB) + """
SELECT c.item_id, gv.genre, 1 AS flag FROM catalogue c JOIN gv ON contains(lower(c.genres), lower(gv.genre))""")
def genre_onehot_substring(spark, sf):
    """F6, parity mode (D6): case-insensitive substring."""
    return features.genre_long(stages.catalogue(spark, sf), "substring")


@register("season_features", CAT + """
SELECT item_id, nullif(regexp_extract(premiered, '(Spring|Summer|Fall|Winter)', 1), '') AS season,
       CAST(nullif(regexp_extract(premiered, '(\\d{4})', 1), '') AS DOUBLE) AS year,
       CASE nullif(regexp_extract(premiered, '(Spring|Summer|Fall|Winter)', 1), '')
            WHEN 'Winter' THEN 1 WHEN 'Spring' THEN 2 WHEN 'Summer' THEN 3 WHEN 'Fall' THEN 4 END AS season_numeric
FROM catalogue""")
def season_features(spark, sf):
    """season word, year, season number."""
    return features.season_features(stages.catalogue(spark, sf)).select("item_id", "season", "year", "season_numeric")


@register("all_features", CAT + f"""
SELECT item_id, nullif(regexp_extract(premiered, '(Spring|Summer|Fall|Winter)', 1), '') AS season,
       round(ln(1 + coalesce(members, 0)), 6) AS members_log,
       coalesce(array_to_string(list_sort(list_distinct(list_transform(string_split(genres, ','), lambda x: regexp_replace(x, {STRIP})))), '|'), '') AS genre_set
FROM catalogue""")
def all_features(spark, sf):
    """F8: all feature steps in order, one column of each step per item."""
    df = features.all_features(stages.catalogue(spark, sf))
    return df.select("item_id", "season", r6("members_log").alias("members_log"), F.array_join("genre_set", "|").alias("genre_set"))


@register("user_item_index", ctes(CAT_CTES, KEEP_LAST_SQL, RATINGS_CLEAN_SQL) + """
SELECT r.user_id, r.item_id, u.user_idx, i.item_idx, r.rating FROM ratings_clean r
JOIN (SELECT user_id, CAST(row_number() OVER (ORDER BY user_id) - 1 AS BIGINT) AS user_idx
      FROM (SELECT DISTINCT user_id FROM ratings_clean)) u USING (user_id)
JOIN (SELECT item_id, CAST(row_number() OVER (ORDER BY item_id) - 1 AS BIGINT) AS item_idx
      FROM (SELECT DISTINCT item_id FROM ratings_clean)) i USING (item_id)""")
def user_item_index(spark, sf):
    """dense user and item indexes (distributed numbering)."""
    _, _, indexed = features.user_item_index(stages.ratings_clean(spark, sf))
    return indexed.select("user_id", "item_id", "user_idx", "item_idx", "rating")


@register("genre_tokens", CAT + f"""
SELECT item_id, CASE WHEN genres IS NULL THEN NULL ELSE
  list_transform(string_split(genres, ','), lambda x: replace(lower(regexp_replace(x, {STRIP})), ' ', '_')) END AS genre_tokens
FROM catalogue""")
def genre_tokens(spark, sf):
    """word tokens of the genres for embeddings."""
    return features.genre_tokens(stages.catalogue(spark, sf)).select("item_id", "genre_tokens")
