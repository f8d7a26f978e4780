"""Cleaning queries (C1-C21) over the derived catalogue and ratings log."""

from __future__ import annotations

from pyspark.sql import functions as F

from ranklight.functions.columns import r6
from ranklight.operators import clean
from ranklight.plans import stages
from ranklight.plans.base_sql import CATALOGUE_RAW, RATINGS_LOG
from ranklight.plans.registry import register
from ranklight.plans.stages import CAT_CTES, KEEP_LAST_SQL, RATINGS_CLEAN_SQL, ctes
from ranklight.sources import tables

RAW = ctes(RATINGS_LOG, CATALOGUE_RAW)
CAT = ctes(CAT_CTES)


def _raw(spark, sf):
    return stages.catalogue_raw(spark, sf)


@register("coerce_numeric", RAW + """
SELECT item_id, src_row, TRY_CAST(score AS DOUBLE) AS score, TRY_CAST(episodes AS DOUBLE) AS episodes
FROM catalogue_raw""")
def coerce_numeric(spark, sf):
    """C1: 'Unknown' and other text to null, numbers to double."""
    return clean.coerce_numeric(_raw(spark, sf)).select("item_id", "src_row", "score", "episodes")


@register("fill_median", CAT + """
SELECT item_id, src_row, score, episodes, members, favorites, scored_by FROM cat_missing""")
def fill_median(spark, sf):
    """Nulls of five numeric columns to the exact column median."""
    return clean.fill_median(_raw(spark, sf)).select("item_id", "src_row", "score", "episodes", "members",
                                                     "favorites", "scored_by")


@register("fill_const", RAW + """
SELECT item_id, src_row, coalesce(genres, 'Unknown') AS genres, coalesce(type, 'Unknown') AS type FROM catalogue_raw""")
def fill_const(spark, sf):
    """Missing genres / type to 'Unknown'."""
    return clean.fill_const(_raw(spark, sf)).select("item_id", "src_row", "genres", "type")


@register("drop_missing", CAT + "SELECT item_id, src_row, name FROM cat_filled")
def drop_missing(spark, sf):
    """C4: rows without id or name are dropped (after the fills)."""
    return clean.handle_missing(_raw(spark, sf)).select("item_id", "src_row", "name")


@register("dedup_id", CAT + "SELECT item_id, src_row, name, members FROM cat_dedup_id")
def dedup_id(spark, sf):
    """First row per id in source order."""
    return clean.dedup_id(clean.handle_missing(_raw(spark, sf))).select("item_id", "src_row", "name", "members")


@register("dedup_name", CAT + "SELECT item_id, src_row, name FROM cat_dedup")
def dedup_name(spark, sf):
    """Then first row per lower-cased name."""
    return clean.remove_duplicates(clean.handle_missing(_raw(spark, sf))).select("item_id", "src_row", "name")


@register("normalize", CAT + """
SELECT item_id, score, name, english_name, genres, type, episodes, genres_list FROM cat_norm""")
def normalize(spark, sf):
    """Clip score, strip text, episodes numeric, genres as a list."""
    df = clean.normalize(clean.remove_duplicates(clean.handle_missing(_raw(spark, sf))))
    return df.select("item_id", "score", "name", "english_name", "genres", "type", "episodes", "genres_list")


@register("iqr_filter", CAT + """
SELECT item_id, members FROM cat_norm
WHERE members >= (SELECT q1 - 3 * (q3 - q1) FROM cat_q) AND members <= (SELECT q3 + 3 * (q3 - q1) FROM cat_q)""")
def iqr_filter(spark, sf):
    """Members within [Q1 - 3 IQR, Q3 + 3 IQR] (exact linear quartiles)."""
    df = clean.normalize(clean.remove_duplicates(clean.handle_missing(_raw(spark, sf))))
    return clean.iqr_filter(df, "members", 3.0).select("item_id", "members")


@register("positive_score", CAT + "SELECT item_id, score FROM cat_norm WHERE score > 0")
def positive_score(spark, sf):
    """C11: drop scores <= 0."""
    df = clean.normalize(clean.remove_duplicates(clean.handle_missing(_raw(spark, sf))))
    return clean.positive_score(df).select("item_id", "score")


@register("clean_catalogue", CAT + "SELECT * FROM catalogue", headline=True)
def clean_catalogue(spark, sf):
    """The four cleaning steps in order."""
    return stages.catalogue(spark, sf)


@register("cleaning_report", CAT + """
SELECT 1 AS step_no, 'missing_values' AS step, (SELECT count(*) FROM catalogue_raw) AS rows_before,
       (SELECT count(*) FROM cat_filled) AS rows_after,
       (SELECT count(*) FROM catalogue_raw) - (SELECT count(*) FROM cat_filled) AS rows_removed
UNION ALL SELECT 2, 'duplicates', (SELECT count(*) FROM cat_filled), (SELECT count(*) FROM cat_dedup),
       (SELECT count(*) FROM cat_filled) - (SELECT count(*) FROM cat_dedup)
UNION ALL SELECT 3, 'outliers', (SELECT count(*) FROM cat_dedup), (SELECT count(*) FROM catalogue),
       (SELECT count(*) FROM cat_dedup) - (SELECT count(*) FROM catalogue)""")
def cleaning_report(spark, sf):
    """Rows before / after / removed per step."""
    return clean.cleaning_report(_raw(spark, sf))


# ------------------------------------------------------------------ ratings

@register("ratings_known_items", ctes(CAT_CTES) + """
SELECT user_id, item_id, rating, l_orderkey, l_linenumber FROM ratings_log
WHERE item_id IN (SELECT item_id FROM catalogue)""")
def ratings_known_items(spark, sf):
    """Ratings of catalogue items only (semi join)."""
    return (clean.ratings_known_items(tables.ratings_log(spark, sf), stages.catalogue(spark, sf))
            .select("user_id", "item_id", "rating", "l_orderkey", "l_linenumber"))


@register("ratings_valid", ctes(RATINGS_LOG) + """
SELECT count(*) AS n, count(CASE WHEN rating = 0 THEN 1 END) AS watching FROM ratings_log
WHERE (rating >= 1 AND rating <= 10) OR rating = 0""")
def ratings_valid(spark, sf):
    """Ratings in 1..10 or 0."""
    v = clean.ratings_valid(tables.ratings_log(spark, sf))
    return v.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("rating") == 0, 1)).alias("watching"))


@register("ratings_keep_last", ctes(RATINGS_LOG, KEEP_LAST_SQL) + "SELECT user_id, item_id, rating FROM ratings_dedup")
def ratings_keep_last(spark, sf):
    """C14: one row per (user, item): the last event."""
    return clean.ratings_keep_last(tables.ratings_log(spark, sf)).select("user_id", "item_id", "rating")


@register("clean_ratings", ctes(CAT_CTES, """known AS (
  SELECT * FROM ratings_log WHERE item_id IN (SELECT item_id FROM catalogue)
    AND ((rating >= 1 AND rating <= 10) OR rating = 0))""") + """
SELECT user_id, item_id, rating FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, item_id
    ORDER BY event_ts DESC, l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC, l_quantity DESC) AS rn
  FROM known) WHERE rn = 1""")
def clean_ratings(spark, sf):
    """C12-C14 in order."""
    return clean.clean_ratings(tables.ratings_log(spark, sf), stages.catalogue(spark, sf)) \
        .select("user_id", "item_id", "rating")


@register("drop_watching", ctes(RATINGS_LOG, KEEP_LAST_SQL, RATINGS_CLEAN_SQL) + """
SELECT count(*) AS n, round(avg(rating), 6) AS mean_rating FROM ratings_clean""")
def drop_watching(spark, sf):
    """C17: rating > 0."""
    return stages.ratings_clean(spark, sf).agg(F.count(F.lit(1)).alias("n"), r6(F.avg("rating")).alias("mean_rating"))


_MIN_SQL = ctes(RATINGS_LOG, KEEP_LAST_SQL, RATINGS_CLEAN_SQL, """mu AS (
  SELECT * FROM ratings_clean WHERE user_id IN (SELECT user_id FROM ratings_clean GROUP BY user_id HAVING count(*) >= 5)),
mi AS (SELECT * FROM mu WHERE item_id IN (SELECT item_id FROM mu GROUP BY item_id HAVING count(*) >= 10))""")


@register("min_user_ratings", _MIN_SQL + "SELECT user_id, item_id, rating FROM mu")
def min_user_ratings(spark, sf):
    """Users with at least 5 ratings."""
    return clean.min_user_ratings(stages.ratings_clean(spark, sf), 5)


@register("min_item_ratings", _MIN_SQL + "SELECT user_id, item_id, rating FROM mi")
def min_item_ratings(spark, sf):
    """Then items with at least 10 ratings (one pass, D12)."""
    return clean.min_item_ratings(clean.min_user_ratings(stages.ratings_clean(spark, sf), 5), 10)


@register("sample_ratings", _MIN_SQL + """
SELECT user_id, item_id, rating FROM mi
ORDER BY md5(CAST(user_id AS VARCHAR) || '-' || CAST(item_id AS VARCHAR) || '-42'), user_id, item_id LIMIT 20000""")
def sample_ratings(spark, sf):
    """C20 + S6: drop watching, min counts, then exactly 20,000 rows by md5 order."""
    return clean.sample_ratings(stages.ratings_clean(spark, sf), 20000, 5, 10, seed=42)


@register("popular_filter", ctes(CAT_CTES, KEEP_LAST_SQL, RATINGS_CLEAN_SQL, """pop AS (
  SELECT item_id FROM ratings_clean GROUP BY item_id HAVING count(*) >= 30)""") + """
SELECT 'catalogue' AS tbl, count(*) AS n FROM catalogue WHERE item_id IN (SELECT item_id FROM pop)
UNION ALL SELECT 'ratings', count(*) FROM ratings_clean WHERE item_id IN (SELECT item_id FROM pop)""")
def popular_filter(spark, sf):
    """Items with >= 30 ratings, applied to both tables."""
    cat, rat = clean.popular_filter(stages.catalogue(spark, sf), stages.ratings_clean(spark, sf), 30)
    return (cat.agg(F.count(F.lit(1)).alias("n")).select(F.lit("catalogue").alias("tbl"), "n")
            .unionByName(rat.agg(F.count(F.lit(1)).alias("n")).select(F.lit("ratings").alias("tbl"), "n")))
