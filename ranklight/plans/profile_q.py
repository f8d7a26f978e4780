"""Profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ranklight.operators import clean, profile
from ranklight.plans import stages
from ranklight.plans.base_sql import CATALOGUE_RAW, RATINGS_LOG
from ranklight.plans.registry import register
from ranklight.plans.stages import CAT_CTES, KEEP_LAST_SQL, RATINGS_CLEAN_SQL, ctes

CAT = ctes(CAT_CTES)
RAT = ctes(RATINGS_LOG, KEEP_LAST_SQL, RATINGS_CLEAN_SQL)
CAT_RAT = ctes(CAT_CTES, KEEP_LAST_SQL, RATINGS_CLEAN_SQL)
STRIP = "regexp_replace(x, '^\\s+|\\s+$', '', 'g')"
GENRES_SQL = f"genre_tags AS (SELECT unnest(list_transform(string_split(genres, ','), lambda x: {STRIP})) AS genre FROM catalogue)"
COERCED_SQL = """coerced AS (
  SELECT TRY_CAST(score AS DOUBLE) AS score, TRY_CAST(episodes AS DOUBLE) AS episodes, CAST(members AS DOUBLE) AS members,
         CAST(favorites AS DOUBLE) AS favorites, CAST(scored_by AS DOUBLE) AS scored_by FROM catalogue_raw)"""
NUM = ("score", "episodes", "members", "favorites", "scored_by")


@register("catalogue_stats", ctes(CAT_CTES, GENRES_SQL) + """
SELECT count(*) AS n_items, round(avg(score), 6) AS mean_score, round(median(score), 6) AS median_score,
       (SELECT count(DISTINCT genre) FROM genre_tags) AS n_genres FROM catalogue""")
def catalogue_stats(spark, sf):
    """A1: items, mean / median score, distinct genres."""
    return profile.catalogue_stats(stages.catalogue(spark, sf))


@register("type_counts", CAT + "SELECT type, count(*) AS n FROM catalogue GROUP BY type")
def type_counts(spark, sf):
    """A1: items per type."""
    return profile.type_counts(stages.catalogue(spark, sf))


@register("ratings_stats", RAT + """
SELECT count(*) AS n_ratings, count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items,
       round(avg(rating), 6) AS mean_rating, round(quantile_cont(rating, 0.5), 6) AS median_rating,
       round(1 - count(*) / (count(DISTINCT user_id) * count(DISTINCT item_id)), 6) AS sparsity FROM ratings_clean""")
def ratings_stats(spark, sf):
    """A2: ratings, users, items, mean / median rating, sparsity."""
    return profile.ratings_stats(stages.ratings_clean(spark, sf))


@register("dataset_summary", CAT_RAT + """
SELECT count(*) AS n_items, round(min(score), 6) AS min_score, round(max(score), 6) AS max_score,
       round(avg(score), 6) AS mean_score, list_sort(list_distinct(list(type))) AS types,
       (SELECT count(*) FROM ratings_clean) AS n_ratings, (SELECT count(DISTINCT user_id) FROM ratings_clean) AS n_users,
       (SELECT min(rating) FROM ratings_clean) AS min_rating, (SELECT max(rating) FROM ratings_clean) AS max_rating,
       (SELECT round(avg(rating), 6) FROM ratings_clean) AS mean_rating FROM catalogue""")
def dataset_summary(spark, sf):
    """A3: catalogue and ratings summary in one row."""
    return profile.dataset_summary(stages.catalogue(spark, sf), stages.ratings_clean(spark, sf))


@register("genre_counts", ctes(CAT_CTES, GENRES_SQL) + """
SELECT genre, count(*) AS n FROM genre_tags GROUP BY genre ORDER BY n DESC, genre LIMIT 20""")
def genre_counts(spark, sf):
    """A4: top 20 genres by item count."""
    return profile.genre_counts(stages.catalogue(spark, sf), 20)


@register("distinct_genres", ctes(CAT_CTES, GENRES_SQL) + "SELECT count(DISTINCT genre) AS n_genres FROM genre_tags")
def distinct_genres(spark, sf):
    """A5: distinct genres (stripped)."""
    return profile.distinct_genres(stages.catalogue(spark, sf))


@register("distinct_genres_raw", ctes(RATINGS_LOG, CATALOGUE_RAW) + """
SELECT count(DISTINCT g) + max(CASE WHEN g IS NULL THEN 1 ELSE 0 END) AS n_genres
FROM (SELECT unnest(CASE WHEN genres IS NULL THEN [NULL] ELSE string_split(genres, ',') END) AS g FROM catalogue_raw)""")
def distinct_genres_raw(spark, sf):
    """A5, reference mode (D4): untrimmed pieces, missing counts as one."""
    return profile.distinct_genres(stages.catalogue_raw(spark, sf), raw=True)


@register("type_distribution", CAT + """
SELECT type, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM catalogue), 6) AS percent
FROM catalogue GROUP BY type""")
def type_distribution(spark, sf):
    """Count and percent per type."""
    return profile.type_distribution(stages.catalogue(spark, sf))


def _hist_sql(src: str, col: str, bins: int) -> str:
    return f"""v AS (SELECT CAST({col} AS DOUBLE) AS v FROM {src} WHERE {col} IS NOT NULL),
mm AS (SELECT min(v) AS lo, max(v) AS hi FROM v),
w AS (SELECT lo, CASE WHEN hi > lo THEN (hi - lo) / {bins} ELSE 1.0 END AS width FROM mm),
b AS (SELECT least(CAST(floor((v - lo) / width) AS INTEGER), {bins - 1}) AS bin FROM v, w),
c AS (SELECT bin, count(*) AS n FROM b GROUP BY bin)"""


@register("score_histogram", ctes(CAT_CTES, _hist_sql("catalogue", "score", 50)) + """
SELECT g.bin, round(w.lo + g.bin * w.width, 6) AS bin_start, round(w.lo + (g.bin + 1) * w.width, 6) AS bin_end,
       coalesce(c.n, 0) AS n
FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(50)) g CROSS JOIN w LEFT JOIN c USING (bin)""")
def score_histogram(spark, sf):
    """50 equal-width score bins, empty bins included."""
    return profile.histogram(stages.catalogue(spark, sf), "score", 50)


@register("score_density", CAT + """, v AS (SELECT score AS v FROM catalogue WHERE score IS NOT NULL),
st AS (SELECT min(v) AS lo, max(v) AS hi, count(*) AS n, stddev_samp(v) AS sd FROM v),
p AS (SELECT st.*, sd * pow(CAST(n AS DOUBLE), -0.2) AS h, (hi - lo) / 99 AS step FROM st),
g AS (SELECT range AS i FROM range(100))
SELECT CAST(g.i AS INTEGER) AS i, round(p.lo + g.i * p.step, 6) AS x,
       round(sum(exp(-0.5 * pow(((p.lo + g.i * p.step) - v.v) / p.h, 2))) / (p.n * p.h * sqrt(2 * pi())), 6) AS density
FROM g CROSS JOIN p CROSS JOIN v GROUP BY g.i, p.lo, p.step, p.n, p.h""")
def score_density(spark, sf):
    """Gaussian kernel density of the score on 100 points."""
    return profile.density(stages.catalogue(spark, sf), "score", 100)


@register("score_stats", CAT + """
SELECT round(avg(score), 6) AS mean, round(quantile_cont(score, 0.5), 6) AS median, round(stddev_samp(score), 6) AS std,
       round(min(score), 6) AS min, round(max(score), 6) AS max, round(quantile_cont(score, 0.25), 6) AS q1,
       round(quantile_cont(score, 0.75), 6) AS q3 FROM catalogue""")
def score_stats(spark, sf):
    """Score statistics."""
    return profile.column_stats(stages.catalogue(spark, sf), "score")


@register("box_stats", CAT + """, q AS (SELECT quantile_cont(members, 0.25) AS q1, quantile_cont(members, 0.5) AS med,
                quantile_cont(members, 0.75) AS q3 FROM catalogue),
lim AS (SELECT q1, med, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT round(any_value(q1), 6) AS q1, round(any_value(med), 6) AS median, round(any_value(q3), 6) AS q3,
       round(min(CASE WHEN members >= lo THEN members END), 6) AS whisker_low,
       round(max(CASE WHEN members <= hi THEN members END), 6) AS whisker_high,
       count(CASE WHEN members < lo OR members > hi THEN 1 END) AS outliers
FROM catalogue CROSS JOIN lim""")
def box_stats(spark, sf):
    """A10: box-plot figures of members."""
    return profile.box_stats(stages.catalogue(spark, sf), "members")


@register("describe", CAT + "\n" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
       round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
       round(quantile_cont({c}, 0.75), 6) AS p75, round(max({c}), 6) AS max FROM catalogue""" for c in NUM))
def describe(spark, sf):
    """describe() of the numeric columns."""
    return profile.describe(stages.catalogue(spark, sf))


_RAW_COLS = ("item_id", "name", "score", "genres", "type", "episodes", "members", "favorites", "scored_by",
             "source", "studios", "producers", "rating", "premiered", "english_name", "popularity", "rank")


@register("missing_report", ctes(RATINGS_LOG, CATALOGUE_RAW, COERCED_SQL.replace(
    "FROM catalogue_raw)", ", name, genres, type, premiered, rank FROM catalogue_raw)")) + """
SELECT "column", missing, round(missing * 100.0 / n, 6) AS percent FROM (
  UNPIVOT (SELECT count(*) AS n, """ + ", ".join(
    f"count(*) - count({c}) AS {c}" for c in ("score", "episodes", "name", "genres", "type", "premiered", "rank"))
    + """ FROM coerced) ON score, episodes, name, genres, type, premiered, rank INTO NAME "column" VALUE missing)
WHERE missing > 0""")
def missing_report(spark, sf):
    """Missing values per column of the raw catalogue after coercion."""
    raw = clean.coerce_numeric(stages.catalogue_raw(spark, sf))
    return profile.missing_report(raw.select("score", "episodes", "members", "favorites", "scored_by", "name",
                                             "genres", "type", "premiered", "rank"))


_CAT_COLS = ["item_id", "name", "score", "genres", "type", "episodes", "members", "favorites", "scored_by", "source",
             "studios", "producers", "rating", "premiered", "english_name", "popularity", "rank", "src_row",
             "genres_list"]
_TYPE_NAMES = ("CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' "
               "WHEN 'VARCHAR[]' THEN 'array<string>' WHEN 'INTEGER' THEN 'int' ELSE lower(column_type) END")
SCHEMA_SQL = (f"""SELECT d.column_name AS "column", {_TYPE_NAMES} AS type, n.non_null
FROM (DESCRIBE {CAT} SELECT * FROM catalogue) d
JOIN ({CAT} SELECT * FROM (UNPIVOT (SELECT """ + ", ".join(f"count({c}) AS {c}" for c in _CAT_COLS) + """ FROM catalogue)
      ON COLUMNS(*) INTO NAME "column" VALUE non_null)) n ON n."column" = d.column_name""")


@register("schema_report", SCHEMA_SQL)
def schema_report(spark, sf):
    """Columns, types and non-null counts of the cleaned catalogue."""
    return profile.schema_report(stages.catalogue(spark, sf))


def _corr_sql(src: str, listwise: bool) -> str:
    where = (" WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in NUM)) if listwise else ""
    parts = []
    for i, a in enumerate(NUM):
        for b in NUM[i:]:
            parts.append(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM {src}{where}")
            if a != b:
                parts.append(f"SELECT '{b}' AS a, '{a}' AS b, round(corr({a}, {b}), 6) AS r FROM {src}{where}")
    return " UNION ALL ".join(parts)


@register("correlation_matrix", ctes(RATINGS_LOG, CATALOGUE_RAW, COERCED_SQL) + _corr_sql("coerced", False))
def correlation_matrix(spark, sf):
    """Pearson r of the numeric columns, pairwise complete."""
    return profile.correlation_matrix(clean.coerce_numeric(stages.catalogue_raw(spark, sf)))


@register("correlation_listwise", ctes(RATINGS_LOG, CATALOGUE_RAW, COERCED_SQL) + _corr_sql("coerced", True))
def correlation_listwise(spark, sf):
    """The same after dropping rows with any null."""
    return profile.correlation_matrix(clean.coerce_numeric(stages.catalogue_raw(spark, sf)), listwise=True)


@register("strong_pairs", ctes(RATINGS_LOG, CATALOGUE_RAW, COERCED_SQL) + "SELECT * FROM (" + _corr_sql("coerced", False)
          + ") WHERE a < b AND abs(r) > 0.3")
def strong_pairs(spark, sf):
    """Pairs with |r| > 0.3."""
    return profile.strong_pairs(profile.correlation_matrix(clean.coerce_numeric(stages.catalogue_raw(spark, sf))))


@register("popularity_vs_quality", CAT + """
SELECT round(corr(members, score), 6) AS r,
       CASE WHEN round(corr(members, score), 6) > 0.3 THEN 'positive'
            WHEN round(corr(members, score), 6) < -0.3 THEN 'negative' ELSE 'weak' END AS verdict FROM catalogue""")
def popularity_vs_quality(spark, sf):
    """Correlation of members and score with a verdict."""
    return profile.popularity_vs_quality(stages.catalogue(spark, sf))


@register("episode_stats", CAT + """
SELECT round(avg(episodes), 6) AS mean, round(quantile_cont(episodes, 0.5), 6) AS median,
       round(stddev_samp(episodes), 6) AS std, round(min(episodes), 6) AS min, round(max(episodes), 6) AS max,
       round(quantile_cont(episodes, 0.25), 6) AS q1, round(quantile_cont(episodes, 0.75), 6) AS q3 FROM catalogue""")
def episode_stats(spark, sf):
    """Episode statistics."""
    return profile.column_stats(stages.catalogue(spark, sf), "episodes")


@register("episode_histogram_short", ctes(CAT_CTES, """short AS (SELECT * FROM catalogue WHERE episodes <= 20)""",
                                          _hist_sql("short", "episodes", 20)) + """
SELECT g.bin, round(w.lo + g.bin * w.width, 6) AS bin_start, round(w.lo + (g.bin + 1) * w.width, 6) AS bin_end,
       coalesce(c.n, 0) AS n
FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(20)) g CROSS JOIN w LEFT JOIN c USING (bin)""")
def episode_histogram_short(spark, sf):
    """Histogram of episodes for items with at most 20."""
    from pyspark.sql import functions as F
    return profile.histogram(stages.catalogue(spark, sf).filter(F.col("episodes") <= 20), "episodes", 20)


@register("top_genre_share", ctes(CAT_CTES, GENRES_SQL, """gc AS (SELECT genre, count(*) AS n FROM genre_tags GROUP BY genre)""") + """
SELECT round(sum(n) / (SELECT sum(n) FROM gc), 6) AS share, list_sort(list(genre)) AS genres
FROM (SELECT * FROM gc ORDER BY n DESC, genre LIMIT 3)""")
def top_genre_share(spark, sf):
    """Share of the top 3 genres among all tags."""
    return profile.top_genre_share(stages.catalogue(spark, sf), 3)


@register("matrix_sparsity", ctes(RATINGS_LOG) + """
SELECT count(*) AS filled, (SELECT count(DISTINCT user_id) FROM ratings_log) AS n_users,
       (SELECT count(DISTINCT item_id) FROM ratings_log) AS n_items,
       round(1 - count(*) / ((SELECT count(DISTINCT user_id) FROM ratings_log) * (SELECT count(DISTINCT item_id) FROM ratings_log)), 6) AS sparsity
FROM (SELECT DISTINCT user_id, item_id FROM ratings_log WHERE rating <> 0)""")
def matrix_sparsity(spark, sf):
    """Empty share of the user x item matrix of the raw log."""
    from ranklight.sources import tables
    return profile.matrix_sparsity(tables.ratings(spark, sf))


@register("releases_per_year", CAT + """
SELECT CAST(regexp_extract(premiered, '(\\d{4})', 1) AS INTEGER) AS year, count(*) AS n FROM catalogue
WHERE regexp_extract(premiered, '(\\d{4})', 1) <> '' GROUP BY 1""")
def releases_per_year(spark, sf):
    """Items per premiere year."""
    return profile.releases_per_year(stages.catalogue(spark, sf))


@register("most_active_users", RAT + """
SELECT user_id, count(*) AS n_ratings FROM ratings_clean GROUP BY user_id ORDER BY n_ratings DESC, user_id LIMIT 50""")
def most_active_users(spark, sf):
    """The 50 users with the most ratings."""
    return profile.most_active_users(stages.ratings_clean(spark, sf), 50)


@register("profile_all", CAT + """
SELECT 'genre_counts' AS tbl, CAST(20 AS BIGINT) AS rows
UNION ALL SELECT 'type_distribution', (SELECT count(DISTINCT type) FROM catalogue)
UNION ALL SELECT 'score_histogram', 50
UNION ALL SELECT 'correlation', 25
UNION ALL SELECT 'top_score', least(20, (SELECT count(*) FROM catalogue))
UNION ALL SELECT 'top_members', least(20, (SELECT count(*) FROM catalogue))""")
def profile_all(spark, sf):
    """All profile tables of the catalogue at once (table, rows)."""
    from pyspark.sql import functions as F
    out = None
    for name, df in profile.profile_all(stages.catalogue(spark, sf)).items():
        r = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("tbl"), "rows")
        out = r if out is None else out.unionByName(r)
    return out


def _profile_rows_sql() -> str:
    from ranklight.plans.registry import ORACLE
    o = lambda n: f"({ORACLE[n]})"
    top = lambda c: (f"(SELECT item_id, {c}, row_number() OVER (ORDER BY {c} DESC NULLS LAST, item_id) AS pos "  # noqa: E731
                     f"FROM ({CAT} SELECT * FROM catalogue) QUALIFY pos <= 20)")
    return f"""SELECT 'genre_counts' AS tbl, genre AS key, CAST(n AS DOUBLE) AS value FROM {o('genre_counts')}
UNION ALL SELECT 'type_distribution', type, CAST(n AS DOUBLE) FROM {o('type_distribution')}
UNION ALL SELECT 'type_percent', type, percent FROM {o('type_distribution')}
UNION ALL SELECT 'score_histogram', CAST(bin AS VARCHAR), CAST(n AS DOUBLE) FROM {o('score_histogram')}
UNION ALL SELECT 'score_histogram_start', CAST(bin AS VARCHAR), bin_start FROM {o('score_histogram')}
UNION ALL SELECT 'correlation', unnest([{', '.join(f"'{a} {b}'" for a in profile.NUMERIC for b in profile.NUMERIC)}]),
  unnest([{', '.join(f"round(corr({a}, {b}), 6)" for a in profile.NUMERIC for b in profile.NUMERIC)}]) FROM ({CAT} SELECT * FROM catalogue)
UNION ALL SELECT 'top_score', CAST(item_id AS VARCHAR), round(score, 6) FROM {top('score')}
UNION ALL SELECT 'top_members', CAST(item_id AS VARCHAR), round(members, 6) FROM {top('members')}"""


@register("profile_all_rows", _profile_rows_sql())
def profile_all_rows(spark, sf):
    """The rows of all profile tables of the catalogue, in long form (table, key, value)."""
    t = profile.profile_all(stages.catalogue(spark, sf))
    parts = (("genre_counts", "genre_counts", "genre", "n"), ("type_distribution", "type_distribution", "type", "n"),
             ("type_percent", "type_distribution", "type", "percent"), ("score_histogram", "score_histogram", "bin", "n"),
             ("score_histogram_start", "score_histogram", "bin", "bin_start"), ("top_score", "top_score", "item_id", "score"),
             ("top_members", "top_members", "item_id", "members"))
    row = lambda df, name, key, value: df.select(F.lit(name).alias("tbl"), key.cast("string").alias("key"),
                                                 F.round(value.cast("double"), 6).alias("value"))
    out = row(t["correlation"], "correlation", F.concat_ws(" ", "a", "b"), F.col("r"))
    for name, table, key, value in parts:
        out = out.unionByName(row(t[table], name, F.col(key), F.col(value)))
    return out


@register("episode_histogram", ctes(CAT_CTES, _hist_sql("catalogue", "episodes", 50)) + """
SELECT g.bin, round(w.lo + g.bin * w.width, 6) AS bin_start, round(w.lo + (g.bin + 1) * w.width, 6) AS bin_end,
       coalesce(c.n, 0) AS n
FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(50)) g CROSS JOIN w LEFT JOIN c USING (bin)""")
def episode_histogram(spark, sf):
    """Histogram of all episode counts (50 bins)."""
    return profile.histogram(stages.catalogue(spark, sf), "episodes", 50)
