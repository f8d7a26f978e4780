"""Shared stage builders: the derived inputs most queries start from.

Shared inputs are written as tables when a query is first built; the rest
stays lazy.
The SQL twins are in ``base_sql`` and below as CTE text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import hashlib

from ranklight.operators import clean, collab
from ranklight.plans.base_sql import CATALOGUE_RAW, RATINGS_LOG
from ranklight.session import stage_path
from ranklight.sources import tables


_MEMO: dict = {}


def materialize(spark: SparkSession, sf: str, name: str, build) -> DataFrame:
    """Build a stage once per application and data folder, written as a
    parquet table in the shared checkpoint folder and read back.

    Downstream plans start from the written table: short lineage, a lost
    executor costs a re-read instead of a recomputation, and the scan has
    column pruning, pushed filters and size statistics (so Spark can decide
    on broadcasts).  Computed once (a checkpoint of an uncached plan would
    compute it twice)."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _MEMO:
        tag = hashlib.md5(sf.encode()).hexdigest()[:8]
        path = stage_path(spark, f"{spark.sparkContext.applicationId}/{name}-{tag}")
        build().write.mode("overwrite").parquet(path)
        df = spark.read.parquet(path)
        # A small stage can come back as one file with one row group, i.e.
        # one scan task for every later plan: it is dealt out evenly.  Never
        # by a key, or a frequent key would lie in one task from here on.
        n = spark.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() < n:
            df = df.repartition(n)
        _MEMO[key] = df
    return _MEMO[key]


def forget() -> None:
    """Build every stage anew when it is next asked for."""
    _MEMO.clear()


def catalogue_raw(spark: SparkSession, sf: str) -> DataFrame:
    return materialize(spark, sf, "catalogue_raw", lambda: tables.catalogue_raw(spark, sf))


def catalogue(spark: SparkSession, sf: str) -> DataFrame:
    """The cleaned catalogue."""
    return materialize(spark, sf, "catalogue", lambda: clean.clean_catalogue(catalogue_raw(spark, sf)))


def ratings_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Ratings: keep-last per (user, item), without 'watching' rows."""
    return materialize(spark, sf, "ratings_clean", lambda: clean.drop_watching(
        clean.ratings_keep_last(tables.ratings_log(spark, sf))).select("user_id", "item_id", "rating"))


def content_model(spark: SparkSession, sf: str):
    """R1 fitted once per application and data folder: the term-weight table
    is written as a checkpoint, so every query on the model starts from it."""
    from ranklight.operators import content
    key = (spark.sparkContext.applicationId, sf, "content_model")
    if key not in _MEMO:
        m = content.fit(catalogue(spark, sf), 5000, (1, 2))
        m.weights = materialize(spark, sf, "content_weights", lambda: m.weights)
        _MEMO[key] = m
    return _MEMO[key]


def ratings_split(spark: SparkSession, sf: str, test_size: float = 0.2) -> DataFrame:
    return materialize(spark, sf, f"ratings_split_{test_size}",
                       lambda: collab.split_train_test(ratings_clean(spark, sf), test_size))


def baseline_model(spark: SparkSession, sf: str):
    """M2 fitted once per application and data folder, with its split: the
    mean and the biases are written tables."""
    split = ratings_split(spark, sf)
    key = (spark.sparkContext.applicationId, sf, "baseline_model")
    if key not in _MEMO:
        m = collab.fit_baseline(collab.train_part(split))
        m.mu = materialize(spark, sf, "baseline_mu", lambda: m.mu)
        m.item_bias = materialize(spark, sf, "baseline_items", lambda: m.item_bias)
        m.user_bias = materialize(spark, sf, "baseline_users", lambda: m.user_bias)
        _MEMO[key] = m
    return _MEMO[key], split


def baseline_test_predictions(spark: SparkSession, sf: str) -> DataFrame:
    model, split = baseline_model(spark, sf)
    return materialize(spark, sf, "baseline_predictions",
                       lambda: collab.predict_baseline(model, collab.test_part(split)))


def factor_model(spark: SparkSession, sf: str, algorithm: str = "SVD", rank: int = 100, max_iter: int = 20,
                 reg: float = 0.1):
    """M3 / M4 fitted once per application, data folder and parameters: stored
    (S12) and loaded back, so every query starts from the same factors."""
    from ranklight.sources import io
    key = (spark.sparkContext.applicationId, sf, "factors", algorithm, rank, max_iter, reg)
    if key not in _MEMO:
        fm = collab.fit_factors(collab.train_part(ratings_split(spark, sf)), algorithm, rank, max_iter, reg)
        tag = hashlib.md5(sf.encode()).hexdigest()[:8]
        path = stage_path(spark, f"{spark.sparkContext.applicationId}/{algorithm}-{rank}-{max_iter}-{reg}-{tag}")
        io.save_factor_model(fm, path)
        loaded = io.load_factor_model(spark, path, fm.baseline is not None)
        loaded.params = fm.params
        _MEMO[key] = loaded
    return _MEMO[key]


def factor_test_predictions(spark: SparkSession, sf: str, algorithm: str = "SVD", rank: int = 100, max_iter: int = 20,
                            reg: float = 0.1) -> DataFrame:
    """The held-out ratings with their predictions: read by every measure."""
    return materialize(spark, sf, f"factor_predictions_{algorithm}-{rank}-{max_iter}-{reg}", lambda: collab.predict_factors(
        factor_model(spark, sf, algorithm, rank, max_iter, reg), collab.test_part(ratings_split(spark, sf))))


def list_frame(spark: SparkSession, sf: str, kind: str = "baseline") -> DataFrame:
    """Content, collaborative and hybrid lists of all test users, built once:
    with the bias model, or with the trained factors (``SVD``, ``NMF``)."""
    from ranklight.operators import evaluate
    base, split = baseline_model(spark, sf)
    model = base if kind == "baseline" else factor_model(spark, sf, kind)
    return materialize(spark, sf, f"list_frame_{kind}", lambda: evaluate.list_frame(
        content_model(spark, sf), model, collab.train_part(split), catalogue(spark, sf), collab.test_part(split)))


def word_vectors(spark: SparkSession, sf: str, vector_size: int = 100) -> DataFrame:
    """E1 trained once per application and data folder: (word, vector)."""
    from ranklight.operators import embed
    return materialize(spark, sf, f"word_vectors_{vector_size}", lambda: embed.word_vectors(
        embed.word2vec_fit(catalogue(spark, sf), vector_size, 5, 2, 20, 42)))


# ------------------------------------------------------------ SQL twins

KEEP_LAST_SQL = """ratings_dedup AS (
  SELECT user_id, item_id, rating FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, item_id
      ORDER BY event_ts DESC, l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC, l_quantity DESC) AS rn
    FROM ratings_log) WHERE rn = 1)"""

RATINGS_CLEAN_SQL = """ratings_clean AS (SELECT user_id, item_id, rating FROM ratings_dedup WHERE rating > 0)"""

SPLIT_SQL = """ratings_split AS (
  SELECT *, CASE WHEN substr(md5(CAST(user_id AS VARCHAR) || '-' || CAST(item_id AS VARCHAR)), 1, 4) < '3333'
                 THEN 'test' ELSE 'train' END AS split
  FROM ratings_clean),
train AS (SELECT user_id, item_id, rating FROM ratings_split WHERE split = 'train'),
test AS (SELECT user_id, item_id, rating FROM ratings_split WHERE split = 'test')"""

BASELINE_SQL = """mu AS (SELECT avg(rating) AS mu FROM train),
bi AS (SELECT item_id, sum(rating - (SELECT mu FROM mu)) / (count(*) + 10.0) AS b_i FROM train GROUP BY item_id),
bu AS (SELECT user_id, sum(rating - (SELECT mu FROM mu) - b_i) / (count(*) + 15.0) AS b_u
       FROM train JOIN bi USING (item_id) GROUP BY user_id)"""

TEST_PRED_SQL = """test_pred AS (
  SELECT user_id, item_id, rating, raw_prediction,
         CASE WHEN raw_prediction IS NULL THEN NULL ELSE least(greatest(raw_prediction, 1.0), 10.0) END AS prediction
  FROM (SELECT t.user_id, t.item_id, t.rating,
               (SELECT mu FROM mu) + coalesce(bu.b_u, 0) + coalesce(bi.b_i, 0) AS raw_prediction
        FROM test t LEFT JOIN bi USING (item_id) LEFT JOIN bu USING (user_id)))"""

CF_CTES = [RATINGS_LOG, KEEP_LAST_SQL, RATINGS_CLEAN_SQL, SPLIT_SQL, BASELINE_SQL, TEST_PRED_SQL]

# Catalogue cleaning (C1-C11) in SQL.
CLEAN_SQL = """cat_missing AS (
  SELECT item_id, name, english_name, genres, type, source, studios, producers, rating, premiered,
         popularity, rank, src_row,
         coalesce(TRY_CAST(score AS DOUBLE), (SELECT median(TRY_CAST(score AS DOUBLE)) FROM catalogue_raw)) AS score,
         coalesce(TRY_CAST(episodes AS DOUBLE), (SELECT median(TRY_CAST(episodes AS DOUBLE)) FROM catalogue_raw)) AS episodes,
         coalesce(CAST(members AS DOUBLE), (SELECT median(CAST(members AS DOUBLE)) FROM catalogue_raw)) AS members,
         coalesce(CAST(favorites AS DOUBLE), (SELECT median(CAST(favorites AS DOUBLE)) FROM catalogue_raw)) AS favorites,
         coalesce(CAST(scored_by AS DOUBLE), (SELECT median(CAST(scored_by AS DOUBLE)) FROM catalogue_raw)) AS scored_by
  FROM catalogue_raw),
cat_filled AS (
  SELECT * REPLACE (coalesce(genres, 'Unknown') AS genres, coalesce(type, 'Unknown') AS type)
  FROM cat_missing WHERE item_id IS NOT NULL AND name IS NOT NULL),
cat_dedup_id AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY src_row) AS rn FROM cat_filled)
  WHERE rn = 1),
cat_dedup AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY lower(name) ORDER BY src_row) AS rn
                              FROM cat_dedup_id) WHERE rn = 1),
cat_norm AS (
  SELECT * REPLACE (
      CASE WHEN score IS NULL THEN NULL ELSE least(greatest(score, 0.0), 10.0) END AS score,
      regexp_replace(name, '^\\s+|\\s+$', '', 'g') AS name,
      regexp_replace(english_name, '^\\s+|\\s+$', '', 'g') AS english_name,
      regexp_replace(genres, '^\\s+|\\s+$', '', 'g') AS genres,
      regexp_replace(type, '^\\s+|\\s+$', '', 'g') AS type,
      coalesce(episodes, 0.0) AS episodes),
    CASE WHEN genres IS NULL THEN []::VARCHAR[]
         ELSE list_transform(string_split(regexp_replace(genres, '^\\s+|\\s+$', '', 'g'), ','),
                             lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')) END AS genres_list
  FROM cat_dedup),
cat_q AS (SELECT quantile_cont(members, 0.25) AS q1, quantile_cont(members, 0.75) AS q3 FROM cat_norm),
catalogue AS (
  SELECT * FROM cat_norm
  WHERE members >= (SELECT q1 - 3 * (q3 - q1) FROM cat_q) AND members <= (SELECT q3 + 3 * (q3 - q1) FROM cat_q)
    AND score > 0)"""

CAT_CTES = [RATINGS_LOG, CATALOGUE_RAW, CLEAN_SQL]


def ctes(*parts) -> str:
    flat = []
    for p in parts:
        for x in (p if isinstance(p, (list, tuple)) else [p]):
            if x not in flat:
                flat.append(x)
    return "WITH " + ",\n".join(flat) + "\n"
