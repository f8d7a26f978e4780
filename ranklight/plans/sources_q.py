"""Source and sink queries (S1-S14): scans with declared schemas, sampled
reads, and round trips through the writers (files go to the shared
checkpoint folder)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ranklight.operators import clean, content
from ranklight.plans import stages
from ranklight.plans.base_sql import CATALOGUE_RAW, RATINGS_LOG
from ranklight.plans.registry import register
from ranklight.plans.stages import KEEP_LAST_SQL, RATINGS_CLEAN_SQL, ctes
from ranklight.session import stage_path
from ranklight.sources import io, tables


def _scratch(spark, name: str) -> str:
    return stage_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


@register("scan_catalogue", ctes(RATINGS_LOG, CATALOGUE_RAW) + "SELECT * FROM catalogue_raw")
def scan_catalogue(spark, sf):
    """The raw catalogue written out and read back with its declared schema."""
    path = _scratch(spark, "catalogue")
    io.write_table(stages.catalogue_raw(spark, sf), path, "csv")
    return io.scan_catalogue(spark, path, "csv")


@register("scan_ratings", ctes(RATINGS_LOG) + "SELECT user_id, item_id, rating FROM ratings_log")
def scan_ratings(spark, sf):
    """S2 + S4: the ratings log, three columns only (pruned at the scan)."""
    return tables.ratings(spark, sf)


@register("scan_ratings_first_n", ctes(RATINGS_LOG, KEEP_LAST_SQL) + """
SELECT user_id, item_id, rating FROM ratings_dedup ORDER BY user_id, item_id LIMIT 1000""")
def scan_ratings_first_n(spark, sf):
    """S2 with nrows: the first 1,000 rows in (user, item) order of a written ratings table."""
    path = _scratch(spark, "ratings")
    io.write_table(clean.ratings_keep_last(tables.ratings_log(spark, sf)).select("user_id", "item_id", "rating"), path)
    return io.scan_ratings(spark, path, "parquet", nrows=1000)


@register("scan_history", "SELECT user_id, event_type, ts FROM events")
def scan_history(spark, sf):
    """S3: the activity history (events), projected to user, type and time."""
    return io.scan_history(spark, f"{sf}/events.parquet", "parquet", ["user_id", "event_type", "ts"])


@register("scan_positive", ctes(RATINGS_LOG) + """
SELECT count(*) AS n, count(DISTINCT user_id) AS users, round(avg(rating), 6) AS mean_rating FROM ratings_log WHERE rating > 0""")
def scan_positive(spark, sf):
    """One partitioned scan of the log keeping rated rows (D11: no file prefix)."""
    r = tables.ratings(spark, sf).filter(F.col("rating") > 0)
    return r.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"),
                 F.round(F.avg("rating"), 6).alias("mean_rating"))


@register("scan_positive_sample", ctes(RATINGS_LOG) + """
SELECT user_id, item_id, rating, l_orderkey, l_linenumber FROM ratings_log WHERE rating > 0
ORDER BY md5(CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-42'), l_orderkey, l_linenumber LIMIT 10000""")
def scan_positive_sample(spark, sf):
    """S5 with its sample step: 10,000 rated rows of the log in md5 order."""
    r = tables.ratings_log(spark, sf).filter(F.col("rating") > 0).select("user_id", "item_id", "rating", "l_orderkey", "l_linenumber")
    return clean.sample_n(r, 10000, 42, ("l_orderkey", "l_linenumber"))


@register("sample_n", ctes(RATINGS_LOG, KEEP_LAST_SQL, RATINGS_CLEAN_SQL) + """
SELECT user_id, item_id, rating FROM ratings_clean
ORDER BY md5(CAST(user_id AS VARCHAR) || '-' || CAST(item_id AS VARCHAR) || '-7'), user_id, item_id LIMIT 5000""")
def sample_n(spark, sf):
    """Exactly 5,000 ratings chosen by md5 order with seed 7."""
    return clean.sample_n(stages.ratings_clean(spark, sf), 5000, seed=7)


def _reco_csv_sql():
    from ranklight.plans.collab_q import RECO_ALL_SQL
    head, tail = RECO_ALL_SQL[:RECO_ALL_SQL.rindex("\nSELECT")], RECO_ALL_SQL[RECO_ALL_SQL.rindex("\nSELECT"):]
    return head + ",\nreco AS (" + tail.strip() + """)
SELECT 'baseline' AS model, count(*) AS n, count(DISTINCT user_id) AS users FROM reco"""


def _metrics_json_sql():
    from ranklight.plans.metrics_q import evaluate_all
    from ranklight.plans.registry import ORACLE
    return ORACLE["evaluate_all"]


@register("sink_recommendations_csv", _reco_csv_sql())
def sink_recommendations_csv(spark, sf):
    """Top-10 lists written as CSV partitioned by model, read back."""
    from ranklight.plans.collab_q import recommend_all_users
    path = _scratch(spark, "recs")
    io.write_recommendations(recommend_all_users(spark, sf).withColumn("model", F.lit("baseline")), path)
    back = spark.read.option("header", True).csv(path)
    return back.groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"))


@register("sink_metrics_json", _metrics_json_sql())
def sink_metrics_json(spark, sf):
    """The metrics table written as JSON and read back."""
    from ranklight.plans.metrics_q import evaluate_all
    path = _scratch(spark, "metrics")
    io.write_metrics_json(evaluate_all(spark, sf), path)
    return spark.read.schema("metric string, k int, value double").json(path)


@register("save_matrix", ctes(RATINGS_LOG, KEEP_LAST_SQL, RATINGS_CLEAN_SQL) + """
SELECT count(*) AS cells, (SELECT count(DISTINCT user_id) - 1 FROM ratings_clean) AS max_user_idx,
       (SELECT count(DISTINCT item_id) - 1 FROM ratings_clean) AS max_item_idx, round(sum(rating), 6) AS sum_rating
FROM ratings_clean""")
def save_matrix(spark, sf):
    """The user-item long table (dense indexes) written and read back."""
    from ranklight.operators.features import user_item_index
    path = _scratch(spark, "matrix")
    _, _, indexed = user_item_index(stages.ratings_clean(spark, sf))
    io.write_table(indexed.select("user_idx", "item_idx", "rating"), path)
    m = spark.read.parquet(path)
    return m.agg(F.count(F.lit(1)).alias("cells"), F.max("user_idx").alias("max_user_idx"),
                 F.max("item_idx").alias("max_item_idx"), F.round(F.sum("rating"), 6).alias("sum_rating"))


def _roundtrip_sql():
    from ranklight.plans.content_q import _FIRST_ITEM, _reco_sql
    return _reco_sql(_FIRST_ITEM, 0.0, False, 10)


@register("content_model_roundtrip", _roundtrip_sql())
def content_model_roundtrip(spark, sf):
    """The content model saved as tables, loaded, and queried (= similar_items)."""
    from ranklight.plans.content_q import _RESULT, _first_item
    path = _scratch(spark, "content_model")
    io.save_content_model(stages.content_model(spark, sf), path)
    model = io.load_content_model(spark, path)
    return content.recommend_batch(model, _first_item(spark, sf), 10).select(*_RESULT.split(", "))
