"""Readers and writers.

Reads declare their schema (no inference pass over the data) and select
only the needed columns, so column pruning and filters reach the scan.
Writes are partitioned Spark writes; models are stored as tables (and
Spark ML's own writers), never as pickled Python objects.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

CATALOGUE_SCHEMA = StructType([
    StructField("item_id", LongType()), StructField("name", StringType()), StructField("score", StringType()),
    StructField("genres", StringType()), StructField("type", StringType()), StructField("episodes", StringType()),
    StructField("members", LongType()), StructField("favorites", LongType()), StructField("scored_by", LongType()),
    StructField("source", StringType()), StructField("studios", StringType()), StructField("producers", StringType()),
    StructField("rating", StringType()), StructField("premiered", StringType()),
    StructField("english_name", StringType()), StructField("popularity", LongType()), StructField("rank", LongType()),
    StructField("src_row", LongType())])
RATINGS_SCHEMA = StructType([StructField("user_id", LongType()), StructField("item_id", LongType()),
                             StructField("rating", DoubleType())])


def _reader(spark: SparkSession, fmt: str, schema: StructType | None):
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.option("header", True)
    if schema is not None and fmt in ("csv", "json"):
        r = r.schema(schema)
    return r


def scan_catalogue(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The catalogue with its declared schema.  A missing path raises
    (Spark's PATH_NOT_FOUND) when the plan is built."""
    return _reader(spark, fmt, CATALOGUE_SCHEMA).load(path)


def scan_ratings(spark: SparkSession, path: str, fmt: str = "parquet", nrows: int | None = None) -> DataFrame:
    """S2 + S4: the three rating columns only; ``nrows`` keeps the first n
    in a stable order (user, item) - a plain limit has no order."""
    df = _reader(spark, fmt, RATINGS_SCHEMA).load(path).select("user_id", "item_id", "rating")
    if nrows is not None:
        df = df.orderBy("user_id", "item_id").limit(nrows)
    return df


def scan_history(spark: SparkSession, path: str, fmt: str = "parquet", columns=None) -> DataFrame:
    """S3: a watch-history / activity table, projected to ``columns``."""
    df = _reader(spark, fmt, None).load(path)
    return df.select(*columns) if columns else df


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """A partitioned write (arrays need parquet or JSON)."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_recommendations(df: DataFrame, path: str, model_col: str = "model") -> None:
    """Result lists as CSV with header, one folder per model."""
    write_table(df, path, "csv", partition_by=[model_col] if model_col in df.columns else None)


def write_metrics_json(df: DataFrame, path: str) -> None:
    """Metrics as JSON lines (nested forms via struct / to_json).  A
    metrics table has one row per (model, metric, k): one file is enough."""
    write_table(df.coalesce(1), path, "json")


# ---------------------------------------------------------------- models as tables

def save_content_model(model, path: str) -> None:
    """Term weights, item columns and the vocabulary as parquet."""
    write_table(model.weights, f"{path}/weights")
    write_table(model.items, f"{path}/items")
    write_table(model.tfidf.vocab, f"{path}/vocab")
    spark = model.weights.sparkSession
    params = dict(model.tfidf.params)
    params["stop_words"] = list(params["stop_words"] or [])
    params["ngram_range"] = list(params["ngram_range"])
    spark.createDataFrame([(json.dumps(params),)], "params string").write.mode("overwrite").json(f"{path}/params")


def load_content_model(spark: SparkSession, path: str):
    from ranklight.operators.content import ContentModel
    from ranklight.operators.tfidf import TfidfModel
    params = json.loads(spark.read.json(f"{path}/params").first()["params"])
    params["ngram_range"] = tuple(params["ngram_range"])
    params["stop_words"] = tuple(params["stop_words"])
    vocab = spark.read.parquet(f"{path}/vocab")
    tf = TfidfModel(vocab, None, params)
    return ContentModel(spark.read.parquet(f"{path}/weights"), spark.read.parquet(f"{path}/items"), tf)


def save_baseline(model, path: str) -> None:
    """S12 (bias part): mean and biases as parquet."""
    write_table(model.mu, f"{path}/mu")
    write_table(model.item_bias, f"{path}/item_bias")
    write_table(model.user_bias, f"{path}/user_bias")


def load_baseline(spark: SparkSession, path: str):
    from ranklight.operators.collab import Baseline
    return Baseline(spark.read.parquet(f"{path}/mu"), spark.read.parquet(f"{path}/item_bias"),
                    spark.read.parquet(f"{path}/user_bias"))


def save_factor_model(model, path: str) -> None:
    """ALS factors with Spark ML's writer, index tables, biases."""
    model.als.write().overwrite().save(f"{path}/als")
    write_table(model.users, f"{path}/users")
    write_table(model.items, f"{path}/items")
    if model.baseline is not None:
        save_baseline(model.baseline, f"{path}/baseline")


def load_factor_model(spark: SparkSession, path: str, with_baseline: bool = True):
    from pyspark.ml.recommendation import ALSModel
    from ranklight.operators.collab import FactorModel
    base = load_baseline(spark, f"{path}/baseline") if with_baseline else None
    return FactorModel(ALSModel.load(f"{path}/als"), spark.read.parquet(f"{path}/users"),
                       spark.read.parquet(f"{path}/items"), base)


def save_hybrid_config(spark: SparkSession, path: str, content_weight: float, collaborative_weight: float,
                       strategy: str) -> None:
    """The hybrid's own state is one row next to the two models."""
    spark.createDataFrame([(content_weight, collaborative_weight, strategy)],
                          "content_weight double, collaborative_weight double, strategy string") \
        .write.mode("overwrite").parquet(path)


def load_hybrid_config(spark: SparkSession, path: str) -> dict:
    return spark.read.parquet(path).first().asDict()


def save_word2vec(model, path: str) -> None:
    """Spark ML's writer plus the vectors as a plain table."""
    from ranklight.operators.embed import word_vectors
    model.write().overwrite().save(f"{path}/model")
    write_table(word_vectors(model), f"{path}/vectors")


def load_word_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/vectors")
