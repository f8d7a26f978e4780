"""Training-corpus pipeline over ``documents``: five stages in order.

Every stage takes all rows its predecessor kept and returns the columns of
``documents``, the last one the packed pieces.  ``run`` writes each stage's
result as Parquet in the shared checkpoint folder and reads it back, so a lost
executor costs no earlier stage.

Stages work on rows of any kind: null texts are rejected by the first stage;
repeated rows, null ids and further columns are described with each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ranklight.llm import decontam, langid, neardup, packing, secrets_ledger
from ranklight.llm.common import scratch, table

#: A text this far from every language (cosine) is none of them, if it has
#: letters enough to tell: the cosines of a few n-grams are as low by chance.
MIN_LANGUAGE_SCORE = 0.05
MIN_LETTERS = 60


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labels teach; those without
    a letter, or with MIN_LETTERS letters and like no language, go.  A null
    ``lang`` gets the prediction.  If no document has a label, nothing is
    taught and nothing rejected."""
    model = langid.train_split(docs)
    if not model.languages:
        return docs
    p = docs.withColumn("_llm_p", langid.prediction(model, F.col("text")))
    letters = F.length(F.regexp_replace("text", r"[^\p{L}]+", ""))
    like = (F.col("_llm_p.score") >= MIN_LANGUAGE_SCORE) | (letters < MIN_LETTERS)
    p = p.where((F.col("_llm_p.lang_pred") != langid.UNKNOWN) & like)
    return p.withColumn("lang", F.coalesce("lang", "_llm_p.lang_pred")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate component: the one of the smallest
    doc_id, of two texts under that id the one of the smaller text hash.  Rows
    without an id are members like others and stand behind those with one.  A
    row without words is a component of its own; repeated rows count once."""
    row = neardup.groups(docs).groupBy("root", "doc_id", "version").agg(F.count(F.lit(1)).alias("copies"))
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "version", "copies")
    heads = row.where("root is not null").groupBy("root").agg(F.min(first).alias("h")).select("h.*")
    heads = heads.drop("no_id").unionByName(row.where("root is null").drop("root"))
    heads = heads.select(F.col("doc_id").alias("_llm_id"), F.col("version").alias("_llm_version"), "copies")
    found = docs.withColumn("_llm_hash", F.xxhash64(F.col("text").cast("string")))
    kept = found.join(heads.hint("shuffle_hash"), (F.col("_llm_hash") == F.col("_llm_version"))
                      & found["doc_id"].cast("long").eqNullSafe(F.col("_llm_id")))
    kept = kept.select(*docs.columns, F.col("copies").alias("_llm_copies"))
    again = kept.where("_llm_copies > 1").dropDuplicates(["doc_id", "text"])
    return kept.where("_llm_copies = 1").unionByName(again).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark."""
    return secrets_ledger.redact(docs)


def mixture_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows that mirror the sources' shares."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("mixture_packing", mixture_packing),
]

#: Language profiles and tokenizer ids have no SQL form; tests/llm checks the pipeline.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline over all of ``documents``: the pieces of what it keeps."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
