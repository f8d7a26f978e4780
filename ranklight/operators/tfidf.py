"""Tokens, n-grams, vocabulary and TF-IDF weights.

Text stays whole: every token of every document is counted.  Documents
become a long table ``(doc, term, tf)``; document frequencies, vocabulary
and idf are grouped aggregates over it; weights are one join of the counts
to the vocabulary (small when ``max_features`` bounds it) and one grouped
norm per document.

Weight = tf * (ln((1 + n) / (1 + df)) + 1), rows scaled to unit length
(smoothed idf, l2 norm).  Spark ML's ``IDF`` lacks the "+ 1", so the
formula is written out here.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklight.functions.columns import WORD_CLASS

TOKEN_PATTERN = f"[{WORD_CLASS}]{{2,}}"

# Our English stop-word list (a short list of our own; the
# same list is used by the SQL oracle).
STOP_WORDS = ("a", "about", "after", "all", "also", "an", "and", "any", "are", "as", "at", "be", "been",
              "but", "by", "can", "could", "do", "for", "from", "had", "has", "have", "he", "her", "his",
              "if", "in", "into", "is", "it", "its", "more", "no", "not", "of", "on", "one", "or", "other",
              "our", "out", "she", "so", "some", "than", "that", "the", "their", "them", "then", "there",
              "these", "they", "this", "to", "up", "was", "we", "were", "what", "when", "which", "who",
              "will", "with", "would", "you", "your")


def tokenize(df: DataFrame, id_col: str, text_col: str, stop_words=STOP_WORDS) -> DataFrame:
    """(id, tokens): lower case, runs of >= 2 word characters, stop
    words removed."""
    toks = F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(TOKEN_PATTERN), 0)
    if stop_words:
        stop = F.array(*[F.lit(w) for w in stop_words])
        toks = F.filter(toks, lambda t: ~F.array_contains(stop, t))
    return df.select(F.col(id_col).alias("doc_id"), F.coalesce(toks, F.array().cast("array<string>")).alias("tokens"))


def by_document(tokens: DataFrame) -> DataFrame:
    """The tokens with all rows of a document together: its terms are then
    counted where they lie, and tokens travel instead of n-grams."""
    return tokens.repartition("doc_id")


def ngram_terms(tokens: DataFrame, ngram_range=(1, 2)) -> DataFrame:
    """(doc_id, term) for all n-grams in range, formed after stop-word
    removal.  One row per occurrence."""
    lo, hi = ngram_range
    arrays = []
    t = F.col("tokens")
    for n in range(lo, hi + 1):
        if n == 1:
            arrays.append(t)
        else:
            idx = F.sequence(F.lit(0), F.size(t) - n)
            grams = F.transform(idx, lambda i: F.concat_ws(" ", F.slice(t, i + 1, n)))
            arrays.append(F.when(F.size(t) >= n, grams).otherwise(F.array().cast("array<string>")))
    allg = arrays[0] if len(arrays) == 1 else F.concat(*arrays)
    return tokens.select("doc_id", F.explode(allg).alias("term"))


def term_counts(terms: DataFrame) -> DataFrame:
    """(doc_id, term, tf): one grouped count, without a shuffle of terms where
    the tokens came ``by_document`` (else combined map-side)."""
    return terms.groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf"))


@dataclass
class TfidfModel:
    vocab: DataFrame          # term, df, total, idf
    n_docs: F.Column          # scalar (subquery) number of documents
    params: dict


def fit_vocabulary(counts: DataFrame, n_docs, min_df: int = 1, max_df: float = 1.0,
                   max_features: int | None = None) -> DataFrame:
    """T3 + T4: document frequency bounds, then the max_features terms of
    highest total count (ties by term)."""
    stats = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total"))
    max_count = F.lit(max_df) * n_docs if isinstance(max_df, float) else F.lit(max_df)
    stats = stats.filter((F.col("df") >= min_df) & (F.col("df") <= max_count))
    if max_features:
        stats = stats.orderBy(F.col("total").desc(), F.col("term")).limit(max_features)
    return stats.withColumn("idf", F.log((1 + n_docs) / (1 + F.col("df"))) + 1)


def fit(docs: DataFrame, id_col: str, text_col: str, max_features: int | None = None,
        ngram_range=(1, 2), min_df: int = 1, max_df: float = 1.0, stop_words=STOP_WORDS):
    """T5 fit: returns (model, weights) with weights = (doc_id, term, w)."""
    toks = tokenize(docs, id_col, text_col, stop_words)
    counts = term_counts(ngram_terms(by_document(toks), ngram_range))
    n_docs = docs.select(F.count(F.lit(1))).scalar()
    vocab = fit_vocabulary(counts, n_docs, min_df, max_df, max_features)
    model = TfidfModel(vocab, n_docs, {"max_features": max_features, "ngram_range": ngram_range,
                                       "min_df": min_df, "max_df": max_df, "stop_words": stop_words})
    return model, weights(counts, vocab)


def weights(counts: DataFrame, vocab: DataFrame) -> DataFrame:
    """tf * idf on vocabulary terms, scaled to unit length per document."""
    # The vocabulary is bounded by max_features when set; Spark broadcasts it
    # only when its measured size is under the broadcast threshold.
    v = vocab.select("term", "idf")
    raw = counts.join(v, "term").withColumn("raw", F.col("tf") * F.col("idf"))
    norms = raw.groupBy("doc_id").agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("norm"))
    return raw.join(norms, "doc_id").select("doc_id", "term", (F.col("raw") / F.col("norm")).alias("w"))


def transform(model: TfidfModel, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Weights for new texts with a fitted vocabulary and idf."""
    p = model.params
    toks = tokenize(docs, id_col, text_col, p["stop_words"])
    counts = term_counts(ngram_terms(by_document(toks), p["ngram_range"]))
    return weights(counts, model.vocab)
