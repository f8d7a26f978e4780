"""Text, similarity and content-based queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ranklight.functions.columns import md5_key, r6
from ranklight.functions.topk import SKEW_SALT, top_k_per_group
from ranklight.operators import collab, content, similarity, tfidf
from ranklight.plans import stages
from ranklight.plans.registry import register
from ranklight.plans.stages import CAT_CTES, ctes
from ranklight.sources import tables

_STOP = "[" + ", ".join(f"'{w}'" for w in tfidf.STOP_WORDS) + "]"
_PAT = "[\\p{L}\\p{N}_]{2,}"


def tok_sql(src: str, id_col: str, text_col: str, p: str = "") -> str:
    return f"""{p}toks AS (
  SELECT {id_col} AS doc_id,
         coalesce(list_filter(regexp_extract_all(lower({text_col}), '{_PAT}'), lambda t: NOT list_contains({_STOP}, t)),
                  []::VARCHAR[]) AS tokens FROM {src}),
{p}terms AS (
  SELECT doc_id, unnest(tokens) AS term FROM {p}toks
  UNION ALL
  SELECT doc_id, unnest(list_transform(range(1, len(tokens)), lambda i: tokens[i] || ' ' || tokens[i + 1]))
  FROM {p}toks WHERE len(tokens) >= 2),
{p}counts AS (SELECT doc_id, term, count(*) AS tf FROM {p}terms GROUP BY doc_id, term)"""


def vocab_sql(n_src: str, min_df: int, max_df: float, max_features: int) -> str:
    return f"""nd AS (SELECT count(*) AS n FROM {n_src}),
vstats AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS total FROM counts GROUP BY term),
vocab AS (SELECT term, df, total, ln((1 + (SELECT n FROM nd)) / (1 + df)) + 1 AS idf FROM vstats
          WHERE df >= {min_df} AND df <= {max_df} * (SELECT n FROM nd)
          ORDER BY total DESC, term LIMIT {max_features}),
raww AS (SELECT c.doc_id, c.term, c.tf * v.idf AS raw FROM counts c JOIN vocab v USING (term)),
weights AS (SELECT doc_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS w FROM raww)"""


CONTENT_TEXT_SQL = """content_src AS (
  SELECT item_id, regexp_replace(lower(concat_ws(' ', coalesce(genres, ''), coalesce(genres, ''), coalesce(type, ''),
         coalesce(source, ''), coalesce(studios, ''), coalesce(rating, ''))), '^\\s+|\\s+$', '', 'g') AS content_text
  FROM catalogue)"""

CONTENT_CTES = ctes(CAT_CTES, CONTENT_TEXT_SQL, tok_sql("content_src", "item_id", "content_text"),
                    vocab_sql("content_src", 1, 1.0, 5000))
DOC_CTES = ctes(tok_sql("documents", "doc_id", "text"), vocab_sql("documents", 2, 0.8, 5000))


# ------------------------------------------------------------------ T1-T6 on the document corpus

def _doc_fit(spark, sf):
    docs = tables.table(spark, sf, "documents").select("doc_id", "text")
    return tfidf.fit(docs, "doc_id", "text", max_features=5000, ngram_range=(1, 2), min_df=2, max_df=0.8)


@register("tokenize_documents", ctes(tok_sql("documents", "doc_id", "text")) + """
SELECT doc_id, len(tokens) AS n_tokens, md5(array_to_string(tokens, ' ')) AS tokens_md5 FROM toks""")
def tokenize_documents(spark, sf):
    """Tokens of every whole document (count and a hash of the full sequence)."""
    t = tfidf.tokenize(tables.table(spark, sf, "documents"), "doc_id", "text")
    return t.select("doc_id", F.size("tokens").cast("long").alias("n_tokens"),
                    F.md5(F.array_join("tokens", " ")).alias("tokens_md5"))


@register("ngrams_documents", ctes(tok_sql("documents", "doc_id", "text")) + """
SELECT doc_id, count(*) AS n_terms, count(DISTINCT term) AS n_distinct FROM terms GROUP BY doc_id""")
def ngrams_documents(spark, sf):
    """Unigrams + bigrams per document."""
    t = tfidf.ngram_terms(tfidf.by_document(tfidf.tokenize(tables.table(spark, sf, "documents"), "doc_id", "text")), (1, 2))
    return t.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_terms"), F.count_distinct("term").alias("n_distinct"))


@register("vocabulary_documents", DOC_CTES + "SELECT term, df, total, round(idf, 6) AS idf FROM vocab")
def vocabulary_documents(spark, sf):
    """T3 + T4: 5,000 most frequent terms among those in >= 2 and <= 80 % of documents."""
    model, _ = _doc_fit(spark, sf)
    return model.vocab.select("term", "df", F.col("total").cast("long").alias("total"), r6("idf").alias("idf"))


@register("tfidf_documents", DOC_CTES + """
SELECT doc_id, count(*) AS n_terms, round(sum(w), 6) AS sum_w, round(max(w), 6) AS max_w FROM weights GROUP BY doc_id""")
def tfidf_documents(spark, sf):
    """T5: unit TF-IDF rows of the corpus (terms, sum and max weight per document)."""
    _, w = _doc_fit(spark, sf)
    return w.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_terms"), r6(F.sum("w")).alias("sum_w"),
                                   r6(F.max("w")).alias("max_w"))


@register("tfidf_transform", DOC_CTES.rstrip() + ",\n" + tok_sql("benchmark", "item_id", "text", "b_") + """,
b_raw AS (SELECT c.doc_id, c.term, c.tf * v.idf AS raw FROM b_counts c JOIN vocab v USING (term))
SELECT doc_id, term, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)), 6) AS w FROM b_raw""")
def tfidf_transform(spark, sf):
    """Weights of the benchmark passages under the corpus vocabulary and idf."""
    model, _ = _doc_fit(spark, sf)
    w = tfidf.transform(model, tables.table(spark, sf, "benchmark"), "item_id", "text")
    return w.select("doc_id", "term", r6("w").alias("w"))


# ------------------------------------------------------------------ similarity on the catalogue

def _content(spark, sf):
    return stages.content_model(spark, sf)


PAIRS_SQL = """pair_sims AS (
  SELECT a.doc_id AS doc_id, b.doc_id AS other, sum(a.w * b.w) AS sim, round(sum(a.w * b.w), 9) AS similarity
  FROM weights a JOIN weights b USING (term) WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id)"""


@register("content_all_pairs", CONTENT_CTES.rstrip() + ",\n" + PAIRS_SQL + """
SELECT doc_id, other, round(sim, 6) AS similarity, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY similarity DESC, other) AS rank FROM pair_sims
  WHERE similarity > 0) WHERE rank <= 10""", headline=True)
def content_all_pairs(spark, sf):
    """T8 + R1: top-10 cosine neighbours of every catalogue item (blocked exact product)."""
    nb = content.all_neighbours(_content(spark, sf), 10)
    return nb.filter(F.col("similarity") > 0).select("doc_id", "other", r6("similarity").alias("similarity"), "rank")


EMB_SQL = """emb AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
emb_pairs AS (
  SELECT a.vec_id AS doc_id, b.vec_id AS other,
         1.0 / (1.0 + sqrt(greatest(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: (a.v[i] - b.v[i]) * (a.v[i] - b.v[i]))), 0.0))) AS sim
  FROM emb a JOIN emb b ON a.vec_id <> b.vec_id)"""


@register("euclidean_neighbours", ctes(EMB_SQL) + """
SELECT doc_id, other, round(sim, 6) AS similarity, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(sim, 9) DESC, other) AS rank FROM emb_pairs)
WHERE rank <= 5""")
def euclidean_neighbours(spark, sf):
    """Top-5 neighbours of every embedding by 1 / (1 + euclidean distance)."""
    nb = similarity.vector_top_k(tables.table(spark, sf, "embeddings"), "vec_id", "embedding", 5, "euclidean")
    return nb.select("doc_id", "other", r6("similarity").alias("similarity"), "rank")


@register("similarity_threshold", CONTENT_CTES.rstrip() + ",\n" + PAIRS_SQL + """,
ids AS (SELECT DISTINCT doc_id FROM weights),
grid AS (SELECT a.doc_id AS doc_id, b.doc_id AS other FROM ids a JOIN ids b ON a.doc_id < b.doc_id)
SELECT round(quantile_cont(coalesce(p.sim, 0.0), 0.75), 6) AS threshold, count(*) AS n_pairs
FROM grid g LEFT JOIN pair_sims p USING (doc_id, other)""")
def similarity_threshold(spark, sf):
    """75th percentile of the strict upper triangle of the similarity matrix (zeros count)."""
    out = similarity.similarity_percentile(_content(spark, sf).weights, 75.0)
    return out.select(r6("threshold").alias("threshold"), "n_pairs")


@register("similarity_sample", CONTENT_CTES.rstrip() + ",\n" + PAIRS_SQL + """,
first AS (SELECT doc_id FROM (SELECT DISTINCT doc_id FROM weights) ORDER BY doc_id LIMIT 20),
grid AS (SELECT a.doc_id AS a, b.doc_id AS b FROM first a JOIN first b ON TRUE),
self AS (SELECT doc_id, sum(w * w) AS s FROM weights GROUP BY doc_id)
SELECT g.a, g.b, round(CASE WHEN g.a = g.b THEN s.s ELSE coalesce(p.sim, 0.0) END, 6) AS similarity
FROM grid g LEFT JOIN pair_sims p ON p.doc_id = g.a AND p.other = g.b LEFT JOIN self s ON s.doc_id = g.a""")
def similarity_sample(spark, sf):
    """Similarity sub-matrix of the first 20 items."""
    w = _content(spark, sf).weights
    first = w.select("doc_id").distinct().orderBy("doc_id").limit(20)
    return similarity.similarity_sample(w, first).select("a", "b", r6("similarity").alias("similarity"))


# ------------------------------------------------------------------ R2-R4

_RESULT = "query_id, rank, item_id, name, genres, score, type, episodes, similarity"


def _reco_sql(where_query: str, min_score: float, keep_self: bool, k: int) -> str:
    cand = f" AND b.doc_id IN (SELECT item_id FROM catalogue WHERE score >= {min_score})" if min_score > 0 else ""
    self_cond = "" if keep_self else " AND a.doc_id <> b.doc_id"
    return CONTENT_CTES.rstrip() + f""",
queries AS ({where_query}),
qs AS (SELECT a.doc_id AS query_id, b.doc_id, sum(a.w * b.w) AS sim, round(sum(a.w * b.w), 9) AS similarity
       FROM weights a JOIN weights b USING (term)
       WHERE a.doc_id IN (SELECT doc_id FROM queries){self_cond}{cand}
       GROUP BY a.doc_id, b.doc_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, doc_id) AS INTEGER) AS rank
           FROM qs WHERE similarity > 0)
SELECT r.query_id, r.rank, c.item_id, c.name, c.genres, c.score, c.type, c.episodes, round(r.sim, 6) AS similarity
FROM ranked r JOIN catalogue c ON c.item_id = r.doc_id WHERE r.rank <= {k}"""


_FIRST_ITEM = "SELECT min(item_id) AS doc_id FROM catalogue"


def _first_item(spark, sf):
    return stages.catalogue(spark, sf).select(F.min("item_id").alias("doc_id"))


def sample_items(cat, n: int = 100, seed: int = 42):
    """n catalogue items in md5(id, seed) order: the same items in every engine."""
    return cat.select("item_id").orderBy(md5_key("item_id", F.lit(str(seed))), "item_id").limit(n) \
        .select(F.col("item_id").alias("doc_id"))


@register("similar_items", _reco_sql(_FIRST_ITEM, 0.0, False, 10))
def similar_items(spark, sf):
    """R2: top-10 similar items of the first catalogue item."""
    return content.recommend_batch(_content(spark, sf), _first_item(spark, sf), 10).select(*_RESULT.split(", "))


@register("similar_items_min_score", _reco_sql(_FIRST_ITEM, 7.0, False, 10))
def similar_items_min_score(spark, sf):
    """R2 with min_score = 7 (filter before the cut, D7)."""
    return content.recommend_batch(_content(spark, sf), _first_item(spark, sf), 10, 7.0).select(*_RESULT.split(", "))


@register("similar_items_keep_self", _reco_sql(_FIRST_ITEM, 0.0, True, 10))
def similar_items_keep_self(spark, sf):
    """The item itself is kept when exclude_same_id is off."""
    return content.recommend_batch(_content(spark, sf), _first_item(spark, sf), 10, 0.0, False) \
        .select(*_RESULT.split(", "))


# The catalogue items that a test user rated best in training.
_BEST_OF_USERS = """SELECT DISTINCT item_id AS doc_id FROM (
  SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, item_id) AS rn FROM train
  WHERE user_id IN (SELECT user_id FROM test)) WHERE rn = 1 AND item_id IN (SELECT item_id FROM catalogue)"""


@register("similar_items_batch", _reco_sql(_BEST_OF_USERS, 0.0, False, 10).replace(
    "queries AS (", ",\n".join([stages.KEEP_LAST_SQL, stages.RATINGS_CLEAN_SQL, stages.SPLIT_SQL]) + ",\nqueries AS (", 1), headline=True)
def similar_items_batch(spark, sf):
    """Top-10 lists for every item that a test user rated best in training."""
    split = stages.ratings_split(spark, sf)
    train, test = collab.train_part(split), collab.test_part(split)
    best = top_k_per_group(train.join(test.select("user_id").distinct(), "user_id", "left_semi"), ["user_id"],
                           [F.col("rating").desc(), F.col("item_id")], 1, salt=SKEW_SALT)
    ids = best.select("item_id").distinct().join(stages.catalogue(spark, sf).select("item_id"), "item_id", "left_semi")
    return content.recommend_batch(_content(spark, sf), ids.select(F.col("item_id").alias("doc_id")), 10).select(*_RESULT.split(", "))


@register("train_content", _reco_sql(_FIRST_ITEM, 0.0, False, 5))
def train_content(spark, sf):
    """Content model fitted, five neighbours of the first item."""
    from ranklight.plans import jobs
    return jobs.train_content(spark, sf).select(*_RESULT.split(", "))


@register("similar_items_overfetch", CONTENT_CTES.rstrip() + f""",
qa AS (SELECT a.doc_id AS query_id, b.doc_id, sum(a.w * b.w) AS sim FROM weights a JOIN weights b USING (term)
       WHERE a.doc_id = ({_FIRST_ITEM}) GROUP BY a.doc_id, b.doc_id),
cut AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(sim, 9) DESC, doc_id) AS r0
                       FROM qa WHERE round(sim, 9) > 0) WHERE r0 <= 50),
kept AS (SELECT * FROM cut WHERE query_id <> doc_id AND doc_id IN (SELECT item_id FROM catalogue WHERE score >= 5.0)),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(sim, 9) DESC, doc_id) AS INTEGER) AS rank
           FROM kept)
SELECT r.query_id, r.rank, c.item_id, c.name, c.genres, c.score, c.type, c.episodes, round(r.sim, 6) AS similarity
FROM ranked r JOIN catalogue c ON c.item_id = r.doc_id WHERE r.rank <= 10""")
def similar_items_overfetch(spark, sf):
    """R2 parity mode (D7): cut to 5 x 10 candidates first, then drop self and score < 5."""
    return content.recommend_batch(_content(spark, sf), _first_item(spark, sf), 10, 5.0, True, overfetch=5) \
        .select(*_RESULT.split(", "))
