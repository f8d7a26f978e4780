"""What travels: fields, vectors and blocks that a step does not need stay where they lie."""

import uuid

import numpy as np
from pyspark.sql import functions as F

from ranklight.operators import clean, collab, hybrid, pairselect, similarity
from ranklight.session import stage_path


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_last_carries_every_column_once(spark):
    """one struct a row; ties in time go on to the next order columns, nulls come first."""
    log = spark.createDataFrame(
        [(1, 1, 5.0, 10, 1, 1), (1, 1, 6.0, 10, 2, 1), (1, 1, 7.0, None, 9, 9), (1, 2, 3.0, 4, 1, 1), (None, 2, 1.0, 1, 1, 1),
         (None, 2, 2.0, 2, 1, 1), (1, 2, 3.0, 4, 1, 1)],
        "user_id long, item_id long, rating double, event_ts long, l_orderkey long, l_linenumber long")
    out = clean.ratings_keep_last(log)
    assert out.columns == log.columns and "max_by" not in _plan(out)
    got = sorted(((r.user_id or 0), r.item_id, r.rating, r.l_orderkey) for r in out.collect())
    assert got == [(0, 2, 2.0, 1), (1, 1, 6.0, 2), (1, 2, 3.0, 1)]


def test_sample_reads_its_rows_once(spark, monkeypatch):
    """what is counted, cut and numbered is built once."""
    kept, real = [], clean._kept
    monkeypatch.setattr(clean, "_kept", lambda df, name: kept.append(name) or real(df, name))
    r = spark.range(400).select((F.col("id") % 20).alias("user_id"), F.floor(F.col("id") / 20).alias("item_id"), F.lit(3.0).alias("rating"))
    assert clean.sample_ratings(r, 50, 5, 10).count() == 50 and kept == ["counted"]


def test_pairs_travel_as_whole_vectors(spark):
    """no shuffle by term; repeated entries of a term add up, pairs without a shared term have no row."""
    w = spark.createDataFrame([(1, "a", 0.6), (1, "b", 0.8), (2, "b", 0.5), (2, "b", 0.5), (3, "c", 1.0), (4, None, 1.0)],
                              "doc_id long, term string, w double")
    pairs = spark.createDataFrame([(1, 2), (1, 2), (1, 3), (2, 2), (4, 4), (None, 1), (1, 9)], "a long, b long")
    out = similarity.pair_similarity(w, pairs)
    assert "term" not in " ".join(x.split("(", 1)[1] for x in _plan(out).splitlines() if "hashpartitioning" in x)
    assert sorted((r.a, r.b, round(r.similarity, 9)) for r in out.collect()) == [(1, 2, 0.8), (2, 2, 1.0)]


def test_one_item_and_one_user_go_to_the_rows(spark):
    """the postings and the items are not dealt by the one item's terms or the one user's id."""
    w = spark.createDataFrame([(1, "a", 1.0), (2, "a", 0.6), (2, "b", 0.8), (3, "b", 1.0)], "doc_id long, term string, w double")
    near = similarity.neighbours_of_item(w, spark.range(1).select(F.lit(1).cast("long").alias("doc_id")), 5)
    assert "hashpartitioning(term" not in _plan(near)
    assert [(r.doc_id, r.similarity) for r in near.collect()] == [(2, 0.6)]
    model = collab.Baseline(spark.createDataFrame([(5.0,)], "mu double"), spark.createDataFrame([(1, 1.0), (2, 0.5)], "item_id long, b_i double"),
                            spark.createDataFrame([(7, 0.25), (8, 3.0)], "user_id long, b_u double"))
    cat = spark.createDataFrame([(1, 7.0), (2, 7.0), (3, 7.0)], "item_id long, score double")
    seen = spark.createDataFrame([(7, 1)], "user_id long, item_id long")
    got = collab.recommend_user(model, seen, cat, 7, 5, 0.0)
    assert "hashpartitioning(user_id" not in _plan(got)
    assert [(r.item_id, r.prediction) for r in got.orderBy("rank").collect()] == [(2, 5.75), (3, 5.25)]
    assert collab.recommend_user(model, seen, cat, 99, 5, 0.0).orderBy("rank").first().prediction == 6.0


def test_reweight_finds_both_lists_once(spark, monkeypatch):
    """three weights, one search of either side."""
    from ranklight.plans import hybrid_q
    from tests.conftest import SF_SMALL
    calls, real = [], hybrid.scored
    monkeypatch.setattr(hybrid, "scored", lambda *a: calls.append(1) or real(*a))
    assert hybrid_q.hybrid_reweight(spark, SF_SMALL).groupBy("content_weight").count().count() == 3 and len(calls) == 1


def test_blocks_travel_in_groups(spark, monkeypatch):
    """at most GROUPS copies of a block travel, and every pair is met once."""
    from pyspark import cloudpickle
    monkeypatch.setattr(pairselect, "BLOCK", 4)
    monkeypatch.setattr(pairselect, "GROUPS", 3)
    cloudpickle.register_pickle_by_value(pairselect)
    try:
        m = np.random.default_rng(5).random((50, 6))
        m /= np.sqrt((m * m).sum(1, keepdims=True))
        w = spark.createDataFrame([(i, f"t{j}", float(m[i, j])) for i in range(50) for j in range(6)], "doc_id long, term string, w double")
        value, n = pairselect.pair_percentile(w, 75, path := stage_path(spark, f"pairs-{uuid.uuid4().hex[:8]}"))
        assert n == 1225 and abs(value - np.percentile((m @ m.T)[np.triu_indices(50, 1)], 75)) < 1e-12
        products = pairselect._products_of(spark.read.parquet(path))
        assert products.count() == 6 and products.select(F.sum(F.size("blocks"))).first()[0] <= 3 * 13
    finally:
        cloudpickle.unregister_pickle_by_value(pairselect)
