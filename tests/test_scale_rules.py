"""Rules that hold at any size: exact samples, distributed percentiles, split
hot keys, trained models that recommend."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ranklight.functions.percentiles import exact_percentiles
from ranklight.operators import clean, collab, hybrid
from ranklight.plans import stages
from tests.conftest import SF_SMALL
from tests.test_learned import _planted


@pytest.mark.parametrize("n", [1, 5000])
def test_sample_n_of_20_million_rows(spark, n):
    df = spark.range(20_000_000).select(F.col("id").alias("user_id"), (F.col("id") % 97).alias("item_id"))
    got = clean.sample_n(df, n, seed=7)
    rows = [(r.user_id, r.item_id) for r in got.collect()]
    assert len(rows) == len(set(rows)) == n


def test_sample_n_is_the_hash_order(spark):
    df = spark.range(3000).select(F.col("id").alias("user_id"), F.lit(1).alias("item_id"))
    want = [r.user_id for r in df.orderBy(clean.md5_key("user_id", "item_id", F.lit("42")), "user_id").limit(40).collect()]
    assert sorted(r.user_id for r in clean.sample_n(df, 40).collect()) == sorted(want)


def test_sample_n_of_equal_keys(spark):
    """All rows in one hash: the cut keeps none or all, the sample is whole."""
    df = spark.range(50_000).select(F.lit(1).alias("user_id"), F.lit(2).alias("item_id"))
    assert clean.sample_n(df, 10).count() == 10
    assert clean.sample_n(df, 60_000).count() == 50_000


@pytest.mark.parametrize("seed", range(3))
def test_percentiles_equal_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(0, 9, 500).astype(float), rng.normal(size=500)
    rows = [(float(x), None if i % 7 == 0 else float(y), None) for i, (x, y) in enumerate(zip(a, b, strict=True))]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(7)
    ps = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {r.column: r.q for r in exact_percentiles(df, ["a", "b", "c"], ps).collect()}
    assert got["a"] == pytest.approx(np.quantile(a, ps).tolist())
    assert got["b"] == pytest.approx(np.quantile([r[1] for r in rows if r[1] is not None], ps).tolist())
    assert got["c"] == [None] * len(ps)


def test_stage_tables_are_not_dealt_by_a_key(spark):
    plan = stages.ratings_clean(spark, SF_SMALL)._jdf.queryExecution().toString()
    assert "hashpartitioning(user_id" not in plan


def test_factor_model_recommends(spark):
    train = _planted(spark, 20, 25)
    fm = collab.fit_factors(train, "SVD", rank=3, max_iter=5, reg=0.1)
    cat = spark.createDataFrame([(i, f"n{i}", "g", 5.0 + i % 4, "TV", 1.0) for i in range(25)],
                                "item_id long, name string, genres string, score double, type string, episodes double")
    user = 3
    seen = {r.item_id for r in train.where(f"user_id = {user}").collect()}
    pairs = spark.createDataFrame([(user, i) for i in range(25) if i not in seen and 5.0 + i % 4 >= 6.0], "user_id long, item_id long")
    want = sorted(((-round(r.raw_prediction, 9), r.item_id) for r in collab.predict_factors(fm, pairs).collect()))[:5]
    got = collab.recommend_user(fm, train, cat, user, 5, 6.0).orderBy("rank").collect()
    assert [r.item_id for r in got] == [i for _, i in want]
    every = collab.recommend_all(fm, train, cat, spark.createDataFrame([(user,)], "user_id long"), 5, 6.0)
    assert [r.item_id for r in every.orderBy("rank").collect()] == [r.item_id for r in got]
    cold = collab.recommend_user(fm, train, cat, 999, 5, 6.0).count()
    assert cold == 5


def test_hybrid_takes_the_factor_model(spark):
    cat = stages.catalogue(spark, SF_SMALL)
    train = collab.train_part(stages.ratings_split(spark, SF_SMALL))
    fm = collab.fit_factors(train, "SVD", rank=4, max_iter=3, reg=0.1)
    cf = hybrid.CFSide(fm, train, cat)
    user = train.groupBy("user_id").count().orderBy(F.desc("count"), "user_id").first().user_id
    item = cat.select(F.min("item_id")).first()[0]
    cb = stages.content_model(spark, SF_SMALL)
    want = {r.item_id for r in cf.recommend(user, 10, 0.0).collect()}
    assert {r.item_id for r in hybrid.switching(cb, cf, None, user, 10).collect()} == want
    assert hybrid.weighted(cb, cf, item, user, 10).count() == 10
    assert {r.item_id for r in hybrid.mixed(None, cf, None, user, 10).collect()} <= {r.item_id for r in cf.recommend(user, 10, 0.0).collect()}


def test_a_cluster_without_a_shared_folder_is_refused(monkeypatch):
    from ranklight import session

    class Conf:
        def get(self, *a):
            return None

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def _keys_of_exchanges(df):
    import re
    return re.findall(r"hashpartitioning\(([^)]*)", df._jdf.queryExecution().executedPlan().toString())


def test_terms_are_counted_where_the_document_lies(spark):
    """no shuffle of (document, term) rows."""
    from ranklight.operators import tfidf
    docs = spark.createDataFrame([(1, "red fox red fox"), (1, "red hen"), (None, "red"), (2, None)], "doc_id long, text string")
    counts = tfidf.term_counts(tfidf.ngram_terms(tfidf.by_document(tfidf.tokenize(docs, "doc_id", "text"))))
    assert not any("term" in k for k in _keys_of_exchanges(counts))
    got = sorted((r.doc_id or 0, r.term, r.tf) for r in counts.collect())
    assert got == [(0, "red", 1), (1, "fox", 2), (1, "fox red", 1), (1, "hen", 1), (1, "red", 3), (1, "red fox", 2), (1, "red hen", 1)]


def test_diversity_shuffles_vectors_not_terms(spark):
    """A vector travels as one row per user and item."""
    from ranklight.operators import metrics
    r = 0.5 ** 0.5
    vectors = spark.createDataFrame([(1, "a", 1.0), (2, "a", r), (2, "b", r), (3, "b", 1.0)], "item_id long, term string, w double")
    members = spark.createDataFrame([(7, 1, "x"), (7, 2, "x"), (7, 3, "y"), (7, 9, "y"), (7, 1, "y"), (8, 9, "x")], "user_id long, item_id long, tag string")
    out = metrics.list_squares(members, vectors)
    assert not any(k.split("#")[0] in ("term", "t") or " t#" in k for k in _keys_of_exchanges(out))
    got = {(x.user_id, x.tag): (x.n, round(x.square, 9)) for x in out.collect()}
    assert got == {(7, "x"): (2, round((1 + r) ** 2 + 0.5, 9)), (7, "y"): (2, 2.0)}
