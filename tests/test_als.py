"""Alternating least squares in large blocks against Spark ML's own."""

import numpy as np
import pytest
from pyspark.ml.recommendation import ALS

from ranklight.operators import als, collab


def _ratings(spark, n_users=70, n_items=50, seed=3):
    rng = np.random.default_rng(seed)
    rows = [(u, i, float(rng.normal())) for u in range(n_users) for i in range(n_items) if rng.random() < (0.9 if u % 9 == 0 or i == 7 else 0.08)]
    return spark.createDataFrame(rows + rows[:5], "u int, i int, r double")  # some pairs twice


def _factors(df):
    return {r.id: np.array(r.features) for r in df.collect()}


@pytest.mark.parametrize("cells", [als.CELLS, 40])
def test_same_factors_as_spark_ml(spark, monkeypatch, cells):
    """Rows of fewer and of more ratings than the rank, summed whole and in parts."""
    from pyspark import cloudpickle
    monkeypatch.setattr(als, "CELLS", cells)
    cloudpickle.register_pickle_by_value(als)
    try:
        rows = _ratings(spark)
        got = als.fit(rows, "u", "i", "r", 6, 4, 0.1, 42)
    finally:
        cloudpickle.unregister_pickle_by_value(als)
    want = ALS(userCol="u", itemCol="i", ratingCol="r", rank=6, maxIter=4, regParam=0.1, seed=42, coldStartStrategy="nan").fit(rows)
    for name in ("userFactors", "itemFactors"):
        a, b = _factors(getattr(got, name)), _factors(getattr(want, name))
        assert a.keys() == b.keys()
        assert all(np.allclose(a[k], b[k], atol=1e-5) for k in a)
    assert got.getColdStartStrategy() == "nan" and got.rank == 6


def test_pieces_mapped_factors_and_checkpoints_change_nothing(spark, monkeypatch):
    """Ratings in several pieces, factors in a file, users' factors cut from their lineage."""
    from pyspark import cloudpickle
    rows = _ratings(spark)
    want = als.fit(rows, "u", "i", "r", 6, 3, 0.1, 42)
    for name, value in (("PIECE", 100), ("MAPPED", 0), ("CUT", 1)):
        monkeypatch.setattr(als, name, value)
    cloudpickle.register_pickle_by_value(als)
    try:
        got = als.fit(rows, "u", "i", "r", 6, 3, 0.1, 42)
    finally:
        cloudpickle.unregister_pickle_by_value(als)
    for name in ("userFactors", "itemFactors"):
        a, b = _factors(getattr(got, name)), _factors(getattr(want, name))
        assert a.keys() == b.keys() and all(np.array_equal(a[k], b[k]) for k in a)


def test_no_step_leaves_shuffle_files(spark, monkeypatch):
    """What the steps and the links shuffled is gone when the fit ends."""
    dealt, inner = [], als._drop_shuffle
    monkeypatch.setattr(als, "_drop_shuffle", lambda rdd: dealt.append(rdd) or inner(rdd))
    als.fit(_ratings(spark), "u", "i", "r", 4, 3, 0.1, 42)
    assert len(dealt) == 2 + 1 + 2 * 3  # links of both sides, the start, every step
    tracker = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    for rdd in dealt:
        link = rdd._jrdd.rdd().dependencies().head()
        while link.getClass().getSimpleName() != "ShuffleDependency":
            link = link.rdd().dependencies().head()
        # Registered anew by later jobs that stop at kept blocks, but without any output.
        assert not tracker.containsShuffle(link.shuffleId()) or tracker.getNumAvailableOutputs(link.shuffleId()) == 0


def test_factors_travel_once_a_block(spark, monkeypatch):
    """fit_factors runs its steps in BLOCKS blocks, not in Spark ML's ten."""
    seen = []
    inner = als.fit
    monkeypatch.setattr(als, "fit", lambda *a: seen.append(a) or inner(*a))
    rows = _ratings(spark).selectExpr("cast(u as long) user_id", "cast(i as long) item_id", "5 + r as rating")
    collab.fit_factors(rows, "SVD", 3, 2, 0.1)
    collab.fit_fold_factors(rows.distinct(), 3, "SVD", 3, 2, 0.1)
    assert len(seen) == 2 and als.BLOCKS < 10
