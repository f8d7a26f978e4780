"""The reference's own fixtures (FIXTURES.md part A) with stated values."""

import math

import pytest
from pyspark.sql import functions as F

from ranklight.operators import clean, content, hybrid, metrics
from ranklight.operators.similarity import check_metric

# A1: dirty catalogue (duplicate id 3, missing name / score / genres / episodes)
A1 = [(1, "Anime 1", "8.5", "Action, Comedy", "TV", "12", 100000, 0),
      (2, "Anime 2", None, "Drama", "Movie", "1", 50000, 1),
      (3, "Anime 3", "7.2", None, "TV", None, 200000, 2),
      (3, "Anime 3", "7.2", None, "TV", None, 200000, 3),
      (4, None, "6.8", "Romance", "OVA", "6", 10000, 4)]
A1_SCHEMA = "item_id long, name string, score string, genres string, type string, episodes string, members long, src_row long"


def a1(spark):
    return spark.createDataFrame(A1, A1_SCHEMA)


def test_dedup_leaves_four_rows(spark):
    out = clean.remove_duplicates(a1(spark))
    assert out.count() == 4
    assert out.select("item_id").distinct().count() == 4


def test_missing_values(spark):
    out = clean.handle_missing(a1(spark)).collect()
    assert all(r.score is not None for r in out)
    assert all(r.genres is not None for r in out)
    assert all(r.name is not None for r in out)
    # median of (8.5, 7.2, 7.2, 6.8) = 7.2 fills item 2
    assert [r.score for r in out if r.item_id == 2] == [7.2]


def test_outlier_step_removes_rows(spark):
    # A2: Members = 10,000,000 appended to A1; as in the reference the step
    # runs on the raw rows, so the row without a score goes (NaN > 0 fails).
    rows = A1 + [(999, "Outlier", "10.0", "Action", "TV", "1", 10_000_000, 5)]
    df = clean.coerce_numeric(spark.createDataFrame(rows, A1_SCHEMA))
    out = clean.remove_outliers(df)
    assert out.count() < len(rows)
    assert 2 not in {r.item_id for r in out.collect()}


def test_iqr_bounds_exact(spark):
    # Linear quartiles of (1, 2, 3, 4, 100): Q1 = 2, Q3 = 4, bounds [-4, 10]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([1, 2, 3, 4, 100])], "item_id long, members double")
    kept = sorted(r.members for r in clean.iqr_filter(df, "members", 3.0).collect())
    assert kept == [1.0, 2.0, 3.0, 4.0]


def test_clean_ratings(spark):
    # A3: unknown item 999, rating 0 (watching), rating -1 (invalid)
    r = spark.createDataFrame([(1, 1, 8), (1, 999, 7), (2, 2, 0), (2, 3, -1), (3, 3, 9)],
                              "user_id long, item_id long, rating long").withColumn("seq", F.monotonically_increasing_id())
    cat = spark.createDataFrame([(1,), (2,), (3,)], "item_id long")
    out = clean.clean_ratings(r, cat).select("user_id", "item_id", "rating").collect()
    assert sorted(tuple(x) for x in out) == [(1, 1, 8), (2, 2, 0), (3, 3, 9)]


def test_keep_last(spark):
    r = spark.createDataFrame([(1, 1, 5.0, 1), (1, 1, 9.0, 2), (1, 2, 3.0, 1)],
                              "user_id long, item_id long, rating double, event_ts long")
    out = sorted(tuple(x) for x in clean.ratings_keep_last(r, ("event_ts",)).select("user_id", "item_id", "rating").collect())
    assert out == [(1, 1, 9.0), (1, 2, 3.0)]


# Ranked lists
def _a14(spark):
    ranked = spark.createDataFrame([(1, i, i) for i in range(1, 6)], "user_id long, item_id long, rank int")
    relevant = spark.createDataFrame([(1, i) for i in (2, 4, 6, 8)], "user_id long, item_id long")
    return ranked, relevant


def test_precision_recall_f1_ap_hit(spark):
    ranked, relevant = _a14(spark)
    r = metrics.per_user_at_k(ranked, relevant, (5,)).collect()[0]
    assert r.precision == pytest.approx(0.4)
    assert r.recall == pytest.approx(0.5)
    assert r.f1 == pytest.approx(2 * 0.4 * 0.5 / 0.9)
    assert r.ap == pytest.approx(0.25)
    assert r.hit == 1.0


def test_ndcg_hand_value(spark):
    ranked, relevant = _a14(spark)
    got = metrics.ndcg_at_k(ranked, relevant, 5).collect()[0].ndcg
    want = (1 / math.log2(3) + 1 / math.log2(5)) / sum(1 / math.log2(i + 1) for i in range(1, 5))
    assert got == pytest.approx(want, abs=1e-6)


def test_rmse_zero_for_equal_vectors(spark):
    # A13 last pair
    df = spark.createDataFrame([(5.0, 5.0)] * 3, "rating double, prediction double")
    r = metrics.rating_errors(df).collect()[0]
    assert r.rmse == 0 and r.mae == 0


def test_rmse_mae_values(spark):
    df = spark.createDataFrame([(3.0, 2.5), (4.0, 4.0), (5.0, 6.0)], "rating double, prediction double")
    r = metrics.rating_errors(df).collect()[0]
    assert r.rmse == pytest.approx(math.sqrt((0.25 + 0 + 1) / 3), abs=1e-6)
    assert r.mae == pytest.approx(0.5, abs=1e-6)


CONTENT_SCHEMA = "item_id long, name string, genres string, type string, score double, episodes double, studios string, source string, rating string"


def test_single_item_has_no_neighbours(spark):
    # A11
    cat = spark.createDataFrame([(1, "Anime 1", "Action", "TV", 8.0, 12.0, "Studio A", "Manga", "PG-13")], CONTENT_SCHEMA)
    m = content.fit(cat)
    assert content.recommend(m, 1, 5).count() == 0


def test_unknown_id_gives_empty(spark):
    # A12
    cat = spark.createDataFrame([(i, f"Anime {i}", "Action", "TV", 8.0, 12.0, "Studio A", "Manga", "PG-13")
                                 for i in (1, 2, 3)], CONTENT_SCHEMA)
    m = content.fit(cat)
    assert content.recommend(m, 999, 5).count() == 0
    assert content.recommend(m, 1, 5).count() == 2


def test_ties_break_by_id(spark):
    # 5 Action + 5 Drama, everything else equal: massive ties
    rows = [(i, f"A{i}", "Action" if i <= 5 else "Drama", "TV", 7.0, 12.0, "S", "Manga", "PG-13") for i in range(1, 11)]
    m = content.fit(spark.createDataFrame(rows, CONTENT_SCHEMA))
    got = [r.item_id for r in content.recommend(m, 1, 9).orderBy("rank").collect()]
    assert got[:4] == [2, 3, 4, 5]
    assert got[4:] == [6, 7, 8, 9, 10]
    sims = [r.similarity for r in content.recommend(m, 1, 9).orderBy("rank").collect()]
    assert sims == sorted(sims, reverse=True)


def test_min_score_filter_before_cut(spark):
    rows = [(i, f"A{i}", "Action", "TV", float(i), 12.0, "S", "Manga", "PG-13") for i in range(1, 11)]
    m = content.fit(spark.createDataFrame(rows, CONTENT_SCHEMA))
    out = content.recommend(m, 1, 3, min_score=8.0).collect()
    assert len(out) == 3 and all(r.score >= 8.0 for r in out)


def test_errors_raise():
    with pytest.raises(ValueError):
        check_metric("manhattan")
    with pytest.raises(ValueError):
        hybrid.hybrid_weights(0.0, 0.0)
    with pytest.raises(ValueError):
        hybrid.recommend("nope", None, None, 1, None)
    from ranklight.operators import collab
    with pytest.raises(ValueError):
        collab.fit_factors(None, "KNN")


def test_hybrid_weights_normalised():
    assert hybrid.hybrid_weights(2, 3) == pytest.approx((0.4, 0.6))
    assert hybrid.reweight(0.3) == pytest.approx((0.3, 0.7))


def test_overfetch_parity_may_return_fewer(spark):
    # 5 Action items with low scores, 5 Drama items with high scores: with the
    # reference's cut (5 x top_n candidates, then the score filter) the list of
    # item 1 keeps only the high-score Action... none; fixed order finds Drama.
    rows = [(i, f"A{i}", "Action" if i <= 5 else "Drama", "TV", 5.0 if i <= 5 else 9.0, 12.0, "S", "Manga", "PG-13")
            for i in range(1, 11)]
    m = content.fit(spark.createDataFrame(rows, CONTENT_SCHEMA))
    fixed = content.recommend(m, 1, 1, min_score=8.0).collect()
    parity = content.recommend(m, 1, 1, min_score=8.0, overfetch=1).collect()
    assert len(fixed) == 1 and fixed[0].score == 9.0
    assert len(parity) == 0


def test_zero_fill_tops_up_with_lowest_ids(spark):
    rows = [(1, "A1", "Action", "TV", 8.0, 12.0, "S", "Manga", "PG"),
            (2, "A2", "Action", "TV", 8.0, 12.0, "S", "Manga", "PG"),
            (3, "B3", "Zzz", "Movie", 8.0, 1.0, "Q", "Novel", "R"),
            (4, "B4", "Yyy", "Special", 8.0, 1.0, "P", "Game", "G")]
    m = content.fit(spark.createDataFrame(rows, CONTENT_SCHEMA))
    plain = [r.item_id for r in content.recommend(m, 1, 3).orderBy("rank").collect()]
    filled = [(r.item_id, r.similarity) for r in content.recommend(m, 1, 3, zero_fill=True).orderBy("rank").collect()]
    assert plain == [2]
    assert [i for i, _ in filled] == [2, 3, 4] and filled[1][1] == 0.0 and filled[2][1] == 0.0
    assert content.recommend(m, 999, 3, zero_fill=True).count() == 0
