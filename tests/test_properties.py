"""Property tests: list invariants of recommendations, and the ranking
metrics against a direct computation of their formulas on random lists."""

import math
import random

import pytest
from pyspark.sql import functions as F

from ranklight.operators import content, metrics
from ranklight.plans import stages
from tests.conftest import SF_SMALL


def test_content_lists_are_clean(spark):
    cb = stages.content_model(spark, SF_SMALL)
    cat = stages.catalogue(spark, SF_SMALL)
    q = cat.select(F.col("item_id").alias("doc_id")).orderBy("doc_id").limit(25)
    lists = content.recommend_batch(cb, q, 8, min_score=5.0).collect()
    by_q = {}
    for r in lists:
        by_q.setdefault(r.query_id, []).append(r)
    for qid, rows in by_q.items():
        rows.sort(key=lambda r: r.rank)
        assert [r.rank for r in rows] == list(range(1, len(rows) + 1))
        assert len({r.item_id for r in rows}) == len(rows)          # no duplicates
        assert all(r.item_id != qid for r in rows)                  # not itself
        assert all(r.score >= 5.0 for r in rows)                    # min score
        sims = [r.similarity for r in rows]
        assert sims == sorted(sims, reverse=True) and all(s > 0 for s in sims)


def _direct(lists, relevant, k):
    """The formulas written out per list (brute force)."""
    out = []
    for u, rec in lists.items():
        rel = relevant.get(u, set())
        top = rec[:k]
        hits = [1 if i in rel else 0 for i in top]
        p = sum(hits) / k
        r = sum(hits) / len(rel) if rel else 0.0
        f1 = 2 * p * r / (p + r) if p + r > 0 else 0.0
        ap, seen = 0.0, 0
        for pos, h in enumerate(hits, 1):
            if h:
                seen += 1
                ap += seen / pos
        ap = ap / min(len(rel), k) if rel and seen else 0.0
        out.append((p, r, f1, ap, 1.0 if sum(hits) else 0.0))
    n = len(out)
    return [sum(x[i] for x in out) / n for i in range(5)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_ranking_metrics_match_direct_formulas(spark, seed):
    rnd = random.Random(seed)
    lists, relevant = {}, {}
    for u in range(40):
        items = rnd.sample(range(60), rnd.randint(1, 15))
        lists[u] = items
        if rnd.random() < 0.8:
            relevant[u] = set(rnd.sample(range(60), rnd.randint(1, 12)))
    ranked = spark.createDataFrame([(u, i, pos) for u, rec in lists.items() for pos, i in enumerate(rec, 1)],
                                   "user_id long, item_id long, rank int")
    rel = spark.createDataFrame([(u, i) for u, s in relevant.items() for i in s], "user_id long, item_id long")
    got = {r.k: r for r in metrics.ranking_metrics(ranked, rel, (5, 10)).collect()}
    for k in (5, 10):
        p, r, f1, ap, hr = _direct(lists, relevant, k)
        g = got[k]
        assert g.precision == pytest.approx(p, abs=1e-6)
        assert g.recall == pytest.approx(r, abs=1e-6)
        assert g.f1_macro == pytest.approx(f1, abs=1e-6)
        assert g.map == pytest.approx(ap, abs=1e-6)
        assert g.hit_rate == pytest.approx(hr, abs=1e-6)
        assert g.users == len(lists)


def test_ndcg_graded_matches_direct(spark):
    rnd = random.Random(7)
    rows, rel_rows, want = [], [], []
    for u in range(30):
        rec = rnd.sample(range(50), 10)
        rel = {i: float(rnd.randint(1, 3)) for i in rnd.sample(range(50), rnd.randint(0, 15))}
        rows += [(u, i, p) for p, i in enumerate(rec, 1)]
        rel_rows += [(u, i, g) for i, g in rel.items()]
        dcg = sum((2 ** rel.get(i, 0.0) - 1) / math.log2(p + 1) for p, i in enumerate(rec[:10], 1))
        ideal = sorted(rel.values(), reverse=True)[:10]
        idcg = sum((2 ** g - 1) / math.log2(p + 1) for p, g in enumerate(ideal, 1))
        want.append(dcg / idcg if idcg > 0 else 0.0)
    ranked = spark.createDataFrame(rows, "user_id long, item_id long, rank int")
    relevant = spark.createDataFrame(rel_rows, "user_id long, item_id long, relevance double")
    got = metrics.ndcg_at_k(ranked, relevant, 10).first()
    assert got.ndcg == pytest.approx(sum(want) / len(want), abs=1e-6)
