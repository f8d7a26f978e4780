"""Top-k by blocks and bounds against all pairs in numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ranklight.operators import blocktopk, similarity


def _brute(ids, scores, k, cand, queries, exclude_self, least):
    out = {}
    for i, q in enumerate(ids):
        if q in queries:
            rows = [(-round(scores[i, j], 9), c) for j, c in enumerate(ids) if c in cand and not (exclude_self and c == q)]
            out[q] = [(c, -s) for s, c in sorted(r for r in rows if -r[0] >= least)[:k]]
    return out


def _same(got, want):
    lists = {}
    for r in sorted(got, key=lambda r: (r[0], r[3])):
        lists.setdefault(r[0], []).append((r[1], round(r[2], 9)))
    assert lists.keys() == {q for q, v in want.items() if v}
    for q, v in lists.items():
        assert [c for c, _ in v] == [c for c, _ in want[q]], q
        assert np.allclose([s for _, s in v], [s for _, s in want[q]], atol=2e-9)


def _sparse(rng, n):
    m = np.zeros((n, 60))
    for i in range(n):
        base = rng.integers(0, 12) * 5
        at = np.unique(np.concatenate([base + rng.integers(0, 5, 3), rng.integers(0, 60, rng.integers(0, 5))]))
        m[i, at] = rng.random(len(at)) + (at // 5 == base // 5) * 2
    m[rng.integers(0, n, n // 5)] = m[0]
    return m / np.sqrt((m * m).sum(1, keepdims=True))


def _long(spark, ids, m):
    return spark.createDataFrame([(int(ids[i]), f"t{j}", float(m[i, j])) for i, j in zip(*np.nonzero(m), strict=True)], "doc_id long, term string, w double")


@pytest.fixture(autouse=True)
def small_blocks(monkeypatch):
    """Many blocks and chunks; the tasks get the module with these values."""
    from pyspark import cloudpickle
    monkeypatch.setattr(blocktopk, "BLOCK", 16)
    monkeypatch.setattr(blocktopk, "CHUNK", 4)
    cloudpickle.register_pickle_by_value(blocktopk)
    yield
    cloudpickle.unregister_pickle_by_value(blocktopk)


@pytest.mark.parametrize("k,exclude_self", [(5, True), (1, False), (40, True)])
def test_sparse_all_items(spark, k, exclude_self):
    rng = np.random.default_rng(k)
    m = _sparse(rng, 250)
    ids = rng.permutation(1000)[:250]
    got = similarity.all_pairs_top_k(_long(spark, ids, m), k, exclude_self).collect()
    _same(got, _brute(ids.tolist(), m @ m.T, k, set(ids.tolist()), set(ids.tolist()), exclude_self, 1e-9))


def test_sparse_some_queries_and_candidates(spark):
    rng = np.random.default_rng(7)
    m = _sparse(rng, 200)
    ids = np.arange(200)
    cand, asked = {i for i in range(200) if i % 3}, {0, 3, 4, 77, 150, 199}
    one = lambda s: spark.createDataFrame([(i,) for i in s], "doc_id long")
    got = similarity.neighbours(_long(spark, ids, m), one(asked | {5000}), 7, True, one(cand)).collect()
    want = _brute(ids.tolist(), m @ m.T, 7, cand, asked, True, 1e-9)
    _same(got, want)
    for q in asked:
        item = similarity.neighbours_of_item(_long(spark, ids, m), one({q}), 7, True, one(cand)).collect()
        _same(item, {q: want[q]})


@pytest.mark.parametrize("metric", ["euclidean", "cosine_eps", "cosine"])
def test_dense(spark, metric):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(9, 8)) * 5
    m = centres[rng.integers(0, 9, 220)] + rng.normal(size=(220, 8)) * 0.3
    m[5] = 0
    m[50:70] = m[4]
    m[100] = 0
    df = spark.createDataFrame([(i, m[i].tolist()) for i in range(220)] + [(999, None)], "id long, v array<double>")
    got = similarity.vector_top_k(df, "id", "v", 6, metric).collect()
    n = np.sqrt((m * m).sum(1))
    d = np.sqrt(np.maximum(((m[:, None] - m[None]) ** 2).sum(2), 0))
    s = 1 / (1 + d) if metric == "euclidean" else m @ m.T / (n[:, None] * n[None] + 1e-10)
    want = _brute(list(range(220)), s, 6, set(range(220)), set(range(220)), True, -9)
    # Distances of equal vectors come out of squares with noise: compare scores, then ids where they differ.
    lists = {}
    for r in got:
        lists.setdefault(r.doc_id, []).append((r.rank, r.other, r.similarity))
    for q, v in want.items():
        mine = sorted(lists[q])
        assert len(mine) == 6 and np.allclose([x[2] for x in mine], [s for _, s in v], atol=1e-6)
        if metric != "euclidean":
            assert [x[1] for x in mine] == [c for c, _ in v]


def test_queries_reach_few_blocks(spark):
    """On rows in groups, most blocks are ruled out."""
    rng = np.random.default_rng(1)
    m = np.zeros((600, 400))
    for i in range(600):
        m[i, (i // 20) * 10 + rng.permutation(10)[:5]] = rng.random(5) + 1
    m /= np.sqrt((m * m).sum(1, keepdims=True))
    rows = blocktopk.sparse_rows(_long(spark, np.arange(600), m))
    blocks = blocktopk.build_blocks(rows, blocktopk.Sparse(), 6, None, similarity._blocks_path(spark))
    n = blocks.count()
    met = blocktopk.surviving_pairs(blocks, blocktopk.Sparse()).select(F.sum(F.size("q_rep"))).first()[0]
    assert n >= 37 and met < 0.15 * 600 * n


def test_empty_and_single(spark):
    empty = spark.createDataFrame([], "doc_id long, term string, w double")
    assert similarity.all_pairs_top_k(empty, 5).count() == 0
    one = spark.createDataFrame([(1, "a", 1.0)], "doc_id long, term string, w double")
    assert similarity.all_pairs_top_k(one, 5).count() == 0
    assert [tuple(r) for r in similarity.all_pairs_top_k(one, 5, False).collect()] == [(1, 1, 1.0, 1)]
    none = spark.createDataFrame([], "id long, v array<double>")
    assert similarity.vector_top_k(none, "id", "v", 5, "euclidean").count() == 0


def test_queries_travel_once_a_group(spark):
    """Without likeness every query needs every block, yet it is sent to each group of blocks only."""
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(300, 32)))], "id long, v array<double>")
    kind = blocktopk.Dense("cosine_eps")
    blocks = blocktopk.build_blocks(blocktopk.dense_rows(df, "id", "v", "cosine_eps"), kind, 6, None, similarity._blocks_path(spark))
    sent = blocktopk.surviving_pairs(blocks, kind).select(F.sum(F.size("q_rep"))).first()[0]
    assert sent <= 300 * -(-blocks.count() // blocktopk.CHUNK)
