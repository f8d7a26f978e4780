"""MinHash near-duplicates against all pairs; sketches and components."""

import random

import numpy as np
import pytest

from ranklight.llm import components, neardup as nd


def _set(text, k):
    w = [x for x in (text or "").encode().lower().split()]
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def _brute(rows, k, percent=80):
    sets = [_set(t, k) for _, t in rows]
    comp = list(range(len(rows)))

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                comp[max(a, b)] = min(a, b)
    return [(rows[i][0], len(sets[i]), rows[find(i)][0]) for i in range(len(rows))]


def _corpus(rng):
    words = [f"w{i}" for i in range(60)]
    base = [rng.choice(words) for _ in range(80)]
    texts = []
    for _ in range(120):  # copies that drift: links near the threshold
        t = list(base)
        for _ in range(rng.randint(0, 9)):
            t[rng.randrange(len(t))] = rng.choice(words)
        texts.append(" ".join(t))
    texts += [" ".join(rng.choice(words) for _ in range(rng.randint(0, 60))) for _ in range(60)]
    for t in list(texts[120:150]):
        w = t.split()
        texts.append(" ".join(w[:int(len(w) * rng.choice([.75, .8, .85, .9, 1.0]))]))
    texts += [None, "", " \n", "One", "ONE", "one\ttwo", "one  TWO", "é É", "a b c", "x " * 4000, "x " * 4001 + "y"]
    return list(enumerate(texts))


@pytest.mark.parametrize("seed,k", [(0, 2), (1, 2), (2, 5)])
def test_equals_all_pairs(spark, docs, seed, k):
    rows = _corpus(random.Random(seed))
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in nd.near_duplicates(docs(rows), shingle_words=k).collect())
    assert got == sorted(_brute(rows, k))


def test_repeated_rows_null_ids_and_empty_table(spark, docs):
    rows = [(5, "a b c d"), (5, "a b c d"), (None, "A B C D"), (2, "other words here"), (None, None)]
    got = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in nd.near_duplicates(docs(rows), shingle_words=2).collect())
    assert got == [(0, 0, False), (0, 5, False), (2, 2, True), (5, 5, True), (5, 5, True)]
    assert nd.near_duplicates(docs([])).count() == 0


def test_sketches_estimate_and_fill():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    for size, shared in ((1, 1), (5, 4), (40, 30), (1500, 1300)):
        a, b = np.unique(pool[:size]), np.unique(np.r_[pool[:shared], pool[2000:2000 + size - shared]])
        s = nd.sketches([a, b, np.zeros(0, np.uint64)], 512)
        assert (s[:2] != nd._EMPTY).all() and (s[2] == nd._EMPTY).all()
        want = shared / (2 * size - shared)
        assert abs((s[0] == s[1]).mean() - want) < 0.08
        assert np.array_equal(s[0], nd.sketches([a], 512)[0])


def test_banding_finds_pairs_at_the_threshold():
    rng = np.random.default_rng(1)
    missed = 0
    for _ in range(400):
        pool = rng.integers(0, 2**63, 110, dtype=np.uint64)
        a, b = np.unique(pool[:100]), np.unique(np.r_[pool[:89], pool[100:]])  # 89 of 111
        k = nd.band_keys(nd.sketches([a, b], nd.BANDS * nd.ROWS), nd.BANDS, nd.ROWS)
        missed += not (k[0] == k[1]).any()
    assert missed == 0


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(30)] + [(200, 201 + i) for i in range(50)]
    got = {r.node: r.root for r in components.connected(spark.createDataFrame(links, "a long, b long")).collect()}
    up = {n: n for e in links for n in e}
    for _ in range(100):
        for a, b in links:
            up[a] = up[b] = min(up[a], up[b])
    assert got == {n: up[n] for a, b in links if a != b for n in (a, b)}
    assert components.connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_shingles_of_one_class_do_not_travel(spark):
    """op4: prefix rows are those that another class can meet; places and counts stay those of the whole prefix."""
    df = spark.createDataFrame([("x", 9, 9, "r", True, [(1, 11), (1, 12), (2, 13), (3, 14)]), ("y", 8, 8, "s", False, [(1, 21)])],
                               "cls string, n long, reach long, root string, outside boolean, prefix array<struct<df: long, item: long>>")
    got = sorted(tuple(r[c] for c in ("cls", "item", "pos", "early", "n_early")) for r in nd._prefixes(df).collect())
    assert got == [("x", 13, 3, [13, 14], 4), ("x", 14, 4, [13, 14], 4)]
