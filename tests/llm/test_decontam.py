"""Greedy string tiling against a word-by-word version; planted passages."""

import random

import numpy as np
import pytest

from ranklight.llm import decontam as dc


def _brute_tiles(doc, item, m):
    """Textbook greedy string tiling."""
    md, mi, tiles = [False] * len(doc), [False] * len(item), []
    while True:
        best, matches = m, []
        for i in range(len(doc)):
            for j in range(len(item)):
                k = 0
                while (i + k < len(doc) and j + k < len(item) and doc[i + k] == item[j + k]
                       and not md[i + k] and not mi[j + k]):
                    k += 1
                if k > best:
                    best, matches = k, [(i, j)]
                elif k == best:
                    matches.append((i, j))
        if not matches:
            return sum(t[2] for t in tiles)
        for i, j in sorted(matches, key=lambda p: (p[0] - p[1], p[0])):
            if not any(md[i:i + best]) and not any(mi[j:j + best]):
                md[i:i + best] = mi[j:j + best] = [True] * best
                tiles.append((i, j, best))


@pytest.mark.parametrize("pairs", [5, 1 << 20])
@pytest.mark.parametrize("seed", range(25))
def test_tiles_equal_brute_force(seed, pairs, monkeypatch):
    monkeypatch.setattr(dc, "SEED_PAIRS", pairs)
    monkeypatch.setattr(dc, "CELLS", 3 * pairs)
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(rng.choice([2, 3, 30]))]
    item = [rng.choice(words) for _ in range(rng.randint(3, 25))]
    doc = [rng.choice([*words, "zz"]) for _ in range(rng.randint(0, 40))]
    cut = rng.randint(0, len(item))
    doc[len(doc) // 2:len(doc) // 2] = item[cut:] + ["yy"] + item[:cut]
    bench = dc.Benchmark([(1, " ".join(item))], min_match=3, coverage=1e-9)
    found = bench.find(" ".join(doc))
    assert sum(f[1] for f in found) == _brute_tiles(doc, item, min(3, len(item)))


def test_several_items_equal_brute_force():
    for seed in range(40):
        rng = random.Random(seed)
        items = [[rng.choice("abc") for _ in range(rng.randint(3, 30))] for _ in range(6)]
        doc = [rng.choice("abcz") for _ in range(60)] + items[2] + items[4][5:]
        found = {f[0]: f[1] for f in dc.Benchmark([(k, " ".join(t)) for k, t in enumerate(items)], coverage=1e-9).find(" ".join(doc))}
        want = {k: _brute_tiles(doc, t, min(dc.MIN_MATCH, len(t))) for k, t in enumerate(items)}
        assert found == {k: v for k, v in want.items() if v}


@pytest.mark.parametrize("item,matched", [("la " * 60, 60), ("la " * 30 + "di " + "la " * 29, 59), ("la " * 50 + "one two three four five six", 50)])
def test_a_million_equal_words_in_bounded_memory(item, matched):
    import tracemalloc
    bench, text = dc.Benchmark([(1, item)]), "la " * 1_000_000
    tracemalloc.start()
    found = bench.find(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [f[:2] for f in found] == [(1, matched)]
    assert peak < 500e6, peak


ITEM = "Which of the seven rivers flows north through the old town before it meets the grey sea at dusk"


def test_planted_passages(spark, docs):
    w = ITEM.split()
    filler = " ".join(f"word{i}" for i in range(300))
    rows = [(1, f"{filler} {ITEM}. {filler}"), (2, ITEM.upper()), (3, f"{' '.join(w[10:])} -- {filler} {' '.join(w[:10])}"),
            (4, filler), (5, " ".join(w[:6])), (6, None), (7, ""), (2, ITEM.upper()), (None, ITEM),
            (8, filler * 3000 + " " + ITEM), (9, " ".join(reversed(w))), (10, "So short it is, and clean")]
    bench = spark.createDataFrame([(100, ITEM, 1), (101, "So short it is", 2), (102, "it", 3), (103, None, 4), (104, "", 5), (100, ITEM, 6)],
                                  "item_id long, text string, doc_id int")
    got = sorted((r.doc_id or -1, r.item_id, r.tiles, r.coverage) for r in dc.contaminations(docs(rows), bench).collect())
    assert sorted({g[0] for g in got}) == [-1, 1, 2, 3, 8, 10]
    assert {g[2:] for g in got if g[0] == 3} == {(2, 1.0)}
    assert len([g for g in got if g[0] == 2]) == 4  # two rows, the item twice
    assert [g[1] for g in got if g[0] == 10] == [101]
    kept = dc.decontaminate(docs(rows), bench)
    assert kept.columns == docs(rows).columns
    assert sorted(r.doc_id for r in kept.collect()) == [4, 5, 6, 7, 9]


def test_blocks_do_not_matter(spark, docs, monkeypatch):
    rng = np.random.default_rng(0)
    items = [(i, " ".join(rng.choice(list("abcdefgh"), 12))) for i in range(40)]
    rows = [(i, " ".join(rng.choice(list("abcdefgh"), 60)) + " " + items[i][1]) for i in range(40)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(tuple, dc.contaminations(docs(rows), bench).collect()))
    monkeypatch.setattr(dc, "BLOCK_WORDS", 100)
    assert sorted(map(tuple, dc.contaminations(docs(rows), bench).collect())) == whole
    assert len(whole) >= 40


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert dc.contaminations(docs([(1, ITEM)]), none).count() == 0
    assert dc.contaminations(docs([]), some).count() == 0
    assert dc.decontaminate(docs([(1, ITEM)]), none).count() == 1
