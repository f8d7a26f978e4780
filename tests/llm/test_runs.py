"""Periodic runs against brute force over all starts and periods."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from ranklight.llm import runs as rn


def _plain(words, min_length, min_exponent):
    """Maximal stretches per period; a stretch with a smaller period that spans it is left out."""
    n, out = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i >= q and (i, j + q - i) not in out:
                out[(i, j + q - i)] = q
            i = j + 1
    return sorted(((s, m, q) for (s, m), q in out.items() if m >= max(min_length, min_exponent * q)), key=lambda r: (r[0], r[2]))


def _texts(rng):
    kind = rng.randrange(5)
    n = rng.randint(0, 70)
    if kind == 0:
        return [rng.choice("ab") for _ in range(n)]
    if kind == 1:
        return ["a"] * n
    if kind == 2:
        x, y = "a", "ab"
        while len(y) < n:
            x, y = y, y + x
        return list(y[:n])
    if kind == 3:
        base = [rng.choice("abcdef") for _ in range(rng.randint(1, 12))]
        return (base * 8)[: n] + [rng.choice("abc") for _ in range(rng.randint(0, 9))] + (base[::-1] * 4)[: n // 2]
    return [rng.choice("abcdefghijklmnop") for _ in range(n)]


@pytest.mark.parametrize("seed", range(6))
def test_all_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(120):
        words = _texts(rng)
        got = sorted(map(tuple, rn.all_runs(np.array([ord(w) for w in words], np.int64)).tolist()))
        assert got == sorted(_plain(words, 2, 2)), words


@pytest.mark.parametrize("min_length,min_exponent", [(24, 3), (6, 2), (10, 4), (2, 2)])
def test_runs_within_covered_stretches(min_length, min_exponent):
    rng = random.Random(9)
    for _ in range(150):
        words = [w for _ in range(4) for w in _texts(rng)]
        assert rn.find_runs(words, min_length, min_exponent) == _plain(words, min_length, min_exponent), words


def test_suffix_tree_ranks_and_extensions():
    rng = random.Random(2)
    for _ in range(60):
        s = [rng.randint(1, 3) for _ in range(rng.randint(1, 60))]
        for reverse in (False, True):
            leaves, between = rn.SuffixTree(s, 4).tour(reverse)
            key = lambda i: [(-c if reverse else c) for c in s[i:]]  # noqa: B023, E731
            assert leaves.tolist() == sorted(range(len(s) + 1), key=key)
            lce = rn.Extensions(leaves, between)
            i, j = np.indices((len(s) + 1,) * 2).reshape(2, -1)
            i, j = i[i != j], j[i != j]
            for a, b, got in zip(i.tolist(), j.tolist(), lce(i, j).tolist(), strict=True):
                want = 0
                while max(a, b) + want < len(s) and s[a + want] == s[b + want]:
                    want += 1
                assert got == want


def test_seed_and_ties():
    assert rn.seed_length(24, 3) == 16 and rn.seed_length(2, 2) == 1
    assert rn.best_run([(0, 30, 10), (5, 24, 8), (9, 31, 10), (40, 62, 20)]) == (9, 31, 10)
    assert rn.best_run([]) is None


def _planted(doc_id, words):
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_query_equals_plain_version(spark, docs, monkeypatch):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.choice([0, 3, 30, 60, 200]))]
        if i % 5 == 0:
            words += words[-7:] * 4 + ["x"] * rng.randint(20, 30)
        rows.append((i, rng.choice([" ", "\n", "\t  "]).join(words)))
    rows += [(900, None), (901, " \n\t"), (902, "é à\x0b" * 30), (902, "é à\x0b" * 30)]
    monkeypatch.setattr(rn, "table", lambda *_: docs(rows))
    got = {r.doc_id: r for r in rn.op13_suffix_tree_runs(spark, "").collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    found = 0
    for i, text in rows:
        words = _planted(i, [w for w in (text or "").replace("\n", " ").replace("\t", " ").replace("\x0b", " ").split(" ") if w])
        want = _plain(words, 24, 3)
        found += len(want)
        top = min(want, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
        r = got[i]
        assert (r.n_runs, r.start, r.length, r.period) == (len(want), *top)
        assert r.exponent_milli == (1000 * top[1] // top[2] if want else None)
        assert r.runs_sha256 == sha("".join(f"{s},{m},{q}\n" for s, m, q in want))
        gone = {k for s, m, q in want for k in range(s + q, s + m)}
        assert r.collapsed_sha256 == sha(" ".join(w for k, w in enumerate(words) if k not in gone))
    assert found > 100


def test_null_ids_long_text_and_empty_table(spark, docs):
    long = " ".join(f"a{i}" for i in range(2000)) + " b c" * 40_000
    out = rn.periodic_runs(docs([(None, "x " * 30), (1, long)])).collect()
    assert sorted([[tuple(x) for x in r.runs] for r in out]) == [[(0, 30, 1)], [(2000, 80_000, 2)]]
    assert rn.periodic_runs(docs([])).count() == 0
    with pytest.raises(ValueError):
        rn.periodic_runs(docs([]), min_exponent=1)
