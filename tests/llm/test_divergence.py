"""Source divergence against a plain version with Python's integers."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from ranklight.llm import divergence as dv

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def _plain(rows, min_docs, top):
    groups, df, total = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        ts = _terms(text)
        groups[(lang or "", source or "")].update(ts)
        df[lang or ""].update(set(ts))
        total[lang or ""].update(ts)
    out = []
    for lang in df:
        kept = [t for t, n in df[lang].items() if n >= min_docs]
        own = [(s, c) for (la, s), c in groups.items() if la == lang]
        share = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[x] for x in kept) + 5 * len(kept)) for t in kept}
        p, q = {s: share(c) for s, c in own}, share(total[lang])
        for s, c in own:
            far = sorted(((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o, _ in own if o != s))
            out += [(lang, s, "pair", o, -v, i + 1) for i, (v, _, o) in enumerate(far)]
            up = sorted((q[t] - p[s][t], t.encode(), t) for t in kept if c[t] and p[s][t] > q[t])[:top]
            out += [(lang, s, "term", t, -v, i + 1) for i, (v, _, t) in enumerate(up)]
    return sorted(out)


def _rows(n_sources, seed=3):
    rng = random.Random(seed)
    words = [f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}" for i in range(60)] + ["Été", "été", "ÉTÉ", "naïve", "Ünder_score", "it's", "日本"]
    rows = []
    for i in range(300):
        source = f"s{rng.randrange(n_sources)}" if i % 17 else None
        text = rng.choice([" ", ", ", "\n"]).join(rng.choice(words[: rng.randint(3, len(words))]).upper() if rng.random() < .2
                                                  else rng.choice(words) for _ in range(rng.randint(0, 40)))
        rows.append((i, text, rng.choice(["en", "en", "en", "de", None]), source))
    return rows + [(301, None, "xx", "lonely"), (302, "", "xx", "other"), (303, "12 34 !", "yy", "alone"), (5, "once twice", "en", "fresh"),
                   (None, "once once", "en", "s0"), rows[0]]


@pytest.mark.parametrize("sources,min_docs,blocks", [(5, 3, {}), (9, 2, {"BLOCK_TERMS": 7, "BLOCK_SOURCES": 3, "LEVELS": 2}), (4, 40, {"TABLE_ENTRIES": 1}), (3, 9999, {})])
def test_audit_equals_the_plain_version(spark, docs, monkeypatch, sources, min_docs, blocks):
    rows = _rows(sources)
    got = _with(spark, docs, rows, min_docs, blocks, monkeypatch)
    assert got == _plain(rows, min_docs, 10)


def _with(spark, docs, rows, min_docs, blocks, monkeypatch):
    # The functions that run in tasks are sent with the module's values of now.
    from pyspark import cloudpickle as spark_pickle
    for name, value in blocks.items():
        monkeypatch.setattr(dv, name, value)
    spark_pickle.register_pickle_by_value(dv)
    try:
        return sorted(tuple(r) for r in dv.audit(docs(rows), min_docs, 10).collect())
    finally:
        spark_pickle.unregister_pickle_by_value(dv)


def test_products_price_any_counts():
    rng = np.random.default_rng(1)
    for terms, a, b, high in [(1, 1, 1, 1), (40, 3, 5, 10**12), (300, 6, 2, 4), (0, 2, 2, 1)]:
        c = [rng.integers(0, high, (terms, s)) for s in (a, b)]
        p = [3 * x + 5 * np.arange(x.shape[1]) for x in c]
        want = np.abs(p[0][:, :, None] - p[1][:, None, :]).sum(0) if terms else np.zeros((a, b))
        assert (dv.price((c[0], p[0]), (c[1], p[1])) == want).all()


def test_slices_keep_terms_whole(monkeypatch):
    monkeypatch.setattr(dv, "SLICE_BYTES", 5)
    text = "Abc déf-GHI jkl\x00mno " * 9 + "x" * 100
    assert [t.decode() for part in dv._slices(text) for t in part] == _terms(text)


def test_large_counts_stay_exact(spark):
    d = spark.createDataFrame([(2**52, 2**53 + 1, 17)], "n long, total long, kept long")
    want = 1 + 10**9 * (2**52 + 5) // (2**53 + 1 + 5 * 17)
    assert d.select(dv._share("n", "total", "kept")).first()[0] == want


def test_empty_table(spark, docs):
    assert dv.audit(docs([])).count() == 0
