"""Language profiles: held-out accuracy, brute-force bundling, odd rows."""

import numpy as np
from pyspark.sql import functions as F

from ranklight.llm import langid
from ranklight.llm.common import table

SMALL = "/root/testdata/sf0.01"


def _brute(enc, text, n=3):
    """Sum of n-gram vectors, letter by letter."""
    s = [0]
    for ch in text.lower():
        c = ord(ch) if ch.isalpha() else 0
        if c or s[-1]:
            s.append(c)
    s += [0] if s[-1] else []
    total = np.zeros(enc.dim)
    for i in range(len(s) - n + 1):
        v = np.ones(enc.dim)
        for k in range(n):
            v = v * np.roll(enc.letter(s[i + k]), n - 1 - k)
        total += v
    return total


def test_profiles_equal_brute_force(monkeypatch):
    enc = langid.Encoder(64)
    texts = ["The cat's  hat!", "", None, "42 -- 17", "Ünïcode 中文字 Straße", "a", "x" * 50, "ab " * 40, "ßÀÉ\n\nnext"]
    want = [_brute(enc, t or "") for t in texts]
    assert np.array_equal(enc.profiles(texts), np.array(want))
    monkeypatch.setattr(langid, "BLOCK_CHARS", 7)
    assert np.array_equal(enc.profiles(texts), np.array(want))


def test_held_out_accuracy(spark):
    docs = table(spark, SMALL, "documents")
    got = langid.op3_language_profiles(spark, SMALL).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == docs.count() and 0.15 < len(held) / len(got) < 0.35
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs = table(spark, SMALL, "documents")
    spoiled = docs.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), F.lit("en")).otherwise(F.col("lang")))
    a, b = langid.train_split(docs), langid.train_split(spoiled)
    assert a.languages == b.languages and np.array_equal(a.prototypes, b.prototypes)


def test_odd_rows(spark, docs):
    rows = [(1, "the and of them", "en"), (3, "der die das nicht und", "de"), (4, None, "en"), (5, "123 !!", "en"), (6, "", None),
            (None, "und der die", None), (7, "no label here", None), (7, "no label here", None), (8, "wort " * 200000, None)]
    m = langid.train(docs(rows))
    assert m.languages == ["de", "en"]
    got = {(r.doc_id, r.lang_pred) for r in langid.predict(docs(rows), m).collect()}
    assert {(4, "und"), (5, "und"), (6, "und"), (None, "de")} <= got
    assert "start" in langid.predict(docs(rows), m).columns
    empty = langid.train(docs([]))
    assert empty.languages == []
    assert {r.lang_pred for r in langid.predict(docs(rows), empty).collect()} == {"und"}
    assert langid.predict(docs([]), m).count() == 0


def test_bundles_add_the_profiles_of_a_label():
    enc = langid.Encoder(64)
    texts = ["one text", "ein Text", None, "another", "Ünï 中文"]
    label = np.array([1, 0, 1, 1, 0])
    each = enc.profiles(texts)
    assert np.array_equal(enc.bundles(texts, label, 3), np.stack([each[label == i].sum(axis=0) for i in range(3)]))
