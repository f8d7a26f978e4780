"""Line dedup: bitmaps and kept texts against a plain version."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ranklight.llm import lines

LONG = "This line is long enough to be looked at, surely " * 2
OTHER = "ÄÖÜ — une ligne assez longue pour être comptée, Été ÉTÉ"


def _key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def _plain(rows, min_chars, min_docs):
    """Per row: (number of lines, kept line numbers)."""
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(_key(line)) >= min_chars:
                holders.setdefault(_key(line), set()).update([doc] if doc is not None else [])
    out = []
    for doc, text in rows:
        ls = (text or "").split("\n")
        gone = [len(_key(x)) >= min_chars and len(holders[_key(x)]) >= min_docs and doc != max(holders[_key(x)]) for x in ls]
        out.append((len(ls), [i for i, g in enumerate(gone) if not g]))
    return out


def _expanded(n, keep):
    return list(range(n)) if keep is None else [i for r in keep for i in range(r.start, r.start + r.length)]


def _rows():
    rng = random.Random(5)
    pool = [f"{'x' * rng.randint(0, 30)} pool line {i}" for i in range(25)] + ["", "  ", "\t", OTHER, OTHER.upper()]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 30)))) for i in range(60)]
    rows += [(3, rows[4][1]), (3, rows[3][1]), (None, rows[7][1]), (None, rows[8][1]), (70, None), (71, ""), (72, "\n\n"),
             (73, "\n".join([pool[0]] * 5000 + [pool[20]] * 3))]
    return rows


@pytest.mark.parametrize("min_chars,min_docs", [(10, 2), (25, 5), (1, 1), (40, 50)])
def test_bitmaps_equal_the_plain_version(spark, docs, min_chars, min_docs):
    rows = _rows()
    d = docs(rows)
    got = lines.keep_bitmaps(d, min_chars, min_docs).withColumn("t", F.col("version")).collect()
    versions = {(r.doc_id, r.text): r.v for r in d.select("doc_id", "text", F.xxhash64("text").alias("v")).collect()}
    by_key = {}
    for r in got:
        by_key.setdefault((r.doc_id, r.version), []).append(r)
    assert len(got) == len(rows)
    for (doc, text), (n, kept) in zip(rows, _plain(rows, min_chars, min_docs), strict=True):
        for r in by_key[(doc, versions[(doc, text)])]:
            assert r.n_lines == n and r.n_dropped == n - len(kept)
            assert _expanded(n, r.keep) == kept


def test_texts_without_the_lines(spark, docs):
    rows = _rows()
    d = docs(rows)
    out = lines.remove_lines(d, 10, 2)
    assert out.columns == d.columns
    want = []
    for (doc, text), (_, kept) in zip(rows, _plain(rows, 10, 2), strict=True):
        ls = (text or "").split("\n")
        want.append((doc, None if text is None else "\n".join(ls[i] for i in kept)))
    order = lambda x: (x[0] is None, x[0] or 0, x[1] or "")
    assert sorted([(r.doc_id, r.text) for r in out.collect()], key=order) == sorted(want, key=order)
    assert all(r.n_chars == len(r.text or "") and r.start == 7 for r in out.collect())


def test_given_rules_by_hand(spark, docs):
    """Five holders, the largest keeps all its copies; four holders keep theirs."""
    rows = [(i, f"head {i}\n  {LONG.upper()}\t\nend") for i in range(1, 5)] + [(9, f"{LONG}\n{LONG}")]
    rows += [(i, OTHER) for i in range(20, 24)] + [(24, OTHER.upper())]
    got = {r.doc_id: r for r in lines.keep_bitmaps(docs(rows)).collect()}
    assert [got[i].n_dropped for i in (1, 2, 3, 4, 9)] == [1, 1, 1, 1, 0]
    assert [tuple(x) for x in got[1].keep] == [(0, 1), (2, 1)]
    assert all(got[i].n_dropped == 0 for i in range(20, 25))


def test_query_digest(spark, docs, monkeypatch):
    rows = [(i, LONG) for i in range(5)] + [(7, None)]
    monkeypatch.setattr(lines, "table", lambda *_: docs(rows))
    got = {r.doc_id: r for r in lines.op11_range_line_dedup(spark, "").collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got[0].kept_sha256 == sha("") and got[4].kept_sha256 == sha(LONG) and got[7].kept_sha256 == sha("")
    assert (got[7].n_lines, got[7].n_dropped, got[0].n_dropped) == (1, 0, 1)


def test_empty_table(spark, docs):
    assert lines.keep_bitmaps(docs([])).count() == 0


def test_one_exchange_between_hashes_and_counts_a_document(spark, docs):
    """The range by (hash, document) serves the window; only sums are dealt again, and no Python runs."""
    plan = lines.frequent_hashes(lines.line_hashes(docs([(1, LONG)])))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 2 and "rangepartitioning" in plan and plan.count("Sort [") == 1
    assert "Python" not in plan and "Arrow" not in plan
