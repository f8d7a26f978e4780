"""The pipeline against a plain version of each stage on a small fixture."""

import re

import corpus_pipeline as cp
from ranklight.llm import langid, tokens
from ranklight.llm.common import table
from tests.llm.conftest import SMALL

ITEM = "Which of the seven rivers flows north through the old town before it meets the grey sea at dusk"
EN = "the cat and the dog went over the hill to find that other old house which they had seen there once before in the winter"
DE = "der Hund und die Katze gingen über den Berg und suchten das andere alte Haus das sie dort im Winter einmal gesehen hatten"


def _rows():
    rows = [(i, f"{EN} number{i} " + " ".join(f"w{i}x{j}" for j in range(40)), "en", "a") for i in range(20)]
    rows += [(100 + i, f"{DE} zahl{i} " + " ".join(f"v{i}x{j}" for j in range(40)), "de", "b") for i in range(20)]
    rows += [(200, rows[3][1] + " end", None, "b"), (201, rows[4][1], "en", "a"), (202, "12 34 -- !!", "en", "a"), (203, None, "en", "a"),
             (204, f"{EN} {ITEM} {DE}", "en", "c"), (205, f"Mixed note: password = hunter22xyz and {DE}", None, None),
             (206, "", "de", "c")]
    return rows


def test_stages(spark, docs, tmp_path):
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    d = docs(_rows())
    seen, columns = [], d.columns
    for name, stage in cp.STAGES[:-1]:
        d = stage(spark, d, str(tmp_path))
        assert d.columns == columns
        seen.append({r.doc_id: r for r in d.collect()})
    clean = set(range(20)) | set(range(100, 120))
    assert set(seen[0]) == clean | {200, 201, 204, 205}
    assert seen[0][205].lang == "de"
    assert set(seen[1]) == clean | {204, 205}
    assert set(seen[2]) == clean | {205}
    assert seen[3][205].text == f"Mixed note: [SECRET] and {DE}" and seen[3][205].n_chars == len(seen[3][205].text)
    assert all(seen[3][i].text == seen[0][i].text for i in clean)
    pieces = cp.STAGES[-1][1](spark, d, str(tmp_path)).collect()
    tok = tokens.word_tokenizer(tokens.default_path())
    want = {i: len(tok.ids(r.text)) // 4 + 1 for i, r in seen[3].items()}
    assert {i: sum(p.length for p in pieces if p.doc_id == i) for i in want} == want


def test_repeated_rows_and_null_ids(spark, docs):
    rows = [(1, EN), (1, EN), (2, EN + " x"), (None, DE), (None, DE), (3, DE + " ganz anders " + EN)]
    got = sorted((r.doc_id or 0, r.text) for r in cp.near_dedup(spark, docs(rows), "").collect())
    assert got == [(0, DE), (1, EN), (3, DE + " ganz anders " + EN)]


def test_empty_documents(spark, docs, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    d = docs([])
    for _, stage in cp.STAGES:
        d = stage(spark, d, str(tmp_path))
    assert d.count() == 0


def test_run_on_test_data(spark):
    pieces = cp.run(spark, SMALL).collect()
    docs = {r.doc_id: r.text for r in table(spark, SMALL, "documents").collect()}
    kept = {p.doc_id for p in pieces}
    letters = {i for i, t in docs.items() if re.search(r"[^\W\d_]", t or "")}
    assert kept <= letters and len(kept) > 0.5 * len(docs)
    assert sum(p.length for p in pieces) == sum({p.doc_id: p.doc_tokens for p in pieces}.values())


def test_short_clean_texts_stay(spark):
    """With the model of the test data, few n-grams decide nothing; many without likeness do."""
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    short = ["Avec.", "A.", "Ok", "A.\nAll rights reserved.", "Und"]
    junk = " ".join("qxzj" + "wvkq"[i % 4] * 5 + "zzxq" for i in range(40))
    rows = [(10_000 + i, t, "en", "x", len(t)) for i, t in enumerate([*short, junk, "12 34"])]
    d = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    kept = {r.doc_id for r in cp.language_id(spark, d, "").select("doc_id").collect()}
    assert {10_000 + i for i in range(len(short))} <= kept and 10_000 + len(short) + 1 not in kept
    scores = sorted(r.score for r in langid.predict(docs, langid.train_split(docs)).collect())
    assert scores[10] > cp.MIN_LANGUAGE_SCORE
    print("junk kept", 10_000 + len(short) in kept, "lowest scores", scores[:10])


def test_one_id_with_several_texts(spark, docs):
    """Decisions go to rows: the near copy under id 7 goes, its other text stays."""
    text = EN + " " + DE + " " + " ".join(f"more{i}" for i in range(40))
    other = " ".join(f"own{i}" for i in range(60))
    got = sorted((r.doc_id, r.text) for r in cp.near_dedup(spark, docs([(1, text), (7, text + " z"), (7, other)]), "").collect())
    assert got == [(1, text), (7, other)]


def test_near_copies_without_ids(spark, docs):
    text = EN + " " + DE + " " + " ".join(f"more{i}" for i in range(40))
    rows = [(None, text), (None, text + " z"), (3, text + " y")]
    assert [(r.doc_id, r.text) for r in cp.near_dedup(spark, docs(rows), "").collect()] == [(3, text + " y")]
    rows = rows[:2] + [(None, "")] * 2 + [(4, None), (4, ""), (4, "")]
    got = cp.near_dedup(spark, docs(rows), "").collect()
    assert sum((r.text or "").startswith(EN) for r in got) == 1
    assert sorted((r.doc_id or 0, r.text is None) for r in got if not r.text) == [(0, False), (4, False), (4, True)] and len(got) == 4
