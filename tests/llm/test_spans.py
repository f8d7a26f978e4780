"""Sentence spans against a plain in-memory version."""

import random

import pytest

from ranklight.llm import spans as sp


def _brute(rows, min_words=20, alone=40):
    """Set of (doc_id, sentence) covered by any occurrence but the first."""
    seen = {}
    for doc, text in rows:
        sents = sp.sentences(text or "")
        words = [" ".join((text or "")[s:e].lower().split()) for s, e in sents]
        for i in range(len(sents)):
            j, n = i, len(words[i].split())
            if n < alone:
                while j < len(sents) and (n < min_words or j == i):
                    j += 1
                    n += len(words[j].split()) if j < len(sents) else 0
            if j < len(sents):
                seen.setdefault(" ".join(words[i:j + 1]), set()).add((doc, i, j))
    covered = set()
    for places in seen.values():
        for doc, i, j in sorted(places)[1:]:
            covered |= {(doc, k) for k in range(i, j + 1)}
    return covered


def _got(df, rows):
    text = dict(rows)
    return {(r.doc_id, k) for r in df.collect() for k, (s, e) in enumerate(sp.sentences(text[r.doc_id] or ""))
            if r.start <= s and e <= r.end}


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, docs, seed):
    rng = random.Random(seed)
    pool = [" ".join(rng.choice(["aa", "Bb", "cc", "dd"]) for _ in range(rng.choice([1, 2, 6, 12, 45]))) + rng.choice([".", "!", "?", "\n"])
            for _ in range(14)]
    rows = [(i, rng.choice([" ", "  "]).join(rng.choice(pool) for _ in range(rng.randint(0, 14)))) for i in range(40)]
    assert _got(sp.repeated(docs(rows)), rows) == _brute(rows)


PASSAGE = ("The old bridge was rebuilt in stone after the flood. It carried carts, cattle and, in one famous winter, a whole "
           "wooden house. Nobody has ever found out who paid for it, and the town archive keeps silent on the matter of "
           "the missing gold coins and bells.")


def test_planted_passage(spark, docs):
    a = "Some text of its own stands before. "
    b = " And a few other words come after it."
    rows = [(5, a + PASSAGE + b), (7, "Another start, quite unlike. " + PASSAGE.upper() + "\nThe end of this."), (9, a + b), (11, None), (12, "")]
    got = sp.repeated(docs(rows)).collect()
    assert [(r.doc_id, r.first_doc_id) for r in got] == [(7, 5)]
    assert rows[1][1][got[0].start:got[0].end] == PASSAGE.upper()
    out = {r.doc_id: r for r in sp.remove(docs(rows)).collect()}
    assert out[5].text == rows[0][1] and out[9].text == rows[2][1] and out[11].text is None and out[12].text == ""
    assert "BRIDGE" not in out[7].text and out[7].text.startswith("Another start") and out[7].n_chars == len(out[7].text)
    assert sp.remove(docs(rows)).columns == docs(rows).columns


def test_one_long_sentence(spark, docs):
    s = " ".join(f"w{i}" for i in range(55))
    rows = [(1, f"Before it. {s}. After."), (2, f"{s}.")]
    assert [(r.doc_id, r.start, r.end) for r in sp.repeated(docs(rows)).collect()] == [(2, 0, len(rows[1][1]))]


def test_repeated_rows_null_ids_and_empty_table(spark, docs):
    rows = [(1, PASSAGE), (1, PASSAGE), (None, PASSAGE), (3, PASSAGE + " " + PASSAGE)]
    got = sorted((r.doc_id, r.start) for r in sp.repeated(docs(rows)).collect())
    assert {g[0] for g in got} == {1, 3}  # the null id is first
    assert sp.repeated(docs([])).count() == 0 and sp.remove(docs([])).count() == 0


def test_one_id_with_several_texts(spark, docs):
    """Cuts go to the row that holds the passage, not to all rows of its id."""
    other = " ".join(f"Unrelated sentence number {i} stands here to be cut by mistake." for i in range(20))
    rows = [(1, PASSAGE), (5, "Its own start. " + PASSAGE), (5, other)]
    out = {(r.doc_id, r.text[:12]): r.text for r in sp.remove(docs(rows)).collect()}
    assert out[(5, other[:12])] == other
    assert out[(1, PASSAGE[:12])] == PASSAGE and "bridge" not in out[(5, "Its own star")]


def test_null_ids_with_several_texts(spark, docs):
    """One of two different texts without id keeps the passage."""
    rows = [(None, "First without an id. " + PASSAGE), (None, "Second one, other. " + PASSAGE), (None, "No passage in this text.")]
    texts = [r.text for r in sp.remove(docs(rows)).collect()]
    assert sum("bridge" in t for t in texts) == 1 and "No passage in this text." in texts


def test_very_long_text(spark, docs):
    rows = [(1, "Short one. " * 60000), (2, "x" * 300000)]
    assert sp.repeated(docs(rows)).count() >= 1


def _all_runs(rows, min_words=20, alone=40):
    """Set of (doc_id, sentence) covered by any repeated run of sentences, its first occurrence excepted."""
    seen = {}
    for doc, text in rows:
        words = [tuple(text[s:e].lower().split()) for s, e in sp.sentences(text)]
        for i in range(len(words)):
            for j in range(i, len(words)):
                if sum(map(len, words[i:j + 1])) >= (min_words if j > i else alone):
                    seen.setdefault(tuple(words[i:j + 1]), []).append((doc, i, j))
    return {(doc, k) for places in seen.values() for doc, i, j in sorted(places)[1:] for k in range(i, j + 1)}


@pytest.mark.parametrize("seed", range(3))
def test_every_repeated_run_is_covered(spark, docs, seed):
    rng = random.Random(seed)
    pool = [" ".join(rng.choice(["aa", "Bb", "cc", "dd"]) for _ in range(rng.choice([1, 2, 6, 12, 45]))) + rng.choice(".!?") for _ in range(14)]
    rows = [(i, " ".join(rng.choice(pool) for _ in range(rng.randint(0, 14)))) for i in range(40)]
    assert _got(sp.repeated(docs(rows), ends=True), rows) == _all_runs(rows)


@pytest.mark.parametrize("sizes", [(30, 10, 8), (45, 12), (10, 5, 10), (12, 45, 1, 1)])
def test_the_tail_of_a_passage_goes(spark, docs, sizes):
    passage = " ".join(" ".join(f"w{n}x{i}" for i in range(n)) + "." for n in sizes)
    rows = [(1, f"{passage} One end of it."), (2, f"Before. {passage} Another end, of some more words than the first.")]
    assert {r.doc_id: r.text for r in sp.remove(docs(rows)).collect()}[2] == "Before.  Another end, of some more words than the first."
