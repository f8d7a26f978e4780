"""The automaton against greedy longest match, piece by piece."""

import random

import pytest

from ranklight.llm import tokencount as tc
from ranklight.llm import tokens


def _greedy(pieces, word):
    n, at = 0, 0
    while at < len(word):
        for end in range(len(word), at, -1):
            if word[at:end] in pieces:
                at, n = end, n + 1
                break
        else:
            return None
    return n


@pytest.mark.parametrize("seed", range(40))
def test_equals_greedy(seed):
    rng = random.Random(seed)
    letters = "abc"[:rng.randint(1, 3)]
    pieces = {"".join(rng.choice(letters + tc.END) for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(0, 12))}
    a = tc.Automaton(pieces)
    for _ in range(200):
        word = "".join(rng.choice(letters) for _ in range(rng.randint(0, 12))) + rng.choice(["", tc.END])
        assert a.count(word) == _greedy(pieces, word), (pieces, word)


def test_real_vocabulary(spark, docs):
    counts = tc.Counts(tokens.default_path())
    pieces = set(tc.vocabulary(tokens.default_path()))
    letters = tokens.byte_letters()
    texts = ["Thanonontioniner onhe, the unbelievable STRASSE!! don't 12 é中文", "", None, "   \n\t", "x" * 3000, "a\x01b"]
    rows = list(enumerate(texts)) + [(1, ""), (None, "the")]
    got = {r.doc_id: (r.n_words, r.n_tokens) for r in tc.token_counts(docs(rows)).collect()}
    for i, t in enumerate(texts):
        words = tc._WORD.findall((t or "").lower())
        want = [_greedy(pieces, "".join(letters[b] for b in w.encode()) + tc.END) for w in words]
        assert got[i] == (len(words), sum(1 if n is None else n for n in want)), t
    assert got[None] == (1, 1) and counts.text("the the") == (2, 2)
    assert tc.token_counts(docs([])).count() == 0


def test_slices_and_cache(monkeypatch):
    counts = tc.Counts(tokens.default_path())
    text = "some words, and more; unpredictably " * 300
    whole = counts.text(text)
    monkeypatch.setattr(tokens, "SLICE_CHARS", 50)
    monkeypatch.setattr(tc, "CACHE_WORDS", 3)
    assert counts.text(text) == whole
