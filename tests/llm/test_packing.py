"""Packing: every id once, no gaps, checksums, mixture of the windows."""

import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from ranklight.llm import packing, tokens


def _ids(text):
    return np.frombuffer(tokens.word_tokenizer(tokens.default_path()).ids(text or ""), "<u4").tolist() + [2]


def _check(rows, expected, window):
    """Pieces rebuild each document and fill the windows without gaps."""
    by_seq = defaultdict(list)
    lengths = defaultdict(list)
    for r in rows:
        by_seq[r.sequence_id].append((r.offset, r.length))
        lengths[(r.doc_id, r.doc_tokens)].append((r.start, r.length, r.ids_crc32))
    for s, spans in by_seq.items():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at and length > 0
            at += length
        assert at == window or s == max(by_seq)
    assert sorted(by_seq) == list(range(len(by_seq)))
    for doc, ids in expected.items():
        at = 0
        for start, length, crc in sorted(lengths[(doc, len(ids))]):
            assert start == at
            assert crc == zlib.crc32(np.array(ids[at:at + length], "<u4").tobytes())
            at += length
        assert at == len(ids)


@pytest.mark.parametrize("window,slice_tokens", [(64, 8), (64, 64), (100, 7)])
def test_every_id_once(spark, docs, window, slice_tokens):
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma!", "Straße", "the"], rng.integers(0, 90))),
             None, rng.choice(["a", "a", "a", "b", "c"])) for i in range(80)]
    rows += [(900, None, None, None), (901, "", None, None), (902, "word " * 3000, None, "long")]
    got = packing.pack(docs(rows).repartition(5), window=window, slice_tokens=slice_tokens).collect()
    _check(got, {r[0]: _ids(r[1]) for r in rows}, window)


def test_windows_meet_their_targets(spark, docs):
    rows = [(i, "one two three four five six seven eight nine", None, "a" if i % 3 == 0 else "b") for i in range(600)]
    got = packing.pack(docs(rows), targets={"a": 3.0, "b": 1.0}, window=200, slice_tokens=10).collect()
    _check(got, {r[0]: _ids(r[1]) for r in rows}, 200)
    share = defaultdict(lambda: [0, 0])
    for r in got:
        share[r.sequence_id][r.source == "b"] += r.length
    # "a" holds 200 of 600 documents: at 3 to 1 it ends after 2000 / 0.75 ids.
    for s in range(2000 // 150 - 1):
        assert abs(share[s][0] - 150) <= 10
    assert all(a == 0 for s, (a, _) in share.items() if s > 2000 // 150 + 1)


def test_default_windows_mirror_the_corpus(spark, docs):
    rows = [(i, "one two three four five six seven eight nine", None, f"s{min(i % 10, 3)}") for i in range(1000)]
    got = packing.pack(docs(rows), window=500, slice_tokens=10).collect()
    for s in range(19):
        for q, p in (("s0", .1), ("s1", .1), ("s2", .1), ("s3", .7)):
            assert abs(sum(r.length for r in got if r.sequence_id == s and r.source == q) - 500 * p) <= 20


def test_sources_beyond_the_queues_share_one(spark, docs, monkeypatch):
    monkeypatch.setattr(packing, "MAX_QUEUES", 2)
    rows = [(i, "x y z " * (i % 7), None, f"s{i % 9}") for i in range(90)]
    got = packing.pack(docs(rows), window=50, slice_tokens=5).collect()
    _check(got, {r[0]: _ids(r[1]) for r in rows}, 50)


@pytest.mark.parametrize("targets", [None, {"s3": 5.0, "s8": 1.0, None: 2.0}])
def test_places_by_joins_equal_the_closed_form(spark, docs, monkeypatch, targets):
    rows = [(i, "x y z " * (i * 7 % 23), None, f"s{i % 9}" if i % 10 else None) for i in range(120)]
    want = sorted(map(tuple, packing.pack(docs(rows).repartition(3, "doc_id"), targets, window=50, slice_tokens=5).collect()), key=str)
    monkeypatch.setattr(packing, "MAX_QUEUES", 2)
    monkeypatch.setattr(packing, "BLOCK_ROUNDS", 3)
    got = packing.pack(docs(rows).repartition(3, "doc_id"), targets, window=50, slice_tokens=5).collect()
    assert sorted(map(tuple, got), key=str) == want


def _simulated(queues, total, window, size):
    """The stream of a plain deficit round-robin: a list of ids (doc_id, place) by queue."""
    stream, at = [], [0] * len(queues)
    phase = [Fraction(k, len(queues)) for k in range(len(queues))]
    credit = list(phase)
    while any(a < len(q) for a, q in zip(at, queues, strict=True)):
        for k, q in enumerate(queues):
            credit[k] += Fraction(len(q), total) * window / size
            while len(q) - at[k] > size and credit[k] >= 1:
                stream += q[at[k]:at[k] + size]
                at[k] += size
                credit[k] -= 1
            rest = len(q) - at[k]
            if 0 < rest <= size and credit[k] >= phase[k] + (1 - phase[k]) * Fraction(rest, size):
                stream += q[at[k]:]
                at[k] = len(q)
    return stream


@pytest.mark.parametrize("window,size,total,seed", [(256, 32, 4096, 0), (128, 16, 2048, 1), (64, 64, 2048, 2), (512, 8, 8192, 3)])
@pytest.mark.parametrize("most", [255, 2])
def test_pack_equals_a_simulated_round_robin(spark, docs, monkeypatch, most, window, size, total, seed):
    # Four sources and a power of two of ids: shares and credits have no rounding.
    rng, rows = np.random.default_rng(seed), []
    left = total
    while left:
        n = min(left, int(rng.choice([1, 5, 40, 300])))
        rows.append((len(rows), " ".join(["one"] * (n - 1)), None, "abcd"[min(3, int(rng.integers(0, 9)))]))
        left -= n
    assert sum(len(_ids(r[1])) for r in rows) == total
    queues = [[(r[0], i) for r in rows if r[3] == s for i in range(len(_ids(r[1])))] for s in "abcd"]
    monkeypatch.setattr(packing, "MAX_QUEUES", most)
    got = packing.pack(docs(rows).coalesce(1), window=window, slice_tokens=size).collect()
    stream = [None] * total
    for r in got:
        for i in range(r.length):
            stream[r.sequence_id * window + r.offset + i] = (r.doc_id, r.start + i)
    assert stream == _simulated(queues, total, window, size)


@pytest.mark.parametrize("hot", [False, True])
def test_every_source_is_in_every_window(spark, docs, hot):
    text = " ".join(["one two three four"] * 40)
    rows = [(i, text, None, "s00" if hot and i % 3 == 0 else f"s{i % 20:02}") for i in range(1500)]
    got = packing.pack(docs(rows)).collect()
    share = defaultdict(lambda: defaultdict(int))
    for r in got:
        share[r.sequence_id][r.source] += r.length
    assert len(share) > 40 and all(len(share[s]) == 20 for s in range(max(share)))
    if not hot:  # a target of 205 ids, up to one slice a source
        assert all(abs(v - 4096 / 20) <= 64 for s in range(max(share) - 1) for v in share[s].values())


def test_every_source_is_mixed_in(spark, docs):
    rows = [(i, "one two three four five six seven eight nine", None, f"s{i % 300:03}") for i in range(3000)]
    got = packing.pack(docs(rows), targets={f"s{k:03}": 3.0 if k == 299 else 1.0 for k in range(300)}, window=3000, slice_tokens=10).collect()
    share = defaultdict(lambda: defaultdict(int))
    for r in got:
        share[r.sequence_id][r.source] += r.length
    for s in range(2):  # s299 alone has three shares of 302
        assert len(share[s]) > 250 and share[s]["s299"] >= 20 and max(n for k, n in share[s].items() if k != "s299") <= 20


def test_sources_of_less_than_a_slice_are_spread(spark, docs):
    rows = [(i, "one two three four", None, f"s{i:03}") for i in range(300)] + [(i, "one two three four", None, "big") for i in range(300, 600)]
    got = packing.pack(docs(rows), window=200, slice_tokens=50).collect()
    big = defaultdict(int)
    for r in got:
        big[r.sequence_id] += r.length * (r.source == "big")
    assert all(50 <= big[s] <= 150 for s in range(max(big)))


def test_repeated_rows_and_null_ids(spark, docs):
    rows = [(1, "same text", None, "a")] * 3 + [(None, "no id", None, "a")]
    got = packing.pack(docs(rows), window=16, slice_tokens=4).collect()
    assert sum(r.length for r in got) == 3 * len(_ids("same text")) + len(_ids("no id"))
    assert sorted((r.sequence_id, r.offset) for r in got)[0] == (0, 0)


def test_empty_table(spark, docs):
    assert packing.pack(docs([])).count() == 0


def test_a_tiny_source_keeps_whole_slices(spark, docs):
    rows = [(i, "one two three four five six seven", None, "big") for i in range(500)] + [(999, "a b c d e f", None, "tiny")]
    got = packing.pack(docs(rows), window=64, slice_tokens=16).collect()
    assert [r.length for r in got if r.doc_id == 999 and r.sequence_id * 64 + r.offset >= 0][:1] != [1]
    _check(got, {r[0]: _ids(r[1]) for r in rows}, 64)


def test_cached_ids_equal_the_tokenizer(spark):
    tok = tokens.word_tokenizer(tokens.default_path())
    for text in ["it's <|endoftext|> a Σας İstanbul náive 中文字 ½²x ﬁ a\x1cb\x85y \xa0 x  don't DON'T 'Tis ''s 12345 ǅ µª",
                 "", " ", "\n\na\r\n", "x'S y'LL", "é ́x", "Ünïcödé … “quotes”", "a" * 5000]:
        assert np.frombuffer(tok.ids(text), "<u4").tolist() == tok.full.encode(text, add_special_tokens=False).ids


def test_slices_of_a_very_long_text(spark, monkeypatch):
    tok = tokens.word_tokenizer(tokens.default_path())
    text = ("some words, and more; " * 400) + "x" * 3000 + " end"
    whole = tok.ids(text)
    monkeypatch.setattr(tokens, "SLICE_CHARS", 100)
    assert tok.ids(text) == whole
