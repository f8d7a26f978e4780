"""Percentiles over all pairs against numpy on the full list."""

import uuid

import numpy as np
import pytest

from ranklight.operators import pairselect
from ranklight.session import stage_path


def _got(spark, m, p):
    w = spark.createDataFrame([(i, f"t{j}", float(m[i, j])) for i, j in zip(*map(lambda a: a.tolist(), np.nonzero(m)), strict=True)],
                              "doc_id long, term string, w double")
    return pairselect.pair_percentile(w, p, stage_path(spark, f"pairs-{uuid.uuid4().hex[:8]}"))


def _unit(rng, n, d, share):
    m = rng.random((n, d)) * (rng.random((n, d)) < share)
    m[:, 0] += 1e-3
    m[n // 2:n // 2 + n // 5] = m[0]
    return m / np.sqrt((m * m).sum(1, keepdims=True))


@pytest.mark.parametrize("few", [100_000, 3])
def test_percentiles_equal_numpy(spark, monkeypatch, few):
    from pyspark import cloudpickle
    monkeypatch.setattr(pairselect, "BLOCK", 32)
    monkeypatch.setattr(pairselect, "BINS", 8)
    monkeypatch.setattr(pairselect, "FEW", few)
    cloudpickle.register_pickle_by_value(pairselect)
    try:
        m = _unit(np.random.default_rng(few), 110, 12, 0.3)
        s = (m @ m.T)[np.triu_indices(110, 1)]
        for p in (0, 37.5, 75, 100):
            value, n = _got(spark, m, p)
            assert n == len(s) and abs(value - np.percentile(s, p)) < 1e-12
    finally:
        cloudpickle.unregister_pickle_by_value(pairselect)


def test_few_rows(spark):
    m = np.array([[1.0, 0.0], [0.0, 1.0], [0.6, 0.8]])
    assert abs(_got(spark, m, 50)[0] - 0.6) < 1e-12
    assert _got(spark, m[:1], 50) == (None, 0)
    same = _got(spark, np.repeat(m[2:], 40, axis=0), 75)
    assert abs(same[0] - 1) < 1e-12 and same[1] == 780


def test_sums_are_exact_beyond_doubles():
    n = np.array([2**55 + 1, 3, 2**54 + 7], np.int64)
    assert pairselect._sums(np.array([1, 0, 1]), n, 3).tolist() == [3, 2**55 + 2**54 + 8, 0]
