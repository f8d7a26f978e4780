"""Scores of pairs in cells against plain products."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ranklight.operators import factorscore

SIDE = "id long, bias double, vec array<float>"


@pytest.mark.parametrize("cell_bytes", [factorscore.CELL_BYTES, 40 * 4 * 8])
def test_scores_as_plain_products(spark, monkeypatch, cell_bytes):
    """Every pair once, also repeated ones; null and unknown ids count as zero."""
    monkeypatch.setattr(factorscore, "CELL_BYTES", cell_bytes)
    rng = np.random.default_rng(5)
    users, items = ([(k, float(rng.normal()), [float(np.float32(x)) for x in rng.normal(size=4)]) for k in range(0, 120, 2)] for _ in range(2))
    pairs = [(int(u), int(i), k) for k, (u, i) in enumerate(rng.integers(0, 120, (300, 2)))] + [(None, 4, 300), (4, None, 301), (None, None, 302), (4, 4, 303), (4, 4, 303)]
    if cell_bytes < factorscore.AT_ONCE:
        a, b = factorscore.cells(60, 60, 4, 2)
        assert a > 1 and b > 1 and (60 / a + 60 / b) * 16 <= cell_bytes + 32
    got = factorscore.score(spark.createDataFrame(pairs, "user_id long, item_id long, tag int"), spark.createDataFrame([*users, (None, 9.0, [1.0] * 4)], SIDE),
                            spark.createDataFrame(items, SIDE), 4).collect()
    u_of, i_of = ({k: (b, np.array(v)) for k, b, v in side} for side in (users, items))
    assert sorted((r.user_id or -1, r.item_id or -1, r.tag) for r in got) == sorted((u or -1, i or -1, t) for u, i, t in pairs)
    for r in got:
        u, i = u_of.get(r.user_id), i_of.get(r.item_id)
        assert r.b_u == (u[0] if u else 0) and r.b_i == (i[0] if i else 0)
        assert math.isclose(r.factor, u[1] @ i[1] if u and i else 0, abs_tol=1e-6)


def test_vectors_do_not_travel_with_pairs(spark):
    """No exchange carries a vector and a pair's columns filled in one row: pairs are dealt once."""
    pairs = spark.range(50).select(F.col("id").alias("user_id"), F.col("id").alias("item_id"), F.lit(1.0).alias("rating"))
    side = spark.range(50).select("id", F.lit(0.0).alias("bias"), F.array(F.lit(1.0).cast("float")).alias("vec"))
    plan = factorscore.score(pairs, side, side, 1)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
