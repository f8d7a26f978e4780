"""Registered queries against their DuckDB oracles on the smallest data,
and independence from the number of shuffle partitions."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from ranklight.sources.tables import DRIVER_TABLES
from tests.conftest import SF_SMALL

SAMPLE = ["cf_baseline_eval", "clean_catalogue", "cleaning_report", "sample_ratings", "discover", "describe",
          "score_density", "genre_onehot", "tfidf_documents", "content_all_pairs", "similar_items_batch",
          "hybrid_weighted", "hybrid_mixed", "ranking_metrics", "ndcg_at_10", "diversity", "cross_validate",
          "recommend_all_users", "embedding_neighbours", "similarity_threshold", "hybrid_weighted_batch",
          "hybrid_switching_batch", "hybrid_mixed_batch", "schema_report", "train_all", "evaluate_hybrid"]


def _norm(v):
    if v is None:
        return ""
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{round(v, 6):.6f}"
    if isinstance(v, (int,)) and not isinstance(v, bool):
        return f"{float(v):.6f}"
    if isinstance(v, (list, tuple)):
        return str([_norm(x) for x in v])
    return str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in DRIVER_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", SAMPLE)
def test_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rel = con.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(rel.columns, rel.fetchall())


@pytest.mark.parametrize("name", ["ranking_metrics", "content_all_pairs", "recommend_all_users", "cross_validate",
                                  "sample_ratings", "similar_items_batch", "hybrid_mixed", "evaluate_hybrid"])
def test_partition_count_does_not_matter(spark, name):
    q = entry.queries()[name]
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    a = q(spark, SF_SMALL)
    ra = _canon(a.columns, [tuple(r) for r in a.collect()])
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    b = q(spark, SF_SMALL)
    assert ra == _canon(b.columns, [tuple(r) for r in b.collect()])


def test_every_query_has_a_docstring_and_most_an_oracle():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert all(fn.__doc__ for fn in qs.values())
    assert set(sql) <= set(qs)
    assert len(sql) >= 0.85 * len(qs)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 1
