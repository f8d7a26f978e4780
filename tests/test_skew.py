"""Hot keys: one user / one term holding a large share of all rows."""

from pyspark.sql import functions as F

from ranklight.functions.topk import top_k_per_group
from ranklight.operators import similarity
from ranklight.plans import stages
from tests.conftest import SF_SMALL


def _skewed(spark):
    # user 0 holds a third of the rows; scores are distinct per (user, item)
    hot = spark.range(0, 30000).select(F.lit(0).cast("long").alias("user_id"), F.col("id").alias("item_id"))
    rest = spark.range(0, 60000).select((F.col("id") % 3000 + 1).alias("user_id"), F.col("id").alias("item_id"))
    df = hot.unionByName(rest).withColumn("score", F.sin(F.col("item_id") * 7.0 + F.col("user_id")))
    return df.repartition(8, "user_id")  # already clustered by the group key


def test_salted_top_k_equals_plain(spark):
    df = _skewed(spark)
    order = [F.col("score").desc(), F.col("item_id")]
    a = top_k_per_group(df, ["user_id"], order, 5)
    b = top_k_per_group(df, ["user_id"], order, 5, salt=16)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_salted_top_k_splits_the_hot_group(spark):
    df = _skewed(spark)
    b = top_k_per_group(df, ["user_id"], [F.col("score").desc(), F.col("item_id")], 5, salt=16)
    plan = b._jdf.queryExecution().executedPlan().toString()
    assert "_part" in plan and "hashpartitioning(user_id" in plan
    # the first level sees the hot user in 16 parts, none larger than ~1/16 of it
    part = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(16))
    sizes = df.filter(F.col("user_id") == 0).groupBy(part.alias("p")).count().collect()
    assert len(sizes) == 16 and max(r["count"] for r in sizes) < 30000 / 8


def test_a_vector_that_a_third_of_the_items_share(spark):
    """Its copies are one class: one row in the blocks, k + 1 members each."""
    from ranklight.operators import blocktopk
    w = spark.range(3000).select(F.col("id").alias("doc_id"), F.explode(F.when(F.col("id") % 3 == 0, F.array(F.lit("hot"))).otherwise(
        F.array(F.lit("t"), F.concat(F.lit("u"), F.col("id").cast("string"))))).alias("term"))
    w = w.select("doc_id", "term", F.when(F.col("term") == "hot", 1.0).otherwise(F.sqrt(F.lit(0.5))).alias("w"))
    got = similarity.all_pairs_top_k(w, 5).where("doc_id % 3 = 0").collect()
    assert len(got) == 5 * 1000 and all(r.similarity == 1.0 for r in got)
    assert {r.other for r in got if r.doc_id == 1500} == {0, 3, 6, 9, 12}
    assert {r.other for r in got if r.doc_id == 6} == {0, 3, 9, 12, 15}
    path = similarity._blocks_path(spark)
    blocks = blocktopk.build_blocks(blocktopk.sparse_rows(w), blocktopk.Sparse(), 6, None, path)
    assert blocks.select(F.sum(F.size("rep"))).first()[0] == 2001


def test_all_users_top_n_for_a_user_who_saw_almost_everything(spark):
    from ranklight.operators import collab
    n_items = 10000
    cat = spark.range(n_items).select(F.col("id").alias("item_id"), F.lit(7.0).alias("score"))
    # b_i decreasing with the id: the global order is by id
    bias = spark.range(n_items).select(F.col("id").alias("item_id"), (-F.col("id") / 1e6).alias("b_i"))
    model = collab.Baseline(spark.createDataFrame([(5.0,)], "mu double"), bias,
                            spark.createDataFrame([(0, 0.0)], "user_id long, b_u double"))
    unseen = {17, 4100, 8191, 8192, 9998, 9999}
    seen = spark.range(n_items).filter(~F.col("id").isin(list(unseen))) \
        .select(F.lit(0).cast("long").alias("user_id"), F.col("id").alias("item_id"))
    seen = seen.unionByName(spark.createDataFrame([(1, 0)], "user_id long, item_id long"))
    users = spark.createDataFrame([(0,), (1,)], "user_id long")
    got = collab.recommend_all_baseline(model, seen, cat, users, top_n=5, min_score=6.0)
    rows = sorted((r.user_id, r.rank, r.item_id) for r in got.collect())
    assert [r[2] for r in rows if r[0] == 0] == [17, 4100, 8191, 8192, 9998]
    assert [r[2] for r in rows if r[0] == 1] == [1, 2, 3, 4, 5]


def test_global_row_number_matches_a_single_window(spark):
    from pyspark.sql import Window
    from ranklight.functions.index import global_row_number
    # many ties in the first key; the id completes the order
    df = spark.range(0, 20000).select(F.col("id"), (F.col("id") % 7).alias("g")).repartition(13)
    got = global_row_number(df, [F.col("g").desc(), F.col("id")], "n")
    want = df.withColumn("n", F.row_number().over(Window.orderBy(F.col("g").desc(), F.col("id"))))
    assert sorted(map(tuple, got.select("id", "n").collect())) == sorted(map(tuple, want.select("id", "n").collect()))
