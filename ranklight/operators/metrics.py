"""Rating-error and ranking metrics.

Inputs are long tables, never Python lists:

* ``pred``: (..., rating, prediction) for rating errors;
* ``ranked``: (user_id, item_id, rank) with rank 1 = best, no item twice per user;
* ``relevant``: (user_id, item_id[, relevance]).

The users present in ``ranked`` define every mean; a user without relevant
items contributes 0.  Everything is joins and grouped sums.  Per-user work is
bounded by k (lists are cut to k before any window), so a user with a huge
relevant set costs one grouped count, not a sorted partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ranklight.functions.columns import r6

K_VALUES = (5, 10, 20)


# ---------------------------------------------------------------- rating errors

def rating_errors(pred: DataFrame, true_col: str = "rating", pred_col: str = "prediction") -> DataFrame:
    """V1-V3 in one pass: rmse, mae, mse and the row count."""
    d = F.col(pred_col) - F.col(true_col)
    return pred.agg(r6(F.sqrt(F.avg(d * d))).alias("rmse"),
                    r6(F.avg(F.abs(d))).alias("mae"),
                    r6(F.avg(d * d)).alias("mse"),
                    F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- ranking

def _with_k(df: DataFrame, ks) -> DataFrame:
    """One copy of each row per k it belongs to (rank <= k): no join."""
    arr = F.array(*[F.lit(int(k)) for k in ks])
    return (df.withColumn("k", F.explode(F.filter(arr, lambda k: F.col("rank") <= k))))


def relevant_counts(relevant: DataFrame) -> DataFrame:
    """Relevant items per user: a grouped count (combined map-side)."""
    return relevant.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_rel"))


def per_user_at_k(ranked: DataFrame, relevant: DataFrame, ks=K_VALUES) -> DataFrame:
    """Per (user, k): hits, n_rel, precision, recall, f1, ap, hit.

    V4-V7 and V10's per-list part.  Lists are cut to max(k) first; the
    running hit count for AP is a window over one list (<= max(k) rows).
    """
    kmax = max(ks)
    cut = ranked.filter(F.col("rank") <= kmax).select("user_id", "item_id", "rank")
    rel = relevant.select("user_id", "item_id").withColumn("_rel", F.lit(1))
    marked = (cut.join(rel, ["user_id", "item_id"], "left")
              .withColumn("hit", F.coalesce("_rel", F.lit(0))).drop("_rel"))
    w = Window.partitionBy("user_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    marked = marked.withColumn("hits_so_far", F.sum("hit").over(w))
    per = (_with_k(marked, ks)
           .groupBy("user_id", "k")
           .agg(F.sum("hit").alias("hits"),
                F.coalesce(F.sum(F.when(F.col("hit") == 1, F.col("hits_so_far") / F.col("rank"))),
                           F.lit(0.0)).alias("ap_sum")))
    per = per.join(relevant_counts(relevant), "user_id", "left").fillna({"n_rel": 0})
    p = F.col("hits") / F.col("k")
    r = F.when(F.col("n_rel") > 0, F.col("hits") / F.col("n_rel")).otherwise(F.lit(0.0))
    return (per.withColumn("precision", p)
            .withColumn("recall", r)
            .withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                     2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
                        .otherwise(F.lit(0.0)))
            .withColumn("ap", F.when((F.col("n_rel") > 0) & (F.col("hits") > 0),
                                     F.col("ap_sum") / F.least(F.col("n_rel"), F.col("k"))).otherwise(F.lit(0.0)))
            .withColumn("hit", (F.col("hits") > 0).cast("double")))


def ranking_metrics(ranked: DataFrame, relevant: DataFrame, ks=K_VALUES) -> DataFrame:
    """Means over users for every k: precision, recall, f1 (per-list mean,
    ``f1_macro``), f1 of the means (D10), MAP, hit rate, users."""
    per = per_user_at_k(ranked, relevant, ks)
    out = per.groupBy("k").agg(
        F.avg("precision").alias("precision"), F.avg("recall").alias("recall"),
        F.avg("f1").alias("f1_macro"), F.avg("ap").alias("map"), F.avg("hit").alias("hit_rate"),
        F.count(F.lit(1)).alias("users"))
    f1m = F.when(F.col("precision") + F.col("recall") > 0,
                 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    return out.select("k", r6("precision").alias("precision"), r6("recall").alias("recall"),
                      r6("f1_macro").alias("f1_macro"), r6(f1m).alias("f1_of_means"),
                      r6("map").alias("map"), r6("hit_rate").alias("hit_rate"), "users")


def ndcg_per_user(ranked: DataFrame, relevant: DataFrame, k: int) -> DataFrame:
    """V9 per user: DCG of the list over the ideal DCG (0 when ideal is 0).

    gain = 2^relevance - 1, discount = log2(position + 1).  The ideal ranking
    needs only the top-k relevances of a user: relevances are counted per
    (user, level) (a grouped count, skew-safe), levels are laid out in
    descending order as position ranges, and the ranges are met with the k
    positions 1..k (a k-row table).
    """
    spark = ranked.sparkSession
    rel = relevant if "relevance" in relevant.columns else relevant.withColumn("relevance", F.lit(1.0))
    rel = rel.select("user_id", "item_id", F.col("relevance").cast("double").alias("relevance"))
    cut = ranked.filter(F.col("rank") <= k).select("user_id", "item_id", "rank")
    dcg = (cut.join(rel, ["user_id", "item_id"], "left")
           .groupBy("user_id")
           .agg(F.sum(F.coalesce((F.pow(F.lit(2.0), F.col("relevance")) - 1) / F.log2(F.col("rank") + 1),
                                 F.lit(0.0))).alias("dcg")))
    levels = rel.groupBy("user_id", "relevance").agg(F.count(F.lit(1)).alias("cnt"))
    lw = Window.partitionBy("user_id").orderBy(F.col("relevance").desc())
    levels = (levels.withColumn("end_pos", F.sum("cnt").over(lw.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("start_pos", F.col("end_pos") - F.col("cnt") + 1)
              .filter(F.col("start_pos") <= k))
    positions = F.broadcast(spark.range(1, k + 1).withColumnRenamed("id", "pos"))
    ideal = (levels.join(positions, (F.col("pos") >= F.col("start_pos")) & (F.col("pos") <= F.col("end_pos")))
             .groupBy("user_id")
             .agg(F.sum((F.pow(F.lit(2.0), F.col("relevance")) - 1) / F.log2(F.col("pos") + 1)).alias("idcg")))
    users = cut.select("user_id").distinct()
    return (users.join(dcg, "user_id", "left").join(ideal, "user_id", "left")
            .select("user_id",
                    F.when(F.coalesce("idcg", F.lit(0.0)) > 0, F.coalesce("dcg", F.lit(0.0)) / F.col("idcg"))
                    .otherwise(F.lit(0.0)).alias("ndcg")))


def ndcg_at_k(ranked: DataFrame, relevant: DataFrame, k: int = 10) -> DataFrame:
    return ndcg_per_user(ranked, relevant, k).agg(r6(F.avg("ndcg")).alias("ndcg"),
                                                  F.count(F.lit(1)).alias("users"))


def coverage(ranked: DataFrame, catalogue: DataFrame, exact: bool = True) -> DataFrame:
    """Distinct recommended items (whole lists) / catalogue size."""
    n_items = catalogue.select(F.count(F.lit(1))).scalar()
    distinct = F.count_distinct("item_id") if exact else F.approx_count_distinct("item_id")
    return ranked.agg(distinct.alias("n_recommended")).select(
        "n_recommended", F.lit(n_items).alias("catalogue_size"),
        F.when(F.lit(n_items) > 0, r6(F.col("n_recommended") / F.lit(n_items))).otherwise(F.lit(0.0)).alias("coverage"))


def list_squares(members: DataFrame, vectors: DataFrame) -> DataFrame:
    """(user_id, tag, n, square) of every list: the items that have a vector,
    and the squared length of the sum of their vectors.  ``members``: user_id,
    item_id, tag (names one of a user's lists).

    A vector travels as one row of (hash of the term, w), once per user and
    item; its terms are summed where the user's rows lie."""
    entry = F.struct(F.xxhash64("term").alias("t"), F.col("w").alias("w"))
    # The entry without a term counts the item.
    packed = vectors.groupBy("item_id").agg(F.collect_list(entry).alias("v")).select("item_id", F.col("v.t").alias("t"), F.col("v.w").alias("w"))
    own = members.where("user_id is not null").groupBy("user_id", "item_id").agg(F.collect_list("tag").alias("tags"))
    here = (own.join(packed, "item_id").select("user_id", "tags", "t", "w").repartition("user_id")
            .select("user_id", F.explode("tags").alias("tag"),
                    F.concat(F.arrays_zip("t", "w"), F.array(F.struct(F.lit(None).cast("long").alias("t"), F.lit(1.0).alias("w")))).alias("e")))
    sums = here.select("user_id", "tag", F.inline("e")).groupBy("user_id", "tag", "t").agg(F.sum("w").alias("s"))
    return sums.groupBy("user_id", "tag").agg(F.max(F.when(F.col("t").isNull(), F.col("s"))).cast("long").alias("n"),
                                              F.sum(F.when(F.col("t").isNotNull(), F.col("s") * F.col("s"))).alias("square"))


def diversity(ranked: DataFrame, vectors: DataFrame, k: int | None = None) -> DataFrame:
    """Per list, mean of 1 - cos over unordered pairs; mean over lists.

    ``vectors`` is a long unit-length table (item_id, term, w).  For unit
    vectors the pair sum needs no pairs: sum_{i<j} v_i.v_j =
    (|sum_i v_i|^2 - n) / 2, so each list costs one grouped sum per
    (user, term), taken where the user's rows lie.  Items without a vector are skipped, lists of < 2 too.
    """
    lst = ranked if k is None else ranked.filter(F.col("rank") <= k)
    n, sq = F.col("n"), F.col("square")
    per = (list_squares(lst.select("user_id", "item_id", F.lit(0).alias("tag")), vectors).filter(n >= 2)
           .select("user_id", (1 - ((sq - n) / 2) / (n * (n - 1) / 2)).alias("diversity")))
    return per.agg(r6(F.avg("diversity")).alias("diversity"), F.count(F.lit(1)).alias("lists"))


def query_diversity(neighbours: DataFrame, sim_col: str = "similarity") -> DataFrame:
    """V13 (D9): 1 - mean similarity of each list to its query item, averaged."""
    per = neighbours.groupBy("query_id").agg((1 - F.avg(sim_col)).alias("d"))
    return per.agg(r6(F.avg("d")).alias("query_diversity"), r6(1 - F.avg("d")).alias("avg_similarity"),
                   F.count(F.lit(1)).alias("queries"))


def evaluate_all(pred: DataFrame, ranked: DataFrame, relevant: DataFrame, ks=K_VALUES) -> DataFrame:
    """Rating errors and, per k, the list metrics, in long form
    (metric, k, value); k = 0 for rating errors."""
    err = rating_errors(pred)
    e_long = err.select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.lit(0).alias("k"), F.col(m).cast("double").alias("value"))
        for m in ("rmse", "mae", "mse")])).alias("x")).select("x.*")
    rm = ranking_metrics(ranked, relevant, ks)
    names = ("precision", "recall", "f1_macro", "f1_of_means", "map", "hit_rate")
    r_long = rm.select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col("k").cast("int").alias("k"), F.col(m).cast("double").alias("value"))
        for m in names])).alias("x")).select("x.*")
    return e_long.unionByName(r_long)


def compare_models(metrics_long: DataFrame, metric_names) -> DataFrame:
    """One row per model, one column per metric (explicit pivot values)."""
    return metrics_long.groupBy("model").pivot("metric", list(metric_names)).agg(F.first("value"))


# Direction of each metric for "best model" (V19): True = larger is better.
HIGHER_IS_BETTER = {"rmse": False, "mae": False, "mse": False, "precision": True, "recall": True,
                    "f1_macro": True, "f1_of_means": True, "map": True, "hit_rate": True,
                    "ndcg": True, "coverage": True, "diversity": True}


def best_per_metric(metrics_long: DataFrame) -> DataFrame:
    """V19 (D8): best model per metric by argmin/argmax, ties to the first
    model name."""
    spark = metrics_long.sparkSession
    dirs = spark.createDataFrame([(m, 1 if up else -1) for m, up in HIGHER_IS_BETTER.items()], "metric string, sign int")
    # The least (-sign * value, model): ties go to the first model name.
    scored = metrics_long.join(F.broadcast(dirs), "metric").withColumn("_key", F.struct((-F.col("value") * F.col("sign")).alias("v"), F.col("model").alias("m")))
    return (scored.groupBy("metric").agg(F.min("_key").alias("_best"))
            .select("metric", F.col("_best.m").alias("best_model"), (-F.col("_best.v") * 1.0).alias("_sv"))
            .join(F.broadcast(dirs), "metric")
            .select("metric", "best_model", r6(F.col("_sv") * F.col("sign")).alias("best_value")))
