"""Collaborative filtering.

* M1 split: a hash rule on (user, item), stable under repartitioning and
  reproducible in SQL (``randomSplit`` is neither).
* M2 baseline: mean + damped item bias + damped user bias, two grouped
  aggregates and two joins.
* M3/M4: Spark ML ALS on the baseline residuals (M3, biased factorisation)
  or on raw ratings with non-negative factors (M4).
* Prediction, per-user ranking and evaluation are joins, grouped sums and
  per-user top-k, never a loop over users or items.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklight.functions.columns import clip, hex_threshold, md5_key, r6
from ranklight.functions.topk import top_k_per_group
from ranklight.functions.index import global_row_number

RATING_MIN, RATING_MAX = 1.0, 10.0
# Candidate positions expanded per task unit in the all-users top-n.
CAND_CHUNK = 4096
#: Keys that each block of positions is dealt to (every user reads the first).
CAND_SALT = 32
RELEVANT_AT = 7.0


# ---------------------------------------------------------------- M1

def split_flag(test_size: float = 0.2) -> F.Column:
    """True for test rows: md5(user-item) prefix below the share's threshold."""
    return F.substring(md5_key("user_id", "item_id"), 1, 4) < F.lit(hex_threshold(test_size))


def split_train_test(ratings: DataFrame, test_size: float = 0.2) -> DataFrame:
    """M1: drop rating 0 and tag each row with split = 'train' / 'test'."""
    return (ratings.filter(F.col("rating") > 0)
            .withColumn("split", F.when(split_flag(test_size), F.lit("test")).otherwise(F.lit("train"))))


def train_part(split: DataFrame) -> DataFrame:
    return split.filter(F.col("split") == "train").drop("split")


def test_part(split: DataFrame) -> DataFrame:
    return split.filter(F.col("split") == "test").drop("split")


# ---------------------------------------------------------------- M2

@dataclass
class Baseline:
    """mu + b_u + b_i.  ``mu`` is a one-row frame; biases are id tables."""
    mu: DataFrame
    item_bias: DataFrame
    user_bias: DataFrame
    params: dict = field(default_factory=dict)

    def mu_col(self) -> F.Column:
        return self.mu.select("mu").scalar()


def fit_baseline(train: DataFrame, reg_item: float = 10.0, reg_user: float = 15.0) -> Baseline:
    """M2: b_i = sum(r - mu) / (n_i + reg_item); b_u = sum(r - mu - b_i) / (n_u + reg_user)."""
    mu_df = train.agg(F.avg("rating").alias("mu"))
    mu = mu_df.select("mu").scalar()
    bi = (train.groupBy("item_id")
          .agg((F.sum(F.col("rating") - mu) / (F.count(F.lit(1)) + reg_item)).alias("b_i")))
    bu = (train.join(bi, "item_id")
          .groupBy("user_id")
          .agg((F.sum(F.col("rating") - mu - F.col("b_i")) / (F.count(F.lit(1)) + reg_user)).alias("b_u")))
    return Baseline(mu_df, bi, bu, {"reg_item": reg_item, "reg_user": reg_user})


def predict_baseline(model: Baseline, pairs: DataFrame, clip_output: bool = True) -> DataFrame:
    """M6 for M2: unknown user or item contributes 0 for its term."""
    raw = (model.mu_col() + F.coalesce(F.col("b_u"), F.lit(0.0)) + F.coalesce(F.col("b_i"), F.lit(0.0)))
    out = (pairs.join(model.item_bias, "item_id", "left").join(model.user_bias, "user_id", "left")
           .withColumn("raw_prediction", raw)
           .withColumn("prediction", clip("raw_prediction", RATING_MIN, RATING_MAX) if clip_output
                       else F.col("raw_prediction")))
    return out.drop("b_u", "b_i")


# ---------------------------------------------------------------- M9 / M11

def ranked_from_predictions(pred: DataFrame, k: int | None = 10) -> DataFrame:
    """Per user, items by prediction desc (raw value first, so clipped ties
    keep their order), item id asc."""
    # Ranked on values rounded to 1e-9: sums of doubles differ in the last
    # bits between engines and runs, and must not reorder near-ties.
    order = [F.round("raw_prediction", 9).desc(), F.col("item_id")] \
        if "raw_prediction" in pred.columns else [F.round("prediction", 9).desc(), F.col("item_id")]
    # pred comes out of a join on user_id: salt so a hot user is split.
    from ranklight.functions.topk import SKEW_SALT
    return top_k_per_group(pred, ["user_id"], order, k, salt=SKEW_SALT if k is not None else 0)


def ranked_lists(pred: DataFrame, k: int) -> DataFrame:
    """(user_id, item_id, rank) of the k best: only what orders a list travels."""
    value = "raw_prediction" if "raw_prediction" in pred.columns else "prediction"
    return ranked_from_predictions(pred.select("user_id", "item_id", value), k).select("user_id", "item_id", "rank")


def evaluate_predictions(pred: DataFrame, k: int = 10, threshold: float = RELEVANT_AT) -> DataFrame:
    """M9: RMSE, MAE on all held-out rows; P@k, R@k over users, where a
    user's list is their held-out items by prediction and relevant = held-out
    rating >= threshold."""
    from ranklight.operators.metrics import per_user_at_k, rating_errors
    err = rating_errors(pred)
    ranked = ranked_lists(pred, k)
    relevant = pred.filter(F.col("rating") >= threshold).select("user_id", "item_id")
    per = per_user_at_k(ranked, relevant, (k,))
    pr = per.agg(r6(F.avg("precision")).alias(f"precision_at_{k}"), r6(F.avg("recall")).alias(f"recall_at_{k}"),
                 F.count(F.lit(1)).alias("users"))
    # one struct-valued subquery: the per-user plan runs once
    s = pr.select(F.struct(*pr.columns)).scalar()
    return err.select("rmse", "mae", F.col("n").alias("n_test"),
                      s.getField(f"precision_at_{k}").alias(f"precision_at_{k}"),
                      s.getField(f"recall_at_{k}").alias(f"recall_at_{k}"),
                      s.getField("users").alias("users"))


def actual_vs_predicted(pred: DataFrame) -> DataFrame:
    """Pairs of true and predicted ratings on the test split."""
    return pred.select("user_id", "item_id", F.col("rating").alias("actual"), r6("prediction").alias("predicted"))


# ---------------------------------------------------------------- M7 / M8

def _eligible_items(catalogue: DataFrame, min_score: float) -> DataFrame:
    cat = catalogue.select("item_id", "score")
    return cat.filter(F.col("score") >= min_score) if min_score and min_score > 0 else cat


def recommend_user_baseline(model: Baseline, ratings: DataFrame, catalogue: DataFrame, user_id: int,
                            top_n: int = 10, min_score: float = 6.0) -> DataFrame:
    """M7: items the user has not rated (D1: raw ids), score >= min_score,
    top-n by prediction.  One user: the item scan is filtered and cut with a
    TakeOrderedAndProject."""
    seen = ratings.filter(F.col("user_id") == user_id).select("item_id")
    items = _eligible_items(catalogue, min_score).join(seen, "item_id", "left_anti")
    pairs = items.select(F.lit(user_id).cast("long").alias("user_id"), "item_id")
    # The user's one bias goes to the items, not all items to the user's key.
    own = Baseline(model.mu, model.item_bias, F.broadcast(model.user_bias.filter(F.col("user_id") == user_id)), model.params)
    pred = predict_baseline(own, pairs)
    top = pred.orderBy(F.round("raw_prediction", 9).desc(), F.col("item_id")).limit(top_n)
    # At most top_n rows: numbering them needs no partition key.
    from pyspark.sql import Window
    return top.select("user_id", "item_id", r6("prediction").alias("prediction"),
                      F.row_number().over(Window.orderBy(F.round("raw_prediction", 9).desc(), F.col("item_id"))).alias("rank"))


def recommend_all_baseline(model: Baseline, ratings: DataFrame, catalogue: DataFrame, users: DataFrame,
                           top_n: int = 10, min_score: float = 6.0) -> DataFrame:
    """M8 for M2: for all given users at once, exact, linear in the data.

    Under M2 every user orders items alike (by b_i), so the eligible items get
    one global position.  A user with s seen eligible items finds their top-n
    unseen among the first n + s positions: emit exactly those candidate
    positions (n + s per user), drop the seen ones, keep the first n.
    """
    items = (_eligible_items(catalogue, min_score).select("item_id")
             .join(model.item_bias, "item_id", "left").fillna({"b_i": 0.0}))
    ordered = global_row_number(items, [F.round("b_i", 9).desc(), F.col("item_id")], "pos")
    users = users.select("user_id").distinct()
    seen = ratings.select("user_id", "item_id").distinct().join(items.select("item_id"), "item_id", "left_semi")
    s = seen.groupBy("user_id").agg(F.count(F.lit(1)).alias("s"))
    # Positions 1..n+s per user, generated in chunks of CAND_CHUNK: the chunk
    # rows are spread over tasks by (user, chunk) before they are expanded,
    # so a user who has seen a third of all items does not expand in one task.
    last = (F.lit(top_n) + F.col("s")).cast("long")
    chunks = (users.join(s, "user_id", "left").fillna({"s": 0})
              .select("user_id", last.alias("last"),
                      F.explode(F.sequence(F.lit(0).cast("long"), F.floor((last - 1) / CAND_CHUNK).cast("long")))
                      .alias("chunk"))
              .repartition("user_id", "chunk"))
    # The order is carried in blocks of one chunk.  Every user asks for the
    # first block, so each block is met under CAND_SALT keys.
    blocks = (ordered.withColumn("chunk", F.floor((F.col("pos") - 1) / CAND_CHUNK).cast("long"))
              .groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("pos", "item_id"))).alias("ids"))
              .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(CAND_SALT - 1).cast("long")))))
    cand = (chunks.withColumn("salt", F.pmod(F.xxhash64("user_id"), F.lit(CAND_SALT))).join(blocks, ["chunk", "salt"])
            .select("user_id", "last", F.explode(F.slice("ids", F.lit(1), F.least(F.size("ids"), (
                F.col("last") - F.col("chunk") * CAND_CHUNK).cast("int")))).alias("x"))
            .select("user_id", "x.pos", "x.item_id").join(seen, ["user_id", "item_id"], "left_anti"))
    top = top_k_per_group(cand, ["user_id"], [F.col("pos")], top_n)
    pred = predict_baseline(model, top.select("user_id", "item_id", "rank"))
    return pred.select("user_id", "item_id", "rank", r6("prediction").alias("prediction"))


# ---------------------------------------------------------------- M10

def fold_of(n_folds: int = 5) -> F.Column:
    """Fold number from the first md5 hex digit of (user, item)."""
    first = F.substring(md5_key("user_id", "item_id"), 1, 1)
    return ((F.instr(F.lit("0123456789abcdef"), first) - 1) % n_folds).cast("int")


def _fold_baselines(r: DataFrame, n_folds: int, reg_item: float, reg_user: float):
    """M2 fitted without fold f, for every f, in one read of ``r`` (user_id,
    item_id, rating, fold): aggregates keep one conditional column per fold,
    and the training statistics of fold f are "all minus fold f" (mean, item
    sums) or sums over rows of other folds (user residuals).  Returns the
    means, the rows with their item's terms ``bi`` and the users' terms
    ``bu`` (arrays by fold)."""
    folds = range(n_folds)
    tot = _scalar_struct(r, [F.sum("rating").alias("S"), F.count(F.lit(1)).alias("N")] +
                         [F.sum(F.when(F.col("fold") == f, F.col("rating"))).alias(f"s{f}") for f in folds] +
                         [F.count(F.when(F.col("fold") == f, 1)).alias(f"n{f}") for f in folds])
    mu = [(tot["S"] - F.coalesce(tot[f"s{f}"], F.lit(0.0))) / (tot["N"] - tot[f"n{f}"]) for f in folds]
    items = r.groupBy("item_id").agg(
        F.sum("rating").alias("S"), F.count(F.lit(1)).alias("N"),
        *[F.coalesce(F.sum(F.when(F.col("fold") == f, F.col("rating"))), F.lit(0.0)).alias(f"s{f}") for f in folds],
        *[F.count(F.when(F.col("fold") == f, 1)).alias(f"n{f}") for f in folds])
    items = items.select("item_id", F.array(*[
        ((F.col("S") - F.col(f"s{f}")) - (F.col("N") - F.col(f"n{f}")) * mu[f]) / ((F.col("N") - F.col(f"n{f}")) + reg_item)
        for f in folds]).alias("bi"))
    rows = r.join(items, "item_id")
    users = rows.groupBy("user_id").agg(
        *[F.sum(F.when(F.col("fold") != f, F.col("rating") - mu[f] - F.col("bi")[f])).alias(f"t{f}") for f in folds],
        *[F.count(F.when(F.col("fold") != f, 1)).alias(f"c{f}") for f in folds])
    users = users.select("user_id", F.array(*[
        F.coalesce(F.col(f"t{f}") / (F.col(f"c{f}") + reg_user), F.lit(0.0)) for f in folds]).alias("bu"))
    return mu, rows, users


def _fold_errors(pred: DataFrame) -> DataFrame:
    """RMSE and MAE of (fold, rating, prediction) by fold, and their means."""
    d = F.col("prediction") - F.col("rating")
    per = pred.groupBy("fold").agg(F.sqrt(F.avg(d * d)).alias("rmse"), F.avg(F.abs(d)).alias("mae"),
                                   F.count(F.lit(1)).alias("n"))
    mean = per.agg(F.avg("rmse").alias("rmse"), F.avg("mae").alias("mae"), F.sum("n").alias("n"))
    return (per.select(F.col("fold").cast("string").alias("fold"), r6("rmse").alias("rmse"), r6("mae").alias("mae"), "n")
            .unionByName(mean.select(F.lit("mean").alias("fold"), r6("rmse").alias("rmse"), r6("mae").alias("mae"),
                                     F.col("n").cast("long").alias("n"))))


def cross_validate_baseline(ratings: DataFrame, n_folds: int = 5, reg_item: float = 10.0,
                            reg_user: float = 15.0) -> DataFrame:
    """M10 for M2: per fold f, fit on the other folds and score fold f.

    All folds in one plan, every rating read and shuffled once.  Output:
    fold, rmse, mae, n, then 'mean'.
    """
    r = ratings.filter(F.col("rating") > 0).select("user_id", "item_id", "rating").withColumn("fold", fold_of(n_folds))
    mu, rows, users = _fold_baselines(r, n_folds, reg_item, reg_user)
    fold_mu = F.element_at(F.array(*mu), F.col("fold") + 1)
    pred = (rows.join(users, "user_id", "left")
            .withColumn("prediction", clip(fold_mu + F.coalesce(F.element_at("bu", F.col("fold") + 1), F.lit(0.0))
                                           + F.coalesce(F.element_at("bi", F.col("fold") + 1), F.lit(0.0)),
                                           RATING_MIN, RATING_MAX)))
    return _fold_errors(pred)


def _scalar_struct(df: DataFrame, fields: list):
    """A one-row aggregate as a struct-valued scalar subquery (run once)."""
    return df.select(F.struct(*fields)).scalar()


# ---------------------------------------------------------------- M3 / M4

@dataclass
class FactorModel:
    """ALS factors over dense indexes, plus the bias model under them (M3)
    or none (M4)."""
    als: object
    users: DataFrame          # user_id, user_idx
    items: DataFrame          # item_id, item_idx
    baseline: Baseline | None
    params: dict = field(default_factory=dict)


def _index(train: DataFrame):
    from ranklight.operators.features import user_item_index
    users, items, indexed = user_item_index(train)
    return (users.withColumn("user_idx", F.col("user_idx").cast("int")),
            items.withColumn("item_idx", F.col("item_idx").cast("int")),
            indexed.withColumn("user_idx", F.col("user_idx").cast("int")).withColumn("item_idx", F.col("item_idx").cast("int")))


def _fit_als(rows: DataFrame, user: str, item: str, target: str, algorithm: str, rank: int, max_iter: int, reg: float, seed: int):
    """Spark ML's ALS where factors must not be negative, else the same steps in large blocks."""
    from pyspark.ml.recommendation import ALS
    from ranklight.operators import als
    if algorithm == "SVD" and reg > 0:
        return als.fit(rows, user, item, target, rank, max_iter, reg, seed)
    return ALS(userCol=user, itemCol=item, ratingCol=target, rank=rank, maxIter=max_iter, regParam=reg, seed=seed,
               nonnegative=(algorithm == "NMF"), coldStartStrategy="nan", checkpointInterval=5).fit(rows.select(user, item, target))


def fit_factors(train: DataFrame, algorithm: str = "SVD", rank: int = 100, max_iter: int = 20,
                reg: float = 0.02, seed: int = 42) -> FactorModel:
    """M3 ``SVD``: bias baseline, then ALS on the residuals r - (mu + b_u + b_i).
    M4 ``NMF``: ALS with non-negative factors on the raw ratings.
    Unknown names raise (M5).  ALS needs int ids: the dense F9 index."""
    if algorithm not in ("SVD", "NMF"):
        raise ValueError(f"unknown algorithm {algorithm!r}; use 'SVD' or 'NMF'")
    users, items, indexed = _index(train)
    base = None
    target = "rating"
    if algorithm == "SVD":
        base = fit_baseline(train)
        indexed = predict_baseline(base, indexed, clip_output=False) \
            .withColumn("residual", F.col("rating") - F.col("raw_prediction"))
        target = "residual"
    model = _fit_als(indexed, "user_idx", "item_idx", target, algorithm, rank, max_iter, reg, seed)
    return FactorModel(model, users, items, base, {"algorithm": algorithm, "rank": rank, "max_iter": max_iter,
                                                   "reg": reg, "seed": seed})


def predict_factors(model: FactorModel, pairs: DataFrame) -> DataFrame:
    """M6 for M3/M4: factor product (0 for an unknown user or item) plus the
    bias terms; clipped to the rating range.  Pairs meet vectors in cells
    (``factorscore``)."""
    from ranklight.operators import factorscore
    base = model.baseline

    def side(ids, key, idx, factors, bias, name):
        f = factors.select(F.col("id").alias(idx), F.col("features").cast("array<float>").alias("vec"))
        own = ids.join(f, idx).select(F.col(key).alias("id"), "vec")
        if bias is None:
            return own.select("id", F.lit(0.0).alias("bias"), "vec")
        zero = F.array_repeat(F.lit(0.0).cast("float"), rank)
        return (own.join(bias.select(F.col(key).alias("id"), name), "id", "full")
                .select("id", F.coalesce(name, F.lit(0.0)).alias("bias"), F.coalesce("vec", zero).alias("vec")))

    rank = model.als.rank
    users = side(model.users, "user_id", "user_idx", model.als.userFactors, base and base.user_bias, "b_u")
    items = side(model.items, "item_id", "item_idx", model.als.itemFactors, base and base.item_bias, "b_i")
    scored = factorscore.score(pairs, users, items, rank)
    raw = F.col("factor").cast("double")
    if base is not None:
        raw = base.mu_col() + F.col("b_u") + F.col("b_i") + raw
    return (scored.withColumn("raw_prediction", raw)
            .withColumn("prediction", clip("raw_prediction", RATING_MIN, RATING_MAX)).drop("b_u", "b_i", "factor"))


def factor_index(model: FactorModel, catalogue: DataFrame, users: DataFrame, min_score: float = 6.0):
    """User and item blocks of M8 on M3/M4: mu and b_u are constant per user,
    so items rank by b_i + p_u.q_i.  A user or item without factors has zeros."""
    from ranklight.operators.innertopk import InnerIndex
    from ranklight.session import stage_path
    zero = F.array_repeat(F.lit(0.0).cast("float"), model.params["rank"])
    base = model.baseline
    # Factors are floats, and travel as such; scores are doubles.
    uf = model.als.userFactors.select(F.col("id").alias("user_idx"), F.col("features").cast("array<float>").alias("f"))
    itf = model.als.itemFactors.select(F.col("id").alias("item_idx"), F.col("features").cast("array<float>").alias("f"))
    us = (users.select("user_id").distinct().join(model.users, "user_id", "left").join(uf, "user_idx", "left")
          .select(F.col("user_id").alias("id"), F.coalesce("f", zero).alias("vec")))
    its = _eligible_items(catalogue, min_score).select("item_id").join(model.items, "item_id", "left").join(itf, "item_idx", "left")
    its = its.join(base.item_bias, "item_id", "left") if base is not None else its.withColumn("b_i", F.lit(0.0))
    its = its.select(F.col("item_id").alias("id"), F.coalesce("b_i", F.lit(0.0)).alias("bias"), F.coalesce("f", zero).alias("vec"))
    return InnerIndex(us, its, stage_path(users.sparkSession, f"factor-blocks-{uuid.uuid4().hex[:12]}"))


def recommend_all_factors(model: FactorModel, seen: DataFrame, catalogue: DataFrame, users: DataFrame,
                          top_n: int = 10, min_score: float = 6.0) -> DataFrame:
    """M8 for M3/M4: top-n unseen eligible items for every given user, by
    blocks of items with upper bounds (``innertopk``).  Reported prediction =
    clip(mu + b_u + score)."""
    top = factor_index(model, catalogue, users, min_score).top_k(seen, top_n)
    base = model.baseline
    mu = base.mu_col() if base is not None else F.lit(0.0)
    own = top.join(base.user_bias, "user_id", "left") if base is not None else top.withColumn("b_u", F.lit(0.0))
    return own.select("user_id", "item_id", F.col("rank").cast("int").alias("rank"),
                      r6(clip(mu + F.coalesce("b_u", F.lit(0.0)) + F.col("score"), RATING_MIN, RATING_MAX)).alias("prediction"))


def recommend_user_factors(model: FactorModel, ratings: DataFrame, catalogue: DataFrame, user_id: int,
                           top_n: int = 10, min_score: float = 6.0) -> DataFrame:
    """M7 on the trained factors: items the user has not rated, score >=
    min_score, top-n by the model's own prediction.  An unknown user gets the
    bias order (their factors count as zero)."""
    from pyspark.sql import Window
    seen = ratings.filter(F.col("user_id") == user_id).select("item_id")
    items = _eligible_items(catalogue, min_score).join(seen, "item_id", "left_anti")
    # The user's one vector goes to the items, not all users'.
    base = model.baseline and replace(model.baseline, user_bias=model.baseline.user_bias.filter(F.col("user_id") == user_id))
    own = replace(model, users=model.users.filter(F.col("user_id") == user_id), baseline=base)
    pred = predict_factors(own, items.select(F.lit(user_id).cast("long").alias("user_id"), "item_id"))
    order = [F.round("raw_prediction", 9).desc(), F.col("item_id")]
    top = pred.orderBy(*order).limit(top_n)
    # At most top_n rows: numbering them needs no partition key.
    return top.select("user_id", "item_id", r6("prediction").alias("prediction"), F.row_number().over(Window.orderBy(*order)).alias("rank"))


def recommend_user(model, ratings: DataFrame, catalogue: DataFrame, user_id: int, top_n: int = 10,
                   min_score: float = 6.0) -> DataFrame:
    """M7 for either kind of model."""
    one = recommend_user_factors if isinstance(model, FactorModel) else recommend_user_baseline
    return one(model, ratings, catalogue, user_id, top_n, min_score)


def recommend_all(model, ratings: DataFrame, catalogue: DataFrame, users: DataFrame, top_n: int = 10,
                  min_score: float = 6.0) -> DataFrame:
    """M8 for either kind of model."""
    many = recommend_all_factors if isinstance(model, FactorModel) else recommend_all_baseline
    return many(model, ratings, catalogue, users, top_n, min_score)


@dataclass
class FoldFactors:
    """Factors of all folds in one ALS model: the id of (index, fold) is
    index * n_folds + fold."""
    als: object
    rows: DataFrame           # user_idx, item_idx, fold, rating, base (bias predictions by fold)
    n_folds: int
    reg: float

    def training(self) -> DataFrame:
        """(user_key, item_key, target): each rating once for every fold that trains on it."""
        f = F.explode(F.sequence(F.lit(0), F.lit(self.n_folds - 1))).alias("f")
        return (self.rows.select("*", f).where("f <> fold")
                .select(self._key("user_idx", "f").alias("user_key"), self._key("item_idx", "f").alias("item_key"),
                        (F.col("rating") - F.element_at("base", F.col("f") + 1)).alias("target")))

    def predictions(self) -> DataFrame:
        """(fold, rating, prediction) of every rating by the factors of its own fold."""
        own = self.rows.select("fold", "rating", F.element_at("base", F.col("fold") + 1).alias("b"),
                               self._key("user_idx", "fold").alias("user_key"), self._key("item_idx", "fold").alias("item_key"))
        scored = self.als.transform(own)
        # A user or item that a fold did not train on has no factors there.
        factor = F.coalesce(F.nanvl(F.col("prediction"), F.lit(0.0)), F.lit(0.0))
        return scored.select("fold", "rating", clip(F.col("b") + factor, RATING_MIN, RATING_MAX).alias("prediction"))

    def sizes(self) -> DataFrame:
        """(fold, users, items) that have factors."""
        def count(df, name):
            return df.groupBy(F.pmod("id", F.lit(self.n_folds)).alias("fold")).agg(F.count(F.lit(1)).alias(name))
        return count(self.als.userFactors, "users").join(count(self.als.itemFactors, "items"), "fold")

    def _key(self, idx: str, fold: str) -> F.Column:
        # ALS takes int ids; more (index, fold) pairs than ints raise in the cast.
        return (F.col(idx).cast("long") * self.n_folds + F.col(fold)).cast("int")


def fit_fold_factors(ratings: DataFrame, n_folds: int = 5, algorithm: str = "SVD", rank: int = 100,
                     max_iter: int = 20, reg: float = 0.1, seed: int = 42) -> FoldFactors:
    """One ALS fit whose users and items are (id, fold): the folds share no
    key, so their normal equations are those of separate fits, and every
    iteration serves all folds in the same shuffles."""
    if algorithm not in ("SVD", "NMF"):
        raise ValueError(f"unknown algorithm {algorithm!r}; use 'SVD' or 'NMF'")
    from ranklight.operators.features import user_item_index
    from ranklight.session import stage_path
    spark = ratings.sparkSession
    r = ratings.filter(F.col("rating") > 0).select("user_id", "item_id", F.col("rating").cast("double").alias("rating"))
    r = r.withColumn("fold", fold_of(n_folds))
    _, _, r = user_item_index(r)
    if algorithm == "SVD":
        mu, rows, users = _fold_baselines(r, n_folds, 10.0, 15.0)
        base = F.array(*[mu[f] + F.col("bu")[f] + F.col("bi")[f] for f in range(n_folds)])
        rows = rows.join(users, "user_id")
    else:
        rows, base = r, F.array_repeat(F.lit(0.0), n_folds)
    rows = rows.select("user_idx", "item_idx", "fold", "rating", base.alias("base"))
    path = stage_path(spark, f"fold-rows-{uuid.uuid4().hex[:12]}")  # read for training and for scoring
    rows.write.parquet(path)
    out = FoldFactors(None, spark.read.schema(rows.schema).parquet(path), n_folds, reg)
    out.als = _fit_als(out.training(), "user_key", "item_key", "target", algorithm, rank, max_iter, reg, seed)
    return out


def cross_validate_factors(ratings: DataFrame, n_folds: int = 5, algorithm: str = "SVD", rank: int = 100,
                           max_iter: int = 20, reg: float = 0.1, seed: int = 42) -> DataFrame:
    """M10 for M3/M4: all folds fitted side by side, each rating scored by
    the factors of its own fold.  Output: fold, rmse, mae, n, then a 'mean' row."""
    return _fold_errors(fit_fold_factors(ratings, n_folds, algorithm, rank, max_iter, reg, seed).predictions())
