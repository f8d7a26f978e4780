"""Cleaning of the catalogue and the ratings log.

"First/last row per key" is a grouped ``min_by``/``max_by`` over a struct of
the row, not a window: the aggregate combines map-side, so a key holding a
third of all rows is reduced inside every map task before the shuffle.
Column-wide statistics (medians, quartiles) are scalar subqueries: Spark
computes them once and hands the value to every task.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklight.functions.columns import UNKNOWN, clip, hex_threshold, md5_key, split_list, strip_ws, to_double
from ranklight.functions.index import global_row_number
from ranklight.functions.percentiles import percentile_map
from ranklight.session import stage_path

NUMERIC_FILL = ("score", "episodes", "members", "favorites", "scored_by")
TEXT_COLUMNS = ("name", "english_name", "genres", "type")
EVENT_ORDER = ("event_ts", "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")


# ---------------------------------------------------------------- helpers

def first_per_key(df: DataFrame, key_cols: list, order_col: str, last: bool = False) -> DataFrame:
    """One row per key: the one with the smallest (or largest) ``order_col``.

    ``order_col`` may name a struct for multi-column orders; it must be unique
    within a key for the result to be deterministic.
    """
    cols = [c for c in df.columns]
    pick = F.max_by if last else F.min_by
    keyed = [F.col(k).alias(f"_k{i}") if isinstance(k, str) else k.alias(f"_k{i}")
             for i, k in enumerate(key_cols)]
    agg = (df.groupBy(*keyed)
           .agg(pick(F.struct(*cols), F.col(order_col)).alias("_row")))
    return agg.select("_row.*")


def _scalar(df: DataFrame, expr) -> F.Column:
    return df.select(expr).scalar()


# ---------------------------------------------------------------- catalogue

def coerce_numeric(df: DataFrame, cols=("score", "episodes")) -> DataFrame:
    """Text to double; 'Unknown' and other non-numbers become null."""
    for c in cols:
        if c in df.columns:
            df = df.withColumn(c, to_double(c))
    return df


def fill_median(df: DataFrame, cols=NUMERIC_FILL, exact: bool = True) -> DataFrame:
    """Nulls to the column median (exact by default; ``exact=False``
    uses ``percentile_approx`` for very large columns)."""
    cols = [c for c in cols if c in df.columns]
    df = coerce_numeric(df, cols)
    if not cols:
        return df
    # One scalar subquery for all medians, referenced per column: Spark runs it once.
    if exact:
        meds = percentile_map(df, cols, [0.5])
        median = lambda c: meds[c][0]
    else:
        approx = _scalar(df, F.struct(*[F.percentile_approx(c, 0.5, 10000).cast("double").alias(c) for c in cols]))
        median = approx.getField
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), median(c)) for c in cols})


def fill_const(df: DataFrame, text=("genres", "type")) -> DataFrame:
    """Missing genres and type to 'Unknown'."""
    return df.fillna({c: UNKNOWN for c in text if c in df.columns})


def drop_missing(df: DataFrame, subset=("item_id", "name")) -> DataFrame:
    """C4: drop rows lacking the id or the name."""
    return df.dropna(subset=[c for c in subset if c in df.columns])


def handle_missing(df: DataFrame, exact: bool = True) -> DataFrame:
    return drop_missing(fill_const(fill_median(df, exact=exact)))


def dedup_id(df: DataFrame, key: str = "item_id", order_col: str = "src_row") -> DataFrame:
    """First row per id in source order."""
    return first_per_key(df, [key], order_col)


def dedup_name(df: DataFrame, order_col: str = "src_row") -> DataFrame:
    """Then first row per lower-cased name (all nulls form one group)."""
    return first_per_key(df, [F.lower("name")], order_col)


def remove_duplicates(df: DataFrame) -> DataFrame:
    return dedup_name(dedup_id(df))


def clip_score(df: DataFrame) -> DataFrame:
    """Score bounded to [0, 10]; null stays null."""
    return df.withColumn("score", clip("score", 0, 10)) if "score" in df.columns else df


def trim_text(df: DataFrame, cols=TEXT_COLUMNS) -> DataFrame:
    """Strip white space of every kind (D3: nulls stay null)."""
    for c in cols:
        if c in df.columns:
            df = df.withColumn(c, strip_ws(c))
    return df


def normalize(df: DataFrame) -> DataFrame:
    """C7 + C8 + episodes numeric (null to 0) + C9 genres_list."""
    df = trim_text(clip_score(df))
    if "episodes" in df.columns:
        df = df.withColumn("episodes", F.coalesce(to_double("episodes"), F.lit(0.0)))
    if "genres" in df.columns:
        df = df.withColumn("genres_list", F.when(F.col("genres").isNull(), F.array().cast("array<string>"))
                           .otherwise(split_list("genres")))
    return df


def iqr_filter(df: DataFrame, col: str = "members", factor: float = 3.0, exact: bool = True) -> DataFrame:
    """Keep rows with col in [Q1 - f*IQR, Q3 + f*IQR] (linear quartiles)."""
    if col not in df.columns:
        return df
    qs = (percentile_map(df, [col], [0.25, 0.75])[col] if exact
          else _scalar(df, F.percentile_approx(col, [0.25, 0.75], 10000).cast("array<double>")))
    q1, q3 = qs[0], qs[1]
    iqr = q3 - q1
    return df.filter((F.col(col) >= q1 - factor * iqr) & (F.col(col) <= q3 + factor * iqr))


def positive_score(df: DataFrame) -> DataFrame:
    """C11: drop scores <= 0."""
    return df.filter(F.col("score") > 0) if "score" in df.columns else df


def remove_outliers(df: DataFrame, factor: float = 3.0) -> DataFrame:
    return positive_score(iqr_filter(df, "members", factor))


def clean_catalogue(raw: DataFrame, exact: bool = True) -> DataFrame:
    """Missing values, duplicates, normalisation, outliers, in this order."""
    return remove_outliers(normalize(remove_duplicates(handle_missing(raw, exact))))


def _kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read back, for what is read more than once."""
    spark = df.sparkSession
    path = stage_path(spark, f"cleaning-{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cleaning_report(raw: DataFrame) -> DataFrame:
    """Rows before / after / removed per cleaning step.  Every step runs
    once: its rows are written and the next step reads them."""
    spark = raw.sparkSession
    s1 = _kept(handle_missing(raw), "missing")
    s2 = _kept(remove_duplicates(s1), "duplicates")
    rows = [_scalar(df, F.count(F.lit(1))) for df in (raw, s1, s2, remove_outliers(normalize(s2)))]
    steps = spark.createDataFrame([(1, "missing_values"), (2, "duplicates"), (3, "outliers")], "step_no int, step string")
    before = F.when(F.col("step_no") == 1, rows[0]).when(F.col("step_no") == 2, rows[1]).otherwise(rows[2])
    after = F.when(F.col("step_no") == 1, rows[1]).when(F.col("step_no") == 2, rows[2]).otherwise(rows[3])
    return (steps.withColumn("rows_before", before).withColumn("rows_after", after)
            .withColumn("rows_removed", F.col("rows_before") - F.col("rows_after")))


# ---------------------------------------------------------------- ratings

def ratings_known_items(ratings: DataFrame, catalogue: DataFrame, item_col: str = "item_id") -> DataFrame:
    """Keep ratings whose item is in the catalogue (semi join; Spark
    broadcasts the id set only when its measured size allows)."""
    return ratings.join(catalogue.select(F.col(item_col).alias("item_id")).distinct(), "item_id", "left_semi")


def ratings_valid(ratings: DataFrame) -> DataFrame:
    """Rating in 1..10, or 0 (watching)."""
    r = F.col("rating")
    return ratings.filter(((r >= 1) & (r <= 10)) | (r == 0))


def ratings_keep_last(log: DataFrame, order_cols=EVENT_ORDER) -> DataFrame:
    """C14: one row per (user, item): the last event in the given order."""
    keep = [c for c in log.columns if c not in ("user_id", "item_id")]
    order = [c for c in order_cols if c in keep]
    # The greatest row, order columns first: every column travels once.
    agg = (log.groupBy("user_id", "item_id")
           .agg(F.max(F.struct(*order, *[c for c in keep if c not in order])).alias("_row")))
    return agg.select("user_id", "item_id", *[F.col(f"_row.{c}").alias(c) for c in keep])


def clean_ratings(log: DataFrame, catalogue: DataFrame) -> DataFrame:
    """C12 + C13 + C14 (D14: part of the pipeline here)."""
    return ratings_keep_last(ratings_valid(ratings_known_items(log, catalogue)))


def drop_watching(ratings: DataFrame) -> DataFrame:
    """C17: rating 0 means 'watching, not rated'."""
    return ratings.filter(F.col("rating") > 0)


def _min_count(ratings: DataFrame, key: str, n: int) -> DataFrame:
    keep = ratings.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= n).select(key)
    return ratings.join(keep, key, "left_semi")


def min_user_ratings(ratings: DataFrame, n: int = 5) -> DataFrame:
    """Users with at least n ratings."""
    return _min_count(ratings, "user_id", n)


def min_item_ratings(ratings: DataFrame, n: int = 10) -> DataFrame:
    """Items with at least n ratings (after C18, one pass: D12)."""
    return _min_count(ratings, "item_id", n)


def min_counts_stable(ratings: DataFrame, min_user: int = 5, min_item: int = 10) -> DataFrame:
    """D12 option: repeat C18 + C19 until nothing changes (every round drops
    rows, so it ends).  Lineage is cut every round with a reliable checkpoint."""
    cur = ratings.checkpoint()
    n = cur.count()
    while True:
        nxt = min_item_ratings(min_user_ratings(cur, min_user), min_item).checkpoint()
        m = nxt.count()
        cur = nxt
        if m == n:
            break
        n = m
    return cur


def sample_n(df: DataFrame, n: int, seed: int = 42, keys=("user_id", "item_id")) -> DataFrame:
    """Exactly n rows (or all), chosen by md5 of (keys, seed).

    The same n rows in every engine and under any partitioning.  At scale the
    rows are first cut to a hash share a little above n/rows (60 bits of the
    hash), and the exact n-th position is found with a distributed numbering.
    A cut that keeps fewer than n rows (many rows with equal keys) is undone.
    """
    h = md5_key(*keys, F.lit(str(seed)))
    total = df.count()
    if total <= n:
        return df
    share = min(1.0, (n + 6 * (n ** 0.5) + 100) / total)
    hashed = df.withColumn("_h", h)
    cand = hashed.filter(F.substring("_h", 1, 15) < F.lit(hex_threshold(share, 15)))
    if cand.count() < n:
        cand = hashed
    numbered = global_row_number(cand, [F.col("_h")] + [F.col(k) for k in keys], "_pos")
    return numbered.filter(F.col("_pos") <= n).drop("_h", "_pos")


def sample_ratings(ratings: DataFrame, sample_size: int | None = None, min_user: int = 5,
                   min_item: int = 10, seed: int = 42) -> DataFrame:
    """C20: drop watching, min counts (one pass), then an exact-n sample."""
    out = min_item_ratings(min_user_ratings(drop_watching(ratings), min_user), min_item)
    if sample_size is not None:
        # Counted, cut and numbered: the rows are written first.
        out = sample_n(_kept(out, "counted"), sample_size, seed)
    return out


def popular_ids(ratings: DataFrame, min_ratings: int = 100) -> DataFrame:
    return (ratings.groupBy("item_id").agg(F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") >= min_ratings).select("item_id"))


def popular_filter(catalogue: DataFrame, ratings: DataFrame, min_ratings: int = 100):
    """Keep items with >= min_ratings ratings, in both tables."""
    ids = popular_ids(ratings, min_ratings)
    return catalogue.join(ids, "item_id", "left_semi"), ratings.join(ids, "item_id", "left_semi")
