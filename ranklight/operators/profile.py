"""Aggregations and profiling.

Whole-table statistics are single ``agg`` passes (partial aggregation on
every task, one small merge).  Exact medians and quartiles (linear
interpolation) come from distributed ranks (``functions.percentiles``);
``exact=False`` switches to ``percentile_approx`` where a column has too many
distinct values for an exact pass.  Histograms and densities first reduce the
column to (value, count), so their size follows the number of distinct
values, not of rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklight.functions.columns import r6, strip_ws
from ranklight.functions.percentiles import exact_percentiles, percentile_map

NUMERIC = ("score", "episodes", "members", "favorites", "scored_by")


def _quantiles(df: DataFrame, col: str, ps, exact: bool = True):
    """The percentiles of a column as a scalar array."""
    if exact:
        return percentile_map(df, [col], ps)[col]
    return df.select(F.percentile_approx(col, list(ps), 10000).cast("array<double>")).scalar()


def catalogue_stats(cat: DataFrame) -> DataFrame:
    """A1: items, mean and median score, distinct (stripped) genres."""
    genres = cat.select(F.explode(F.transform(F.split("genres", ","), lambda x: strip_ws(x))).alias("g"))
    n_genres = genres.select(F.count_distinct("g")).scalar()
    median = _quantiles(cat, "score", [0.5])[0]
    return (cat.agg(F.count(F.lit(1)).alias("n_items"), r6(F.avg("score")).alias("mean_score"))
            .withColumn("median_score", r6(median)).withColumn("n_genres", n_genres))


def type_counts(cat: DataFrame) -> DataFrame:
    """A1 part: items per type."""
    return cat.groupBy("type").agg(F.count(F.lit(1)).alias("n"))


def ratings_stats(r: DataFrame, exact: bool = True) -> DataFrame:
    """A2: rows, distinct users and items, mean, median, sparsity 1 - rows/(U*I)."""
    cd = F.count_distinct if exact else F.approx_count_distinct
    s = r.agg(F.count(F.lit(1)).alias("n_ratings"), cd("user_id").alias("n_users"), cd("item_id").alias("n_items"),
              r6(F.avg("rating")).alias("mean_rating"))
    s = s.withColumn("median_rating", r6(_quantiles(r, "rating", [0.5], exact)[0]))
    return s.withColumn("sparsity", r6(1 - F.col("n_ratings") / (F.col("n_users") * F.col("n_items"))))


def dataset_summary(cat: DataFrame, r: DataFrame) -> DataFrame:
    """A3: A1 + A2 with min/max and the sorted list of types."""
    c = cat.agg(F.count(F.lit(1)).alias("n_items"), r6(F.min("score")).alias("min_score"),
                r6(F.max("score")).alias("max_score"), r6(F.avg("score")).alias("mean_score"),
                F.sort_array(F.collect_set("type")).alias("types"))
    rs = r.agg(F.count(F.lit(1)).alias("n_ratings"), F.count_distinct("user_id").alias("n_users"),
               F.min("rating").alias("min_rating"), F.max("rating").alias("max_rating"),
               r6(F.avg("rating")).alias("mean_rating"))
    s = rs.select(F.struct(*rs.columns)).scalar()
    return c.select("*", *[s.getField(x).alias(x) for x in rs.columns])


def genre_counts(cat: DataFrame, top_n: int | None = 20) -> DataFrame:
    """A4: split, strip, count per genre, top-n (ties by genre)."""
    g = (cat.select(F.explode(F.transform(F.split("genres", ","), lambda x: strip_ws(x))).alias("genre"))
         .groupBy("genre").agg(F.count(F.lit(1)).alias("n")))
    return g.orderBy(F.col("n").desc(), "genre").limit(top_n) if top_n else g


def distinct_genres(cat: DataFrame, raw: bool = False) -> DataFrame:
    """A5: number of distinct genres.  ``raw=True`` is the reference's count:
    untrimmed pieces, a missing genre text counting as one value (D4)."""
    if raw:
        g = cat.select(F.explode_outer(F.split("genres", ",")).alias("g"))
        return g.agg((F.count_distinct("g") + F.max(F.col("g").isNull().cast("int"))).alias("n_genres"))
    g = cat.select(F.explode(F.transform(F.split("genres", ","), lambda x: strip_ws(x))).alias("g"))
    return g.agg(F.count_distinct("g").alias("n_genres"))


def type_distribution(cat: DataFrame) -> DataFrame:
    """Count and percent per type (total by scalar subquery, not an
    unpartitioned window)."""
    total = cat.select(F.count(F.lit(1))).scalar()
    return (cat.groupBy("type").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("percent", r6(F.col("n") * 100.0 / total)))


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Equal-width bins from min to max; the max falls in the last bin;
    empty bins are reported with 0."""
    v = df.select(F.col(col).cast("double").alias("v")).filter(F.col("v").isNotNull())
    mm = v.select(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi"))).scalar()
    lo, hi = mm.getField("lo"), mm.getField("hi")
    width = F.when(hi > lo, (hi - lo) / bins).otherwise(F.lit(1.0))
    counted = (v.groupBy("v").agg(F.count(F.lit(1)).alias("c"))
               .withColumn("bin", F.least(F.floor((F.col("v") - lo) / width).cast("int"), F.lit(bins - 1)))
               .groupBy("bin").agg(F.sum("c").alias("n")))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (grid.join(counted, "bin", "left").fillna({"n": 0})
            .select("bin", r6(lo + F.col("bin") * width).alias("bin_start"),
                    r6(lo + (F.col("bin") + 1) * width).alias("bin_end"), F.col("n").cast("long").alias("n")))


def density(df: DataFrame, col: str, points: int = 100) -> DataFrame:
    """Gaussian kernel density on `points` grid points from min to max,
    bandwidth by Scott's rule (sigma * n^(-1/5), sample sigma).

    The column is reduced to (value, count) first; each distinct value then
    contributes to every grid point (a fixed fan-out of `points`).
    """
    v = df.select(F.col(col).cast("double").alias("v")).filter(F.col("v").isNotNull())
    st = v.select(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count(F.lit(1)).alias("n"),
                           F.stddev_samp("v").alias("sd"))).scalar()
    lo, hi, n, sd = st.getField("lo"), st.getField("hi"), st.getField("n"), st.getField("sd")
    h = sd * F.pow(n.cast("double"), F.lit(-0.2))
    step = F.when(F.lit(points) > 1, (hi - lo) / (points - 1)).otherwise(F.lit(0.0))
    counts = v.groupBy("v").agg(F.count(F.lit(1)).alias("c"))
    contrib = (counts.select("v", "c", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
               .withColumn("x", lo + F.col("i") * step)
               .withColumn("k", F.col("c") * F.exp(-0.5 * F.pow((F.col("x") - F.col("v")) / h, 2))))
    norm = n * h * math.sqrt(2 * math.pi)
    return (contrib.groupBy("i", "x").agg(F.sum("k").alias("s"))
            .select("i", r6("x").alias("x"), r6(F.col("s") / norm).alias("density")))


def column_stats(df: DataFrame, col: str, exact: bool = True) -> DataFrame:
    """Mean, median, std (n-1), min, max, Q1, Q3."""
    c = F.col(col)
    q = _quantiles(df, col, [0.25, 0.5, 0.75], exact)
    s = df.agg(r6(F.avg(c)).alias("mean"), r6(F.stddev_samp(c)).alias("std"), r6(F.min(c)).alias("min"),
               r6(F.max(c)).alias("max"))
    return s.select("mean", r6(q[1]).alias("median"), "std", "min", "max", r6(q[0]).alias("q1"), r6(q[2]).alias("q3"))


def box_stats(df: DataFrame, col: str) -> DataFrame:
    """A10: quartiles, whiskers at 1.5 IQR (most extreme values inside),
    outlier count."""
    qs = _quantiles(df, col, [0.25, 0.5, 0.75])
    q1, med, q3 = qs[0], qs[1], qs[2]
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    c = F.col(col)
    return df.agg(r6(F.first(q1)).alias("q1"), r6(F.first(med)).alias("median"), r6(F.first(q3)).alias("q3"),
                  r6(F.min(F.when(c >= lo, c))).alias("whisker_low"), r6(F.max(F.when(c <= hi, c))).alias("whisker_high"),
                  F.count(F.when((c < lo) | (c > hi), 1)).alias("outliers"))


def describe(df: DataFrame, cols=NUMERIC) -> DataFrame:
    """Count, mean, std, min, quartiles, max per numeric column.
    Long form via ``unpivot`` and one grouped pass, joined with the quartiles."""
    cols = [c for c in cols if c in df.columns]
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], cols, "column", "value")
    v = F.col("value")
    s = long.groupBy("column").agg(
        F.count(v).alias("count"), r6(F.avg(v)).alias("mean"), r6(F.stddev_samp(v)).alias("std"),
        r6(F.min(v)).alias("min"), r6(F.max(v)).alias("max"))
    q = exact_percentiles(df, cols, [0.25, 0.5, 0.75])
    return s.join(q, "column").select("column", "count", "mean", "std", "min", r6(F.col("q")[0]).alias("p25"),
                                      r6(F.col("q")[1]).alias("p50"), r6(F.col("q")[2]).alias("p75"), "max")


def missing_report(df: DataFrame) -> DataFrame:
    """Null count and percent per column, only > 0, largest first."""
    total = F.count(F.lit(1))
    wide = df.agg(total.alias("_n"), *[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in df.columns])
    long = wide.unpivot(["_n"], list(df.columns), "column", "missing")
    return (long.filter(F.col("missing") > 0)
            .select("column", "missing", r6(F.col("missing") * 100.0 / F.col("_n")).alias("percent")))


def schema_report(df: DataFrame) -> DataFrame:
    """Columns, types and non-null counts."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    long = counts.unpivot([], list(df.columns), "column", "non_null")
    # The schema itself is plan metadata (one row per column), not data.
    types = df.sparkSession.createDataFrame([(f.name, f.dataType.simpleString()) for f in df.schema.fields],
                                            "column string, type string")
    return long.join(F.broadcast(types), "column").select("column", "type", "non_null")


def correlation_matrix(df: DataFrame, cols=NUMERIC, listwise: bool = False) -> DataFrame:
    """A14 (pairwise complete) / A15 (listwise): Pearson r for every pair,
    in one aggregate, long form (a, b, r)."""
    cols = [c for c in cols if c in df.columns]
    d = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    if listwise:
        d = d.dropna()
    aggs = [F.corr(a, b).alias(f"{a}__{b}") for i, a in enumerate(cols) for b in cols[i:]]
    wide = d.agg(*aggs)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    arr = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"{a}__{b}").alias("r"))
                    for a, b in pairs])
    up = wide.select(F.explode(arr).alias("x")).select("x.*")
    # Mirror the off-diagonal half so the matrix is complete.
    low = up.filter(F.col("a") != F.col("b")).select(F.col("b").alias("a"), F.col("a").alias("b"), "r")
    return up.unionByName(low).select("a", "b", r6("r").alias("r"))


def strong_pairs(corr: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Upper-triangle pairs with |r| > threshold (column order)."""
    return corr.filter((F.col("a") < F.col("b")) & (F.abs("r") > threshold))


def popularity_vs_quality(cat: DataFrame, x: str = "members", y: str = "score", cut: float = 0.3) -> DataFrame:
    """Correlation with a verdict label."""
    r = F.corr(F.col(x).cast("double"), F.col(y).cast("double"))
    return cat.agg(r6(r).alias("r")).withColumn(
        "verdict", F.when(F.col("r") > cut, "positive").when(F.col("r") < -cut, "negative").otherwise("weak"))


def top_genre_share(cat: DataFrame, top: int = 3) -> DataFrame:
    """Share of the top genres among all genre tags."""
    g = genre_counts(cat, None)
    total = g.select(F.sum("n")).scalar()
    return (g.orderBy(F.col("n").desc(), "genre").limit(top)
            .agg(r6(F.sum("n") / total).alias("share"), F.sort_array(F.collect_list("genre")).alias("genres")))


def matrix_sparsity(r: DataFrame) -> DataFrame:
    """Share of empty cells of the user x item matrix; a stored 0
    counts as empty, duplicates count once (D13)."""
    nz = r.filter(F.col("rating") != 0).select("user_id", "item_id").distinct()
    ui = r.select(F.struct(F.count_distinct("user_id").alias("u"), F.count_distinct("item_id").alias("i"))).scalar()
    u, i = ui.getField("u"), ui.getField("i")
    return nz.agg(F.count(F.lit(1)).alias("filled")).select(
        "filled", u.alias("n_users"), i.alias("n_items"),
        r6(1 - F.col("filled") / (u * i)).alias("sparsity"))


def releases_per_year(cat: DataFrame) -> DataFrame:
    """Items per premiere year (from the season text)."""
    y = F.regexp_extract("premiered", r"(\d{4})", 1)
    return (cat.select(F.nullif(y, F.lit("")).cast("int").alias("year")).filter(F.col("year").isNotNull())
            .groupBy("year").agg(F.count(F.lit(1)).alias("n")))


def most_active_users(r: DataFrame, top_n: int = 50) -> DataFrame:
    """Users with the most ratings (ties by id)."""
    return (r.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_ratings"))
            .orderBy(F.col("n_ratings").desc(), "user_id").limit(top_n))


def profile_all(cat: DataFrame) -> dict[str, DataFrame]:
    """The profile tables of the catalogue, each a lazy DataFrame."""
    return {"genre_counts": genre_counts(cat), "type_distribution": type_distribution(cat),
            "score_histogram": histogram(cat, "score"), "correlation": correlation_matrix(cat),
            "top_score": cat.orderBy(F.col("score").desc_nulls_last(), "item_id").limit(20),
            "top_members": cat.orderBy(F.col("members").desc_nulls_last(), "item_id").limit(20)}
