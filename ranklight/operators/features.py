"""Feature engineering.

All scalar features are built-in column expressions (whole-stage codegen).
Column-wide constants (max popularity, max rank) are scalar subqueries; the
distributed id index (F9) is a sort plus per-partition offsets, never a
single-task window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklight.functions.columns import WORD_CLASS, season_number, strip_ws
from ranklight.functions.index import global_row_number

# The weighting of text fields in the two text features.
# (column, repetitions) in the order they are concatenated.
WEIGHTED_TEXT_FIELDS = (("genres", 3), ("type", 2), ("source", 1), ("studios", 2), ("producers", 1),
                        ("rating", 1), ("premiered", 1))
CONTENT_TEXT_FIELDS = (("genres", 2), ("type", 1), ("source", 1), ("studios", 1), ("rating", 1))


def text_features_weighted(cat: DataFrame) -> DataFrame:
    """fields repeated by weight, each followed by a blank; lower, strip,
    then everything but word characters and white space removed."""
    parts = []
    for c, times in WEIGHTED_TEXT_FIELDS:
        if c in cat.columns:
            parts.append(F.repeat(F.concat(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(" ")), times))
    text = F.concat(*parts) if parts else F.lit("")
    text = F.regexp_replace(strip_ws(F.lower(text)), f"[^{WORD_CLASS}\\s]", "")
    return cat.withColumn("text_features", text)


def text_features_content(cat: DataFrame) -> DataFrame:
    """genres twice, type, source, studios, rating joined by blanks;
    lower and strip, punctuation kept."""
    parts = []
    for c, times in CONTENT_TEXT_FIELDS:
        if c in cat.columns:
            v = F.coalesce(F.col(c).cast("string"), F.lit(""))
            parts.extend([v] * times)
    return cat.withColumn("content_text", strip_ws(F.lower(F.concat_ws(" ", *parts))))


def log_features(cat: DataFrame) -> DataFrame:
    """log1p of counts, null as 0."""
    for c in ("episodes", "members", "favorites", "scored_by"):
        if c in cat.columns:
            cat = cat.withColumn(f"{c}_log", F.log1p(F.coalesce(F.col(c).cast("double"), F.lit(0.0))))
    return cat


def inverse_rank(cat: DataFrame) -> DataFrame:
    """1 - x / max(x) for popularity and rank; null counts as the max."""
    for c in ("popularity", "rank"):
        if c in cat.columns:
            mx = cat.select(F.max(F.col(c)).cast("double")).scalar()
            cat = cat.withColumn(f"{c}_normalized", 1 - F.coalesce(F.col(c).cast("double"), mx) / mx)
    return cat


def score_scaled(cat: DataFrame) -> DataFrame:
    """score / 10, null as 0."""
    return cat.withColumn("score_normalized", F.coalesce(F.col("score"), F.lit(0.0)) / 10.0)


def numeric_features(cat: DataFrame) -> DataFrame:
    return score_scaled(inverse_rank(log_features(cat)))


def genre_long(cat: DataFrame, mode: str = "exact") -> DataFrame:
    """F6 long form: the ones of the item x genre matrix as (item_id, genre, 1).

    ``exact``: the item lists the genre; one row per listed genre, nothing
    else is read.  ``substring`` (D6 parity): the genre occurs
    case-insensitively anywhere in the item's genre text; the distinct genres
    (labels, the width of the matrix) reach every task as one scalar subquery.
    """
    lst = F.transform(F.split("genres", ","), lambda x: strip_ws(x))
    if mode != "substring":
        return cat.select("item_id", F.explode(F.array_distinct(lst)).alias("genre"), F.lit(1).alias("flag"))
    vocab = cat.select(F.explode(lst).alias("g")).agg(F.sort_array(F.collect_set("g"))).scalar()
    items = cat.select("item_id", "genres", F.explode(vocab).alias("genre"))
    return (items.where(F.lower(F.col("genres")).contains(F.lower(F.col("genre"))))
            .select("item_id", "genre", F.lit(1).alias("flag")))


def genre_onehot(cat: DataFrame, genres: list[str]) -> DataFrame:
    """F6 wide form for a known, sorted genre list: one 0/1 column each."""
    lst = F.transform(F.split("genres", ","), lambda x: strip_ws(x))
    return cat.select("item_id", *[F.array_contains(lst, g).cast("int").alias(f"genre_{g}") for g in genres])


def season_features(cat: DataFrame) -> DataFrame:
    """season word, 4-digit year as double, season number 1..4."""
    season = F.nullif(F.regexp_extract("premiered", r"(Spring|Summer|Fall|Winter)", 1), F.lit(""))
    year = F.nullif(F.regexp_extract("premiered", r"(\d{4})", 1), F.lit("")).cast("double")
    return (cat.withColumn("season", season).withColumn("year", year)
            .withColumn("season_numeric", season_number("season")))


def genre_set(cat: DataFrame) -> DataFrame:
    """F6 as one column: the sorted distinct genres of the item (the row's
    ones of the one-hot matrix; empty without genres)."""
    lst = F.array_sort(F.array_distinct(F.transform(F.split("genres", ","), lambda x: strip_ws(x))))
    return cat.withColumn("genre_set", F.coalesce(lst, F.array().cast("array<string>")))


def all_features(cat: DataFrame, text: bool = True, numeric: bool = True, time: bool = True,
                 genre: bool = True) -> DataFrame:
    """F8: the feature steps in order, each switchable.  Genres are added as
    sets; ``genre_onehot`` widens a known list of them."""
    out = cat
    if text:
        out = text_features_weighted(out)
    if genre:
        out = genre_set(out)
    if numeric:
        out = numeric_features(out)
    if time:
        out = season_features(out)
    return out


def user_item_index(ratings: DataFrame):
    """dense 0-based indexes for users and items, in id order, plus the
    ratings with both indexes.  Distributed numbering (sort + offsets)."""
    users = global_row_number(ratings.select("user_id").distinct(), [F.col("user_id")], "user_idx", start=0)
    items = global_row_number(ratings.select("item_id").distinct(), [F.col("item_id")], "item_idx", start=0)
    indexed = ratings.join(users, "user_id").join(items, "item_id")
    return users, items, indexed


def genre_tokens(cat: DataFrame) -> DataFrame:
    """genres split, stripped, lower-cased, inner blanks to '_'."""
    return cat.withColumn("genre_tokens", F.when(F.col("genres").isNotNull(), F.transform(
        F.split("genres", ","), lambda x: F.regexp_replace(F.lower(strip_ws(x)), " ", "_"))))
