"""Catalogue queries: filter, sort, top-k.

Top-n over the whole catalogue is ``orderBy(...).limit(n)``, planned as a
TakeOrderedAndProject: every task keeps its n best rows, one merge of
n x tasks rows.  Ties always break by item id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklight.functions.columns import strip_ws


def _order(metric: str):
    return [F.col(metric).desc_nulls_last(), F.col("item_id")]


def discover(cat: DataFrame, min_score: float = 0.0, item_type: str | None = None,
             sort_by: str = "score", top_n: int = 20) -> DataFrame:
    """Q1: score >= x, optional type, top-n by the chosen column."""
    df = cat.filter(F.col("score") >= min_score)
    if item_type:
        df = df.filter(F.col("type") == item_type)
    return df.orderBy(*_order(sort_by)).limit(top_n)


def genre_any(cat: DataFrame, genres: list[str], mode: str = "exact") -> DataFrame:
    """Q2: any of the genres occurs.  ``exact``: list membership;
    ``substring``: case-sensitive substring of the genre text (parity)."""
    if mode == "substring":
        cond = None
        for g in genres:
            c = F.col("genres").contains(g)
            cond = c if cond is None else (cond | c)
        return cat.filter(cond)
    wanted = F.array(*[F.lit(g) for g in genres])
    return cat.filter(F.arrays_overlap("genres_list", wanted))


def genre_all(cat: DataFrame, genres: list[str], mode: str = "exact") -> DataFrame:
    """Q3: all of the genres occur."""
    if mode == "substring":
        cond = None
        for g in genres:
            c = F.col("genres").contains(g)
            cond = c if cond is None else (cond & c)
        return cat.filter(cond)
    wanted = F.array(*[F.lit(g) for g in genres])
    return cat.filter(F.size(F.array_except(wanted, F.col("genres_list"))) == 0)


def popular(cat: DataFrame, min_members: float = 0, top_n: int = 20) -> DataFrame:
    """Q4: members >= m, top-n by members."""
    return cat.filter(F.col("members") >= min_members).orderBy(*_order("members")).limit(top_n)


def top_by_metric(cat: DataFrame, metric: str = "score", top_n: int = 20) -> DataFrame:
    """Q5: top-n by a metric, nulls last."""
    return cat.orderBy(*_order(metric)).limit(top_n)


def type_list(cat: DataFrame) -> DataFrame:
    """Q6: sorted distinct types."""
    return cat.select("type").distinct().orderBy("type")


def first_genres(cat: DataFrame, n: int = 5) -> DataFrame:
    """Q7: the first n stripped genres of each item."""
    return cat.select("item_id", F.slice(F.transform(F.split("genres", ","), lambda x: strip_ws(x)), 1, n)
                      .alias("first_genres"))


def item_summary(cat: DataFrame) -> DataFrame:
    """Q8: one formatted text line per item."""
    line = F.format_string("%s | Score: %.2f/10 | Genres: %s | Type: %s | Episodes: %d | Members: %d",
                           F.col("name"), F.col("score"), F.coalesce("genres", F.lit("N/A")),
                           F.coalesce("type", F.lit("N/A")), F.col("episodes").cast("long"),
                           F.col("members").cast("long"))
    return cat.select("item_id", line.alias("summary"))


def name_search(cat: DataFrame, query: str) -> DataFrame:
    """Q9: case-insensitive substring search on the name."""
    return cat.filter(F.lower("name").contains(query.lower()))


def episodes_at_most(cat: DataFrame, n: float = 50) -> DataFrame:
    """Q10: items with at most n episodes."""
    return cat.filter(F.col("episodes") <= n)
