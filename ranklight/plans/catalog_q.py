"""Catalogue browsing queries (Q1-Q10) on the cleaned catalogue."""

from __future__ import annotations

from pyspark.sql import functions as F

from ranklight.operators import catalog
from ranklight.plans import stages
from ranklight.plans.registry import register
from ranklight.plans.stages import CAT_CTES, ctes

CAT = ctes(CAT_CTES)


@register("discover", CAT + """
SELECT item_id, name, score, type, members FROM catalogue WHERE score >= 5.0 AND type = 'SMALL'
ORDER BY score DESC NULLS LAST, item_id LIMIT 20""")
def discover(spark, sf):
    """Q1: score >= 5, type SMALL, top 20 by score."""
    return catalog.discover(stages.catalogue(spark, sf), 5.0, "SMALL", "score", 20) \
        .select("item_id", "name", "score", "type", "members")


@register("genre_any", CAT + """
SELECT item_id, genres FROM catalogue WHERE list_has_any(genres_list, ['gear', 'widget'])""")
def genre_any(spark, sf):
    """Q2: items with genre 'gear' or 'widget'."""
    return catalog.genre_any(stages.catalogue(spark, sf), ["gear", "widget"]).select("item_id", "genres")


@register("genre_any_substring", CAT + """
SELECT item_id, genres FROM catalogue WHERE contains(genres, 'ge') OR contains(genres, 'SMALL')""")
def genre_any_substring(spark, sf):
    """Q2, parity mode: case-sensitive substring match."""
    return catalog.genre_any(stages.catalogue(spark, sf), ["ge", "SMALL"], "substring").select("item_id", "genres")


@register("genre_all", CAT + """
SELECT item_id, genres FROM catalogue WHERE list_has_all(genres_list, ['small', 'gear'])""")
def genre_all(spark, sf):
    """Q3: items with both 'small' and 'gear'."""
    return catalog.genre_all(stages.catalogue(spark, sf), ["small", "gear"]).select("item_id", "genres")


@register("popular", CAT + """
SELECT item_id, name, members FROM catalogue WHERE members >= 25 ORDER BY members DESC NULLS LAST, item_id LIMIT 20""")
def popular(spark, sf):
    """Q4: members >= 25, top 20 by members."""
    return catalog.popular(stages.catalogue(spark, sf), 25, 20).select("item_id", "name", "members")


@register("top_by_favorites", CAT + """
SELECT item_id, favorites FROM catalogue ORDER BY favorites DESC NULLS LAST, item_id LIMIT 15""")
def top_by_favorites(spark, sf):
    """Q5: top 15 by favorites."""
    return catalog.top_by_metric(stages.catalogue(spark, sf), "favorites", 15).select("item_id", "favorites")


@register("type_list", CAT + "SELECT DISTINCT type FROM catalogue ORDER BY type")
def type_list(spark, sf):
    """Q6: distinct types, sorted."""
    return catalog.type_list(stages.catalogue(spark, sf))


@register("first_genres", CAT + """
SELECT item_id, list_transform(string_split(genres, ','), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g'))[1:5]
  AS first_genres FROM catalogue""")
def first_genres(spark, sf):
    """Q7: first five genres of every item."""
    return catalog.first_genres(stages.catalogue(spark, sf))


@register("item_summary", CAT + """
SELECT item_id, printf('%s | Score: %.2f/10 | Genres: %s | Type: %s | Episodes: %d | Members: %d',
                       name, score, coalesce(genres, 'N/A'), coalesce(type, 'N/A'),
                       CAST(episodes AS BIGINT), CAST(members AS BIGINT)) AS summary FROM catalogue""")
def item_summary(spark, sf):
    """Q8: a formatted line per item."""
    return catalog.item_summary(stages.catalogue(spark, sf))


@register("name_search", CAT + "SELECT item_id, name FROM catalogue WHERE contains(lower(name), 'blue gear')")
def name_search(spark, sf):
    """Q9: names containing 'Blue Gear' (any case)."""
    return catalog.name_search(stages.catalogue(spark, sf), "Blue Gear").select("item_id", "name")


@register("episodes_at_most", CAT + "SELECT count(*) AS n, round(avg(episodes), 6) AS mean_episodes FROM catalogue WHERE episodes <= 20")
def episodes_at_most(spark, sf):
    """Q10: the subset with at most 20 episodes."""
    df = catalog.episodes_at_most(stages.catalogue(spark, sf), 20)
    return df.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("episodes"), 6).alias("mean_episodes"))


_GENRES = "regexp_replace(x, '^\\s+|\\s+$', '', 'g')"


@register("discover_page", CAT + f""", top AS (
  SELECT item_id, name, score, type FROM catalogue WHERE score >= 5.0 ORDER BY score DESC NULLS LAST, item_id LIMIT 20)
SELECT *, (SELECT count(*) FROM catalogue) AS n_items, (SELECT round(avg(score), 6) FROM catalogue) AS mean_score,
       (SELECT count(DISTINCT g) FROM (SELECT unnest(list_transform(string_split(genres, ','), lambda x: {_GENRES})) AS g
                                       FROM catalogue)) AS n_genres,
       (SELECT count(DISTINCT type) FROM catalogue) AS n_types FROM top""")
def discover_page(spark, sf):
    """Header figures and the top-20 discover list (score >= 5)."""
    from ranklight.plans import jobs
    return jobs.discover_page(spark, sf)


@register("top_by_score", CAT + """
SELECT item_id, score FROM catalogue ORDER BY score DESC NULLS LAST, item_id LIMIT 15""")
def top_by_score(spark, sf):
    """Q5: top 15 by score."""
    return catalog.top_by_metric(stages.catalogue(spark, sf), "score", 15).select("item_id", "score")


@register("top_by_members", CAT + """
SELECT item_id, members FROM catalogue ORDER BY members DESC NULLS LAST, item_id LIMIT 15""")
def top_by_members(spark, sf):
    """Q5: top 15 by members."""
    return catalog.top_by_metric(stages.catalogue(spark, sf), "members", 15).select("item_id", "members")
