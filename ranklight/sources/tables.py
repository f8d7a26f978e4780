"""The driver tables and the recommender tables derived from them.

The recommender works on a catalogue of items and a log of (user, item,
rating) events.  Both are derived from the TPC-H-like tables by fixed rules
(see FIXTURES.md, part C), always over the whole tables:

* ratings log: ``lineitem JOIN orders`` on the order key;
  user = customer, item = part, rating = quantity modulo 11 (0 = watching).
* catalogue: ``part`` enriched with per-item activity from the ratings log,
  with missing values, text placeholders and duplicate listings injected by
  rules on the part key, so that the cleaning operators have work to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ranklight.functions.columns import UNKNOWN, season_of
from ranklight.functions.index import global_row_number

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents "
                 "embeddings pages benchmark labels conversations").split()

# Fixed rules for the raw catalogue (the SQL oracle uses the same numbers).
# key % MOD == REM marks the row for the given defect.
RULE_SCORE_UNKNOWN = (7, 3)      # Score text 'Unknown'
RULE_EPISODES_UNKNOWN = (13, 6)  # Episodes text 'Unknown'
RULE_GENRES_NULL = (11, 2)       # Genres missing
RULE_TYPE_NULL = (17, 8)         # Type missing
RULE_NAME_NULL = (101, 50)       # Name missing: row is dropped in cleaning
RULE_DUP_ID = (9, 4)             # listed twice under the same id
RULE_DUP_NAME = (23, 5)          # listed again under a new id, name in upper case
SOURCE_BY_SIZE = ((10, "Manga"), (30, "Original"), (None, "Light novel"))
AGE_RATINGS = ("G - All Ages", "PG - Children", "PG-13 - Teens 13 or older",
               "R - 17+ (violence & profanity)")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, read lazily (column pruning and filters reach the scan)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ratings_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw ratings log with its event-order columns.

    Columns: user_id, item_id, rating (double, 0..10), event_ts, l_orderkey,
    l_linenumber, l_extendedprice, l_quantity.  The last five give each event
    a total order for keep-last dedup (the line key alone is not unique).
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .select(F.col("o_custkey").alias("user_id"),
                    F.col("l_partkey").alias("item_id"),
                    (F.col("l_quantity").cast("long") % 11).cast("double").alias("rating"),
                    F.col("l_shipdate").alias("event_ts"),
                    "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity"))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ratings log in the reference's three-column form."""
    return ratings_log(spark, sf_dir).select("user_id", "item_id", "rating")


def item_activity(log: DataFrame) -> DataFrame:
    """Per-item activity: one grouped pass with map-side partial aggregation."""
    return log.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("members"),
        F.count(F.when(F.col("rating") > 0, 1)).alias("scored_by"),
        F.count(F.when(F.col("rating") == 10, 1)).alias("favorites"),
        F.sum(F.when(F.col("rating") > 0, F.col("rating").cast("long"))).alias("sum_pos"),
        F.min("event_ts").alias("first_ts"))


def _score_centi() -> F.Column:
    # Mean positive rating in hundredths, rounded half up in integer
    # arithmetic, so every engine gets the same digits.
    return F.expr("(200 * sum_pos + scored_by) div (2 * scored_by)")


def _hit(key, rule) -> F.Column:
    mod, rem = rule
    return (key % mod) == rem


def catalogue_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw catalogue, as a CSV export of it would look.

    Score and Episodes are text with the placeholder 'Unknown'; some names,
    genres and types are missing; some items are listed twice (same id, or a
    new id with the name in another case).  ``src_row`` is the row's position
    in the export, which defines "first" for dedup.
    """
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    act = item_activity(ratings_log(spark, sf_dir))
    base = (part.join(act, part.p_partkey == act.item_id, "left")
            .withColumn("mean_rating", F.when(F.col("scored_by") > 0, _score_centi())))
    k = F.col("p_partkey")
    src = None
    for bound, word in SOURCE_BY_SIZE:
        cond = F.col("p_size") <= bound if bound is not None else F.lit(True)
        src = F.when(cond, word) if src is None else src.when(cond, word)
    age = F.element_at(F.array(*[F.lit(a) for a in AGE_RATINGS]),
                       (F.col("p_size") % len(AGE_RATINGS) + 1).cast("int"))
    base = base.select(
        k.alias("item_id"),
        F.when(_hit(k, RULE_NAME_NULL), F.lit(None).cast("string"))
         .otherwise(F.concat_ws(" ", "p_name", k.cast("string"))).alias("name"),
        F.when(_hit(k, RULE_SCORE_UNKNOWN) | F.col("mean_rating").isNull(), F.lit(UNKNOWN))
         .otherwise((F.col("mean_rating") / 100.0).cast("string")).alias("score"),
        F.when(_hit(k, RULE_GENRES_NULL), F.lit(None).cast("string"))
         .otherwise(F.concat_ws(", ", F.regexp_replace("p_name", " ", ", "), "p_type")).alias("genres"),
        F.when(_hit(k, RULE_TYPE_NULL), F.lit(None).cast("string")).otherwise(F.col("p_type")).alias("type"),
        F.when(_hit(k, RULE_EPISODES_UNKNOWN), F.lit(UNKNOWN))
         .otherwise(F.col("p_size").cast("string")).alias("episodes"),
        F.coalesce("members", F.lit(0)).alias("members"),
        F.coalesce("favorites", F.lit(0)).alias("favorites"),
        F.coalesce("scored_by", F.lit(0)).alias("scored_by"),
        src.alias("source"),
        F.col("p_brand").alias("studios"),
        F.concat(F.lit("Producer#"), (F.col("p_size") % 7).cast("string")).alias("producers"),
        age.alias("rating"),
        F.when(F.col("first_ts").isNotNull(),
               F.concat_ws(" ", season_of("first_ts"), F.year("first_ts").cast("string"))).alias("premiered"),
        F.col("p_name").alias("english_name"),
        F.col("mean_rating"),
        (k * 3).alias("src_row"))
    # Popularity: position by members (desc); Rank: position by mean rating
    # (desc) among rated items.  Distributed numbering, no single-task window.
    base = global_row_number(base, [F.col("members").desc(), F.col("item_id")], "popularity")
    rated = global_row_number(base.filter(F.col("mean_rating").isNotNull())
                              .select("item_id", "mean_rating"),
                              [F.col("mean_rating").desc(), F.col("item_id")], "rank").select("item_id", "rank")
    base = base.join(rated, "item_id", "left").drop("mean_rating")
    # Duplicate listings in one pass (no union re-reading the base): each
    # row explodes into its copies; copy 1 = same id, members + 1; copy 2 =
    # new id, name in upper case.
    iid = F.col("item_id")
    copies = F.array(F.lit(0),
                     F.when(_hit(iid, RULE_DUP_ID), F.lit(1)),
                     F.when(_hit(iid, RULE_DUP_NAME), F.lit(2)))
    out = base.withColumn("_copy", F.explode(F.filter(copies, lambda c: c.isNotNull())))
    c = F.col("_copy")
    out = (out.withColumn("members", F.when(c == 1, F.col("members") + 1).otherwise(F.col("members")))
              .withColumn("name", F.when(c == 2, F.upper("name")).otherwise(F.col("name")))
              .withColumn("item_id", F.when(c == 2, -iid - 1).otherwise(iid))
              .withColumn("src_row", F.col("src_row") + c))
    return out.select(*CATALOGUE_COLUMNS)


CATALOGUE_COLUMNS = ["item_id", "name", "score", "genres", "type", "episodes", "members",
                     "favorites", "scored_by", "source", "studios", "producers", "rating",
                     "premiered", "english_name", "popularity", "rank", "src_row"]
