"""Top-k per group.

``row_number() over (partition by g order by ...) <= k`` is planned by Spark
(3.5+) with a WindowGroupLimit before the shuffle as well as after it, so
every map task keeps at most k rows per group and a group holding a third
of all rows still sends only k rows per map partition to its reducer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_k_per_group(df: DataFrame, group_cols: list, order_cols: list, k: int | None,
                    rank_col: str = "rank", salt: int = 0) -> DataFrame:
    """Keep the first k rows of each group under ``order_cols`` (a total
    order: end it with a unique key) and number them 1..k in ``rank_col``.

    When the input is already clustered by the group (e.g. it comes out of a
    join on that key) Spark adds no exchange and hence no partial limit, so
    one hot group would be sorted whole in one task.  ``salt`` > 0 then
    splits every group into ``salt`` parts by a hash of the row: top k per
    part first (after an explicit exchange on (group, part)), then top k of
    those <= salt * k rows per group.  The result is the same.
    """
    if salt and k is not None:
        part = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salt))
        salted = df.withColumn("_part", part).repartition(*[F.col(g) if isinstance(g, str) else g
                                                            for g in group_cols], F.col("_part"))
        w1 = Window.partitionBy(*group_cols, "_part").orderBy(*order_cols)
        df = salted.withColumn("_r1", F.row_number().over(w1)).filter(F.col("_r1") <= k).drop("_r1", "_part")
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    out = df.withColumn(rank_col, F.row_number().over(w))
    if k is not None:
        out = out.filter(F.col(rank_col) <= k)
    return out


# Parts per group for top-k over inputs clustered by the group key.
SKEW_SALT = 16
