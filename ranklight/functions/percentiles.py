"""Exact percentiles of whole columns without a single large task.

``percentile`` merges all distinct values of a column in one task.  Here the
columns are reduced to (column, value, count), range-partitioned by value and
written with their partition numbers; counts per partition (a small table)
give each partition its offset, and a running count inside the partitions
gives every value the ranks it holds.  A percentile is one or two of those
ranks, interpolated linearly.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ranklight.session import stage_path


def exact_percentiles(df: DataFrame, cols, ps) -> DataFrame:
    """(column, q): for each of ``cols`` the array of its percentiles ``ps``
    (0 to 1), nulls left out; elements are null for a column without values."""
    spark = df.sparkSession
    cols, ps = list(cols), [float(p) for p in ps]
    long = (df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "column", "v")
            .where("v is not null").groupBy("column", "v").agg(F.count(F.lit(1)).alias("n")))
    path = stage_path(spark, f"percentiles-{uuid.uuid4().hex[:12]}")
    long.orderBy("column", "v").withColumn("pid", F.spark_partition_id()).write.parquet(path)
    dealt = spark.read.schema("column string, v double, n long, pid int").parquet(path)
    sums = dealt.groupBy("column", "pid").agg(F.sum("n").alias("n"))
    wp = Window.partitionBy("column").orderBy("pid")
    ahead = sums.select("column", "pid", (F.sum("n").over(wp) - F.col("n")).alias("ahead"),
                        F.sum("n").over(Window.partitionBy("column")).alias("total"))
    w = Window.partitionBy("column", "pid").orderBy("v")
    ranks = dealt.withColumn("run", F.sum("n").over(w)).join(F.broadcast(ahead), ["column", "pid"])
    after = F.col("ahead") + F.col("run")  # ranks below this one lie at or before the value
    out = []
    for i, p in enumerate(ps):
        pos = (F.col("total") - 1) * F.lit(p)
        out += [F.min(F.when(after > F.floor(pos), F.col("v"))).alias(f"lo{i}"),
                F.min(F.when(after > F.ceil(pos), F.col("v"))).alias(f"hi{i}")]
    found = ranks.groupBy("column", "total").agg(*out)
    between = []
    for i, p in enumerate(ps):
        pos = (F.col("total") - 1) * F.lit(p)
        part = pos - F.floor(pos)
        between.append(F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * part)
    names = spark.createDataFrame([(c,) for c in cols], "column string")
    return F.broadcast(names).join(found.select("column", F.array(*between).alias("q")), "column", "left") \
        .select("column", F.coalesce("q", F.array(*[F.lit(None).cast("double")] * len(ps))).alias("q"))


def percentile_map(df: DataFrame, cols, ps) -> Column:
    """A scalar map from column name to its percentiles, computed once."""
    q = exact_percentiles(df, cols, ps)
    return q.select(F.map_from_entries(F.collect_list(F.struct("column", "q")))).scalar()
