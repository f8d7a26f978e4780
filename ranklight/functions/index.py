"""Dense global numbering without a single-partition window.

``row_number() over (order by ...)`` without a partition key pulls every row
into one task.  Here the rows are range-partitioned and sorted by the global
order (a normal distributed sort), each partition counts its rows, the small
per-partition count table (one row per partition, so its size is bounded by
the partition count, not the data) gives each partition its offset, and the
position inside the partition comes from ``monotonically_increasing_id``,
whose low 33 bits are the record number inside the task.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ranklight.session import stage_path


def global_row_number(df: DataFrame, order_cols: list, out: str = "row_num",
                      start: int = 1) -> DataFrame:
    """Add ``out`` = position of the row under ``order_cols`` (start-based).

    ``order_cols`` must be a total order (end with a unique key) so the result
    is deterministic and recomputation after an executor loss gives the same
    numbers.
    """
    sorted_df = (df.orderBy(*order_cols)
                 .withColumn("_rl_pid", F.spark_partition_id())
                 .withColumn("_rl_pos", F.monotonically_increasing_id()
                             - F.shiftleft(F.spark_partition_id().cast("long"), 33)))
    # Written once: both uses below read the same numbers, whatever is lost.
    path = stage_path(df.sparkSession, f"numbering-{uuid.uuid4().hex[:12]}")
    sorted_df.write.parquet(path)
    sorted_df = df.sparkSession.read.schema(sorted_df.schema).parquet(path)
    counts = sorted_df.groupBy("_rl_pid").agg(F.count(F.lit(1)).alias("_rl_n"))
    # Offsets over at most #partitions rows: a one-task window is fine here.
    offsets = counts.select(
        "_rl_pid",
        (F.sum("_rl_n").over(Window.orderBy("_rl_pid")) - F.col("_rl_n")).alias("_rl_off"))
    return (sorted_df.join(F.broadcast(offsets), "_rl_pid")
            .withColumn(out, (F.col("_rl_off") + F.col("_rl_pos") + F.lit(start)).cast("long"))
            .drop("_rl_pid", "_rl_pos", "_rl_off"))
