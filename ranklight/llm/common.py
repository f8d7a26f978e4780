"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ranklight.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, an expensive stage is
    computed once, and later joins see the table's true size.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of rows handed to Python at a time: texts and pages are long rows.
BATCH_BYTES = 8 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def prepare(df: DataFrame, *cols: str) -> None:
    """Raise ValueError when a needed column is absent; bound the batches that
    Python tasks of this session get (a lower setting stays)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    conf = df.sparkSession.conf
    now = conf.get(_BATCH_CONF).rstrip("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        conf.set(_BATCH_CONF, f"{BATCH_BYTES}b")
