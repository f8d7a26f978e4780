"""Session construction and cluster-facing settings."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on.  Shuffle partitions are a starting point only:
# AQE coalesces small partitions and splits skewed ones at run time.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Files are split into ~128 MB input partitions; at 100 TB that is
    # ~800k scan tasks, which the scheduler handles in waves.
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    # Python tasks (block products) run one per core: one BLAS thread each,
    # or every task would start a thread per core and oversubscribe.
    "spark.executorEnv.OPENBLAS_NUM_THREADS": "1",
    "spark.executorEnv.OMP_NUM_THREADS": "1",
    "spark.executorEnv.MKL_NUM_THREADS": "1",
}


def get_session(master: str | None = None, app_name: str = "ranklight",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Return the active session or build one with the default settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # Local mode runs every task in the driver JVM.
            builder = builder.config("spark.driver.memory", os.environ.get("RANKLIGHT_DRIVER_MEMORY", "8g"))
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and stage tables.

    A cluster names it in ``spark.checkpoint.dir``; that setting is always
    used when present.  Where it is unset, a local session (tests) gets a
    scratch folder under the system temp folder; on a cluster that folder
    would not be shared, so it raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf = tempfile.mkdtemp(prefix="ranklight-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf)
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def stage_path(spark: SparkSession, name: str) -> str:
    """A path for a written stage table inside the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "stages", name)


def drop_stages(spark: SparkSession) -> None:
    """Delete the stage tables and numberings this application has written.
    DataFrames that still read them become unusable."""
    from ranklight.plans.stages import forget
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(os.path.join(checkpoint_dir(spark), "stages"))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    forget()
