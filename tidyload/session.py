"""Session helpers: a local session for tests/bench, and the shared checkpoint
folder (``spark.checkpoint.dir``) used for lineage cuts and written tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# A whole-stage-codegen method that fuses a view and several staged
# projections can exceed the JVM's 8000-byte JIT limit and would then run in
# the bytecode interpreter; this lets the JIT compile it (set the same in the
# cluster's spark-defaults for drivers and executors).
JIT_HUGE_METHODS = "-XX:-DontCompileHugeMethods"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tidyload") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.files.maxPartitionBytes", "16m")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.extraJavaOptions", JIT_HUGE_METHODS)
        .config("spark.executor.extraJavaOptions", JIT_HUGE_METHODS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``; only when it is unset (local tests) set our own."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tidyload-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A fresh location under the shared checkpoint folder for written tables."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, "tables", *parts, uuid.uuid4().hex)


def written(df: DataFrame) -> DataFrame:
    """Write a frame once into the shared folder and read it back: cuts lineage,
    keeps columns prunable and survives executor loss."""
    path = shared_path(df.sparkSession, "written")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
