"""Session helpers: a local session for tests/bench and checkpoint-dir handling."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "taxaframe") -> SparkSession:
    """Session used by tests and bench.py. On a cluster, use the session you are given."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.optimizer.runtime.bloomFilter.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins; a private folder is only created when the
    setting is absent (local tests).
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set; on a cluster it has to name a shared folder")
        configured = tempfile.mkdtemp(prefix="taxaframe-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back: a table for several uses, and a short lineage."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables-{uuid.uuid4().hex}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
