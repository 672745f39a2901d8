"""Session helpers.

Library code never creates its own session; these helpers are for tests,
``bench.py`` and ``__spark_entry__.py``.  The checkpoint folder is read from
``spark.checkpoint.dir``; a private folder is only made when the setting is
absent and the master is local (tests, bench).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "catspark") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    A private folder is made only for a local master (tests, bench): every
    other cluster has to name a folder that all executors share.
    """
    current = spark.conf.get(CHECKPOINT_CONF, None)
    if not current:
        if not spark.conf.get("spark.master", "").startswith("local["):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="catspark-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, current)
    spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder, read it back.

    Cuts lineage: what a lost executor held is read again, not computed again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)  # the shared folder is the scarce part
    return spark.read.schema(df.schema).parquet(path)
