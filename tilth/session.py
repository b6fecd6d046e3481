"""Session helpers: building a session for tests/bench and locating shared scratch space.

Lineage is cut with ``DataFrame.checkpoint()`` into the folder named by
``spark.checkpoint.dir``.  On a cluster that folder is shared storage set by
the operator; we only pick one ourselves when the session has none (tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "tilth", extra: dict | None = None) -> SparkSession:
    """A session for tests and the benchmark.  Without a master it is local; there 8 shuffle
    partitions suit the small tables.  On a cluster the number is left to the cluster's
    setting (a high one, which adaptive execution coalesces) unless given."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    parts = shuffle_partitions or os.environ.get("TILTH_SHUFFLE_PARTITIONS") or (8 if master.startswith("local") else None)
    b = SparkSession.builder.master(master).appName(app)
    if parts:
        b = b.config("spark.sql.shuffle.partitions", str(parts))
    if master.startswith("local"):
        b = b.config("spark.driver.memory", "16g")
    b = (b
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.ui.enabled", "false"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session; set one only when none is configured."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint folder
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        # one process: its own temporary folder is shared by definition
        configured = tempfile.mkdtemp(prefix="tilth-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: writes to the shared checkpoint folder and cuts lineage.

    Used where a result must be identical across several consumers (for example
    values tagged with their partition id) and must survive executor loss.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written intermediate tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tilth-scratch/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete every intermediate table that ``scratch_path`` named, once their readers are done."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/tilth-scratch"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
