"""Session helpers: a tuned local session for tests/bench and the shared scratch folder.

On a cluster the caller owns the session; the library only reads
``spark.checkpoint.dir`` to know where lineage cuts and intermediate tables
may be written.  A folder of our own is chosen only when that setting is
unset (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "sheetwright") -> SparkSession:
    """A local session configured the way the tests and the bench expect."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SHEETWRIGHT_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and intermediate tables.

    Uses the folder the cluster names (``spark.checkpoint.dir`` or an
    already set checkpoint dir); only when none is set on a local master, a
    folder of our own is created and registered (tests, local runs).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="sheetwright-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str, unique: bool = True) -> str:
    """A path below the shared checkpoint folder for an intermediate dataset."""
    root = checkpoint_root(spark).rstrip("/")
    leaf = f"{name}-{uuid.uuid4().hex[:12]}" if unique else name
    return f"{root}/sheetwright/{leaf}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists on its (Hadoop) file system."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable lineage cut in the shared checkpoint folder (survives executor loss)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
