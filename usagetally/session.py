"""Session and shared-folder helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


#: HotSpot leaves methods of more than 8,000 bytes of bytecode interpreted.  The code that Spark generates
#: for a fact's rules is longer; a cluster sets the same for its executors (README, "Cluster settings").
COMPILE_LONG_METHODS = "-XX:-DontCompileHugeMethods"


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "usagetally") -> SparkSession:
    """A local session for tests and the benchmark (never for a cluster)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.extraJavaOptions", COMPILE_LONG_METHODS)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Written tables that cut lineage or stage a publish live below it.  Only a
    local-mode session without the setting gets a fresh temporary folder.
    """
    d = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="usagetally-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared folder."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/usagetally/{name}-{uuid.uuid4().hex}"


def local_path(p: str) -> str:
    return p[len("file:"):] if p.startswith("file:") else p


def exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists (any Hadoop file system)."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(jpath))


__all__ = ["local_session", "shared_dir", "scratch_path", "exists", "local_path"]
