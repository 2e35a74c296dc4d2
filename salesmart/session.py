"""Session construction and the few settings the jobs rely on."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# The reference evaluates every day / hour bucket in this zone.
DEFAULT_ZONE = "Asia/Seoul"

# Scan split sizing used by the reference's benchmark job (8 MiB, at least 4
# splits).  Kept as a named profile; the default profile keeps Spark's 128 MiB
# splits, which is what a 100 TB scan wants.
BENCHMARK_SCAN_CONF = {
    "spark.sql.files.maxPartitionBytes": str(8 * 1024 * 1024),
    "spark.sql.files.minPartitionNum": "4",
}

LOCAL_DRIVER_MEMORY = "8g"

BASE_CONF = {
    "spark.sql.session.timeZone": DEFAULT_ZONE,
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split skewed join partitions even when that needs an extra shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Remove reliable-checkpoint files once their DataFrame is garbage collected.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "salesmart",
    zone: str = DEFAULT_ZONE,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with the time zone, ANSI mode and AQE set.

    ``master`` is left to spark-submit when ``None``.  ``shuffle_partitions``
    should be sized so that one shuffle partition is roughly 128-256 MiB at the
    target scale; AQE coalesces small ones at run time.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    conf["spark.sql.session.timeZone"] = zone
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        # Local mode runs all tasks inside the driver JVM: its heap is the
        # executors' memory, and Spark's 1 GiB default makes shuffles spill
        # and GC dominate.  (On a cluster, spark-submit sizes the processes.)
        conf["spark.driver.memory"] = LOCAL_DRIVER_MEMORY
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    sc = _context(spark)
    if sc is not None:
        sc.setLogLevel("WARN")
    return spark


_LOCAL_WORK_DIRS: dict[str, str] = {}


def _context(spark: SparkSession):
    """The SparkContext, or None for a Spark Connect session."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no context
        return None


def default_parallelism(spark: SparkSession) -> int:
    """Cores Spark plans for (the shuffle partition count on Spark Connect)."""
    sc = _context(spark)
    if sc is not None:
        return sc.defaultParallelism
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def work_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and written tables.

    Reads ``spark.checkpoint.dir`` from the session's configuration (the
    cluster names a shared folder there).  Only when it is unset on a
    ``local[...]`` master, as in tests, a private temporary folder is created
    once per application.  On any other master a missing setting is an error:
    executors could not see each other's files in a machine-local folder.
    """
    sc = _context(spark)
    if sc is None:
        named, key, master = spark.conf.get("spark.checkpoint.dir", None), "connect", "connect"
    else:
        named, key, master = sc.getConf().get("spark.checkpoint.dir", None), sc.applicationId, sc.master
    if named:
        if sc is not None and sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise ValueError(
            f"master {master!r} needs spark.checkpoint.dir: a folder that the driver and all executors share"
        )
    if key not in _LOCAL_WORK_DIRS:
        _LOCAL_WORK_DIRS[key] = tempfile.mkdtemp(prefix="salesmart-")
        if sc is not None and sc.getCheckpointDir() is None:
            sc.setCheckpointDir(_LOCAL_WORK_DIRS[key] + "/checkpoints")
    return _LOCAL_WORK_DIRS[key]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under :func:`work_dir`, removed when the application ends."""
    path = f"{work_dir(spark)}/scratch/{name}-{uuid.uuid4().hex}"
    sc = _context(spark)
    if sc is not None:
        jpath = sc._jvm.org.apache.hadoop.fs.Path(path)
        jpath.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return path


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts lineage (a lost executor costs no recomputation upstream), keeps
    column pruning, and gives later joins a plain scan on either side, so AQE
    can split a skewed key.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
