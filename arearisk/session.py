"""Session construction and shared-storage locations."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a job of this shape wants on any cluster: adaptive execution
# (coalesces small shuffles, converts size-checked joins to broadcast at run
# time, splits skewed join partitions) and a fixed UTC clock for timestamps.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Python call-site capture costs a JVM round trip per column function;
    # plan construction of the wide report projections is several times faster without it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# Starting points for a large cluster, for ``get_session(extra=SCALE_CONF)``: many initial shuffle
# partitions that AQE coalesces to ~256 MB each, 256 MB input splits, and a
# broadcast threshold that keeps every broadcast side size-checked and small.
SCALE_CONF = {
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "arearisk", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session. ``master``/partitions are only for local runs."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def app_key(spark: SparkSession) -> str:
    """Identity of the running application (for per-session caches)."""
    return spark.conf.get("spark.app.id", None) or str(id(spark))


def shared_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and written intermediates.

    On a cluster this is ``spark.checkpoint.dir`` as configured for the
    session. Only when it is unset (local tests) is a private folder created
    and registered as the checkpoint directory.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # remote (Connect) sessions have no SparkContext
        sc = None
    if sc is not None:
        d = sc.getCheckpointDir() or d
    if not d:
        master = spark.conf.get("spark.master", "")
        if not re.match(r"local(\[|$)", master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="arearisk-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(d)
            d = sc.getCheckpointDir() or d
    return d


# Locations handed out per application, for ``drop_scratch``.
_MADE: dict[str, list[str]] = {}


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused location under the shared folder."""
    path = shared_dir(spark).rstrip("/") + "/" + f"{label}-{uuid.uuid4().hex}"
    _MADE.setdefault(app_key(spark), []).append(path)
    return path


def drop_scratch(spark: SparkSession) -> int:
    """Delete every location that this application got from ``fresh_path``; call it when no frame that reads them is
    needed any more. Returns how many there were."""
    made = _MADE.pop(app_key(spark), [])
    for path in made:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    return len(made)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme (for local test assertions only)."""
    if path.startswith("file:"):
        path = path[5:]
        while path.startswith("//"):
            path = path[1:]
    return os.path.normpath(path)


def cut_lineage(df, label: str = "cut"):
    """Materialise ``df`` as a Parquet table in the shared folder and continue
    from a fresh scan of it.

    The plan runs once (a reliable ``checkpoint()`` of an unpersisted plan
    runs it twice: once to count, once to write), the files survive executor
    loss, and later readers get column pruning and size statistics.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.parquet(path)
