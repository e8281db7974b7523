"""Session settings the transforms rely on, and the shared scratch location.

The caller owns the session. We only pin what results depend on (the
session time zone: ``order_date`` is derived in it) and switch on adaptive
execution where nobody has set it. Scratch data (streaming checkpoints,
changelogs, topics written by tests) lives under the cluster's shared
checkpoint folder. Only a local session that names none gets a private temp
folder; on a cluster a missing setting is an error.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings applied only when the session has no value of its own.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
# The state store is left to the session: report state is one row per (day, province)
# or (day, city), a few thousand rows whatever the order volume, which the default
# in-memory provider holds cheaply. A deployment keeping years of days may pick
# RocksDB with spark.sql.streaming.stateStore.providerClass.


def _is_set(spark: SparkSession, key: str) -> bool:
    """Whether the session carries an explicit value (a built-in default does not count)."""
    try:
        return spark.conf.get(key, None) is not None and spark._jsparkSession.conf().contains(key)
    except Exception:  # no JVM handle (e.g. a remote session): treat as set, change nothing
        return True


def prepare_session(spark: SparkSession) -> SparkSession:
    """Pin UTC (dates are derived in the session zone) and enable AQE if unset."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    for key, value in _DEFAULTS.items():
        if not _is_set(spark, key):
            spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session.

    Order: the SparkContext's checkpoint dir, then ``spark.checkpoint.dir``;
    if neither is set, a local session gets a fresh private folder, registered
    so that later calls reuse it, and any other session is refused: executors
    on other machines could not see such a folder.
    """
    sc = None
    try:
        sc = spark.sparkContext
        current = sc.getCheckpointDir()
        if current:
            return current.rstrip("/")
    except Exception:
        sc = None
    try:
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:
        conf_dir = None
    if not conf_dir and sc is not None:
        conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        if sc is not None:
            sc.setCheckpointDir(conf_dir)
        return conf_dir.rstrip("/")
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not re.fullmatch(r"local(\[[^\]]*\])?", master or ""):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="tidemill-")
    if sc is not None:
        sc.setCheckpointDir(local)
        return sc.getCheckpointDir().rstrip("/")
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique directory path under the checkpoint root (not created)."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, on whatever file system it names."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)
