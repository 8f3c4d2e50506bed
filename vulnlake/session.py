"""Session settings the library relies on, and the shared scratch location.

Only two things matter for correct results: the session time zone (dates are cut from UTC instants) and
adaptive execution (runtime choice of broadcast vs. sort-merge joins, skew splitting and partition
coalescing). Everything else is left to the cluster's own configuration.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every query in this package assumes. They are SQL confs, so they can be set on a live session.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

# Unless the session has its own value: shuffled bytes that adaptive execution gives to one task. A task's sorts and hash
# tables are several times as large as its compressed input, and the distinct counts hold every value of it.
TASK_INPUT = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16m")


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the confs in ``REQUIRED_CONF`` on an existing session, and ``TASK_INPUT`` if it has none (idempotent)."""
    if spark.conf.get(TASK_INPUT[0], None) is None:
        spark.conf.set(*TASK_INPUT)
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession):
    """What is executed in here frees its shuffle files as soon as it ends; otherwise they stay on disk until the driver's heap
    happens to be collected. For frames that are executed once."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def build_session(master: str | None = None, app: str = "vulnlake", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults; for tests, benches and scripts.

    On a cluster, ``master`` stays None so spark-submit decides, and ``shuffle_partitions`` should be sized
    to the data (AQE coalesces small partitions, so erring high is cheap).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(REQUIRED_CONF)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return apply_defaults(spark)


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared scratch root: ``spark.checkpoint.dir`` as configured on the session.

    Only when it is unset on a ``local`` master (tests) is a fresh local folder created and registered as the
    SparkContext checkpoint directory. A cluster's executors would not see such a folder: there it is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session has no local SparkContext
        sc = None
    if sc is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
    else:
        configured = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if sc is None or sc.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="vulnlake-ckpt-"))
    # the context appends a random sub-folder; use what it reports so every path lives under one root
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unique folder name under the shared scratch root (not created; writers create it)."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex[:12]}")
