"""Session construction and the few session-level settings the library relies on.

The library never needs a particular session: every operator is a plain
DataFrame transformation. ``get_session`` is a convenience for tests, the
bench and local runs; on a cluster, pass your own session and make sure
``spark.checkpoint.dir`` names a shared (HDFS/object-store) folder.
"""

from __future__ import annotations

import os
import tempfile
import threading
from collections import Counter
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

# Settings that change results or plans in ways the operators depend on.
#  - UTC: date/time casts of zone-aware timestamps are reproducible.
#  - AQE: runtime broadcast conversion, partition coalescing and skew-join
#    splitting (hot reviewers / products) are left to Spark.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "revlens",
    extra_conf: dict | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the library's base settings.

    Master, shuffle partitions and memory are the deployment's (spark-submit,
    spark-defaults) unless they are asked for here.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    The cluster's ``spark.checkpoint.dir`` is always used when set. Only a
    local-mode session without one (tests) gets a fresh scratch folder; on a
    cluster an unset value is an error, because a machine-local folder would
    not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS / object store) so checkpoints survive executor loss"
        )
    folder = tempfile.mkdtemp(prefix="revlens-ckpt-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did, unless it is installed there."""
    here = str(Path(__file__).resolve().parents[1])
    env = spark.sparkContext.environment
    if here not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (here, env.get("PYTHONPATH", "")) if x)


def split_session(spark: SparkSession, split_bytes: int) -> SparkSession:
    """A session of the same application and settings whose scans take ``split_bytes`` a task.

    Spark sizes the tasks of a scan by stored bytes, and rows that compress well come in
    millions a task, more than its sorts hold. The given session keeps its settings.
    """
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if own.conf.isModifiable(name) and name != FREE_SHUFFLES:
            own.conf.set(name, value)
    own.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    return own


#: Spark then deletes the shuffle files of an action when it ends, not when the driver's
#: garbage collector finds them.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing: Counter = Counter()  # session -> writes that run
_before: dict = {}  # session -> its own setting
_freeing_lock = threading.Lock()


@contextmanager
def freed_shuffles(spark: SparkSession):
    """For writes whose result is read from files: what they shuffled is deleted when they
    end, so that disks hold one write's shuffles at a time. The session gets its setting
    back after the last of the writes that run at once."""
    with _freeing_lock:
        if not _freeing[spark]:
            _before[spark] = spark.conf.get(FREE_SHUFFLES, None)
            spark.conf.set(FREE_SHUFFLES, "true")
        _freeing[spark] += 1
    try:
        yield
    finally:
        with _freeing_lock:
            _freeing[spark] -= 1
            if not _freeing[spark]:
                del _freeing[spark]
                before = _before.pop(spark)
                spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for a materialized intermediate table next to the checkpoints."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}"


def scale_conf(
    input_bytes: int,
    total_cores: int,
    shuffle_expansion: float = 1.0,
    target_partition_bytes: int = 256 << 20,
    scan_split_bytes: int = 512 << 20,
) -> dict[str, str]:
    """Partition sizing for a cluster run, from the input size and core count.

    * initial shuffle partitions ≈ shuffled bytes / target partition size
      (``shuffle_expansion`` = shuffled bytes per input byte; the fact-table
      dedup shuffles whole review rows, ≈ 1.0), at least 2 × cores so every
      core has work; AQE coalesces small ones back toward the advisory size,
      so over-estimating is cheap and under-estimating spills;
    * scan splits of ``scan_split_bytes`` keep per-task input bounded;
    * a partition counts as skewed at 4 × the median and > 2 × the advisory
      size, and is then split by AQE (plain shuffle joins) — hot keys behind
      an aggregate are split by ``revlens.operators.skew``.

    Example: 100 TB of reviews on 1,000 executors × 8 cores →
    ``scale_conf(100 << 40, 8000)`` gives 409,600 initial shuffle partitions
    of 256 MB.
    """
    shuffled = max(1, int(input_bytes * shuffle_expansion))
    partitions = max(2 * total_cores, -(-shuffled // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(scan_split_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
    }
