"""Session settings and the shared scratch location.

Scratch data (checkpoints, staged invoice files, stream checkpoints) always
lives under the folder the cluster names in ``spark.checkpoint.dir``.  A
private local folder is only created when that setting is missing and the
master is ``local`` (unit tests on a laptop); elsewhere a missing setting is an
error.  Scratch folders are deleted when the session's JVM ends.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on.  AQE re-plans joins from runtime sizes,
# splits skewed shuffle partitions and coalesces small ones.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # checkpoints live in the shared folder; delete them once nothing references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "ledgerlight",
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(RECOMMENDED_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str | None:
    """The shared checkpoint folder configured for this session, if any."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, creating a local one only when unset (tests)."""
    root = checkpoint_root(spark)
    if root:
        return root
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on {master}")
    local = tempfile.mkdtemp(prefix="ledgerlight-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir()


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
BYTES_PER_PARTITION = 16 << 20  # of compressed input; a shuffle of its rows is about as large
_initial: dict[str, str] = {}


def scale_partitions(spark: SparkSession, input_bytes: int) -> None:
    """Let shuffles begin with a partition per ``BYTES_PER_PARTITION`` of input where the session has fewer.

    The session's number is fixed, so the memory of a task (and what it spills) would grow with the
    tables; adaptive execution merges partitions that turn out small.  A number that the
    user has set is left alone.
    """
    known = spark.conf.get(INITIAL_PARTITIONS, None)
    if known is not None and known != _initial.get(spark.sparkContext.applicationId):
        return
    wanted = -(-input_bytes // BYTES_PER_PARTITION)
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(INITIAL_PARTITIONS, str(wanted))
        _initial[spark.sparkContext.applicationId] = str(wanted)
    elif known is not None:
        spark.conf.unset(INITIAL_PARTITIONS)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique path under the checkpoint root for one job's files, deleted with the session's JVM."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    folder = f"{root}/ledgerlight-{label}-{uuid.uuid4().hex[:12]}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return f"{folder}/files"

