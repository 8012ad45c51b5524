"""Session configuration and the shared working folder.

Scale notes
-----------
* AQE re-plans at runtime: it coalesces small shuffle partitions, turns a sort-merge join
  into a broadcast join once the real size of one side is known, and splits skewed
  partitions of a join side.
* ``autoBroadcastJoinThreshold`` is the size check behind every broadcast that is not
  explicitly hinted; explicit ``broadcast()`` hints are only used in this library for
  sides with a proven row bound (calendar, nations, sentinel rows, per-partition offsets).
* Written intermediates (checkpoints, version directories, snapshots) live under the
  cluster's shared ``spark.checkpoint.dir``; a private folder is created only when the
  session has none (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile
import threading
import weakref
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
import uuid

from pyspark.sql import SparkSession

# Settings that matter at 100 TB; all are plain Spark SQL configs.
SCALE_CONFIGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    # checkpoints of key assignment / audit chains are compressed and removed once
    # unreferenced
    "spark.checkpoint.compress": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


_ROOT_LOCK = threading.Lock()
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"      # from Spark 4.1 on
_DROPPING_LOCK, _DROPPING = threading.Lock(), weakref.WeakKeyDictionary()       # session -> [open blocks, value before]


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "starmart", extra: dict | None = None) -> SparkSession:
    """Create (or get) a session with the scale settings above and the UI off."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_CONFIGS)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_scale_configs(spark: SparkSession) -> None:
    """Apply the runtime-settable scale configs to an existing session."""
    for k, v in SCALE_CONFIGS.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static or locked configs stay as the cluster set them
            pass


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session. Only a local master may go without it (tests, one machine): a
    private folder is then created and registered. On a cluster an unset folder is an
    error, as executors could not see a folder of the driver's machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session: the server owns the checkpoint dir
        sc = None
    if configured:
        if sc is not None and not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        # Spark appends a per-application folder; keep our tables next to it.
        return os.path.dirname(current.rstrip("/"))
    if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    with _ROOT_LOCK:  # concurrent jobs of one run must agree on a single folder
        current = sc.getCheckpointDir() if sc is not None else None
        if current:
            return os.path.dirname(current.rstrip("/"))
        local = tempfile.mkdtemp(prefix="starmart-")
        sc.setCheckpointDir(local)
        return local


def scratch_root(spark: SparkSession) -> str:
    """This application's folder of written intermediates."""
    return f"{shared_root(spark)}/starmart/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared root for one written intermediate."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove all intermediates of this application. Call it when the results that read
    them are written; a lazy result still needs its intermediates."""
    from starmart.sources.versions import drop_path
    drop_path(spark, scratch_root(spark))


@contextmanager
def scratch(spark: SparkSession, name: str):
    """A fresh folder under the shared root that is removed at the end, also on failure."""
    from starmart.sources.versions import drop_path
    path = scratch_path(spark, name)
    try:
        yield path
    finally:
        drop_path(spark, path)


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Inside, the shuffle files of a query are removed when it ends; else they stay until a
    garbage collection of the driver finds the plan gone, and those of a job's steps add up.
    For jobs whose steps write tables: a frame that is run again shuffles again."""
    with _DROPPING_LOCK:        # blocks of concurrent jobs share the session's setting
        held = _DROPPING.setdefault(spark, [0, None])
        if not held[0]:
            held[1] = spark.conf.get(_DROP_SHUFFLES, None)
            spark.conf.set(_DROP_SHUFFLES, "true")
        held[0] += 1
    try:
        yield
    finally:
        with _DROPPING_LOCK:
            held[0] -= 1
            if not held[0]:
                if held[1] is None:
                    spark.conf.unset(_DROP_SHUFFLES)
                else:
                    spark.conf.set(_DROP_SHUFFLES, held[1])


def run_concurrently(actions) -> None:
    """Run independent Spark actions as concurrent jobs (one driver thread each) and
    re-raise the first failure. Small jobs then fill the gaps large ones leave."""
    with ThreadPoolExecutor(max_workers=max(1, len(actions))) as pool:
        for f in [pool.submit(a) for a in actions]:
            f.result()
