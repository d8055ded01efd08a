"""Session construction and the few cluster settings every job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that hold from a laptop to a large cluster: adaptive execution
# re-plans joins and coalesces partitions at runtime, skew-join splits hot keys,
# and timestamps are compared as wall-clock values in UTC.
LOCAL_SHUFFLE_PARTITIONS = 8
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "cardspark", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's defaults.

    ``shuffle_partitions`` is set if given; else a local master gets
    ``LOCAL_SHUFFLE_PARTITIONS``, and a cluster keeps what it configures
    (adaptive execution merges partitions, it never adds any)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    local = bool(master) and master.startswith("local")
    if shuffle_partitions is None and local:
        shuffle_partitions = LOCAL_SHUFFLE_PARTITIONS
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if local:
        # local mode: the driver JVM is the only executor
        conf.setdefault("spark.driver.memory", "12g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session. Only a local-mode
    session (tests, bench) with no such setting gets a scratch folder of its
    own; a cluster session without one is an error, because a machine-local
    folder does not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/object store) before running warehouse or metric jobs")
    path = tempfile.mkdtemp(prefix="cardspark-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path


def run_concurrently(tasks: dict, max_workers: int = 8) -> dict:
    """Run independent Spark actions (``name -> callable``) from a pool of
    driver threads and return ``name -> result``.

    Each callable submits its own jobs; the scheduler interleaves their
    stages on the executors, so small jobs that cannot fill the cluster on
    their own (a dimension build, a staging write) overlap instead of
    queueing. The first failure is raised after all tasks have finished.
    """
    from concurrent.futures import ThreadPoolExecutor

    if len(tasks) <= 1:
        return {k: f() for k, f in tasks.items()}
    with ThreadPoolExecutor(max_workers=min(max_workers, len(tasks))) as pool:
        futures = {k: pool.submit(f) for k, f in tasks.items()}
    return {k: fut.result() for k, fut in futures.items()}
