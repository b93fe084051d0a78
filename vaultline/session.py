"""Session helpers: a tuned local session for tests/bench, and scratch space
taken from the cluster's shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins (broadcast only when the
# measured side is small, split skewed partitions) and coalesces small shuffles.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Texts can be long: a batch of this many bounds a Python worker's memory.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "vaultline", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session. With ``master=None`` nothing is said about the
    master or the driver's memory: the launcher (``spark-submit --master``,
    ``spark-defaults.conf``, a running session) decides, and Spark's own default
    is local. A master given here is for tests and benches."""
    builder = SparkSession.builder.appName(app)
    conf = dict(DEFAULT_CONF)
    if master is not None:
        builder = builder.master(master)
        conf["spark.driver.memory"] = os.environ.get("SPARK_DRIVER_MEMORY", "16g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster
    (``spark.checkpoint.dir``). Where none is configured a local session (tests)
    gets a fresh folder; any other raises, since a folder of the driver's machine
    is not there for executors."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="vaultline-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder for written
    tables (sinks in queries, lineage cuts)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/vaultline/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when their job ends, not when the driver's memory is next collected."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(DROP_SHUFFLES) if before is None else spark.conf.set(DROP_SHUFFLES, before)
