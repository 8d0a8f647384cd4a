"""Session settings the pipeline relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that make results and plans what the package expects. All are runtime
# SQL confs, so they can be applied to a session someone else built.
RUNTIME_CONF = {
    # Dates, date keys and hours are computed in the session zone: pin it.
    "spark.sql.session.timeZone": "UTC",
    # Integer overflow raises instead of wrapping into a wrong total.
    "spark.sql.ansi.enabled": "true",
    # Runtime re-planning: broadcast a join side only once its real size is known,
    # coalesce small shuffle partitions, and split skewed join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Shuffle partitions are joined up to this size, so that a task of a sort-merge
    # join sorts tens of MB in memory and spills nothing (64 MB become 280 MB there).
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # A write partitioned into a few folders keeps a file open for each and does
    # not first sort a task's rows by folder.
    "spark.sql.maxConcurrentOutputFileWriters": "2",
}


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    """Set ``RUNTIME_CONF`` on an existing session (only keys that differ)."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "lakemart",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the package's settings.

    ``shuffle_partitions`` is the starting point AQE coalesces from; on a cluster
    size it so a partition of the largest shuffle fits an executor core
    (roughly shuffle bytes / 128 MB), locally the core count is enough.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**RUNTIME_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    return apply_runtime_conf(spark)


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and written intermediates.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir). Only a
    local-mode session without one gets a private temporary folder; a cluster
    session without one is an error, because a machine-local folder is not
    visible to other executors and does not survive their loss.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder (HDFS, object store)"
        )
    root = tempfile.mkdtemp(prefix="lakemart-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique folder under the scratch root for one run of ``purpose``."""
    return f"{scratch_root(spark)}/lakemart/{purpose}-{uuid.uuid4().hex[:12]}"
