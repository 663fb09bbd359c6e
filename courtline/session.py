"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every courtline job wants. AQE re-plans joins and coalesces small
# shuffle partitions at run time; skew-join splitting handles a hot key.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # delete checkpoint files once the checkpointed data is no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


MIB = 1 << 20


def scale_conf(input_bytes: int, cores: int, partition_mib: int = 256) -> dict[str, str]:
    """Partition sizing for an input of ``input_bytes`` on ``cores`` task slots.

    Scan splits of ``partition_mib`` (at least one wave per core); the first
    shuffle of a stage starts with about one partition per split (at least
    two per core) and AQE coalesces towards the same advisory size, so both
    scan and shuffle partitions fit comfortably in executor memory and spill
    stays rare."""
    split = partition_mib * MIB
    splits = max(1, -(-input_bytes // split))
    initial = max(2 * cores, splits)
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(split),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.shuffle.partitions": str(initial),
    }


def build_session(
    app: str = "courtline",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    input_bytes: int | None = None,
    cores: int | None = None,
) -> SparkSession:
    """Build (or fetch) a session with courtline's defaults.

    On a cluster pass ``master=None`` and let spark-submit decide, and give
    ``input_bytes`` and ``cores`` to size scan splits and shuffle partitions
    (``scale_conf``); AQE coalesces the small shuffles.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if input_bytes and cores:
        conf.update(scale_conf(input_bytes, cores))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and scratch tables.

    Reads ``spark.checkpoint.dir`` (or an already set checkpoint dir) from the
    session. Only a local-mode session without one gets a fresh folder of its
    own; a cluster session without a shared folder is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError(
                "set spark.checkpoint.dir to a shared folder (e.g. on HDFS/S3) "
                "before running courtline jobs on a cluster"
            )
        conf_dir = tempfile.mkdtemp(prefix="courtline-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder path under the application's scratch folder."""
    return os.path.join(scratch_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def scratch_root(spark: SparkSession) -> str:
    """This application's folder for scratch tables, under the shared checkpoint root."""
    return os.path.join(checkpoint_root(spark), "courtline-scratch", spark.sparkContext.applicationId)


def free_scratch(spark: SparkSession) -> None:
    """Delete the application's scratch tables. DataFrames that were returned over them
    cannot be read any more, so this is for the end of a job."""
    from courtline.sinks.manifest import remove

    remove(spark, scratch_root(spark))


@contextmanager
def scoped_conf(spark: SparkSession, conf: dict[str, str]):
    """Set SQL confs for the duration of a block, then restore them."""
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
