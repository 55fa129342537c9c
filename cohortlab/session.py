"""Session construction and cluster-facing settings.

The same settings are meant for a large cluster: adaptive execution re-plans
joins and coalesces shuffle partitions at runtime, skewed join partitions are
split, and the checkpoint folder comes from the cluster's own
``spark.checkpoint.dir`` whenever one is configured.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. Column names arrive upper-case from the loader
# and are read lower-case by the models, so resolution must stay
# case-insensitive.
BASE_CONF = {
    "spark.sql.caseSensitive": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # many small shuffle partitions that adaptive execution joins up: the number
    # bounds a partition's size at scale and costs little on small data
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4096",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "cohortlab",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return (or create) a session with the engine's settings applied.

    ``master`` is only used for local runs (tests, bench); on a cluster the
    submitter decides it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
        conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(shuffle_partitions)
    if extra_conf:
        conf.update(extra_conf)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in conf.items():
        if not key.startswith("spark.ui") and not key.startswith("spark.driver"):
            try:
                spark.conf.set(key, value)
            except Exception:  # static confs of an existing session
                pass
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and stream checkpoints.

    Read from ``spark.checkpoint.dir`` (set by the cluster). Only when it is
    unset on a local master, as in tests, a fresh scratch folder is made; on a
    cluster every executor would write to its own disk, so that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="cohortlab-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local
