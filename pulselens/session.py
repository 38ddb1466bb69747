"""Session helpers: one place for the configs every operator relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Configs the operators assume.  Timestamps are pinned to UTC so day and
# 15-minute boundaries do not move with the machine's zone; AQE stays on so
# shuffle partition counts and skewed joins are re-planned at run time.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "pulselens") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    for k, v in BASE_CONF.items():
        if k in ("spark.ui.enabled", "spark.ui.showConsoleProgress"):
            continue
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a shared session
            pass


def checkpoint_base(spark: SparkSession) -> str:
    """The cluster's shared folder, as ``spark.checkpoint.dir`` gives it (a path without a scheme is on the default
    file system).  Only sinks and streams ask for it.

    It must be set on a cluster; on a local master (tests) a private folder stands in for it."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="pulselens-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def shared_dir(spark: SparkSession, name: str, fresh: bool = True) -> str:
    """A sub-folder of the shared folder: a new one, or (``fresh=False``) the one of that name, which a later run finds
    again."""
    return f"{checkpoint_base(spark)}/pulselens/{name}" + (f"-{uuid.uuid4().hex[:12]}" if fresh else "")
