"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "portflow") -> SparkSession:
    """Session with the settings every job here assumes.

    * UTC session time zone: calendar keys are derived from local dates and
      must not move with the driver's zone.
    * AQE on (partition coalescing, skew-join splitting) so shuffle partition
      counts sized for the largest input still behave on small inputs.
    * UI off: no web server is started for batch runs.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true")
          .config("spark.ui.showConsoleProgress", "false"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session (the cluster names a
    shared location there).  Only when it is unset — as in local tests — is
    ``fallback`` installed as the checkpoint dir.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if fallback is None:
            raise RuntimeError("spark.checkpoint.dir is not set and no fallback was given")
        spark.sparkContext.setCheckpointDir(fallback)
        root = fallback
    return root


def subdir(root: str, *parts: str) -> str:
    """Join a path under a (possibly URI-style) root."""
    return "/".join([root.rstrip("/")] + [p.strip("/") for p in parts])


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under the shared folder and read back: lineage ends there.

    Where no shared folder is set, a temporary one is made only if driver and
    executors are one process; on a cluster that is an error.
    """
    spark = df.sparkSession
    one_process = re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master)
    path = subdir(checkpoint_root(spark, fallback=tempfile.mkdtemp(prefix="portflow-") if one_process else None), "staged", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def env_int(name: str, default: int) -> int:
    try:
        return int(os.environ.get(name, default))
    except ValueError:
        return default
