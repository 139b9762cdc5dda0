"""Session defaults and scratch space shared by the package."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

_own_scratch: str | None = None


def use_scratch(path: str) -> None:
    """Folder for intermediate tables where ``spark.checkpoint.dir`` is unset, as in tests."""
    global _own_scratch
    _own_scratch = path


def build_session(app: str = "palisade", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC time, ANSI mode and adaptive execution.

    Shuffle parallelism is left to the cluster's settings unless passed in;
    adaptive execution coalesces small shuffles and splits skewed joins.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for intermediate tables and stream checkpoints.

    It lies in the shared folder named by ``spark.checkpoint.dir``.  Without that
    setting the caller has to name a folder with ``use_scratch``, which counts only where
    driver and executors are one process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "local")):
        root = _own_scratch
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"

