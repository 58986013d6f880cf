"""Session conventions shared by every operator.

Times are UTC wall clock stored as ``timestamp_ntz``.  Shared working
folders (upsert staging, landed files, stream checkpoints) live under the
cluster's ``spark.checkpoint.dir``; a private folder is chosen only when a
local session has none (tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import SparkSession

import loadcast

_CKPT_KEY = "spark.checkpoint.dir"

# Task functions travel by value, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(loadcast)


def ensure_utc(spark: SparkSession) -> None:
    """Pin the session zone to UTC (the data model is UTC everywhere)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder named by the cluster; set one only where it is unset."""
    root = spark.conf.get(_CKPT_KEY, None)
    if not root:
        root = spark.sparkContext.getConf().get(_CKPT_KEY, None)
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError(f"{_CKPT_KEY} must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="loadcast-ckpt-")
        spark.conf.set(_CKPT_KEY, root)
    try:
        spark.sparkContext.setCheckpointDir(root)
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        pass
    return root


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint root for one run (created
    by whatever is first written to it)."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
