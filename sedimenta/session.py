"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Only settings the semantics rely on, plus the runtime re-planning that splits
# skewed joins. Sizes (partitions, memory) belong to whoever submits the job.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # keys stand in plans as binary literals; explain, UI and event log show none of 16 bytes or more
    "spark.sql.redaction.string.regex": r"(?i)0x[0-9a-f]{32,}|X'[0-9a-f]{32,}'|\[([0-9a-f]{2}[ ,]*){16,}\]",
    # no stack trace per column expression: plans here have hundreds of them
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


_LOCAL_FOLDERS: dict[str, str] = {}


def build_session(app_name: str = "sedimenta", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the library's settings; `extra` takes keys with `__` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in `spark.checkpoint.dir`.

    Every executor must see it, so a machine-local folder is made only where
    the setting is absent and the master is local.
    """
    for conf in (spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.getConf().get("spark.checkpoint.dir")):
        if conf:
            return conf.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _LOCAL_FOLDERS[application]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; never reused, so no plan overwrites its own input."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
