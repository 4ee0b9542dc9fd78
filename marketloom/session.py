"""Session settings and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local_folders: dict[str, str] = {}


def build_session(app: str = "marketloom", master: str | None = None, **settings: str) -> SparkSession:
    """Session with adaptive execution on; keyword settings use `__` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def release_shuffles(spark: SparkSession) -> None:
    """From now on the shuffle files of a statement go when it ends, and not when the driver happens to collect its garbage.

    What the session itself says about it stands. A frame that is evaluated once more shuffles once more.
    """
    if spark.conf.get(CLEANUP_SETTING, None) is None and spark.conf.isModifiable(CLEANUP_SETTING):
        spark.conf.set(CLEANUP_SETTING, "true")


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, taken from the session.

    Only a local session, where driver and executors are one process, may fall back to a
    temporary folder; a cluster without the setting is refused.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):  # not local-cluster
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder shared by all executors")
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="marketloom-")
    return _local_folders[application]


def new_work_folder(spark: SparkSession, purpose: str) -> str:
    """Unused path below the shared folder, so that runs never see each other's files."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
