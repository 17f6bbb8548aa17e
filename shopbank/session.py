"""Session and scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(
    app: str, time_zone: str = "UTC", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """A session with the settings the operators count on. ``conf`` wins over all of them.

    Shuffle partitions are left to the cluster: adaptive execution merges small ones and splits
    skewed ones.
    """
    settings = {
        "spark.sql.session.timeZone": time_zone,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Sessions of one key are merged before the shuffle, so a hot key arrives combined.
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
        **(conf or {}),
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_LOCAL_SCRATCH: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    A local session may do without the setting; it gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if not _LOCAL_SCRATCH:
        _LOCAL_SCRATCH.append(tempfile.mkdtemp(prefix="shopbank-"))
    return _LOCAL_SCRATCH[0]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody else uses, below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
