"""Folders for written intermediate tables, in the storage that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
# For sessions that were started without a checkpoint folder; it can be set while they run.
SHARED_DIR = "changeloom.shared.dir"


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints, else the one named in ``SHARED_DIR``."""
    root = spark.conf.get(CHECKPOINT_DIR, None) or spark.conf.get(SHARED_DIR, None)
    if not root:
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors can reach")
    return root.rstrip("/")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """The path of a folder nobody has used before.

    Results may be read from it as long as the application runs; what lies under its id can be
    deleted afterwards.
    """
    application = spark.conf.get("spark.app.id", "application")
    return f"{shared_root(spark)}/changeloom/{application}/{purpose}-{uuid.uuid4().hex}"
