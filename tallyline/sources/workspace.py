"""Where jobs may put tables they need between steps."""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    A local session without that setting gets a temporary folder. On a cluster
    the setting is required, as a folder of one machine is lost with it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_folder(spark.conf.get("spark.app.id", ""))


@cache
def _local_folder(application: str) -> str:
    """One temporary folder per local application."""
    return tempfile.mkdtemp(prefix="tallyline-")


def new_path(spark: SparkSession, name: str) -> str:
    """Path below the shared folder that no other run uses."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")
