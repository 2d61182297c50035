"""Where intermediate tables and stream checkpoints go."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


@cache
def own_folder() -> str:
    """A folder for a session that runs on this machine alone; goes with the process."""
    folder = tempfile.mkdtemp(prefix="storepulse-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the shared folder the cluster names in ``spark.checkpoint.dir``.

    Every executor must see it, so on a cluster a session without that setting is
    refused. In local mode, where all run on one machine, it is set to a folder of this
    process. What is written there backs lazy results: the shared folder's owner clears
    it, the process its own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = own_folder()
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
