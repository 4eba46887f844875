"""A folder that every executor can reach."""

from __future__ import annotations

import tempfile
from functools import cache
from uuid import uuid4

from pyspark.sql import SparkSession


@cache
def _local_default(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


def work_dir(spark: SparkSession) -> str:
    """A new folder name under the session's shared checkpoint folder.

    Without that setting a local session gets a temporary folder; a cluster
    has no folder its machines share by chance, so there it is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = _local_default(context.applicationId)
    return f"{shared.rstrip('/')}/tidemark-{uuid4().hex}"
