"""New folders for what a query writes and reads back."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def new_folder(spark: SparkSession, tag: str) -> str:
    """A path, not there yet, in the folder that driver and executors share: spark.checkpoint.dir; a temporary folder
    only where they are one process. It is deleted when the driver's JVM ends."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="foliant-")
    base = base if "://" in base else f"file://{base}"
    path = f"{base.rstrip('/')}/foliant/{tag}-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).deleteOnExit(at)
    return path
