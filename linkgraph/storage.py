"""The folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. A session in one process gets a folder of its own where it has none, as in tests; on a cluster that is an error."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = f"{tempfile.gettempdir()}/linkgraph-{spark.sparkContext.applicationId}"
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared folder, which goes when the application ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(p)  # deleteOnExit only takes a path that exists
    fs.deleteOnExit(p)
    fs.delete(p, True)
    return path
