"""Fresh folders for what a query writes and reads back."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that the cluster shares (spark.checkpoint.dir), deleted when the application ends.

    Where that is unset, a local folder serves a local master; on a cluster other machines would not see it, so it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the whole cluster shares")
        base = tempfile.mkdtemp(prefix="spark-ledgerloom-")
        atexit.register(shutil.rmtree, base, True)
    path = f"{base.rstrip('/')}/ledgerloom/{name}-{uuid.uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return path
