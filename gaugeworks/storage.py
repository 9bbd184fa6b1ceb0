"""Where intermediate tables live.

Everything written between stages goes to the shared folder named by ``spark.checkpoint.dir``. A
local session without that setting uses a folder in its warehouse; a cluster session without it is
an error, because executors could not read each other's files.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    configured = configured or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, path: str, reader: SparkSession | None = None) -> DataFrame:
    """``df`` written once as a table at ``path``, so that later passes neither recompute it nor
    depend on the executors that produced it, and read only the columns they use. What a failed
    attempt left there is replaced. ``reader`` is the session of the result, if not that of ``df``."""
    df.write.mode("overwrite").parquet(path)
    return (reader or df.sparkSession).read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing will read again."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(conf).delete(target, True)


def set_times(spark: SparkSession, paths: list[str]) -> None:
    """Give the files below each of ``paths`` a later time than those below the one before, so that
    a stream that takes the oldest files first takes them in this order."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    now = jvm.java.lang.System.currentTimeMillis()
    for number, path in enumerate(paths):
        folder = jvm.org.apache.hadoop.fs.Path(path)
        files = folder.getFileSystem(conf)
        for status in files.listStatus(folder):
            files.setTimes(status.getPath(), now + 1000 * (number - len(paths)), -1)
