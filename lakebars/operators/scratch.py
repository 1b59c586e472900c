"""Written tables in a folder the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under `spark.checkpoint.dir`.

    A local session without that setting uses the machine's temporary folder;
    a cluster without it is an error, since its executors share no such folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.gettempdir()
    return f"{root.rstrip('/')}/lakebars/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str, scratch: str | None = None) -> DataFrame:
    """Write `df` now and read it back.

    The plan of what reads it then starts at a table of known size, so Spark
    broadcasts it in a join only if it really is below
    `spark.sql.autoBroadcastJoinThreshold`, and shuffles otherwise. Nothing is
    recomputed when an executor is lost. The table lies in `scratch`, a folder
    the caller keeps and removes (`remove`), or below `spark.checkpoint.dir`.
    """
    path = f"{scratch.rstrip('/')}/{name}-{uuid.uuid4().hex}" if scratch else scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it lies; a missing one is fine."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
