"""Intermediate tables that cut a plan's lineage and tell the planner their size."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@cache
def _own_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"monthloom-{application}-")


def scratch_folder(spark: SparkSession) -> str:
    """This application's part of the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a temporary folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return f"{folder.rstrip('/')}/{context.applicationId}"
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return _own_folder(context.applicationId)


def discard(spark: SparkSession) -> None:
    """Removes this application's scratch tables; to be called when nothing reads them any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, read_as: T.StructType | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and return the table read back.

    Later plans start from the files, so lost executors cost no recomputation of ``df``, every
    reader sees the same rows, and the optimizer knows the true size: a small table is broadcast
    by Spark's own threshold check, a large one is joined by shuffling.
    """
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(read_as or df.schema).parquet(path)
