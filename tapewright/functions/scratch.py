"""Paths for tables that a job writes and reads again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the folder that spark.checkpoint.dir names.

    Where that setting is absent, a local session gets a temporary folder; on a cluster its
    absence is an error, as executors would not see one another's files.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _handed_out.append(path)
    return path


_handed_out: list[str] = []


def clear(spark: SparkSession) -> int:
    """Deletes what this process has written to the shared folder so far, and returns how many paths that were.

    Frames that still read from there are of no use afterwards, so results are to be written or collected first.
    """
    done = 0
    while _handed_out:
        path = spark._jvm.org.apache.hadoop.fs.Path(_handed_out.pop())
        done += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return done


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written to the shared folder and read back: a cut in the plan and in the lineage."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
