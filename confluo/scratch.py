"""Tables written once into the folder that all executors share, so that no later step computes them again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, list[str]] = {}


def folder(spark: SparkSession) -> str:
    """A new path below spark.checkpoint.dir.

    A session on one machine without that setting (tests) gets a temporary folder; on a cluster the setting is needed,
    since executors don't see each other's disks.
    """
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        top = tempfile.gettempdir() + "/spark-scratch"
    path = f"{top.rstrip('/')}/{uuid.uuid4().hex}"
    _own.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def scratch(df: DataFrame) -> DataFrame:
    """df, written as Parquet and read back: its rows are fixed from then on and lineage ends there."""
    path = folder(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def clean(spark: SparkSession) -> None:
    """Delete what this application has written here; results that still read from it are lost."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in _own.pop(spark.sparkContext.applicationId, []):
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
