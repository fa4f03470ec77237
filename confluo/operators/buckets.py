"""Tables kept in folders by the hash of a key: a change rewrites the buckets it touches and reads no others."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from confluo.scratch import exists, scratch

BUCKET = "bucket"


def bucket_of(key: str | Column, n: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def read(spark: SparkSession, path: str, schema: StructType, only: Iterable[int] | None = None) -> DataFrame:
    """The table at a path, of a schema without the bucket, or only some of its buckets; empty if nothing is there yet."""
    whole = StructType([*schema.fields]).add(BUCKET, IntegerType())
    df = spark.read.schema(whole).parquet(path) if exists(spark, path) else spark.createDataFrame([], whole)
    return df if only is None else df.where(F.col(BUCKET).isin(sorted(only)))


def touched(df: DataFrame) -> list[int]:
    """The distinct buckets of a table: as many as there are buckets at most."""
    return [r[0] for r in df.select(BUCKET).distinct().collect()]


def overwrite(df: DataFrame, path: str, clear: Iterable[int] = ()) -> None:
    """Replace the buckets that df has rows of, and leave others alone; Spark splits a bucket that is large.

    df may read from the path itself, as it is written elsewhere first. Buckets to clear that get no row hold one of
    nulls from then on, as a folder without rows would stay as it was; readers drop rows without key.
    """
    new = scratch(df)
    left = sorted(set(clear) - set(touched(new))) if clear else []
    if left:
        nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in new.schema if f.name != BUCKET]
        none = df.sparkSession.createDataFrame([(b,) for b in left], f"{BUCKET} int").select(*nulls, BUCKET)
        new = new.unionByName(none)
    new.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
