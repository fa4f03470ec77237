"""Stored indexes: tables cut into buckets by their key once, so that repeated lookups move only the rows that ask."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from confluo.scratch import folder


def keep(df: DataFrame, keys: list[str], n_buckets: int = 64, name: str | None = None, path: str | None = None) -> DataFrame:
    """df written as a table in buckets by its keys and sorted by them within each; the result reads from there.

    A join or grouping by just these keys needs no exchange of the table: Spark deals the other side into as many parts.
    The table is named and placed as asked, else in the shared scratch folder under a name of its own.
    """
    spark = df.sparkSession
    name = name or f"stored_{uuid.uuid4().hex}"
    # one file a bucket: dealt by the same hash before it is written
    dealt = df.repartition(n_buckets, *keys)
    dealt.write.bucketBy(n_buckets, *keys).sortBy(*keys).mode("overwrite").option("path", path or folder(spark)).saveAsTable(name)
    return spark.table(name)


def drop(spark: SparkSession, df_or_name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS `{df_or_name}`")
