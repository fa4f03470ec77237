"""Health of candidates, folded from check results, and the upsert that marks absence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from confluo.operators import buckets, carry
from confluo.scratch import scratch

DISABLE_AFTER = 6


def status_of(failures: Column, disable_after: int = DISABLE_AFTER) -> Column:
    return F.when(failures == 0, "online").when(failures <= 2, "degraded").when(failures < disable_after, "unstable").otherwise("offline")


def fold(checks: DataFrame, key: str, at: list[str], ok: str, state: DataFrame | None = None, ephemeral: Column | None = None, disable_after: int = DISABLE_AFTER) -> DataFrame:
    """State of each candidate after its checks in order: failures in a row, status, enabled, last_check, last_success.

    A run of failures since the last success adds to the failures of the prior state (key, failures, last_success) if
    there was no success. Only aggregates: failures after the last success are those later than the greatest time of
    a success, so no candidate's history is sorted in one task.
    """
    when = F.struct(*at)
    last = checks.groupBy(key).agg(F.max(F.when(F.col(ok), when)).alias("_last_ok"))
    j = checks.join(last, key)
    agg = j.groupBy(key).agg(
        F.sum((F.col("_last_ok").isNull() | (when > F.col("_last_ok"))).cast("int")).cast("int").alias("_run"),
        F.max(when).alias("_at"), F.first("_last_ok").alias("_last_ok"),
    )
    time = at[0]
    if state is not None:
        agg = agg.join(state.select(F.col(key), F.col("failures").alias("_before"), F.col("last_success").alias("_succ")), key, "left")
    else:
        agg = agg.withColumn("_before", F.lit(0)).withColumn("_succ", F.lit(None).cast(checks.schema[time].dataType))
    failures = F.when(F.col("_last_ok").isNull(), F.coalesce("_before", F.lit(0)) + F.col("_run")).otherwise(F.col("_run")).cast("int")
    out = agg.select(key, failures.alias("failures"), F.col(f"_at.{time}").alias("last_check"), F.coalesce(F.col(f"_last_ok.{time}"), F.col("_succ")).alias("last_success"))
    live = F.col("failures") < disable_after
    return out.withColumn("status", status_of(F.col("failures"), disable_after)).withColumn("enabled", live | ephemeral if ephemeral is not None else live)


def runs(checks: DataFrame, key: str, at: list[str], ok: str, block: int = carry.BLOCK) -> DataFrame:
    """Each check with the failures in a row up to it.

    Failures so far less those at the last success, both carried from block to block, so that a candidate with a third of
    all checks is scanned by many tasks. Checks of unknown outcome are neither.
    """
    rows = carry.blocks(checks, [key], at, block)
    failed = carry.running(rows, [key], "_block", "_n", {"_failed": ("sum", (~F.col(ok)).cast("int"))})
    last = carry.running(failed, [key], "_block", "_n", {"_until": ("last", F.when(F.col(ok), F.col("_failed")))})
    return last.select(*checks.columns, (F.col("_failed") - F.coalesce("_until", F.lit(0))).alias("failures"))


def upsert(state: DataFrame, batch: DataFrame, key: str, full_run: bool = True) -> DataFrame:
    """New results replace rows of the state; on a full run, rows not in the batch become absent."""
    cols = [c for c in state.columns if c not in (key, "present")]
    s, b = state.alias("s"), batch.withColumn("_in", F.lit(True)).alias("b")
    j = s.join(b, F.col(f"s.{key}") == F.col(f"b.{key}"), "full_outer")
    new = F.coalesce("b._in", F.lit(False))
    present = F.when(new, True).otherwise(F.lit(False) if full_run else F.col("s.present"))
    return j.select(F.coalesce(f"b.{key}", f"s.{key}").alias(key), *(F.when(new, F.col(f"b.{c}")).otherwise(F.col(f"s.{c}")).alias(c) for c in cols), present.alias("present"))


def upsert_into(path: str, schema: StructType, batch: DataFrame, key: str, full_run: bool = True, n_buckets: int = 64) -> int:
    """upsert() into a state kept by the hash of its key; returns the number of buckets rewritten, others stay as they are.

    schema: of the state's rows (key, values, present). On a full run, buckets also change that hold a row which was
    present and is not in the batch; to find them, only keys and marks of the state are read.
    """
    spark = batch.sparkSession
    b = scratch(batch.withColumn(buckets.BUCKET, buckets.bucket_of(key, n_buckets)))
    only = set(buckets.touched(b))
    if full_run:
        only |= set(buckets.touched(buckets.read(spark, path, schema).where("present").join(b.select(key), key, "left_anti")))
    new = upsert(buckets.read(spark, path, schema, only).drop(buckets.BUCKET), b.drop(buckets.BUCKET), key, full_run)
    buckets.overwrite(new.withColumn(buckets.BUCKET, buckets.bucket_of(key, n_buckets)), path)
    return len(only)
