"""Reports, indexes and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counts(df: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    """(metric, key, value): rows by each metric's value; array metrics count a row under each element.

    All metrics are one explode and one aggregate, so the input is read once.
    """
    def pairs(name: str, c: Column) -> Column:
        pair = lambda x: F.struct(F.lit(name).alias("metric"), x.cast("string").alias("key"))
        many = df.select(c).schema[0].dataType.typeName() == "array"
        return F.transform(c, pair) if many else F.array(pair(c))

    each = [pairs(n, c) for n, c in metrics.items()]
    return df.select(F.explode(F.concat(*each)).alias("m")).groupBy("m.metric", "m.key").agg(F.count("*").alias("value"))


def check_rate(df: DataFrame, group: str, ok: Column) -> DataFrame:
    """ok, failed and rate of each group and of all (TOTAL)."""
    r = df.rollup(group).agg(F.count_if(ok).alias("ok"), F.count_if(~ok).alias("failed"), F.grouping(group).alias("_all"))
    return r.select(F.when(F.col("_all") == 1, "TOTAL").otherwise(F.col(group)).alias(group), "ok", "failed", F.round(F.col("ok") / (F.col("ok") + F.col("failed")), 4).alias("rate"))


def failed_report(df: DataFrame, category: str, ok: Column, skipped: str) -> DataFrame:
    """By category: active and failed rows; failed rows of the skipped category are counted apart, not listed."""
    return df.groupBy(category).agg(F.count_if(ok).alias("active"), F.count_if(~ok & (F.col(category) != skipped)).alias("failed"), F.count_if(~ok & (F.col(category) == skipped)).alias("skipped"))


def failed_rows(df: DataFrame, category: str, ok: Column, keep: list[str], skipped: str | None = None) -> DataFrame:
    """The failed rows themselves, but for those of the skipped category; an unknown outcome has failed."""
    bad = ~F.coalesce(ok, F.lit(False))
    return df.where(bad if skipped is None else bad & ~F.coalesce(F.col(category) == skipped, F.lit(False))).select(category, *keep)


def nested_index(entities: DataFrame, candidates: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Entities with the sorted array of all their candidates."""
    c = candidates.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("candidates"))
    return entities.join(c, key, "left")


def tri_state_index(sources: list[DataFrame], key: str, language: str, flag: str) -> DataFrame:
    """(key, languages, english) of united sources: the flag is True if any says so, False if known otherwise, else
    unknown."""
    u = reduce(DataFrame.unionByName, sources)
    return u.groupBy(key).agg(F.array_sort(F.collect_set(language)).alias("languages"), F.bool_or(flag).alias("english"))


def union_sources(sources: dict[str, DataFrame]) -> DataFrame:
    """All sources with their name and place."""
    return reduce(DataFrame.unionByName, (df.withColumn("source", F.lit(n)).withColumn("source_ord", F.lit(i)) for i, (n, df) in enumerate(sources.items())))


def set_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(side, key): keys that only one side has."""
    x, y = a.select(key).distinct().withColumn("_a", F.lit(True)), b.select(key).distinct().withColumn("_b", F.lit(True))
    j = x.join(y, key, "full_outer").where("_a IS NULL OR _b IS NULL")
    return j.select(F.when(F.col("_b").isNull(), "left").otherwise("right").alias("side"), key)
