"""Data-quality checks: each returns violations as (check, key, detail)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations(df: DataFrame, key: Column, checks: dict[str, Column], detail: Column | None = None) -> DataFrame:
    """Rows that fail a check, once for each; the input is read once."""
    d = detail.cast("string") if detail is not None else F.lit("")
    hits = F.filter(F.array(*(F.when(F.coalesce(bad, F.lit(False)), n) for n, bad in checks.items())), lambda x: x.isNotNull())
    return df.select(F.explode(hits).alias("check"), key.cast("string").alias("key"), F.coalesce(d, F.lit("")).alias("detail"))


def references(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Keys of child without a parent, and parents' keys that occur more than once, with their counts."""
    lost = child.join(parent.select(F.col(pk).alias(fk)), fk, "left_anti").groupBy(fk).agg(F.count("*").alias("n")).select(F.lit("missing").alias("check"), F.col(fk).cast("string").alias("key"), F.col("n").cast("string").alias("detail"))
    twice = parent.groupBy(pk).agg(F.count("*").alias("n")).where("n > 1").select(F.lit("duplicate").alias("check"), F.col(pk).cast("string").alias("key"), F.col("n").cast("string").alias("detail"))
    return lost.unionByName(twice)


#: Fixed value: the form of an entity's id.
ID = r"^[a-z0-9]+(?:-[a-z0-9]+)*$"


def records(df: DataFrame, entity: str, name: str) -> DataFrame:
    """Records whose id has another form (bad-id) or whose name is blank (blank-name)."""
    return violations(df, F.col(entity), {"bad-id": ~F.coalesce(F.col(entity).rlike(ID), F.lit(False)), "blank-name": F.trim(F.coalesce(F.col(name), F.lit(""))) == ""}, F.col(name))


def ambiguous_aliases(records: DataFrame, entity: str, key: str, countries: str) -> DataFrame:
    """(key, country, n, first, last) of keys that several records of one country, or several without any, share.

    Records that clash are grouped, not paired: a key that n records share gives one row a country, not n squared.
    """
    place = F.when(F.size(countries) == 0, F.array(F.lit(""))).otherwise(F.array_distinct(countries))
    each = records.select(F.col(entity).alias("e"), F.col(key).alias("key"), F.explode(place).alias("country")).where("key <> ''").distinct()
    return each.groupBy("key", "country").agg(F.count("*").alias("n"), F.min("e").alias("first"), F.max("e").alias("last")).where("n > 1")


def completeness(inputs: DataFrame, source: str, expected: DataFrame, least: str) -> DataFrame:
    """(source, n, complete): whether each expected source has at least its least number of rows."""
    n = inputs.groupBy(source).agg(F.count("*").alias("n"))
    return expected.join(n, source, "left").select(source, F.coalesce("n", F.lit(0)).alias("n"), (F.coalesce("n", F.lit(0)) >= F.col(least)).alias("complete"))


def demand(df: DataFrame, bad: Column, message: str) -> DataFrame:
    """df, whose evaluation fails at the first bad row (strict mode)."""
    return df.where(F.when(bad, F.raise_error(F.lit(message)).cast("boolean")).otherwise(True))
