"""Snapshots that replace: a source's new snapshot withdraws what it no longer lists.

A store holds, side by side, what each source lists now (by source), the candidates of all entities and the best of
each (both by the hash of the entity). A batch compares the snapshots that arrived with what their sources listed before;
entities with a row that came, went or changed are touched; candidates and bests are read and rewritten only in buckets
that hold a touched entity, and bests are chosen anew for touched entities alone. An entity whose best candidate is gone
falls to the next, one without candidates is gone. What sources list is written last, so a batch that failed half-way and
runs again finds the same differences; one that has run already finds none.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from confluo.operators import buckets, survive
from confluo.scratch import exists, scratch


@dataclass(frozen=True)
class Store:
    """Where the tables are, and the columns of their rows: entity, source and version, and whatever else rows have."""

    path: str
    schema: StructType
    n_buckets: int = 64
    entity: str = "entity_id"
    source: str = "source"
    version: str = "version"

    def listed(self, spark: SparkSession) -> DataFrame:
        """Rows of all sources' last snapshots."""
        at = f"{self.path}/listed"
        return spark.read.schema(self.schema).parquet(at) if exists(spark, at) else spark.createDataFrame([], self.schema)

    def candidates(self, spark: SparkSession, only: list[int] | None = None) -> DataFrame:
        return buckets.read(spark, f"{self.path}/candidates", self.schema, only).where(F.col(self.entity).isNotNull())

    def best(self, spark: SparkSession, only: list[int] | None = None) -> DataFrame:
        """The best candidate of each entity that has any."""
        return buckets.read(spark, f"{self.path}/best", self.schema, only).where(F.col(self.entity).isNotNull())


def refresh(store: Store, rows: DataFrame, rank: list[Column], emptied: DataFrame | None = None) -> dict[str, int]:
    """Take in the snapshots that rows hold whole, each source's latest if several came; older ones than listed are ignored.

    emptied: (source, version) of snapshots that list nothing. Returns numbers of touched entities and buckets.
    """
    spark, e, s, v = rows.sparkSession, store.entity, store.source, store.version
    names = [f.name for f in store.schema]
    rows = scratch(rows.select(*names).where(F.col(e).isNotNull() & F.col(s).isNotNull()))
    came = rows.select(s, v)
    if emptied is not None:
        came = came.unionByName(emptied.select(s, v))
    came = came.groupBy(s).agg(F.max(v).alias("_new"))
    known = store.listed(spark).groupBy(s).agg(F.max(v).alias("_old"))
    # one row a source: those that have a newer snapshot
    came = scratch(came.join(known, s, "left").where(F.col("_old").isNull() | (F.col("_new") > F.col("_old"))).select(s, "_new"))
    if came.isEmpty():
        return {"entities": 0, "buckets": 0}
    new = scratch(rows.join(came, s).where(F.col(v) == F.col("_new")).drop("_new"))
    old = store.listed(spark).where(F.col(e).isNotNull()).join(came.select(s), s, "left_semi")
    bare = [n for n in names if n != v]
    changed = new.select(*bare).subtract(old.select(*bare)).union(old.select(*bare).subtract(new.select(*bare)))
    entities = scratch(changed.select(e).distinct().withColumn(buckets.BUCKET, buckets.bucket_of(e, store.n_buckets)))
    only = buckets.touched(entities)
    ids = entities.select(e)
    if only:
        # of touched entities, other sources' rows stay and these sources' are replaced; the others' rows stay
        had = store.candidates(spark, only).select(*names)
        theirs = had.join(ids, e, "left_semi").join(came.select(s), s, "left_anti")
        fresh = scratch(theirs.unionByName(new.join(ids, e, "left_semi")))
        rest = had.join(ids, e, "left_anti")
        at = lambda df: df.withColumn(buckets.BUCKET, buckets.bucket_of(e, store.n_buckets))
        best = survive.survivors(fresh, [e], rank, [n for n in names if n != e]).select(*names)
        bests = store.best(spark, only).select(*names).join(ids, e, "left_anti").unionByName(best)
        # bests first: they are made of candidates that are still as they were
        buckets.overwrite(at(bests), f"{store.path}/best", only)
        buckets.overwrite(at(rest.unionByName(fresh)), f"{store.path}/candidates", only)
    now = new.select(*names)
    gone = came.join(now.select(s).distinct(), s, "left_anti")
    now = now.unionByName(gone.select(*(F.col(n) if n == s else F.col("_new").alias(n) if n == v else F.lit(None).cast(store.schema[n].dataType).alias(n) for n in names)))
    now.hint("rebalance", s).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(s).parquet(f"{store.path}/listed")
    return {"entities": entities.count(), "buckets": len(only)}
