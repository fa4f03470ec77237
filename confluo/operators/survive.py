"""Survivorship of candidates and first- or best-wins deduplication, by aggregates with map-side combine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rank of a health status; others rank 2, no state 1.
STATUS_RANKS = {"online": 0, "unknown": 1, "degraded": 2, "unstable": 3, "offline": 4}
NO_RESPONSE = 10**9


def status_rank(status: Column) -> Column:
    m = F.create_map(*(F.lit(x) for kv in STATUS_RANKS.items() for x in kv))
    return F.when(status.isNull(), 1).otherwise(F.coalesce(m[F.lower(status)], F.lit(2)))


def effective_enabled(df: DataFrame, enabled: str = "enabled", failures: str = "failures", disable_after: int = 6) -> Column:
    """Usable unless state says disabled or failed too often; no state is usable."""
    return F.coalesce(enabled, F.lit(True)) & (F.coalesce(failures, F.lit(0)) < disable_after)


def survivors(candidates: DataFrame, entity: list[str], rank: list[Column], keep: list[str]) -> DataFrame:
    """The row of least rank per entity."""
    return candidates.groupBy(*entity).agg(F.min_by(F.struct(*keep), F.struct(*(r.alias(f"r{i}") for i, r in enumerate(rank)))).alias("_b")).select(*entity, "_b.*")


def candidate_rank(status: Column, trust: Column, failures: Column, response_ms: Column, height: Column, tie: list[Column], disable_after: int = 6) -> list[Column]:
    """Health, then trust, then capped failures, latency, quality; trust outranks latency."""
    return [status_rank(status), trust, F.least(F.coalesce(failures, F.lit(0)), F.lit(disable_after)), F.coalesce(response_ms, F.lit(NO_RESPONSE)), -F.coalesce(height, F.lit(0)), *tie]


def first_wins(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in source and line order, whatever the partitioning."""
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_b")).select(*key, "_b.*")


def keep_best(df: DataFrame, key: list[str], score: Column, order: list[str]) -> DataFrame:
    """The row of highest score of each key; the first in order wins ties."""
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct((-score).alias("_s"), *order)).alias("_b")).select(*key, "_b.*")


def best_element(items: Column, online, rank) -> Column:
    """The best of an array of structs: online ones if there are any, the first of highest rank."""
    up = F.filter(items, online)
    use = F.when(F.size(up) > 0, up).otherwise(items)
    placed = F.transform(use, lambda x, i: F.struct(rank(x).alias("r"), (-i).alias("i"), x.alias("x")))
    return F.array_max(placed)["x"]
