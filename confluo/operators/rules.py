"""Inclusion rules: each is a Column that holds the reason for exclusion, or '' to keep; cascade takes the first."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from confluo.functions.names import col

KEEP = ""


def _any(c: Column, patterns: Iterable[str]) -> Column:
    return reduce(lambda a, p: a | c.rlike(p), patterns, F.lit(False))


def _array(values: Iterable[str]) -> Column:
    return F.array(*(F.lit(v) for v in values)).cast("array<string>")


def cascade(df: DataFrame, rules: list[Column], manual: Column | None = None, reason_col: str = "excluded_by", enabled_col: str = "enabled") -> DataFrame:
    """Add the first non-empty reason (recomputed, whatever the input holds) and whether the row stays enabled."""
    first = F.coalesce(*(F.nullif(r, F.lit(KEEP)) for r in rules), F.lit(KEEP))
    if manual is not None:
        first = F.when(F.coalesce(manual, F.lit(False)), KEEP).otherwise(first)
    return df.withColumn(reason_col, first).withColumn(enabled_col, F.col(reason_col) == KEEP)


def language(entity, categories, languages, english, *, within, keep=(), except_ids=(), except_categories=(), unknown="keep") -> Column:
    """english is tri-state: null (unknown) follows the policy, true stays, false stays only with a kept language."""
    listed = F.array_sort(F.array_distinct(F.transform(F.coalesce(col(languages), _array(())), F.lower)))
    reason = F.concat(F.lit("language:"), F.when(F.size(listed) > 0, F.concat_ws(",", listed)).otherwise("non-english"))
    return (
        F.when(col(entity).isin(list(except_ids)) if except_ids else F.lit(False), KEEP)
        .when(~F.arrays_overlap(col(categories), _array(within)), KEEP)
        .when(F.arrays_overlap(col(categories), _array(except_categories)) if except_categories else F.lit(False), KEEP)
        .when(col(english).isNull(), KEEP if unknown == "keep" else "language:unknown")
        .when(col(english), KEEP)
        .when(F.arrays_overlap(listed, _array(keep)) if keep else F.lit(False), KEEP)
        .otherwise(reason)
    )


def quality(categories, height, not_24_7, *, within, max_height=None, require_247=False) -> Column:
    """Unknown heights pass."""
    tall = F.coalesce(col(height) > max_height, F.lit(False)) if max_height is not None else F.lit(False)
    return (
        F.when(~F.arrays_overlap(col(categories), _array(within)), KEEP)
        .when(tall, F.concat(F.lit("quality:"), col(height).cast("string"), F.lit("p")))
        .when(F.coalesce(col(not_24_7), F.lit(False)) & F.lit(require_247), "not-24/7")
        .otherwise(KEEP)
    )


def name_patterns(name, categories, *, within, any_case=(), cased=(), reason="radio") -> Column:
    n = F.coalesce(col(name), F.lit(""))
    hit = _any(n, [f"(?iU){p}" for p in any_case]) | _any(n, cased)
    return F.when(F.arrays_overlap(col(categories), _array(within)) & hit, reason).otherwise(KEEP)


def event_expiry(start, kind, *, as_of: Column, hours: dict[str, float], default_hours: float, enabled: bool = True) -> Column:
    """Expired when as_of is past the start by more than the kind's duration, in hours or parts of one; unknown starts stay."""
    if not enabled:
        return F.lit(KEEP)
    length = reduce(lambda rest, kv: F.when(col(kind) == kv[0], float(kv[1])).otherwise(rest), hours.items(), F.lit(float(default_hours)))
    end = col(start) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (length * 3600).cast("decimal(18,6)"))
    return F.when(F.coalesce(as_of > end, F.lit(False)), F.concat(F.lit("event-ended:"), F.date_format(col(start), "yyyy-MM-dd HH:mm:ss"))).otherwise(KEEP)


def exclude(entity, name, categories, *, ids=(), drop_categories=(), patterns=()) -> Column:
    """By id, by category, by the first name pattern, which the reason names."""
    out = reduce(lambda rest, p: F.when(F.coalesce(col(name), F.lit("")).rlike(p), f"name:{p}").otherwise(rest), reversed(list(patterns)), F.lit(KEEP))
    if drop_categories:
        out = F.when(F.arrays_overlap(col(categories), _array(drop_categories)), "category").otherwise(out)
    return F.when(col(entity).isin(list(ids)), F.concat(F.lit("channel:"), col(entity))).otherwise(out) if ids else out


def nested_any(name, countries, refs, *, any_case=(), call_signs=(), call_countries=(), cased=(), ref_patterns=(), reason="local") -> Column:
    """Name patterns; call signs only where the country issues them; patterns over any element of nested references."""
    n = F.coalesce(col(name), F.lit(""))
    in_refs = F.exists(F.flatten(F.map_values(F.coalesce(col(refs), F.create_map().cast("map<string,array<string>>")))), lambda x: _any(x, ref_patterns))
    signs = F.arrays_overlap(col(countries), _array(call_countries)) & _any(n, call_signs) if call_countries else F.lit(False)
    return F.when(_any(n, [f"(?i){p}" for p in any_case]) | signs | _any(n, cased) | in_refs, reason).otherwise(KEEP)


def allow_list(name, categories, countries, *, allow, brands=(), except_categories=(), unknown="drop") -> Column:
    """Countries must meet the allow list; whole-word brands and some categories are exempt."""
    padded = F.concat(F.lit(" "), F.lower(F.coalesce(col(name), F.lit(""))), F.lit(" "))
    brand = reduce(lambda a, b: a | F.contains(padded, F.lit(f" {b} ")), brands, F.lit(False))
    free = F.arrays_overlap(col(categories), _array(except_categories)) if except_categories else F.lit(False)
    known = F.array_sort(F.coalesce(col(countries), _array(())))
    return (
        F.when(brand | free, KEEP)
        .when(F.size(known) == 0, "country:unknown" if unknown == "drop" else KEEP)
        .when(F.arrays_overlap(known, _array(allow)), KEEP)
        .otherwise(F.concat(F.lit("country:"), F.concat_ws(",", known)))
    )


def drop_groups(df: DataFrame, group, patterns: Iterable[str]) -> tuple[DataFrame, DataFrame]:
    """Rows outside the excluded groups, and how many rows each excluded group had."""
    hit = _any(F.coalesce(col(group), F.lit("")), [f"(?iU){p}" for p in patterns])
    return df.where(~hit), df.where(hit).groupBy(col(group).alias("dropped_group")).agg(F.count("*").alias("n"))


def same_day_or_undated(day, as_of) -> Column:
    return col(day).isNull() | (F.to_date(col(day)) == F.to_date(as_of))


def multi_value(values, wanted: Iterable[str], sep: str = ";") -> Column:
    """Whether a separated list has a wanted member."""
    return F.arrays_overlap(F.transform(F.split(F.coalesce(col(values), F.lit("")), sep), lambda x: F.lower(F.trim(x))), _array(wanted))


def min_quality(height, least: int, include_unknown: bool = False) -> Column:
    return F.coalesce(col(height) >= least, F.lit(include_unknown))


def retained(df: DataFrame, seen: DataFrame, curated: DataFrame, key: str, manual: Column, sourceless: Column) -> DataFrame:
    """Historical rows that are manual, without sources, seen now, or the target of a curated alias."""
    kept = seen.select(key).unionByName(curated.select(key)).distinct().withColumn("_hit", F.lit(True))
    return df.join(kept, key, "left").where(F.coalesce(manual, F.lit(False)) | F.coalesce(sourceless, F.lit(False)) | F.col("_hit").isNotNull()).drop("_hit")
