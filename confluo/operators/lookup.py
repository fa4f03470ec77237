"""Lookups in outside tables: ranked, by several keys, by alias, with overrides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def asset_index(assets: DataFrame, rank: list[Column], value: str) -> tuple[DataFrame, DataFrame]:
    """The best asset by key and country (_k1, _c1, _own), and by key alone (_k2, _any): one row a key each."""
    win = F.min_by(F.col(value), F.struct(*(r.alias(f"r{i}") for i, r in enumerate(rank))))
    own = assets.where(F.col("country") != "").groupBy("key", "country").agg(win.alias("_own")).select(F.col("key").alias("_k1"), F.col("country").alias("_c1"), "_own")
    return own, assets.groupBy("key").agg(win.alias("_any")).select(F.col("key").alias("_k2"), "_any")


def from_index(df: DataFrame, index: tuple[DataFrame, DataFrame], key: str, country: str, out: str) -> DataFrame:
    """Add the value of the best asset of asset_index(): of the row's country if it has one (never another's), else of any."""
    own, anywhere = index
    c = F.coalesce(F.col(country), F.lit(""))
    j = df.join(own, (F.col(key) == F.col("_k1")) & (F.upper(c) == F.col("_c1")), "left").join(anywhere, F.col(key) == F.col("_k2"), "left")
    return j.select(*df.columns, F.coalesce(F.when(c != "", F.col("_own")).otherwise(F.col("_any")), F.lit("")).alias(out))


def ranked_lookup(df: DataFrame, assets: DataFrame, key: str, country: str, rank: list[Column], value: str, out: str) -> DataFrame:
    """from_index() over an index made for this once. assets: key, country, value and what rank refers to."""
    return from_index(df, asset_index(assets, rank, value), key, country, out)


def ordered_fallback(df: DataFrame, row: str, keys: str, index: DataFrame, out: str, miss=None) -> DataFrame:
    """Add the value of the first of a row's keys that the index (key, value; one row a key) knows."""
    each = df.select(F.col(row).alias("_row"), F.posexplode(keys).alias("pos", "key"))
    best = each.join(index, "key").groupBy("_row").agg(F.min_by("value", "pos").alias("_value"))
    return df.join(best, F.col(row) == F.col("_row"), "left").select(*df.columns, F.coalesce("_value", F.lit(miss)).alias(out))


def matched_counts(df: DataFrame, value: str, miss=None) -> DataFrame:
    """(outcome, n): rows that a lookup found something for, and those it gave the value of a miss."""
    missed = F.col(value).eqNullSafe(F.lit(miss))
    return df.groupBy(F.when(missed, "unmatched").otherwise("matched").alias("outcome")).agg(F.count("*").alias("n"))


def multi_key_union(df: DataFrame, row: str, keys: str, index: DataFrame) -> DataFrame:
    """(row, languages, english): languages of all keys found, up to the first that says True; the flag is True if one
    is, else False if one is, else unknown; a False with an English code among the languages is True."""
    each = df.select(F.col(row).alias(row), F.posexplode(keys).alias("pos", "key")).join(index, "key")
    seen = each.groupBy(row).agg(F.array_sort(F.collect_list(F.struct("pos", "languages", "english"))).alias("s"))
    stop = F.array_position(F.transform("s", lambda x: F.coalesce(x["english"], F.lit(False))), True)
    used = F.when(stop > 0, F.slice("s", 1, stop.cast("int"))).otherwise(F.col("s"))
    langs = F.array_sort(F.array_distinct(F.flatten(F.transform(used, lambda x: F.transform(x["languages"], F.lower)))))
    no = F.exists("s", lambda x: ~x["english"])
    found = seen.select(row, langs.alias("languages"), F.when(stop > 0, True).when(no, F.exists(langs, lambda x: F.startswith(x, F.lit("eng")))).alias("english"))
    return df.select(row).join(found, row, "left").select(row, F.coalesce("languages", F.array().cast("array<string>")).alias("languages"), "english")


def alias_join(df: DataFrame, key: Column, name: Column, aliases: DataFrame, default: str, out: str) -> DataFrame:
    """Add the slug of an alias (alias, slug); without one, names in brackets are entertainment, others the default.

    An alias that occurs more than once counts once, with its least slug, so no row is multiplied. Spark broadcasts the
    aliases only if they are small.
    """
    bracket = F.startswith(F.ltrim(name), F.lit("["))
    one = aliases.groupBy(F.col("alias").alias("_key")).agg(F.min("slug").alias("_slug"))
    j = df.withColumn("_key", key).join(one, "_key", "left")
    return j.select(*df.columns, F.coalesce("_slug", F.when(bracket, "entertainment").otherwise(default)).alias(out))


def override(df: DataFrame, key: str, overrides: DataFrame, matches: DataFrame, out: str) -> DataFrame:
    """Override, else match, else nothing (a former value is cleared). Both tables: key, value; of a key that occurs more
    than once the least value counts, so no row is multiplied."""
    o = overrides.groupBy(F.col("key").alias("_k1")).agg(F.min("value").alias("_o"))
    m = matches.groupBy(F.col("key").alias("_k2")).agg(F.min("value").alias("_m"))
    j = df.drop(out).join(o, F.col(key) == F.col("_k1"), "left").join(m, F.col(key) == F.col("_k2"), "left")
    return j.withColumn(out, F.coalesce("_o", "_m")).drop("_k1", "_o", "_k2", "_m")


def worklist(df: DataFrame, assets: DataFrame, key: str) -> DataFrame:
    """Rows whose key has no asset."""
    return df.join(assets.select(F.col("key").alias(key)), key, "left_anti")


def sources_index(entries: DataFrame, key: str, source: str, ref: str) -> DataFrame:
    """Each key's sources and references, one row a key."""
    return entries.groupBy(key).agg(F.array_sort(F.collect_set(source)).alias("sources"), F.array_sort(F.collect_set(ref)).alias("refs"))


def allow_list(guide: DataFrame, entries: DataFrame, key: str, source: str, ref: str) -> DataFrame:
    """All guide rows with sources and references of matching entries; those without stay, disabled as no-source."""
    return with_sources(guide, sources_index(entries, key, source, ref), key)


def with_sources(guide: DataFrame, index: DataFrame, key: str) -> DataFrame:
    """allow_list() over a sources_index()."""
    j = guide.join(index, key, "left")
    empty = lambda c: F.coalesce(c, F.array().cast(index.schema[c].dataType))
    return j.select(*guide.columns, empty("sources").alias("sources"), empty("refs").alias("refs"), F.col("sources").isNotNull().alias("enabled"), F.when(F.col("sources").isNull(), "no-source").otherwise("").alias("excluded_by"))


def best_asset(df: DataFrame, article: str, title: str, image: str, plausible: Column) -> DataFrame:
    """(article, image) of the best plausible image: exact prefix, most title words, vectors first, then the name."""
    stem = F.lower(image)
    words = F.filter(F.split(F.lower(title), "[^a-z0-9]+"), lambda w: F.length(w) > 2)
    overlap = F.size(F.filter(words, lambda w: F.contains(stem, w)))
    exact = F.startswith(stem, F.concat(F.lit("file:"), F.lower(title), F.lit(" ")))
    rank = F.struct((~exact).alias("a"), (-overlap).alias("b"), (~F.endswith(stem, F.lit(".svg"))).alias("c"), F.col(image).alias("d"))
    return df.where(plausible).groupBy(article).agg(F.min_by(image, rank).alias(image))
