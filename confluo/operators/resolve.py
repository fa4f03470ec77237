"""Resolution of observations to entities, never merging ambiguous names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_index(entities: DataFrame, keys: str = "keys", entity: str = "entity_id", countries: str = "countries") -> tuple[DataFrame, DataFrame]:
    """One row per name key (n, only_id, n_agnostic, agnostic_id), and one per key and country (n, only_id).

    Joins against these are N:1, so a name that thousands of entities share multiplies nothing.
    """
    each = entities.select(F.col(entity).alias("id"), F.explode(F.array_distinct(keys)).alias("key"), F.col(countries).alias("countries")).where("key <> ''")
    free = F.when(F.size("countries") == 0, F.col("id"))
    by_name = each.groupBy("key").agg(F.count("id").alias("n"), F.min("id").alias("only_id"), F.count(free).alias("n_agnostic"), F.min(free).alias("agnostic_id"))
    by_country = each.select("id", "key", F.explode("countries").alias("country")).distinct().groupBy("key", "country").agg(F.count("id").alias("n_country"), F.min("id").alias("country_id"))
    return by_name, by_country


def resolve(entries: DataFrame, entities: DataFrame, aliases: DataFrame, entry_key: str = "entry_key", source: str = "source", keys: str = "keys", country: str = "country", slug: str = "slug") -> DataFrame:
    """Add entity_id and matched_by to entries.

    1. a source's alias for any of the entry's keys, the first by place; 2. the first key that names any entity;
    3. if it names several: the one of the entry's country, else the one without country; 4. else a fallback id:
    the slug, with the country if the slug belongs to an entity elsewhere, marked unmapped if the name was ambiguous.

    entries: entry_key, source, keys (array), country ('' if unknown), slug. entities: entity_id, keys, countries.
    aliases: source, alias_key, entity_id (one row a source and key: see unique_refs).
    """
    by_name, by_country = key_index(entities)
    each = entries.select(F.col(entry_key).alias("e"), F.col(source).alias("source"), F.col(country).alias("country"), F.posexplode(keys).alias("pos", "key")).where("key <> ''")
    live = aliases.join(entities.select("entity_id"), "entity_id", "left_semi").select("source", F.col("alias_key").alias("key"), F.col("entity_id").alias("alias_id"))
    hit = each.join(live, ["source", "key"], "left").join(by_name, "key", "left").join(by_country, ["key", "country"], "left")
    found = F.struct("n", "only_id", "n_agnostic", "agnostic_id", "n_country", "country_id")
    best = hit.groupBy("e").agg(F.min_by("alias_id", F.when(F.col("alias_id").isNotNull(), F.col("pos"))).alias("alias_id"), F.min_by(found, F.when(F.col("n").isNotNull(), F.col("pos"))).alias("f"))
    known = entities.select(F.col("entity_id").alias("_own"), F.col("countries").alias("_own_countries"))
    out = entries.join(best, F.col(entry_key) == F.col("e"), "left").join(known, F.col(slug) == F.col("_own"), "left")
    n = F.coalesce("f.n", F.lit(0))
    # several entities share the name: the country decides, else the one without any
    by_place = F.when(F.col("f.n_country") >= 1, F.when(F.col("f.n_country") == 1, F.col("f.country_id"))).when(F.col("f.n_agnostic") == 1, F.col("f.agnostic_id"))
    several = F.when(F.col(country) != "", by_place).when(F.col("f.n_agnostic") == 1, F.col("f.agnostic_id"))
    one = F.when(n == 1, F.col("f.only_id")).when(n > 1, several)
    elsewhere = (F.col(country) != "") & F.col("_own").isNotNull() & ~F.coalesce(F.array_contains("_own_countries", F.col(country)), F.lit(False))
    fallback = F.when(elsewhere, F.concat(F.col(slug), F.lit("-"), F.lower(F.col(country)))).when(n > 1, F.concat(F.lit("unmapped-"), F.col(slug))).otherwise(F.col(slug))
    how = F.when(F.col("alias_id").isNotNull(), "source-alias").when(one.isNotNull(), "canonical-name").when(n > 1, "ambiguous-fallback").otherwise("fallback")
    return out.select(*[entries[c] for c in entries.columns], F.coalesce("alias_id", one, fallback).alias("entity_id"), how.alias("matched_by"))


def unique_refs(refs: DataFrame, curated: DataFrame | None = None, source: str = "source", ref: str = "ref", entity: str = "entity_id") -> DataFrame:
    """(source, ref, entity_id) of references that one entity alone claims; curated rows always win."""
    own = refs.groupBy(source, ref).agg(F.min(entity).alias("lo"), F.max(entity).alias("hi")).where("lo = hi").select(source, ref, F.col("lo").alias(entity))
    if curated is None:
        return own
    return own.join(curated.select(source, ref), [source, ref], "left_anti").unionByName(curated.select(source, ref, entity))


def conditional_id(items: DataFrame, slug: str = "slug", country: str = "country", manual: DataFrame | None = None) -> DataFrame:
    """Add entity_id: the slug if all its observations share one country, else slug-country; ids of manual entities
    that these clash with are qualified too."""
    c = F.coalesce(country, F.lit(""))
    spread = items.groupBy(slug).agg((F.min(c) != F.max(c)).alias("_many"))
    out = items.join(spread, slug)
    qualify: Column = F.col("_many")
    if manual is not None:
        out = out.join(manual.select(F.col("entity_id").alias("_manual")).distinct(), F.col(slug) == F.col("_manual"), "left")
        qualify = qualify | F.col("_manual").isNotNull()
    qualified = F.when(c != "", F.concat(F.col(slug), F.lit("-"), F.lower(c))).otherwise(F.col(slug))
    return out.withColumn("entity_id", F.when(qualify, qualified).otherwise(F.col(slug))).drop("_many", "_manual")
