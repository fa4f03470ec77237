"""Golden records: survivorship of attributes, consolidation of duplicates, folding of variants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from confluo.scratch import scratch


def golden_record(items: DataFrame, entity: str = "entity_id", most_aliases: int = 40, default_category: str = "general") -> DataFrame:
    """One row per entity from its observations.

    items: entity, trust, name, plain, key, url, height, not_24_7, country, category, source, ref. The first by
    (trust, lower name, url) gives the name; heights take the largest, not_24_7 any; aliases keep order, one a key;
    categories go by frequency, ties to the one seen first; references are a map of sorted sets by source. Names and
    categories are reduced to one row each before they are collected, so what an entity collects is its distinct values; of
    aliases only the first most_aliases are ranked (by each task first) and collected, however many an entity has.
    """
    order = F.struct("trust", F.lower("name").alias("l"), "url")
    base = items.groupBy(entity).agg(
        F.min_by("plain", order).alias("name"), F.max("height").alias("quality_height"), F.bool_or("not_24_7").alias("not_24_7"),
        F.array_sort(F.collect_set(F.when(F.col("country") != "", F.col("country")))).alias("countries"), F.array_sort(F.collect_set("source")).alias("sources"),
    )
    alias = items.where(~F.col("key").eqNullSafe("")).groupBy(entity, "key").agg(F.min(F.struct(order.alias("o"), F.col("name").alias("value"))).alias("x"))
    place = F.row_number().over(Window.partitionBy(entity).orderBy("x.o", "key"))
    alias = alias.withColumn("place", place).where(F.col("place") <= most_aliases)
    alias = alias.groupBy(entity).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "x.value"))), lambda a: a["value"]).alias("aliases"))
    cats = items.groupBy(entity, "category").agg(F.count("*").alias("n"), F.min(order).alias("o"))
    cats = cats.groupBy(entity).agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "o", F.coalesce("category", F.lit(default_category)).alias("c")))).alias("x")).select(entity, F.transform("x", lambda c: c["c"]).alias("categories"))
    refs = items.groupBy(entity, "source").agg(F.array_sort(F.collect_set("ref")).alias("r")).groupBy(entity).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("source", "r")))).alias("source_refs"))
    out = base.join(alias, entity, "left").join(cats, entity).join(refs, entity)
    return out.withColumn("aliases", F.coalesce("aliases", F.array().cast("array<string>")))


def consolidate(records: DataFrame, entity: str = "entity_id", slug: str = "slug") -> DataFrame:
    """One record per slug: the one whose id is the slug, else the shortest id (ties: the smallest) survives.

    records: entity, slug, name, marked (its name shows quality), arrays aliases, countries, categories, sources,
    manual, external_id. Arrays are united in member order, flags or-ed, gaps filled from the first that has a value;
    a plain name is preferred. Consolidating twice changes nothing.
    """
    order = F.struct((F.col(entity) != F.col(slug)).alias("a"), F.length(entity).alias("b"), F.col(entity).alias("c"))
    first = lambda c, has: F.min_by(c, F.when(has, order))
    base = records.groupBy(slug).agg(
        F.min_by(entity, order).alias(entity), F.coalesce(first("name", ~F.col("marked")), F.min_by("name", order)).alias("name"),
        F.bool_or("manual").alias("manual"), first("external_id", F.coalesce("external_id", F.lit("")) != "").alias("external_id"), F.count("*").alias("members"),
    )
    # each distinct value of a slug's arrays is one row before they are put together, however many members hold it
    arrays = ("aliases", "countries", "categories", "sources")
    tagged = lambda c: F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda v: F.struct(F.lit(c).alias("c"), v.alias("v")))
    each = records.select(F.col(slug), order.alias("o"), F.posexplode(F.concat(*map(tagged, arrays))).alias("pos", "x"))
    values = each.groupBy(slug, "x.c", "x.v").agg(F.min(F.struct("o", "pos")).alias("at"))
    of = lambda c: F.transform(F.array_sort(F.collect_list(F.when(F.col("c") == c, F.struct("at", "v")))), lambda x: x["v"]).alias(c)
    united = values.groupBy(slug).agg(*map(of, arrays)).withColumnRenamed(slug, "_slug")
    none = F.array().cast("array<string>")
    out = base.join(united, F.col(slug).eqNullSafe(F.col("_slug")), "left")
    return out.select(slug, entity, "name", *(F.coalesce(c, none).alias(c) for c in arrays), "manual", "external_id", "members")


def variant_fold(records: DataFrame, entity: str, name: str, key: str, base: str, base_key: str, countries: str) -> DataFrame:
    """(entity, winner) of region variants whose unqualified name is a published record in its own right.

    The winner is unqualified if possible, then has a country, then has the lowest id; each key has two best rows, so
    that a record is not its own winner. Records are written once, with what they are ranked by: their names are taken
    apart once.
    """
    rank = F.struct((F.col(base) != F.col(name)).alias("a"), (F.size(countries) == 0).alias("b"), F.col(entity).alias("c"))
    r = scratch(records.select(entity, F.col(key).alias("_key"), F.col(base_key).alias("_k"), rank.alias("r")))
    first = r.groupBy("_key").agg(F.min("r").alias("first"))
    rest = r.join(first, "_key").where("r <> first").groupBy("_key").agg(F.min("r").alias("second"))
    # one row a key: written, so that Spark sees how few they are
    best = scratch(first.join(rest, "_key", "left").select(F.col("_key").alias("_k"), "first", "second"))
    j = r.where("r.a").join(best, "_k")
    own = F.col("first.c") == F.col(entity)
    return j.select(entity, F.when(own, F.col("second.c")).otherwise(F.col("first.c")).alias("winner")).where("winner IS NOT NULL")


def feed_collapse(feeds: DataFrame, game: str = "game") -> DataFrame:
    """One row per game of its feeds: sources, references, earliest start and hint, least place."""
    return feeds.groupBy(game).agg(
        F.array_sort(F.collect_set("source")).alias("sources"), F.array_sort(F.collect_set("ref")).alias("refs"), F.min("start").alias("start"), F.min("ord").alias("ord"), F.count("*").alias("feeds"), F.min_by("display", "ord").alias("display")
    )


def category_order(rows: DataFrame, entity: str, category: str, ord_: str, front: Column) -> DataFrame:
    """Categories of each entity, in the order first seen, live leagues (front) before all."""
    one = rows.groupBy(entity, category).agg(F.min(ord_).alias("o"), F.max(front).alias("f"))
    return one.groupBy(entity).agg(F.transform(F.array_sort(F.collect_list(F.struct((~F.col("f")).alias("f"), "o", F.col(category).alias("c")))), lambda x: x["c"]).alias("categories"))
