"""Orders, dense numbering at scale, interleaving, systematic samples, publication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from confluo.scratch import scratch


def number(df: DataFrame, order: list[Column], out: str = "number", partitions: int | None = None) -> DataFrame:
    """Add dense numbers 1..n in an order; rows that tie in it get numbers in any order.

    Rows are range-partitioned and sorted once and written to the shared folder with their partition and their place in
    it; a row's number is its place plus the rows of the partitions before it (one row a partition), so no task sees all
    rows. They are written since a range exchange that runs twice may cut elsewhere. An empty table stays empty.
    """
    names = [f"_o{i}" for i in range(len(order))]
    keyed = df.select("*", *(c.alias(n) for c, n in zip(order, names, strict=True)))
    placed = keyed.repartitionByRange(*([partitions] if partitions else []), *names).sortWithinPartitions(*names).drop(*names)
    # the low 33 bits of such an id count the rows of a partition, the others are the partition
    at = scratch(placed.withColumn("_at", F.monotonically_increasing_id()).withColumn("_p", F.shiftright("_at", 33)).withColumn("_r", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_at"))
    n = at.groupBy("_p").agg(F.count("*").alias("n"))
    before = n.select("_p", (F.sum("n").over(Window.orderBy("_p")) - F.col("n")).alias("_before"))
    # one row a partition of the sort: a bound on what is broadcast
    return at.join(F.broadcast(before), "_p").withColumn(out, (F.col("_r") + F.col("_before") + 1).cast("long")).drop("_p", "_r", "_before")


def folded(name: Column) -> Column:
    """A name for comparison without case: lower case, with the sharp s written out."""
    return F.replace(F.lower(F.coalesce(name, F.lit(""))), F.lit("ß"), F.lit("ss"))


def lineup(records: DataFrame, leagues: list[str], default_category: str = "general", out: str = "number") -> DataFrame:
    """Number records as they are published: by folded name, then those whose first category is a live league.

    records: entity_id, name, categories (array), live_league, live_suborder, league_group, event_start, event_hint,
    live_order. Live ones go by league in the given order (others after all), block, group, start (unknown ones last), hint
    (the same), guide order, folded name; ties go to the id.
    """
    known = F.array(*map(F.lit, leagues))
    live = F.array_contains(known, F.coalesce(F.try_element_at("categories", F.lit(1)), F.lit(default_category)))
    place = F.array_position(known, F.coalesce("live_league", F.lit("")))
    # unknown times sort after all that begin with digits or letters
    late = lambda c, sign: F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit(sign))
    block = [F.when(place > 0, place).otherwise(len(leagues) + 1), F.coalesce("live_suborder", F.lit(0)), F.coalesce("league_group", F.lit("")), late("event_start", "~~~"), late("event_hint", "~~"), F.coalesce("live_order", F.lit(0))]
    return number(records, [live, *(F.when(live, k) for k in block), folded(F.coalesce("name", "entity_id")), F.col("entity_id")], out)


def _in_groups(df: DataFrame, group: Column, order: str) -> DataFrame:
    """Add _turn (from 1), the place within the group, and _low and _size, the group's least order and number of rows.

    Numbered over all rows, so that a group of any size is sorted by many tasks.
    """
    all_ = number(df.withColumn("_g", group), [F.col("_g"), F.col(order)], "_n")
    first = all_.groupBy("_g").agg(F.min("_n").alias("_first"), F.min(order).alias("_low"), F.count("*").alias("_size"))
    joined = all_.alias("a").join(first.alias("f"), F.col("a._g").eqNullSafe(F.col("f._g")))
    return joined.select("a.*", "_low", "_size", (F.col("_n") - F.col("_first") + 1).alias("_turn")).drop("_g", "_n")


def interleave(df: DataFrame, group: Column, pos: str, out: str = "turn") -> DataFrame:
    """Round-robin over groups: add turn (place within the group) and first (the group's first place); sorting by
    both gives the order."""
    return _in_groups(df, group, pos).withColumnsRenamed({"_turn": out, "_low": "first"}).drop("_size")


def systematic_sample(df: DataFrame, group: str, order: str, k: int) -> DataFrame:
    """Every max(1, n // k)-th row of each group, the first k of them."""
    step = F.greatest(F.lit(1), F.floor(F.col("_size") / k))
    placed = _in_groups(df, F.col(group), order)
    return placed.where(((F.col("_turn") - 1) % step == 0) & ((F.col("_turn") - 1) / step < k)).drop("_turn", "_low", "_size")


def publish(df: DataFrame, number_: Column, external: Column, own: Column, name: Column, asset: Column, country: Column, category: Column) -> DataFrame:
    """Attributes of a published row in their order: number, id, name, asset and country if known, category."""
    item = lambda k, v: F.struct(F.lit(k).alias("k"), F.coalesce(v.cast("string"), F.lit("")).alias("v"))
    attrs = F.array(item("number", number_), item("id", F.coalesce(F.nullif(external, F.lit("")), own)), item("name", name), item("asset", asset), item("country", country), item("group", category))
    return df.withColumn("attrs", F.filter(attrs, lambda a: a["v"] != ""))
