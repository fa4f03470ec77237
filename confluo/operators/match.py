"""Exact-unique and fuzzy matching to outside tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from confluo.scratch import scratch


def mutual_unique(left: DataFrame, right: DataFrame, left_id: str, right_id: str, steps: list[str], generic: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Match each left row to the one right row that shares a key, keys being tried in order; a step counts only with
    exactly one hit, and right rows that two left rows claim are dropped as ambiguous. Steps named in generic ignore
    keys that several left rows hold: such a key names a kind of thing, not one.

    left and right hold an array column of keys for each step. Returns (matches: left_id, right_id, matched_by) and
    counts (outcome, n). Right rows meet a key only in numbers: keys are reduced to (n, only id) first.
    """
    hits = None
    for place, step in enumerate(steps):
        index = right.select(F.explode(F.array_distinct(step)).alias("key"), F.col(right_id).alias("r")).where("key <> ''").groupBy("key").agg(F.min("r").alias("lo"), F.max("r").alias("hi"))
        own = left.select(F.col(left_id).alias("l"), F.explode(F.array_distinct(step)).alias("key"))
        if step in generic:
            own = own.join(own.groupBy("key").agg(F.count("*").alias("holders")).where("holders = 1"), "key", "left_semi")
        found = own.join(index, "key").groupBy("l").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).select("l", F.lit(place).alias("place"), F.lit(step).alias("matched_by"), F.when(F.col("lo") == F.col("hi"), F.col("lo")).alias("r"))
        hits = found if hits is None else hits.unionByName(found)
    best = hits.where("r IS NOT NULL").groupBy("l").agg(F.min_by(F.struct("r", "matched_by"), "place").alias("m")).select("l", "m.*")
    claims = best.groupBy("r").agg(F.count("*").alias("claims"))
    judged = best.join(claims, "r")
    matches = judged.where("claims = 1").select(F.col("l").alias(left_id), F.col("r").alias(right_id), "matched_by")
    outcome = left.select(F.col(left_id).alias("l")).join(judged, "l", "left").select(F.when(F.col("claims") == 1, "matched").when(F.col("claims") > 1, "ambiguous").otherwise("unmatched").alias("outcome"))
    return matches, outcome.groupBy("outcome").agg(F.count("*").alias("n"))


def overlap(a: Column, b: Column, containment: bool = False) -> Column:
    """Shared words over the larger set; with containment, a set inside the other scores 0.75 at least."""
    shared = F.size(F.array_intersect(a, b))
    score = shared / F.greatest(F.size(a), F.size(b), F.lit(1))
    if containment:
        inside = (shared > 0) & ((shared == F.size(a)) | (shared == F.size(b)))
        score = F.when(inside, F.greatest(score, F.lit(0.75))).otherwise(score)
    return score


def _ranked(party: str | Column) -> Column:
    """A party's tokens from rare to frequent. Any order that all sets share is exact; longer words are rarer, and need no count."""
    return F.transform(F.sort_array(F.transform(party, lambda w: F.struct((-F.length(w)).alias("n"), w.alias("w")))), lambda x: x["w"])


def _probes(df: DataFrame, party: str, word: str, threshold: float, containment: bool) -> DataFrame:
    """One row for each token of a party by which it may meet another: word, whether it is in the prefix (word_p) and, for
    containment, whether it is the rarest (word_r); without containment only tokens of the prefix."""
    n = F.size(party)
    prefix = n - F.ceil(F.lit(threshold) * n - 1e-9).cast("int") + 1
    ranked = _ranked(party)
    each = df.select("*", F.posexplode(ranked if containment else F.slice(ranked, 1, prefix)).alias("_i", word))
    return each.select("*", (F.col("_i") < prefix).alias(f"{word}_p"), (F.lit(containment) & (F.col("_i") == 0)).alias(f"{word}_r")).drop("_i")


def fuzzy_two_party(games: DataFrame, events: DataFrame, threshold: float = 0.6, swapped: bool = False, containment: bool = False) -> DataFrame:
    """The best event of each game: both parties' token sets must overlap by the threshold (the smaller score counts).

    games: game, kind, home, away (token arrays). events: event, ord, kind, home, away. Ties go to the lowest ord.
    Nothing is crossed: with tokens in one order, two sets that overlap enough share a token among the first
    n - ceil(t * n) + 1 of each. A candidate shares such a token in both parties, so tokens are met in pairs and a frequent
    one alone brings nothing together. For the containment score a set may also hold the other, whose first token is then
    looked for in all of it; either may hold in either party. Candidates are scored where they meet: events are read once,
    none is written or shuffled while the games' probes are small enough for Spark to send them round.
    """
    games = games.select("game", "kind", F.col("home").alias("gh"), F.col("away").alias("ga"))
    if swapped:
        games = games.unionByName(games.select("game", "kind", F.col("ga").alias("gh"), F.col("gh").alias("ga")))
    # written, so that Spark knows how small they are
    games = scratch(games.withColumn("side", F.monotonically_increasing_id()))
    g = scratch(_probes(_probes(games, "gh", "w", threshold, containment), "ga", "v", threshold, containment).select("side", "kind", *(f"{x}{y}" for x in "wv" for y in ("", "_p", "_r"))))
    known = scratch(g.groupBy("kind", "w").agg(F.max("w_p").alias("any_p"), F.max("w_r").alias("any_r")))
    meet = lambda x: (F.col(f"g_{x}_p") & F.col(f"{x}_p")) | F.col(f"g_{x}_r") | F.col(f"{x}_r")
    # of an event's first party only tokens go on that some game has and may be met by
    e = _probes(events, "home", "w", threshold, containment).join(known, ["kind", "w"]).where((F.col("any_p") & F.col("w_p")) | F.col("any_r") | F.col("w_r")).drop("any_p", "any_r")
    e = _probes(e, "away", "v", threshold, containment)
    marks = [F.col(f"{x}_{y}").alias(f"g_{x}_{y}") for x in "wv" for y in "pr"]
    met = e.join(g.select("side", "kind", "w", "v", *marks), ["kind", "w", "v"]).where(meet("w") & meet("v"))
    both = met.join(games.select("side", "game", "gh", "ga"), "side")
    score = F.least(overlap(F.col("gh"), F.col("home"), containment), overlap(F.col("ga"), F.col("away"), containment))
    scored = both.select("game", "event", "ord", score.alias("score")).where(F.col("score") >= threshold)
    return scored.groupBy("game").agg(F.min_by(F.struct("event", "score"), F.struct((-F.col("score")).alias("s"), "ord")).alias("m")).select("game", "m.event", "m.score")
