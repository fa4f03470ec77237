"""Many name patterns as a table: names meet only patterns whose required word they hold, and the first in order wins.

A chain of conditions tries every pattern on every name. Here each pattern is known by words that any name it matches
must hold: of its literal words that stand between word boundaries, outside groups and alternatives, those that fewest
names hold, three at most. Distinct names are joined with distinct patterns by these words, so a name is tried only on
patterns it may match, and copies of a name or a pattern cost nothing more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from confluo.scratch import scratch

#: Patterns without such a word that may be tried on all names.
MOST_LOOSE = 200
#: Words that a pattern is known by, at most: the rarest.
KNOWN_BY = 3
_GAP, _SPREAD = "\x01", 8


def required_words(pattern: Column) -> Column:
    """Words [a-z0-9]+ that a name must hold, as runs between other characters, for the pattern to match; may be empty.

    What isn't understood counts as a gap beside which no word is whole: groups, classes, escapes but \\b and \\s, and
    characters that may be left out. A pattern with alternatives outside groups has no required word.
    """
    text = F.regexp_replace(pattern, r"\\[^bs]|\[(?:\\.|[^\]\\])*\]", _GAP)
    for _ in range(4):  # groups within groups, the innermost first
        text = F.regexp_replace(text, r"\([^()]*\)", _GAP)
    text = F.regexp_replace(text, r"(?:\\[bs]|.)(?:[?*]|\{0?,\d*\})[?+]?", _GAP)
    text = F.regexp_replace(text, r"(.)(?:\+|\{\d+(?:,\d*)?\})[?+]?", f"$1{_GAP}")
    text = F.regexp_replace(F.regexp_replace(text, rf"\\s{_GAP}?", " "), r"\\b", "\x02")
    found = F.regexp_extract_all(F.lower(text), F.lit("(?:^\\^|[\x02 ])([a-z0-9]+)(?=[\x02 ]|\\$$)"), F.lit(1))
    return F.when(F.contains(text, F.lit("|")) | text.rlike(r"[()]"), F.array().cast("array<string>")).otherwise(F.array_distinct(found))


def words_of(name: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(F.coalesce(name, F.lit(""))), "[^a-z0-9]+"), lambda w: w != ""))


def _met(names: DataFrame, known: DataFrame) -> DataFrame:
    """(_name, pattern, best) of names that hold the words a pattern is known by.

    Words are met one after the other, and only names that hold the first words of some pattern go on to the next.
    """
    found, held = None, names
    for depth in range(1, KNOWN_BY + 1):
        path = [f"w{i}" for i in range(depth)]
        each = held.select("_name", "_words", *path[:-1], F.explode("_words").alias(path[-1]))
        here = known.where(F.size("by") >= depth).select(*(F.col("by")[i].alias(w) for i, w in enumerate(path)), F.size("by").alias("_n"), "pattern", "best")
        ends = each.select("_name", *path).join(here.where(F.col("_n") == depth), path).where(F.expr("_name rlike concat('(?i)', pattern)")).select("_name", "best")
        found = ends if found is None else found.unionByName(ends)
        if depth < KNOWN_BY:
            held = each.join(here.where(F.col("_n") > depth).select(*path).distinct(), path, "left_semi")
    return found


def first_match(df: DataFrame, row: str, name: str, patterns: DataFrame, out: str = "label", most_loose: int = MOST_LOOSE) -> DataFrame:
    """df with out: the label of the first pattern that its name matches, by place, without regard to case; null if none does.

    row: a column of df that tells its rows apart; rows of one name are spread by it. patterns: place, pattern, label. Only
    ASCII letters and digits make words, on both sides. Equal patterns count once, by the first of them, and equal names are
    tried once. Patterns without a required word are tried on every name, which is an error beyond most_loose of them.
    """
    p = patterns.where("pattern IS NOT NULL").groupBy("pattern").agg(F.min(F.struct("place", "label")).alias("best"), F.count("*").alias("times"))
    p = scratch(p.withColumn("required", required_words(F.col("pattern"))))
    loose = p.where(F.size("required") == 0).orderBy("best.place").limit(most_loose + 1).collect()
    if sum(r.times for r in loose) > most_loose:
        raise ValueError(f"more than {most_loose} patterns have no word that they require")
    names = scratch(df.where(F.col(name).isNotNull()).select(F.col(name).alias("_name")).distinct().withColumn("_words", words_of(F.col("_name"))))
    asked = p.select("pattern", "best", F.size("required").alias("_n"), F.explode("required").alias("word"))
    freq = scratch(names.select(F.explode("_words").alias("word")).join(asked.select("word").distinct(), "word", "left_semi").groupBy("word").agg(F.count("*").alias("n")))
    # the rarest words; a pattern with a word that no name holds matches nothing
    words = F.transform(F.slice(F.array_sort(F.collect_list(F.struct("n", "word"))), 1, KNOWN_BY), lambda x: x["word"])
    known = scratch(asked.join(freq, "word").groupBy("pattern", "best", "_n").agg(words.alias("by"), F.count("*").alias("_of")).where("_of = _n").select("pattern", "best", "by"))
    best = _met(names, known).groupBy("_name").agg(F.min("best").alias("_met"))
    best = best.select(F.col("_name"), "_met", F.explode(F.sequence(F.lit(0), F.lit(_SPREAD - 1))).alias("_at"))
    kind = best.schema["_met"].dataType.simpleString()
    always = F.lit(None).cast(kind)
    for r in reversed(loose):
        always = F.when(F.coalesce(F.col(name), F.lit("")).rlike(f"(?i){r.pattern}"), F.struct(F.lit(r.best.place).alias("place"), F.lit(r.best.label).alias("label")).cast(kind)).otherwise(always)
    spread = F.pmod(F.xxhash64(row), F.lit(_SPREAD)).cast("int")
    j = df.withColumn("_own", spread).join(best, (F.col(name) == F.col("_name")) & (F.col("_own") == F.col("_at")), "left").withColumn("_always", always)
    first = F.least(F.col("_met"), F.col("_always"))
    return j.select(*df.columns, first["label"].alias(out))
