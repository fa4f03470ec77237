"""Stored indexes move no index rows; pattern tables equal a chain of conditions."""

import random
import re

import pytest
from pyspark.sql import functions as F

from confluo.operators import lookup, patterns, stored


def exchanges(df):
    """Lines of the plan below each exchange."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan, [x for x in plan.split("\n") if re.search(r"\bExchange\b", x)]


def test_lookups_move_only_what_asks(spark):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        n = 16
        asks = spark.range(500).select(F.col("id").alias("row"), F.array((F.col("id") % 90).cast("string"), (F.col("id") % 70).cast("string")).alias("keys"), (F.col("id") % 90).cast("string").alias("key"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("c"), (F.col("id") % 3).cast("string"))).alias("place"))
        idx = spark.range(60).select(F.col("id").cast("string").alias("key"), F.concat(F.lit("v"), F.col("id").cast("string")).alias("value"))
        assets = spark.range(300).select((F.col("id") % 80).cast("string").alias("key"), F.when(F.col("id") % 4 > 0, F.concat(F.lit("C"), (F.col("id") % 3).cast("string"))).otherwise("").alias("country"), F.concat(F.lit("a"), F.col("id").cast("string")).alias("value"))
        langs = idx.select("key", F.array("value").alias("languages"), (F.col("key") % 2 == 0).alias("english"))
        entries = asks.select("key", F.col("row").alias("source"), F.col("row").alias("ref"))
        own, anywhere = lookup.asset_index(assets, [F.length("value"), F.col("value")], "value")
        kept = lambda df, *k: stored.keep(df, list(k), n)
        cases = [
            (lookup.ranked_lookup(asks, assets, "key", "place", [F.length("value"), F.col("value")], "value", "out"), lookup.from_index(asks, (kept(own, "_k1", "_c1"), kept(anywhere, "_k2")), "key", "place", "out")),
            (lookup.ordered_fallback(asks, "row", "keys", idx, "out"), lookup.ordered_fallback(asks, "row", "keys", kept(idx, "key"), "out")),
            (lookup.multi_key_union(asks, "row", "keys", langs), lookup.multi_key_union(asks, "row", "keys", kept(langs, "key"))),
            (lookup.allow_list(idx, entries, "key", "source", "ref"), lookup.with_sources(idx, kept(lookup.sources_index(entries, "key", "source", "ref"), "key"), "key")),
        ]
        for plain, fast in cases:
            assert sorted(map(str, plain.collect())) == sorted(map(str, fast.collect()))
            plan = fast._jdf.queryExecution().executedPlan().toString()
            # from each scan of a stored table up to its join stands no exchange
            lines = plan.split("\n")
            scans = [i for i, x in enumerate(lines) if "FileScan" in x and "Bucketed: true" in x]
            assert scans
            for i in scans:
                depth = len(re.match(r"[\s:|+-]*", lines[i])[0])
                for x in reversed(lines[:i]):
                    d = len(re.match(r"[\s:|+-]*", x)[0])
                    if d < depth:
                        depth = d
                        assert "Exchange" not in x, plan
                        if "Join" in x:
                            break
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_required_words(spark):
    cases = {
        r"\bradio\b": ["radio"], r"radio": [], r"^fox\b": ["fox"], r"\bfox$": ["fox"], r"\bfox\s+news\b": ["fox", "news"], r"\bnews?\b": [], r"\b(?:a|b)\s+live\b": ["live"], r"\bx\b|\by\b": [], r"\b(x|y) tv\b": ["tv"],
        r"\bHD\b": ["hd"], r"\bfoo\d\b": [], r"\bfoo\.bar\b": [], r"\bfoo[0-9] bar\b": ["bar"], r"\bab+\b": [], r"\bab{0,2}c\b": [], r"\b(a(b|c)) d\b": ["d"], r"((((((x))))))\bq\b": [], r"\bé\b \btv\b": ["tv"], "": [], r"\ba{2}\b": [], r"\bq .* z\b": ["q", "z"],
    }
    df = spark.createDataFrame([(k,) for k in cases], "p string").select("p", patterns.required_words(F.col("p")).alias("w"))
    assert {r.p: r.w for r in df.collect()} == cases


def test_pattern_table_equals_a_chain(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(60)] + ["live", "HD", "news"]
    forms = [lambda: rf"\b{rng.choice(words)}\s+{rng.choice(words)}\b", lambda: rf"^{rng.choice(words)}\b", lambda: rf"\b{rng.choice(words)}\b.*\b{rng.choice(words)}$", lambda: rf"\b(?:{rng.choice(words)}|{rng.choice(words)}) {rng.choice(words)}\b"]
    rules = [(i, forms[i % 4](), f"r{i}") for i in range(2000)] + [(100, r"w1.w2x?|^$", "loose"), (5000, r"[0-9]{2} ", "any")]
    names = [(i, None if i == 7 else " ".join(rng.choice([w, w.upper(), w + "-x", w, "é"]) for w in rng.choices(words, k=rng.randrange(6))), "clash") for i in range(400)]
    df = spark.createDataFrame(names, "id int, name string, label string").drop("label")
    got = {r.id: r.label for r in patterns.first_match(df, "id", "name", spark.createDataFrame(rules, "place int, pattern string, label string")).collect()}
    compiled = [(p, l, re.compile(x, re.I | re.A)) for p, x, l in rules]
    for i, name, _ in names:
        hits = sorted((p, l) for p, l, x in compiled if x.search(name or ""))
        assert got[i] == (hits[0][1] if hits else None), (i, name)
    many = spark.range(300).select(F.col("id").alias("place"), F.lit("x").alias("pattern"), F.lit("l").alias("label"))
    with pytest.raises(ValueError):
        patterns.first_match(df, "id", "name", many)
    assert patterns.first_match(df, "id", "name", many.limit(0)).where("label IS NOT NULL").isEmpty()


def test_copies_of_patterns_and_names_are_not_met_anew(spark):
    """The rows that meet patterns don't grow when names and patterns are repeated, and all a pattern's rare words are asked for."""
    from confluo.scratch import scratch

    def run(times):
        words = [f"w{i}" for i in range(40)]
        texts = [(rf"\bcommon {a} {b}\b", f"the common {a} {b} x") for a in words for b in words[:10]]
        rules = spark.createDataFrame([(len(texts) * t + i, p, f"{t}") for t in range(times) for i, (p, _) in enumerate(texts)], "place int, pattern string, label string")
        df = spark.createDataFrame([(len(texts) * t + i, n) for t in range(times) for i, (_, n) in enumerate(texts)], "id int, name string")
        tried = []
        met, patterns._met = patterns._met, lambda names, known: tried.append((names.count(), known.count(), scratch(met(names, known)).count())) or met(names, known)
        try:
            got = patterns.first_match(df, "id", "name", rules).collect()
        finally:
            patterns._met = met
        assert len(got) == len(texts) * times and {r.label for r in got} == {"0"}
        return tried[0]

    assert run(1) == run(3) == (400, 400, 400)
