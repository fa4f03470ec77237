"""What a step writes and moves must not grow faster than its input; results must stay those of a plain version."""

import random
import time

import pytest
from pyspark.sql import functions as F

from confluo.functions import names
from confluo.operators import match


def _overlap(a, b, containment):
    shared = len(set(a) & set(b))
    score = shared / max(len(a), len(b), 1)
    return max(score, 0.75) if containment and shared and shared in (len(a), len(b)) else score


@pytest.mark.parametrize(("swapped", "containment", "threshold"), [(False, False, 0.6), (True, True, 0.6), (False, True, 0.7), (True, False, 0.5)])
def test_fuzzy_match_writes_no_events(spark, monkeypatch, swapped, containment, threshold):
    """Equal to all pairs, with words that nearly all hold, and no event is written, however many there are."""
    rng = random.Random(5)
    words = ["the", "and", "off"] * 2 + [f"word{i}" for i in range(5)] + ["élan", "été"]
    party = lambda: sorted(set(rng.choices(words, k=rng.randrange(1, 6))))
    games = [(i, rng.choice("ab"), party(), party()) for i in range(40)]
    events = [(i, i // 2, rng.choice("ab"), party(), party()) for i in range(1500)]
    written, keep = [], match.scratch

    def counted(df):
        out = keep(df)
        written.append(out.count())
        return out

    monkeypatch.setattr(match, "scratch", counted)
    g = spark.createDataFrame(games, "game int, kind string, home array<string>, away array<string>")
    e = spark.createDataFrame(events, "event int, ord int, kind string, home array<string>, away array<string>")
    got = {r.game: (r.score, r.event // 2) for r in match.fuzzy_two_party(g, e, threshold, swapped, containment).collect()}
    assert max(written) <= 40 * 2 * 25
    want = {}
    for k, kind, h, a in games:
        best = None
        for event, place, other, x, y in events:
            if other != kind:
                continue
            s = min(_overlap(h, x, containment), _overlap(a, y, containment))
            if swapped:
                s = max(s, min(_overlap(h, y, containment), _overlap(a, x, containment)))
            if s >= threshold and (best is None or (-s, place) < (-best[0], best[1])):
                best = (s, place)
        if best:
            want[k] = best
    assert len(want) > 10
    assert {k: (round(s, 9), p) for k, (s, p) in got.items()} == {k: (round(s, 9), p) for k, (s, p) in want.items()}


def test_script_flag_is_exact_and_cheap_on_latin_text(spark):
    every = spark.range(0x110000).where("id NOT BETWEEN 55296 AND 57343").select("id", F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32").alias("c"))
    plain = F.col("c").rlike("[" + "".join(rf"\p{{Is{x}}}" for x in names.SCRIPTS) + "]")
    assert every.where(names.non_latin("c") != plain).isEmpty()
    assert every.where(names.non_latin("c")).agg(F.min("id")).first()[0] == names.FIRST_OTHER
    text = spark.range(400).select(F.repeat(F.lit("über Straße and señor "), 1000).alias("t")).coalesce(1).cache()
    assert text.count() == 400

    def seconds(c):
        took = []
        for _ in range(3):
            began = time.perf_counter()
            assert text.where(c).isEmpty()
            took.append(time.perf_counter() - began)
        return min(took)

    assert seconds(names.non_latin("t")) < 4 * seconds(F.col("t").rlike(r"[\x{400}-\x{10FFFF}]")) + 0.2


def _distinct_only(spark, tmp_path, monkeypatch, query, times=4):
    """The distinct values that a query takes apart, over parts and over parts repeated with shifted keys."""
    from confluo.functions import names as n
    from confluo.plans import registry

    seen, keep = [], n.scratch

    def counted(df):
        out = keep(df)
        seen.append(out.count())
        return out

    monkeypatch.setattr(n, "scratch", counted)
    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    top = part.agg(F.max("p_partkey")).first()[0] + 1
    for i, k in enumerate((1, times)):
        d = f"{tmp_path}/{i}"
        # a multiple of what the queries divide keys by
        part.crossJoin(spark.range(k).withColumnRenamed("id", "_i")).select((F.col("p_partkey") + F.col("_i") * (top + -top % 660)).cast("long").alias("p_partkey"), *part.columns[1:]).write.parquet(f"{d}/part.parquet")
        registry.QUERIES[query](spark, d).write.format("noop").mode("overwrite").save()
    return seen


@pytest.mark.parametrize("query", ["variant_fold", "conditional_id", "consolidate", "resolve_cascade"])
def test_names_are_taken_apart_once_each(spark, tmp_path, monkeypatch, query):
    import confluo.catalogue  # noqa: F401  registers the queries

    seen = _distinct_only(spark, tmp_path, monkeypatch, query)
    assert seen and seen[: len(seen) // 2] == seen[len(seen) // 2 :]
