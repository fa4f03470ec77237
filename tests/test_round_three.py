"""Line-up order, slug forms, guide lines, event caches, first aliases, tables with keys that repeat."""

import json

from pyspark.sql import functions as F

from confluo.functions import names
from confluo.operators import golden, lookup, order
from confluo.sources import feeds


def test_lineup_puts_live_leagues_last_and_unknown_starts_after_known(spark):
    rows = [("b1", "Straße", ["news"], None, None, None, None, None, None), ("b2", "strasse 2", [], None, None, None, None, None, None), ("b0", None, None, None, None, None, None, None, None)]
    rows += [(f"l{i}", f"N{i}", ["nfl"], lg, sub, "g", start, hint, o) for i, (lg, sub, start, hint, o) in enumerate([("soccer", 0, "2024-01-01", None, 1), ("nfl", 1, None, None, 1), ("nfl", 1, "2024-01-02", None, 9), ("nfl", None, "", "h", 2), ("golf", 0, "2020", None, 0), ("nfl", 1, None, "9pm", 5)])]
    df = spark.createDataFrame(rows, "entity_id string, name string, categories array<string>, live_league string, live_suborder int, league_group string, event_start string, event_hint string, live_order int")
    got = [r.entity_id for r in order.lineup(df, ["nfl", "nba", "soccer"]).orderBy("number").collect()]
    assert got == ["b0", "b1", "b2", "l3", "l2", "l5", "l1", "l0", "l4"]


def test_slug_forms(spark):
    df = spark.createDataFrame([("A&E + HD (720p)",), ("--",), (None,)], "a string")
    got = [tuple(r) for r in df.select(names.plain_slug("a", names.JOINED), names.plain_slug("a", names.SPELLED), names.plain_slug("a")).collect()]
    assert got == [("aande-hd-720p", "a-and-e-plus-hd-720p", "a-e-hd-720p"), ("", "", ""), ("", "", "")]


def test_guide_lines(spark):
    lines = ["1. Too early", "📺 TV Guide (USA) (12 channels)", "1. One", "2.Two", "3. ### Local  News ###", " 4.  Three (2 channels) ", "5 Not numbered", "(1 channels)", "6. Four", "Not a section (3 channels) x"]
    df = spark.createDataFrame([("f", i, x) for i, x in enumerate(lines)], "file string, pos int, line string")
    assert [(r.section, r.subsection, r.name) for r in feeds.parse_guide(df).orderBy("pos").collect()] == [("TV Guide (USA)", "", "One"), ("TV Guide (USA)", "", "Two"), ("TV Guide (USA)", "local news", "Three (2 channels)"), ("", "", "Four")]


def test_event_cache_keeps_one_day(spark):
    days = {"2024-01-01|Soccer": [{"dateEvent": "2024-01-01T00", "strTime": "18:30:00+00:00", "n": 1}, {"dateEvent": "2024-01-02", "n": 2}, {}], "2024-01-02|a|Golf": [{"dateEvent": " 2024-01-01 ", "strTime": None, "n": "x"}], "k": None, "q": 5}
    df = spark.createDataFrame([(1, json.dumps({"days": days})), (2, "{"), (3, None), (4, "[]")], "id int, text string")
    got = feeds.on_day(feeds.day_cache(df, "text", ["id"]), "2024-01-01", "dateEvent", "strTime", {"n": ("n", "int")})
    assert sorted((r.id, r.kind, r.n, str(r.start)) for r in got.collect()) == [(1, "Golf", None, "2024-01-01 00:00:00"), (1, "Soccer", 1, "2024-01-01 18:30:00")]


def test_first_aliases_of_an_entity_with_a_million(spark):
    n = 1_000_000
    cols = ["'e' AS entity_id", "cast(id % 1000 AS int) AS trust", "concat('n', id) AS name", "'p' AS plain", "concat('k', id div 2) AS key", "concat('u', id) AS url", "1 AS height", "false AS not_24_7", "'' AS country", "'c' AS category", "'s' AS source", "'r' AS ref"]
    many = spark.range(n).selectExpr(*cols).repartition(8)
    none = spark.range(2).selectExpr("'f' AS entity_id", *cols[1:4], "'' AS key", *cols[5:])
    r = {x.entity_id: x for x in golden.golden_record(many.unionByName(none)).collect()}
    want = sorted((i % 1000, f"n{i}", f"u{i}", f"k{i // 2}") for i in range(n))
    seen, first = set(), []
    for _, name, _, key in want:
        if key not in seen:
            seen.add(key)
            first.append(name)
            if len(first) == 40:
                break
    assert r["e"].aliases == first and r["f"].aliases == []
    plan = golden.golden_record(many.unionByName(none))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_tables_whose_keys_repeat_multiply_nothing(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, k string")
    twice = spark.createDataFrame([("a", "x"), ("a", "w"), (None, "q")], "key string, value string")
    assert sorted((r.id, r.out) for r in lookup.override(df, "k", twice, twice.where("key IS NULL"), "out").collect()) == [(1, "w"), (2, None), (3, None)]
    al = lookup.alias_join(df, F.col("k"), F.col("k"), twice.toDF("alias", "slug"), "general", "out")
    assert sorted((r.id, r.out) for r in al.collect()) == [(1, "w"), (2, "general"), (3, "general")]
