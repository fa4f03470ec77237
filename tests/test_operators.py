"""Operators on small hand-made tables."""

import pytest
from pyspark.sql import functions as F

from confluo.functions import names
from confluo.operators import checks, health, lookup, match, order, resolve, rules, survive
from confluo.scratch import folder
from confluo.sources import feeds, playlists


def test_resolution_never_merges_ambiguous_names(spark):
    ents = spark.createDataFrame([("abc-au", ["abc"], ["AU"]), ("abc-us", ["abc"], ["US"]), ("bbc", ["bbc"], []), ("cnn", ["cnn"], ["US"])], "entity_id string, keys array<string>, countries array<string>")
    entries = spark.createDataFrame(
        [(1, "s", ["abc"], "US", "abc"), (2, "s", ["abc"], "", "abc"), (3, "s", ["x", "bbc"], "FR", "x"), (4, "s", ["nope"], "", "nope"), (5, "t", ["weird"], "", "weird"), (6, "s", ["cnn"], "", "cnn"), (7, "s", ["abc"], "FR", "abc")],
        "entry_key int, source string, keys array<string>, country string, slug string",
    )
    aliases = spark.createDataFrame([("t", "weird", "bbc"), ("t", "abc", "gone")], "source string, alias_key string, entity_id string")
    got = {r.entry_key: (r.entity_id, r.matched_by) for r in resolve.resolve(entries, ents, aliases).collect()}
    assert got == {
        1: ("abc-us", "canonical-name"), 2: ("unmapped-abc", "ambiguous-fallback"), 3: ("bbc", "canonical-name"), 4: ("nope", "fallback"),
        5: ("bbc", "source-alias"), 6: ("cnn", "canonical-name"), 7: ("unmapped-abc", "ambiguous-fallback"),
    }


def test_trust_beats_latency_and_health_beats_trust(spark):
    rows = [("e", "a", "online", 2, 0, 100), ("e", "b", "online", 1, 0, 900), ("e", "c", "offline", 0, 9, 1), ("f", "d", None, 3, None, None), ("f", "g", "degraded", 1, 1, 5)]
    df = spark.createDataFrame(rows, "entity string, id string, status string, trust int, failures int, ms int")
    rank = survive.candidate_rank(F.col("status"), F.col("trust"), F.col("failures"), F.col("ms"), F.lit(0), [F.col("id")])
    got = {r.entity: r.id for r in survive.survivors(df, ["entity"], rank, ["id"]).collect()}
    assert got == {"e": "b", "f": "d"}


def test_first_wins_is_stable_under_repartitioning(spark):
    df = spark.range(200).select((F.col("id") % 7).alias("k"), F.col("id").alias("ord"))
    want = sorted(survive.first_wins(df, ["k"], ["ord"]).collect())
    assert want == sorted(survive.first_wins(df.repartition(13), ["k"], ["ord"]).collect())


def test_health_needs_six_failures_to_disable_and_one_success_to_recover(spark):
    rows = [("five", i, False) for i in range(5)] + [("six", i, False) for i in range(6)] + [("back", i, i == 6) for i in range(7)]
    got = {r.id: (r.failures, r.status, r.enabled) for r in health.fold(spark.createDataFrame(rows, "id string, t int, ok boolean"), "id", ["t"], "ok").collect()}
    assert got == {"five": (5, "unstable", True), "six": (6, "offline", False), "back": (0, "online", True)}


def test_health_goes_on_from_state(spark):
    state = spark.createDataFrame([("a", 4, 1)], "id string, failures int, last_success int")
    got = health.fold(spark.createDataFrame([("a", 9, False), ("a", 10, False)], "id string, t int, ok boolean"), "id", ["t"], "ok", state).first()
    assert (got.failures, got.status, got.last_success) == (6, "offline", 1)


def test_stream_equals_batch(spark):
    from confluo.plans.health import health_fold, health_fold_stream

    d = "/root/testdata/sf0.001"
    key = lambda r: (r.user_id, r.failures, r.status, r.enabled)
    assert sorted(map(key, health_fold(spark, d).collect())) == sorted(map(key, health_fold_stream(spark, d).collect()))


def test_cascade_takes_the_first_reason(spark):
    df = spark.createDataFrame([(1, "x", False), (2, "radio one", False), (3, "radio one", True)], "id int, name string, manual boolean").withColumn("cats", F.array(F.lit("music")))
    r = [rules.name_patterns("name", "cats", within=["music"], any_case=[r"\bRADIO\b"]), rules.exclude("name", "name", "cats", drop_categories=["music"])]
    assert [x.excluded_by for x in rules.cascade(df, r, F.col("manual")).orderBy("id").collect()] == ["category", "radio", ""]


def test_unknown_language_stays_and_unknown_country_goes(spark):
    df = spark.range(1).select(F.array(F.lit("a")).alias("cats"), F.array().cast("array<string>").alias("none"), F.lit(None).cast("boolean").alias("en"))
    got = df.select(rules.language(F.lit("e"), "cats", "none", "en", within=["a"]).alias("l"), rules.allow_list(F.lit("x"), "cats", "none", allow=["US"]).alias("c")).first()
    assert (got.l, got.c) == ("", "country:unknown")


def test_playlist_round_trip(spark):
    text = '#EXTM3U url="x"\n#EXTINF:-1 tvg-id="a" tvg-name="A, \\"q\\"" tvg-id="b",Title, two\n#EXTVLCOPT:x=1\nhttp://h/1\n#late\nhttp://orphan\n#EXTINF:5,no url\n#EXTINF:-1 broken="1,2\nhttp://h/3\n'
    e, h, r = playlists.scan(spark.createDataFrame([("f", text)], "file string, value string"))
    got = [(x.duration, [tuple(a) for a in x.attrs], x.title, x.url, x.directives) for x in e.orderBy("line_no").collect()]
    assert got == [("-1", [("tvg-id", "b"), ("tvg-name", 'A, "q"')], "Title, two", "http://h/1", ["#EXTVLCOPT:x=1"]), ("5", [], "no url", "", [])]
    assert h.first().header == '#EXTM3U url="x"\n#late' and r.first().line == '#EXTINF:-1 broken="1,2'
    assert e.where("title = 'Title, two'").select(playlists.render(F.col("attrs"), F.col("title"), F.col("url"), directives=F.col("directives"))).first()[0] == '#EXTINF:-1 tvg-id="b" tvg-name="A, \\"q\\"",Title, two\n#EXTVLCOPT:x=1\nhttp://h/1'


def test_guide_sections(spark):
    lines = ["Sports (3 channels)", "1. # Soccer #", "2. One", "3. Two", "News (1 channels)", "1. Three"]
    df = spark.createDataFrame([("f", i, x) for i, x in enumerate(lines)], "file string, pos int, line string")
    assert [(r.section, r.subsection, r.name) for r in feeds.parse_guide(df).orderBy("pos").collect()] == [("Sports", "soccer", "One"), ("Sports", "soccer", "Two"), ("News", "", "Three")]


def test_country_asset_wins_and_none_is_borrowed(spark):
    a = spark.createDataFrame([("k", "US", "us"), ("k", "", "any"), ("k", "DE", "de")], "key string, country string, value string")
    df = spark.createDataFrame([(1, "k", "us"), (2, "k", "FR"), (3, "k", "")], "id int, key string, place string")
    got = [r.asset for r in lookup.ranked_lookup(df, a, "key", "place", [F.col("country") != "", F.col("value")], "value", "asset").orderBy("id").collect()]
    assert got == ["us", "", "any"]


def test_nicknames_and_swapped_sides_match(spark):
    t = lambda c: names.token_set(F.col(c))
    games = spark.createDataFrame([(1, "nfl", "Bengals", "Baltimore Ravens"), (2, "nfl", "Nobody Here", "Ravens")], "game int, kind string, h string, a string").select("game", "kind", t("h").alias("home"), t("a").alias("away"))
    events = spark.createDataFrame([(7, 1, "nfl", "Baltimore Ravens", "Cincinnati Bengals"), (8, 2, "nfl", "Dallas Cowboys", "New York Giants")], "event int, ord int, kind string, h string, a string").select("event", "ord", "kind", t("h").alias("home"), t("a").alias("away"))
    assert [(r.game, r.event) for r in match.fuzzy_two_party(games, events, 0.6, swapped=True, containment=True).collect()] == [(1, 7)]
    assert match.fuzzy_two_party(games, events, 0.6).isEmpty()


def test_interleave_loses_nothing(spark):
    df = spark.createDataFrame([(i, "a" if i < 6 else "b") for i in range(9)], "pos int, host string")
    got = order.interleave(df, F.col("host"), "pos").orderBy("turn", "first").collect()
    assert sorted(r.pos for r in got) == list(range(9)) and [r.host for r in got][:4] == ["a", "b", "a", "b"]


def test_numbers_are_dense(spark):
    df = spark.range(1000).select(F.xxhash64("id").alias("x"))
    got = order.number(df, [F.col("x")], partitions=7).orderBy("number").collect()
    assert [r.number for r in got] == list(range(1, 1001)) and [r.x for r in got] == sorted(r.x for r in got)


def test_strict_mode_raises(spark):
    import pytest

    with pytest.raises(Exception, match="unresolved"):
        checks.demand(spark.range(3), F.col("id") == 2, "unresolved").collect()


def test_entry_and_names_agree():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_no_row_is_lost_when_numbers_come_from_many_sampled_ranges(spark, adaptive):
    """A million rows over 200 ranges, where the bounds come from a sample; all columns are written."""
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        df = spark.range(1_000_000).select(F.xxhash64("id").alias("k"), (F.col("id") % 3).alias("third"), F.col("id").cast("string").alias("other"))
        path = folder(spark)
        order.number(df, [F.col("third"), F.col("k")], partitions=200).write.parquet(path)
        got = spark.read.parquet(path)
        first = got.agg(F.count("*").alias("n"), F.countDistinct("number").alias("d"), F.min("number").alias("lo"), F.max("number").alias("hi"), F.countDistinct("other").alias("o")).first()
        assert tuple(first) == (1_000_000, 1_000_000, 1, 1_000_000, 1_000_000)
        before = got.select("number", F.struct("third", "k").alias("x")).join(got.select((F.col("number") + 1).alias("number"), F.struct("third", "k").alias("y")), "number")
        assert before.where("x <= y").isEmpty()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)
    assert order.number(df.limit(0), [F.col("k")]).count() == 0


def test_groups_are_interleaved_and_sampled(spark):
    df = spark.createDataFrame([("a", i) for i in range(50)] + [("b", i) for i in range(100, 103)] + [(None, 7)], "g string, i int")
    got = {(r.g, r.i): (r.turn, r.first) for r in order.interleave(df, F.col("g"), "i").collect()}
    assert got == {("a", i): (i + 1, 0) for i in range(50)} | {("b", 100 + i): (i + 1, 100) for i in range(3)} | {(None, 7): (1, 7)}
    assert sorted((r.g or "", r.i) for r in order.systematic_sample(df, "g", "i", 4).collect()) == [("", 7), ("a", 0), ("a", 12), ("a", 24), ("a", 36), ("b", 100), ("b", 101), ("b", 102)]


def test_events_last_parts_of_hours(spark):
    df = spark.sql("SELECT timestamp_ntz '2026-01-01 10:00:00' AS start, 'any' AS kind")
    late = lambda at, hours: df.select(rules.event_expiry("start", "kind", as_of=F.lit(at).cast("timestamp_ntz"), hours={}, default_hours=hours)).first()[0]
    assert late("2026-01-01 12:15:00", 2.5) == "" and late("2026-01-01 12:31:00", 2.5) == "event-ended:2026-01-01 10:00:00"
    assert late("2026-01-01 10:00:31", 0.01) == "" and late("2026-01-01 10:00:37", 0.01) != ""


def test_addresses_in_pages(spark):
    import base64

    chunk = lambda x: base64.b64encode(x.encode()).decode().rstrip("=")
    page = lambda channel, *parts: channel + " ".join(f"var v{i}='{chunk(p)}' ;" for i, p in enumerate(parts))
    ch = 'var _CH = "0af9";'
    rows = [
        (page(ch, "https://a/b", "/playlist.m3u8?token=x1"), "https://a/b/playlist.m3u8?token=x1"), (page(ch, "zz ?to", "ken=abc="), "https://base/0af9/playlist.m3u8?token=abc="),
        (page("", "?token=a"), None), (page(ch, "nothing"), None), (ch, None), ("", None), (None, None),
    ]
    df = spark.createDataFrame([(i, h) for i, (h, _) in enumerate(rows)], "i int, h string")
    assert [r.a for r in df.select("i", feeds.stream_address(F.col("h"), "https://base/").alias("a")).orderBy("i").collect()] == [w for _, w in rows]


def test_playlists_survive_a_folder(spark):
    df = spark.range(300).select(F.col("id"), F.array(F.struct(F.lit("tvg-id").alias("k"), F.col("id").cast("string").alias("v"))).alias("attrs"))
    for one in (True, False):
        path = folder(spark)
        playlists.write(df, path, [F.col("id")], playlists.render(F.col("attrs"), F.lit("t, x"), F.concat(F.lit("http://h/"), F.col("id").cast("string"))), one_file=one, header="#EXTM3U a\n# note")
        entries, headers, rejects = playlists.scan(playlists.read(spark, path))
        assert sorted(int(r.url[9:]) for r in entries.collect()) == list(range(300)) and rejects.isEmpty()
        assert [r.header for r in headers.collect()] == ["#EXTM3U a\n# note"]


def test_generic_ids_match_nothing(spark):
    left = spark.createDataFrame([(1, ["k"], []), (2, ["k"], []), (3, ["own"], ["n"]), (4, [], ["m"])], "l int, ref array<string>, name array<string>")
    right = spark.createDataFrame([("a", ["k"], []), ("b", ["own"], ["m"]), ("c", [], ["n"])], "r string, ref array<string>, name array<string>")
    got = match.mutual_unique(left, right, "l", "r", ["ref", "name"], generic=("ref",))[0]
    assert got.isEmpty()  # 3 and 4 both claim b
    got = match.mutual_unique(left.where("l <> 4"), right, "l", "r", ["ref", "name"], generic=("ref",))[0]
    assert [tuple(r) for r in got.collect()] == [(3, "b", "ref")]


def test_records_and_failed_rows(spark):
    from confluo.operators import report

    df = spark.createDataFrame([("a-b2", "x"), ("A", " "), (None, None), ("a--b", "y")], "id string, name string")
    got = sorted((r.check, r.key or "") for r in checks.records(df, "id", "name").collect())
    assert got == [("bad-id", ""), ("bad-id", "A"), ("bad-id", "a--b"), ("blank-name", ""), ("blank-name", "A")]
    rows = spark.createDataFrame([("s", 1, True), ("s", 2, False), ("live", 3, False), (None, 4, None)], "cat string, i int, ok boolean")
    assert sorted(r.i for r in report.failed_rows(rows, "cat", F.col("ok"), ["i"], "live").collect()) == [2, 4]


def test_country_spellings(spark):
    from confluo.functions import geo

    names_ = ["Channel (Türkiye)", "X (CHILE)", "Y (Viet-Nam)", "Z (Atlantis)", "no brackets", None, "Q (México) (Côte d'Ivoire)"]
    got = spark.createDataFrame([(n,) for n in names_], "n string").select(F.coalesce(geo.country_from_name("n"), F.lit("")).alias("c"))
    assert [r.c for r in got.collect()] == ["TR", "CL", "VN", "", "", "", ""]
