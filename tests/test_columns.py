"""Derived columns on example values."""

import pytest
from pyspark.sql import functions as F

from confluo.functions import geo, names


def values(spark, inputs, make):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(make(F.col("x"))).collect()]


@pytest.mark.parametrize(
    "make,cases",
    [
        (names.strip_quality, {"Trace Urban HD (1080p)": "Trace Urban", "9Gem (720p) [Geo-blocked]": "9Gem [Geo-blocked]", "1HD Music Television": "1HD Music Television", "HD": "HD", "A  B": "A B"}),
        (names.quality_height, {"Channel (1080p)": 1080, "Channel HD": 720, "Channel FHD": 1080, "Channel": None, "A (480i) (720p)": 720}),
        (names.not_24_7, {"X [Not 24/7]": True, "X": False}),
        (geo.country_ref, {"OrbitTVParanormal.de.ES": "DE", "ParanormalState.us.UK": "US", "DodomaTV.tz": "TZ", "WPIX-DT.us_locals1": "US", "DodomaTV": "", "1001Noites.br.SD": "BR"}),
        (geo.country_from_name, {"Arte (France)": "FR", "Arte": "", "Arte (France) x": ""}),
        (lambda c: geo.region_base(c, ["Arabia"]), {"Orbit TV Paranormal (Germany) ES": "Orbit TV Paranormal", "48 Hours CA": "48 Hours", "A&E TV": "A&E TV", "Angel TV Arabia": "Angel TV", "Are You The One? DK": "Are You The One?"}),
        (lambda c: names.event_start(F.lit("2026-07-16"), c).cast("string"), {"00:15:00": "2026-07-16 00:15:00", "16:00": "2026-07-16 16:00:00", "": "2026-07-16 00:00:00", "18:30+00:00": "2026-07-16 18:30:00"}),
        (lambda c: names.parse_kickoff(c)["start"], {"x start:2026-07-16 18:30:00": "2026-07-16T18:30:00+00:00", "Jul 16": None}),
        (lambda c: names.parse_kickoff(c)["hint"], {"Game Jul 6 live": "07-06", "Game": None}),
        (lambda c: F.array_join(names.token_set(c), " "), {"FC Real Madrid": "madrid real", "Club Atletico": "atletico club", "a b": ""}),
        (names.clean_display, {"Bein [4K] (Backup) HD": "Bein", "One  Two 720p": "One Two"}),
        (names.ext_country, {"Chan.uk2": "GB", "Chan.us_locals1": "US", "Chan": ""}),
        (names.quality_rank, {"X (uhd)": 2160, "X (HD)": 720, "X": 0}),
        (names.unwrap_proxy, {"https://p.example/?url=https%3A%2F%2Fa.example%2Fx": "https://a.example/x", "https://a.example/y": "https://a.example/y"}),
    ],
)
def test_examples(spark, make, cases):
    assert values(spark, list(cases), make) == list(cases.values())


def test_parse_event(spark):
    e = values(spark, ["[Liga MX] América vs Monterrey | TUDN", "[NBA] A x B (X1)", "plain"], names.parse_event)
    assert (e[0].sport, e[0].home, e[0].away) == ("Soccer", "América", "Monterrey")
    assert (e[1].sport, e[1].home, e[1].away) == ("Basketball", "A", "B")
    assert e[2] is None


def test_ascii_keys(spark):
    df = spark.createDataFrame([("Café & Thé HD",), ("plain",), (None,), ("日本",)], "n string")
    got = {r.n: (r.k, r.s) for r in names.with_ascii(df, "n", "a").select("n", names.name_key("a").alias("k"), names.slug("a").alias("s")).collect()}
    assert got == {"Café & Thé HD": ("cafe and the", "cafe-and-the"), "plain": ("plain", "plain"), None: ("", "unknown-channel"), "日本": ("", "unknown-channel")}


def test_countries_prefer_explicit_then_reference_then_name(spark):
    none = F.array().cast("array<string>")
    df = spark.range(1)
    got = df.select(
        geo.record_countries(F.array(F.lit("uk")), F.array(F.lit("a.de")), F.lit("X (France)")).alias("a"),
        geo.record_countries(none, F.array(F.lit("a.de"), F.lit("b.us.UK")), F.lit("X (France)")).alias("b"),
        geo.record_countries(none, none, F.lit("X (France)")).alias("c"),
    ).first()
    assert (got.a, got.b, got.c) == (["GB"], ["DE", "US"], ["FR"])
