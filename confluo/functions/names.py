"""Derived columns of names: comparison keys, advertised quality, categories, ids. All are native Column expressions,
but for with_ascii, which folds accents of distinct non-ASCII values."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from confluo.scratch import scratch

# Quality words and patterns of the source data.
QUALITY_ANY = r"\s*\((?:FHD|UHD|HD|SD|4K|HEVC|[1-9][0-9]{2,3}[pi])\)"
QUALITY_TAIL = r"(?:\s+(?:FHD|UHD|HD|SD|4K|HEVC))+\s*$"
QUALITY_SUFFIX = r"\s+\((?:FHD|UHD|HD|SD|4K|[1-9][0-9]{2,3}[pi])\)\s*$"
RESOLUTION = r"\(\s*([1-9][0-9]{2,3})\s*[pi]\s*\)"
NOT_24_7 = r"\[\s*not\s*24\s*/\s*7\s*\]"
QUALITY_RANKS = (("UHD", 2160), ("FHD", 1080), ("HD", 720), ("SD", 0), ("4K", 2160))
CLUB_SUFFIXES = "fc cf sc ac afc cd ud rc rcd sv bk if ik un us ss as ca club atletico".split()


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_all(c: str | Column) -> Column:
    """Strip white space of any kind from both ends."""
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def with_ascii(df: DataFrame, source: str, target: str) -> DataFrame:
    """Add target: source in compatibility decomposition without its non-ASCII characters.

    ASCII values stay native; distinct other values go once through an Arrow function and come back by a join.
    """

    @F.pandas_udf("string")
    def fold(s: pd.Series) -> pd.Series:
        return s.str.normalize("NFKD").str.encode("ascii", "ignore").str.decode("ascii")

    other = df.where(F.col(source).rlike(r"[^\x00-\x7F]")).select(F.col(source).alias("_key")).distinct().withColumn("_fold", fold("_key"))
    return df.join(other, F.col(source) == F.col("_key"), "left").withColumn(target, F.coalesce("_fold", source)).drop("_key", "_fold")


def of_distinct(df: DataFrame, source: str, **derived: Column) -> DataFrame:
    """Add columns derived from source alone, each worked out once for each distinct value; values are written, so that
    Spark sees how few they are. Names are repeated by many sources, and taking one apart costs far more than a join."""
    values = scratch(df.select(F.col(source).alias("_of")).distinct().select("_of", *(c.alias(n) for n, c in derived.items())))
    return df.join(values, F.col(source).eqNullSafe(F.col("_of")), "left").drop("_of")


def strip_quality(c: str | Column) -> Column:
    """A name without advertised quality: bracketed anywhere, bare words at the end."""
    whole = trim_all(F.coalesce(col(c), F.lit("")))
    text = trim_all(F.regexp_replace(F.coalesce(col(c), F.lit("")), f"(?iU){QUALITY_ANY}", ""))
    text = trim_all(F.regexp_replace(text, f"(?iU){QUALITY_TAIL}", ""))
    text = F.regexp_replace(text, r"(?U)\s{2,}", " ")
    # a lambda's variable is computed once; named twice, the text would be taken apart twice, and so on outwards
    return F.transform(F.array(text), lambda t: F.when(t == "", whole).otherwise(t))[0]


def _key(ascii_name: str | Column, gap: str) -> Column:
    text = strip_quality(F.regexp_replace(F.coalesce(col(ascii_name), F.lit("")), "&", " and "))
    text = F.regexp_replace(F.lower(text), "[^a-z0-9]+", gap)
    return F.regexp_replace(text, f"^{gap}+|{gap}+$", "")


def name_key(ascii_name: str | Column) -> Column:
    """Comparison key of a name that is ASCII already (see with_ascii)."""
    return _key(ascii_name, " ")


def slug(ascii_name: str | Column, default: str = "unknown-channel") -> Column:
    return F.transform(F.array(_key(ascii_name, "-")), lambda s: F.when(s == "", default).otherwise(s))[0]


def plain_slug(ascii_name: str | Column, signs: dict[str, str] | None = None) -> Column:
    """A slug that keeps quality words; signs are spelled out first. As it is, the form of a category's name."""
    text = F.coalesce(col(ascii_name), F.lit(""))
    for sign, word in (signs or {}).items():
        text = F.replace(text, F.lit(sign), F.lit(word))
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", "")


#: How feeds spell signs in their ids; one joins `&` to the words beside it, one spells `+` too.
JOINED, SPELLED = {"&": "and"}, {"&": " and ", "+": " plus "}


def quality_height(c: str | Column) -> Column:
    """Largest advertised height; bare words count as 720 or 1080; null if nothing is advertised."""
    c = F.coalesce(col(c), F.lit(""))
    found = F.array_max(F.transform(F.regexp_extract_all(c, F.lit(f"(?i){RESOLUTION}"), F.lit(1)), lambda x: x.cast("int")))
    words = F.when(c.rlike(r"(?i)\b(?:FHD|UHD|4K|HEVC)\b"), 1080).when(c.rlike(r"(?i)\bHD\b"), 720)
    return F.coalesce(found, words).cast("int")


def not_24_7(c: str | Column) -> Column:
    return F.coalesce(col(c), F.lit("")).rlike(f"(?i){NOT_24_7}")


def label_height(c: str | Column) -> Column:
    """Height of a quality label such as 1920x1080, 720p or hd; null if it has none."""
    q = F.lower(trim_all(c))
    wide = F.regexp_extract(q, r"(\d{3,4})\s*x\s*(\d{3,4})", 2)
    tall = F.regexp_extract(q, r"(\d{3,4})\s*p\+?", 1)
    return F.when(wide != "", wide.cast("int")).when(tall != "", tall.cast("int")).when(q == "hd", 720).when(q.isin("fhd", "uhd", "4k"), 1080)


def quality_rank(title: str | Column) -> Column:
    """Rank of the first (LABEL) in fixed order; 0 if there is none."""
    up = F.upper(F.coalesce(col(title), F.lit("")))
    tries = [F.when(F.contains(up, F.lit(f"({label})")), rank) for label, rank in QUALITY_RANKS]
    return F.coalesce(*tries, F.lit(0))


def candidate_id(source: str | Column, entity: str | Column, url: str | Column) -> Column:
    zero = F.decode(F.unhex(F.lit("00")), "UTF-8")
    return F.substring(F.sha2(F.concat(col(source), zero, col(entity), zero, col(url)), 256), 1, 20)


def first_match(c: str | Column, ladder: list[tuple[str, str]], default: str | None = None) -> Column:
    """The value of the first pattern that a text matches."""
    out = F.lit(default)
    return reduce(lambda rest, p: F.when(col(c).rlike(p[0]), p[1]).otherwise(rest), reversed(ladder), out)


def vocab_last(c: str | Column, vocabulary: dict[str, str], default: str) -> Column:
    """The last part of a ;-list that the vocabulary knows, in its words."""
    m = F.create_map(*(F.lit(x) for kv in vocabulary.items() for x in kv))
    known = F.filter(F.transform(F.split(F.coalesce(col(c), F.lit("")), ";"), lambda x: m[F.lower(trim_all(x))]), lambda x: x.isNotNull())
    return F.coalesce(F.try_element_at(known, F.lit(-1)), F.lit(default))


# Backup marks and quality in the guide's names.
BACKUP = r"(?i)\s*[\(\[]\s*backup\s*[\)\]]\s*"
GUIDE_QUALITY = r"(?i)\[\s*(?:\d{3,4}\s*[pi]|\b(?:UHD|FHD|HD|SD|4K|8K)\b)\s*\]"
GUIDE_QUALITY_BARE = r"(?i)\s*(?:\b\d{3,4}\s*[pi]\b|\b(?:UHD|FHD|HD|SD|4K|8K)\b|[ᵁᴴᴰᴿ³⁸⁴⁰ᴾ]+)"


def clean_display(c: str | Column) -> Column:
    """A guide name without backup marks, quality and doubled spaces."""
    s = F.regexp_replace(col(c), BACKUP, " ")
    s = F.regexp_replace(s, GUIDE_QUALITY, " ")
    s = F.regexp_replace(s, GUIDE_QUALITY_BARE, " ")
    return trim_all(F.regexp_replace(s, r"\s+", " "))


def ext_id_key(c: str | Column) -> Column:
    return F.regexp_replace(F.lower(col(c)), "[^a-z0-9]+", "")


#: Fixed value: the country's place at the end of an outside id.
EXT_COUNTRY = r"(?i)\.([a-z]{2})(?:2|_locals\d+)?$"


def ext_country(c: str | Column) -> Column:
    """Country suffix of an outside id, UK read as GB; empty if there is none."""
    code = F.upper(F.regexp_extract(col(c), EXT_COUNTRY, 1))
    return F.when(code == "UK", "GB").otherwise(code)


def ext_usable(c: str | Column) -> Column:
    k = ext_id_key(c)
    return (k != "") & ~F.contains(k, F.lit("dummy"))


def token_set(c: str | Column) -> Column:
    """Words of a name with more than two letters, without club suffixes unless nothing else is left; sorted."""
    text = F.trim(F.regexp_replace(F.lower(F.coalesce(col(c), F.lit(""))), "[^a-z0-9]+", " "))
    words = F.sort_array(F.array_distinct(F.filter(F.split(text, " "), lambda w: F.length(w) > 2)))
    # a lambda's variable is computed once; written out, the words would be taken apart anew at each mention
    rest = lambda ws: F.transform(F.array(F.filter(ws, lambda w: ~w.isin(CLUB_SUFFIXES))), lambda r: F.when(F.size(r) > 0, r).otherwise(ws))[0]
    return F.transform(F.array(words), rest)[0]


#: Scripts that tell a title which isn't English.
SCRIPTS = (
    "Arabic Cyrillic Devanagari Greek Hebrew Han Hiragana Katakana Hangul Thai Bengali Tamil Telugu Kannada Malayalam Gujarati "
    "Gurmukhi Oriya Sinhala Armenian Georgian Lao Khmer Myanmar Ethiopic Tibetan Mongolian Thaana Syriac Nko Tifinagh Balinese "
    "Javanese Sundanese Tagalog Limbu Meetei_Mayek Ol_Chiki Bopomofo Yi Cherokee Canadian_Aboriginal Runic Glagolitic Braille"
).split()


#: The lowest character of any of these scripts (Bopomofo's); what lies below is told from them by one comparison.
FIRST_OTHER = 0x2EA


def non_latin(c: str | Column) -> Column:
    scripts = "".join(rf"\p{{Is{x}}}" for x in SCRIPTS)
    return F.coalesce(col(c), F.lit("")).rlike(rf"[\x{{{FIRST_OTHER:X}}}-\x{{10FFFF}}&&[{scripts}]]")


def url_host(c: str | Column) -> Column:
    return F.lower(F.parse_url(col(c), F.lit("HOST")))


def url_query(c: str | Column, key: str) -> Column:
    return F.parse_url(col(c), F.lit("QUERY"), F.lit(key))


def unwrap_proxy(c: str | Column, key: str = "url") -> Column:
    """The address that a proxy link carries in its query, or the link itself."""
    return F.coalesce(F.try_url_decode(url_query(c, key)), col(c))


def title_variants(c: str | Column) -> Column:
    """A name as it is, without bracketed remarks, without quality; distinct, most specific first."""
    bare = trim_all(F.regexp_replace(F.regexp_replace(col(c), r"[\[(][^\])]*[\])]", ""), r"\s{2,}", " "))
    base = strip_quality(F.when(bare == "", col(c)).otherwise(bare))
    return F.filter(F.array_distinct(F.array(trim_all(c), bare, base)), lambda x: x != "")


def safe_source_id(c: str | Column, country: str | Column | None = None) -> Column:
    s = F.regexp_replace(F.regexp_replace(col(c), r"[^A-Za-z0-9._-]+", "-"), "^-+|-+$", "")
    return s if country is None else F.when(F.coalesce(col(country), F.lit("")) == "", s).otherwise(F.concat(s, F.lit("."), F.lower(col(country))))


#: Words of file names that speak against and for a logo.
ASSET_JUNK, ASSET_HINTS = "(?i)icon|flag|map|photo|building|stub|commons", "(?i)logo|wordmark|ident"


def asset_plausible(file_name: str | Column, title: str | Column) -> Column:
    """Whether a file may be the artwork of an article: no junk, and a hint word or a vector named after it."""
    name = F.coalesce(col(file_name), F.lit(""))
    base = F.element_at(F.split(F.element_at(F.split(name, "/"), -1), ":"), -1)
    stem = F.trim(F.regexp_replace(F.lower(F.regexp_replace(base, r"(?i)\.(svg|pdf)$", "")), "[^a-z0-9]+", " "))
    wanted = F.trim(F.regexp_replace(F.lower(F.coalesce(col(title), F.lit(""))), "[^a-z0-9]+", " "))
    vector = name.rlike(r"(?i)\.(svg|pdf)$") & (wanted != "") & (stem != "") & ((stem == wanted) | F.startswith(wanted, stem))
    return (name != "") & ~name.rlike(ASSET_JUNK) & (name.rlike(ASSET_HINTS) | vector)


# -- events ------------------------------------------------------------------------------------------------------
#: Words of an event's prefix that name its sport, in order.
SPORT_HINTS = [
    (r"(?i)american football|nfl|ncaaf|\bncaa\b", "American Football"),
    (r"(?i)basketball|euroleague|\bnba\b", "Basketball"),
    (r"(?i)motorsport|\bf1\b|rally", "Motorsport"),
    (r"(?i)ice hockey|hockey", "Ice Hockey"),
    (r"(?i)baseball|\bmlb\b", "Baseball"),
    (r"(?i)rugby", "Rugby"),
    (r"(?i)\bmma\b|ufc|bellator|boxing", "Fighting"),
    (r"(?i)tennis", "Tennis"),
    (r"(?i)cricket", "Cricket"),
]


# The forms of an event's name and of a kick-off.
EVENT = r"(?s)^\s*\[([^\]]+)\]\s*(.*)$"
EVENT_REMARKS = r"[\(\[][^)\]]*[\)\]]|\|.*$"
EVENT_VERSUS = r"(?i)\s+(?:v|vs\.?|x|-)\s+"
KICKOFF = r"start\s*:\s*(\d{4}-\d{2}-\d{2})[ T](\d{2}:\d{2}(?::\d{2})?)"
MONTHS = "jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec"
MONTH_DAY = rf"(?i)\b({MONTHS})[a-z]*\s+(\d{{1,2}})\b"


def parse_event(c: str | Column) -> Column:
    """Struct (sport, home, away, prefix) of "[League] A vs B | feed"; null if the text is none."""
    prefix, rest = F.regexp_extract(col(c), EVENT, 1), F.regexp_extract(col(c), EVENT, 2)
    rest = F.regexp_replace(F.regexp_replace(rest, EVENT_REMARKS, " "), r"\s{2,}", " ")
    rest = F.regexp_replace(rest, r"^[ |-]+|[ |-]+$", "")
    parts = F.filter(F.transform(F.split(rest, EVENT_VERSUS), trim_all), lambda p: p != "")
    return F.when((prefix != "") & (F.size(parts) >= 2), F.struct(first_match(prefix, SPORT_HINTS, "Soccer").alias("sport"), parts[0].alias("home"), parts[1].alias("away"), F.regexp_replace(F.regexp_replace(prefix, r"\s+", " "), r"^[ |-]+|[ |-]+$", "").alias("prefix")))


def event_start(day: str | Column, clock: str | Column) -> Column:
    """UTC time of a date and an irregular time: seconds and offsets are cut, none means midnight."""
    t = trim_all(F.split(F.coalesce(col(clock), F.lit("")), r"\+")[0])
    t = F.when(t == "", "00:00").otherwise(F.regexp_replace(t, r"^([^:]*:[^:]*):[^:]*$", "$1"))
    return F.try_to_timestamp(F.concat_ws(" ", trim_all(day), t), F.lit("yyyy-MM-dd H:mm"))


def parse_kickoff(c: str | Column) -> Column:
    """Struct (start, hint): an embedded start:... time, else month-day of a bare date; a year is never invented."""
    day, clock = F.regexp_extract(col(c), KICKOFF, 1), F.regexp_extract(col(c), KICKOFF, 2)
    month, number = F.lower(F.regexp_extract(col(c), MONTH_DAY, 1)), F.regexp_extract(col(c), MONTH_DAY, 2)
    place = (F.expr("0") + sum((F.when(month == m, i).otherwise(0) for i, m in enumerate(MONTHS.split("|"), 1)), F.lit(0))).cast("string")
    start = F.when(day != "", F.concat(day, F.lit("T"), clock, F.when(F.length(clock) == 5, ":00").otherwise(""), F.lit("+00:00")))
    hint = F.when((day == "") & (month != ""), F.concat(F.lpad(place, 2, "0"), F.lit("-"), F.lpad(number, 2, "0")))
    return F.struct(start.alias("start"), hint.alias("hint"))
