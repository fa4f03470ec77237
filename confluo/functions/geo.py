"""Derived columns of countries."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from confluo.functions.names import col, trim_all

#: ISO 3166-1 alpha-2 codes.
CODES = (
    "AD AE AF AG AI AL AM AO AQ AR AS AT AU AW AX AZ BA BB BD BE BF BG BH BI BJ BL BM BN BO BQ BR BS BT BV BW BY BZ "
    "CA CC CD CF CG CH CI CK CL CM CN CO CR CU CV CW CX CY CZ DE DJ DK DM DO DZ EC EE EG EH ER ES ET FI FJ FK FM FO "
    "FR GA GB GD GE GF GG GH GI GL GM GN GP GQ GR GS GT GU GW GY HK HM HN HR HT HU ID IE IL IM IN IO IQ IR IS IT JE "
    "JM JO JP KE KG KH KI KM KN KP KR KW KY KZ LA LB LC LI LK LR LS LT LU LV LY MA MC MD ME MF MG MH MK ML MM MN MO "
    "MP MQ MR MS MT MU MV MW MX MY MZ NA NC NE NF NG NI NL NO NP NR NU NZ OM PA PE PF PG PH PK PL PM PN PR PS PT PW "
    "PY QA RE RO RS RU RW SA SB SC SD SE SG SH SI SJ SK SL SM SN SO SR SS ST SV SX SY SZ TC TD TF TG TH TJ TK TL TM "
    "TN TO TR TT TV TW TZ UA UG UM US UY UZ VA VC VE VG VI VN VU WF WS YE YT ZA ZM ZW"
).split()
#: Names by which sources call countries.
NAMES = {
    "afghanistan": "AF", "albania": "AL", "algeria": "DZ", "argentina": "AR", "australia": "AU", "austria": "AT", "azerbaijan": "AZ",
    "bangladesh": "BD", "belarus": "BY", "belgium": "BE", "bolivia": "BO", "bosnia": "BA", "brazil": "BR", "bulgaria": "BG", "burkina faso": "BF",
    "cambodia": "KH", "cameroon": "CM", "canada": "CA", "chile": "CL", "china": "CN", "colombia": "CO", "congo": "CG", "costa rica": "CR",
    "croatia": "HR", "cuba": "CU", "cyprus": "CY", "czech republic": "CZ", "czechia": "CZ", "denmark": "DK", "ecuador": "EC", "egypt": "EG",
    "el salvador": "SV", "estonia": "EE", "ethiopia": "ET", "finland": "FI", "france": "FR", "georgia": "GE", "germany": "DE", "ghana": "GH",
    "greece": "GR", "guatemala": "GT", "honduras": "HN", "hong kong": "HK", "hungary": "HU", "iceland": "IS", "india": "IN", "indonesia": "ID",
    "iran": "IR", "iraq": "IQ", "ireland": "IE", "israel": "IL", "italy": "IT", "ivory coast": "CI", "jamaica": "JM", "japan": "JP", "jordan": "JO",
    "kazakhstan": "KZ", "kenya": "KE", "kuwait": "KW", "latvia": "LV", "lebanon": "LB", "libya": "LY", "lithuania": "LT", "luxembourg": "LU",
    "malaysia": "MY", "maldives": "MV", "mali": "ML", "malta": "MT", "mexico": "MX", "moldova": "MD", "mongolia": "MN", "montenegro": "ME",
    "morocco": "MA", "mozambique": "MZ", "myanmar": "MM", "burma": "MM", "nepal": "NP", "netherlands": "NL", "holland": "NL", "new zealand": "NZ",
    "nigeria": "NG", "north macedonia": "MK", "macedonia": "MK", "norway": "NO", "oman": "OM", "pakistan": "PK", "panama": "PA", "paraguay": "PY",
    "peru": "PE", "philippines": "PH", "poland": "PL", "portugal": "PT", "qatar": "QA", "romania": "RO", "russia": "RU", "russian federation": "RU",
    "rwanda": "RW", "saudi arabia": "SA", "senegal": "SN", "serbia": "RS", "sierra leone": "SL", "singapore": "SG", "slovakia": "SK",
    "slovenia": "SI", "somalia": "SO", "south africa": "ZA", "south korea": "KR", "korea": "KR", "spain": "ES", "sri lanka": "LK", "sudan": "SD",
    "sweden": "SE", "switzerland": "CH", "taiwan": "TW", "tanzania": "TZ", "thailand": "TH", "tunisia": "TN", "turkey": "TR", "turkiye": "TR",
    "uganda": "UG", "ukraine": "UA", "united arab emirates": "AE", "united kingdom": "GB", "great britain": "GB", "britain": "GB", "england": "GB",
    "scotland": "GB", "wales": "GB", "uk": "GB", "united states": "US", "united states of america": "US", "usa": "US", "uruguay": "UY",
    "uzbekistan": "UZ", "venezuela": "VE", "vietnam": "VN", "viet nam": "VN", "zambia": "ZM", "zimbabwe": "ZW",
}
#: Latin letters with accents, and what is left of them in compatibility decomposition.
_LETTERS = {chr(c): unicodedata.normalize("NFKD", chr(c)).encode("ascii", "ignore").decode() for c in range(0xC0, 0x250)}
_ACCENTED = {c: plain for c, plain in _LETTERS.items() if len(plain) == 1}


def alias_key(c: str | Column) -> Column:
    """A name in lower case, accents and other non-ASCII characters dropped, with single spaces."""
    ascii_ = F.regexp_replace(F.translate(col(c), "".join(_ACCENTED), "".join(_ACCENTED.values())), r"[^\x00-\x7F]+", "")
    return F.trim(F.regexp_replace(F.lower(ascii_), "[^a-z0-9]+", " "))


def _gb(c: Column) -> Column:
    return F.when(c == "UK", "GB").otherwise(c)


def country_of_name(c: str | Column, names: dict[str, str] = NAMES) -> Column:
    """Code of a country's name; empty if unknown."""
    m = F.create_map(*(F.lit(x) for kv in names.items() for x in kv))
    return F.coalesce(m[alias_key(c)], F.lit(""))


def country_from_name(c: str | Column, names: dict[str, str] = NAMES) -> Column:
    """Code of the country in a name's last brackets; empty if there is none."""
    return country_of_name(F.regexp_extract(col(c), r"\s*\(([^)]*)\)\s*$", 1), names)


def country_ref(c: str | Column) -> Column:
    """Country in a source id: its last part but one, else the last; empty if neither is a code."""
    parts = F.filter(F.split(F.coalesce(col(c), F.lit("")), r"\."), lambda p: trim_all(p) != "")

    def code(place: int) -> Column:
        part = F.lower(trim_all(F.try_element_at(parts, F.lit(place))))
        return _gb(F.upper(F.regexp_extract(part, r"^([a-z]{2})(?:[._][a-z]*\d*)?\d*$", 1)))

    good = lambda p: F.when(code(p).isin(CODES), code(p))
    return F.when(F.size(parts) < 2, "").otherwise(F.coalesce(good(-2), good(-1), F.lit("")))


def explicit_country(attr: str | Column, group: str | Column) -> Column:
    """A two-letter attribute, else the code of a group called "XX TV"; UK is GB; empty if neither."""
    a = F.upper(trim_all(F.coalesce(col(attr), F.lit(""))))
    g = F.upper(F.regexp_extract(F.coalesce(col(group), F.lit("")), r"(?i)^\s*([A-Z]{2})\s+TV\b", 1))
    return _gb(F.when(a.rlike("^[A-Z]{2}$"), a).otherwise(g))


def entry_country(attr: str | Column, group: str | Column, default: str | Column) -> Column:
    own = explicit_country(attr, group)
    return F.when(own != "", own).otherwise(F.upper(trim_all(F.coalesce(col(default), F.lit("")))))


def country_codes(countries: str | Column, country: str | Column | None = None) -> Column:
    """Distinct two-letter codes of a list (and a single value), UK as GB, sorted."""
    all_ = F.coalesce(col(countries), F.array().cast("array<string>"))
    if country is not None:
        all_ = F.array_union(all_, F.array(F.coalesce(col(country), F.lit(""))))
    up = F.transform(all_, lambda x: _gb(F.upper(trim_all(x))))
    return F.array_sort(F.array_distinct(F.filter(up, lambda x: x.rlike("^[A-Z]{2}$"))))


def record_countries(countries: str | Column, refs: str | Column, name: str | Column) -> Column:
    """Explicit codes, else those of all source references (a list of ids), else the name's; sorted."""
    explicit = country_codes(countries)
    by_ref = F.array_sort(F.array_distinct(F.filter(F.transform(F.coalesce(col(refs), F.array().cast("array<string>")), country_ref), lambda x: x != "")))
    by_name = F.filter(F.array(country_from_name(name)), lambda x: x != "")
    return F.when(F.size(explicit) > 0, explicit).when(F.size(by_ref) > 0, by_ref).otherwise(by_name)


def region_base(name: str | Column, words: list[str], names: dict[str, str] = NAMES) -> Column:
    """A name without up to four trailing region qualifiers: bracketed countries, region words, upper-case codes."""
    keys = [w.lower() for w in words]

    def step(text: Column) -> Column:
        inside = F.regexp_extract(text, r"\s*\(([^)]*)\)\s*$", 1)
        head, tail = F.regexp_extract(text, r"^(.*) ([^ ]*)$", 1), F.regexp_extract(text, r"^(.*) ([^ ]*)$", 2)
        word = alias_key(tail).isin(keys) if keys else F.lit(False)
        code = tail.rlike("^[A-Z]{2}$") & (tail != "TV") & tail.isin(CODES)
        cut = F.when(country_of_name(inside, names) != "", F.regexp_replace(text, r"\s*\([^)]*\)\s*$", "")).when(word | code, head).otherwise(text)
        cut = F.regexp_replace(cut, "^[ –—-]+|[ –—-]+$", "")
        return F.when(cut == "", text).otherwise(cut)

    text = trim_all(name)
    for _ in range(4):
        # a lambda's variable is computed once; written out, four steps would be thousands of expressions
        text = F.transform(F.array(text), step)[0]
    return text


def published_country(own: str | Column, known: str | Column) -> Column:
    """The candidate's own country, else the only known one; empty if there are several."""
    return F.when(F.coalesce(col(own), F.lit("")) != "", col(own)).when(F.size(col(known)) == 1, col(known)[0]).otherwise("")
