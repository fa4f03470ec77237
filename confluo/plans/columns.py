"""Derived-column jobs over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from confluo.functions import geo, names
from confluo.plans.registry import query, table

#: Names with the noise that feeds add; the same text is SQL in both engines.
NOISY = "CASE WHEN p_partkey % 3 = 0 THEN p_name || ' HD (1080p)' WHEN p_partkey % 3 = 1 THEN upper(p_name) || ' FHD' ELSE p_name || ' [Not 24/7]' END"
_STRIP = lambda x: rf"trim(regexp_replace(regexp_replace(trim(regexp_replace({x}, '(?i)\s*\((FHD|UHD|HD|SD|4K|HEVC|[1-9][0-9]{{2,3}}[pi])\)', '', 'g')), '(?i)(\s+(FHD|UHD|HD|SD|4K|HEVC))+\s*$', ''), '\s{{2,}}', ' ', 'g'))"
_ASCII = lambda x: rf"regexp_replace(strip_accents({x}), '[^\x00-\x7F]', '', 'g')"
KEY_SQL = lambda x, gap=" ": f"trim(regexp_replace(lower({_STRIP(f"replace({x}, '&', ' and ')")}), '[^a-z0-9]+', '{gap}', 'g'), '{gap}')"
_FIRST = "regexp_extract(text, '^[^\\n.]*')"


@query(f"SELECT doc_id, {KEY_SQL(_ASCII(_FIRST))} AS name_key FROM documents")
def name_key(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.regexp_extract("text", r"^[^\n.]*", 0).alias("name"))
    return names.with_ascii(docs, "name", "a").select("doc_id", names.name_key("a").alias("name_key"))


@query(f"SELECT doc_id, coalesce(nullif({KEY_SQL(_ASCII(_FIRST), '-')}, ''), 'unknown-channel') AS slug FROM documents")
def slug(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.regexp_extract("text", r"^[^\n.]*", 0).alias("name"))
    return names.with_ascii(docs, "name", "a").select("doc_id", names.slug("a").alias("slug"))


_PLAIN = lambda x: f"trim(regexp_replace(lower({x}), '[^a-z0-9]+', '-', 'g'), '-')"
_SIGNS = f"regexp_replace({_ASCII(_FIRST)}, '(o|t)', '\\1&+', 'g')"


@query(f"""SELECT doc_id, {_PLAIN(f"replace({_SIGNS}, '&', 'and')")} AS joined, {_PLAIN(f"replace(replace({_SIGNS}, '&', ' and '), '+', ' plus ')")} AS spelled, {_PLAIN(_SIGNS)} AS category FROM documents""")
def slug_variants(spark, d):
    """Ids of names with signs, as feeds with spelling of their own make them, and as categories are named."""
    docs = table(spark, d, "documents").select("doc_id", F.regexp_extract("text", r"^[^\n.]*", 0).alias("name"))
    x = F.regexp_replace("a", "(o|t)", "$1&+")
    return names.with_ascii(docs, "name", "a").select("doc_id", names.plain_slug(x, names.JOINED).alias("joined"), names.plain_slug(x, names.SPELLED).alias("spelled"), names.plain_slug(x).alias("category"))


@query(f"SELECT p_partkey, {_STRIP(NOISY)} AS plain FROM part")
def strip_quality(spark, d):
    return table(spark, d, "part").select("p_partkey", names.strip_quality(F.expr(NOISY)).alias("plain"))


@query(
    rf"""SELECT p_partkey, CASE WHEN regexp_matches(n, '(?i)\(\s*[1-9][0-9]{{2,3}}\s*[pi]\s*\)') THEN list_max(list_transform(regexp_extract_all(n, '(?i)\(\s*([1-9][0-9]{{2,3}})\s*[pi]\s*\)', 1), lambda x: x::INT))
    WHEN regexp_matches(n, '(?i)\b(FHD|UHD|4K|HEVC)\b') THEN 1080 WHEN regexp_matches(n, '(?i)\bHD\b') THEN 720 END AS height,
    regexp_matches(n, '(?i)\[\s*not\s*24\s*/\s*7\s*\]') AS not_24_7 FROM (SELECT p_partkey, {NOISY} AS n FROM part)"""
)
def quality_height(spark, d):
    n = F.expr(NOISY)
    return table(spark, d, "part").select("p_partkey", names.quality_height(n).alias("height"), names.not_24_7(n).alias("not_24_7"))


_LABEL = "CASE p_partkey % 9 WHEN 0 THEN '1920 x 1080' WHEN 1 THEN p_size || '0p' WHEN 2 THEN ' HD ' WHEN 3 THEN 'FHD' WHEN 4 THEN '4k' WHEN 5 THEN 'sd' WHEN 6 THEN '640x480 720p' WHEN 7 THEN '' ELSE '720P+' END"


@query("SELECT p_partkey, CASE p_partkey % 9 WHEN 0 THEN 1080 WHEN 1 THEN CASE WHEN p_size >= 10 THEN p_size * 10 END WHEN 2 THEN 720 WHEN 3 THEN 1080 WHEN 4 THEN 1080 WHEN 6 THEN 480 WHEN 8 THEN 720 END AS height FROM part")
def label_height(spark, d):
    return table(spark, d, "part").select("p_partkey", names.label_height(F.expr(_LABEL)).alias("height"))


_LABELLED = "p_name || CASE p_size % 6 WHEN 0 THEN ' (UHD)' WHEN 1 THEN ' (FHD)' WHEN 2 THEN ' (hd)' WHEN 3 THEN ' (SD)' WHEN 4 THEN ' (4K)' ELSE '' END"


@query(f"SELECT p_partkey, CASE WHEN contains(n, '(UHD)') THEN 2160 WHEN contains(n, '(FHD)') THEN 1080 WHEN contains(n, '(HD)') THEN 720 WHEN contains(n, '(SD)') THEN 0 WHEN contains(n, '(4K)') THEN 2160 ELSE 0 END AS rank FROM (SELECT p_partkey, upper({_LABELLED}) AS n FROM part)")
def quality_rank(spark, d):
    return table(spark, d, "part").select("p_partkey", names.quality_rank(F.expr(_LABELLED)).alias("rank"))


@query("SELECT p_partkey, substr(sha256(p_brand || chr(0) || p_partkey::VARCHAR || chr(0) || p_name), 1, 20) AS candidate_id FROM part")
def candidate_id(spark, d):
    return table(spark, d, "part").select("p_partkey", names.candidate_id("p_brand", F.col("p_partkey").cast("string"), "p_name").alias("candidate_id"))


_LADDER = [("(?i)green|olive|lime", "nature"), ("(?i)steel|metal|brass", "metal"), ("(?i)small|tiny", "kids")]


@query("SELECT p_partkey, CASE " + " ".join(f"WHEN regexp_matches(p_name || ' ' || p_type, '{p}') THEN '{v}'" for p, v in _LADDER) + " ELSE 'general' END AS category FROM part")
def category_ladder(spark, d):
    return table(spark, d, "part").select("p_partkey", names.first_match(F.concat_ws(" ", "p_name", "p_type"), _LADDER, "general").alias("category"))


_VOCAB = {"urgent": "news", "high": "sports", "medium": "music", "low": "movies"}
_PARTS = "replace(lower(o_orderpriority), '-', ';') || '; ' || o_orderstatus"


@query(
    "SELECT o_orderkey, coalesce(list_filter(list_transform(string_split(" + _PARTS + ", ';'), lambda x: CASE trim(lower(x)) "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _VOCAB.items()) + " END), lambda x: x IS NOT NULL)[-1], 'undefined') AS category FROM orders"
)
def vocab_map(spark, d):
    return table(spark, d, "orders").select("o_orderkey", names.vocab_last(F.expr(_PARTS), _VOCAB, "undefined").alias("category"))


_DISPLAY = "CASE WHEN p_partkey % 4 = 0 THEN p_name || ' (Backup) [1080p]' WHEN p_partkey % 4 = 1 THEN p_name || ' 720p  HD' WHEN p_partkey % 4 = 2 THEN '[4K] ' || p_name ELSE p_name || 'ᴴᴰ' END"


@query(
    rf"""SELECT p_partkey, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace({_DISPLAY}, '(?i)\s*[\(\[]\s*backup\s*[\)\]]\s*', ' ', 'g'),
    '(?i)\[\s*(\d{{3,4}}\s*[pi]|\b(UHD|FHD|HD|SD|4K|8K)\b)\s*\]', ' ', 'g'), '(?i)\s*(\b\d{{3,4}}\s*[pi]\b|\b(UHD|FHD|HD|SD|4K|8K)\b|[ᵁᴴᴰᴿ³⁸⁴⁰ᴾ]+)', ' ', 'g'), '\s+', ' ', 'g')) AS display FROM part"""
)
def clean_display(spark, d):
    return table(spark, d, "part").select("p_partkey", names.clean_display(F.expr(_DISPLAY)).alias("display"))


@query(rf"SELECT p_partkey, array_to_string(list_distinct_ordered, '|') AS variants FROM (SELECT p_partkey, list_filter([v1, CASE WHEN v2 <> v1 THEN v2 ELSE '' END, CASE WHEN v3 <> v1 AND v3 <> v2 THEN v3 ELSE '' END], lambda x: x <> '') AS list_distinct_ordered FROM (SELECT p_partkey, trim(n) AS v1, trim(regexp_replace(regexp_replace(n, '[\[(][^\])]*[\])]', '', 'g'), '\s{{2,}}', ' ', 'g')) AS v2, {_STRIP("trim(regexp_replace(regexp_replace(n, '[\\[(][^\\])]*[\\])]', '', 'g'), '\\s{2,}', ' ', 'g'))")} AS v3 FROM (SELECT p_partkey, {NOISY} AS n FROM part)))")
def title_variants(spark, d):
    return table(spark, d, "part").select("p_partkey", F.array_join(names.title_variants(F.expr(NOISY)), "|").alias("variants"))


_EXT = "CASE WHEN p_partkey % 5 = 0 THEN 'Dummy.' || p_brand || '.us' WHEN p_partkey % 5 = 1 THEN p_brand || '.Channel.uk_locals1' WHEN p_partkey % 5 = 2 THEN p_name || '.de2' ELSE p_name END"


@query(rf"SELECT p_partkey, regexp_replace(lower(x), '[^a-z0-9]+', '', 'g') AS key, replace(upper(regexp_extract(x, '(?i)\.([a-z]{{2}})(2|_locals\d+)?$', 1)), 'UK', 'GB') AS country, regexp_replace(lower(x), '[^a-z0-9]+', '', 'g') <> '' AND NOT contains(regexp_replace(lower(x), '[^a-z0-9]+', '', 'g'), 'dummy') AS usable FROM (SELECT p_partkey, {_EXT} AS x FROM part)")
def ext_id_key(spark, d):
    x = F.expr(_EXT)
    return table(spark, d, "part").select("p_partkey", names.ext_id_key(x).alias("key"), names.ext_country(x).alias("country"), names.ext_usable(x).alias("usable"))


_CLUBS = ", ".join(f"'{s}'" for s in names.CLUB_SUFFIXES)
TOKENS_SQL = lambda x: f"(SELECT CASE WHEN len(list_filter(w, lambda t: t NOT IN ({_CLUBS}))) > 0 THEN list_filter(w, lambda t: t NOT IN ({_CLUBS})) ELSE w END FROM (SELECT list_sort(list_distinct(list_filter(string_split(trim(regexp_replace(lower({x}), '[^a-z0-9]+', ' ', 'g')), ' '), lambda t: length(t) > 2))) AS w))"


@query(f"SELECT page_id, array_to_string({TOKENS_SQL('url')}, ' ') AS tokens FROM pages")
def token_set(spark, d):
    return table(spark, d, "pages").select("page_id", F.array_join(names.token_set("url"), " ").alias("tokens"))


_GAME = "CASE WHEN p_partkey % 4 = 0 THEN '[NBA] ' || p_name || ' vs ' || p_brand || ' | feed 1' WHEN p_partkey % 4 = 1 THEN ' [Liga  MX] ' || p_brand || ' V ' || p_name || ' (FAWA)' WHEN p_partkey % 4 = 2 THEN '[Ice Hockey] solo' ELSE p_name END"
_REST = r"regexp_replace(regexp_replace(regexp_replace(regexp_extract(g, '(?s)^\s*\[([^\]]+)\]\s*(.*)$', 2), '[\(\[][^)\]]*[\)\]]|\|.*$', ' ', 'g'), '\s{2,}', ' ', 'g'), '^[ |-]+|[ |-]+$', '', 'g')"
EVENT_SQL = rf"""SELECT k, prefix, CASE WHEN regexp_matches(prefix, '(?i)american football|nfl|ncaaf|\bncaa\b') THEN 'American Football' WHEN regexp_matches(prefix, '(?i)basketball|euroleague|\bnba\b') THEN 'Basketball'
  WHEN regexp_matches(prefix, '(?i)ice hockey|hockey') THEN 'Ice Hockey' ELSE 'Soccer' END AS sport, trim(parts[1]) AS home, trim(parts[2]) AS away
  FROM (SELECT k, regexp_extract(g, '(?s)^\s*\[([^\]]+)\]\s*(.*)$', 1) AS prefix, regexp_split_to_array({_REST}, '(?i)\s+(v|vs\.?|x|-)\s+') AS parts FROM (SELECT p_partkey AS k, {_GAME} AS g FROM part))
  WHERE prefix <> '' AND len(parts) >= 2"""


@query(f"SELECT k AS p_partkey, sport, home, away FROM ({EVENT_SQL})")
def parse_event(spark, d):
    e = table(spark, d, "part").select("p_partkey", names.parse_event(F.expr(_GAME)).alias("e")).where("e IS NOT NULL")
    return e.select("p_partkey", "e.sport", "e.home", "e.away")


_ELSEWHERE = "CASE WHEN doc_id % 7 = 0 THEN text || ' новости' WHEN doc_id % 11 = 0 THEN 'ニュース' WHEN doc_id % 13 = 0 THEN text || 'ዜና' WHEN doc_id % 17 = 0 THEN 'ព័ត៌មាន' WHEN doc_id % 19 = 0 THEN text || ' ಸುದ್ದಿ' WHEN doc_id % 23 = 0 THEN text || ' ⠓' ELSE text END"
_SCRIPT_CLASS = "[" + "".join(rf"\p{{{x}}}" for x in names.SCRIPTS) + "]"


@query(f"SELECT doc_id, regexp_matches(t, '{_SCRIPT_CLASS}') AS non_latin FROM (SELECT doc_id, {_ELSEWHERE} AS t FROM documents)")
def script_flag(spark, d):
    t = F.expr(_ELSEWHERE)
    return table(spark, d, "documents").select("doc_id", names.non_latin(t).alias("non_latin"))


@query(r"SELECT page_id, regexp_extract(lower(url), '^[a-z]+://([^/?#]+)', 1) AS host, coalesce(nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), ''), '') AS page, CASE WHEN page_id % 2 = 0 THEN url ELSE 'https://proxy.example.com/?url=' || url_encode(url) END AS link, url AS target FROM pages")
def url_parts(spark, d):
    link = F.expr("CASE WHEN page_id % 2 = 0 THEN url ELSE 'https://proxy.example.com/?url=' || url_encode(url) END")
    return table(spark, d, "pages").select("page_id", names.url_host("url").alias("host"), F.coalesce(names.url_query("url", "page"), F.lit("")).alias("page"), link.alias("link"), F.when(F.col("page_id") % 2 == 0, F.col("url")).otherwise(names.unwrap_proxy(link)).alias("target"))


@query("SELECT p_partkey, regexp_replace(regexp_replace(p_name || '?' || p_brand, '[^A-Za-z0-9._-]+', '-', 'g'), '^-+|-+$', '', 'g') || CASE WHEN p_size % 2 = 0 THEN '.us' ELSE '' END AS safe_id FROM part")
def safe_source_id(spark, d):
    return table(spark, d, "part").select("p_partkey", names.safe_source_id(F.expr("p_name || '?' || p_brand"), F.expr("CASE WHEN p_size % 2 = 0 THEN 'US' ELSE '' END")).alias("safe_id"))


_LOGO = "CASE WHEN p_partkey % 4 = 0 THEN 'File:' || p_name || ' logo.png' WHEN p_partkey % 4 = 1 THEN 'a/' || replace(p_name, ' ', '_') || '.SVG' WHEN p_partkey % 4 = 2 THEN p_name || ' building.jpg' ELSE p_brand || '.svg' END"


@query(
    rf"""SELECT p_partkey, f <> '' AND NOT regexp_matches(f, '(?i)icon|flag|map|photo|building|stub|commons') AND (regexp_matches(f, '(?i)logo|wordmark|ident')
    OR (regexp_matches(f, '(?i)\.(svg|pdf)$') AND stem <> '' AND w <> '' AND starts_with(w, stem))) AS plausible
    FROM (SELECT p_partkey, f, w, trim(regexp_replace(lower(regexp_replace(string_split(string_split(f, '/')[-1], ':')[-1], '(?i)\.(svg|pdf)$', '')), '[^a-z0-9]+', ' ', 'g')) AS stem
    FROM (SELECT p_partkey, {_LOGO} AS f, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')) AS w FROM part))"""
)
def asset_plausible(spark, d):
    return table(spark, d, "part").select("p_partkey", names.asset_plausible(F.expr(_LOGO), "p_name").alias("plausible"))


_DATE = "CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END"
_CLOCK = "CASE o_orderkey % 4 WHEN 0 THEN '00:15:00' WHEN 1 THEN '16:00' WHEN 2 THEN '18:30+00:00' ELSE '' END"


@query(f"SELECT o_orderkey, CASE WHEN {_DATE} <> '' THEN strptime({_DATE} || ' ' || CASE o_orderkey % 4 WHEN 0 THEN '00:15' WHEN 1 THEN '16:00' WHEN 2 THEN '18:30' ELSE '00:00' END, '%Y-%m-%d %H:%M') END AS start FROM orders")
def event_start(spark, d):
    day = F.expr("CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE date_format(o_orderdate, 'yyyy-MM-dd') END")
    return table(spark, d, "orders").select("o_orderkey", names.event_start(day, F.expr(_CLOCK)).alias("start"))


_MONTHS = "'jan','feb','mar','apr','may','jun','jul','aug','sep','oct','nov','dec'"


@query(
    f"""SELECT o_orderkey, CASE WHEN k = 0 THEN strftime(o_orderdate, '%Y-%m-%d') || 'T18:30:00+00:00' END AS start,
    CASE WHEN k = 1 THEN strftime(o_orderdate, '%m-%d') END AS hint FROM (SELECT o_orderkey, o_orderdate, o_orderkey % 3 AS k FROM orders)"""
)
def parse_kickoff(spark, d):
    raw = F.expr("CASE o_orderkey % 3 WHEN 0 THEN 'Game start: ' || date_format(o_orderdate, 'yyyy-MM-dd') || ' 18:30' WHEN 1 THEN 'Game ' || date_format(o_orderdate, 'MMMM d') || ' live' ELSE 'Game' END")
    return table(spark, d, "orders").select("o_orderkey", names.parse_kickoff(raw).alias("k")).select("o_orderkey", "k.start", "k.hint")


# -- geography: ids and names are built from part and nation -----------------------------------------------------
_REF = "CASE p_partkey % 5 WHEN 0 THEN 'Chan' || p_partkey || '.de.ES' WHEN 1 THEN 'Chan.us.UK' WHEN 2 THEN 'Chan.tz' WHEN 3 THEN 'WPIX-DT.us_locals1' ELSE 'DodomaTV' END"


@query("SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'DE' WHEN 1 THEN 'US' WHEN 2 THEN 'TZ' WHEN 3 THEN 'US' ELSE '' END AS country FROM part")
def country_ref(spark, d):
    return table(spark, d, "part").select("p_partkey", geo.country_ref(F.expr(_REF)).alias("country"))


_COUNTRY_CASE = "CASE lower(n_name) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in geo.NAMES.items()) + " ELSE '' END"


_SPELLED = "CASE p_partkey % 9 WHEN 0 THEN 'Chile' WHEN 1 THEN 'South  Africa' WHEN 2 THEN 'Türkiye' WHEN 3 THEN 'COLOMBIA' WHEN 4 THEN 'Republic of Nowhere' WHEN 5 THEN 'Viet-Nam' WHEN 6 THEN 'United States of America' WHEN 7 THEN 'Scotland' ELSE 'México' END"


@query("SELECT p_partkey, CASE p_partkey % 9 WHEN 0 THEN 'CL' WHEN 1 THEN 'ZA' WHEN 2 THEN 'TR' WHEN 3 THEN 'CO' WHEN 4 THEN '' WHEN 5 THEN 'VN' WHEN 6 THEN 'US' WHEN 7 THEN 'GB' ELSE 'MX' END AS country FROM part")
def country_spelling(spark, d):
    return table(spark, d, "part").select("p_partkey", geo.country_from_name(F.concat(F.col("p_name"), F.lit(" ("), F.expr(_SPELLED), F.lit(")"))).alias("country"))


@query(f"SELECT n_nationkey, {_COUNTRY_CASE} AS country FROM nation")
def country_name(spark, d):
    return table(spark, d, "nation").select("n_nationkey", geo.country_from_name(F.concat(F.lit("Arte ("), F.initcap("n_name"), F.lit(")"))).alias("country"))


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'FR,GB' WHEN p_size % 3 = 1 THEN CASE p_partkey % 5 WHEN 0 THEN 'DE' WHEN 1 THEN 'US' WHEN 2 THEN 'TZ' WHEN 3 THEN 'US' ELSE 'KE' END ELSE 'KE' END AS countries FROM part")
def record_countries(spark, d):
    explicit = F.expr("CASE WHEN p_size % 3 = 0 THEN array('uk', ' fr', 'bad') ELSE array() END")
    refs = F.when(F.col("p_size") % 3 == 1, F.array(F.expr(_REF))).otherwise(F.array().cast("array<string>"))
    return table(spark, d, "part").select("p_partkey", F.array_join(geo.record_countries(explicit, refs, F.expr("p_name || ' (Kenya)'")), ",").alias("countries"))


_VARIANT = "p_name || CASE p_partkey % 6 WHEN 0 THEN ' CA' WHEN 1 THEN ' (Germany) ES' WHEN 2 THEN ' Arabia' WHEN 3 THEN ' TV' WHEN 4 THEN ' (Live)' ELSE '' END"


@query("SELECT p_partkey, p_name || CASE p_partkey % 6 WHEN 3 THEN ' TV' WHEN 4 THEN ' (Live)' ELSE '' END AS base FROM part")
def region_base(spark, d):
    return table(spark, d, "part").select("p_partkey", geo.region_base(F.expr(_VARIANT), ["Arabia", "Africa"]).alias("base"))


@query("SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'GB' WHEN 1 THEN 'DE' ELSE '' END AS c0, CASE p_size % 3 WHEN 0 THEN 'GB' WHEN 1 THEN 'DE' ELSE 'FR' END AS country FROM part")
def entry_country(spark, d):
    attr = F.expr("CASE WHEN p_size % 3 = 0 THEN ' uk ' WHEN p_size % 3 = 1 THEN 'xx1' ELSE '' END")
    group = F.expr("CASE WHEN p_size % 3 = 1 THEN 'DE TV' ELSE 'Movies' END")
    return table(spark, d, "part").select("p_partkey", geo.explicit_country(attr, group).alias("c0"), geo.entry_country(attr, group, F.lit(" fr")).alias("country"))


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'DE,GB' ELSE 'GB' END AS codes, CASE WHEN p_size % 4 = 0 THEN 'US' WHEN p_size % 2 = 0 THEN '' ELSE 'GB' END AS published FROM part")
def published_country(spark, d):
    codes = geo.country_codes(F.expr("CASE WHEN p_size % 2 = 0 THEN array('uk', 'de', 'x') ELSE array('GB') END"), F.lit("UK"))
    own = F.expr("CASE WHEN p_size % 4 = 0 THEN 'US' ELSE '' END")
    return table(spark, d, "part").select("p_partkey", F.array_join(codes, ",").alias("codes"), geo.published_country(own, codes).alias("published"))


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'DE,GB,US' ELSE 'US' END AS codes FROM part")
def country_codes(spark, d):
    return table(spark, d, "part").select("p_partkey", F.array_join(geo.country_codes(F.expr("CASE WHEN p_size % 2 = 0 THEN array('uk', 'de', 'x', 'GB') ELSE array() END"), F.lit("us")), ",").alias("codes"))


@query("""SELECT doc_id, array_to_string(list_sort(list_distinct(list_concat(a, b))), ',') AS u, array_to_string(list_sort(list_intersect(a, b)), ',') AS i, len(list_filter(a, lambda x: NOT list_contains(b, x))) = 0 AS sub
FROM (SELECT doc_id, list_distinct(string_split(lang || ',' || source, ',')) AS a, list_distinct([lang, 'en', 'src1', 'src2']) AS b FROM documents)""")
def array_set_algebra(spark, d):
    a, b = F.array_distinct(F.array("lang", "source")), F.array_distinct(F.array(F.col("lang"), F.lit("en"), F.lit("src1"), F.lit("src2")))
    return table(spark, d, "documents").select("doc_id", F.array_join(F.array_sort(F.array_union(a, b)), ",").alias("u"), F.array_join(F.array_sort(F.array_intersect(a, b)), ",").alias("i"), (F.size(F.array_except(a, b)) == 0).alias("sub"))
