"""Resolution, matching and golden-record queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from confluo.functions import geo, names
from confluo.operators import checks, golden, match, resolve
from confluo.plans.columns import KEY_SQL, NOISY, TOKENS_SQL
from confluo.plans.registry import query, table

# Entities: one per name and brand; every third brand has no country. Names are shared by up to 25 entities.
_PLACE = "CASE WHEN substr(p_brand, 7, 1) = '3' THEN '' WHEN substr(p_brand, 7, 1) = '1' THEN 'US' ELSE 'DE' END"
_ENTITIES = f"SELECT min(p_partkey) AS p, p_name, p_brand, {_PLACE} AS place FROM part WHERE p_partkey % 11 < 4 GROUP BY p_name, p_brand"
_ENTRY_PLACE = "CASE WHEN p_size % 3 = 0 THEN '' WHEN p_size % 3 = 1 THEN 'US' ELSE 'FR' END"


def entities(spark, d):
    p = table(spark, d, "part").where("p_partkey % 11 < 4").groupBy("p_name", "p_brand").agg(F.min("p_partkey").alias("p")).withColumn("place", F.expr(_PLACE))
    name = names.name_key("p_name")
    return p.select(F.concat(F.lit("e"), F.col("p").cast("string")).alias("entity_id"), F.array(name).alias("keys"), F.when(F.col("place") == "", F.array().cast("array<string>")).otherwise(F.array("place")).alias("countries"))


def entries(parts):
    e = parts.select(F.col("p_partkey").alias("entry_key"), F.col("p_brand").alias("source"), F.expr(_ENTRY_PLACE).alias("country"), F.expr(NOISY).alias("name"))
    n = F.col("_of")
    e = names.of_distinct(e, "name", keys=F.array(names.name_key(F.concat(F.lit("zz "), n)), names.name_key(n)), slug=names.slug(n))
    return e.select("entry_key", "source", "keys", "country", "slug")


def aliases(spark, d):
    # a brand's own name for a part, if one entity alone bears it there
    e = table(spark, d, "part").where("p_partkey % 11 < 4 AND p_brand = 'Brand#22'").groupBy("p_name", "p_brand").agg(F.min("p_partkey").alias("p"))
    return e.select(F.col("p_brand").alias("source"), names.name_key("p_name").alias("alias_key"), F.concat(F.lit("e"), F.col("p").cast("string")).alias("entity_id"))


RESOLVE_SQL = f"""
WITH ent AS ({_ENTITIES}), k AS (SELECT 'e' || p AS id, {KEY_SQL('p_name')} AS key, place, p_brand FROM ent),
al AS (SELECT p_brand AS source, key, id FROM k WHERE p_brand = 'Brand#22'),
nm AS (SELECT key, count(*) AS n, min(id) AS only_id, count(*) FILTER (place = '') AS na, min(id) FILTER (place = '') AS aid FROM k GROUP BY key),
nc AS (SELECT key, place, count(*) AS n, min(id) AS id FROM k WHERE place <> '' GROUP BY key, place),
en AS (SELECT p_partkey, p_brand AS source, {KEY_SQL(NOISY)} AS key, {KEY_SQL(NOISY, '-')} AS slug, {_ENTRY_PLACE} AS country FROM part),
j AS (SELECT en.*, al.id AS alias_id, coalesce(nm.n, 0) AS n, nm.only_id, nm.na, nm.aid, nc.n AS cn, nc.id AS cid FROM en
  LEFT JOIN al ON al.source = en.source AND al.key = en.key LEFT JOIN nm ON nm.key = en.key LEFT JOIN nc ON nc.key = en.key AND nc.place = en.country),
o AS (SELECT *, CASE WHEN n = 1 THEN only_id WHEN n > 1 AND country <> '' AND cn >= 1 THEN CASE WHEN cn = 1 THEN cid END WHEN n > 1 AND na = 1 THEN aid END AS one FROM j)
SELECT p_partkey, coalesce(alias_id, one, CASE WHEN n > 1 THEN 'unmapped-' || slug ELSE slug END) AS entity_id,
  CASE WHEN alias_id IS NOT NULL THEN 'source-alias' WHEN one IS NOT NULL THEN 'canonical-name' WHEN n > 1 THEN 'ambiguous-fallback' ELSE 'fallback' END AS matched_by FROM o"""


def _resolved(spark, d):
    return resolve.resolve(entries(table(spark, d, "part")), entities(spark, d), aliases(spark, d))


@query(RESOLVE_SQL)
def resolve_cascade(spark, d):
    return _resolved(spark, d).select(F.col("entry_key").alias("p_partkey"), "entity_id", "matched_by")


@query(f"SELECT matched_by, count(*) AS n FROM ({RESOLVE_SQL}) WHERE matched_by IN ('fallback', 'ambiguous-fallback') GROUP BY matched_by")
def unresolved(spark, d):
    return _resolved(spark, d).where(F.col("matched_by").isin("fallback", "ambiguous-fallback")).groupBy("matched_by").agg(F.count("*").alias("n"))


@query("SELECT l_suppkey AS source, l_partkey AS ref, min(l_orderkey) AS entity_id FROM lineitem GROUP BY ALL HAVING count(DISTINCT l_orderkey) = 1 AND NOT (l_suppkey = 1 AND l_partkey < 100) UNION ALL SELECT DISTINCT 1, p_partkey, -1 FROM part WHERE p_partkey < 100")
def unique_ref(spark, d):
    refs = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("source"), F.col("l_partkey").alias("ref"), F.col("l_orderkey").alias("entity_id"))
    curated = table(spark, d, "part").where("p_partkey < 100").select(F.lit(1).cast("long").alias("source"), F.col("p_partkey").alias("ref"), F.lit(-1).cast("long").alias("entity_id"))
    return resolve.unique_refs(refs, curated)


@query(f"SELECT key, count(*) AS n, min(id) AS only_id, count(*) FILTER (place = '') AS n_agnostic, min(id) FILTER (place = '') AS agnostic_id FROM (SELECT 'e' || p AS id, {KEY_SQL('p_name')} AS key, place FROM ({_ENTITIES})) GROUP BY key")
def key_index(spark, d):
    return resolve.key_index(entities(spark, d))[0]


@query(f"SELECT p_partkey, slug || CASE WHEN (many OR man) AND place <> '' THEN '-' || lower(place) ELSE '' END AS entity_id FROM (SELECT p_partkey, slug, place, min(place) OVER w <> max(place) OVER w AS many, slug IN (SELECT {KEY_SQL('p_name', '-')} FROM part WHERE p_partkey < 4) AS man FROM (SELECT p_partkey, {KEY_SQL('p_name', '-')} || '-' || p_size AS slug, {_PLACE} AS place FROM part) WINDOW w AS (PARTITION BY slug))")
def conditional_id(spark, d):
    p = table(spark, d, "part")
    named = names.of_distinct(p, "p_name", slug=names.slug("_of"))
    items = named.select("p_partkey", F.concat("slug", F.lit("-"), F.col("p_size").cast("string")).alias("slug"), F.expr(_PLACE).alias("country"))
    manual = p.where("p_partkey < 4").select(names.slug("p_name").alias("entity_id"))
    return resolve.conditional_id(items, manual=manual).select("p_partkey", "entity_id")


_MU = """
WITH c AS (SELECT c_custkey AS l, c_nationkey || ':' || floor(c_acctbal / 100)::INT AS k FROM customer), s AS (SELECT s_suppkey AS r, s_nationkey || ':' || floor(s_acctbal / 100)::INT AS k FROM supplier),
x AS (SELECT k, min(r) AS r FROM s GROUP BY k HAVING count(*) = 1), m AS (SELECT l, r, count(*) OVER (PARTITION BY r) AS n FROM c JOIN x USING (k))"""


def _mutual(spark, d):
    key = lambda n, b: F.array(F.concat_ws(":", n, F.floor(F.col(b) / 100).cast("int").cast("string")))
    left = table(spark, d, "customer").select("c_custkey", key("c_nationkey", "c_acctbal").alias("nation_balance"))
    right = table(spark, d, "supplier").select("s_suppkey", key("s_nationkey", "s_acctbal").alias("nation_balance"))
    return match.mutual_unique(left, right, "c_custkey", "s_suppkey", ["nation_balance"])


@query(f"{_MU} SELECT l AS c_custkey, r AS s_suppkey, 'nation_balance' AS matched_by FROM m WHERE n = 1")
def mutual_unique_match(spark, d):
    return _mutual(spark, d)[0]


@query(f"{_MU} SELECT CASE WHEN n = 1 THEN 'matched' WHEN n > 1 THEN 'ambiguous' ELSE 'unmatched' END AS outcome, count(*) AS n FROM c LEFT JOIN m USING (l) GROUP BY 1")
def mutual_unique_counts(spark, d):
    return _mutual(spark, d)[1]


_STEPS = """
WITH c AS (SELECT c_custkey AS l, CASE WHEN c_custkey % 3 = 0 THEN 's' || (c_custkey // 4) END AS ref, CASE WHEN c_custkey % 2 = 0 THEN floor(c_acctbal / 20)::INT || ':' || c_nationkey END AS placed, CASE WHEN c_custkey % 2 = 1 THEN floor(c_acctbal / 20)::INT || '' END AS named FROM customer),
s AS (SELECT s_suppkey AS r, 's' || s_suppkey AS ref, floor(s_acctbal / 20)::INT || ':' || s_nationkey AS placed, floor(s_acctbal / 20)::INT || '' AS named FROM supplier),
own AS (SELECT ref FROM c WHERE ref IS NOT NULL GROUP BY ref HAVING count(*) = 1),
h AS (SELECT l, 0 AS place, 'ref' AS matched_by, min(r) AS r FROM c JOIN own USING (ref) JOIN s USING (ref) GROUP BY l HAVING count(DISTINCT r) = 1
  UNION ALL SELECT l, 1, 'placed', min(r) FROM c JOIN s USING (placed) GROUP BY l HAVING count(DISTINCT r) = 1 UNION ALL SELECT l, 2, 'named', min(r) FROM c JOIN s USING (named) GROUP BY l HAVING count(DISTINCT r) = 1),
b AS (SELECT l, r, matched_by FROM h QUALIFY row_number() OVER (PARTITION BY l ORDER BY place) = 1)
SELECT l AS c_custkey, r AS s_suppkey, matched_by FROM b QUALIFY count(*) OVER (PARTITION BY r) = 1"""


@query(_STEPS)
def mutual_unique_cascade(spark, d):
    """Source id first, unless several hold it, then name with country where that is known, else the name alone."""
    one = lambda on, x: F.when(on, F.array(x)).otherwise(F.array().cast("array<string>"))
    name = lambda balance: F.floor(F.col(balance) / 20).cast("int").cast("string")
    placed = F.col("c_custkey") % 2 == 0
    left = table(spark, d, "customer").select(
        "c_custkey", one(F.col("c_custkey") % 3 == 0, F.concat(F.lit("s"), F.floor(F.col("c_custkey") / 4).cast("string"))).alias("ref"),
        one(placed, F.concat_ws(":", name("c_acctbal"), "c_nationkey")).alias("placed"), one(~placed, name("c_acctbal")).alias("named"),
    )
    right = table(spark, d, "supplier").select("s_suppkey", F.array(F.concat(F.lit("s"), F.col("s_suppkey").cast("string"))).alias("ref"), F.array(F.concat_ws(":", name("s_acctbal"), "s_nationkey")).alias("placed"), F.array(name("s_acctbal")).alias("named"))
    return match.mutual_unique(left, right, "c_custkey", "s_suppkey", ["ref", "placed", "named"], generic=("ref",))[0]


# -- fuzzy two-party matching: sentences of benchmark items (games) and documents (events), each halved ------------
_SENT = "SELECT k, row_number() OVER (PARTITION BY k ORDER BY i) AS o, s FROM (SELECT {k} AS k, generate_subscripts(string_split(regexp_replace(text, '\\n', '.', 'g'), '.'), 1) AS i, unnest(string_split(regexp_replace(text, '\\n', '.', 'g'), '.')) AS s FROM {t}) WHERE length(trim(s)) > 20"
_HALF = lambda part: f"(SELECT array_to_string(w{'[1:(len(w) // 2)]' if part == 0 else '[(len(w) // 2) + 1:]'}, ' ') FROM (SELECT string_split(trim(s), ' ') AS w))"


def _parties(t: str, k: str, swap: bool) -> str:
    h, a = TOKENS_SQL(_HALF(0)), TOKENS_SQL(_HALF(1))
    if swap:
        h, a = f"CASE WHEN k % 2 = 0 THEN {a} ELSE {h} END", f"CASE WHEN k % 2 = 0 THEN {h} ELSE {a} END"
    return f"SELECT k, min(o) AS o, h, a FROM (SELECT k, o, {h} AS h, {a} AS a FROM ({_SENT.format(t=t, k=k)})) WHERE len(h) > 0 AND len(a) > 0 GROUP BY k, h, a"


def _fuzzy_sql(swap: bool) -> str:
    shared = lambda x, y: f"len(list_intersect({x}, {y}))"

    def score(x, y):
        s = f"{shared(x, y)} / greatest(len({x}), len({y}), 1)"
        return f"CASE WHEN {shared(x, y)} > 0 AND {shared(x, y)} IN (len({x}), len({y})) THEN greatest({s}, 0.75) ELSE {s} END" if swap else s

    total = f"least({score('g.h', 'e.h')}, {score('g.a', 'e.a')})"
    if swap:
        total = f"greatest({total}, least({score('g.h', 'e.a')}, {score('g.a', 'e.h')}))"
    return f"""WITH g AS ({_parties("(SELECT * FROM benchmark WHERE item_id >= 0)", "item_id", swap)}), e AS ({_parties("documents", "doc_id", False)}),
    x AS (SELECT g.k AS g, g.o AS go, e.k AS e, e.o AS eo, {total} AS score FROM g, e WHERE len(list_intersect(list_concat(g.h, g.a), list_concat(e.h, e.a))) > 0)
    SELECT g AS item_id, go AS place, arg_max(e, (score, -e, -eo)) AS doc_id, max(score) AS score FROM x WHERE score >= 0.6 GROUP BY g, go"""


def _sentences(df, key: str, swap: bool):
    s = df.select(F.col(key).alias("k"), F.posexplode(F.filter(F.split(F.regexp_replace("text", r"\n", "."), r"\."), lambda x: F.length(F.trim(x)) > 20)).alias("i", "s"))
    # words as a column of their own: written out, a sentence would be cut anew at each mention
    s = s.withColumn("w", F.split(F.trim("s"), " ")).withColumn("n", F.size("w"))
    mid = F.floor(F.col("n") / 2).cast("int")
    h, a = names.token_set(F.array_join(F.slice("w", 1, mid), " ")), names.token_set(F.array_join(F.slice("w", mid + 1, F.col("n")), " "))
    if swap:
        h, a = F.when(F.col("k") % 2 == 0, a).otherwise(h), F.when(F.col("k") % 2 == 0, h).otherwise(a)
    # a filter after the projection would be pushed below it and take all sentences apart twice
    both = F.filter(F.array(F.struct(h.alias("home"), a.alias("away"))), lambda x: (F.size(x["home"]) > 0) & (F.size(x["away"]) > 0))
    return s.select("k", (F.col("i") + 1).alias("o"), F.explode(both).alias("x")).select("k", "o", "x.home", "x.away")


def _fuzzy(spark, d, swap):
    # a sentence repeated in an item is one game; repeated in a document it ties with itself, and the first wins
    games = _sentences(table(spark, d, "benchmark"), "item_id", swap).groupBy("k", "home", "away").agg(F.min("o").alias("o")).select(F.struct("k", "o").alias("game"), F.lit("s").alias("kind"), "home", "away")
    events = _sentences(table(spark, d, "documents"), "doc_id", False).select(F.struct("k", "o").alias("event"), F.struct("k", "o").alias("ord"), F.lit("s").alias("kind"), "home", "away")
    return match.fuzzy_two_party(games, events, 0.6, swapped=swap, containment=swap)


@query(_fuzzy_sql(False))
def fuzzy_pair(spark, d):
    return _fuzzy(spark, d, False).select("game.k", "game.o", "event.k", "score").toDF("item_id", "place", "doc_id", "score")


@query(_fuzzy_sql(True))
def fuzzy_pair_swapped(spark, d):
    return _fuzzy(spark, d, True).select("game.k", "game.o", "event.k", "score").toDF("item_id", "place", "doc_id", "score")


@query(f"SELECT b.item_id, m.doc_id, d.source AS kind, CASE WHEN m.doc_id IS NULL THEN 'unmatched' ELSE 'matched' END AS state FROM benchmark b LEFT JOIN (SELECT item_id, arg_max(doc_id, (score, -place)) AS doc_id FROM ({_fuzzy_sql(False)}) GROUP BY item_id) m USING (item_id) LEFT JOIN documents d ON d.doc_id = m.doc_id")
def event_enrich(spark, d):
    best = _fuzzy(spark, d, False).groupBy("game.k").agg(F.max_by("event.k", F.struct("score", -F.col("game.o"))).alias("doc_id")).withColumnRenamed("k", "item_id")
    docs = table(spark, d, "documents").select("doc_id", F.col("source").alias("kind"))
    return table(spark, d, "benchmark").select("item_id").join(best, "item_id", "left").join(docs, "doc_id", "left").select("item_id", "doc_id", "kind", F.when(F.col("doc_id").isNull(), "unmatched").otherwise("matched").alias("state"))


# -- golden records ----------------------------------------------------------------------------------------------
_ITEMS = f"""SELECT {KEY_SQL('p_name', '-')} AS entity_id, p_size AS trust, {NOISY} AS name, 'u' || p_partkey AS url, p_name AS plain, {KEY_SQL(NOISY)} || ' ' || lower(p_brand) AS key, p_partkey,
  CASE WHEN p_partkey % 3 = 0 THEN 1080 WHEN p_partkey % 3 = 1 THEN 1080 END AS height, p_partkey % 3 = 2 AS not_24_7, {_PLACE} AS country, p_type AS category, p_brand AS source FROM part"""


@query(
    f"""WITH i AS ({_ITEMS}), al AS (SELECT entity_id, string_agg(name, '|' ORDER BY trust, lower(name), url) AS aliases FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity_id, key ORDER BY trust, lower(name), url) AS rk FROM i) WHERE rk = 1 QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY trust, lower(name), url) <= 40) GROUP BY entity_id),
    ca AS (SELECT entity_id, string_agg(category, '|' ORDER BY n DESC, t, l, u) AS categories FROM (SELECT entity_id, category, count(*) AS n, arg_min(trust, (trust, lower(name), url)) AS t, arg_min(lower(name), (trust, lower(name), url)) AS l, arg_min(url, (trust, lower(name), url)) AS u FROM i GROUP BY ALL) GROUP BY entity_id),
    rf AS (SELECT entity_id, string_agg(source || '=' || refs, ';' ORDER BY source) AS refs FROM (SELECT entity_id, source, array_to_string(list_sort(list(DISTINCT p_partkey::VARCHAR)), ',') AS refs FROM i GROUP BY ALL) GROUP BY entity_id)
    SELECT entity_id, arg_min(plain, (trust, lower(name), url)) AS name, max(height) AS quality_height, bool_or(not_24_7) AS not_24_7, array_to_string(list_sort(list(DISTINCT country) FILTER (country <> '')), ',') AS countries,
    any_value(aliases) AS aliases, any_value(categories) AS categories, any_value(refs) AS refs FROM i JOIN al USING (entity_id) JOIN ca USING (entity_id) JOIN rf USING (entity_id) GROUP BY entity_id"""
)
def golden_record(spark, d):
    n = F.expr(NOISY)
    items = table(spark, d, "part").select(
        names.slug("p_name").alias("entity_id"), F.col("p_size").alias("trust"), n.alias("name"), F.concat(F.lit("u"), F.col("p_partkey").cast("string")).alias("url"), F.col("p_name").alias("plain"), F.concat(names.name_key(n), F.lit(" "), F.lower("p_brand")).alias("key"),
        names.quality_height(n).alias("height"), names.not_24_7(n).alias("not_24_7"), F.expr(_PLACE).alias("country"), F.col("p_type").alias("category"), F.col("p_brand").alias("source"), F.col("p_partkey").cast("string").alias("ref"),
    )
    g = golden.golden_record(items)
    refs = F.array_join(F.transform(F.array_sort(F.map_entries("source_refs")), lambda e: F.concat(e["key"], F.lit("="), F.array_join(e["value"], ","))), ";")
    return g.select("entity_id", "name", "quality_height", "not_24_7", F.array_join("countries", ",").alias("countries"), F.array_join("aliases", "|").alias("aliases"), F.array_join("categories", "|").alias("categories"), refs.alias("refs"))


_MEMBERS = f"""SELECT p_partkey, {KEY_SQL('p_name', '-')} AS slug, CASE WHEN p_partkey % 2 = 0 AND p_partkey = min(p_partkey) OVER (PARTITION BY p_name) THEN {KEY_SQL('p_name', '-')} ELSE 'r' || p_partkey END AS id,
  {NOISY} AS name, p_name, p_partkey % 3 <> 2 AS marked, {_PLACE} AS place, p_type, p_brand, p_size % 50 = 0 AS manual, CASE WHEN p_size % 7 = 0 THEN 'x' || p_partkey END AS ext FROM part"""
_UNITED = lambda c: f"(SELECT slug, string_agg(v, '|' ORDER BY rn, pos) AS {c} FROM (SELECT slug, v, rn, pos FROM a WHERE c = '{c}' QUALIFY row_number() OVER (PARTITION BY slug, v ORDER BY rn, pos) = 1) GROUP BY slug) AS {c}_"


@query(
    f"""WITH o AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY id <> slug, length(id), id) AS rn FROM ({_MEMBERS})),
    a AS (SELECT slug, rn, 'aliases' AS c, 1 AS pos, name AS v FROM o UNION ALL SELECT slug, rn, 'aliases', 2, p_name FROM o UNION ALL SELECT slug, rn, 'countries', 1, place FROM o WHERE place <> '' UNION ALL SELECT slug, rn, 'categories', 1, p_type FROM o UNION ALL SELECT slug, rn, 'sources', 1, p_brand FROM o)
    SELECT slug, members, manual, entity_id, name, external_id, aliases, coalesce(countries, '') AS countries, categories, sources
    FROM (SELECT slug, count(*) AS members, bool_or(manual) AS manual, arg_min(id, rn) AS entity_id, coalesce(arg_min(name, rn) FILTER (NOT marked), arg_min(name, rn)) AS name, arg_min(ext, rn) FILTER (ext IS NOT NULL) AS external_id FROM o GROUP BY slug)
    JOIN {_UNITED("aliases")} USING (slug) LEFT JOIN {_UNITED("countries")} USING (slug) JOIN {_UNITED("categories")} USING (slug) JOIN {_UNITED("sources")} USING (slug)"""
)
def consolidate(spark, d):
    p, s, n = names.of_distinct(table(spark, d, "part"), "p_name", slug=names.slug("_of")), F.col("slug"), F.expr(NOISY)
    least = p.groupBy("p_name").agg(F.min("p_partkey").alias("least"))
    own = F.when((F.col("p_partkey") % 2 == 0) & (F.col("p_partkey") == F.col("least")), s).otherwise(F.concat(F.lit("r"), F.col("p_partkey").cast("string")))
    place = F.expr(_PLACE)
    r = p.join(least, "p_name").select(
        s.alias("slug"), own.alias("entity_id"), n.alias("name"), (F.col("p_partkey") % 3 != 2).alias("marked"), F.array(n, "p_name").alias("aliases"),
        F.when(place == "", F.lit(None).cast("array<string>")).otherwise(F.array(place)).alias("countries"), F.array("p_type").alias("categories"), F.array("p_brand").alias("sources"),
        (F.col("p_size") % 50 == 0).alias("manual"), F.when(F.col("p_size") % 7 == 0, F.concat(F.lit("x"), F.col("p_partkey").cast("string"))).otherwise("").alias("external_id"),
    )
    arrays = ("aliases", "countries", "categories", "sources")
    return golden.consolidate(r).select("slug", "members", "manual", "entity_id", "name", "external_id", *(F.array_join(c, "|").alias(c) for c in arrays))


_VAR = "p_name || ' ' || p_size || CASE p_partkey % 4 WHEN 0 THEN ' CA' WHEN 1 THEN ' Arabia' ELSE '' END"


@query(
    f"""WITH r AS (SELECT p_partkey AS id, p_name || ' ' || p_size AS base, p_partkey % 4 < 2 AS v, CASE WHEN p_partkey % 4 = 0 THEN 'c' WHEN p_partkey % 4 = 1 THEN 'a' ELSE '' END AS q, p_partkey % 5 = 0 AS nc, {KEY_SQL(_VAR)} AS key, {KEY_SQL("p_name || ' ' || p_size")} AS bkey FROM part)
    SELECT a.id AS p_partkey, (arg_min(b.id, (b.v, b.nc, b.id))) AS winner FROM r a JOIN r b ON b.key = a.bkey AND b.id <> a.id WHERE a.v GROUP BY a.id"""
)
def variant_fold(spark, d):
    base = geo.region_base("_of", ["Arabia"])
    r = table(spark, d, "part").select("p_partkey", F.expr(_VAR).alias("name"), F.when(F.col("p_partkey") % 5 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("US"))).alias("countries"))
    r = names.of_distinct(r, "name", key=names.name_key("_of"), base=base, base_key=names.name_key(base))
    return golden.variant_fold(r, "p_partkey", "name", "key", "base", "base_key", "countries")


_GAMES = "'[Liga MX] ' || p_name || ' vs ' || p_brand || CASE p_partkey % 3 WHEN 0 THEN ' | feed 1' WHEN 1 THEN ' (FAWA)' ELSE '' END"


@query("SELECT lower('[liga mx] ' || p_name || ' vs ' || p_brand) AS game, count(*) AS feeds, count(DISTINCT p_type) AS n_sources, min(p_partkey) AS ord, min(p_size::VARCHAR) AS start FROM part GROUP BY 1")
def feed_collapse(spark, d):
    e = names.parse_event(F.expr(_GAMES))
    f = table(spark, d, "part").select(F.lower(F.concat(F.lit("["), e["prefix"], F.lit("] "), e["home"], F.lit(" vs "), e["away"])).alias("game"), F.col("p_type").alias("source"), F.col("p_partkey").cast("string").alias("ref"), F.col("p_size").cast("string").alias("start"), F.col("p_partkey").alias("ord"), F.expr(_GAMES).alias("display"))
    return golden.feed_collapse(f).select("game", "feeds", F.size("sources").cast("long").alias("n_sources"), "ord", "start")


@query("SELECT p_name, string_agg(p_type, '|' ORDER BY NOT f, o) AS categories FROM (SELECT p_name, p_type, min(p_partkey) AS o, bool_or(p_size = 50) AS f FROM part GROUP BY ALL) GROUP BY p_name")
def category_order(spark, d):
    return golden.category_order(table(spark, d, "part"), "p_name", "p_type", "p_partkey", F.col("p_size") == 50).select("p_name", F.array_join("categories", "|").alias("categories"))


@query(f"SELECT key, country, count(DISTINCT id) AS n, min(id) AS first, max(id) AS last FROM (SELECT 'e' || p AS id, {KEY_SQL('p_name')} AS key, place AS country FROM ({_ENTITIES})) GROUP BY key, country HAVING count(DISTINCT id) > 1")
def dq_ambiguous_alias(spark, d):
    e = entities(spark, d).withColumn("key", F.col("keys")[0])
    return checks.ambiguous_aliases(e, "entity_id", "key", "countries")
