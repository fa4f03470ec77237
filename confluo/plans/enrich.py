"""Lookup, index and survivorship queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from confluo.functions import names
from confluo.operators import lookup, report, stored, survive
from confluo.plans.registry import ORACLE_SQL, query, table

_RANKS = "CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END"


def _candidates(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag")
    return li.join(table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("trust")), "l_suppkey")


@query(
    f"""SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY {_RANKS}, s_nationkey, least(l_linenumber, 6), l_quantity, l_orderkey, l_linenumber) AS rn
    FROM lineitem JOIN supplier ON s_suppkey = l_suppkey) WHERE rn = 1"""
)
def survivor(spark, d):
    status = F.when(F.col("l_returnflag") == "A", "online").when(F.col("l_returnflag") == "N", "unknown").otherwise("degraded")
    rank = survive.candidate_rank(status, F.col("trust"), F.col("l_linenumber"), F.col("l_quantity"), F.lit(0), [F.col("l_orderkey"), F.col("l_linenumber")])
    return survive.survivors(_candidates(spark, d), ["l_partkey"], rank, ["l_orderkey", "l_linenumber", "l_suppkey"])


@query("SELECT p_partkey, coalesce(bool_or(l_returnflag <> 'R' AND l_linenumber < 6), true) AS any_enabled, count(l_partkey) AS n FROM part LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY p_partkey")
def effective_enabled(spark, d):
    li = table(spark, d, "lineitem").select("l_partkey", (F.col("l_returnflag") != "R").alias("enabled"), F.col("l_linenumber").alias("failures"))
    j = table(spark, d, "part").select("p_partkey").join(li, F.col("p_partkey") == F.col("l_partkey"), "left")
    return j.groupBy("p_partkey").agg(F.bool_or(survive.effective_enabled(j)).alias("any_enabled"), F.count("l_partkey").alias("n"))


@query("SELECT p_partkey, p_name, coalesce(c, '') AS candidates FROM part LEFT JOIN (SELECT l_partkey, string_agg(l_orderkey || ':' || l_linenumber, ',' ORDER BY l_orderkey, l_linenumber) AS c FROM lineitem GROUP BY l_partkey) ON l_partkey = p_partkey")
def nested_index(spark, d):
    li = table(spark, d, "lineitem").withColumnRenamed("l_partkey", "p_partkey")
    n = report.nested_index(table(spark, d, "part").select("p_partkey", "p_name"), li, "p_partkey", ["l_orderkey", "l_linenumber", "l_suppkey"])
    text = F.array_join(F.transform("candidates", lambda c: F.concat(c["l_orderkey"].cast("string"), F.lit(":"), c["l_linenumber"].cast("string"))), ",")
    return n.select("p_partkey", "p_name", F.coalesce(text, F.lit("")).alias("candidates"))


@query("SELECT l_orderkey, arg_max(l_linenumber, (l_quantity, -l_linenumber)) AS best FROM (SELECT *, bool_or(l_returnflag = 'A') OVER (PARTITION BY l_orderkey) AS any_a FROM lineitem) WHERE NOT any_a OR l_returnflag = 'A' GROUP BY l_orderkey")
def best_element(spark, d):
    items = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_quantity", "l_returnflag"))).alias("items"))
    best = survive.best_element(F.col("items"), lambda x: x["l_returnflag"] == "A", lambda x: x["l_quantity"])
    return items.select("l_orderkey", best["l_linenumber"].alias("best"))


_WORDS = "lower(regexp_extract(text, '^[^ ]+ [^ ]+'))"


@query(f"SELECT k, doc_id, source FROM (SELECT {_WORDS} AS k, doc_id, source, row_number() OVER (PARTITION BY {_WORDS} ORDER BY substr(source, 4)::INT, doc_id) AS rn FROM documents) WHERE rn = 1")
def first_wins_dedupe(spark, d):
    docs = table(spark, d, "documents").select(F.lower(F.regexp_extract("text", "^[^ ]+ [^ ]+", 0)).alias("k"), "doc_id", "source", F.substring("source", 4, 9).cast("int").alias("ord"))
    return survive.first_wins(docs, ["k"], ["ord", "doc_id"]).select("k", "doc_id", "source")


@query(f"SELECT k, doc_id, n_chars FROM (SELECT {_WORDS} AS k, doc_id, n_chars, row_number() OVER (PARTITION BY {_WORDS} ORDER BY n_chars DESC, doc_id) AS rn FROM documents) WHERE rn = 1")
def keep_best(spark, d):
    docs = table(spark, d, "documents").select(F.lower(F.regexp_extract("text", "^[^ ]+ [^ ]+", 0)).alias("k"), "doc_id", "n_chars")
    return survive.keep_best(docs, ["k"], F.col("n_chars"), ["doc_id"])


@query("SELECT source, source_ord, count(*) AS n FROM (SELECT 'documents' AS source, 0 AS source_ord, doc_id AS id FROM documents UNION ALL SELECT 'pages', 1, page_id FROM pages UNION ALL SELECT 'benchmark', 2, item_id FROM benchmark) GROUP BY ALL")
def union_sources(spark, d):
    parts = {t: table(spark, d, t).select(F.col(k).alias("id")) for t, k in (("documents", "doc_id"), ("pages", "page_id"), ("benchmark", "item_id"))}
    return report.union_sources(parts).groupBy("source", "source_ord").agg(F.count("*").alias("n"))


_ASSET = "SELECT s_nationkey % 7 AS key, CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE 'N' || s_nationkey % 4 END AS country, s_name AS value, s_suppkey % 2 AS kind FROM supplier"


@query(f"WITH a AS ({_ASSET}), c AS (SELECT c_custkey, c_nationkey % 7 AS key, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 'n' || c_custkey % 4 END AS country FROM customer) SELECT c_custkey, coalesce(CASE WHEN country <> '' THEN (SELECT arg_min(value, (kind, length(value), value)) FROM a WHERE a.key = c.key AND a.country = upper(c.country)) ELSE (SELECT arg_min(value, (kind, length(value), value)) FROM a WHERE a.key = c.key) END, '') AS asset FROM c")
def ranked_lookup(spark, d):
    a, c, rank = _assets(spark, d)
    return lookup.ranked_lookup(c, a, "key", "place", rank, "value", "asset").select("c_custkey", "asset")


def _assets(spark, d):
    a = table(spark, d, "supplier").select((F.col("s_nationkey") % 7).alias("key"), F.when(F.col("s_suppkey") % 3 == 0, "").otherwise(F.concat(F.lit("N"), (F.col("s_nationkey") % 4).cast("string"))).alias("country"), F.col("s_name").alias("value"), (F.col("s_suppkey") % 2).alias("kind"))
    c = table(spark, d, "customer").select("c_custkey", (F.col("c_nationkey") % 7).alias("key"), F.when(F.col("c_custkey") % 4 == 0, "").otherwise(F.concat(F.lit("n"), (F.col("c_custkey") % 4).cast("string"))).alias("place"))
    return a, c, [F.col("kind"), F.length("value"), F.col("value")]


@query(ORACLE_SQL["ranked_lookup"])
def ranked_lookup_stored(spark, d):
    """The same rows from an index in buckets, as repeated lookups use it."""
    a, c, rank = _assets(spark, d)
    own, anywhere = lookup.asset_index(a, rank, "value")
    index = stored.keep(own, ["_k1", "_c1"], 8), stored.keep(anywhere, ["_k2"], 8)
    return lookup.from_index(c, index, "key", "place", "asset").select("c_custkey", "asset")


_FALLBACK = "WITH i AS (SELECT s_nationkey::VARCHAR AS k, min(s_name) AS v FROM supplier WHERE s_nationkey % 3 = 0 GROUP BY 1) SELECT c_custkey, coalesce((SELECT v FROM i WHERE k = c_nationkey::VARCHAR), (SELECT v FROM i WHERE k = ((c_nationkey + 1) % 25)::VARCHAR), '') AS asset FROM customer"


@query(f"SELECT CASE WHEN asset = '' THEN 'unmatched' ELSE 'matched' END AS outcome, count(*) AS n FROM ({_FALLBACK}) GROUP BY 1")
def fallback_counts(spark, d):
    return lookup.matched_counts(ordered_fallback(spark, d), "asset", "")


@query(_FALLBACK)
def ordered_fallback(spark, d):
    i = table(spark, d, "supplier").where("s_nationkey % 3 = 0").groupBy(F.col("s_nationkey").cast("string").alias("key")).agg(F.min("s_name").alias("value"))
    c = table(spark, d, "customer").select("c_custkey", F.array(F.col("c_nationkey").cast("string"), ((F.col("c_nationkey") + 1) % 25).cast("string")).alias("keys"))
    return lookup.ordered_fallback(c, "c_custkey", "keys", i, "asset", "").select("c_custkey", "asset")


@query("SELECT c_custkey, asset, doc_id, sources FROM (" + _FALLBACK + ") JOIN (SELECT doc_id, string_agg(DISTINCT lang, ',' ORDER BY lang) AS sources FROM (SELECT a.doc_id, b.lang FROM documents a JOIN documents b USING (source)) GROUP BY doc_id) ON doc_id = c_custkey")
def fallback_and_languages_stored(spark, d):
    """Two lookups from indexes in buckets: the first known key's value, and all languages of a document's source."""
    i = table(spark, d, "supplier").where("s_nationkey % 3 = 0").groupBy(F.col("s_nationkey").cast("string").alias("key")).agg(F.min("s_name").alias("value"))
    c = table(spark, d, "customer").select("c_custkey", F.array(F.col("c_nationkey").cast("string"), ((F.col("c_nationkey") + 1) % 25).cast("string")).alias("keys"))
    docs = table(spark, d, "documents")
    langs = docs.groupBy(F.col("source").alias("key")).agg(F.collect_set("lang").alias("languages")).withColumn("english", F.lit(None).cast("boolean"))
    first = lookup.ordered_fallback(c, "c_custkey", "keys", stored.keep(i, ["key"], 8), "asset", "").select("c_custkey", "asset")
    every = lookup.multi_key_union(docs.select("doc_id", F.array("source").alias("keys")), "doc_id", "keys", stored.keep(langs, ["key"], 8))
    return first.join(every.select("doc_id", F.array_join("languages", ",").alias("sources")), F.col("c_custkey") == F.col("doc_id")).select("c_custkey", "asset", "doc_id", "sources")


@query(
    """WITH i AS (SELECT source AS k, list_sort(list(DISTINCT lang)) AS l, CASE substr(source, 4)::INT % 3 WHEN 0 THEN true WHEN 1 THEN false END AS e FROM documents GROUP BY source),
    d AS (SELECT doc_id, source AS k1, 'src' || (doc_id % 23) AS k2 FROM documents)
    SELECT doc_id, array_to_string(list_sort(list_distinct(list_concat(coalesce(a.l, []), CASE WHEN coalesce(a.e, false) THEN [] ELSE coalesce(b.l, []) END))), ',') AS languages,
    CASE WHEN a.e OR b.e THEN true WHEN NOT a.e OR NOT b.e THEN false END AS english FROM d LEFT JOIN i a ON a.k = k1 LEFT JOIN i b ON b.k = k2"""
)
def multi_key_lookup(spark, d):
    docs = table(spark, d, "documents")
    n = F.substring("source", 4, 9).cast("int") % 3
    i = docs.groupBy(F.col("source").alias("key")).agg(F.collect_set("lang").alias("languages")).withColumn("source", F.col("key")).select("key", "languages", F.when(n == 0, True).when(n == 1, False).alias("english"))
    rows = docs.select("doc_id", F.array("source", F.concat(F.lit("src"), (F.col("doc_id") % 23).cast("string"))).alias("keys"))
    return lookup.multi_key_union(rows, "doc_id", "keys", i).select("doc_id", F.array_join("languages", ",").alias("languages"), "english")


@query("SELECT p_partkey, CASE lower(p_type) WHEN 'economy' THEN 'budget' WHEN 'standard' THEN 'plain' WHEN 'promo' THEN 'offer' ELSE CASE WHEN p_size % 9 = 0 THEN 'entertainment' ELSE 'general' END END AS category FROM part")
def dim_alias_join(spark, d):
    aliases = spark.sql("SELECT * FROM VALUES ('economy', 'budget'), ('standard', 'plain'), ('promo', 'offer') AS t(alias, slug)")
    p = table(spark, d, "part")
    name = F.when(F.col("p_size") % 9 == 0, F.concat(F.lit(" ["), "p_name")).otherwise(F.col("p_name"))
    return lookup.alias_join(p, F.lower("p_type"), name, aliases, "general", "category").select("p_partkey", "category")


@query("SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_suppkey % 4 = 0)")
def worklist_anti(spark, d):
    a = table(spark, d, "supplier").where("s_suppkey % 4 = 0").select(F.col("s_nationkey").alias("key"))
    return lookup.worklist(table(spark, d, "customer").select("c_custkey", "c_nationkey"), a, "c_nationkey")


@query("SELECT p_partkey, coalesce(array_to_string(list_sort(s), ','), '') AS sources, s IS NOT NULL AS enabled, CASE WHEN s IS NULL THEN 'no-source' ELSE '' END AS excluded_by FROM part LEFT JOIN (SELECT l_partkey, list(DISTINCT l_suppkey) AS s FROM lineitem WHERE l_quantity > 45 GROUP BY 1) ON l_partkey = p_partkey")
def allow_list_left(spark, d):
    e = table(spark, d, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"), "l_suppkey", "l_orderkey")
    out = lookup.allow_list(table(spark, d, "part").select("p_partkey"), e, "p_partkey", "l_suppkey", "l_orderkey")
    return out.select("p_partkey", F.array_join(F.col("sources").cast("array<string>"), ",").alias("sources"), "enabled", "excluded_by")


@query("SELECT c_custkey, coalesce(o.v, m.v) AS ext FROM customer LEFT JOIN (SELECT c_custkey AS k, 'fixed' AS v FROM customer WHERE c_custkey % 10 = 0) o ON o.k = c_custkey LEFT JOIN (SELECT s_suppkey AS k, s_name AS v FROM supplier) m ON m.k = c_custkey")
def override_coalesce(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.lit("old").alias("ext"))
    o = c.where("c_custkey % 10 = 0").select(F.col("c_custkey").alias("key"), F.lit("fixed").alias("value"))
    m = table(spark, d, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("value"))
    return lookup.override(c, "c_custkey", o, m, "ext")


@query(
    r"""SELECT p_name, arg_min(img, (NOT exact, -overlap, NOT svg, img)) AS img FROM (SELECT p_name, img, starts_with(lower(img), 'file:' || lower(p_name) || ' ') AS exact, ends_with(lower(img), '.svg') AS svg,
    len(list_filter(string_split(lower(p_name), ' '), lambda w: length(w) > 2 AND contains(lower(img), w))) AS overlap FROM (SELECT p_name, 'File:' || CASE WHEN p_size % 3 = 0 THEN p_name || ' ' ELSE p_type || ' ' END || p_brand || ' logo' || CASE WHEN p_size % 2 = 0 THEN '.svg' ELSE '.png' END AS img FROM part)) GROUP BY p_name"""
)
def best_asset(spark, d):
    img = F.expr("'File:' || CASE WHEN p_size % 3 = 0 THEN p_name || ' ' ELSE p_type || ' ' END || p_brand || ' logo' || CASE WHEN p_size % 2 = 0 THEN '.svg' ELSE '.png' END")
    p = table(spark, d, "part").select("p_name", img.alias("img"), F.col("p_name").alias("title"))
    return lookup.best_asset(p, "p_name", "title", "img", names.asset_plausible("img", "title"))


@query("SELECT source AS key, array_to_string(list_sort(list(DISTINCT lang)), ',') AS languages, bool_or(e) AS english FROM (SELECT source, lang, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE lang = 'en' END AS e FROM documents UNION ALL SELECT 'src' || page_id % 30, 'xx', NULL FROM pages) GROUP BY source")
def tri_state_index(spark, d):
    a = table(spark, d, "documents").select(F.col("source").alias("key"), "lang", F.when(F.col("doc_id") % 3 != 0, F.col("lang") == "en").alias("flag"))
    b = table(spark, d, "pages").select(F.concat(F.lit("src"), (F.col("page_id") % 30).cast("string")).alias("key"), F.lit("xx").alias("lang"), F.lit(None).cast("boolean").alias("flag"))
    return report.tri_state_index([a, b], "key", "lang", "flag").select("key", F.array_join("languages", ",").alias("languages"), "english")
