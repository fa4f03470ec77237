"""Rule queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from confluo.operators import patterns
from confluo.operators import rules as R
from confluo.plans.registry import query, table

_HEIGHT = "CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_size * 40 END"


@query(
    """SELECT doc_id, reason AS excluded_by, reason = '' AS enabled FROM (SELECT d.doc_id, CASE WHEN d.doc_id % 50 = 0 THEN ''
    WHEN lang <> 'en' AND lang <> 'fr' THEN 'language:' || lang WHEN n_chars > 8000 THEN 'quality:' || n_chars || 'p' WHEN regexp_matches(text, '%%%|\\*\\*\\*') THEN 'radio'
    WHEN toxic = 1 THEN 'toxic' WHEN source = 'src7' THEN 'channel:src7' WHEN contains(text, '###') THEN 'name:###' ELSE '' END AS reason FROM documents d LEFT JOIN labels l USING (doc_id))""".replace("\\\\", "\\")
)
def rule_cascade(spark, d):
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left").withColumn("cats", F.array(F.lit("all")))
    rules = [
        R.language("source", "cats", F.array("lang"), F.when(F.col("lang").isNotNull(), F.col("lang") == "en"), within=["all"], keep=["fr"]),
        R.quality("cats", "n_chars", F.lit(False), within=["all"], max_height=8000),
        R.name_patterns("text", "cats", within=["all"], cased=["%%%", r"\*\*\*"]),
        F.when(F.col("toxic") == 1, "toxic").otherwise(""),
        R.exclude("source", "text", "cats", ids=["src7"], patterns=["###"]),
    ]
    return R.cascade(docs, rules, manual=F.col("doc_id") % 50 == 0).select("doc_id", "excluded_by", "enabled")


@query("SELECT doc_id, CASE WHEN source = 'src3' OR doc_id % 2 = 0 OR doc_id % 5 = 0 OR lang IN ('en', 'fr') THEN '' ELSE 'language:' || lang END AS reason FROM documents")
def rule_language(spark, d):
    english = F.when(F.col("doc_id") % 5 != 0, F.col("lang") == "en")
    cats = F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("sports"))).otherwise(F.array(F.lit("music")))
    return table(spark, d, "documents").select("doc_id", R.language("source", cats, F.array(F.upper("lang")), english, within=["music"], keep=["fr"], except_ids=["src3"]).alias("reason"))


@query(f"SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN '' WHEN h > 720 THEN 'quality:' || h || 'p' WHEN p_partkey % 3 = 0 THEN 'not-24/7' ELSE '' END AS reason FROM (SELECT p_partkey, {_HEIGHT} AS h FROM part)")
def rule_quality(spark, d):
    cats = F.when(F.col("p_partkey") % 2 == 0, F.array(F.lit("news"))).otherwise(F.array(F.lit("music"), F.lit("kids")))
    return table(spark, d, "part").select("p_partkey", R.quality(cats, F.expr(_HEIGHT), F.col("p_partkey") % 3 == 0, within=["music"], max_height=720, require_247=True).alias("reason"))


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 1 AND (regexp_matches(p_name, '(?i)GREEN') OR regexp_matches(p_type, '^[A-Z]+ ')) THEN 'radio' ELSE '' END AS reason FROM part")
def rule_patterns(spark, d):
    cats = F.when(F.col("p_size") % 2 == 1, F.array(F.lit("music"))).otherwise(F.array(F.lit("news")))
    both = F.concat("p_type", F.lit("|"), "p_name")
    return table(spark, d, "part").select("p_partkey", R.name_patterns(both, cats, within=["music"], any_case=[r"\|.*GREEN"], cased=[r"^[A-Z]+ "]).alias("reason"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 AND TIMESTAMP '1996-06-01 02:15:00' > o_orderdate + to_minutes(CASE o_orderpriority WHEN '1-URGENT' THEN 120 WHEN '2-HIGH' THEN 1440 WHEN '5-LOW' THEN 144000 ELSE 150 END) THEN 'event-ended:' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') ELSE '' END AS reason FROM orders")
def rule_event_expiry(spark, d):
    start = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderdate"))
    reason = R.event_expiry(start, "o_orderpriority", as_of=F.lit("1996-06-01 02:15:00").cast("timestamp_ntz"), hours={"1-URGENT": 2, "2-HIGH": 24, "5-LOW": 2400}, default_hours=2.5)
    return table(spark, d, "orders").select("o_orderkey", reason.alias("reason"))


@query("SELECT p_partkey, CASE WHEN p_brand = 'Brand#11' THEN 'channel:Brand#11' WHEN p_size > 40 THEN 'category' WHEN regexp_matches(p_name, 'red') THEN 'name:red' WHEN regexp_matches(p_name, 'o') THEN 'name:o' ELSE '' END AS reason FROM part")
def rule_exclude(spark, d):
    cats = F.when(F.col("p_size") > 40, F.array(F.lit("big"), F.lit("x"))).otherwise(F.array(F.lit("x")))
    return table(spark, d, "part").select("p_partkey", R.exclude("p_brand", "p_name", cats, ids=["Brand#11"], drop_categories=["big"], patterns=["red", "o"]).alias("reason"))


@query("SELECT n_nationkey, CASE WHEN contains(' ' || lower(n_name) || ' ', ' china ') OR n_nationkey % 10 = 9 THEN '' WHEN n_nationkey % 6 = 5 THEN 'country:unknown' WHEN r_name IN ('EUROPE', 'ASIA') THEN '' ELSE 'country:' || r_name END AS reason FROM nation JOIN region ON n_regionkey = r_regionkey")
def rule_allow_list(spark, d):
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    known = F.when(F.col("n_nationkey") % 6 == 5, F.array().cast("array<string>")).otherwise(F.array("r_name"))
    cats = F.when(F.col("n_nationkey") % 10 == 9, F.array(F.lit("sports"))).otherwise(F.array(F.lit("news")))
    return n.select("n_nationkey", R.allow_list("n_name", cats, known, allow=["EUROPE", "ASIA"], brands=["china"], except_categories=["sports"]).alias("reason"))


@query("SELECT p_partkey, CASE WHEN regexp_matches(p_name, '(?i)STEEL') OR (p_size % 2 = 0 AND regexp_matches(p_brand, '#1')) OR p_partkey % 9 = 0 THEN 'local' ELSE '' END AS reason FROM part")
def rule_nested_any(spark, d):
    countries = F.when(F.col("p_size") % 2 == 0, F.array(F.lit("US"))).otherwise(F.array(F.lit("DE")))
    refs = F.create_map(F.lit("a"), F.array("p_type"), F.lit("b"), F.array(F.lit("x"), F.when(F.col("p_partkey") % 9 == 0, "WPIX-DT.us_locals1").otherwise("y")))
    name = F.concat("p_brand", F.lit(" "), "p_name")
    return table(spark, d, "part").select("p_partkey", R.nested_any(name, countries, refs, any_case=["STEEL"], call_signs=["#1"], call_countries=["US"], ref_patterns=[r"_locals\d"]).alias("reason"))


@query("SELECT source AS dropped_group, count(*) AS n FROM documents WHERE regexp_matches(source, '(?i)^SRC1') GROUP BY source UNION ALL SELECT 'kept', count(*) FROM documents WHERE NOT regexp_matches(source, '(?i)^SRC1')")
def group_exclusion(spark, d):
    kept, dropped = R.drop_groups(table(spark, d, "documents"), "source", ["^SRC1"])
    return dropped.unionByName(kept.agg(F.count("*").alias("n")).withColumn("dropped_group", F.lit("kept")))


@query("SELECT o_orderkey, o_orderkey % 7 = 0 OR o_orderdate::DATE = DATE '1996-01-02' AS keep FROM orders")
def same_day_or_undated(spark, d):
    day = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderdate"))
    return table(spark, d, "orders").select("o_orderkey", R.same_day_or_undated(day, F.lit("1996-01-02")).alias("keep"))


@query("SELECT p_partkey FROM part WHERE regexp_matches(lower(p_type || ';' || p_brand), 'brand#1[13]') OR lower(p_type) IN ('economy', 'brand#11')")
def multi_value_filter(spark, d):
    return table(spark, d, "part").where(R.multi_value(F.concat("p_type", F.lit("; "), "p_brand"), ["brand#11", "brand#13", "economy"])).select("p_partkey")


@query(f"SELECT p_partkey FROM part WHERE coalesce(({_HEIGHT}) >= 720, true)")
def min_quality(spark, d):
    return table(spark, d, "part").where(R.min_quality(F.expr(_HEIGHT), 720, include_unknown=True)).select("p_partkey")


@query("SELECT p_partkey, p_name FROM part WHERE p_partkey % 100 = 0 OR p_size = 1 OR p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 49) OR p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_discount = 0 AND l_quantity < 3)")
def retention(spark, d):
    li = table(spark, d, "lineitem").withColumnRenamed("l_partkey", "p_partkey")
    out = R.retained(table(spark, d, "part"), li.where("l_quantity >= 49"), li.where("l_discount = 0 AND l_quantity < 3"), "p_partkey", F.col("p_partkey") % 100 == 0, F.col("p_size") == 1)
    return out.select("p_partkey", "p_name")


_NAME = "p_name || ' ' || p_size || ' ' || p_brand || ' ' || lower(p_type)"
_NOUN = "split_part(p_name, ' ', 2)"


@query(
    f"""WITH p AS (SELECT *, p_partkey % 3 AS form FROM part), a AS (SELECT p_name, p_size, min(p_partkey) AS k FROM p WHERE form = 0 GROUP BY ALL), b AS (SELECT p_size, p_brand, min(p_partkey) AS k FROM p WHERE form = 1 GROUP BY ALL),
    c AS (SELECT {_NOUN} AS noun, lower(p_type) AS kind, min(p_partkey) AS k FROM p WHERE form = 2 GROUP BY ALL)
    SELECT p_partkey, 'rule ' || coalesce(least(a.k, b.k, c.k, CASE WHEN p_size = 7 THEN 10 END), -1) AS label FROM p LEFT JOIN a USING (p_name, p_size) LEFT JOIN b USING (p_size, p_brand) LEFT JOIN c ON c.noun = {_NOUN} AND c.kind = lower(p_type)"""
)
def pattern_table(spark, d):
    """A pattern for each part, of three forms, and one without a word of its own, over the names of all parts."""
    p, k = table(spark, d, "part"), F.col("p_partkey")
    word = lambda i: F.split("p_name", " ")[i]
    size = F.col("p_size").cast("string")
    text = (
        F.when(k % 3 == 0, F.concat(F.lit(r"\b"), word(0), F.lit(r"\s+"), word(1), F.lit(r" "), size, F.lit(r"\b")))
        .when(k % 3 == 1, F.concat(F.lit(r"\b"), size, F.lit(r"\s+(?:Brand|x)[#]"), F.substring("p_brand", 7, 9), F.lit(r"\b")))
        .otherwise(F.concat(F.lit(r"\b"), word(1), F.lit(r"\b.*\b"), F.upper("p_type"), F.lit("$")))
    )
    rules = p.select(k.alias("place"), text.alias("pattern"), F.concat(F.lit("rule "), k.cast("string")).alias("label"))
    loose = spark.createDataFrame([(10, r" (7|x7) [A-Z]+#", "rule 10")], "place long, pattern string, label string")
    rules = rules.where("place <> 10").unionByName(loose).unionByName(rules.where("place = 10").withColumn("place", F.lit(10).cast("long")))
    names = p.select("p_partkey", F.concat_ws(" ", "p_name", size, "p_brand", F.lower("p_type")).alias("name"))
    return patterns.first_match(names, "p_partkey", "name", rules).select("p_partkey", F.coalesce("label", F.lit("rule -1")).alias("label"))
