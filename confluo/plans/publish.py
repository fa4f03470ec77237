"""Orders, publication, reports and data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from confluo.functions.names import url_host
from confluo.operators import checks, order, report
from confluo.plans.registry import query, table


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderstatus = 'P', o_orderstatus, o_orderdate, o_orderkey) AS number FROM orders")
def publish_order(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    return order.number(o, [F.col("o_orderstatus") == "P", F.col("o_orderstatus"), F.col("o_orderdate"), F.col("o_orderkey")]).select("o_orderkey", "number")


_LIVE = """SELECT p_partkey, p_partkey::VARCHAR AS id, p_name AS name, p_size % 4 AS q, CASE p_size % 4 WHEN 0 THEN 'nfl' WHEN 1 THEN 'soccer' WHEN 2 THEN 'golf' END AS league,
    CASE WHEN p_size % 3 > 0 THEN p_size % 3 END AS sub, CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS grp, CASE WHEN p_partkey % 5 > 0 THEN '2024-01-' || lpad((p_partkey % 28 + 1)::VARCHAR, 2, '0') END AS start,
    CASE WHEN p_partkey % 3 = 0 THEN 'h' || p_partkey % 4 END AS hint, p_partkey % 6 AS ord, p_partkey % 3 < 2 AS live FROM part"""


@query(
    f"""SELECT p_partkey, row_number() OVER (ORDER BY live, CASE WHEN live THEN CASE league WHEN 'nfl' THEN 1 WHEN 'soccer' THEN 3 ELSE 4 END END, CASE WHEN live THEN coalesce(sub, 0) END, CASE WHEN live THEN coalesce(grp, '') END,
    CASE WHEN live THEN coalesce(start, '~~~') END, CASE WHEN live THEN coalesce(hint, '~~') END, CASE WHEN live THEN ord END, lower(name), id) AS number FROM ({_LIVE})"""
)
def publish_lineup(spark, d):
    """Parts as a line-up: two thirds in live leagues, with leagues, blocks, groups, starts and hints that may be missing."""
    k, z = F.col("p_partkey"), F.col("p_size")
    league = F.when(z % 4 == 0, "nfl").when(z % 4 == 1, "soccer").when(z % 4 == 2, "golf")
    first = F.when(k % 3 == 0, F.array(F.lit("nba"), F.lit("x"))).when(k % 3 == 1, F.array(F.lit("nfl"))).when(k % 2 == 0, F.array(F.lit("x"), F.lit("nfl"))).otherwise(F.array().cast("array<string>"))
    r = table(spark, d, "part").select(
        "p_partkey", k.cast("string").alias("entity_id"), F.col("p_name").alias("name"), first.alias("categories"), league.alias("live_league"), F.when(z % 3 > 0, z % 3).alias("live_suborder"), F.when(k % 2 == 0, F.col("p_brand")).alias("league_group"),
        F.when(k % 5 > 0, F.concat(F.lit("2024-01-"), F.lpad((k % 28 + 1).cast("string"), 2, "0"))).alias("event_start"), F.when(k % 3 == 0, F.concat(F.lit("h"), (k % 4).cast("string"))).alias("event_hint"), (k % 6).alias("live_order"),
    )
    return order.lineup(r, ["nfl", "nba", "soccer"]).select("p_partkey", "number")


@query("SELECT p_partkey, row_number() OVER (ORDER BY p_type, lower(p_name), p_partkey) AS number FROM part")
def sort_renumber(spark, d):
    return order.number(table(spark, d, "part").select("p_partkey", "p_type", "p_name"), [F.col("p_type"), F.lower("p_name"), F.col("p_partkey")]).select("p_partkey", "number")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def top_k(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100)


_HOST = "lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#]+)', 1))"


@query(f"SELECT page_id, row_number() OVER (PARTITION BY {_HOST} ORDER BY page_id) AS turn, min(page_id) OVER (PARTITION BY {_HOST}) AS first FROM pages")
def host_interleave(spark, d):
    return order.interleave(table(spark, d, "pages").select("page_id", "url"), url_host("url"), "page_id").select("page_id", "turn", "first")


@query("SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER w - 1 AS r, greatest(1, count(*) OVER (PARTITION BY source) // 7) AS s FROM documents WINDOW w AS (PARTITION BY source ORDER BY doc_id)) WHERE r % s = 0 AND r / s < 7")
def systematic_sample(spark, d):
    return order.systematic_sample(table(spark, d, "documents").select("source", "doc_id"), "source", "doc_id", 7)


@query("SELECT p_partkey, 'number=' || p_partkey || ';id=' || CASE WHEN p_size % 2 = 0 THEN 'x' || p_size ELSE p_partkey::VARCHAR END || ';name=' || p_name || CASE WHEN p_size % 3 = 0 THEN ';asset=a.svg' ELSE '' END || CASE WHEN p_size % 5 = 0 THEN ';country=US' ELSE '' END || ';group=' || p_type AS attrs FROM part")
def publish_projection(spark, d):
    p = table(spark, d, "part")
    when = lambda n, v: F.when(F.col("p_size") % n == 0, v).otherwise("")
    out = order.publish(p, F.col("p_partkey"), when(2, F.concat(F.lit("x"), F.col("p_size").cast("string"))), F.col("p_partkey").cast("string"), F.col("p_name"), when(3, "a.svg"), when(5, "US"), F.col("p_type"))
    return out.select("p_partkey", F.array_join(F.transform("attrs", lambda a: F.concat(a["k"], F.lit("="), a["v"])), ";").alias("attrs"))


@query(
    """SELECT 'source' AS metric, source AS key, count(*) AS value FROM documents GROUP BY source UNION ALL SELECT 'lang', lang, count(*) FROM documents GROUP BY lang
    UNION ALL SELECT 'tag', t, count(*) FROM (SELECT unnest(CASE WHEN n_chars > 1000 THEN ['long', lang] ELSE [lang] END) AS t FROM documents) GROUP BY t"""
)
def build_report(spark, d):
    tags = F.when(F.col("n_chars") > 1000, F.array(F.lit("long"), F.col("lang"))).otherwise(F.array("lang"))
    return report.counts(table(spark, d, "documents"), {"source": F.col("source"), "lang": F.col("lang"), "tag": tags})


@query("SELECT coalesce(event_type, 'TOTAL') AS event_type, count(*) FILTER (value > 50) AS ok, count(*) FILTER (value <= 50) AS failed, round(count(*) FILTER (value > 50) / count(*), 4) AS rate FROM events GROUP BY ROLLUP (event_type)")
def check_rate(spark, d):
    return report.check_rate(table(spark, d, "events").where("value IS NOT NULL AND event_type IS NOT NULL"), "event_type", F.col("value") > 50)


@query("SELECT event_type, count(*) FILTER (value > 50) AS active, count(*) FILTER (value <= 50 AND event_type <> 'error') AS failed, count(*) FILTER (value <= 50 AND event_type = 'error') AS skipped FROM events GROUP BY event_type")
def failed_report(spark, d):
    return report.failed_report(table(spark, d, "events").where("value IS NOT NULL"), "event_type", F.col("value") > 50, "error")


@query("SELECT event_type, event_id, user_id FROM events WHERE value <= 50 AND event_type <> 'error'")
def failed_rows(spark, d):
    """The rows that failed_report counts as failed."""
    return report.failed_rows(table(spark, d, "events").where("value IS NOT NULL"), "event_type", F.col("value") > 50, ["event_id", "user_id"], skipped="error")


@query("SELECT event_type, event_id, value FROM events WHERE value IS NOT NULL AND event_type IS NOT NULL AND value <= 50")
def check_failures(spark, d):
    """The rows that check_rate counts as failed."""
    return report.failed_rows(table(spark, d, "events").where("value IS NOT NULL AND event_type IS NOT NULL"), "event_type", F.col("value") > 50, ["event_id", "value"])


@query("""SELECT 'bad-id' AS "check", id AS key, name AS detail FROM (SELECT CASE p_partkey % 4 WHEN 0 THEN 'p-' || p_partkey WHEN 1 THEN 'P' || p_partkey WHEN 2 THEN 'p--' || p_partkey ELSE p_partkey::VARCHAR END AS id, CASE WHEN p_partkey % 7 = 0 THEN ' ' ELSE p_name END AS name, p_partkey AS k FROM part) WHERE k % 4 IN (1, 2)
UNION ALL SELECT 'blank-name', CASE p_partkey % 4 WHEN 0 THEN 'p-' || p_partkey WHEN 1 THEN 'P' || p_partkey WHEN 2 THEN 'p--' || p_partkey ELSE p_partkey::VARCHAR END, ' ' FROM part WHERE p_partkey % 7 = 0""")
def dq_records(spark, d):
    own = F.expr("CASE p_partkey % 4 WHEN 0 THEN concat('p-', p_partkey) WHEN 1 THEN concat('P', p_partkey) WHEN 2 THEN concat('p--', p_partkey) ELSE string(p_partkey) END")
    p = table(spark, d, "part").select(own.alias("id"), F.when(F.col("p_partkey") % 7 == 0, " ").otherwise(F.col("p_name")).alias("name"))
    return checks.records(p, "id", "name")


@query("SELECT 'left' AS side, p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 40) UNION ALL SELECT DISTINCT 'right', l_partkey FROM lineitem WHERE l_quantity > 40 AND l_partkey NOT IN (SELECT p_partkey FROM part)")
def set_diff(spark, d):
    li = table(spark, d, "lineitem").where("l_quantity > 40").select(F.col("l_partkey").alias("p_partkey"))
    return report.set_difference(table(spark, d, "part").select("p_partkey"), li, "p_partkey")


@query(
    """SELECT 'scheme' AS "check", page_id::VARCHAR AS key, url AS detail FROM pages WHERE NOT starts_with(url, 'https://') UNION ALL SELECT 'query', page_id::VARCHAR, url FROM pages WHERE contains(url, '?')
    UNION ALL SELECT 'blank', c_custkey::VARCHAR, c_name FROM customer WHERE trim(c_name) = '' UNION ALL SELECT 'balance', c_custkey::VARCHAR, c_name FROM customer WHERE c_acctbal < 0"""
)
def dq_entries(spark, d):
    p = table(spark, d, "pages")
    c = table(spark, d, "customer")
    a = checks.violations(p, F.col("page_id"), {"scheme": ~F.startswith("url", F.lit("https://")), "query": F.contains("url", F.lit("?"))}, F.col("url"))
    return a.unionByName(checks.violations(c, F.col("c_custkey"), {"blank": F.trim("c_name") == "", "balance": F.col("c_acctbal") < 0}, F.col("c_name")))


@query("""SELECT 'missing' AS "check", l_orderkey::VARCHAR AS key, count(*)::VARCHAR AS detail FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY l_orderkey
UNION ALL SELECT 'duplicate', o_orderkey::VARCHAR, count(*)::VARCHAR FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_orderkey HAVING count(*) > 1""")
def dq_keys(spark, d):
    return checks.references(table(spark, d, "lineitem"), "l_orderkey", table(spark, d, "orders").where("o_orderstatus <> 'P'"), "o_orderkey")


@query("""SELECT 'index-only' AS "check", p_partkey::VARCHAR AS key FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 30) UNION ALL
SELECT 'unselected', p_partkey::VARCHAR FROM part WHERE p_size = 13 UNION ALL SELECT 'missing-country', count(*)::VARCHAR FROM part WHERE p_brand LIKE '%3'""")
def dq_index(spark, d):
    p = table(spark, d, "part")
    li = table(spark, d, "lineitem").where("l_quantity > 30").select(F.col("l_partkey").alias("p_partkey"))
    lost = report.set_difference(p.select("p_partkey"), li, "p_partkey").where("side = 'left'").select(F.lit("index-only").alias("check"), F.col("p_partkey").cast("string").alias("key"))
    none = checks.violations(p, F.col("p_partkey"), {"unselected": F.col("p_size") == 13}).select("check", "key")
    warn = p.agg(F.count_if(F.endswith("p_brand", F.lit("3"))).cast("string").alias("key")).select(F.lit("missing-country").alias("check"), "key")
    return lost.unionByName(none).unionByName(warn)


@query("SELECT 'src' || i AS source, coalesce(n, 0) AS n, coalesce(n, 0) >= 10 * i AS complete FROM range(0, 25) t(i) LEFT JOIN (SELECT source, count(*) AS n FROM documents GROUP BY source) s ON s.source = 'src' || i")
def dq_completeness(spark, d):
    expected = spark.range(25).select(F.concat(F.lit("src"), F.col("id").cast("string")).alias("source"), (10 * F.col("id")).alias("least"))
    return checks.completeness(table(spark, d, "documents"), "source", expected, "least")
