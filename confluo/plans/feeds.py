"""Scans, sinks and adapters over the tables rendered as feeds."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from confluo.functions import names
from confluo.operators import lookup
from confluo.plans.registry import query, table
from confluo.scratch import folder, scratch
from confluo.sources import feeds, playlists, publication

_GROUP = "CASE WHEN p_size % 4 = 0 THEN '' ELSE p_type END"


def _attrs():
    pair = lambda k, v: F.struct(F.lit(k).alias("k"), v.alias("v"))
    return F.array(pair("tvg-id", F.col("p_partkey").cast("string")), pair("tvg-name", F.concat(F.col("p_name"), F.lit(' "q" \\ x'))), pair("group-title", F.expr(_GROUP)))


def _texts(spark, d):
    """Parts as playlist texts, one text for each hundred parts, with some lines that no reader accepts."""
    p = table(spark, d, "part")
    notes = F.when(F.col("p_size") % 2 == 0, F.array(F.concat(F.lit("#EXTVLCOPT:size="), F.col("p_size").cast("string")))).otherwise(F.array().cast("array<string>"))
    text = playlists.render(_attrs(), F.concat("p_name", F.lit(", "), "p_brand"), F.concat(F.lit("http://h/"), F.col("p_partkey").cast("string")), directives=notes)
    bad = F.when(F.col("p_partkey") % 50 == 0, F.concat(F.lit('\n#EXTINF:-1 tvg-id="a,b'), F.col("p_partkey").cast("string"))).otherwise("")
    rows = p.select(F.concat(F.lit("f"), F.floor(F.col("p_partkey") / 100).cast("string")).alias("file"), "p_partkey", F.concat(text, bad).alias("t"))
    return rows.groupBy("file").agg(F.concat(F.lit("#EXTM3U x\n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", "t"))), lambda x: x["t"]), "\n")).alias("value"))


@query("SELECT p_partkey, p_name || ', ' || p_brand AS title, 'http://h/' || p_partkey AS url, CASE WHEN p_size % 2 = 0 THEN '#EXTVLCOPT:size=' || p_size ELSE '' END AS directives FROM part")
def m3u_round_trip(spark, d):
    e, _, _ = playlists.scan(_texts(spark, d))
    return e.select(playlists.get(F.col("attrs"), "tvg-id").cast("long").alias("p_partkey"), "title", "url", F.array_join("directives", "|").alias("directives"))


@query("SELECT 'f' || (p_partkey // 100) AS file, '#EXTINF:-1 tvg-id=\"a,b' || p_partkey AS line FROM part WHERE p_partkey % 50 = 0")
def m3u_rejects(spark, d):
    return playlists.scan(_texts(spark, d))[2].select("file", "line")


@query("SELECT p_partkey, k, v FROM (SELECT p_partkey, unnest(['tvg-id', 'tvg-name', 'group-title']) AS k, unnest([p_partkey::VARCHAR, p_name || ' \"q\" \\ x', CASE WHEN p_size % 4 = 0 THEN '' ELSE p_type END]) AS v FROM part) WHERE v <> ''")
def m3u_attrs(spark, d):
    e, _, _ = playlists.scan(_texts(spark, d))
    return e.select(playlists.get(F.col("attrs"), "tvg-id").cast("long").alias("p_partkey"), F.explode("attrs").alias("a")).select("p_partkey", "a.k", "a.v")


@query("SELECT p_partkey, '#EXTINF:-1 tvg-id=\"' || p_partkey || '\" tvg-name=\"' || p_name || ' \\\"q\\\" \\\\ x\"' || CASE WHEN p_size % 4 = 0 THEN '' ELSE ' group-title=\"' || p_type || '\"' END || ',' || p_name || chr(10) || 'http://h/' || p_partkey AS text FROM part")
def m3u_render(spark, d):
    return table(spark, d, "part").select("p_partkey", playlists.render(_attrs(), F.col("p_name"), F.concat(F.lit("http://h/"), F.col("p_partkey").cast("string"))).alias("text"))


@query("SELECT p_partkey, p_name || ' \"q\" \\ x' AS name, CASE WHEN p_size % 4 = 0 THEN 'Unknown' ELSE p_type END AS \"group\", p_name || ' \"q\" \\ x|' || p_name || ', ' || p_brand || '|' || p_partkey AS candidates FROM part")
def entry_names(spark, d):
    e = playlists.names_of(playlists.scan(_texts(spark, d))[0])
    return e.select(playlists.get(F.col("attrs"), "tvg-id").cast("long").alias("p_partkey"), "name", "group", F.array_join("candidates", "|").alias("candidates"))


@query("SELECT p_partkey, 'http://h/' || p_partkey AS url, CASE WHEN p_size % 4 = 0 THEN 'general' WHEN lower(p_type) = 'economy' THEN 'budget' WHEN lower(p_type) = 'promo' THEN 'offer' ELSE 'general' END AS category FROM part")
def normalise_entries(spark, d):
    e = playlists.names_of(playlists.scan(_texts(spark, d))[0])
    aliases = spark.sql("SELECT * FROM VALUES ('economy', 'budget'), ('promo', 'offer') AS t(alias, slug)")
    out = lookup.alias_join(e, names.name_key("group"), F.col("name"), aliases, "general", "category")
    return out.select(playlists.get(F.col("attrs"), "tvg-id").cast("long").alias("p_partkey"), "url", "category")


@query("SELECT conv_id, turn, last_value(CASE WHEN role = 'system' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS section FROM conversations")
def section_forward_fill(spark, d):
    c = table(spark, d, "conversations").withColumn("o", F.struct("turn", "role", "text"))
    return feeds.forward_fill(c, ["conv_id"], "o", F.col("role") == "system", F.col("turn"), "section").select("conv_id", "turn", "section")


@query("SELECT event_id, unnest(json_keys(props)) AS key, json_extract_string(props, '$.' || unnest(json_keys(props))) AS value FROM events")
def json_map_explode(spark, d):
    return feeds.explode_map(table(spark, d, "events"), "props", "string", ["event_id"])


@query(r"SELECT page_id, regexp_extract(url, '://[^/]+/([a-z]+)/', 1) AS folder, CASE regexp_extract(url, '://[^/]+/([a-z]+)/', 1) WHEN 'en' THEN 'US' WHEN 'fr' THEN 'FR' ELSE '' END AS country, CASE regexp_extract(url, '://[^/]+/([a-z]+)/', 1) WHEN 'es' THEN 'group' ELSE 'channel' END AS kind FROM pages")
def path_classify(spark, d):
    folders = spark.sql("SELECT * FROM VALUES ('en', 'US', 'channel'), ('fr', 'FR', 'channel'), ('es', '', 'group') AS t(folder, country, kind)")
    p = table(spark, d, "pages").select(F.concat(F.regexp_extract("url", r"://[^/]+/([a-z]+)/", 1), F.lit("/p "), F.col("page_id").cast("string"), F.lit(".png")).alias("path"))
    a = feeds.asset_rows(p, "path", folders, "https://h")
    return a.select(F.regexp_extract("name", r"(\d+)$", 1).cast("long").alias("page_id"), F.split("path", "/")[0].alias("folder"), "country", "kind")


@query(r"""SELECT page_id, (unnest(range(1, n + 1)) - 1)::INT AS pos, unnest(h) AS href, unnest(t) AS label FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS h, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS t, len(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>')) AS n FROM pages)""")
def html_links(spark, d):
    return feeds.html_records(table(spark, d, "pages"), "html", '<a href="([^"]*)">([^<]*)</a>', ["href", "label"], ["page_id"])


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN s_name ELSE c_name END AS c_name, CASE WHEN c_custkey % 5 = 0 THEN s_name ELSE c_mktsegment END AS c_mktsegment FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey")
def adapter_blank_fill(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 3 != 0, F.col("c_name")).otherwise("").alias("c_name"), F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")).alias("c_mktsegment"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name"), F.col("s_name").alias("c_mktsegment"))
    return feeds.blank_fill(c, s, "c_custkey", ["c_name", "c_mktsegment"])


@query("SELECT p_partkey, p_name AS title, 'http://h/' || p_partkey AS url, 1 AS headers FROM part")
def m3u_file_round_trip(spark, d):
    """Parts written as one playlist over several files and read back from there; the header is there once."""
    path = folder(spark)
    text = playlists.render(_attrs(), F.col("p_name"), F.concat(F.lit("http://h/"), F.col("p_partkey").cast("string")))
    playlists.write(table(spark, d, "part"), path, [F.col("p_type"), F.col("p_partkey")], text, header='#EXTM3U url-tvg="http://h/g.xml"')
    entries, headers, _ = playlists.scan(playlists.read(spark, path))
    n = headers.where("header = '#EXTM3U url-tvg=\"http://h/g.xml\"'").agg(F.count("*").cast("int").alias("headers"))
    return entries.select(playlists.get(F.col("attrs"), "tvg-id").cast("long").alias("p_partkey"), "title", "url").crossJoin(F.broadcast(n))  # one row


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN '#EXTM3U url-tvg="https://h/guide$1.xml" x="' || s_name || '"' ELSE '#EXTM3U x="' || s_name || '" url-tvg="https://h/guide$1.xml"' END AS header FROM supplier""")
def guide_header(spark, d):
    old = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit('#EXTM3U url-tvg="http://old" x="'), F.col("s_name"), F.lit('"'))).otherwise(F.concat(F.lit('#EXTM3U x="'), F.col("s_name"), F.lit('"')))
    return table(spark, d, "supplier").select("s_suppkey", playlists.guide_header(old, "https://h/guide$1.xml").alias("header"))


@query("SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'https://c/' || CASE WHEN page_id % 2 = 0 THEN 'ab12' ELSE 'cd34' END || '/playlist.m3u8?token=t' || page_id || 'z' WHEN 1 THEN 'https://h/x' || page_id || '/playlist.m3u8?token=t' || page_id || 'z' END AS address FROM pages")
def html_base64(spark, d):
    """Addresses in base64 chunks without padding, as player pages hold them."""
    bare = lambda x: F.regexp_replace(F.base64(x.cast("binary")), r"[=\r\n]+", "")
    k = F.col("page_id").cast("string")
    address = F.concat(F.when(F.col("page_id") % 3 == 1, F.concat(F.lit("https://h/x"), k, F.lit("/playlist.m3u8"))).otherwise(""), F.lit("?token=t"), k, F.lit("z"))
    channel = F.when(F.col("page_id") % 3 == 2, "").when(F.col("page_id") % 2 == 0, 'var _CH = "ab12";').otherwise('var _CH="cd34";')
    page = F.concat(F.col("html"), channel, F.lit("var a1 = '"), bare(F.substr(address, F.lit(1), F.lit(5))), F.lit("'; var b = '"), bare(F.substr(address, F.lit(6))), F.lit("';"))
    return table(spark, d, "pages").select("page_id", feeds.stream_address(page, "https://c/").alias("address"))


@query("SELECT s_suppkey, n_name AS country, 'https://h/v2/' || s_suppkey || '/master.m3u8?jwt=' || s_name || '&x=1' AS url FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE s_suppkey % 4 <> 0 AND s_suppkey % 4 <> 3 AND n_name IN ('NATION_1', 'NATION_2', 'NATION_5', 'NATION_8', 'NATION_13', 'NATION_21')")
def adapter_template(spark, d):
    """Records of an API that are stitched and come from allowed countries, with addresses from a template."""
    s = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    stitched = F.when(F.col("s_suppkey") % 4 == 3, F.lit(None).cast("boolean")).otherwise(F.col("s_suppkey") % 4 != 0)
    allow = ["nation_1", "Nation_2", "NATION_5", "NATION_8", "NATION_13", "NATION_21"]
    out = feeds.adapt(s, stitched, "https://h/v2/{id}/master.m3u8?jwt={token}&x=1", {"id": F.col("s_suppkey"), "token": F.col("s_name")}, F.col("n_name"), allow)
    return out.select("s_suppkey", F.col("n_name").alias("country"), "url")


@query("SELECT p_brand || '.' || p_partkey AS ext_id, p_name || ' & <b>' AS name, 'en' AS lang FROM part")
def xml_names(spark, d):
    """Parts as a gzipped XML guide with entities, written and read back."""
    path = folder(spark)
    p = table(spark, d, "part").select(F.concat("p_brand", F.lit("."), F.col("p_partkey").cast("string")).alias("_id"), F.array(F.struct(F.concat("p_name", F.lit(" & <b>")).alias("_VALUE"), F.lit("en").alias("_lang"))).alias("display-name"))
    p.write.format("xml").option("rowTag", "channel").option("rootTag", "tv").option("compression", "gzip").save(path)
    return feeds.read_xml_names(spark, path).select("ext_id", F.col("names")[0]["name"].alias("name"), F.col("names")[0]["lang"].alias("lang"))


@query(
    """WITH l AS (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice) AS k FROM lineitem),
    x AS (SELECT l_orderkey, l_linenumber, (l_orderkey * 8 + l_linenumber) * 1000 + k AS pos FROM l),
    y AS (SELECT *, max(CASE WHEN l_linenumber = 1 THEN pos END) OVER w AS opened, arg_max(l_orderkey, CASE WHEN l_linenumber = 1 THEN pos END) OVER w AS title FROM x WINDOW w AS (ORDER BY pos ROWS UNBOUNDED PRECEDING)),
    z AS (SELECT *, count(*) FILTER (l_linenumber = 3) OVER (PARTITION BY opened ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS urls FROM y WHERE opened IS NOT NULL)
    SELECT title AS l_orderkey, opened + 1 AS line_no, coalesce(max('http://h/' || l_orderkey) FILTER (l_linenumber = 3), '') AS url,
      coalesce(string_agg('#line ' || l_linenumber, '|' ORDER BY pos) FILTER (l_linenumber NOT IN (1, 3)), '') AS directives FROM z WHERE urls = 0 GROUP BY title, opened"""
)
def m3u_one_file(spark, d):
    """All line items as lines of one playlist: first items open entries, third ones are addresses, others comments."""
    key = F.struct("l_orderkey", "l_linenumber")
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    # items that share order and line number, a few at most, follow each other
    turn = F.row_number().over(Window.partitionBy(key).orderBy("l_partkey", "l_suppkey", "l_extendedprice"))
    order, no = F.col("l_orderkey").cast("string"), F.col("l_linenumber")
    line = F.when(no == 1, F.concat(F.lit("#EXTINF:-1 x=\"1\","), order)).when(no == 3, F.concat(F.lit("http://h/"), order)).otherwise(F.concat(F.lit("#line "), no.cast("string")))
    ln = li.select(F.lit("all").alias("file"), ((F.col("l_orderkey") * 8 + no) * 1000 + turn).cast("long").alias("pos"), line.alias("line"))
    e, _, _ = playlists.scan_lines(scratch(ln), block=200_000_000)
    return e.select(F.col("title").cast("long").alias("l_orderkey"), "line_no", "url", F.array_join("directives", "|").alias("directives"))


@query(
    """SELECT s_suppkey, n_name AS section, coalesce('group ' || max(CASE WHEN s_suppkey % 5 = 0 THEN s_suppkey END) OVER (PARTITION BY n_nationkey ORDER BY s_suppkey), '') AS subsection, s_name || ' (x)' AS name
    FROM supplier JOIN nation ON n_nationkey = s_nationkey"""
)
def guide_sections(spark, d):
    """Suppliers as one numbered guide: nations are sections, each fifth supplier opens a subsection."""
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    s = table(spark, d, "supplier").join(n, "s_nationkey").withColumn("at", F.col("s_nationkey").cast("long") * 10_000_000_000 + F.col("s_suppkey") * 4)
    key = F.col("s_suppkey").cast("string")
    part = s.select("at", F.explode(F.array_compact(F.array(
        F.when(F.col("s_suppkey") % 5 == 0, F.struct(F.lit(1).alias("k"), F.concat(key, F.lit(". #  Group   "), key, F.lit(" #")).alias("line"))),
        F.struct(F.lit(2).alias("k"), F.concat(key, F.lit(".  "), F.col("s_name"), F.lit(" (x) ")).alias("line")), F.struct(F.lit(3).alias("k"), F.lit("a line of other text").alias("line")),
    ))).alias("x"))
    heads = s.groupBy("s_nationkey", "n_name").agg(F.count("*").alias("n")).select((F.col("s_nationkey").cast("long") * 10_000_000_000).alias("pos"), F.concat("n_name", F.lit(" ("), F.col("n").cast("string"), F.lit(" channels)")).alias("line"))
    ln = heads.unionByName(part.select((F.col("at") + F.col("x.k")).alias("pos"), "x.line")).withColumn("file", F.lit("g"))
    g = feeds.parse_guide(ln, block=1_000_000_000)
    return g.select((F.expr("pos % 10000000000") / 4).cast("long").alias("s_suppkey"), "section", "subsection", "name")


@query("SELECT p_partkey, p_name AS title, 'http://h/' || p_partkey AS url, (SELECT count(*) FROM part) AS rows_seen, (SELECT count(*) FROM part WHERE p_size < 25) AS small_seen, true AS refused FROM part")
def publish_guarded(spark, d):
    """Parts published as a playlist, then a truncated run of them that the guards refuse: what is read is the former."""
    root, p = folder(spark), table(spark, d, "part")
    text = playlists.render(_attrs(), F.col("p_name"), F.concat(F.lit("http://h/"), F.col("p_partkey").cast("string")))
    lines = lambda df: playlists.arrange(df, [F.col("p_type"), F.col("p_partkey")], text)
    metrics = {"rows": F.count("p_partkey"), "small": F.count_if(F.col("p_size") < 25)}
    _, seen = publication.publish(lines(p), root, ["value"], metrics)
    try:
        publication.publish(lines(p.where("p_partkey % 9 = 0")), root, ["value"], metrics, {k: lambda m, k=k: 2 * m[k] >= seen[k] for k in seen})
        refused = False
    except publication.Refused as x:
        refused = sorted(x.failed) == sorted(seen)
    e, _, _ = playlists.scan_lines(playlists.read_lines(spark, publication.current(spark, root)))
    return e.select(playlists.get(F.col("attrs"), "tvg-id").cast("long").alias("p_partkey"), "title", "url", F.lit(seen["rows"]).alias("rows_seen"), F.lit(seen["small"]).alias("small_seen"), F.lit(refused).alias("refused"))


@query("SELECT p_brand AS brand, p_type AS kind, count(*) AS n, string_agg(p_name || ' \"' || p_size || '\"', '|' ORDER BY p_partkey) AS items FROM part GROUP BY ALL")
def json_catalog_round_trip(spark, d):
    """A nested catalog, brands of kinds of parts, published as one JSON text over several files and read back."""
    root, item = folder(spark), F.struct("p_partkey", F.concat("p_name", F.lit(' "'), F.col("p_size").cast("string"), F.lit('"')).alias("name"))
    kinds = table(spark, d, "part").groupBy("p_brand", "p_type").agg(F.array_sort(F.collect_list(item)).alias("items"))
    brands = kinds.groupBy("p_brand").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("p_type", "items")))).alias("kinds"))
    at, _ = publication.publish(feeds.json_map(brands, F.col("p_brand"), F.col("kinds")), root, ["value"])
    back = feeds.read_json_map(spark, at, "map<string, array<struct<p_partkey: bigint, name: string>>>")
    each = back.select(F.col("key").alias("brand"), F.explode("value").alias("kind", "items"))
    return each.select("brand", "kind", F.size("items").cast("long").alias("n"), F.array_join("items.name", "|").alias("items"))


@query("SELECT event_id, event_type AS kind, '2024-01-10' AS day, date_trunc('minute', ts) AS start, 'E ' || event_id || ' \"x\"' AS title, value FROM events WHERE ts::DATE = DATE '2024-01-10'")
def event_cache(spark, d):
    """Events as caches by day and kind, a text for each hour of day, of which one day is kept; some texts are no JSON."""
    e = table(spark, d, "events").select("event_id", "event_type", "value", F.col("ts").cast("timestamp").alias("t"))
    one = F.struct(F.col("event_id").alias("id"), F.date_format("t", "yyyy-MM-dd").alias("dateEvent"), F.date_format("t", "HH:mm:ss").alias("strTime"), F.concat(F.lit("E "), F.col("event_id").cast("string"), F.lit(' "x"')).alias("strEvent"), F.col("value").alias("v"))
    lists = e.groupBy(F.hour("t").alias("h"), F.concat(F.date_format("t", "yyyy-MM-dd"), F.lit("|"), F.col("event_type")).alias("k")).agg(F.collect_list(one).alias("l"))
    texts = lists.groupBy("h").agg(F.to_json(F.struct(F.map_from_entries(F.collect_list(F.struct("k", "l"))).alias("days"))).alias("text"))
    texts = texts.unionByName(spark.createDataFrame([(24, "no json"), (25, '{"days": 3}'), (26, None), (27, '{"days": {"x|y": null}}')], "h int, text string"))
    found = feeds.on_day(feeds.day_cache(texts, "text", ["h"]), "2024-01-10", "dateEvent", "strTime", {"event_id": ("id", "bigint"), "title": ("strEvent", "string"), "value": ("v", "double")})
    return found.select("event_id", "kind", "day", F.col("start").cast("timestamp_ntz").alias("start"), "title", "value")
