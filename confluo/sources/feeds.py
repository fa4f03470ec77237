"""Other feeds: XML names, sectioned guides, JSON maps, file trees, HTML pages, API records."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from confluo.functions.names import event_start, trim_all
from confluo.operators import carry
from confluo.operators.order import number

XML_SCHEMA = "_id STRING, `display-name` ARRAY<STRUCT<_VALUE: STRING, _lang: STRING>>"


def read_xml_names(spark: SparkSession, path: str) -> DataFrame:
    """(ext_id, names) of the channel elements of XML guides, gz too."""
    x = spark.read.format("xml").option("rowTag", "channel").schema(XML_SCHEMA).load(path)
    return x.select(F.col("_id").alias("ext_id"), F.transform("display-name", lambda n: F.struct(n["_lang"].alias("lang"), n["_VALUE"].alias("name"))).alias("names")).where("ext_id IS NOT NULL")


def forward_fill(df: DataFrame, group: list[str], order: str, opens: Column, value: Column, out: str, block: int = carry.BLOCK) -> DataFrame:
    """Add the value of the last row at or before each row, within its group, that opens a section; a group of any size
    is scanned by many tasks."""
    rows = carry.blocks(df, group, [order], block)
    return carry.running(rows, group, "_block", "_n", {out: ("last", F.when(opens, value))}).drop("_n", "_block")


def parse_guide(lines: DataFrame, block: int = carry.BLOCK) -> DataFrame:
    """(file, pos, section, subsection, name) of a numbered guide (file, pos, line), pos being dense within a file.

    A line `Name (12 channels)` that begins with no digit opens a section, without signs before the name; a numbered one
    that begins with # opens a subsection; other numbered ones are entries, dropped before the first section. What is open
    is carried from block to block of a file's lines.
    """
    line = trim_all("line")
    section = trim_all(F.regexp_replace(F.regexp_extract(line, r"^([^0-9].*?)?\((\d+) channels\)$", 1), r"(?U)^[^\w]+", ""))
    opens = line.rlike(r"^([^0-9].*?)?\(\d+ channels\)$")
    entry = ~opens & F.col("line").rlike(r"^\s*\d+\.")
    numbered = trim_all(F.regexp_extract("line", r"^\s*\d+\.\s*(.*)$", 1))
    is_sub = entry & F.startswith(numbered, F.lit("#"))
    sub = F.lower(F.regexp_replace(trim_all(F.regexp_replace(numbered, r"^#+\s*|\s*#+$", "")), r"\s+", " "))
    df = lines.select("file", "pos", "line").withColumn("_block", F.expr(f"pos div {block}"))
    df = carry.running(df, ["file"], "_block", "pos", {"section": ("last", F.when(opens, section)), "subsection": ("last", F.when(opens, "").when(is_sub, sub))})
    return df.where(entry & ~is_sub & F.col("section").isNotNull()).select("file", "pos", "section", "subsection", numbered.alias("name"))


def explode_map(df: DataFrame, text: str, value: DataType | str, keep: list[str]) -> DataFrame:
    """(…, key, value) of a JSON object keyed by id."""
    kind = value if isinstance(value, str) else value.simpleString()
    return df.select(*keep, F.explode(F.from_json(text, f"map<string,{kind}>")).alias("key", "value"))


def day_cache(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """(…, day, kind, event) of caches {"days": {"day|kind": [event, …]}}; event is a VARIANT, whatever fields it has.

    A text that is no JSON, or has no such days, gives no rows.
    """
    tvf = df.sparkSession.tvf
    days = df.select(*keep, F.try_parse_json(text).alias("_v")).select(*keep, F.try_variant_get("_v", "$.days", "variant").alias("_days"))
    by_key = days.lateralJoin(tvf.variant_explode(F.col("_days").outer())).select(*keep, F.col("key").alias("_key"), F.col("value").alias("_list"))
    each = by_key.lateralJoin(tvf.variant_explode(F.col("_list").outer())).select(*keep, "_key", F.col("value").alias("event"))
    return each.select(*keep, F.substring_index("_key", "|", 1).alias("day"), F.substring_index("_key", "|", -1).alias("kind"), "event")


def on_day(cache: DataFrame, day: str, date: str, clock: str, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """Events of a cache that take place on a day, by their own date (its first ten characters), with start, the UTC time
    of date and clock, and fields by name, each (path, type)."""
    get = lambda path, kind: F.try_variant_get("event", f"$.{path}", kind)
    own = F.substring(F.trim(F.coalesce(get(date, "string"), F.lit(""))), 1, 10)
    names = {k: get(*v).alias(k) for k, v in fields.items()}
    rest = [c for c in cache.columns if c != "event"]
    return cache.where(own == day).select(*rest, event_start(own, get(clock, "string")).alias("start"), *names.values())


def json_map(df: DataFrame, key: Column, value: Column, partitions: int | None = None) -> DataFrame:
    """df with value: its rows as lines of one JSON object, by key; lines but the first begin with a comma.

    The first line opens the object and the last closes it, so the files written from it, one after the other by name, are
    one JSON text, however many tasks write it. Keys that are null or occur again make no object: they raise an error.
    """
    twice = F.when(F.lag("_k").over(Window.partitionBy("_k").orderBy("_k")).isNotNull(), F.raise_error(F.concat(F.lit("key occurs twice: "), F.col("_k"))))
    rows = df.select("*", F.coalesce(key.cast("string"), F.raise_error(F.lit("null key")).cast("string")).alias("_k"), F.to_json(value).alias("_v"))
    rows = rows.withColumn("_k", F.coalesce(twice.cast("string"), F.col("_k")))
    placed = number(rows, [F.col("_k")], "_n", partitions)
    # a key as JSON: the text of a one-element array without its brackets
    quoted = F.regexp_replace(F.to_json(F.array("_k")), r"^\[|\]$", "")
    line = F.concat(F.when(F.col("_n") > 1, ",").otherwise(""), quoted, F.lit(":"), F.col("_v"))
    ends = df.sparkSession.createDataFrame([(0, "{"), (None, "}")], "_n long, value string")
    more = ends.select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema), F.coalesce("_n", F.lit((1 << 63) - 1)).alias("_n"), "value")
    out = more.unionByName(placed.select(*df.columns, "_n", line.alias("value")))
    return out.repartitionByRange(*([partitions] if partitions else []), "_n").sortWithinPartitions("_n").drop("_n")


def read_json_map(spark: SparkSession, path: str, value: DataType | str) -> DataFrame:
    """(key, value) of what json_map() wrote: each line is parsed by itself, by as many tasks as read the files."""
    kind = value if isinstance(value, str) else value.simpleString()
    body = spark.read.text(path).where(~F.col("value").isin("{", "}"))
    one = F.concat(F.lit("{"), F.regexp_replace("value", "^,", ""), F.lit("}"))
    return body.select(F.explode(F.from_json(one, f"map<string,{kind}>")).alias("key", "value"))


def asset_rows(tree: DataFrame, path: str, folders: DataFrame, base_url: str) -> DataFrame:
    """(path, name, country, kind, url) of image files; the first part of the path says country and kind."""
    image = F.col(path).rlike(r"(?i)\.(png|svg|jpe?g|webp)$")
    quoted = F.array_join(F.transform(F.split(path, "/"), lambda p: F.replace(F.url_encode(p), F.lit("+"), F.lit("%20"))), "/")
    t = tree.where(image).withColumn("folder", F.split(path, "/")[0]).join(folders, "folder", "left")
    return t.select(F.col(path).alias("path"), F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "").alias("name"), F.coalesce("country", F.lit("")).alias("country"), F.coalesce("kind", F.lit("channel")).alias("kind"), F.concat(F.lit(base_url + "/"), quoted).alias("url"))


def html_records(df: DataFrame, html: str, pattern: str, fields: list[str], keep: list[str]) -> DataFrame:
    """One row per match of a pattern in pages, a column for each of its groups; JavaScript escapes are undone first."""
    text = F.regexp_replace(F.regexp_replace(F.col(html), r'\\/', "/"), r'\\"', '"')
    groups = [F.regexp_extract_all(text, F.lit(pattern), F.lit(i + 1)).alias(f) for i, f in enumerate(fields)]
    return df.select(*keep, F.posexplode(F.arrays_zip(*groups)).alias("pos", "_m")).select(*keep, "pos", *(F.col(f"_m.{f}") for f in fields))


def unbase64_parts(chunks: Column) -> Column:
    """Text of an array of base64 chunks, padded or not, joined in their order."""
    whole = lambda x: F.rpad(x, (F.ceil(F.length(x) / 4) * 4).cast("int"), F.lit("="))
    return F.array_join(F.transform(chunks, lambda x: F.decode(F.unbase64(whole(x)), "UTF-8")), "")


# How pages of players hold their channel and the chunks of its address.
CHANNEL = r'var\s+_CH\s*=\s*"([0-9a-f]+)"'
CHUNKS = r"var\s+\w+\s*=\s*'([A-Za-z0-9+/=]+)'\s*;"
ADDRESS = r"""(https?://[^"'`\s]+?/playlist\.m3u8\?token=[A-Za-z0-9+/=]+|\?token=[A-Za-z0-9+/=]+)"""


def stream_address(html: Column, base: str) -> Column:
    """The address that a player's page holds in base64 chunks; a bare token gets base/channel before it; null if the
    page names no channel or holds no address."""
    channel = F.regexp_extract(html, CHANNEL, 1)
    found = F.regexp_extract(unbase64_parts(F.regexp_extract_all(html, F.lit(CHUNKS), F.lit(1))), ADDRESS, 1)
    whole = F.when(F.startswith(found, F.lit("?")), F.concat(F.lit(f"{base.rstrip('/')}/"), channel, F.lit("/playlist.m3u8"), found)).otherwise(found)
    return F.when((channel != "") & (found != ""), whole)


def adapt(records: DataFrame, keep: Column, template: str, values: dict[str, Column], countries: Column | None = None, allow: list[str] | None = None) -> DataFrame:
    """Records of an API that are kept and come from an allowed country, with url: the template, its {names} filled in."""
    out = records.where(F.coalesce(keep, F.lit(False)))
    if allow is not None:
        out = out.where(F.coalesce(F.upper(countries).isin([c.upper() for c in allow]), F.lit(False)))
    parts, at = [], 0
    for m in re.finditer(r"\{(\w+)\}", template):
        parts += [F.lit(template[at : m.start()]), F.coalesce(values[m[1]].cast("string"), F.lit(""))]
        at = m.end()
    return out.withColumn("url", F.concat(*parts, F.lit(template[at:])))


def blank_fill(df: DataFrame, detail: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Columns of df, blanks filled from a detail record of the same key."""
    d = detail.select(F.col(key).alias("_k"), *(F.col(c).alias(f"_{c}") for c in columns))
    j = df.join(d, F.col(key) == F.col("_k"), "left")
    return j.select(*(F.coalesce(F.nullif(F.col(c), F.lit("")), F.col(f"_{c}")).alias(c) if c in columns else F.col(c) for c in df.columns))
