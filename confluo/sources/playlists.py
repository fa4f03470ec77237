"""Extended-M3U text: scan, attributes, rejects, render."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from confluo.functions.names import trim_all
from confluo.operators import carry
from confluo.scratch import scratch

_LINE = r'^#EXTINF:((?:\\.|"(?:\\.|[^"\\])*+"|[^\\",])*+),(.*)$'
_ATTR = r'([A-Za-z0-9_-]+)="((?:\\.|[^"\\])*)"'


def read(spark: SparkSession, path: str) -> DataFrame:
    """(file, value): whole texts, one row a file."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, pos, line) of text files that many tasks read together, whatever their size; pos counts a file's lines from 0.

    Lines are written once with the byte range they came from and their place in it; a range's lines follow those of the
    ranges before it in its file.
    """
    place = F.monotonically_increasing_id()
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), place.alias("at"), F.col("value").alias("line"))
    raw = scratch(raw.withColumn("line", trim_all("line")))
    ranges = raw.groupBy("file", "start").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("start")) - F.col("n") - F.col("first")
    # one row for each byte range that a task reads
    return raw.join(F.broadcast(ranges.select("file", "start", before.alias("shift"))), ["file", "start"]).select("file", (F.col("at") + F.col("shift")).alias("pos"), "line")


def lines(texts: DataFrame) -> DataFrame:
    """(file, pos, line) of texts (file, value)."""
    return texts.select("file", F.posexplode(F.split("value", r"\r\n|\n|\r")).alias("pos", "line")).withColumn("line", trim_all("line"))


def scan(texts: DataFrame, block: int = carry.BLOCK) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(entries, headers, rejects) of texts (file, value)."""
    return scan_lines(lines(texts), block)


def scan_lines(ln: DataFrame, block: int = carry.BLOCK) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(entries, headers, rejects) of lines (file, pos, line).

    An #EXTINF line opens an entry, other # lines attach to the open entry or to the header, the next bare line is the
    address and closes it; an entry without address still counts; an address with no open entry is dropped. An #EXTINF
    line without a comma outside quotes becomes a reject. Which entry a line belongs to, and whether its address has
    come, is carried from block to block of a file's lines, so one huge file is scanned by many tasks. A file's loose
    comments are one value, its header.
    """
    opens, bare = F.startswith("line", F.lit("#EXTINF:")), ~F.startswith("line", F.lit("#"))
    ln = ln.where("line <> ''").select("file", "pos", "line", F.when(opens, "open").when(bare, "url").otherwise("note").alias("kind"), F.expr(f"pos div {block}").alias("_block"))
    entry_at, closes = F.when(F.col("kind") == "open", F.col("pos")), F.when(F.col("kind") != "note", F.col("kind"))
    ln = carry.running(ln, ["file"], "_block", "pos", {"grp": ("last", entry_at), "was": ("before", closes)})
    inside = (F.col("kind") == "open") | F.coalesce(F.col("was") == "open", F.lit(False))
    entry = ln.where(inside).groupBy("file", "grp").agg(
        F.min("pos").alias("pos"), F.max(F.when(F.col("kind") == "open", F.col("line"))).alias("raw"), F.coalesce(F.max(F.when(F.col("kind") == "url", F.col("line"))), F.lit("")).alias("url"),
        F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == "note", F.struct("pos", "line")))), lambda x: x["line"]).alias("directives"),
    )
    good = F.col("raw").rlike(f"(?s){_LINE}")
    meta = trim_all(F.regexp_extract("raw", f"(?s){_LINE}", 1))
    entries = entry.where(good).select(
        "file", (F.col("pos") + 1).alias("line_no"), F.coalesce(F.nullif(F.regexp_extract(meta, r"^(\S+)", 1), F.lit("")), F.lit("-1")).alias("duration"), attributes(meta).alias("attrs"), trim_all(F.regexp_extract("raw", f"(?s){_LINE}", 2)).alias("title"), "url", "directives"
    )
    loose = ln.where((F.col("kind") == "note") & ~inside)
    headers = loose.groupBy("file").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), "\n").alias("header"))
    return entries, headers, entry.where(~good).select("file", (F.col("pos") + 1).alias("line_no"), F.col("raw").alias("line"))


def attributes(meta: Column) -> Column:
    """Array of (k, v) of key="value" pairs; a key that repeats keeps its first place and its last value."""
    ks, vs = F.regexp_extract_all(meta, F.lit(_ATTR), F.lit(1)), F.regexp_extract_all(meta, F.lit(_ATTR), F.lit(2))
    values = F.transform(vs, lambda v: F.regexp_replace(v, r"\\(.)", "$1"))
    # the last value of a key is the first of the reversed list
    back_k, back_v = F.reverse(ks), F.reverse(values)
    return F.transform(F.array_distinct(ks), lambda k: F.struct(k.alias("k"), F.element_at(back_v, F.array_position(back_k, k).cast("int")).alias("v")))


def get(attrs: Column, key: str) -> Column:
    return F.coalesce(F.try_element_at(F.filter(attrs, lambda a: a["k"] == key), F.lit(1))["v"], F.lit(""))


def names_of(entries: DataFrame) -> DataFrame:
    """Add name (attribute, else title), group (Unknown by default), clean name and the distinct candidate names."""
    from confluo.functions.names import QUALITY_SUFFIX

    name = trim_all(F.coalesce(F.nullif(get(F.col("attrs"), "tvg-name"), F.lit("")), F.col("title")))
    out = entries.withColumn("name", name).withColumn("group", F.coalesce(F.nullif(trim_all(get(F.col("attrs"), "group-title")), F.lit("")), F.lit("Unknown")))
    out = out.withColumn("clean", trim_all(F.regexp_replace("name", f"(?i){QUALITY_SUFFIX}", "")))
    each = F.array("name", "title", "clean", get(F.col("attrs"), "tvg-id"))
    return out.withColumn("candidates", F.array_distinct(F.filter(F.transform(each, trim_all), lambda x: x != "")))


def render(attrs: Column, title: Column, url: Column, duration: Column | None = None, directives: Column | None = None) -> Column:
    """Text of one entry: its #EXTINF line with non-empty escaped attributes, directives, address."""
    escape = lambda v: F.translate(F.regexp_replace(v, r'(["\\])', r"\\$1"), "\r\n", "  ")
    parts = F.transform(F.filter(attrs, lambda a: a["v"] != ""), lambda a: F.concat(a["k"], F.lit('="'), escape(a["v"]), F.lit('"')))
    meta = F.array_join(F.concat(F.array(duration if duration is not None else F.lit("-1")), parts), " ")
    head = F.concat(F.lit("#EXTINF:"), meta, F.lit(","), title)
    return F.array_join(F.concat(F.array(head), directives if directives is not None else F.array().cast("array<string>"), F.array(url)), "\n")


def guide_header(header: Column, address: str) -> Column:
    """A header line whose guide address is the given one, added where it has none."""
    own = f'url-tvg="{address}"'
    return F.when(F.contains(header, F.lit("url-tvg=")), F.regexp_replace(header, 'url-tvg="[^"]*"', own.replace("\\", "\\\\").replace("$", "\\$"))).otherwise(F.concat(header, F.lit(f" {own}")))


def arrange(df: DataFrame, order: list[Column], text: Column, one_file: bool = False, header: str = "#EXTM3U") -> DataFrame:
    """df with value, the text of each row, in order over the partitions; the first row is the header, null but for its text.

    Written as they stand, the files, one after the other by name, are one playlist; only the first has the header.
    """
    keys = ["_h", *(f"_o{i}" for i in range(len(order)))]
    out = df.select("*", F.lit(1).alias("_h"), *(c.alias(k) for c, k in zip(order, keys[1:], strict=True)), text.alias("value"))
    first = df.sparkSession.range(1).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema), F.lit(0).alias("_h"), *(F.lit(None).cast(out.schema[k].dataType).alias(k) for k in keys[1:]), F.lit(header).alias("value"))
    out = first.unionByName(out)
    return (out.coalesce(1) if one_file else out.repartitionByRange(*keys)).sortWithinPartitions(*keys).drop(*keys)


def write(df: DataFrame, path: str, order: list[Column], text: Column, one_file: bool = False, header: str = "#EXTM3U") -> None:
    """Write the header and rendered entries in order to a new folder; publication.publish() replaces a playlist that is read."""
    arrange(df, order, text, one_file, header).select("value").write.text(path)
