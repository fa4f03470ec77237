"""Merkle manifest of a dataset: one hash tree for each source over its rows, one tree over the sources.

A leaf is the hash of a row's fields. Nodes carry nested-interval labels: the ranks [lo, hi) of the leaves that they
cover. A run of FAN neighbours, those whose interval starts in one bucket of FAN ** level ranks, becomes a node of the
next level. Proofs come from the labels alone: a node finds its parent by a join on the bucket of the parent's level
and on containment, the parent brings what its own ancestors gave it, and the siblings are those of its children that
cover the difference of the two intervals, left and right of the node. Each level has a third of the rows of the one
below it, no key holds more than FAN children, and ranks come from a range sort, so that a source with a third of all
rows is built by many tasks. All of it is native expressions; texts are read once, hashes alone are shuffled.

Edge cases: a null field is `-`; an empty text is `0:`; a very long text is hashed whole by one task; rows that repeat
an id stand in the order of their hashes, so equal rows may stand in any; null ids come first; a null source is a tree
of its own, which comes first; a source of one row has that leaf as its root; an empty table gives no rows; columns
other than the fields, the id and the source, whatever their names, are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from confluo.operators.order import number
from confluo.scratch import scratch

FAN = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: A tree's key: a source that may be null, as two columns that are not.
TREE = ("absent", "source")


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _bucket(side: str, level: int) -> Column:
    return F.expr(f"{side}lo div {FAN**level}L")


def grow(leaves: DataFrame) -> list[DataFrame]:
    """Tables of all levels' nodes, leaves first: absent, source, n (leaves of the tree), lo, hi, digest, and above the
    leaves kids, the node's children in order. leaves: the same columns but kids, others stay; written already."""
    levels, most = [leaves], leaves.agg(F.max("n")).first()[0] or 0
    while FAN ** (len(levels) - 1) < most:
        at = len(levels)
        runs = levels[-1].where(F.col("n") > FAN ** (at - 1)).groupBy(*TREE, "n", _bucket("", at).alias("bucket"))
        kids = runs.agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "digest"))).alias("kids"))
        levels.append(scratch(kids.select(*TREE, "n", F.col("kids")[0]["lo"].alias("lo"), F.element_at("kids", -1)["hi"].alias("hi"), digest(F.array_join("kids.digest", "")).alias("digest"), "kids")))
    return levels


def roots(levels: list[DataFrame]) -> DataFrame:
    """absent, source, n and digest of each tree's root."""
    whole = (df.where((F.col("lo") == 0) & (F.col("hi") == F.col("n"))) for df in levels)
    # a tree of n leaves ends at the first level at which one node covers all
    return reduce(DataFrame.unionByName, (df.select(*TREE, "n", "digest") for df in whole))


def prove(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """Leaves with steps, what stands left and right of the leaf's node on each level from the leaf's own to the root of all.

    above: for each tree absent, source, n, the steps of its root, and columns that all its leaves get.
    """
    extra = [c for c in above.columns if c not in (*TREE, "n", "steps")]
    none = F.lit(None).cast("array<struct<lo:bigint,hi:bigint,digest:string>>")
    at = None
    for level in range(len(levels) - 1, -1, -1):
        # a root has the tree's row as its parent, which has no other children
        ends = above.where((F.col("n") <= FAN**level) & (F.col("n") > FAN**level // FAN))
        parents = ends.select(*TREE, F.lit(0).cast("long").alias("lo"), F.col("n").alias("hi"), none.alias("kids"), "steps", *extra)
        parents = parents if at is None else parents.unionByName(at)
        c, p = levels[level].alias("c"), parents.alias("p")
        inside = (F.col("p.lo") <= F.col("c.lo")) & (F.col("c.hi") <= F.col("p.hi"))
        met = c.join(p, [*(F.col(f"c.{k}") == F.col(f"p.{k}") for k in TREE), _bucket("c.", level + 1) == _bucket("p.", level + 1), inside])
        left = F.array_join(F.transform(F.filter("p.kids", lambda k: k["hi"] <= F.col("c.lo")), lambda k: k["digest"]), "")
        right = F.array_join(F.transform(F.filter("p.kids", lambda k: k["lo"] >= F.col("c.hi")), lambda k: k["digest"]), "")
        steps = F.when(F.col("p.kids").isNull(), F.col("p.steps")).otherwise(F.concat(F.array(F.struct(left.alias("left"), right.alias("right"))), "p.steps"))
        own = [f"c.{x}" for x in levels[level].columns if x not in (("n", "digest") if level else ())]
        at = met.select(*own, steps.alias("steps"), *(F.col(f"p.{x}") for x in extra))
    return at


def fold(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its steps lead to."""
    return F.aggregate(steps, leaf, lambda acc, s: digest(s["left"], acc, s["right"]))


def _ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """rows with their rank in their tree as the interval [lo, hi), and n, the tree's rows; written."""
    placed = number(rows, [*map(F.col, TREE), *order], "_n")
    trees = placed.groupBy(*TREE).agg(F.min("_n").alias("_first"), F.count("*").alias("n"))
    lo = F.col("_n") - F.col("_first")
    return scratch(placed.join(trees, list(TREE)).withColumn("lo", lo).withColumn("hi", lo + 1).drop("_n", "_first"))


def manifest(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", fields=FIELDS, altered: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of docs: the id, leaf, subroot, root, proof_sha256, folded_root and verified.

    altered: Columns over docs that stand for some fields in a copy of the data; folded_root is the root that the
    copy's leaf leads to with the proof of the original, and verified whether that is the root.
    """
    value = lambda name, other: (other or {}).get(name, F.col(name))
    leaf, copy = (digest(*(field(value(f, a)) for f in fields)) for a in (None, altered))
    source = F.col(source_col).cast("string")
    rows = scratch(docs.select(F.col(id_col).alias("id"), source.isNull().alias("absent"), F.coalesce(source, F.lit("")).alias("source"), leaf.alias("digest"), copy.alias("copy")))
    trees = grow(_ranked(rows, [F.col("id"), F.col("digest")]))
    subroots = roots(trees).withColumnRenamed("n", "size")
    # one tree over the sources, null first
    of = subroots.select(F.lit(False).alias("absent"), F.lit("").alias("source"), F.struct((~F.col("absent")).alias("named"), F.col("source").alias("name")).alias("of"), "size", "digest")
    top = grow(_ranked(of, [F.col("of")]))
    last = roots(top).withColumnRenamed("digest", "root").withColumn("steps", F.array().cast("array<struct<left:string,right:string>>"))
    above = prove(top, last).select((~F.col("of.named")).alias("absent"), F.col("of.name").alias("source"), F.col("size").alias("n"), "steps", F.col("digest").alias("subroot"), "root")
    proved = prove(trees, scratch(above))
    siblings = F.array_join(F.transform("steps", lambda s: F.concat(s["left"], s["right"])), "")
    out = proved.select(F.col("id").alias(id_col), F.col("digest").alias("leaf"), "subroot", "root", digest(siblings).alias("proof_sha256"), fold(F.col("copy"), F.col("steps")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def line_ends_lost(docs: DataFrame) -> DataFrame:
    """The manifest of documents, and of a copy in which rows with an even crc32 of their id lost the line ends of their text."""
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return manifest(docs, altered={"text": F.when(even, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))})


_CRC = "list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)), lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda d, i: CASE WHEN d & 1 = 1 THEN xor(d >> 1, 3988292384) ELSE d >> 1 END))"
_HASH = "sha256(" + " || ".join(f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in FIELDS[:-1]) + " || coalesce(strlen({t}) || ':' || {t}, '-'))"
_UP = "list_transform(range(0, (len(d) + 2) // 3), lambda i: sha256(array_to_string(d[3 * i + 1 : 3 * i + 3], '')))"
_SIDES = "array_to_string(d[a // 3 * 3 + 1 : a], '') AS l, array_to_string(d[a + 2 : a // 3 * 3 + 3], '') AS r"
#: The same rows by DuckDB: each tree's levels as lists, walked up leaf by leaf.
SQL = f"""
WITH RECURSIVE h AS (SELECT doc_id, source, {_HASH.format(t="text")} AS leaf,
  CASE WHEN {_CRC} & 1 = 1 THEN {_HASH.format(t="replace(text, chr(10), '')")} ELSE {_HASH.format(t="text")} END AS copy FROM documents),
t AS (SELECT source, list(leaf ORDER BY doc_id NULLS FIRST, leaf) AS d FROM h GROUP BY source),
ranked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS k FROM h),
up AS (SELECT source, 0 AS level, d FROM t UNION ALL SELECT source, level + 1, {_UP} FROM up WHERE len(d) > 1),
sub AS (SELECT source, d[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS k FROM up WHERE len(d) = 1),
tops AS (SELECT 0 AS level, (SELECT list(subroot ORDER BY k) FROM sub) AS d UNION ALL SELECT level + 1, {_UP} FROM tops WHERE len(d) > 1),
low AS (SELECT doc_id, copy, leaf, source, k, level, l, r FROM (
  SELECT x.doc_id, x.copy, x.leaf, x.source, x.k, level, x.k // power(3, level)::BIGINT AS a, {_SIDES}
  FROM ranked x JOIN up ON x.source IS NOT DISTINCT FROM up.source WHERE len(d) > 1)),
high AS (SELECT source, level, k // power(3, level)::BIGINT AS a, {_SIDES} FROM sub, tops WHERE len(d) > 1),
ls AS (SELECT source, k, list(struct_pack(l := l, r := r) ORDER BY level) AS s FROM low GROUP BY source, k),
hs AS (SELECT source, list(struct_pack(l := l, r := r) ORDER BY level) AS s FROM high GROUP BY source),
p AS (SELECT x.doc_id, x.leaf, x.copy, sub.subroot, list_concat(coalesce(ls.s, []), coalesce(hs.s, [])) AS s
  FROM ranked x JOIN sub ON x.source IS NOT DISTINCT FROM sub.source LEFT JOIN ls ON x.source IS NOT DISTINCT FROM ls.source AND x.k = ls.k
  LEFT JOIN hs ON x.source IS NOT DISTINCT FROM hs.source),
f AS (SELECT doc_id, leaf, subroot, s, 0 AS i, copy AS c FROM p UNION ALL SELECT doc_id, leaf, subroot, s, i + 1, sha256(s[i + 1].l || c || s[i + 1].r) FROM f WHERE i < len(s))
SELECT doc_id, leaf, subroot, (SELECT d[1] FROM tops WHERE len(d) = 1) AS root,
  sha256(array_to_string(list_transform(s, lambda e: e.l || e.r), '')) AS proof_sha256, c AS folded_root,
  c = (SELECT d[1] FROM tops WHERE len(d) = 1) AS verified
FROM f WHERE i = len(s)
"""
