"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from confluo.scratch import scratch

_shipped: set[str] = set()
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: White space that str.split() knows beyond the six ASCII characters.
_ODD = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def words(text: str | None) -> list[str]:
    """Runs of anything but the six ASCII white-space characters."""
    if not text:
        return []
    if not text.isascii():
        return _WORD.findall(text) if _ODD.search(text) else text.split()
    return _WORD.findall(text) if any(c in text for c in "\x1c\x1d\x1e\x1f") else text.split()


def ship(spark: SparkSession) -> None:
    """Give executors this package, as --py-files would; once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = os.path.join(tempfile.mkdtemp(), f"{os.path.basename(top)}_src.zip")
    with zipfile.ZipFile(out, "w") as z:
        for d, _, names in os.walk(top):
            for n in names:
                if n.endswith(".py"):
                    z.write(os.path.join(d, n), os.path.relpath(os.path.join(d, n), os.path.dirname(top)))
    sc.addPyFile(out)
    _shipped.add(sc.applicationId)


def fold(column: str | Column, parts: int) -> Column:
    """crc32 of a column's text, modulo parts: the split into learning and held-out rows."""
    c = F.col(column) if isinstance(column, str) else column
    return F.crc32(c.cast("string").cast("binary")) % parts


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sorted_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups from batches sorted by key, with the groups' first rows."""
    held = None
    for b in batches:
        t = pa.Table.from_batches([b])
        t = t if held is None else pa.concat_tables([held, t])
        k = t.column(key).to_numpy()
        cut = np.flatnonzero(k[1:] != k[:-1]) + 1
        if not len(cut):
            held = t
            continue
        held = t.slice(int(cut[-1]))
        yield t.slice(0, int(cut[-1])), np.concatenate([[0], cut[:-1]])
    if held is not None and held.num_rows:
        yield held, np.array([0])


def components(nodes: DataFrame, edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Connected components of edges (a, b): (node, component), component being the smallest node reachable.

    Each round hangs every tree's root under the smallest root seen across its edges and then halves all paths
    (pointer jumping), so rounds grow with the logarithm of the longest chain. State is cut in the shared folder.
    """
    edges = scratch(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct())
    for _ in range(most_rounds):
        # every vertex takes all its larger neighbours to its smallest neighbour, then the same for smaller ones
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b"), F.col("m")).where("b <> m").select(F.col("m").alias("a"), "b").distinct()
        low2 = large.groupBy("b").agg(F.min("a").alias("m"))
        small = (
            large.join(low2, "b")
            .select(F.explode(F.array(F.struct(F.col("m").alias("a"), F.col("b").alias("b")), F.struct(F.col("m").alias("a"), F.col("a").alias("b")))).alias("e"))
            .select("e.a", "e.b").where("a <> b").distinct()
        )
        new = scratch(small)
        stats = new.agg(F.count("*").alias("n"), F.countDistinct("b").alias("kids"), F.sum(F.xxhash64("a", "b") % 1000003).alias("h")).first()
        # a star forest: every child has one parent and no parent is a child
        done = stats.n == stats.kids and new.join(new.select(F.col("b").alias("a")), "a", "left_semi").isEmpty()
        edges = new
        if done:
            break
    else:
        raise RuntimeError("components did not settle")
    return nodes.join(edges.withColumnRenamed("b", "node").withColumnRenamed("a", "root"), "node", "left").select("node", F.coalesce("root", "node").alias("component"))
