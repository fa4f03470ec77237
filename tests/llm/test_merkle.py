"""Merkle manifest: a tree built one run at a time in Python, its SQL, proofs that fail where the data changed."""

import hashlib
import zlib

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from confluo.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = (row[0], row[3], row[2], row[4], text)
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """Root and, for each node, the (left, right) siblings on its way up."""
    steps, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        for x, k in enumerate(at):
            run = level[k // 3 * 3 : k // 3 * 3 + 3]
            steps[x].append(("".join(run[: k % 3]), "".join(run[k % 3 + 1 :])))
        level, at = [h(*level[i : i + 3]) for i in range(0, len(level), 3)], [k // 3 for k in at]
    return level[0], steps


def plain(rows):
    by = {}
    for r in rows:
        by.setdefault(r[3], []).append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    done = {}
    for s in sources:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        done[s] = tree([leaf(r, r[1]) for r in by[s]])
    root, tops = tree([done[s][0] for s in sources])
    out = []
    for s, top in zip(sources, tops, strict=True):
        for r, own in zip(by[s], done[s][1], strict=True):
            even = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            c = leaf(r, r[1].replace("\n", "") if even and r[1] is not None else r[1])
            steps = own + top
            for left, right in steps:
                c = h(left, c, right)
            out.append((r[0], leaf(r, r[1]), done[s][0], root, h(*(x for p in steps for x in p)), c, c == root))
    return sorted(map(str, out))


def rows(sizes):
    texts = [None, "", "a\nb", "plain", "é\n\nß", "x" * 50_000, "\n"]
    out, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            out.append((i * 7 % 1009, texts[i % 7], None if i % 5 == 0 else "en", source, None if i % 4 == 0 else i, "clash"))
            i += 1
    return out


def test_manifest(spark):
    for sizes in ({None: 4, "": 1, "b": 3, "é": 9, "z": 10, "hot": 95, "two": 2} | {f"s{i}": 1 + i % 3 for i in range(21)}, {"only": 1}):
        data = rows(sizes)
        data += data[:2]  # rows that repeat
        data.append((None, "no\nid", "de", "b", 3, "clash"))
        df = spark.createDataFrame(data, SCHEMA).repartition(5)
        got = sorted(str(tuple(r)) for r in merkle.line_ends_lost(df).collect())
        assert got == plain(data)
    assert merkle.line_ends_lost(spark.createDataFrame([], SCHEMA)).count() == 0


def test_sql(spark):
    data = [r for r in rows({None: 5, "a": 31, "b": 1}) if r[0] is not None]
    documents = pd.DataFrame([(*r[:4], r[4]) for r in data], columns=["doc_id", "text", "lang", "source", "n_chars"]).astype({"n_chars": "Int64"})  # noqa: F841  read by DuckDB
    got = sorted(str(tuple(r)) for r in merkle.line_ends_lost(spark.createDataFrame(data, SCHEMA)).collect())
    assert got == sorted(map(str, duckdb.sql(merkle.SQL).fetchall())) == plain(data)


def test_labels_nest_and_any_change_shows(spark):
    df = spark.createDataFrame(rows({"hot": 50, "b": 5}), SCHEMA)
    ranked = merkle._ranked(df.select(F.lit(False).alias("absent"), "source", "doc_id", merkle.digest(F.col("doc_id").cast("string")).alias("digest")), [F.col("doc_id")])
    levels = merkle.grow(ranked)
    for up in levels[1:]:
        for r in up.collect():
            assert r.kids[0].lo == r.lo and r.kids[-1].hi == r.hi and all(a.hi == b.lo for a, b in zip(r.kids, r.kids[1:], strict=False)) and len(r.kids) <= 3
    assert {(r.source, r.n) for r in merkle.roots(levels).collect()} == {("hot", 50), ("b", 5)}
    # any field, not only texts
    got = merkle.manifest(df, altered={"n_chars": F.when(F.col("doc_id") == 14, F.lit(-1)).otherwise(F.col("n_chars"))})
    assert {r.doc_id for r in got.where("NOT verified").collect()} == {14}
