"""Embedding near-duplicates by NN-descent.

Equal vectors form one class, which is one row from then on. Each class has a list of its K nearest neighbours so far,
first those of its bucket in random-projection trees (as many as a pair at the threshold needs to meet with the target
recall, so more on larger tables); rounds of neighbours-of-neighbours joins (lists and reversed lists meet at a node,
whose members are compared with each other) refine the lists until few change. A list whose K entries all reach the
threshold is saturated. Saturated classes search again, among themselves, for the K nearest outside the components that
links form so far, until no list is saturated (a link of two classes can be missing from both lists only where both are
saturated). All pairs of a component are then compared in blocks, so that no link within one is missed.

An audit compares drawn vectors with all others by brute force and is the judge of recall: the mean over drawn vectors
with links, for each order of magnitude of their number of links, so that large groups cannot hide small ones. It draws
until LINKED vectors with links are seen; where AUDIT_MOST draws hold fewer, two independent descents must agree. Below
the target the descent starts again with more trees and longer lists, and at last all pairs are compared. Links that
the audit finds are added. Cosines that decide are taken in double precision.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing; vectors of
different lengths are never compared; repeated rows and ids count each; an empty table gives no rows; columns other
than id and vector are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from confluo.llm.common import components, scratch, ship, sorted_groups

THRESHOLD, TARGET_RECALL = 0.9, 0.97
#: Neighbours of a list, trees, classes of a tree's bucket, rounds of joins, share of changes that ends them.
K, TREES, BUCKET, ROUNDS, CHANGES = 8, 8, 64, 4, 0.02
#: Classes compared at once within a component; in single precision, cosines this far below the threshold are looked at.
BLOCK, MARGIN = 1024, 1e-4
#: Vectors drawn first and at most for the audit, and drawn vectors with links that it needs.
AUDIT, AUDIT_MOST, LINKED = 256, 16384, 64


def _classes(df: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, DataFrame]:
    """(vec_id, node) of all rows, node null where nothing can link; and (node, d, copies, least, v, q) of classes."""
    v = F.col(vec_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fine = v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0)
    rows = df.select(F.col(id_col).alias("vec_id"), F.when(fine, v).alias("v")).withColumn("node", F.when(F.col("v").isNotNull(), F.xxhash64("v")))
    one = rows.where("node IS NOT NULL").groupBy("node").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"), F.first("v").alias("v"))

    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            full, short, d = [], [], []
            for x in b.column(3):
                a = x.values.to_numpy(zero_copy_only=False).astype(np.float64)
                a = a / np.abs(a).max()
                a /= np.sqrt(a @ a)
                full.append(a.tobytes())
                short.append(a.astype(np.float32).tobytes())
                d.append(len(a))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(3)), pa.array(d, pa.int32()), pa.array(full, pa.binary()), pa.array(short, pa.binary())], ["node", "copies", "least", "d", "v", "q"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.select("vec_id", "node"), scratch(one.mapInArrow(unit, f"node long, copies long, least {kind}, d int, v binary, q binary"))


def _matrix(column: pa.ChunkedArray, kind=np.float32) -> np.ndarray:
    raw = column.to_pylist()
    return np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1)


def _buckets(classes: DataFrame, n: int, trees: int, bucket: int, seed: int) -> DataFrame:
    """(key, node, comp, q): the bucket of each class in each tree; large buckets are dealt out by a hash, other in each tree."""
    bits = max(0, int(np.ceil(np.log2(max(1, n) / bucket))))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for b in batches:
            d = b.column("d").to_numpy()
            for size in np.unique(d):
                t = b.filter(pa.array(d == size))
                if size not in planes:
                    planes[size] = np.random.default_rng([seed, int(size)]).normal(size=(int(size), trees * bits)).astype(np.float32)
                on = (_matrix(t.column("q")) @ planes[size] > 0).reshape(t.num_rows, trees, bits)
                code = (on * (1 << np.arange(bits, dtype=np.int64))).sum(2) if bits else np.zeros((t.num_rows, trees), np.int64)
                for k in range(trees):
                    yield pa.RecordBatch.from_arrays([pa.array((code[:, k] * 4096 + k) * 65536 + int(size)), t.column("node"), t.column("comp"), t.column("q")], ["path", "node", "comp", "q"])

    cur = classes.select("node", "comp", "d", "q").mapInArrow(split, "path long, node long, comp long, q binary")
    sizes = cur.groupBy("path").agg(F.count("*").alias("n")).where("n > 1").withColumn("parts", F.ceil(F.col("n") / (4 * bucket)))
    return cur.join(sizes, "path").select(F.xxhash64("path", F.pmod(F.xxhash64(F.lit(seed), "path", "node"), F.col("parts"))).alias("key"), "node", "comp", "q")


def _meet(members: DataFrame, k: int) -> DataFrame:
    """(a, b, sim) of members (key, node, comp, q, kth) of two components that meet under a key, where it improves on a's list (kth)."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, cut in sorted_groups(batches, "key"):
            node, comp, kth, raw = t.column("node").to_numpy(), t.column("comp").to_numpy(), t.column("kth").to_numpy(), t.column("q").to_pylist()
            out = ([], [], [])
            for lo, hi in zip(cut, [*cut[1:], t.num_rows], strict=True):
                if hi - lo < 2:
                    continue
                x = np.frombuffer(b"".join(raw[lo:hi]), np.float32).reshape(hi - lo, -1)
                s = x @ x.T
                s[comp[lo:hi, None] == comp[None, lo:hi]] = -2
                if hi - lo > k + 1:
                    least = np.maximum(np.partition(s, -k, axis=1)[:, -k], kth[lo:hi])
                else:
                    least = kth[lo:hi]
                i, j = np.nonzero((s >= least[:, None]) & (s > -2))
                out[0].append(node[lo + i])
                out[1].append(node[lo + j])
                out[2].append(s[i, j].astype(np.float64))
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["a", "b", "sim"])

    return members.repartition("key").sortWithinPartitions("key").mapInArrow(compare, "a long, b long, sim double")


def _best(edges: DataFrame, k: int) -> DataFrame:
    """The k most similar distinct neighbours of each class: (a, b, sim, place)."""
    w = Window.partitionBy("a").orderBy(F.desc("sim"), "b")
    return edges.where("a <> b").groupBy("a", "b").agg(F.max("sim").alias("sim")).withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def descend(classes: DataFrame, n: int, k: int, trees: int, bucket: int, rounds: int, seed: int) -> DataFrame:
    """The graph (a, b, sim, place) of the nearest neighbours outside a class's component, comp."""
    start = _buckets(classes, n, trees, bucket, seed).withColumn("kth", F.lit(-2.0))
    graph = scratch(_best(_meet(start, k), k))
    for _ in range(rounds):
        # reversed lists are drawn down to k by a hash
        back = graph.select(F.col("b").alias("key"), F.col("a").alias("node"))
        back = back.withColumn("r", F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64("node", "key")))).where(F.col("r") <= k).drop("r")
        own = graph.select("a").distinct()
        around = graph.select(F.col("a").alias("key"), F.col("b").alias("node")).unionAll(back).unionAll(own.select(F.col("a").alias("key"), F.col("a").alias("node"))).distinct()
        kth = graph.groupBy("a").agg(F.when(F.count("*") >= k, F.min("sim")).otherwise(-2.0).alias("kth")).withColumnRenamed("a", "node")
        members = around.join(classes.select("node", "comp", "q"), "node").join(kth, "node", "left").select("key", "node", "comp", "q", F.coalesce("kth", F.lit(-2.0)).alias("kth"))
        new = scratch(_best(graph.select("a", "b", "sim").unionAll(_meet(members, k)), k))
        changed = new.join(graph.select("a", "b"), ["a", "b"], "left_anti").count()
        total = new.count()
        graph = new
        if changed <= CHANGES * max(1, total):
            break
    return graph


def _exact(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Those (a, b) whose cosine in double precision reaches the threshold."""
    both = pairs.join(classes.select(F.col("node").alias("a"), F.col("v").alias("va")), "a").join(classes.select(F.col("node").alias("b"), F.col("v").alias("vb")), "b")

    def sure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = [float(np.frombuffer(x, np.float64) @ np.frombuffer(y, np.float64)) for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
            good = pa.array(np.array(s, float) >= threshold)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(good), b.column(1).filter(good)], ["a", "b"])

    return both.select("a", "b", "va", "vb").mapInArrow(sure, "a long, b long")


def _found(classes: DataFrame, n: int, threshold: float, k: int, trees: int, bucket: int, rounds: int, seed: int) -> tuple[DataFrame, DataFrame | None]:
    """(a, b) links that one descent finds, and further ones among saturated classes until no list is saturated; and the
    components of all these links (node, component), where they are known."""
    some, links = classes.withColumn("comp", F.col("node")), None
    while True:
        graph = descend(some, n, k, trees, bucket, rounds, seed)
        # single precision proposes with a margin; double precision decides
        near = graph.where(F.col("sim") >= threshold - MARGIN).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        new = scratch(_exact(near, classes, threshold))
        links = new if links is None else links.unionAll(new)
        full = scratch(graph.groupBy("a").agg(F.count("*").alias("n"), F.min("sim").alias("least")).where((F.col("n") >= k) & (F.col("least") >= threshold - MARGIN)).select(F.col("a").alias("node")))
        n = full.count()
        if not n:
            return links, None
        comp = components(classes.select("node"), links).withColumnRenamed("component", "comp")
        some = scratch(classes.join(full, "node").join(comp, "node"))
        if some.select("comp").distinct().limit(2).count() < 2:
            return links, comp.withColumnRenamed("comp", "component")
        if new.isEmpty():  # lists are full of cosines just below the threshold
            k *= 2
        seed += 1000


def _audit(classes: DataFrame, threshold: float, first: int, last: int) -> DataFrame:
    """(a, b) linked pairs of drawn classes, a, number `first` to `last` by a hash, with all classes, by brute force."""
    drawn = classes.orderBy(F.xxhash64(F.lit(5), "node"), "node").limit(last).select("node", "v").collect()[first:]
    by: list[tuple] = []
    for size in {len(r.v) for r in drawn}:
        own = [r for r in drawn if len(r.v) == size]
        for at in range(0, len(own), 1024):
            part = own[at : at + 1024]
            by.append((size, np.array([r.node for r in part], np.int64), np.frombuffer(b"".join(bytes(r.v) for r in part), np.float64).reshape(len(part), -1)))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            node, raw = b.column("node").to_numpy(), b.column("v").to_pylist()
            for size, a, x in by:
                at = np.array([i for i, r in enumerate(raw) if len(r) == size], np.int64)
                for lo in range(0, len(at), 2048):
                    own = at[lo : lo + 2048]
                    s = np.frombuffer(b"".join(raw[i] for i in own), np.float64).reshape(len(own), -1) @ x.T
                    i, j = np.nonzero((s >= threshold) & (node[own][:, None] != a[None, :]))
                    yield pa.RecordBatch.from_arrays([pa.array(a[j]), pa.array(node[own][i])], ["a", "b"])

    return classes.select("node", "v").mapInArrow(look, "a long, b long")


def _truth(classes: DataFrame, n: int, threshold: float) -> tuple[DataFrame, bool]:
    """Links of drawn classes, and whether enough of these have links, or all classes are drawn."""
    first, last, seen = 0, AUDIT, None
    while True:
        new = scratch(_audit(classes, threshold, first, last))
        seen = new if seen is None else seen.unionAll(new)
        enough = last >= n or seen.select("a").distinct().count() >= LINKED
        if enough or last >= AUDIT_MOST or not last:
            return seen, enough
        first, last = last, min(2 * last, AUDIT_MOST)


def _sides(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Pairs (a, b) with the components ca and cb of both."""
    side = lambda c: members.select(F.col("node").alias(c), F.col("component").alias(f"c{c}"))
    return pairs.join(side("a"), "a").join(side("b"), "b")


def _reached(truth: DataFrame, members: DataFrame, target: float) -> bool:
    """Whether drawn classes have the target share of their links within their component (where all pairs are compared),
    on average over those with 1, with 2 to 3, with 4 to 7 links, and so on."""
    each = _sides(truth, members).groupBy("a").agg(F.count("*").alias("n"), F.avg((F.col("ca") == F.col("cb")).cast("double")).alias("recall"))
    return each.groupBy(F.floor(F.log2("n"))).agg(F.avg("recall").alias("r")).where(F.col("r") < target).isEmpty()


def _across(classes: DataFrame, members: DataFrame, threshold: float, block: int) -> DataFrame:
    """(a, b) links between components by comparing all classes, in blocks; one link for two components that meet in a block."""
    sizes = classes.groupBy("d").agg(F.ceil(F.count("*") / block).cast("int").alias("nb"))
    rows = classes.select("node", "d", "v").join(sizes, "d").join(members, "node").withColumn("b", F.pmod(F.xxhash64(F.lit("all"), "node"), F.col("nb")).cast("int")).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    rows = rows.select(F.xxhash64("d", F.least("b", "o"), F.greatest("b", "o")).alias("key"), F.when(F.col("b") <= F.col("o"), 1).otherwise(2).alias("side"), F.col("b") == F.col("o"), "node", "component", "v").toDF("key", "side", "one", "node", "component", "v")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, cut in sorted_groups(batches, "key"):
            node, comp, side, one, raw = t.column("node").to_numpy(), t.column("component").to_numpy(), t.column("side").to_numpy(), t.column("one").to_numpy(), t.column("v").to_pylist()
            for lo, hi in zip(cut, [*cut[1:], t.num_rows], strict=True):
                x, h, c = np.frombuffer(b"".join(raw[lo:hi]), np.float64).reshape(hi - lo, -1), node[lo:hi], comp[lo:hi]
                right = 0 if one[lo] else int((side[lo:hi] == 1).sum())
                for at in range(0, right or hi - lo, 512):
                    to = min(at + 512, right or hi - lo)
                    i, j = np.nonzero((x[at:to] @ x[right:].T >= threshold) & (c[at:to, None] != c[None, right:]))
                    pairs = np.stack([c[at + i], c[right + j]])
                    _, pick = np.unique(pairs, axis=1, return_index=True)
                    yield pa.RecordBatch.from_arrays([pa.array(h[at + i[pick]]), pa.array(h[right + j[pick]])], ["a", "b"])

    return rows.repartition("key").sortWithinPartitions("key", "side").mapInArrow(compare, "a long, b long")


def _enlarge(members: DataFrame, classes: DataFrame, threshold: float, block: int) -> DataFrame:
    """(node, w): documents linked to each class of components with company; all pairs of a component, in blocks."""
    sizes = members.groupBy("component").agg(F.ceil(F.count("*") / block).cast("int").alias("nb"), F.count("*").alias("n")).where("n > 1")
    rows = members.join(sizes, "component").withColumn("b", F.pmod(F.xxhash64(F.lit("block"), "node"), F.col("nb")).cast("int")).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    rows = rows.select("node", F.xxhash64("component", F.least("b", "o"), F.greatest("b", "o")).alias("key"), F.when(F.col("b") == F.col("o"), 0).when(F.col("b") < F.col("o"), 1).otherwise(2).alias("side"))
    full = rows.join(classes.select("node", "copies", "v"), "node").repartition("key").sortWithinPartitions("key", "side")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, cut in sorted_groups(batches, "key"):
            node, side, copies, raw = t.column("node").to_numpy(), t.column("side").to_numpy(), t.column("copies").to_numpy(), t.column("v").to_pylist()
            w = np.zeros(t.num_rows, np.int64)
            for lo, hi in zip(cut, [*cut[1:], t.num_rows], strict=True):
                x = np.frombuffer(b"".join(raw[lo:hi]), np.float64).reshape(hi - lo, -1)
                c, s = copies[lo:hi], side[lo:hi]
                if s[0] == 0:
                    on = x @ x.T >= threshold
                    np.fill_diagonal(on, False)
                    w[lo:hi] = on @ c
                else:
                    m = int((s == 1).sum())
                    on = x[:m] @ x[m:].T >= threshold
                    w[lo : lo + m], w[lo + m : hi] = on @ c[m:], c[:m] @ on
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(w)], ["node", "w"])

    return full.mapInArrow(count, "node long, w long").groupBy("node").agg(F.sum("w").alias("w"))


def _trees(n: int, bucket: int, threshold: float, target: float) -> int:
    """Trees in which two vectors at the threshold share a bucket at least once, with the target as probability."""
    bits = max(0.0, np.ceil(np.log2(max(1, n) / bucket)))
    once = (1 - np.arccos(np.clip(threshold, -1, 1)) / np.pi) ** bits
    return TREES if once >= target else int(min(2048, max(TREES, np.ceil(np.log(1 - target) / np.log(1 - once)))))


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = THRESHOLD, k: int = K, trees: int | None = None, bucket: int = BUCKET, rounds: int = ROUNDS, target: float = TARGET_RECALL, block: int = BLOCK, tries: int = 3) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id (least id of its component), kept (it has that id)."""
    ship(df.sparkSession)
    rows, classes = _classes(df, id_col, vec_col)
    rows = scratch(rows)
    n = classes.count()
    trees = trees or _trees(n, bucket, threshold, target)
    truth, enough = _truth(classes, n, threshold)
    links, members, good = None, None, False
    for attempt in range(tries):
        new, comp = _found(classes, n, threshold, k << attempt, trees << attempt, bucket, rounds, attempt)
        if not enough and members is not None:
            # too few links for the audit: this descent's links are the sample by which the earlier ones are judged
            total, known = _sides(new, members).agg(F.count("*"), F.coalesce(F.sum((F.col("ca") == F.col("cb")).cast("long")), F.lit(0))).first()
            good = known >= target * total
        comp = comp if links is None else None
        links = new if links is None else links.unionAll(new)
        members = scratch(components(classes.select("node"), links) if comp is None else comp)
        reached = _reached(truth, members, target)
        good = reached and (enough or good)
        if good:
            break
    links = links.unionAll(truth)
    # links that the audit found inside components change none of them
    if not _sides(truth, members).where("ca <> cb").isEmpty():
        members = scratch(components(classes.select("node"), links))
    if not good:
        members = scratch(components(classes.select("node"), links.unionAll(_across(classes, members, threshold, 4 * block))))
    weights = _enlarge(members, classes, threshold, block)
    stats = classes.select("node", "copies", "least").join(members, "node").join(weights, "node", "left")
    least = stats.groupBy("component").agg(F.min("least").alias("component_id"))
    stats = stats.join(least, "component").select("node", (F.col("copies") - 1 + F.coalesce("w", F.lit(0))).alias("n_links"), "component_id")
    out = rows.join(stats, "node", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce(F.when(F.col("node").isNotNull(), F.col("component_id")), F.col("vec_id")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
