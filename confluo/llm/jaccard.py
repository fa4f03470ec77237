"""Chosen-path join: all pairs of documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Documents with equal sets form one class, which is one row from then on, so thousands of copies cost one. Each class
has a sketch of minhashes, its sampled tokens. In every run, all classes start in one bucket, split on one token; below,
a bucket's path chooses each of CHOICES tokens with a chance such that a pair at the threshold shares one chosen token
on average, and its classes go on under every chosen one. Buckets of one are dropped, those of up to LEAF classes (or
that a split leaves mostly whole, which only groups of similar sets do) are compared by brute force, in blocks, so that
no bucket meets in one task. A pair is compared in the first of the leaves that both are in, by run; its sketch must allow the threshold (five standard
deviations below), and the shingles themselves then decide. Runs are repeated until the number of new links met once and
twice says (Chao's estimate) that the target recall of all pairs of classes is reached; if it never is, that is an error.

Words are cut at the six ASCII white-space characters; a text of one to four words is one shingle. Edge cases: null
and empty texts have no shingle and link with nothing; repeated rows and ids are documents of their own; an empty
table gives no rows; columns of the input other than id and text are ignored; of a very long text all shingles are
taken and met in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from confluo.llm.common import components, scratch, ship, sorted_groups, words

WORDS, THRESHOLD, TARGET_RECALL = 5, 0.8, 0.995
#: Runs of one round, tokens that runs start with in turn, and tokens that one level below the first may choose from (a
#: path knows its run, so later runs that start with the same token split in other ways). Bits of a path below its run, so
#: that paths of earlier runs come first.
RUNS, FIRST, CHOICES, LEVELS, PATH_BITS = 16, 32, 8, 8, 52
TOKENS = FIRST + CHOICES * LEVELS
#: Rounds without the target recall that are an error.
ERROR = 64
LEAF, BLOCK = 400, 1024
_SEEDS = np.random.default_rng(12345).integers(1, 1 << 63, (2, TOKENS), dtype=np.uint64)


class _Words(dict):
    """64-bit hashes of words; holds up to a bound, then starts anew."""

    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) > 150_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_words = _Words()


def shingles(text: str | None, k: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's windows of k words."""
    w = words(text)
    h = np.fromiter(map(_words.__getitem__, w), np.uint64, len(w))
    if not len(h):
        return h
    n = max(1, len(h) - k + 1)
    s = np.full(n, min(k, len(h)), np.uint64)
    for i in range(min(k, len(h))):
        s = s * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n]
        s ^= s >> np.uint64(29)
    s *= np.uint64(0xBF58476D1CE4E5B9)
    s ^= s >> np.uint64(32)
    return np.unique(s)


def sketch(s: np.ndarray) -> np.ndarray:
    """One 32-bit minhash for each token place."""
    out = np.full(TOKENS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(s), 2048):
        part = (s[at : at + 2048, None] * (_SEEDS[0] | np.uint64(1)) + _SEEDS[1]) >> np.uint64(32)
        np.minimum(out, part.min(0).astype(np.uint32), out=out)
    return out


def _sets(docs: DataFrame) -> DataFrame:
    """doc_id, t (hash of the text), h (hash of the set of shingles), n (its size) and sig, of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hs, ns, sigs = [], [], []
            for x in b.column(2).to_pylist():
                s = shingles(x)
                ns.append(len(s))
                hs.append(int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True) if len(s) else None)
                sigs.append(sketch(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(hs, pa.int64()), pa.array(ns, pa.int64()), pa.array(sigs, pa.binary())], ["doc_id", "t", "h", "n", "sig"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text").alias("t"), "text").mapInArrow(run, f"doc_id {kind}, t long, h long, n long, sig binary")


def _token(at) -> F.Column:
    """The minhash at a place of the sketch, as hex text."""
    return F.hex(F.substring(F.col("sig"), at * 4 + 1, F.lit(4)))


def _path(run: F.Column, *parts: F.Column) -> F.Column:
    """Hash of a path, never 0, that begins with its run."""
    return F.shiftleft((run + 1).cast("long"), PATH_BITS).bitwiseOR(F.xxhash64(*parts).bitwiseAND(F.lit((1 << PATH_BITS) - 1)))


def _leaves(reps: DataFrame, first_run: int, leaf: int, threshold: float) -> DataFrame:
    """(h, run, path, n): the leaf buckets of each class in each run, where it has company."""
    runs = F.explode(F.array(*(F.lit(r) for r in range(first_run, first_run + RUNS)))).alias("run")
    cur = reps.select("h", "sig", runs).select("h", "run", _path(F.col("run"), F.col("run"), _token(F.pmod(F.col("run"), F.lit(FIRST)))).alias("path"), F.lit(1 << 60).alias("parent_n"))
    chance = int(min(1.0, 1 / (threshold * CHOICES)) * 1000)
    found = None
    for level in range(1, LEVELS + 1):
        sizes = cur.groupBy("path").agg(F.count("*").alias("n")).where("n > 1")
        sized = scratch(cur.join(sizes, "path"))
        whole = (F.col("n") <= leaf) | (2 * F.col("n") > F.col("parent_n")) | F.lit(level == LEVELS)
        done = sized.where(whole).select("h", "run", "path", "n")
        found = done if found is None else found.unionAll(done)
        rest = sized.where(~whole)
        if rest.isEmpty():
            break
        places = F.sequence(F.lit(FIRST + CHOICES * (level - 1)), F.lit(FIRST + CHOICES * level - 1))
        chosen = F.explode(F.filter(places, lambda i: F.pmod(F.xxhash64(F.lit("token"), F.col("path"), i), F.lit(1000)) < chance)).alias("at")
        cur = rest.select("h", "run", "path", "n", chosen).join(reps.select("h", "sig"), "h").select("h", "run", _path(F.col("run"), F.col("path"), F.col("at"), _token(F.col("at"))).alias("path"), F.col("n").alias("parent_n"))
    return found


def _common(i: np.ndarray, js: np.ndarray) -> np.ndarray:
    """Which of the leaves in rows js are in i, too; 0 stands for none."""
    return np.isin(js, i[i != 0])


def _pairs(path: int, side: np.ndarray, sig: np.ndarray, met: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a leaf of which it is the first that both are in, and whose sketches allow the threshold."""
    n, out_i, out_j = len(side), [], []
    for i in range(n):
        js = np.flatnonzero(side == 2) if side[i] == 1 else np.arange(i + 1, n) if side[i] == 0 else ()
        if len(js):
            js = js[(sig[js] == sig[i]).sum(1) >= least]
            if len(js):
                js = js[np.where(_common(met[i], met[js]), met[js], np.iinfo(np.int64).max).min(1) == path]
                out_i.append(np.full(len(js), i))
                out_j.append(js)
    z = np.zeros(0, np.int64)
    return np.concatenate([*out_i, z]).astype(np.int64), np.concatenate([*out_j, z]).astype(np.int64)


def _arrays(t: pa.Table) -> tuple[np.ndarray, ...]:
    sig = np.frombuffer(b"".join(t.column("low").to_pylist()), np.uint8).reshape(-1, TOKENS)
    each = t.column("met").combine_chunks()
    n = np.diff(each.offsets.to_numpy())
    met = np.zeros((len(n), int(n.max(initial=1))), np.int64)
    met[np.arange(met.shape[1])[None, :] < n[:, None]] = each.flatten().to_numpy()
    return t.column("path").to_numpy(), t.column("side").to_numpy(), sig, met


def _times(i: np.ndarray, j: np.ndarray, met: np.ndarray) -> np.ndarray:
    """The number of runs in which each pair meets."""
    out = np.zeros(len(i), np.int64)
    for k, (a, b) in enumerate(zip(i, j, strict=True)):
        out[k] = len(set((met[b][_common(met[a], met[b])] >> PATH_BITS).tolist()))
    return out


def _shared(i: np.ndarray, j: np.ndarray, sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of pairs of sets."""
    if len(i) <= 4:
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i, j, strict=True)], np.int64)
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, inv, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = count > 1
    place = np.cumsum(keep) - 1
    use = keep[inv]
    width = -(-int(keep.sum()) // 64) * 64
    step = max(1, 64_000_000 // max(64, width))
    out = np.zeros(len(i), np.int64)
    bits = np.zeros((len(sets), width // 8), np.uint8)
    r, c = rows[use], place[inv[use]]
    np.bitwise_or.at(bits, (r, c >> 3), (1 << (c & 7)).astype(np.uint8))
    packed = bits.view(np.uint64)
    for at in range(0, len(i), step):
        out[at : at + step] = np.bitwise_count(packed[i[at : at + step]] & packed[j[at : at + step]]).sum(1)
    return out


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The root of each of n nodes under the given links."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return np.array([find(x) for x in range(n)])


def _compare(dealt: DataFrame, docs: DataFrame, reps: DataFrame, threshold: float) -> DataFrame:
    """(h, root, w, pairs, once, twice) for dealt classes with a link: w documents linked, links, those met in one and two runs."""
    least = max(1.0, (threshold - 5 * (threshold * (1 - threshold) / TOKENS) ** 0.5) * TOKENS)
    part = dealt.repartition("key").sortWithinPartitions("key")

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, cut in sorted_groups(batches, "key"):
            path, side, sig, met = _arrays(t)
            use = np.zeros(t.num_rows, bool)
            for a, b in zip(cut, [*cut[1:], t.num_rows], strict=True):
                i, j = _pairs(path[a], side[a:b], sig[a:b], met[a:b], least)
                use[a + i], use[a + j] = True, True
            yield from t.filter(pa.array(use)).to_batches()

    chosen = scratch(part.mapInArrow(candidates, part.schema))
    need = chosen.select("h").distinct().join(reps.select("h", "first.*"), "h")
    texts = docs.select("doc_id", F.xxhash64("text").alias("t"), "text")
    texts = texts.join(need.select(F.col("doc_id").alias("_d"), F.col("t").alias("_t"), "h"), (F.col("t") == F.col("_t")) & F.col("doc_id").eqNullSafe(F.col("_d"))).select("h", "text")

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shingles(x).tobytes() for x in b.column(1).to_pylist()], pa.binary())], ["h", "shingles"])

    sets = texts.dropDuplicates(["h"]).mapInArrow(sets_of, "h long, shingles binary")
    full = chosen.join(sets, "h").repartition("key").sortWithinPartitions("key")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, cut in sorted_groups(batches, "key"):
            path, side, sig, met = _arrays(t)
            h, copies = t.column("h").to_numpy(), t.column("copies").to_numpy()
            raw = t.column("shingles").to_pylist()
            root, w, pairs, once, twice = h.copy(), np.zeros(len(h), np.int64), np.zeros(len(h), np.int64), np.zeros(len(h), np.int64), np.zeros(len(h), np.int64)
            for a, b in zip(cut, [*cut[1:], t.num_rows], strict=True):
                i, j = _pairs(path[a], side[a:b], sig[a:b], met[a:b], least)
                if not len(i):
                    continue
                sets = [np.frombuffer(x, np.uint64) for x in raw[a:b]]
                size = np.array([len(s) for s in sets])
                both = _shared(i, j, sets)
                good = both >= threshold * (size[i] + size[j] - both) - 1e-9
                i, j = i[good], j[good]
                root[a:b] = h[a:b][_forest(b - a, i, j)]
                np.add.at(w, a + i, copies[a + j])
                np.add.at(w, a + j, copies[a + i])
                times = _times(i, j, met[a:b])
                np.add.at(pairs, a + i, 1)
                np.add.at(once, a + i, times == 1)
                np.add.at(twice, a + i, times == 2)
            on = w > 0
            yield pa.RecordBatch.from_arrays([pa.array(x[on]) for x in (h, root, w, pairs, once, twice)], ["h", "root", "w", "pairs", "once", "twice"])

    return full.mapInArrow(verify, "h long, root long, w long, pairs long, once long, twice long")


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, target: float = TARGET_RECALL, leaf: int = LEAF, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, t (xxhash64 of its text), class_id, n_links, n_copies, kept.

    class_id is the smallest id in the component of linked documents, n_links the number of other documents linked
    directly (copies included), n_copies of documents with the same set; kept marks documents with the class id as id.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sets = scratch(_sets(docs))
    reps = sets.where("h IS NOT NULL").groupBy("h").agg(F.count("*").alias("copies"), F.min(F.struct("doc_id", "t")).alias("first"), F.first("sig").alias("sig"))
    reps = scratch(reps)
    # the sketch's lowest byte of each token is enough to estimate similarity
    low = F.unhex(F.concat(*(F.hex(F.substring("sig", 4 * i + 1, 1)) for i in range(TOKENS))))
    leaves, found, total = None, None, 0
    for k in range(ERROR):
        new = _leaves(reps, k * RUNS, leaf, threshold)
        leaves = new if leaves is None else leaves.unionAll(new)
        by = leaves.groupBy("h").agg(F.collect_list(F.struct("run", "path", "n")).alias("at"))
        here = F.explode(F.filter("at", lambda e: e["run"] >= k * RUNS)).alias("e")
        rows = by.join(reps.select("h", "copies", "sig"), "h").select("h", "copies", low.alias("low"), F.col("at.path").alias("met"), here)
        rows = rows.select("h", "copies", "low", "met", "e.path", F.ceil(F.col("e.n") / block).cast("int").alias("nb"))
        mine = F.pmod(F.xxhash64(F.lit("block"), "h"), F.col("nb")).cast("int")
        rows = rows.withColumn("b", mine).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
        dealt = rows.select(
            F.when(F.col("nb") == 1, F.col("path")).otherwise(F.xxhash64("path", F.least("b", "o"), F.greatest("b", "o"))).alias("key"),
            F.when(F.col("b") == F.col("o"), 0).when(F.col("b") < F.col("o"), 1).otherwise(2).alias("side"),
            "path", "h", "copies", "low", "met",
        )
        links = scratch(_compare(dealt, docs, reps, threshold))
        found = links if found is None else found.unionAll(links)
        n, once, twice = links.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("pairs", "once", "twice"))).first()
        total += n
        missed = once * (once - 1) / (2 * (twice + 1))
        if missed <= (1 - target) * max(1, total):
            break
    else:
        raise RuntimeError("the target recall was not reached")
    linked = components(reps.select(F.col("h").alias("node")), found.where("h <> root").select(F.col("h").alias("a"), F.col("root").alias("b")))
    stats = reps.select("h", "copies", F.col("first.doc_id").alias("least")).join(linked.withColumnRenamed("node", "h"), "h").join(found.groupBy("h").agg(F.sum("w").alias("w")), "h", "left")
    ids = stats.groupBy("component").agg(F.min("least").alias("class_id"))
    stats = stats.join(ids, "component").select("h", "component", "class_id", "copies", (F.col("copies") - 1 + F.coalesce("w", F.lit(0))).alias("n_links"))
    out = sets.select("doc_id", "t", "h").join(stats, "h", "left")
    return out.select("doc_id", "t", F.coalesce(F.when(F.col("h").isNull(), F.col("doc_id")).otherwise(F.col("class_id")), F.col("doc_id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("copies", F.lit(1)).alias("n_copies"), F.coalesce("component", F.lit(0)).alias("component")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of docs, all columns as they are, with one document of each group of linked ones: that of least id."""
    result = scratch(join(docs, id_col, text_col, **options))
    linked = F.col("component") != 0
    best = result.where(linked).groupBy("component").agg(F.min(F.struct("doc_id", "t")).alias("x")).select("x.doc_id", "x.t")
    keep = best.unionAll(result.where(~linked).select("doc_id", "t").distinct()).select(F.col("doc_id").alias("_d"), F.col("t").alias("_t"))
    rows = docs.join(keep, (F.xxhash64(text_col) == F.col("_t")) & F.col(id_col).eqNullSafe(F.col("_d")), "left_semi")
    # rows that repeat id and text: one of them stays (empty texts link with nothing and all stay)
    if result.where(linked).groupBy("doc_id", "t").count().where("count > 1").isEmpty():
        return rows
    empty = ~F.coalesce(F.regexp_like(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]")), F.lit(False))
    return rows.where(~empty).dropDuplicates([id_col, text_col]).unionByName(rows.where(empty))
