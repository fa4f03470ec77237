"""Phrase collocations by direct-address tiling: pairs of frequency-ranked ids are counted in tiles of a square table.

Words of each language are ranked by frequency; ids from 0 on fall into classes, the first of TILE ids, each later one as
large as all before it, so a pair of ids falls into the tile of its two classes and has an address there. As frequent
ids are low, few tiles hold most pairs: a tile with enough pairs for its cells is counted with a dense bincount, any
other one as sorted coordinates. Frequent pairs are ranked again, and get ids of their own, which pair up with the next
word: phrases of one word more, in tiles of the same kind, up to the longest asked for. A phrase counts only where the
phrases without its first and without its last word are frequent too, as no other can be.

One pass over the documents cuts them into batches, with a row for each distinct word of a batch; batches get the ids of
their frequent words back, count their own pairs by tile (what precedes every shuffle), and get the ids of frequent ones
back. A tile is cut by its addresses into as many parts as keep each below `share` distinct ones, whatever the text: a
tile can't hold more than its cells, nor than occurrences of either class. Rows of a part that many batches sent are
merged in shares first, round by round. Nothing that grows with the corpus comes to the driver or is broadcast.

Pieces end at `[.,;:!?\\x0A-\\x0D]`, words at spaces and tabs; A-Z are lower-cased. Edge cases: a null or empty text has no
words; a null language is `und`, beside others of that name; a very long text is in one batch and met in one task; repeated
rows each count; equal scores and frequencies are ordered by the phrase's bytes; an empty table gives no rows; ids and
columns other than the text and its language, whatever their names, are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from confluo.llm.common import scratch, ship
from confluo.llm.lm import _restore, _squeeze, pack, total, unpack
from confluo.operators.order import number

LEAST, LONGEST, TOP, COVER = 10, 3, 2000, 50
#: Shares of a language's phrases whose first are found side by side.
TOP_SHARES = 32
#: Ids of the first class; cells of a tile that may be counted densely, and cells for each pair that then are too many;
#: distinct addresses of a part, and of rows that one task merges; bytes of text in a batch.
TILE, DENSE, SPARSE, SHARE, MERGE, BATCH_BYTES = 1024, 1 << 22, 16, 6_000_000, 24_000_000, 32_000_000
#: Ends a piece; no UTF-8 text holds this byte.
_END = b"\xff"
_TABLE = bytes(c + 32 if 65 <= c <= 90 else 32 if c == 9 else 255 if c in b".,;:!?\n\v\f\r" else c for c in range(256))
#: The tile of rows that hold a batch's ids and not pairs.
IDS = -1
_PART = "batch long, lang string, tile int, part int, n long, data binary"


def tokens(text: str) -> list[bytes]:
    """Words of a text, and _END where a piece ends."""
    return text.encode().translate(_TABLE).replace(_END, b" \xff ").split()


# -- tiles -----------------------------------------------------------------------------------------------------------
def class_of(x: np.ndarray) -> np.ndarray:
    """0 for the first TILE ids, then one more for each doubling."""
    return np.frexp((x // TILE).astype(float))[1].astype(np.int64)


def first_of(c):
    return np.where(c == 0, 0, TILE << np.maximum(c - 1, 0))


def width_of(c):
    return TILE << np.maximum(c - 1, 0)


def tiled(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tile of each pair, and its address there."""
    ci, cj = class_of(i), class_of(j)
    return ci * 64 + cj, (i - first_of(ci)) * width_of(cj) + j - first_of(cj)


def _tiled(i: np.ndarray, j: np.ndarray, step: int = 500_000) -> tuple[np.ndarray, np.ndarray]:
    """tiled() of many pairs, with few temporary arrays at once."""
    tile, address = np.empty(len(i), np.int16), np.empty(len(i), np.int64)
    for at in range(0, len(i), step):
        tile[at : at + step], address[at : at + step] = tiled(i[at : at + step], j[at : at + step])
    return tile, address


def untiled(tile: int, address: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ci, cj = np.array(tile // 64), np.array(tile % 64)
    return first_of(ci) + address // width_of(cj), first_of(cj) + address % width_of(cj)


def cells(tile: int) -> int:
    size = int(width_of(np.array(tile // 64))) * int(width_of(np.array(tile % 64)))
    if size > 1 << 63:
        raise OverflowError("ids too large for addresses of 64 bits")
    return size


def summed(tile: int, addresses: list[np.ndarray], counts: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct addresses of a tile in order, and how often each is there."""
    size = cells(tile)
    if size <= DENSE and sum(map(len, addresses)) * SPARSE >= size:
        dense = np.zeros(size, np.int64)
        for k, a in enumerate(addresses):
            dense += np.bincount(a, None if counts is None else counts[k], size).astype(np.int64)
        at = np.flatnonzero(dense)
        return at, dense[at]
    if counts is None:
        return np.unique(np.concatenate(addresses), return_counts=True)
    return total(addresses, counts)


def parts(tile: int, occ: tuple[np.ndarray, np.ndarray], share: int) -> int:
    """Into how many parts a tile is cut; occ: occurrences by class of first and second ids."""
    return max(1, -(-min(cells(tile), int(occ[0][tile // 64]), int(occ[1][tile % 64])) // share))


def part_of(address: np.ndarray, n: int) -> np.ndarray:
    return (address.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % n


def count_pairs(i: np.ndarray, j: np.ndarray, occ: tuple[np.ndarray, np.ndarray], share: int) -> Iterator[tuple[int, int, int, bytes]]:
    """Tile, part, number and packed counts of the distinct pairs of a batch."""
    tile, address = _tiled(i, j)
    order = np.argsort(tile, kind="stable")
    tile, address = tile[order], address[order]
    first = np.flatnonzero(np.r_[True, tile[1:] != tile[:-1]][: len(tile)])
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(tile)], strict=False):
        k = int(tile[a])
        u, n = summed(k, [address[a:b]])
        p = parts(k, occ, share)
        own = part_of(u, p)
        for x in np.unique(own).tolist():
            on = own == x
            yield k, x, int(on.sum()), pack(u[on], n[on])


# -- the job ---------------------------------------------------------------------------------------------------------
def _encoded(docs: DataFrame, batch_bytes: int) -> DataFrame:
    """Rows of batches: data, the places of a language's words in the batch's own list, or a word with its place and count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch, size, places, codes = TaskContext.get().partitionId() << 32, 0, {}, defaultdict(list)

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal batch, size
            batch += 1
            for lang, arrays in codes.items():
                c, ws = np.concatenate(arrays), list(places[lang])
                yield rows([batch], [lang], [_squeeze(c.tobytes())], [None], [None], [None])
                n = np.bincount(c, minlength=len(ws))
                for at in range(1, len(ws), 100_000):
                    w = [x.decode() for x in ws[at : at + 100_000]]
                    yield rows([batch] * len(w), [lang] * len(w), [None] * len(w), w, range(at, at + len(w)), n[at : at + 100_000])
            size = 0
            codes.clear()
            places.clear()

        def rows(*cols) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.string(), pa.binary(), pa.string(), pa.int32(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["batch", "lang", "data", "word", "place", "n"])

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if lang not in places:
                    places[lang] = own = defaultdict()
                    own.default_factory = own.__len__
                    own[_END]  # noqa: B018  place 0
                t = tokens(text)
                t.append(_END)
                codes[lang].append(np.fromiter(map(places[lang].__getitem__, t), np.int32, len(t)))
                size += len(text)
                if size >= batch_bytes:
                    yield from flush()
        yield from flush()

    return docs.mapInArrow(run, "batch long, lang string, data binary, word string, place int, n long")


def _ranked(df: DataFrame, ties: list[Column]) -> DataFrame:
    """df with id, from 0, by falling f within each language; written."""
    placed = number(df, [F.col("lang"), -F.col("f"), *ties], "_n")
    first = placed.groupBy("lang").agg(F.min("_n").alias("_first"))
    return scratch(placed.join(first, "lang").withColumn("id", F.col("_n") - F.col("_first")).drop("_n", "_first"))


def _shape(ranked: DataFrame, name: str) -> DataFrame:
    """Of each language the sum of f by class of ids."""
    c = F.when(F.col("id") < TILE, 0).otherwise(F.length(F.bin(F.expr(f"id div {TILE}")))).alias("c")
    by = ranked.groupBy("lang", c).agg(F.sum("f").alias("f")).groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("c", "f"))).alias("m"))
    return by.select("lang", F.transform(F.sequence(F.lit(0), F.array_max(F.map_keys("m"))), lambda k: F.coalesce(F.try_element_at("m", k), F.lit(0).cast("long"))).alias(name))


def _given(asks: DataFrame, known: DataFrame, keys: list[str], size: int, f, schema: str) -> DataFrame:
    """f over a part's rows of asks and of known; a part that many rows ask for is dealt to several tasks."""
    shares = asks.groupBy(*keys).agg(F.ceil(F.sum("n") / size).cast("int").alias("shares"))
    left = asks.join(shares, keys).withColumn("share", F.pmod(F.xxhash64("batch"), "shares").cast("int")).drop("shares")
    right = known.join(shares, keys).withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))).drop("shares")
    return left.groupBy(*keys, "share").cogroup(right.groupBy(*keys, "share")).applyInArrow(f, schema)


def _one(t: pa.Table, keys: list[str]) -> list:
    return [t.column(k)[0].as_py() for k in keys]


_KEYS = ["lang", "tile", "part"]


def _frequent(counts: DataFrame, least: int, merge: int) -> DataFrame:
    """lang, tile, part, i, j and f of pairs that occur so often; counts: rows of batches."""

    def add(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        u, n = zip(*map(unpack, t.column("data").to_pylist()), strict=True)
        return summed(t.column("tile")[0].as_py(), list(u), list(n))

    def merged(t: pa.Table) -> pa.Table:
        u, n = add(t)
        return pa.table([pa.array([x], k) for x, k in zip([t.column("batch")[0].as_py(), *_one(t, _KEYS), len(u), pack(u, n)], (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.binary()), strict=True)], ["batch", *_KEYS, "n", "data"])

    def often(t: pa.Table) -> pa.Table:
        lang, tile, part = _one(t, _KEYS)
        u, n = add(t)
        u, n = u[n >= least], n[n >= least]
        i, j = untiled(tile, u)
        return pa.table([pa.array([lang] * len(u), pa.string()), pa.array(np.full(len(u), tile, np.int32)), pa.array(np.full(len(u), part, np.int32)), *(pa.array(x, pa.int64()) for x in (i, j, n))], [*_KEYS, "i", "j", "f"])

    while True:
        shares = counts.groupBy(*_KEYS).agg(F.ceil(F.sum("n") / merge).cast("int").alias("shares"), F.count("*").alias("rows"))
        if (shares.agg(F.max(F.when(F.col("rows") > 1, F.col("shares")))).first()[0] or 0) <= 1:
            break
        dealt = counts.join(shares, _KEYS).withColumn("share", F.pmod(F.xxhash64("batch"), "shares").cast("int"))
        counts = scratch(dealt.select("batch", *_KEYS, "n", "data", "share").groupBy(*_KEYS, "share").applyInArrow(merged, _PART))
    return counts.groupBy(*_KEYS).applyInArrow(often, "lang string, tile int, part int, i long, j long, f long")


def _occ(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.array(t.column(c)[0].as_py() or [0], np.int64) for c in ("occ", "word_occ"))


def _held(batch: int, lang: str, rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    return pa.table([pa.array([batch] * len(rows), pa.int64()), pa.array([lang] * len(rows), pa.string()), *(pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int32(), pa.int32(), pa.int64(), pa.binary())))], ["batch", *_KEYS, "n", "data"])


def phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, longest: int = LONGEST, batch_bytes: int = BATCH_BYTES, share: int = SHARE, merge: int = MERGE) -> tuple[DataFrame, DataFrame]:
    """Phrases of 1 to `longest` words that occur at least so often, and what each language holds.

    The first: lang, size (in words), phrase (joined by spaces), f; the second: lang, n (words in all).
    """
    if merge < 4 * share:
        raise ValueError("merge must be four times share or more, so that each round of merging leaves fewer rows")
    ship(docs.sparkSession)
    src = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sent = scratch(_encoded(src, batch_bytes))
    words = sent.where("word IS NOT NULL").select("batch", "lang", "word", "place", "n")
    counted = scratch(words.groupBy("lang", "word").agg(F.sum("n").alias("f")))
    ranked = _ranked(counted.where(F.col("f") >= least), [F.col("word")])
    shape = _shape(ranked, "word_occ")

    def begin(t: pa.Table, ids: pa.Table) -> pa.Table:
        """Ids of the batch's words in place of its own numbers, -1 for rare ones and ends; pairs."""
        if not t.num_rows:
            return _held(0, "", [])
        batch, lang = _one(t, ["batch", "lang"])
        c = np.frombuffer(_restore(t.column("data")[0].as_py()), np.int32)
        of = np.full(int(c.max(initial=0)) + 1, -1, np.int64)
        of[ids.column("place").to_numpy()] = ids.column("id").to_numpy()
        w = of[c]
        on = np.flatnonzero((w[:-1] >= 0) & (w[1:] >= 0))
        occ = _occ(t)
        return _held(batch, lang, [(IDS, 0, len(w), _squeeze(w.tobytes())), *count_pairs(w[on], w[on + 1], occ, share)])

    found = words.join(ranked.select("lang", "word", "id"), ["lang", "word"]).select(F.col("batch").alias("batch"), F.col("lang").alias("lang"), "place", "id")  # columns of their own, unlike those of texts
    texts = sent.where("data IS NOT NULL").select("batch", "lang", "data").join(shape, "lang", "left").withColumn("occ", F.col("word_occ"))
    state = scratch(texts.groupBy("batch", "lang").cogroup(found.groupBy("batch", "lang")).applyInArrow(begin, _PART))
    out = [ranked.select("lang", F.lit(1).alias("size"), F.col("word").alias("phrase"), "f", "id")]
    for size in range(2, longest + 1):
        pairs = _frequent(state.where(F.col("tile") != IDS), least, merge)
        pairs = _ranked(pairs, [F.col("i"), F.col("j")])
        last = ranked.select("lang", F.col("word"), F.col("id").alias("j"))
        start = out[-1].select("lang", F.col("phrase").alias("start"), F.col("id").alias("i"))
        named = pairs.join(start, ["lang", "i"]).join(last, ["lang", "j"])
        out.append(scratch(named.select("lang", F.lit(size).alias("size"), F.concat_ws(" ", "start", "word").alias("phrase"), "f", "id")))
        if size < longest:
            state = _longer(state, pairs, _shape(pairs, "occ"), shape, size, size + 1 < longest, share, merge)
    return reduce(DataFrame.unionByName, (d.drop("id") for d in out)), counted.groupBy("lang").agg(F.sum("f").alias("n"))


def _longer(state: DataFrame, pairs: DataFrame, occ: DataFrame, word_occ: DataFrame, size: int, more: bool, share: int, merge: int) -> DataFrame:
    """The batches' rows for phrases of size + 1 words, from those for phrases of `size` words and the ids of the frequent;
    with ids for phrases longer than that if there are more to come."""

    def ids(t: pa.Table, known: pa.Table) -> pa.Table:
        if not t.num_rows or not known.num_rows:
            return _held(0, "", [])
        address = tiled(known.column("i").to_numpy(), known.column("j").to_numpy())[1]
        order = np.argsort(address)
        address, id_ = address[order], known.column("id").to_numpy()[order]
        out = []
        for data in t.column("data").to_pylist():
            u, _ = unpack(data)
            at = np.minimum(np.searchsorted(address, u), len(address) - 1)
            on = address[at] == u
            out.append(pack(u[on], id_[at[on]]))
        return pa.table([t.column("batch"), *(t.column(k) for k in _KEYS), t.column("n"), pa.array(out, pa.binary())], ["batch", *_KEYS, "n", "data"])

    def step(t: pa.Table, answers: pa.Table) -> pa.Table:
        if not t.num_rows:
            return _held(0, "", [])
        batch, lang = _one(t, ["batch", "lang"])
        held = np.frombuffer(_restore(t.column("data")[0].as_py()), np.int64)
        # start[p]: the id of the phrase of size - 1 words at p, of words themselves at first; its pair is the word after it
        start, w = (held, held) if size == 2 else held.reshape(2, -1)
        n = max(0, len(w) - size + 1)
        on = np.flatnonzero((start[:n] >= 0) & (w[size - 1 :] >= 0) & (start[1 : n + 1] >= 0 if size > 2 else True))
        tile, address = _tiled(start[on], w[on + size - 1])
        got, by = np.full(len(w), -1, np.int64), defaultdict(list)
        for k, data in zip(answers.column("tile").to_pylist(), answers.column("data").to_pylist(), strict=True):
            by[k].append(unpack(data))
        for k in np.unique(tile).tolist():
            if k in by:
                u, id_ = (np.concatenate(x) for x in zip(*by[k], strict=True))
                order = np.argsort(u)
                u, id_, mine = u[order], id_[order], np.flatnonzero(tile == k)
                if len(u):
                    at = np.minimum(np.searchsorted(u, address[mine]), len(u) - 1)
                    hit = u[at] == address[mine]
                    got[on[mine[hit]]] = id_[at[hit]]
        n = max(0, len(w) - size)
        on = np.flatnonzero((got[:n] >= 0) & (got[1 : n + 1] >= 0))
        ids = [(IDS, 0, len(w), _squeeze(got.tobytes() + w.tobytes()))] if more else []
        return _held(batch, lang, [*ids, *count_pairs(got[on], w[on + size], _occ(t), share)])

    asks = state.where(F.col("tile") != IDS)
    answers = _given(asks, pairs.select(*_KEYS, "i", "j", "id"), _KEYS, merge, ids, _PART)
    texts = state.where(F.col("tile") == IDS).select("batch", "lang", "data").join(word_occ, "lang", "left").join(occ, "lang", "left")
    given = answers.select("batch", "lang", "tile", "data")
    return scratch(texts.groupBy("batch", "lang").cogroup(given.groupBy("batch", "lang")).applyInArrow(step, _PART))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, longest: int = LONGEST, top: int = TOP, cover: int = COVER, **options) -> DataFrame:
    """Each language's best phrases of two or more words: lang, rank, phrase, a, l, r, n, score.

    A phrase's score is floor(1000000 * a * a / (l * r)) at the cut into a first part (l) and a rest (r) where it is least;
    phrases within a longer frequent one that has `cover` percent of their occurrences or more are left out.
    """
    found, totals = phrases(docs, text_col, lang_col, least, longest, **options)
    some = found.where("size > 1").withColumn("w", F.split("phrase", " "))
    cuts = some.select("lang", "phrase", F.col("f").alias("a"), "size", "w", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.expr("slice(w, 1, k)"), " ").alias("first"), F.array_join(F.expr("slice(w, k + 1, size)"), " ").alias("rest"))
    part = lambda name, to: found.select("lang", F.col("phrase").alias(name), F.col("f").alias(to))
    cuts = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"])
    # products are exact up to 38 digits, beyond which Spark raises an error; the quotient is a million at most
    wide = cuts.select("*", *(F.col(c).cast("decimal(38,0)").alias(f"_{c}") for c in "alr"))
    cuts = wide.withColumn("score", F.expr("1000000 * _a * _a div (_l * _r)"))
    best = cuts.groupBy("lang", "phrase").agg(F.min_by(F.struct("a", "l", "r", "score"), F.struct("score", "k")).alias("b")).select("lang", "phrase", "b.*")
    # phrases inside longer ones, and the most frequent of these
    inside = some.where("size > 2").select("lang", "f", "w", "size", F.explode(F.expr("sequence(2, size - 1)")).alias("m"))
    inside = inside.select("lang", "f", F.explode(F.expr("transform(sequence(1, size - m + 1), i -> array_join(slice(w, i, m), ' '))")).alias("phrase"))
    over = inside.groupBy("lang", "phrase").agg(F.max("f").alias("over"))
    kept = best.join(over, ["lang", "phrase"], "left").where(F.col("over").isNull() | (100 * F.col("over") < cover * F.col("a")))
    # the first of each share of a language's phrases, then the first of those: no task sees more than shares * top
    order = lambda *by: Window.partitionBy("lang", *by).orderBy(F.desc("score"), F.desc("a"), "phrase")
    some_of = kept.withColumn("_s", F.pmod(F.xxhash64("phrase"), F.lit(TOP_SHARES))).withColumn("_r", F.row_number().over(order("_s"))).where(F.col("_r") <= top)
    first = some_of.withColumn("rank", F.row_number().over(order())).where(F.col("rank") <= top)
    return first.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


#: The same rows by DuckDB.
SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)),
i AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p),
t AS (SELECT lang, w[i] AS x, w[i + 1] AS y, w[i + 2] AS z FROM i),
g1 AS (SELECT lang, x, count(*) AS f FROM t GROUP BY ALL),
g2 AS (SELECT lang, x, y, count(*) AS f FROM t WHERE y IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
g3 AS (SELECT lang, x, y, z, count(*) AS f FROM t WHERE z IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM g1 GROUP BY lang),
cut AS (SELECT g2.lang, g2.x || ' ' || g2.y AS phrase, 1 AS s, g2.f AS a, l.f AS l, r.f AS r FROM g2 JOIN g1 l ON l.lang = g2.lang AND l.x = g2.x JOIN g1 r ON r.lang = g2.lang AND r.x = g2.y
  UNION ALL SELECT g3.lang, g3.x || ' ' || g3.y || ' ' || g3.z, 1, g3.f, l.f, r.f FROM g3 JOIN g1 l ON l.lang = g3.lang AND l.x = g3.x JOIN g2 r ON r.lang = g3.lang AND r.x = g3.y AND r.y = g3.z
  UNION ALL SELECT g3.lang, g3.x || ' ' || g3.y || ' ' || g3.z, 2, g3.f, l.f, r.f FROM g3 JOIN g2 l ON l.lang = g3.lang AND l.x = g3.x AND l.y = g3.y JOIN g1 r ON r.lang = g3.lang AND r.x = g3.z),
scored AS (SELECT *, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM cut),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, s) AS turn FROM scored),
inside AS (SELECT lang, phrase, max(f) AS f FROM (SELECT lang, x || ' ' || y AS phrase, f FROM g3 UNION ALL SELECT lang, y || ' ' || z, f FROM g3) GROUP BY lang, phrase),
best AS (SELECT o.lang, o.phrase, a, l, r, score FROM lowest o LEFT JOIN inside ON inside.lang = o.lang AND inside.phrase = o.phrase WHERE turn = 1 AND (inside.f IS NULL OR 100 * inside.f < 50 * a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""
