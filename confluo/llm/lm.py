"""Language-model scoring: context-tree weighting over bytes, beside a unigram baseline over words.

The text's bytes and one end byte 0 are predicted from the `depth` bytes before them (3 to 6; 0 before the start). Each byte is
eight binary decisions; every decision node has a context tree over the preceding bytes, whose nodes hold
Krichevsky-Trofimov estimates and are weighted over all depths (Willems, Shtarkov and Tjalkens 1995). The trees are
learned from all training texts and then frozen; a text's score is the log10 probability it gets.

Everything that grows with the corpus stays in tables. One pass over the documents cuts them into batches of about
`batch_bytes` and writes, for each batch, its texts, and its distinct words and (context, byte) grams with counts: one
compressed row for each of `parts` groups of words by their hash, and of as many groups of grams by their three nearest
context bytes, so that even the commonest pair of bytes is dealt to SPLIT groups. A group's rows are summed (in shares of
at most about `share` entries, then together), its trees are weighted down to depth 3, what lies above is added up over
groups: depth 2 as a table, of which a group gets its own pairs' nodes (65,536 * 255 nodes at most, over all groups), and
depth 1 and 0 (at most 257 * 255 nodes) on the driver. Each batch gets its words and grams back with their sums or values;
then batches score their texts. So memory grows with the distinct words or grams of a group, for which `parts` is to be
chosen (512 do for some 100 GB), not with the rows that ask for them.

Edge cases: a null text is an empty one: its only word token is the end, its only byte the end byte; a very long text is
a batch of its own. Without training texts all counts are 0 and grams get the weighted estimates of empty nodes (1/256 a
byte). Repeated rows each count. An empty table gives no rows. Other columns of docs, whatever their names, are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from confluo.llm import common
from confluo.llm.common import fold, scratch, ship

#: Bytes of context, unless a caller asks for others.
DEPTH = 3
#: Bytes of text in a batch, and of those whose grams are cut at once; groups of grams, and of words; entries that one
#: task sums or answers.
BATCH_BYTES, SLICE_BYTES, PARTS, SHARE = 32_000_000, 1_000_000, 512, 20_000_000
#: Groups that grams which share their two nearest bytes are dealt to, by their third.
SPLIT = 16
#: Stands for the end token; no word holds a space.
END = " "


def words(text: str) -> list[str]:
    """Words of a text, A-Z in lower case (bytes.lower() changes nothing else)."""
    return common.words(text.encode().lower().decode())


def grams(texts: list[str], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Codes of (depth bytes before, byte) for all positions of all texts, and the positions of each text.

    A code is, from its highest byte, the nearest byte of context, the next nearest and so on, and the byte itself: in
    the order of codes, all that share their nearest bytes stand together.
    """
    raw = [t.encode() for t in texts]
    sizes = np.fromiter((len(r) + 1 for r in raw), np.int64, len(raw))
    data = np.frombuffer(b"".join(bytes(depth) + r + b"\0" for r in raw), np.uint8)
    codes = data[depth:].astype(np.int64)
    for k in range(1, depth + 1):
        codes |= data[depth - k : len(data) - k].astype(np.int64) << 8 * (depth - k + 1)
    keep = np.ones(len(codes), bool)
    ends = np.cumsum(sizes + depth)[:-1]
    for k in range(1, depth + 1):  # windows that would reach from one text into the next
        keep[ends - k] = False
    return codes[keep], sizes


def total(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order, and the sums of their counts."""
    c, n = np.concatenate([*codes, np.zeros(0, np.int64)]), np.concatenate([*counts, np.zeros(0, np.int64)])
    order = np.argsort(c, kind="stable")
    c = c[order]
    first = np.flatnonzero(np.r_[True, c[1:] != c[:-1]][: len(c)])
    return c[first], np.add.reduceat(n[order], first) if len(c) else n


def merged(codes: list[np.ndarray], counts: list[np.ndarray], pieces: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """total() of arrays that are each in order, by ranges of codes one after the other, so that few temporary arrays are held."""
    longest = max(codes, key=len, default=np.zeros(0, np.int64))
    if len(longest) < 100_000:
        return total(codes, counts)
    cuts = [np.r_[0, np.searchsorted(c, longest[np.arange(1, pieces) * len(longest) // pieces]), len(c)] for c in codes]
    out = [total([c[k[i] : k[i + 1]] for c, k in zip(codes, cuts, strict=True)], [n[k[i] : k[i + 1]] for n, k in zip(counts, cuts, strict=True)]) for i in range(pieces)]
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _squeeze(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.Codec("zstd").compress(data, asbytes=True)


def _restore(data: bytes) -> bytes:
    return pa.Codec("zstd").decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)


def pack(codes: np.ndarray, values: np.ndarray) -> bytes:
    """Codes in order and a value of eight bytes for each, as compressed byte planes."""
    return _squeeze(b"".join(x.view(np.uint8).reshape(-1, 8).T.tobytes() for x in (np.diff(codes, prepend=0), values)))


def unpack(data: bytes, kind: type = np.int64) -> tuple[np.ndarray, np.ndarray]:
    """What pack() got, values being of the given kind."""
    steps, values = (np.ascontiguousarray(p.T).reshape(-1) for p in np.frombuffer(_restore(data), np.uint8).reshape(2, 8, -1))
    return np.cumsum(steps.view(np.int64)), values.view(kind)


def short(values: np.ndarray) -> np.ndarray:
    """Values rounded to 36 binary digits, an error of 1e-11 of each, so that they pack better."""
    return ((np.ascontiguousarray(values).view(np.int64) + 0x8000) & ~0xFFFF).view(np.float64)


def pack_words(ws: list[str], counts: list[int]) -> bytes:
    """Words, none of which holds a line's end, and their counts."""
    return _squeeze(np.array(counts, np.int64).tobytes() + "\n".join(ws).encode())


def unpack_words(data: bytes, n: int) -> tuple[list[str], list[int]]:
    raw = _restore(data)
    return raw[8 * n :].decode().split("\n"), np.frombuffer(raw, np.int64, n).tolist()


# -- context-tree weighting ------------------------------------------------------------------------------------------
def _lgamma_half(n: np.ndarray) -> np.ndarray:
    """log gamma(n + 1/2) for counts n, by Stirling's series after a shift by 8."""
    x = n + 0.5
    shift = np.zeros_like(x)
    for k in range(8):
        shift += np.log(x + k)
    x = x + 8
    return (x - 0.5) * np.log(x) - x + 0.9189385332046727 + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5) - shift


def _lgamma_int(n: np.ndarray) -> np.ndarray:
    """log gamma(n + 1)."""
    x = n + 9.0
    shift = np.zeros_like(x)
    for k in range(1, 9):
        shift += np.log(n + k)
    return (x - 0.5) * np.log(x) - x + 0.9189385332046727 + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5) - shift


_SMALL = np.arange(4096.0)
_HALF, _INT = _lgamma_half(_SMALL), _lgamma_int(_SMALL)


def _look(small: np.ndarray, f, n: np.ndarray) -> np.ndarray:
    """f of counts, most of which are small."""
    out = small[np.minimum(n, len(small) - 1).astype(np.int64)]
    big = n >= len(small)
    if big.any():
        out[big] = f(n[big])
    return out


def kt_block(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a block with these counts."""
    n0, n1 = n0.astype(float), n1.astype(float)
    return _look(_HALF, _lgamma_half, n0) + _look(_HALF, _lgamma_half, n1) - _look(_INT, _lgamma_int, n0 + n1) - np.log(np.pi)


def kt_next(n0: np.ndarray, n1: np.ndarray, bit: np.ndarray) -> np.ndarray:
    return (np.where(bit == 1, n1, n0) + 0.5) / (n0 + n1 + 1.0)


def weigh(kt: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted log probability of an inner node, and the share of that weight that stays at the node."""
    w = np.logaddexp(kt, below) - np.log(2)
    return w, np.exp(kt - np.log(2) - w)


def _bits(codes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Decision node (1 to 255) and bit of decision k of each code's last byte."""
    byte = codes & 255
    return (1 << k) | (byte >> (8 - k)), (byte >> (7 - k)) & 1


class Trees:
    """Trees over grams (in order, with counts) of which all that share their three nearest bytes are here.

    levels: of each depth from the deepest to 3, the distinct (context, byte), their counts, and the place in this level
    of each gram one level deeper. As a decision's node follows the byte's order, the grams of a node stand together.
    """

    def __init__(self, codes: np.ndarray, n: np.ndarray, depth: int):
        self.levels = [(codes, n.astype(float), np.arange(len(codes)))]
        for _ in range(depth - 1, 2, -1):
            c, n, _ = self.levels[-1]
            short = c >> 16 << 8 | c & 255
            u, inv = np.unique(short, return_inverse=True)
            self.levels.append((u, np.bincount(inv, n, len(u)), inv))

    def nodes(self, k: int) -> Iterator[tuple[np.ndarray, ...]]:
        """Of decision k, level by level: each gram's node, the nodes' keys, both counts, weights and shares that stay."""
        place = w = first = None
        for c, n, inv in self.levels:
            node, bit = _bits(c, k)
            key = c >> 8 << 8 | node
            new = np.r_[True, key[1:] != key[:-1]][: len(c)]
            ones = np.where(bit == 1, n, 0)
            was, first = first, np.flatnonzero(new)
            n1 = np.add.reduceat(ones, first) if len(c) else ones
            n0 = np.add.reduceat(n, first) - n1 if len(c) else n
            place = np.cumsum(new) - 1
            kt = kt_block(n0, n1)
            if w is None:
                w, stay = kt, np.ones(len(kt))
            else:  # the nodes below, by the node of their first gram
                w, stay = weigh(kt, np.bincount(place[inv[was]], w, len(kt)))
            yield place, key[first], n0, n1, w, stay

    def up(self) -> pa.Table:
        """Sums over the nodes of depth 3, by the two nearest bytes and decision node."""
        out = []
        for k in range(8):
            *_, (_, key, n0, n1, w, _) = self.nodes(k)
            u, inv = np.unique(key >> 16 << 8 | key & 255, return_inverse=True)
            out.append([u >> 8, u & 255, *(np.bincount(inv, x, len(u)) for x in (n0, n1, w))])
        return pa.table([np.concatenate(c) for c in zip(*out, strict=True)], ["pair", "node", "n0", "n1", "w"])

    def values(self, top: dict[str, np.ndarray], two: dict[str, np.ndarray], depth: int) -> np.ndarray:
        """log10 of the frozen tree's probability of each gram's byte after its context."""
        codes = self.levels[0][0]
        c1, pair, out = codes >> 8 * depth & 255, codes >> 8 * (depth - 1) << 8, np.zeros(len(codes))
        for k in range(8):
            node, bit = _bits(codes, k)
            p, at = 0.0, slice(None)
            for (place, _, n0, n1, _, stay), (_, _, inv) in zip(self.nodes(k), self.levels, strict=True):
                at = inv[at]
                x = place[at]
                p = stay[x] * kt_next(n0[x], n1[x], bit) + (1 - stay[x]) * p
            n0, n1, stay = look_up_two(two, pair | node)
            p = stay * kt_next(n0, n1, bit) + (1 - stay) * p
            p = top["stay1"][c1, node] * kt_next(top["n0"][c1, node], top["n1"][c1, node], bit) + (1 - top["stay1"][c1, node]) * p
            out += np.log10(top["stay0"][node] * kt_next(top["r0"][node], top["r1"][node], bit) + (1 - top["stay0"][node]) * p)
        return out


def pairs(t: pa.Table) -> pa.Table:
    """Nodes of depth 2 from sums over depth 3: pair, node, n0, n1, w and stay."""
    n0, n1, below = (t.column(c).to_numpy() for c in ("n0", "n1", "w"))
    w, stay = weigh(kt_block(n0, n1), below)
    return pa.table([t.column("pair"), t.column("node"), t.column("n0"), t.column("n1"), pa.array(w), pa.array(stay)], ["pair", "node", "n0", "n1", "w", "stay"])


def in_order(t: pa.Table) -> dict[str, np.ndarray]:
    """Nodes of depth 2 by their key."""
    key = t.column("pair").to_numpy() << 8 | t.column("node").to_numpy()
    order = np.argsort(key)
    return {"key": key[order]} | {c: t.column(c).to_numpy()[order] for c in ("n0", "n1", "stay")}


def look_up_two(two: dict[str, np.ndarray], key: np.ndarray) -> tuple[np.ndarray, ...]:
    """Counts and shares that stay of nodes of depth 2; those that training never saw are empty and keep one half."""
    if not len(two["key"]):
        return 0.0 * key, 0.0 * key, 0.5 + 0.0 * key
    at = np.minimum(np.searchsorted(two["key"], key), len(two["key"]) - 1)
    on = two["key"][at] == key
    return np.where(on, two["n0"][at], 0.0), np.where(on, two["n1"][at], 0.0), np.where(on, two["stay"][at], 0.5)


def shallow(c1: np.ndarray, node: np.ndarray, n0: np.ndarray, n1: np.ndarray, w: np.ndarray) -> dict[str, np.ndarray]:
    """Dense nodes of depth 1 (by nearest byte and decision) and depth 0, from sums over depth 2."""
    a = {k: np.zeros((256, 256)) for k in ("n0", "n1", "below")}
    for k, x in (("n0", n0), ("n1", n1), ("below", w)):
        np.add.at(a[k], (c1, node), x)
    w1, stay1 = weigh(kt_block(a["n0"], a["n1"]), a["below"])
    r0, r1, below0 = a["n0"].sum(0), a["n1"].sum(0), w1.sum(0)
    _, stay0 = weigh(kt_block(r0, r1), below0)
    return {"n0": a["n0"], "n1": a["n1"], "stay1": stay1, "r0": r0, "r1": r1, "stay0": stay0}


# -- the job ---------------------------------------------------------------------------------------------------------
def slices(texts: pa.ChunkedArray | pa.Array) -> Iterator[list[str]]:
    """Texts in order, in runs of about SLICE_BYTES."""
    held, size = [], 0
    for at in range(0, len(texts), 64):
        for t in texts.slice(at, 64).to_pylist():
            held.append(t)
            size += len(t)
            if size >= SLICE_BYTES:
                yield held
                held, size = [], 0
    if held:
        yield held


_SENT = "batch string, part int, n long, data binary"
_FIELDS = pa.schema([("batch", pa.string()), ("part", pa.int32()), ("n", pa.int64()), ("data", pa.binary())])
#: Stands for the texts of a batch in place of a group; groups of grams come from 0 on, then those of words.
TEXT = -1


def _rows(batch: str, part: list[int], n: list[int], data: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([batch] * len(part)), pa.array(part, pa.int32()), pa.array(n, pa.int64()), pa.array(data, pa.binary())], schema=_FIELDS)


def part_of(codes: np.ndarray, depth: int, parts: int) -> np.ndarray:
    """Group of each code, by its three nearest bytes; the two nearest alone say which run of `split_of` groups it is in."""
    split = split_of(parts)
    return (codes >> 8 * (depth - 1)) * 40503 % 65537 % (parts // split) * split + (codes >> 8 * (depth - 2) & 255) * 167 % 257 % split


def split_of(parts: int) -> int:
    return min(SPLIT, parts)


def run_of(pair: Column, parts: int) -> Column:
    """The run of groups that grams with these two nearest bytes are in."""
    return pair * 40503 % 65537 % (parts // split_of(parts))


def gather(t: pa.Table, depth: int, parts: int) -> Iterator[pa.RecordBatch]:
    """A batch's texts, grams and words as rows."""
    batch = uuid.uuid4().hex
    with pa.BufferOutputStream() as out:
        with pa.ipc.new_stream(out, t.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
            w.write_table(t)
        yield _rows(batch, [TEXT], [t.num_rows], [out.getvalue().to_pybytes()])
    learn, other, codes, counts = Counter(), set(), [], []
    train = t.column("train").to_numpy()
    for on in (True, False):
        for texts in slices(t.column("text").filter(pa.array(train == on))):
            if on:
                learn.update(w for x in texts for w in words(x))
            else:
                other.update(w for x in texts for w in words(x))
            u, n = np.unique(grams(texts, depth)[0], return_counts=True)
            codes.append(u)
            counts.append(n if on else 0 * n)
            if len(codes) >= 6:
                codes, counts = ([x] for x in merged(codes, counts))
    u, n = merged(codes, counts)
    del codes, counts
    part = np.empty(len(u), np.int32)
    for at in range(0, len(u), 500_000):  # few temporary arrays at once
        part[at : at + 500_000] = part_of(u[at : at + 500_000], depth, parts)
    order = np.argsort(part, kind="stable")
    u = u[order]
    n = n[order]
    part = part[order]
    del order
    first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    yield _rows(batch, part[first].tolist(), np.diff(first, append=len(u)).tolist(), [pack(u[a:b], n[a:b]) for a, b in zip(first, [*first[1:], len(u)], strict=True)])
    del u, n, part
    learn[END] += int(train.sum())
    groups: list[list[str]] = [[] for _ in range(parts)]
    for ws in (learn, other - learn.keys()):
        for w in ws:
            groups[zlib.crc32(w.encode()) % parts].append(w)
    full = [(k, g) for k, g in enumerate(groups) if g]
    yield _rows(batch, [parts + k for k, _ in full], [len(g) for _, g in full], [pack_words(g, [learn.get(w, 0) for w in g]) for _, g in full])


def batched(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """Record batches (doc_id, text, train) as tables of about so many bytes of text; a row is never cut."""
    held, size = [], 0
    for b in batches:
        at = 0
        ends = np.cumsum(pc.binary_length(b.column(1)).to_numpy(zero_copy_only=False).astype(np.int64))
        while at < b.num_rows:
            before = ends[at - 1] if at else 0
            stop = min(b.num_rows, int(np.searchsorted(ends, before + most - size)) + 1)
            held.append(b.slice(at, stop - at))
            size += int(ends[stop - 1] - before)
            at = stop
            if size >= most:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def score(docs: DataFrame, train, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = BATCH_BYTES, depth: int = DEPTH, parts: int = PARTS, share: int = SHARE) -> DataFrame:
    """One row per document; train: a boolean Column over docs that says which texts the model learns from.

    doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes and bits_per_byte.
    """
    if not 3 <= depth <= 6:  # a code is at most seven bytes of a long
        raise ValueError("depth must be 3 to 6")
    ship(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.coalesce(train, F.lit(False)).alias("train"))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batched(batches, batch_bytes):
            yield from gather(t, depth, parts)

    sent = scratch(src.mapInArrow(send, _SENT))
    # a group that many batches ask is dealt to several tasks; one row a group says to how many
    asked = sent.where(F.col("part") != TEXT)
    dealt = asked.groupBy("part").agg(F.ceil(F.sum("n") / share).cast("int").alias("shares"))
    asked = asked.join(F.broadcast(dealt), "part").withColumn("share", F.pmod(F.xxhash64("batch"), "shares").cast("int"))

    def add(t: pa.Table) -> pa.Table:
        part, rows = t.column("part")[0].as_py(), list(zip(t.column("data").to_pylist(), t.column("n").to_pylist(), strict=True))
        if part < parts:
            u, n = merged(*map(list, zip(*(unpack(d) for d, _ in rows), strict=True)))
            return pa.table({"part": pa.array([part], pa.int32()), "n": [len(u)], "tokens": [0], "known": [0], "data": [pack(u, n)]})
        c: dict[str, int] = {}
        for d, n in rows:
            for w, k in zip(*unpack_words(d, n), strict=True):
                c[w] = c.get(w, 0) + k
        return pa.table({"part": pa.array([part], pa.int32()), "n": [len(c)], "tokens": [sum(c.values())], "known": [sum(k > 0 for k in c.values())], "data": [pack_words(list(c), list(c.values()))]})

    added = "part int, n long, tokens long, known long, data binary"
    some = asked.select("part", "share", "n", "data").groupBy("part", "share").applyInArrow(add, added)
    sums = scratch(some.select("part", "n", "data").groupBy("part").applyInArrow(add, added))
    tokens, distinct = map(int, sums.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("known"), F.lit(0))).first())

    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for d in b.column(0).to_pylist():
                u, c = unpack(d)
                if (c > 0).any():
                    yield from Trees(u[c > 0], c[c > 0], depth).up().to_batches()

    nodes = "pair long, node long, n0 double, n1 double, w double"
    three = sums.where(F.col("part") < parts).select("data").mapInArrow(up, nodes).groupBy("pair", "node").agg(*(F.sum(c).alias(c) for c in ("n0", "n1", "w")))
    two = scratch(three.mapInArrow(lambda batches: (x for b in batches for x in pairs(pa.Table.from_batches([b])).to_batches()), nodes + ", stay double"))
    rows = two.groupBy(F.shiftright("pair", 8).alias("c1"), "node").agg(*(F.sum(c).alias(c) for c in ("n0", "n1", "w"))).toArrow()
    top = shallow(*(rows.column(c).to_numpy() for c in ("c1", "node", "n0", "n1", "w")))

    def bundle(t: pa.Table) -> pa.Table:
        """The nodes of depth 2 that a run of groups needs, as one value."""
        with pa.BufferOutputStream() as out:
            with pa.ipc.new_stream(out, t.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                w.write_table(t)
            return pa.table({"run": [t.column("run")[0].as_py()], "two": pa.array([out.getvalue().to_pybytes()], pa.binary())})

    runs = two.select(run_of(F.col("pair"), parts).alias("run"), "pair", "node", "n0", "n1", "stay").groupBy("run").applyInArrow(bundle, "run long, two binary")
    none = {c: np.zeros(0, np.int64 if c == "key" else float) for c in ("key", "n0", "n1", "stay")}

    def answer(t: pa.Table, s: pa.Table) -> pa.Table:
        if not t.num_rows or not s.num_rows:
            return _FIELDS.empty_table()
        data, n = next((d, n) for d, n in zip(s.column("data").to_pylist(), s.column("n").to_pylist(), strict=True) if d)
        ask, m = t.column("data").to_pylist(), t.column("n").to_pylist()
        if t.column("part")[0].as_py() < parts:
            u, c = unpack(data)
            held = next((x for x in s.column("two").to_pylist() if x), None)
            near = in_order(pa.ipc.open_stream(held).read_all()) if held else none
            values = short(Trees(u, c, depth).values(top, near, depth))
            out = [pack(c, values[np.searchsorted(u, c)]) for c, _ in map(unpack, ask)]
        else:
            count = dict(zip(*unpack_words(data, n), strict=True))
            out = [pack_words(ws, [count[w] for w in ws]) for ws, _ in map(unpack_words, ask, m)]
        return pa.table([t.column("batch"), t.column("part"), t.column("n"), pa.array(out, pa.binary())], schema=_FIELDS)

    # beside a group's sums, its run's nodes of depth 2
    run = (F.col("run") * split_of(parts)).cast("int")
    each = runs.select(F.explode(F.sequence(run, run + split_of(parts) - 1)).alias("part"), F.lit(0).cast("long").alias("n"), F.lit(None).cast("binary").alias("data"), "two")
    known = sums.select("part", "n", "data", F.lit(None).cast("binary").alias("two")).unionByName(each)
    known = known.join(F.broadcast(dealt), "part").select("part", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), "n", "data", "two")
    values = asked.select("part", "share", "batch", "n", "data").groupBy("part", "share").cogroup(known.groupBy("part", "share")).applyInArrow(answer, _SENT)
    scale = np.log10(tokens + 1.0 * (distinct + 1))

    def look_up(b: pa.Table) -> pa.Table:
        part = b.column("part").to_numpy()
        of = lambda on: b.filter(pa.array(on)).select(["data", "n"]).to_pydict()
        cost, w = {}, of(part >= parts)
        for d, n in zip(w["data"], w["n"], strict=True):
            ws, c = unpack_words(d, n)
            cost |= zip(ws, (np.log10(np.array(c, float) + 1.0) - scale).tolist(), strict=True)
        unknown = float(np.log10(1.0) - scale)
        each = [unpack(d, np.float64) for d in of((part >= 0) & (part < parts))["data"]]
        u, v = (np.concatenate(x) for x in zip(*each, strict=True))
        del w, each
        order = np.argsort(u, kind="stable")
        u, v = u[order], v[order]
        t = pa.ipc.open_stream(of(part == TEXT)["data"][0]).read_all()
        cols = {k: [] for k in ("n_tokens", "n_known", "base_score", "score", "n_bytes")}
        for texts in slices(t.column("text")):
            c, sizes = grams(texts, depth)
            distinct_c, inv = np.unique(c, return_inverse=True)
            cols["score"] += np.add.reduceat(v[np.searchsorted(u, distinct_c)][inv], np.cumsum(sizes) - sizes).tolist()
            cols["n_bytes"] += sizes.tolist()
            for x in texts:
                ws = words(x)
                ws.append(END)
                logs = list(map(cost.__getitem__, ws))
                cols["n_tokens"].append(len(ws))
                cols["n_known"].append(len(ws) - logs.count(unknown))
                cols["base_score"].append(sum(logs))
        return pa.table({"doc_id": t.column("doc_id"), "held_out": pa.array(~t.column("train").to_numpy()), "train_tokens": pa.array([tokens] * t.num_rows, pa.int64())} | {k: pa.array(x, pa.float64() if "score" in k else pa.int64()) for k, x in cols.items()})

    back = sent.where(F.col("part") == TEXT).unionByName(values)
    kind = src.schema["doc_id"].dataType.simpleString()
    scored = back.groupBy("batch").applyInArrow(look_up, f"doc_id {kind}, held_out boolean, train_tokens long, n_tokens long, n_known long, base_score double, score double, n_bytes long")
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes"]
    return scored.select(*names, (-F.col("score") * F.lit(float(np.log2(10))) / F.col("n_bytes")).alias("bits_per_byte"))


def evaluate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int = 7, held: int = 2, depth: int = DEPTH) -> DataFrame:
    """Score all texts, learning from those whose id's crc32 modulo parts is not held."""
    return score(docs, ~F.coalesce(fold(id_col, parts) == held, F.lit(False)), id_col, text_col, depth=depth)
