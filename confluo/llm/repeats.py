"""Removal of repeated byte strings: a depth-limited radix sort of all suffixes, through `threshold` bytes.

Suffixes are told apart by most-significant-digit passes; a bucket of one suffix drops out, and the buckets that are left
at depth `threshold` are exactly the strings that start at two places or more. Two things keep that small:

* Suffixes move in blocks. A suffix belongs to its anchor, the least of the hashes of eight bytes among its first WIDTHS[0]
  places, which its own bytes determine, so that equal suffixes lie equally far before equal anchors. A block is a run of
  neighbours with one anchor. The digit of a pass over blocks of some width is the bytes that all suffixes of such a block
  share, placed by the anchor: 73 bytes for 128 suffixes, 193 for 8, all 200 for one. A block whose digit is nowhere else
  holds no repeat. One that occurs twice with all bytes of all its suffixes is repeated as a whole. What is left is split
  into narrower blocks for the next pass, and of a block that is repeated as a whole one copy goes with it, if others in its
  bucket differ.
* Digits are fingerprints of 64 bits, as order between buckets is never read; together with the fingerprint of a block's
  bytes, which is compared within its bucket only, strings count as equal if 128 bits agree.

One pass over the documents cuts them into batches, each written as one row, with the block's digits as rows. Counts are
sums by digit, added up within a batch before any shuffle, so neither a string that a third of all documents hold nor
thousands of copies meet in one task; answers go back to batches. Later passes see only the bytes of the blocks in
question. Memory grows with a batch, not with a bucket.

Edge cases: a null text is an empty one; texts under the threshold keep all bytes; matches never cross documents, and may
overlap each other; a very long text is a batch of its own and met in one task; rows that repeat match each other, so that
both lose what they share; ties and null ids change nothing; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from confluo.llm.common import scratch, ship
from confluo.llm.lm import batched

#: Bytes of a repeated string; suffixes in a block of each pass; bytes of text in a batch, and of those looked at at once.
THRESHOLD, WIDTHS, BATCH_BYTES, SLICE_BYTES = 200, (128, 8, 1), 8_000_000, 2_000_000
#: What a row of a batch holds.
TEXT, BLOCKS, SPANS, DONE = 0, 1, 2, 3
_GRAM = 8
_ROW = "batch long, kind int, data binary, core long, whole long, n int"
_DOC = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _ipc(t: pa.Table) -> bytes:
    with pa.BufferOutputStream() as out:
        with pa.ipc.new_stream(out, t.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
            w.write_table(t)
        return out.getvalue().to_pybytes()


def _open(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def _joined(texts: pa.ChunkedArray) -> tuple[bytes, np.ndarray]:
    """All texts' bytes in one piece, and where each starts and the last ends."""
    raw = texts.cast(pa.binary()).to_pylist()
    return b"".join(raw), np.cumsum([0, *map(len, raw)])


def _anchors(data: bytes, width: int) -> np.ndarray:
    """For each place p of data the place of the least hash in [p, p + width); only places that have so many bytes."""
    n = len(data) - _GRAM + 1
    if n < width:
        return np.zeros(0, np.int64)
    key = np.empty(n, np.uint64)
    for o in range(_GRAM):
        v = np.frombuffer(data, "<u8", (len(data) - o) // _GRAM, o)
        key[o::_GRAM] = v[: len(key[o::_GRAM])]
    key *= np.uint64(0x9E3779B97F4A7C15)
    key ^= key >> np.uint64(29)
    key *= np.uint64(0xBF58476D1CE4E5B9)
    key &= np.uint64(0xFFFFFFFF00000000)
    key |= np.arange(n, dtype=np.uint64)
    step = 1
    while step < width:  # the least of a run of `step`, then of twice as many
        by = min(step, width - step)
        key = np.minimum(key[:-by], key[by:])
        step += by
    return (key & np.uint64(0xFFFFFFFF)).astype(np.int64)


def blocks(data: bytes, starts: np.ndarray, threshold: int = THRESHOLD, width: int = WIDTHS[0]) -> tuple[np.ndarray, ...]:
    """Anchor, least and greatest distance before it of the suffixes of each block; texts start at starts[:-1]."""
    out = []
    for at in range(0, max(0, len(data) - threshold + 1), SLICE_BYTES):
        anchor = _anchors(data[at : at + SLICE_BYTES + threshold - 1], width)[:SLICE_BYTES]
        anchor = anchor[: max(0, len(data) - threshold + 1 - at)]
        good = np.ones(len(anchor), bool)
        i, j = np.searchsorted(starts, at, "right"), np.searchsorted(starts, at + len(anchor) + threshold)
        for end, begin in zip(starts[i : j + 1].tolist(), starts[i - 1 : j].tolist(), strict=False):
            # suffixes that would reach into the next text
            good[max(0, max(begin, end - threshold + 1) - at) : max(0, end - at)] = False
        label = np.where(good, anchor, -1)
        first = np.flatnonzero(np.r_[True, label[1:] != label[:-1]][: len(label)])
        last = np.r_[first[1:], len(label)][: len(first)] - 1
        on = label[first] >= 0
        first, last = first[on], last[on]
        a = label[first]
        out.append((a + at, a - last, a - first))
    return tuple(np.concatenate([np.zeros(0, np.int64), *c]) for c in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3


def split(low: np.ndarray, high: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Blocks cut at multiples of width: the block each part comes from, its least and greatest distance, its multiple."""
    n = high // width - low // width + 1
    of = np.repeat(np.arange(len(low)), n)
    k = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + (low // width)[of]
    return of, np.maximum(low[of], k * width), np.minimum(high[of], k * width + width - 1), k


def digits(data: bytes, a: np.ndarray, low: np.ndarray, high: np.ndarray, k: np.ndarray, width: int, threshold: int = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of what all suffixes share that can be in such a block, and of all bytes of those that are."""
    h = xxhash.xxh3_64_intdigest
    start, end = a - k * width, a + threshold - (k * width + width - 1)
    core = [h(data[s:e], x) for s, e, x in zip(start.tolist(), end.tolist(), (k + 1).tolist(), strict=True)]
    shape = (high - k * width) * width + low - k * width + 1000
    whole = [h(data[s:e], x) for s, e, x in zip((a - high).tolist(), (a + threshold - low).tolist(), shape.tolist(), strict=True)]
    return np.array(core, np.uint64).view(np.int64), np.array(whole, np.uint64).view(np.int64)


def _same(core: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each distinct pair, in their order, and where each first stands in that order."""
    order = np.lexsort((whole, core))
    c, w = core[order], whole[order]
    new = np.r_[True, (c[1:] != c[:-1]) | (w[1:] != w[:-1])][: len(c)]
    number = np.empty(len(c), np.int64)
    number[order] = np.cumsum(new) - 1
    return number, order[new]


def _asked(batch: int, core: np.ndarray, whole: np.ndarray) -> Iterator[pa.RecordBatch]:
    number, first = _same(core, whole)
    n = np.bincount(number, minlength=len(first))
    for at in range(0, len(first), 100_000):
        i = first[at : at + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), batch)), pa.nulls(len(i), pa.int32()), pa.nulls(len(i), pa.binary()), pa.array(core[i]), pa.array(whole[i]), pa.array(n[at : at + 100_000], pa.int32())], ["batch", "kind", "data", "core", "whole", "n"])


def _held(batch: int, kind: int, data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([batch]), pa.array([kind], pa.int32()), pa.array([data], pa.binary()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32())], ["batch", "kind", "data", "core", "whole", "n"])


def _marks(asked: DataFrame, last: bool) -> DataFrame:
    """Of each batch's digits in buckets of two or more: whether the block is repeated as a whole, and whether its suffixes
    go into the next pass."""
    full = asked.groupBy("core").agg(F.sum("n").alias("total")).where("total > 1").select("core")
    live = scratch(asked.join(full, "core", "left_semi"))
    kinds = live.groupBy("core", "whole").agg(F.sum("n").alias("total"), F.min("batch").alias("first"))
    if last:
        return live.join(kinds.where("total > 1"), ["core", "whole"], "left_semi").select("batch", "core", "whole", F.lit(True).alias("all"), F.lit(False).alias("next"))
    kinds = kinds.join(kinds.groupBy("core").agg(F.count("*").alias("kinds")), "core")
    go = (F.col("kinds") > 1) & ((F.col("total") == 1) | (F.col("batch") == F.col("first")))
    return live.join(kinds, ["core", "whole"]).select("batch", "core", "whole", (F.col("total") > 1).alias("all"), go.alias("next"))


def _answers(marks: pa.Table, core: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each block: repeated as a whole; to be split further, one of those that are equal."""
    m = marks.num_rows
    number, _ = _same(np.r_[marks.column("core").to_numpy(), core], np.r_[marks.column("whole").to_numpy(), whole])
    out = []
    for name in ("all", "next"):
        on = np.zeros(m + len(core), bool)
        on[number[:m]] = marks.column(name).to_numpy(zero_copy_only=False).astype(bool)
        out.append(on[number[m:]])
    once = np.zeros(len(core), bool)
    once[np.unique(number[m:], return_index=True)[1]] = True
    return out[0], out[1] & (once | ~out[0])


def _cut(data: bytes, a: np.ndarray, low: np.ndarray, high: np.ndarray, doc: np.ndarray, off: np.ndarray, threshold: int) -> bytes:
    """Blocks with their bytes; off: the place in its document at which a block's bytes begin."""
    raw = b"".join([data[s:e] for s, e in zip((a - high).tolist(), (a + threshold - low).tolist(), strict=True)])
    return _ipc(pa.table({"low": [low], "high": [high], "doc": [doc], "off": [off], "raw": pa.array([raw], pa.large_binary())}))


def _read_cut(blob: bytes, width: int, threshold: int) -> tuple:
    """Bytes of blocks and, cut to width, their anchors, least and greatest distances, multiples, documents and places."""
    t = _open(blob)
    low, high, doc, off = (t.column(c).chunk(0).flatten().to_numpy() for c in ("low", "high", "doc", "off"))
    size = high - low + threshold
    a = np.cumsum(size) - size + high
    of, lo, hi, k = split(low, high, width)
    return t.column("raw")[0].as_py(), a[of], lo, hi, k, doc[of], (off + high)[of] - hi


def _spans(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> dict[int, list[list[int]]]:
    """Disjoint spans of each document, in order; those that touch are one."""
    order = np.lexsort((start, doc))
    out: dict[int, list[list[int]]] = {}
    for d, s, e in zip(doc[order].tolist(), start[order].tolist(), end[order].tolist(), strict=True):
        own = out.setdefault(d, [])
        if own and s <= own[-1][1]:
            own[-1][1] = max(own[-1][1], e)
        else:
            own.append([s, e])
    return out


def _flat(spans: dict[int, list[list[int]]]) -> pa.Table:
    rows = [(d, s, e) for d, own in spans.items() for s, e in own]
    return pa.table([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], ["doc", "start", "end"])


def _result(text: bytes, spans: list[list[int]]) -> tuple[int, int, int, str]:
    h, at = hashlib.sha256(), 0
    for s, e in spans:
        h.update(text[at:s])
        at = e
    h.update(text[at:])
    return len(text), sum(e - s for s, e in spans), len(spans), h.hexdigest()


def _refine(todo: DataFrame, width: int, threshold: int) -> DataFrame:
    """A pass over blocks cut to width: spans that are found, and blocks for the next pass."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for batch, blob in zip(b.column("batch").to_pylist(), b.column("data").to_pylist(), strict=True):
                yield from _asked(batch, *digits(*_read_cut(blob, width, threshold)[:5], width, threshold))

    def answer(t: pa.Table, marks: pa.Table) -> pa.Table:
        out: list[tuple[int, int, bytes]] = []
        for batch, blob in zip(t.column("batch").to_pylist(), t.column("data").to_pylist(), strict=True):
            data, a, lo, hi, k, doc, off = _read_cut(blob, width, threshold)
            whole, go = _answers(marks, *digits(data, a, lo, hi, k, width, threshold))
            on = whole & (doc >= 0)
            if on.any():
                out.append((batch, SPANS, _ipc(_flat(_spans(doc[on], off[on], (off + hi - lo + threshold)[on])))))
            if go.any():
                out.append((batch, BLOCKS, _cut(data, a[go], lo[go], hi[go], doc[go], off[go], threshold)))
        return pa.table([pa.array([r[i] for r in out], kind) for i, kind in enumerate((pa.int64(), pa.int32(), pa.binary()))], ["batch", "kind", "data"])

    asked = scratch(todo.mapInArrow(ask, _ROW).select("batch", "core", "whole", "n"))
    marks = _marks(asked, width == 1)
    return scratch(todo.groupBy("batch").cogroup(marks.groupBy("batch")).applyInArrow(answer, "batch long, kind int, data binary"))


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD, widths: tuple[int, ...] = WIDTHS, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans and kept_sha256."""
    if widths[-1] != 1 or widths[0] + _GRAM > threshold or any(a % b for a, b in zip(widths, widths[1:], strict=False)):
        raise ValueError("widths must divide each other, end at 1 and start below the threshold")
    ship(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = TaskContext.get().partitionId() << 32
        for t in batched(batches, batch_bytes):
            batch += 1
            yield _held(batch, TEXT, _ipc(t))
            data, starts = _joined(t.column("text"))
            a, low, high = blocks(data, starts, threshold, widths[0])
            yield from _asked(batch, *digits(data, a, low, high, 0 * a, widths[0], threshold))

    sent = scratch(src.mapInArrow(send, _ROW))

    def first(t: pa.Table, marks: pa.Table) -> pa.Table:
        """Documents that need no other pass are done; of others their text and spans stay; blocks for the next pass."""
        batch, t = t.column("batch")[0].as_py(), _open(t.column("data")[0].as_py())
        data, starts = _joined(t.column("text"))
        a, low, high = blocks(data, starts, threshold, widths[0])
        whole, go = _answers(marks, *digits(data, a, low, high, 0 * a, widths[0], threshold))
        doc = np.searchsorted(starts, a, "right") - 1
        off = a - high - starts[doc]
        found = _spans(doc[whole], off[whole], (off + high - low + threshold)[whole])
        open_ = np.zeros(t.num_rows, bool)
        open_[doc[go & ~whole]] = True
        done = np.flatnonzero(~open_)
        cols = zip(*(_result(data[starts[d] : starts[d + 1]], found.get(d, [])) for d in done.tolist()), strict=True) if len(done) else ([],) * 4
        ids = t.column("doc_id").combine_chunks()
        kinds = [DONE] * len(done)
        blobs: list[bytes | None] = [None] * len(done)
        if open_.any():
            where = np.cumsum(open_) - 1
            kinds += [TEXT, SPANS]
            blobs += [_ipc(t.filter(pa.array(open_))), _ipc(_flat({int(where[d]): own for d, own in found.items() if open_[d]}))]
            # blocks of finished documents only stand for others: their document is not read again
            kinds.append(BLOCKS)
            blobs.append(_cut(data, a[go], low[go], high[go], np.where(open_[doc[go]], where[doc[go]], -1), off[go], threshold))
        elif go.any():
            kinds.append(BLOCKS)
            blobs.append(_cut(data, a[go], low[go], high[go], np.full(int(go.sum()), -1), off[go], threshold))
        more = len(kinds) - len(done)
        pad = lambda x, type_: pa.array([*x, *[None] * more], type_)
        n_bytes, n_removed, n_spans, sha = map(list, cols)
        return pa.table([pa.array([batch] * len(kinds), pa.int64()), pa.array(kinds, pa.int32()), pa.array(blobs, pa.binary()), pa.concat_arrays([ids.take(pa.array(done)), pa.nulls(more, ids.type)]), pad(n_bytes, pa.int64()), pad(n_removed, pa.int64()), pad(n_spans, pa.int64()), pad(sha, pa.string())], ["batch", "kind", "data", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    texts = sent.where(F.col("kind") == TEXT).select("batch", "data")
    marks = _marks(sent.where("core IS NOT NULL").select("batch", "core", "whole", "n"), len(widths) == 1)
    now = scratch(texts.groupBy("batch").cogroup(marks.groupBy("batch")).applyInArrow(first, f"batch long, kind int, data binary, doc_id {kind}, {_DOC}"))
    found = [now.where(F.col("kind").isin(TEXT, SPANS)).select("batch", "kind", "data")]
    todo = now.where(F.col("kind") == BLOCKS).select("batch", "kind", "data")
    for width in widths[1:]:
        after = _refine(todo, width, threshold)
        found.append(after.where(F.col("kind") == SPANS))
        todo = after.where(F.col("kind") == BLOCKS)

    def finish(t: pa.Table) -> pa.Table:
        rows = list(zip(t.column("kind").to_pylist(), t.column("data").to_pylist(), strict=True))
        texts = [_open(d) for k, d in rows if k == TEXT]
        got = pa.concat_tables([_open(d) for k, d in rows if k == SPANS])
        own = _spans(*(got.column(c).to_numpy() for c in ("doc", "start", "end")))
        if not texts:
            raise RuntimeError("spans of a document that isn't here")
        data, starts = _joined(texts[0].column("text"))
        cols = list(zip(*(_result(data[starts[d] : starts[d + 1]], own.get(d, [])) for d in range(texts[0].num_rows)), strict=True))
        return pa.table([texts[0].column("doc_id"), *(pa.array(c, pa.string() if i == 3 else pa.int64()) for i, c in enumerate(cols))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    done = now.where(F.col("kind") == DONE).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    rest = reduce(DataFrame.unionByName, found).groupBy("batch").applyInArrow(finish, f"doc_id {kind}, {_DOC}")
    return done.unionByName(rest)
