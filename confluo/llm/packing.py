"""Best-two-fit packing of whole documents into sequences of a fixed number of tokens.

Pieces of one length are interchangeable, so bins are planned on the histogram of lengths, which has `capacity` rows
at any corpus size, and each plan (a multiset of lengths) is used as often as its lengths last; that gives the same
bins as planning them one by one. A bin of a single piece is left as it is: that is the largest piece left, and would
only come back to the next bin. Numbering the pieces of each length is a window over (bucket, length) groups of
bounded size, drawn by a number that each written piece has, plus prefix sums, so neither a length that a third of all
pieces have nor rows that repeat meet in one task.

Edge cases: a null or empty text is its end id alone (one piece of length 1); a very long text is encoded whole by one
task and cut into pieces; repeated rows are packed as often as they occur; an empty table gives no pieces; ids must be
whole numbers or text of one (others raise an error), or null; columns other than id and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from confluo.llm.bpe import encoder
from confluo.llm.common import scratch, ship

CAPACITY = 1024
END_ID = 2
#: Pieces that one numbering group holds on average if all have the same length.
GROUP_ROWS = 20_000


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, tokenizer_path: str | None = None) -> DataFrame:
    """Cut each document's ids, end id included, into pieces: doc_id, piece, start, length, ids_crc32.

    A document of more than capacity ids gets full pieces but for the first, which takes what is left over.
    """
    ship(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        end = np.array([end_id], "<u4").tobytes()
        for b in batches:
            keys, out = b.column(0).to_pylist(), ([], [], [], [], [])
            for key, raw in zip(keys, enc.encode_many(b.column(1).to_pylist()), strict=True):
                n = len(raw) // 4 + 1
                raw += end
                start, stop, k = 0, n if n <= capacity else (n % capacity or capacity), 0
                while start < n:
                    for col, v in zip(out, (key, k, start, stop - start, zlib.crc32(raw[4 * start : 4 * stop])), strict=True):
                        col.append(v)
                    start, stop, k = stop, stop + capacity, k + 1
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[pd.DataFrame, int]:
    """Best-two-fit on a histogram of lengths; the rows are runs of pieces of one length, with their places.

    Each bin is filled greedily, largest piece first. If a gap stays, its smallest piece gives way to the two pieces
    left whose sum fits the gap so widened and fills more of it. A run's pieces, by rank from `first`, go `each` to a
    bin, from bin `bin` on, at `offset` and steps of the length. At most about capacity * ln(capacity) plans arise.
    """
    have = np.zeros(capacity + 1, np.int64)
    for k, v in counts.items():
        have[k] = v
    used, rows, n_bins = np.zeros(capacity + 1, np.int64), [], 0
    while have.any():
        left, bin_, gap = have.copy(), [], capacity
        while gap:
            fit = np.flatnonzero(left[: gap + 1])
            if not len(fit):
                break
            size = int(fit[-1])
            k = min(gap // size, int(left[size]))
            bin_ += [size] * k
            left[size] -= k
            gap -= k * size
        if gap and len(bin_) > 1:
            least, wide = bin_[-1], gap + bin_[-1]
            fit = np.flatnonzero(left[: wide + 1])
            best = (least, 0, 0)
            if len(fit):
                # the best partner of each size x <= y: the largest y that fits beside it
                at = np.searchsorted(fit, wide - fit, "right") - 1
                for x, i in zip(fit.tolist(), at.tolist(), strict=True):
                    while i >= 0 and fit[i] == x and left[x] < 2:
                        i -= 1
                    if i >= 0 and x + int(fit[i]) > best[0]:
                        best = (x + int(fit[i]), max(x, int(fit[i])), min(x, int(fit[i])))
            if best[1]:
                bin_ = [*bin_[:-1], best[1], best[2]]
        sizes, need = np.unique(np.array(bin_), return_counts=True)
        times = int((have[sizes] // need).min())
        offset = 0
        for size, k in zip(sizes[::-1].tolist(), need[::-1].tolist(), strict=True):
            rows.append((size, int(used[size]), k, n_bins, offset))
            used[size] += k * times
            have[size] -= k * times
            offset += k * size
        n_bins += times
    return pd.DataFrame(rows, columns=["length", "first", "each", "bin", "offset"]).sort_values(["length", "first"], ignore_index=True), n_bins


def pack_pieces(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give each piece a sequence_id and an offset, gapless from 0. cut: as pieces() returns it, and a number `at` of its
    own for each row, written already."""
    hist = {r.length: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table, _ = plan(hist, capacity)
    groups = max(16, sum(hist.values()) // GROUP_ROWS)
    by = cut.withColumn("bucket", F.pmod(F.xxhash64("at"), F.lit(groups)))
    ranked = by.withColumn("rank", F.row_number().over(Window.partitionBy("length", "bucket").orderBy("at")).cast("long") - 1)
    sums = by.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    sums = sums.select("length", "bucket", (F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("before"))
    numbered = ranked.join(sums, ["length", "bucket"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank"))
    lengths, first, each, bin_, offset = (table[c].to_numpy() for c in ("length", "first", "each", "bin", "offset"))
    # one sorted key for (length, rank): ranks stay below the number of pieces
    key = lengths.astype(object) * (1 << 52) + first.astype(object) if len(table) else np.zeros(0)
    key = np.array(key, np.int64) if capacity < 2048 else None
    if key is None:
        raise ValueError("capacity must be below 2048")

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            n, r = b["length"].to_numpy(np.int64), b["rank"].to_numpy(np.int64)
            i = np.searchsorted(key, n * (1 << 52) + r, "right") - 1
            d = r - first[i]
            yield b.drop(columns="rank").assign(sequence_id=bin_[i] + d // each[i], offset=offset[i] + d % each[i] * n)

    return numbered.mapInPandas(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, tokenizer_path: str | None = None) -> DataFrame:
    """Pack all documents; one row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut = pieces(docs, id_col, text_col, capacity, end_id, tokenizer_path)
    return pack_pieces(scratch(cut.withColumn("at", F.monotonically_increasing_id())), capacity)
