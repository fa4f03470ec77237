"""Language identification by a bidirectional gated recurrent network over bytes, trained and run in numpy.

Training: backpropagation through time on random windows of a bounded sample of learning rows (`sample_rows` a
language, a documented bound on fitting only). Prediction: every byte of every text gets label probabilities from a
forward and a backward pass over its window of `window` bytes (windows tile the text, the last is padded and masked),
and a document's probability is the mean over its positions.

Edge cases: null texts and texts without a letter get `und` with score 0; texts of any length run in blocks of
windows; languages that are null in learning rows are not learned; with nothing to learn from all rows are `und`;
repeated rows are each labelled and, their text being one, learned once; an empty table gives no rows; columns other
than those named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from confluo.llm.common import fold, ship

HIDDEN, WINDOW, BLOCK = 8, 128, 4096


class ByteGru:
    """Parameters and passes; arrays are feature-major so that every step works on contiguous rows."""

    def __init__(self, langs: list[str], hidden: int = HIDDEN, seed: int = 0):
        r, h, n = np.random.default_rng(seed), hidden, len(langs)
        self.langs, self.h = langs, h
        self.p = {}
        for d in "fb":
            self.p[d + "E"] = r.normal(0, 0.5, (256, 3 * h)).astype(np.float32)
            self.p[d + "Z"] = r.normal(0, h**-0.5, (2 * h, h)).astype(np.float32)
            self.p[d + "N"] = r.normal(0, h**-0.5, (h, h)).astype(np.float32)
        self.p["W"] = r.normal(0, 0.3, (n, 2 * h)).astype(np.float32)
        self.p["c"] = np.zeros((n, 1), np.float32)

    def _run(self, d: str, x: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Hidden states (T, h, B) of one direction over bytes x (T, B), already in that direction's order."""
        h, (steps, b) = self.h, x.shape
        table, uz, un = np.ascontiguousarray(self.p[d + "E"].T), self.p[d + "Z"], self.p[d + "N"]
        out, state = np.empty((steps, h, b), np.float32), np.zeros((h, b), np.float32)
        for t in range(steps):
            e = table.take(x[t], axis=1)
            zr = uz @ state
            zr += e[: 2 * h]
            zr *= 0.5
            np.tanh(zr, out=zr)
            zr *= 0.5
            zr += 0.5
            z, g = zr[:h], zr[h:]
            n = un @ (g * state)
            n += e[2 * h :]
            np.tanh(n, out=n)
            if keep is not None:
                keep.append((state.copy(), z.copy(), g.copy(), n.copy()))
            state -= n
            state *= z
            state += n
            out[t] = state
        return out

    def positions(self, x: np.ndarray) -> np.ndarray:
        """Label probabilities (T, n, B) of every position of windows x (T, B)."""
        f, b = self._run("f", x), self._run("b", x[::-1])[::-1]
        w, c, h = self.p["W"], self.p["c"], self.h
        o = np.matmul(w[:, :h], f)
        o += np.matmul(w[:, h:], b)
        o += c
        o -= o.max(axis=1, keepdims=True)
        np.exp(o, out=o)
        o /= o.sum(axis=1, keepdims=True)
        return o

    def step(self, x: np.ndarray, y: np.ndarray, mask: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean cross-entropy over positions, by backpropagation through time."""
        h, (steps, b) = self.h, x.shape
        kf, kb = [], []
        f, g = self._run("f", x, kf), self._run("b", x[::-1], kb)[::-1]
        w = self.p["W"]
        o = np.matmul(w[:, :h], f) + np.matmul(w[:, h:], g) + self.p["c"]
        o -= o.max(axis=1, keepdims=True)
        np.exp(o, out=o)
        o /= o.sum(axis=1, keepdims=True)
        o[:, y, np.arange(b)] -= 1
        o *= mask[:, None, :] / mask.sum()
        grads = {k: np.zeros_like(v) for k, v in self.p.items()}
        grads["W"] = np.concatenate([np.einsum("tnb,thb->nh", o, f), np.einsum("tnb,thb->nh", o, g)], 1)
        grads["c"] = o.sum(axis=(0, 2))[:, None]
        for d, keep, xs, dout in (("f", kf, x, np.matmul(w[:, :h].T, o)), ("b", kb, x[::-1], np.matmul(w[:, h:].T, o)[::-1])):
            uz, un, ds = self.p[d + "Z"], self.p[d + "N"], np.zeros((h, b), np.float32)
            for t in range(steps - 1, -1, -1):
                s, z, r, n = keep[t]
                ds = ds + dout[t]
                da = ds * (1 - z) * (1 - n * n)
                dz = ds * (s - n) * z * (1 - z)
                back = un.T @ da
                dr = back * s * r * (1 - r)
                dzr = np.concatenate([dz, dr])
                grads[d + "N"] += da @ (r * s).T
                grads[d + "Z"] += dzr @ s.T
                np.add.at(grads[d + "E"], xs[t], np.concatenate([dzr, da]).T)
                ds = ds * z + back * r + uz.T @ dzr
        return grads

    def fit(self, texts: list[bytes], labels: np.ndarray, steps: int = 160, batch: int = 192, window: int = 48, rate: float = 0.02, seed: int = 0) -> ByteGru:
        """Adam over random windows; each language is drawn equally often."""
        r = np.random.default_rng(seed)
        by = [np.flatnonzero(labels == k) for k in range(len(self.langs))]
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        for i in range(1, steps + 1):
            y = np.arange(batch) % len(self.langs)
            x, mask = np.zeros((window, batch), np.uint8), np.zeros((window, batch), np.float32)
            for j in range(batch):
                t = texts[by[y[j]][r.integers(len(by[y[j]]))]]
                at = int(r.integers(max(1, len(t) - window + 1)))
                piece = np.frombuffer(t[at : at + window], np.uint8)
                x[: len(piece), j], mask[: len(piece), j] = piece, 1
            grads = self.step(x, y, mask)
            norm = np.sqrt(sum(float((a * a).sum()) for a in grads.values()))
            for k, a in grads.items():
                a = a * min(1.0, 1.0 / max(norm, 1e-9))
                m[k] += 0.1 * (a - m[k])
                v2[k] += 0.01 * (a * a - v2[k])
                lr = rate * min(1.0, 2 * (1 - i / (steps + 1)))
                self.p[k] -= (lr * (m[k] / (1 - 0.9**i)) / (np.sqrt(v2[k] / (1 - 0.99**i)) + 1e-8)).astype(np.float32)
        return self

    def documents(self, data: np.ndarray, offsets: np.ndarray, window: int = WINDOW, block: int = BLOCK) -> np.ndarray:
        """Mean label probabilities (documents, n) of texts that lie one after another in data; nan if empty."""
        sizes = np.diff(offsets)
        count = -(-sizes // window)
        doc = np.repeat(np.arange(len(sizes)), count)
        start = offsets[:-1][doc] + (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * window
        length = np.minimum(window, offsets[1:][doc] - start)
        total = np.zeros((len(sizes), len(self.langs)))
        padded = np.concatenate([data, np.zeros(window, np.uint8)])
        steps = np.arange(window)
        for at in range(0, len(doc), block):
            s, n = start[at : at + block], length[at : at + block]
            x = padded[s[None, :] + steps[:, None]]
            if n.min() < window:
                x[steps[:, None] >= n[None, :]] = 0  # what follows a text is not part of its window
            p = self.positions(x)
            if n.min() < window:
                p *= (steps[:, None] < n[None, :])[:, None, :]
            np.add.at(total, doc[at : at + block], p.sum(axis=0).T)
        with np.errstate(invalid="ignore", divide="ignore"):
            return total / sizes[:, None]


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", sample_rows: int = 300, sample_bytes: int = 4000) -> ByteGru | None:
    """Learn from non-null languages. sample_rows a language are drawn by a hash of the text, and of each a random
    stretch of up to sample_bytes; both bound what the driver holds."""
    src = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (F.length(text_col) > 0)).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    counts = {r.lang: r["n"] for r in src.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    share = F.lit(0.0)
    for k, n in counts.items():
        share = F.when(F.col("lang") == k, F.lit(min(1.0, 1.5 * sample_rows / n))).otherwise(share)
    key = F.pmod(F.xxhash64("text"), F.lit(1 << 40))
    at = F.pmod(F.xxhash64(F.lit(7), "text"), F.greatest(F.length("text") - sample_bytes // 2, F.lit(1))).cast("int") + 1
    drawn = src.where(key < share * F.lit(float(1 << 40))).select("lang", F.substr("text", at, F.lit(sample_bytes // 2)).alias("t"), key.alias("k"))
    # copies of a text are one row, and each language is cut to its share, before any reach the driver
    drawn = drawn.groupBy("lang", "k").agg(F.min("t").alias("t"))
    some = drawn.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("k"))).where(F.col("r") <= sample_rows).select("lang", "k", "t").collect()
    langs, texts, labels = sorted(counts), [], []
    for i, lang in enumerate(langs):
        own = sorted((r.k, r.t) for r in some if r.lang == lang)
        texts += [t.encode() for _, t in own]
        labels += [i] * len(own)
    got = sorted(set(labels))
    labels = np.searchsorted(got, labels)
    return ByteGru([langs[i] for i in got]).fit(texts, labels) if got else None


def predict(docs: DataFrame, model: ByteGru | None, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, lang_pred, score (the mean probability of that language), and columns to keep."""
    ship(docs.sparkSession)
    kept = [c for c in keep]
    # names of our own, so that columns of the input cannot clash
    src = docs.select(F.col(id_col).alias("doc_id"), *kept, F.when(F.regexp_like(F.col(text_col), F.lit(r"\p{L}")), F.col(text_col)).alias("_text"))
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]) + ", lang_pred string, score double"

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = b.column(b.num_columns - 1).cast(pa.large_string()).fill_null("")
            buf, n = t.buffers(), len(t)
            offsets = np.frombuffer(buf[1], np.int64)[t.offset : t.offset + n + 1] if n else np.zeros(1, np.int64)
            data = np.frombuffer(buf[2], np.uint8)[offsets[0] : offsets[-1]] if n and buf[2] else np.zeros(0, np.uint8)
            names, score = np.full(n, "und", object), np.zeros(n)
            if model is not None:
                p = model.documents(data, offsets - offsets[0])
                good = np.diff(offsets) > 0
                best = np.where(good[:, None], p, 0).argmax(1)
                names[good] = np.array(model.langs, object)[best[good]]
                score[good] = np.clip(p[np.arange(n), best][good], 0, 1)
            cols = [b.column(i) for i in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(names, pa.string()), pa.array(score)], [*b.schema.names[:-1], "lang_pred", "score"])

    return src.mapInArrow(label, out)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", parts: int = 4, held: int = 2) -> DataFrame:
    """Learn on documents whose id's crc32 modulo parts is not held, and label all."""
    out = fold(id_col, parts) == held
    model = fit(docs.where(~F.coalesce(out, F.lit(False))), text_col, lang_col)
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(out, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    return predict(src, model, keep=("held_out",))
