"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; documents drawn without a look at their labels are the unlabelled rest.
A logistic model minimises prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)); where the second part is negative, its
gradient step is reversed, as in Kiryo et al. 2017. Words come in lower case, cut at white space and ASCII punctuation.
A word's features are its runs of 3 to 7 characters, the word's borders included, so that stems count in words they are
glued into; a text's value of a feature is its number of occurrences for each word of the text, shrunk towards 0 in
short texts. The model keeps the features whose means differ most between both samples, whichever way they differ.

Fitting, in one task, sees a bounded sample (`positives`, `unlabelled`, `most_words`: documented bounds, drawn by hash);
scoring sees whole texts. Edge cases: null, empty and wordless texts score by the bias alone; very long texts are scored whole, one
word at a time; without any confirmed positive (or without any text) all scores are 0; any number of positives, one
included, gives a model; rows that occur twice are scored twice and, their text being one, learned once; null labels
confirm nothing; an empty table gives no rows; columns of docs named like an output are replaced.
"""

from __future__ import annotations

import string
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from confluo.llm.common import fold, ship

POSITIVES, UNLABELLED, MOST_WORDS = 3000, 9000, 4096
#: Features are hashed to so many bits; runs of these lengths; words that are hashed at once; words that a worker
#: remembers; characters of texts that are scored together.
BITS, SHORTEST, LONGEST, CHUNK, CACHE, BLOCK = 20, 3, 7, 20_000, 200_000, 500_000
#: A word counts for so much of its text at most, so that no text of one word outweighs all others.
MOST_SHARE = 0.1
#: Words that the length of a text is raised by in its shares.
SMOOTH = 100.0
_CUT = str.maketrans(dict.fromkeys(string.punctuation, " "))


def words(text: str | None) -> list[str]:
    return (text or "").lower().translate(_CUT).split()


def features(ws: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed runs of characters of words, and the place of the word that each is from."""
    spaced = [f" {w} " for w in ws]
    n = np.fromiter(map(len, spaced), np.int64, len(spaced))
    chars = np.frombuffer("".join(spaced).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    end, word, at = np.repeat(np.cumsum(n), n), np.repeat(np.arange(len(ws)), n), np.arange(len(chars))
    h, found, of = np.zeros(len(chars), np.uint64), [], []
    for k in range(1, LONGEST + 1):
        h = h[: max(0, len(chars) - k + 1)] * np.uint64(0x9E3779B97F4A7C15) + chars[k - 1 :] + np.uint64(1)
        if k >= SHORTEST:
            inside = (at + k <= end)[: len(h)]
            x = h[inside]
            found.append((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - BITS))
            of.append(word[: len(h)][inside])
    return np.concatenate(found).astype(np.int64), np.concatenate(of)


def risk(zp: np.ndarray, zu: np.ndarray, prior: float) -> tuple[float, float, np.ndarray, np.ndarray]:
    """Both parts of the corrected risk under the logistic loss, and the step's gradient by the scores of both samples.

    prior * R_p(+), and R_u(-) - prior * R_p(-); where the latter is negative, the gradient is that of its negative.
    """
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -500, 500)))
    plus, rest = prior * np.logaddexp(0, -zp).mean(), np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
    gp, gu = prior * sig(zp) / len(zp), sig(zu) / len(zu)
    if rest < 0:
        return plus, rest, gp, -gu
    return plus, rest, prior * (sig(zp) - 1) / len(zp) - gp, gu


class PuModel:
    """Weights of hashed features and a bias; score() takes texts as they are."""

    def __init__(self, kept: np.ndarray, weights: np.ndarray, bias: float, smooth: float):
        self.kept, self.weights, self.bias, self.smooth = kept, weights, bias, smooth
        self._of_word: dict[str, float] = {}
        self._table: np.ndarray | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_of_word": {}, "_table": None}

    def _learn_words(self, ws: list[str]) -> None:
        if self._table is None:
            self._table = np.zeros(1 << BITS)
            self._table[self.kept] = self.weights
        if len(self._of_word) > CACHE:
            self._of_word.clear()
        new = sorted(w for w in set(ws) if w not in self._of_word)
        for i in range(0, len(new), CHUNK):
            part = new[i : i + CHUNK]
            f, of = features(part)
            self._of_word.update(zip(part, np.bincount(of, self._table[f], len(part)).tolist(), strict=True))

    def _sum(self, ws: list[str]) -> float:
        n, most = Counter(ws), MOST_SHARE * (len(ws) + self.smooth)
        total = sum(map(self._of_word.__getitem__, ws))
        total -= sum((c - most) * self._of_word[w] for w, c in n.most_common(int(1 / MOST_SHARE)) if c > most)
        return total / (len(ws) + self.smooth)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        z, held, chars = [], [], 0
        for i, t in enumerate(texts):
            held.append(words(t))
            chars += len(t or "")
            if chars >= BLOCK or i == len(texts) - 1:  # words of many texts are hashed at once
                self._learn_words([w for ws in held for w in ws])
                z += map(self._sum, held)
                held, chars = [], 0
        return 1 / (1 + np.exp(-np.clip(np.array(z, float) + self.bias, -500, 500)))


def counted(text: str | None, most_words: int = MOST_WORDS) -> str:
    """A text as its words and their counts; of more than `most_words` distinct words, so many, drawn by their hash."""
    c = Counter(words(text))
    if len(c) > most_words:
        c = {w: c[w] for w in sorted(c, key=lambda w: zlib.crc32(w.encode("utf-8", "surrogatepass")))[:most_words]}
    return " ".join(f"{w} {n}" for w, n in sorted(c.items()))


def fit(positive: list[str], unlabelled: list[str], prior: float, most: int = 1024, smooth: float = SMOOTH, epochs: int = 150, rate: float = 0.02, shrink: float = 1e-3, sure: float = 4.0) -> PuModel | None:
    """Train on texts as counted() gives them; most is the number of features kept, smooth the words that a
    text's length is raised by, shrink the weight of the squared weights, sure the distance at which a feature counts half."""
    if not positive or not unlabelled:
        return None
    texts, n_pos, n_unl = [*positive, *unlabelled], len(positive), len(unlabelled)
    place: dict[str, int] = {}
    col = np.fromiter((place.setdefault(w, len(place)) for t in texts for w in t.split()[::2]), np.int32)
    row = np.repeat(np.arange(len(texts), dtype=np.int32), [(t.count(" ") + 1) // 2 for t in texts])
    rate_of = np.fromiter((int(c) for t in texts for c in t.split()[1::2]), np.float64, len(row))
    rate_of = np.minimum(rate_of / (np.bincount(row, rate_of, len(texts)) + smooth)[row], MOST_SHARE)
    vocabulary, is_pos, size = list(place), row < n_pos, 1 << BITS
    chunks = range(0, len(vocabulary), CHUNK)

    # means and variances of the features in both samples, words taken as independent
    def moments(on: np.ndarray, n: int) -> list[np.ndarray]:
        return [np.bincount(col[on], x[on], len(vocabulary)) / n for x in (rate_of, rate_of**2)]

    by_word = [*moments(is_pos, n_pos), *moments(~is_pos, n_unl)]
    p1, p2, u1, u2 = (np.zeros(size) for _ in by_word)
    for i in chunks:
        f, of = features(vocabulary[i : i + CHUNK])
        for total, m in zip((p1, p2, u1, u2), by_word, strict=True):
            total += np.bincount(f, m[i : i + CHUNK][of], size)
    floor = (0.1 / smooth) ** 2
    gap = np.abs(p1 - u1) / np.sqrt((np.maximum(p2 - p1**2, 0) + floor) / n_pos + (np.maximum(u2 - u1**2, 0) + floor) / n_unl)
    kept = np.sort(np.argsort(-gap, kind="stable")[:most])
    kept = kept[gap[kept] > 0]
    if not len(kept):
        return PuModel(kept, np.zeros(0), float(np.log(prior / (1 - prior))), smooth)

    # texts by kept features, from the words that hold any
    slot = np.full(size, -1)
    slot[kept] = np.arange(len(kept))
    held_f, held_w = [], []
    for i in chunks:
        f, of = features(vocabulary[i : i + CHUNK])
        on = slot[f] >= 0
        order = np.argsort(of[on], kind="stable")
        held_f.append(slot[f[on]][order].astype(np.int32))
        held_w.append((of[on][order] + i).astype(np.int32))
    hf, hw = np.concatenate(held_f), np.concatenate(held_w)
    first = np.searchsorted(hw, np.arange(len(vocabulary) + 1))
    blocks = []
    for lo, hi in zip(starts := np.searchsorted(row, np.arange(0, len(texts), 500)), [*starts[1:], len(row)], strict=True):
        c = col[lo:hi]
        many = np.diff(first)[c]
        at = np.repeat(first[c], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        key, inv = np.unique(np.repeat(row[lo:hi], many).astype(np.int64) * len(kept) + hf[at], return_inverse=True)
        blocks.append((key // len(kept), key % len(kept), np.bincount(inv, np.repeat(rate_of[lo:hi], many), len(key))))
    r, f, x = (np.concatenate(c) for c in zip(*blocks, strict=True))
    spread = np.sqrt(np.bincount(f, x**2, len(kept)) / len(texts)) + 1e-9
    # features that may differ by chance move a score little: trust grows with their distance in standard errors
    trust = gap[kept] ** 2 / (gap[kept] ** 2 + sure**2) / spread
    x *= trust[f]

    w = np.append(np.zeros(len(kept)), np.log(prior / (1 - prior)))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for i in range(1, epochs + 1):
        z = np.bincount(r, w[f] * x, len(texts)) + w[-1]
        g = np.concatenate(risk(z[:n_pos], z[n_pos:], prior)[2:])
        step = np.append(np.bincount(f, g[r] * x, len(kept)) + shrink * w[:-1], g.sum())
        m += 0.1 * (step - m)
        v += 0.01 * (step * step - v)
        w -= rate * m / (1 - 0.9**i) / (np.sqrt(v / (1 - 0.99**i)) + 1e-6)
    return PuModel(kept, w[:-1] * trust, float(w[-1]), smooth)


def sample_words(docs: DataFrame, text_col: str, most: int) -> DataFrame:
    """(h, w): hash and counted words of up to `most` distinct texts, those with the least hashes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([counted(t) for t in b.column(1).to_pylist()], pa.string())], ["h", "w"])

    # copies of a text are one row before any are counted
    texts = docs.where(F.col(text_col).isNotNull()).select(F.xxhash64(text_col).alias("h"), F.col(text_col).alias("t"))
    return texts.groupBy("h").agg(F.min("t").alias("t")).mapInArrow(cut, "h long, w string").orderBy("h").limit(most)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> PuModel | None:
    """Fit on learning documents and their labels. The class prior is the share of positives among labelled rows.

    The sample, bounded by `positives`, `unlabelled` and `most_words`, meets in one task, which fits; the driver gets
    the model's weights alone.
    """
    ship(docs.sparkSession)
    lab = labels.where(F.col(label_col).isNotNull())
    n_lab, n_pos = lab.agg(F.count("*"), F.coalesce(F.sum((F.col(label_col) == 1).cast("long")), F.lit(0))).first()
    if not n_pos:
        return None
    prior = min(0.9, max(0.01, n_pos / n_lab))
    draw = lambda share, c: F.pmod(F.xxhash64(F.lit(11), c), F.lit(1 << 30)) < int(min(1.0, share) * (1 << 30))
    # about `positives` ids by their hash: a bound on what is broadcast
    ids = lab.where(F.col(label_col) == 1).where(draw(1.2 * positives / n_pos, F.col(id_col))).select(F.col(id_col).alias("_id")).distinct().limit(2 * positives)
    pos = docs.join(F.broadcast(ids), docs[id_col] == ids["_id"], "left_semi")
    n_docs = docs.count()
    unl = docs.where(draw(1.2 * unlabelled / max(1, n_docs), F.col(text_col)))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = list(batches)
        if not have:
            return
        t = pa.Table.from_batches(have).sort_by([("kind", "ascending"), ("h", "ascending")]).to_pydict()
        texts = {k: [w for kind, w in zip(t["kind"], t["w"], strict=True) if kind == k and w] for k in (0, 1)}
        model = fit(texts[1], texts[0], prior)
        if model is not None:
            yield pa.RecordBatch.from_arrays([pa.array([*model.kept.tolist(), -1], pa.int64()), pa.array([*model.weights.tolist(), model.bias])], ["feature", "weight"])

    both = sample_words(pos, text_col, positives).withColumn("kind", F.lit(1)).unionByName(sample_words(unl, text_col, unlabelled).withColumn("kind", F.lit(0)))
    got = both.repartition(1).mapInArrow(learn, "feature long, weight double").toArrow()
    feature, weight = got.column("feature").to_numpy(), got.column("weight").to_numpy()
    if not len(feature):
        return None
    on = feature >= 0
    return PuModel(feature[on], weight[on], float(weight[~on][0]), SMOOTH)


def score(docs: DataFrame, model: PuModel | None, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """All columns of docs but the text, plus score and predicted; names that clash with these are replaced."""
    ship(docs.sparkSession)
    names = [c for c in docs.columns if c not in (text_col, "score", "predicted")]
    src = docs.select(*names, F.col(text_col).alias("_text"))
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = b.column(b.num_columns - 1)
            s = np.concatenate([model.scores(t.slice(at, 512).to_pylist()) if model else np.zeros(len(t.slice(at, 512))) for at in range(0, len(t), 512)] or [np.zeros(0)])
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(b.num_columns - 1)), pa.array(s), pa.array((s >= threshold).astype(np.int32))], [*b.schema.names[:-1], "score", "predicted"])

    return src.mapInArrow(run, f"{out}, score double, predicted int")


def detect(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", parts: int = 5, held: int = 0) -> DataFrame:
    """Learn on rows whose id's crc32 modulo parts is not held, and score all: doc_id, held_out, score, predicted."""
    learn = ~F.coalesce(fold(id_col, parts) == held, F.lit(False))
    model = train(docs.where(learn), labels.where(learn), id_col, text_col, label_col)
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(fold(id_col, parts) == held, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    return score(src, model)


def reject(docs: DataFrame, model: PuModel | None, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of docs, all columns as they are, that score below the threshold."""
    ship(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = b.column(at)
            for k in range(0, len(t), 512):
                part = b.slice(k, 512)
                yield part.filter(pa.array(model.scores(t.slice(k, 512).to_pylist()) < threshold)) if model else part

    return docs.mapInArrow(run, docs.schema)
