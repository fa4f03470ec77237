"""Edit-aware token counts: a segment tree over runs of pre-tokens for each document.

A leaf is a run of pre-tokens that ends where a non-space character stands before a space, a place that always ends a
pre-token; the tree holds the tokens and characters of its leaves. An edit touches the leaves that it overlaps and,
where a touched border stops being such a place, its neighbours; only these are encoded again, and only the sums above
them change. A leaf that edits have made large is split when the tree is next built.

Edge cases: a null or empty text has one empty leaf and 0 tokens; edits are given in characters of the original text,
must not overlap (an edit that starts before the last one ended is ignored, as is one outside the text), and may be
null or empty; repeated rows are documents of their own; a very long text is one tree in one task; an empty table gives
no rows; ids must be whole numbers or text of one (others raise an error), or null; columns other than those named are
not read. n_edits counts the edits that were applied.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from confluo.llm.bpe import Encoder, encoder
from confluo.llm.common import ship

#: Characters from which a leaf ends at the next sure place.
LEAF_CHARS = 256
_PLACE = re.compile(r"(?<=\S) ")


class Tree:
    """Tokens and characters of leaves, with sums in heap order: node i has the children 2i and 2i + 1."""

    def __init__(self, tokens: np.ndarray, chars: np.ndarray):
        self.base = 1 << max(0, int(len(tokens) - 1).bit_length())
        self.sums = np.zeros((2, 2 * self.base), np.int64)
        self.sums[0, self.base : self.base + len(tokens)] = tokens
        self.sums[1, self.base : self.base + len(chars)] = chars
        self.n = len(tokens)
        level = self.base
        while level > 1:
            half = level // 2
            self.sums[:, half:level] = self.sums[:, level : 2 * level].reshape(2, half, 2).sum(2)
            level = half

    @property
    def total(self) -> int:
        return int(self.sums[0, 1])

    def leaf_at(self, char: int) -> tuple[int, int]:
        """The leaf that holds a character (the last with characters, if it is past the end), and where it starts."""
        i, start = 1, 0
        char = min(char, max(0, int(self.sums[1, 1]) - 1))
        while i < self.base:
            left = int(self.sums[1, 2 * i])
            if char - start < left:
                i = 2 * i
            else:
                start += left
                i = 2 * i + 1
        return i - self.base, start

    def put(self, leaf: int, tokens: int, chars: int) -> None:
        i = leaf + self.base
        change = (tokens - self.sums[0, i], chars - self.sums[1, i])
        while i:
            self.sums[0, i] += change[0]
            self.sums[1, i] += change[1]
            i //= 2

    def chars(self, leaf: int) -> int:
        return int(self.sums[1, leaf + self.base])


def leaves(text: str, leaf_chars: int = LEAF_CHARS) -> list[str]:
    """Cut a text at sure places, each leaf having leaf_chars or more characters but the last."""
    out, start = [], 0
    n = len(text)
    while n - start > leaf_chars:
        m = _PLACE.search(text, start + leaf_chars)
        if not m:
            break
        out.append(text[start : m.start()])
        start = m.start()
    out.append(text[start:])
    return out


def build(enc: Encoder, text: str, leaf_chars: int = LEAF_CHARS) -> Tree:
    parts = leaves(text, leaf_chars)
    tokens = np.array([len(x) // 4 for x in enc.encode_many(parts)], np.int64)
    return Tree(tokens, np.array([len(p) for p in parts], np.int64))


def usable(edits: list[tuple[int, int, str]], size: int) -> list[tuple[int, int, str]]:
    """Edits in order of their place, without those outside a text of that size or over an earlier one."""
    out, last = [], 0
    for start, end, new in sorted(edits):
        if last <= start <= end <= size:
            out.append((start, end, new))
            last = end
    return out


def apply(enc: Encoder, tree: Tree, text: str, edits: list[tuple[int, int, str]]) -> tuple[str, int]:
    """Apply edits (start, end, replacement) to the tree; the new text and the characters encoded again."""
    edits = usable(edits, len(text))
    parts, at = [], 0
    for start, end, new in edits:
        parts += [text[at:start], new]
        at = end
    done = "".join([*parts, text[at:]])
    shift, again = 0, 0
    for start, end, new in edits:
        s, e = start + shift, end + shift
        first, lo = tree.leaf_at(s)
        stop, hi = tree.leaf_at(max(s, e - 1))
        hi += tree.chars(stop)
        # once this edit is applied, the text is the new one up to edge, and from there the old one, moved by shift
        edge, shift = s + len(new), shift + len(new) - (end - start)
        hi += edge - e
        size = len(text) + shift

        def sure(p: int, edge: int = edge, shift: int = shift) -> bool:
            """Whether a non-space character stands before a space at p."""
            before, here = (done[q : q + 1] if q < edge else text[q - shift : q - shift + 1] for q in (p - 1, p))
            return bool(before.strip()) and here == " "

        while lo > 0 and not sure(lo):
            first -= 1
            lo -= tree.chars(first)
        while hi < size and not sure(hi):
            stop += 1
            hi += tree.chars(stop)
        region = done[lo:edge] + text[edge - shift : hi - shift]
        tree.put(first, len(enc.encode(region)) // 4, len(region))
        for leaf in range(first + 1, stop + 1):
            if tree.chars(leaf):
                tree.put(leaf, 0, 0)
        again += len(region)
    return done, again


STATE = "doc_id long, text string, n_tokens long, leaf_tokens binary, leaf_chars binary"


def _state(key, text: str, tree: Tree) -> tuple:
    b = tree.base
    return key, text, tree.total, tree.sums[0, b : b + tree.n].astype("<i4").tobytes(), tree.sums[1, b : b + tree.n].astype("<i4").tobytes()


def _batch(rows: list[tuple], more: dict | None = None) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [()] * 5
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.binary())
    data = {n: pa.array(c, t) for n, c, t in zip(("doc_id", "text", "n_tokens", "leaf_tokens", "leaf_chars"), cols, kinds, strict=True)}
    return pa.RecordBatch.from_pydict(data | (more or {}))


def count(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), tokenizer_path: str | None = None, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """State of each document: its text, its tokens and its leaves; columns to keep follow."""
    ship(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long"), F.col(text_col), *keep)
    extra = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[2:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                p = b.slice(at, 1024)
                rows = [_state(k, t or "", build(enc, t or "", leaf_chars)) for k, t in zip(p.column(0).to_pylist(), p.column(1).to_pylist(), strict=True)]
                yield _batch(rows, {n: p.column(i + 2) for i, n in enumerate(keep)})

    return src.mapInArrow(run, STATE + extra)


def update(state: DataFrame, edits_col: str = "edits", tokenizer_path: str | None = None) -> DataFrame:
    """Apply each row's array of edits <start, end, new> to its state: the new state, old_tokens, n_edits, chars_again."""
    ship(state.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                rows, old, n, again = [], [], [], []
                for r in b.slice(lo, 1024).to_pylist():
                    tree = Tree(np.frombuffer(r["leaf_tokens"], "<i4"), np.frombuffer(r["leaf_chars"], "<i4"))
                    edits = [(e["start"], e["end"], e["new"] or "") for e in r[edits_col] or () if e and e["start"] is not None and e["end"] is not None]
                    edits = usable(edits, len(r["text"]))
                    text, chars = apply(enc, tree, r["text"], edits)
                    rows.append(_state(r["doc_id"], text, tree))
                    old.append(r["n_tokens"])
                    n.append(len(edits))
                    again.append(chars)
                yield _batch(rows, {"old_tokens": pa.array(old, pa.int64()), "n_edits": pa.array(n, pa.int64()), "chars_again": pa.array(again, pa.int64())})

    return state.select("doc_id", "text", "n_tokens", "leaf_tokens", "leaf_chars", edits_col).mapInArrow(run, STATE + ", old_tokens long, n_edits long, chars_again long")


_PHONE = re.compile(r"\+\d[\d ().-]{6,}\d")
_MAIL = re.compile(r"[\w.+-]+@[\w-]+\.[\w.-]*\w")


def redactions(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add edits that put [phone] and [mail] in place of phone numbers and mail addresses."""
    ship(docs.sparkSession)

    def run(t: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in t:
            out = []
            for x in s:
                e = []
                if x and "+" in x:
                    e += [(m.start(), m.end(), "[phone]") for m in _PHONE.finditer(x)]
                if x and "@" in x:
                    e += [(m.start(), m.end(), "[mail]") for m in _MAIL.finditer(x)]
                out.append([{"start": a, "end": b, "new": n} for a, b, n in e])
            yield pd.Series(out)

    find = F.pandas_udf(run, "array<struct<start:int,end:int,new:string>>")
    return docs.withColumn("edits", find(F.col(text_col)))


def count_and_redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of each document before and after its redactions, and how much was encoded again for them."""
    src = redactions(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    after = update(count(src, keep=("edits",)))
    return after.select("doc_id", F.col("old_tokens").alias("n_tokens"), "n_edits", F.col("n_tokens").alias("n_tokens_after"), (F.octet_length("leaf_chars") / 4).cast("long").alias("n_leaves"), "chars_again", F.sha2("text", 256).alias("text_sha256"))
