"""Byte-level BPE: encoding by tree concatenation, decoding, and the cached encoder that other operators use.

Edge cases: a null text is an empty one; an empty text has no ids. The special token's string in a text becomes its
one id, as the tokenizers library does. Rows with equal or null ids stay rows of their own; other columns are ignored. A very
long text is encoded by many tasks and put together by one; an empty table gives no rows; ids must be whole numbers or
text of one (others raise an error), or null.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from confluo.llm.common import ship

#: Characters from which a document is cut into leaves that are encoded in different tasks.
LEAF_CHARS = 16384
#: Characters of one unsplit run that are encoded at once; longer runs are halved.
RUN_CHARS = 512
#: Entries of a worker's chunk cache; when full it starts anew, results stay the same.
CACHE_ENTRIES = 200_000
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _kind(c: str) -> int:
    """0 white space, 1 letter, 2 number, 3 other: the classes that the split pattern knows."""
    if c.isspace():
        return 0
    if c.isalpha():
        return 1
    return 2 if c.isnumeric() else 3


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes, equal to the tokenizers library's.

    A place where a non-space character stands before a space always ends a pre-token, so the pieces of
    text.split(" ") can be encoded apart, and a cache of pieces serves most of a corpus.
    """

    def __init__(self, path: str | None = None):
        import tiktoken

        with open(path or default_path(), encoding="utf-8") as f:
            spec = json.load(f)
        back = _byte_of()
        special = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
        ranks = {bytes(back[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        plain = spec["normalizer"] is None and spec["pre_tokenizer"]["type"] == "ByteLevel" and not spec["pre_tokenizer"]["add_prefix_space"]
        merged = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        if not plain or any(ranks[bytes(back[c] for c in a + b)] != 256 + i for i, (a, b) in enumerate(merged)):
            raise ValueError("a byte-level BPE vocabulary in merge order, without normalizer, is needed")
        self.special = {t: np.array([i], "<u4").tobytes() for t, i in special.items()}
        self.bytes_of = dict.fromkeys(range(max([*ranks.values(), *special.values()]) + 1), b"")
        self.bytes_of |= {i: t for t, i in ranks.items()} | {i: t.encode() for t, i in special.items()}
        self.length = np.array([len(self.bytes_of[i]) for i in range(len(self.bytes_of))], np.int64)
        self._encode = tiktoken.Encoding("own", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.cache: dict[str, bytes] = {}

    # -- whole texts -------------------------------------------------------------------------------------------
    def encode_many(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text, in order."""
        for at in range(0, len(texts), 512):
            some = [t or "" for t in texts[at : at + 512]]
            parts = [t.split(" ") for t in some]
            cache = self.cache
            missing = {w for p in parts for w in p if w not in cache}
            if missing:
                if len(cache) > CACHE_ENTRIES:
                    cache.clear()
                    missing = {w for p in parts for w in p}
                self._learn(missing)
            for t, p in zip(some, parts, strict=True):
                try:
                    rest = b"".join(map(cache.__getitem__, p[1:]))
                except KeyError:
                    yield self.encode(t)
                    continue
                yield self._first(p[0]) + rest

    def encode(self, text: str | None) -> bytes:
        text = text or ""
        for token, ids in self.special.items():
            if token in text:
                return ids.join(self.encode(x) for x in text.split(token))
        return self.direct(text)

    def direct(self, text: str) -> bytes:
        """Encode at once, or by tree concatenation if a long run of one class is in the text."""
        if len(text) <= RUN_CHARS:
            return np.array(self._encode(text), "<u4").tobytes()
        if max(map(len, text.split())) <= RUN_CHARS if not text.isspace() else False:
            return np.array(self._encode(text), "<u4").tobytes()
        return self.tree(text)

    def _first(self, part: str) -> bytes:
        return self.encode(part) if part else b""

    def _learn(self, parts: set[str]) -> None:
        """Put " " + part into the cache for all parts that may stand alone there."""
        odd = [w for w in parts if not w or len(w) > 64 or w[-1].isspace() or "<|" in w]
        good = list(parts.difference(odd)) if odd else list(parts)
        if not good:
            return
        ids = np.array(self._encode(" " + " ".join(good)), "<u4")
        ends = np.cumsum(self.length[ids])
        sizes = np.fromiter((len(w.encode()) for w in good), np.int64, len(good))
        stops = (np.searchsorted(ends, np.cumsum(sizes + 1)) + 1).tolist()
        raw, start, cache = ids.tobytes(), 0, self.cache
        for w, stop in zip(good, stops, strict=True):
            cache[w] = raw[4 * start : 4 * stop]
            start = stop

    # -- tree concatenation ------------------------------------------------------------------------------------
    def tree(self, text: str, leaf: int = RUN_CHARS) -> bytes:
        """Encode halves and join them; exact for any text."""
        if len(text) <= leaf:
            return np.array(self._encode(text), "<u4").tobytes()
        half = len(text) // 2
        a, b = text[:half], text[half:]
        return self.join(a, self.tree(a, leaf), b, self.tree(b, leaf))

    def join(self, left: str, left_ids: bytes, right: str, right_ids: bytes) -> bytes:
        """Ids of left + right from the ids of both: re-encode a growing window around the join until both sides agree.

        A side agrees if the window ends at a sure pre-token boundary, or if, inside one long run, the window's
        outermost token is the one that the side had there: then every two neighbours in the result were neighbours
        in a valid encoding, which makes the whole a valid one.
        """
        if not left or not right:
            return left_ids + right_ids
        li, ri, w = np.frombuffer(left_ids, "<u4"), np.frombuffer(right_ids, "<u4"), 16
        while True:
            a, sure_a = self._cut(left, w, -1)
            b, sure_b = self._cut(right, w, 1)
            na = len(left[a:].encode())
            nb = len(right[:b].encode())
            ka = int(np.searchsorted(np.cumsum(self.length[li[::-1]][: na + 1]), na)) + 1 if na else 0
            kb = int(np.searchsorted(np.cumsum(self.length[ri[: nb + 1]]), nb)) + 1 if nb else 0
            if not sure_a or not sure_b:
                # inside a run: move the window's ends to token ends that are also character ends
                a, ka, good_a = self._to_token(left, li, a, ka, -1) if not sure_a else (a, ka, True)
                b, kb, good_b = self._to_token(right, ri, b, kb, 1) if not sure_b else (b, kb, True)
                if not (good_a and good_b):
                    w *= 2
                    continue
            win = np.array(self._encode(left[a:] + right[:b]), "<u4")
            if (sure_a or win[0] == li[len(li) - ka]) and (sure_b or win[-1] == ri[kb - 1]):
                return li[: len(li) - ka].tobytes() + win.tobytes() + ri[kb:].tobytes()
            w *= 2

    @staticmethod
    def _cut(text: str, w: int, side: int) -> tuple[int, bool]:
        """The place nearest to the join, at most w characters away, that surely ends a pre-token; else w away."""
        n = len(text)
        places = range(n - 1, max(0, n - w), -1) if side < 0 else range(1, min(n, w))
        for p in places:
            x, y = text[p - 1], text[p]
            kx = _kind(x)
            if kx and x != "'" and kx != _kind(y):
                # to the right, what stands before must not hang on the join: one whole pre-token lies between
                return p, True
        if n <= w:
            return (0, True) if side < 0 else (n, True)
        return (n - w, False) if side < 0 else (w, False)

    def _to_token(self, text: str, ids: np.ndarray, at: int, k: int, side: int) -> tuple[int, int, bool]:
        """From character at outward to the next token end that is a character end, inside the same run."""
        n = len(text)
        run = _kind(text[-1] if side < 0 else text[0])
        while k < len(ids):
            size = int(self.length[ids[len(ids) - k :] if side < 0 else ids[:k]].sum())
            raw = text.encode()
            piece = raw[len(raw) - size :] if side < 0 else raw[:size]
            edge_ok = (raw[len(raw) - size] & 0xC0) != 0x80 if side < 0 else (raw[size] & 0xC0) != 0x80
            if edge_ok:
                chars = len(piece.decode())
                same = all(_kind(c) == run for c in (text[n - chars - 1 :] if side < 0 else text[: chars + 1]))
                return (n - chars if side < 0 else chars), k, same
            k += 1
        return 0, 0, False

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


_encoders: dict[str | None, Encoder] = {}


def encoder(path: str | None = None) -> Encoder:
    """This worker's encoder."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _digests(enc: Encoder, ids: bytes) -> tuple[int, str, str]:
    return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(enc.decode(ids).encode()).hexdigest()


_OUT = pa.schema([("id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_path: str | None = None, with_ids: bool = False, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """One row per document: id, n_tokens, digests of ids and of the decoded text; with_ids adds ids and decoded.

    Documents of up to leaf_chars are encoded where they are read. Longer ones are cut into leaves that are dealt to
    all tasks and encoded in parallel; one task then joins a document's leaves pairwise, re-encoding only windows
    around the joins. One document's ids meet in one task because a digest needs them in order.
    """
    ship(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    special = F.contains(F.col("text"), F.lit("<|endoftext|>"))
    whole = (F.length("text") <= leaf_chars) | special
    out = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids binary, decoded string" if with_ids else "")

    def rows(enc: Encoder, keys: list, encoded: list[bytes]) -> pa.RecordBatch:
        d = [_digests(enc, x) for x in encoded]
        cols = [pa.array(keys, pa.int64()), pa.array([x[0] for x in d], pa.int64()), pa.array([x[1] for x in d]), pa.array([x[2] for x in d])]
        names = _OUT.names
        if with_ids:
            cols += [pa.array(encoded, pa.binary()), pa.array([enc.decode(x) for x in encoded])]
            names = [*names, "ids", "decoded"]
        return pa.RecordBatch.from_arrays([c.cast(pa.string()) if pa.types.is_null(c.type) else c for c in cols], names)

    def encode_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        for b in batches:
            keys, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            texts = [t if not any(s in t for s in enc.special) else t for t in texts]
            for at in range(0, len(keys), 1024):
                yield rows(enc, keys[at : at + 1024], list(enc.encode_many(texts[at : at + 1024])))

    def encode_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        for b in batches:
            yield b.append_column("ids", pa.array(list(enc.encode_many(b.column("leaf").to_pylist())), pa.binary()))

    def join_leaves(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        enc = encoder(tokenizer_path)
        t = t.sort_by("pos")
        level = list(zip(t.column("leaf").to_pylist(), t.column("ids").to_pylist(), strict=True))
        while len(level) > 1:
            pairs = [(a[0] + b[0], enc.join(*a, *b)) for a, b in zip(level[::2], level[1::2], strict=False)]
            level = pairs + ([level[-1]] if len(level) % 2 else [])
        return pa.Table.from_batches([rows(enc, [t.column("id")[0].as_py()], [level[0][1]])])

    short = src.where(whole).mapInArrow(encode_whole, out)
    # a row key of its own, so that two documents with one id stay apart
    cut = F.transform(F.sequence(F.lit(0), ((F.length("text") - 1) / leaf_chars).cast("int")), lambda i: F.substr(F.col("text"), i * leaf_chars + 1, F.lit(leaf_chars)))
    leaves = src.where(~whole).withColumn("row", F.monotonically_increasing_id()).select("id", "row", F.posexplode(cut).alias("pos", "leaf"))
    long = leaves.repartition("row", "pos").mapInArrow(encode_leaves, "id long, row long, pos int, leaf string, ids binary").groupBy("row").applyInArrow(join_leaves, out)
    return short.unionByName(long)
