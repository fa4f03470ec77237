"""Context-tree weighting against a tree walked node by node, and the baseline against its formula."""

import math
import random
import re
from collections import Counter
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from confluo.llm import lm


def brute(train, texts, depth=3):
    """Scores by recursion over contexts with math.lgamma."""
    n = Counter()
    for t in train:
        data = b"\0" * depth + t.encode() + b"\0"
        for i in range(depth, len(data)):
            for k in range(8):
                node, bit = (1 << k) | (data[i] >> (8 - k)), data[i] >> (7 - k) & 1
                for d in range(depth + 1):
                    n[node, data[i - d : i], bit] += 1
    kids = {}
    for node, ctx, _ in n:
        if ctx:
            kids.setdefault((node, ctx[1:]), set()).add(ctx)

    def block(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    @cache
    def weighted(node, ctx):
        kt = block(n[node, ctx, 0], n[node, ctx, 1])
        if len(ctx) == depth:
            return kt, 1.0
        below = sum(weighted(node, c)[0] for c in kids.get((node, ctx), ()))
        top = max(kt, below)
        w = top + math.log(math.exp(kt - top) + math.exp(below - top)) - math.log(2)
        return w, math.exp(kt - math.log(2) - w)

    def prob(node, ctx, d, bit):
        own = ctx[depth - d :] if d else b""
        kt = (n[node, own, bit] + 0.5) / (n[node, own, 0] + n[node, own, 1] + 1)
        if d == depth:
            return kt
        stay = weighted(node, own)[1]
        return stay * kt + (1 - stay) * prob(node, ctx, d + 1, bit)

    out = []
    for t in texts:
        data, s = b"\0" * depth + t.encode() + b"\0", 0.0
        for i in range(depth, len(data)):
            for k in range(8):
                s += math.log10(prob((1 << k) | (data[i] >> (8 - k)), data[i - depth : i], 0, data[i] >> (7 - k) & 1))
        out.append(s)
    return out


def test_scores(spark):
    r = random.Random(4)
    bits = ["the", "tion", " ", "\n", "é", "A", ".", "\x1c", "x"]
    rows = [(i, "".join(r.choices(bits, k=r.choice([0, 1, 5, 60])))) for i in range(40)] + [(None, None), (3, "the the"), (3, "the the"), (99, "unseen zzz")]
    df = spark.createDataFrame([(*x, "clash") for x in rows], "doc_id long, text string, batch string")
    got = {(x.doc_id, x.n_bytes, round(x.score, 6), x.held_out, x.n_tokens, x.n_known, round(x.base_score, 6)) for x in lm.evaluate(df).collect()}
    import zlib

    def held(k):
        return k is not None and zlib.crc32(str(k).encode()) % 7 == 2

    train = [t or "" for k, t in rows if not held(k)]
    assert len(train) < len(rows)
    tok = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [""] for _, t in rows]
    c = Counter(w for (k, _), ws in zip(rows, tok, strict=True) if not held(k) for w in ws)
    total, v = sum(c.values()), len(c)
    want = set()
    for (k, t), ws, s in zip(rows, tok, brute(train, [t or "" for _, t in rows]), strict=True):
        base = sum(math.log10((c[w] + 1) / (total + v + 1)) for w in ws)
        want.add((k, len((t or "").encode()) + 1, round(s, 6), held(k), len(ws), sum(c[w] > 0 for w in ws), round(base, 6)))
    assert got == want
    assert lm.evaluate(df.limit(0)).count() == 0


def test_probabilities_sum_to_one():
    codes = np.unique(lm.grams(["the thing then", "this"])[0]).astype(np.int64)
    n = np.arange(1, len(codes) + 1)
    groups = lm.part_of(codes, 3, 64)
    up = [lm.Trees(codes[groups == p], n[groups == p], 3).up() for p in np.unique(groups)]
    three = pd.concat([t.to_pandas() for t in up]).groupby(["pair", "node"], as_index=False).sum()
    two = lm.pairs(pa.Table.from_pandas(three, preserve_index=False))
    top = lm.shallow(two.column("pair").to_numpy() >> 8, *(two.column(c).to_numpy() for c in ("node", "n0", "n1", "w")))
    ctx = int(codes[5] >> 8)
    every = np.array([ctx << 8 | b for b in range(256)], np.int64)
    have = dict(zip(codes.tolist(), n.tolist(), strict=True))
    same = codes[codes >> 16 == ctx >> 8]
    all_codes = np.union1d(every, same)
    v = lm.Trees(all_codes, np.array([have.get(int(c), 0) for c in all_codes]), 3).values(top, lm.in_order(two), 3)
    assert sum(10 ** v[np.isin(all_codes, every)]) == pytest.approx(1)


def test_a_common_pair_of_bytes_is_dealt_out():
    codes = np.unique(lm.grams([f"re{a}{b} {b}re " for a in "abcdefghijklmnop" for b in "qrstuvwxyz "], 6)[0])
    near = codes >> 40 == ord("e") << 8 | ord("r")
    part, third = lm.part_of(codes, 6, 512), codes >> 32 & 255
    assert near.sum() > 20 and len(set(part[near].tolist())) > 2 and len(set((part[near] // lm.SPLIT).tolist())) == 1
    for k in np.unique(codes >> 32).tolist():  # grams that share three bytes stay together
        assert len(set(part[codes >> 32 == k].tolist())) == 1
    assert part.max() < 512 and lm.part_of(codes, 6, 5).max() < 5 and len(set(third[near].tolist())) > 2


def test_merging_by_ranges():
    r = np.random.default_rng(2)
    each = [np.unique(r.integers(0, 1 << 22, n)) for n in (150_000, 9, 300_000, 0)]
    counts = [r.integers(0, 5, len(c)) for c in each]
    for a, b in zip(lm.merged(each, counts), lm.total(each, counts), strict=True):
        assert (a == b).all()
    assert len(lm.merged([], [])[0]) == 0


def test_packing():
    r = np.random.default_rng(1)
    for n in (1, 2, 1000):
        codes, values = np.unique(r.integers(0, 1 << 56, n)), r.random(n)
        codes = codes[: len(values)]
        c, v = lm.unpack(lm.pack(codes, values[: len(codes)]), np.float64)
        assert (c == codes).all() and (v == values[: len(codes)]).all()
        c, v = lm.unpack(lm.pack(codes, codes * 3))
        assert (v == codes * 3).all()
    x = -r.random(1000) * 9
    assert np.abs(lm.short(x) / x - 1).max() < 1e-11
    assert lm.unpack_words(lm.pack_words([" ", "é", "b"], [0, 1, 1 << 40]), 3) == ([" ", "é", "b"], [0, 1, 1 << 40])
    u, n = lm.total([np.array([1, 5]), np.array([1, 2])], [np.array([1, 1]), np.array([4, 0])])
    assert u.tolist() == [1, 2, 5] and n.tolist() == [5, 0, 1]


def test_any_unicode_in_small_batches_and_shares(spark):
    """Random characters of all planes, long texts, many batches, few groups, several tasks for each group."""
    r = random.Random(7)
    texts = ["".join(chr(r.choice([r.randrange(32, 127), r.randrange(0x80, 0x800), r.randrange(0x4E00, 0x9FFF), r.randrange(0x1F300, 0x1F650)])) for _ in range(r.choice([0, 3, 50]))) for _ in range(30)]
    texts.append("long " * 400 + "\0end")
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    import zlib

    train = [t for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 7 != 2]
    got = lm.score(df, lm.fold("doc_id", 7) != 2, batch_bytes=300, parts=5, share=50, depth=5).collect()
    assert len(got) == len(texts)
    want = brute(train, texts, 5)
    for x in got:
        assert x.score == pytest.approx(want[x.doc_id], rel=1e-8)


def test_depth(spark):
    """The next word hangs on a byte that lies beyond three bytes; scores equal the node-by-node version."""
    import zlib

    texts = ["".join(f"{'abcdefgh'[(i + j) % 8]}ing " for j in range(20)) for i in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    train = [t for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 7 != 2]
    total = {}
    for depth in (3, 6):
        got = lm.evaluate(df, depth=depth).collect()
        assert {x.doc_id: round(x.score, 6) for x in got if x.doc_id < 9} == {i: round(s, 6) for i, s in enumerate(brute(train, texts[:9], depth))}
        total[depth] = sum(x.score for x in got if x.held_out)
    assert total[6] > sum(x.base_score for x in got if x.held_out) / 2 > total[3]
