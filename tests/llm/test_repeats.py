"""Repeated byte strings against counting every string of so many bytes."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from confluo.llm import repeats


def plain(rows, threshold=200):
    raw = [(r[0], (r[1] or "").encode()) for r in rows]
    count = Counter(t[i : i + threshold] for _, t in raw for i in range(len(t) - threshold + 1))
    out = []
    for key, t in raw:
        cover = np.zeros(len(t) + 2, bool)
        for i in range(len(t) - threshold + 1):
            if count[t[i : i + threshold]] > 1:
                cover[i + 1 : i + threshold + 1] = True
        kept = bytes(b for b, c in zip(t, cover[1:], strict=False) if not c)
        out.append((key, len(t), int(cover.sum()), int((cover[1:] & ~cover[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(map(str, out))


def prose(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def corpus(seed):
    rng = random.Random(seed)
    passages = [prose(rng, n) for n in (30, 40, 60, 66, 90, 200)]
    out = []
    for i in range(60):
        parts = [prose(rng, rng.randrange(60))]
        for _ in range(rng.randrange(4)):
            p = rng.choice(passages)
            a = rng.randrange(len(p) // 2)
            parts += [rng.choice([p, p[a:], p[: -a - 1], p[a : a + 203]]), prose(rng, rng.randrange(40), 9)]
        out.append((i, "".join(parts)))
    long = prose(rng, 3000)
    out += [(100, long), (101, long[:7000] + "X" + long[7001:]), (102, long[5:]), (103, None), (104, ""), (105, "a" * 199), (106, "a" * 450), (107, "ab" * 300), (108, "é" * 150), (109, "漢字かな" * 40), (None, passages[0]), (100, long), (110, passages[5] + "|" + passages[5])]
    return [(k, t, "clash") for k, t in out]


@pytest.mark.parametrize("seed", [1, 2])
def test_spans(spark, monkeypatch, seed):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string, n_bytes string").repartition(6)
    got = sorted(str(tuple(r)) for r in repeats.spans(df, batch_bytes=20_000).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())
    assert got == plain(rows)


def test_other_depths_and_slices(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SLICE_BYTES", 777)
    rows = corpus(3)
    data, starts = b"".join((r[1] or "").encode() for r in rows), np.cumsum([0, *(len((r[1] or "").encode()) for r in rows)])
    a, low, high = repeats.blocks(data, starts)
    # every suffix that is long enough is in one block, and its anchor depends on its bytes alone
    seen, far = Counter(), {}
    for x, lo, hi in zip(a.tolist(), low.tolist(), high.tolist(), strict=True):
        for d in range(lo, hi + 1):
            seen[x - d] += 1
            assert far.setdefault(data[x - d : x - d + 200], d) == d
    assert seen == Counter(p for s, e in zip(starts, starts[1:], strict=False) for p in range(s, e - 199))
    df = spark.createDataFrame(rows, "doc_id long, text string, n_bytes string")
    for threshold, widths in ((40, (32, 4, 1)), (33, (16, 1)), (200, (1,))):
        assert sorted(str(tuple(r)) for r in repeats.spans(df, threshold=threshold, widths=widths).collect()) == plain(rows, threshold)


def test_empty_table(spark):
    assert repeats.spans(spark.createDataFrame([], "doc_id string, text string")).count() == 0
    with pytest.raises(ValueError):
        repeats.spans(spark.createDataFrame([], "doc_id string, text string"), widths=(128, 3, 1))
