"""Packing against its contract and against a piece-by-piece version of the plan."""

import random
import zlib
from collections import Counter

import numpy as np
from tokenizers import Tokenizer

from confluo.llm import bpe, packing


def one_by_one(counts, cap):
    """Bins as sorted lists, planned a bin at a time with plain lists."""
    left, bins = sorted(n for n, k in counts.items() for _ in range(k)), []
    while left:
        bin_, rest, gap = [], left[:], cap
        for x in sorted(left, reverse=True):
            if x <= gap:
                bin_.append(x)
                rest.remove(x)
                gap -= x
        if gap and len(bin_) > 1:
            wide = gap + bin_[-1]
            pairs = [(x + y) for i, x in enumerate(rest) for y in rest[i + 1 :] if bin_[-1] < x + y <= wide]
            if pairs:
                best = max(pairs)
                x, y = max(((x, y) for i, x in enumerate(rest) for y in rest[i + 1 :] if x + y == best), key=lambda p: -min(p))
                rest.append(bin_.pop())
                rest.remove(x)
                rest.remove(y)
                bin_ += [x, y]
        bins.append(sum(bin_))
        left = sorted(rest)
    return bins


def test_plan_equals_one_by_one():
    r = random.Random(1)
    for _ in range(60):
        cap = r.choice([10, 37, 64])
        counts = dict(Counter(r.randint(1, cap) for _ in range(r.randint(0, 60))))
        table, n = packing.plan(counts, cap)
        assert n == len(one_by_one(counts, cap))


def test_pack(spark):
    r = random.Random(2)
    words = ["the", "of", "thing", "reed", "\n", "é", "42", "thton"]
    rows = [(i, " ".join(r.choices(words, k=r.choice([0, 3, 40, 900, 3000]))), "clash") for i in range(60)]
    rows += [(5, None, "clash"), (None, "", "clash"), (7, rows[7][1], "clash"), (7, rows[7][1], "clash")]
    df = spark.createDataFrame(rows, "doc_id long, text string, length string")
    got = packing.pack(df).collect()
    lib = Tokenizer.from_file(bpe.default_path())
    want = Counter()
    for k, t, _ in rows:
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 2]
        first = len(ids) if len(ids) <= 1024 else len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for j, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[k, j, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((x.doc_id, x.piece, x.start, x.length, x.ids_crc32) for x in got) == want
    bins = {}
    for x in got:
        bins.setdefault(x.sequence_id, []).append((x.offset, x.length))
    for b in bins.values():
        at = 0
        for o, n in sorted(b):
            assert o == at
            at += n
        assert at <= 1024
    total = sum(x.length for x in got)
    assert len(bins) <= -(-total // 1024) * 1.1 + 1
    assert packing.pack(df.limit(0)).count() == 0
