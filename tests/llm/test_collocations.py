"""Collocations against counting every phrase in Python; tiles, parts and rounds of merging forced small."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest

from confluo.llm import collocations

SCHEMA = "doc_id long, text string, lang string, rank string"


def plain(rows, least=10, longest=3, top=2000):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f = defaultdict(Counter)
    for r in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (r[1] or "").translate(lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, longest + 1):
                f[r[2] or "und"].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        n = sum(v for p, v in c.items() if len(p) == 1)
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        over = Counter()
        for p, a in cand.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    over[p[i : i + m]] = max(over[p[i : i + m]], a)
        found = []
        for p, a in cand.items():
            if not over[p] or 100 * over[p] < 50 * a:
                s, k = min((1_000_000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                found.append((-s, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)]
    return sorted(map(str, out))


def corpus(seed, n=150):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.9))}" for _ in range(4000)] + ["New", "York", "new", "é", "É", "\x85x", "a\x1cb", "\x00", "City"] * 20
    out = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(120)):
            parts.append(rng.choice(["New York City", "new\tyork", "w1 w2 w3 w4", *(rng.choice(words) for _ in range(4))]))
            parts.append(rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", "?! "]))
        out.append((i, "".join(parts), rng.choice(["en", "en", "de", None, "und"]), "clash"))
    return [*out, (1, None, "en", "clash"), (2, "", "xx", "clash"), (3, "one two three", "xy", "clash"), (None, "over and " * 5000, "de", "clash"), *out[:2]]


@pytest.mark.parametrize("small", [False, True])
def test_collocations(spark, monkeypatch, small):
    options = {}
    if small:
        monkeypatch.setattr(collocations, "TILE", 16)
        options = {"share": 40, "merge": 160, "batch_bytes": 5000}
    rows = corpus(1 + small)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = sorted(str(tuple(r)) for r in collocations.collocations(df, **options).collect())
    assert len(got) > 100 and got == plain(rows)
    if not small:
        documents = pd.DataFrame([r[:3] for r in rows if "\x00" not in (r[1] or "")], columns=["doc_id", "text", "lang"]).astype({"doc_id": "Int64"})  # noqa: F841  read by DuckDB
        assert sorted(map(str, duckdb.sql(collocations.SQL).fetchall())) == plain([r for r in rows if "\x00" not in (r[1] or "")])


def test_longer_phrases_and_limits(spark):
    rows = corpus(5)
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(str(tuple(r)) for r in collocations.collocations(df, least=6, longest=4, top=25).collect())
    assert got == plain(rows, 6, 4, 25)
    assert collocations.collocations(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        collocations.collocations(df, share=100, merge=100)


def test_tiles():
    rng = np.random.default_rng(0)
    x = np.r_[0, 1023, 1024, 2047, 2048, 4095, 4096, rng.integers(0, 1 << 36, 1000)]
    y = np.r_[rng.integers(0, 1 << 27, len(x) - 3), 0, 1023, 1024]
    tile, address = collocations.tiled(x, y)
    for k in np.unique(tile).tolist():
        on = tile == k
        i, j = collocations.untiled(k, address[on])
        assert (i == x[on]).all() and (j == y[on]).all() and (address[on] < collocations.cells(k)).all() and (address[on] >= 0).all()
    # dense and sparse counts agree, weighted or not
    a = rng.integers(0, 1 << 20, 200_000)
    u, n = collocations.summed(0, [a])
    assert (np.unique(a) == u).all() and n.sum() == len(a)
    for few in (u[:50], u):
        v, m = collocations.summed(0, [few, few], [n[: len(few)], n[: len(few)]])
        assert (v == few).all() and (m == 2 * n[: len(few)]).all()
