"""Quality rules and URL filters: edge cases against plain Python, and their SQL on small tables."""

import re
from collections import Counter

import duckdb
import pandas as pd

import pytest

from confluo.llm import quality, url_filter


def plain(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    cover = {i + k for i in range(len(w) - 2) for k in range(3) if seen[tuple(w[i : i + 3])] > 1}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(cover)


TEXTS = [None, "", " \n\t", "one", "a b c", "a b c a b c", "x " * 400, "the of and to " * 30, "a\x0bb\x1fc é#é |", "l 1\nl 1\r\nl 1\n\nl 1", "word " * 20000, " lead and trail \n" * 3, "é" * 5000]


def test_quality_counts(spark):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(1, "one", "clash"), (None, "one", "clash")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality.judge(df).collect())
    assert got == sorted((str(k), *plain(t)) for k, t, _ in rows)
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.kept and r.base_failed) for r in quality.judge(df).collect())
    assert quality.judge(df.limit(0)).count() == 0
    assert quality.keep(df).columns == df.columns


URLS = [None, "", "no scheme", "http://", "HTTP://A.Example.ORG", "https://example.org/es/1", "https://x.example.org/en/12?a", "https://myexample.org/es/1", "https://EXAMPLE.org/en/2#x", "http://a.com/fr/1", "http://a.com/de/1", "http://a.com/de", "http://a.com/es/1", "x://b.net/p?q=http://c", "http://b.net#f/x", "a://b://c.org/z", "http://org/x", "http://a.com/de/\n2"]


def test_url_filter(spark):
    rows = [(i, u, "clash") for i, u in enumerate(URLS)] + [(3, "http://a.com/es/2", "clash"), (None, "http://a.com/de/5", "clash")]
    got = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, host string")).collect()
    pages = pd.DataFrame({"page_id": pd.array([r[0] for r in rows], "Int64"), "url": [r[1] for r in rows]})  # noqa: F841  read by DuckDB
    want = duckdb.sql(url_filter.SQL).fetchall()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))
    by = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got}
    assert by[5] == ("example.org", "/es/1", "example.org/es/", "block") and by[6][2:] == ("example.org/en/1", "block") and by[7][2:] == ("org/", "allow")
    assert by[8][2:] == ("org/", "allow") and by[9][2:] == ("com/fr/", "allow") and by[11][2] is None and by[0][:2] == ("", "") and by[13][:2] == ("b.net", "/p")
    assert url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, host string").limit(0)).count() == 0


def test_reputation_shrinks_by_spread_beyond_chance(spark):
    """Posterior means equal a plain version, and hosts under two-label suffixes have domains of their own."""
    from collections import defaultdict

    rows = [("a.x.co.uk", 9, 10), ("b.x.co.uk", 1, 10), ("c.y.co.uk", 5, 10), ("d.z.com", 30, 30), ("z.com", 0, 20), ("e.w.com", 7, 40), ("localhost", 1, 1)]
    got = url_filter.reputation(spark.createDataFrame(rows, "host string, good long, n long"))
    mean = {k: {r.key: r["mean"] for r in df.collect()} for k, df in got.items()}

    def cut(host, more):
        parts = host.split(".")
        n = (2 if ".".join(parts[-2:]) in url_filter.SECOND_LEVEL else 1) + more
        return ".".join(parts[-n:])

    levels = [[(h, cut(h, 1), g, n) for h, g, n in rows]]
    for more in (0, None):
        add = defaultdict(lambda: [0, 0])
        for _, up, g, n in levels[-1]:
            add[up][0] += g
            add[up][1] += n
        levels.append([(k, "" if more is None else cut(k, more), g, n) for k, (g, n) in add.items()])
    above = {"": (sum(g for *_, g, _ in levels[0]) + 1) / (sum(n for *_, n in levels[0]) + 2)}
    for name, level in (("suffix", levels[2]), ("domain", levels[1]), ("host", levels[0])):
        u = [above[up] for _, up, _, _ in level]
        extra = sum(n * (g / n - x) ** 2 for (_, _, g, n), x in zip(level, u, strict=True)) - sum(x * (1 - x) for x in u)
        rho = extra / sum((n - 1) * x * (1 - x) for (*_, n), x in zip(level, u, strict=True))
        k = max(1.0, min(1000.0, 1 / rho - 1 if rho > 0 else 1000.0))
        above = {key: (g + k * x) / (n + k) for (key, _, g, n), x in zip(level, u, strict=True)}
        assert mean[name] == pytest.approx(above)
    assert set(mean["domain"]) == {"x.co.uk", "y.co.uk", "z.com", "w.com", "localhost"} and set(mean["suffix"]) == {"co.uk", "com", "localhost"}
