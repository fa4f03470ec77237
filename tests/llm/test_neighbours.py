"""NN-descent against all cosines."""

import numpy as np

from confluo.llm import neighbours


def test_equals_all_pairs(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=(300, 16))
    for g in range(12):
        at = slice(20 * g, 20 * g + 5 + g)
        x[at] = x[20 * g] + r.normal(scale=0.12, size=x[at].shape)
    x[250:255] = x[249]
    rows = [(i, [float(v) for v in a], "clash") for i, a in enumerate(x)]
    odd = [(900, None), (901, [0.0] * 16), (902, [float("nan"), *[1.0] * 15]), (903, [None, *[1.0] * 15]), (904, []), (905, [1.0, 2.0]), (906, [2.0, 4.0]), (5, rows[5][1]), (907, [float("inf"), *[1.0] * 15])]
    rows += [(*o, "clash") for o in odd]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, node string")
    good = [(k, np.array(v)) for k, v, _ in rows if v and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    links, root = {i: 0 for i in range(len(good))}, list(range(len(good)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i, (_, a) in enumerate(good):
        for j in range(i):
            b = good[j][1]
            if len(a) == len(b) and a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= 0.9:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    low = {}
    for i, (k, _) in enumerate(good):
        low[find(i)] = min(low.get(find(i), k), k)
    want = sorted([(k, links[i], low[find(i)]) for i, (k, _) in enumerate(good)] + [(k, 0, k) for k in (900, 901, 902, 903, 904, 907)])
    for block in (1024, 4):
        got = neighbours.near_duplicates(df, bucket=16, block=block).collect()
        assert sorted((g.vec_id, g.n_links, g.component_id) for g in got) == want
    assert neighbours.near_duplicates(df.limit(0)).count() == 0


def linked(x):
    """(links, least id of the component) of each row by all cosines."""
    u = x / np.sqrt((x * x).sum(1))[:, None]
    on = u @ u.T >= 0.9
    low = np.arange(len(x))
    while True:
        new = np.where(on, low[None, :], len(x)).min(1)
        if (new == low).all():
            return [(i, int(n) - 1, int(c)) for i, (n, c) in enumerate(zip(on.sum(1), low, strict=True))]
        low = new


def table(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in a]) for i, a in enumerate(x)], "vec_id long, embedding array<double>")


def found(df, **options):
    return sorted((g.vec_id, g.n_links, g.component_id) for g in neighbours.near_duplicates(df, **options).collect())


def test_links_between_tight_subgroups(spark, monkeypatch):
    """Each list fills with a vector's own subgroup of 12 (cosines about 0.99); subgroups of a group are linked too."""
    monkeypatch.setattr(neighbours, "AUDIT", 0)  # the descent alone
    r = np.random.default_rng(7)
    tops = r.normal(size=(10, 1, 1, 64))
    x = (tops + r.normal(scale=0.2, size=(10, 4, 1, 64)) + r.normal(scale=0.05, size=(10, 4, 12, 64))).reshape(-1, 64)
    want = linked(x)
    assert len({c for _, _, c in want}) == 10 and min(n for _, n, _ in want) > 12
    assert found(table(spark, x), tries=1) == want


def test_large_group_does_not_hide_lost_pairs(spark):
    """One tree and no rounds lose pairs, which are few among all links beside one large group."""
    r = np.random.default_rng(8)
    one = r.normal(size=32)
    big = one + r.normal(scale=0.1, size=(500, 32))
    single = r.normal(size=(500, 32))
    pair = single[:400] + r.normal(scale=0.38, size=(400, 32))
    x = np.concatenate([big, single, pair])
    assert found(table(spark, x), trees=1, bucket=16, rounds=0, tries=2) == linked(x)
