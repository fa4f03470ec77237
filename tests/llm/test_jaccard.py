"""The chosen-path join against all pairs compared one by one."""

import random

from confluo.llm import jaccard


def brute(rows):
    sets = []
    for _, t in rows:
        w = (t or "").split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and len(a & b) >= 0.8 * len(a | b):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    low = {}
    for i, (k, _) in enumerate(rows):
        low.setdefault(find(i), []).append(k)
    return sorted((k, min(low[find(i)]), links[i]) for i, (k, _) in enumerate(rows))


def corpus(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choices("abcde", k=3))
    shared = [word() for _ in range(60)]
    rows, k = [], 0
    for g in range(45):
        base = [word() for _ in range(r.choice([6, 40, 120]))]
        if g % 3 == 0:
            base += shared
        for _ in range(r.choice([1, 2, 3, 40 if g == 0 else 4])):
            w = base[:]
            for _ in range(r.choice([0, 0, 1, 1, 2])):
                w[r.randrange(len(w))] = word()
            k += 1
            rows.append((k, " ".join(w)))
    return [*rows, (k + 1, None), (k + 2, ""), (k + 3, "one two"), (k + 4, "one two"), (k + 5, " \n"), (5, rows[4][1])]


def test_equals_all_pairs(spark):
    rows = corpus(1)
    df = spark.createDataFrame([(*x, "clash") for x in rows], "doc_id long, text string, h string")
    for leaf, block in ((400, 1024), (4, 8)):
        got = jaccard.join(df, leaf=leaf, block=block)
        assert sorted((x.doc_id, x.class_id, x.n_links) for x in got.collect()) == brute(rows)
    assert jaccard.join(df.limit(0)).count() == 0


def test_runs_go_on_until_the_estimate_is_reached(spark, monkeypatch):
    """With one run in a round, two rounds lose pairs; copies of one linked pair must not raise the tolerance."""
    import random

    from confluo.llm import jaccard

    monkeypatch.setattr(jaccard, "RUNS", 1)
    r = random.Random(1)
    rows = []
    for i in range(300):
        w = [f"w{r.randrange(10**6)}" for _ in range(60)]
        other = [*w[:30], "other", *w[31:]]
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(other))]
    rows += [(1000 + k, rows[k % 2][1]) for k in range(400)]
    got = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string")).where("doc_id < 600").collect()
    assert sum(x.n_links == 0 for x in got) <= 2
