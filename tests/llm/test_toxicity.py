"""Positive-unlabelled learning on planted words and glued stems, its risk against a plain version, and edge cases."""

import math
import random
import re

import numpy as np
import pytest

from confluo.llm import toxicity


def corpus():
    r = random.Random(1)
    plain = ["".join(r.choices("abcdefgh", k=4)) for _ in range(3000)]
    bad = ["vile", "nasty", "awful"]
    rows, labels = [], []
    for i in range(1500):
        w = r.choices(plain, k=r.randint(20, 80))
        toxic = i % 8 == 0
        if toxic:
            w[r.randrange(len(w))] = r.choice(bad).upper() + "!"
        rows.append((i, " ".join(w), toxic))
        if i % 3 == 0:
            labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame([(k, t, "clash") for k, t, _ in rows] + [(9000, None, "clash"), (9001, "", "clash"), (9001, "", "clash"), (9002, "vile " * 50000, "clash"), (None, "calm", "clash")], "doc_id long, text string, score string")
    lab = spark.createDataFrame([*labels, (9001, None), (9002, 0)], "doc_id long, toxic int")
    got = toxicity.detect(docs, lab).collect()
    assert len(got) == len(rows) + 5
    truth = {k: x for k, _, x in rows}
    held = [(g.predicted, truth[g.doc_id]) for g in got if g.held_out and g.doc_id in truth]
    assert len(held) > 200
    assert sum(p == int(t) for p, t in held) >= 0.97 * len(held)
    assert all(0 <= g.score <= 1 and g.predicted == (g.score >= 0.5) for g in got)
    by = {g.doc_id: g.predicted for g in got}
    assert by[9000] == by[9001] == 0 and by[9002] == 1


def test_without_positives_nothing_is_toxic(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([(1, 0), (2, None)], "doc_id long, toxic int")
    assert [(g.score, g.predicted) for g in toxicity.detect(docs, none).collect()] == [(0.0, 0)] * 2
    assert toxicity.detect(docs.limit(0), none.limit(0)).count() == 0


def test_glued_stems_by_language(spark):
    """In one language whole words mark toxic texts, in the other a stem with any ending."""
    r = random.Random(2)
    syllables = {"a": "ba be bi bo da de di do".split(), "b": "ku ko ka ki lu lo la li".split()}
    rows, labels, lang = [], [], {}
    for i in range(1600):
        lang[i] = "ab"[i % 2]
        w = ["".join(r.choices(syllables[lang[i]], k=r.randint(1, 4))) for _ in range(r.randint(60, 200))]
        if toxic := i % 9 == 0:
            for _ in range(max(2, len(w) // 50)):
                w[r.randrange(len(w))] = r.choice(["vile", "awful"]) if lang[i] == "a" else "lakilo" + r.choice(syllables["b"])
        rows.append((i, " ".join(w)))
        if i % 2 or r.random() < 0.5:
            labels.append((i, int(toxic)))
    got = toxicity.detect(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).where("held_out").collect()
    for x in "ab":
        toxic = [g.predicted for g in got if lang[g.doc_id] == x and g.doc_id % 9 == 0]
        clean = [g.predicted for g in got if lang[g.doc_id] == x and g.doc_id % 9]
        assert len(toxic) > 9 and sum(toxic) >= 0.9 * len(toxic)
        assert sum(clean) <= 0.03 * len(clean)


def test_features_are_runs_of_characters():
    ws = ["abc", "x", "", "über-long-word", "\U0001f600y"]
    f, of = toxicity.features(ws)
    for i, w in enumerate(ws):
        s = f" {w} "
        assert sum(of == i) == sum(max(0, len(s) - k + 1) for k in range(3, 8))
    same = lambda a, b: len(set(toxicity.features([a])[0]) & set(toxicity.features([b])[0]))
    # " ab", "abc" to "abcdefg" and all between, but nothing with the end's border
    assert same("abcdefg", "abcdefgxyz") == sum(max(0, 8 - k + 1) for k in range(3, 8))
    assert same("abc", "xyz") == 0


@pytest.mark.parametrize("shift", [-3.0, 2.0])
def test_risk_and_gradient(shift):
    r = random.Random(3)
    zp, zu, prior = [r.gauss(1, 2) for _ in range(7)], [r.gauss(shift, 1) for _ in range(11)], 0.4

    def plain(zp, zu):
        plus = prior * sum(math.log(1 + math.exp(-z)) for z in zp) / len(zp)
        return plus, sum(math.log(1 + math.exp(z)) for z in zu) / len(zu) - prior * sum(math.log(1 + math.exp(z)) for z in zp) / len(zp)

    plus, rest, gp, gu = toxicity.risk(np.array(zp), np.array(zu), prior)
    assert (plus, rest) == pytest.approx(plain(zp, zu))
    assert (rest < 0) == (shift < 0)
    goal = (lambda p, q: -q) if rest < 0 else (lambda p, q: p + q)
    for k in range(len(zp) + len(zu)):
        def moved(d, k=k):
            z = [*zp, *zu]
            z[k] += d
            return goal(*plain(z[: len(zp)], z[len(zp) :]))

        assert np.concatenate([gp, gu])[k] == pytest.approx((moved(1e-5) - moved(-1e-5)) / 2e-5, abs=1e-7)


def test_scores_are_sums_over_runs():
    """The cached, hashed scores equal a walk over the runs of each word."""
    texts = ["vile day", "a good day", "day by day", None, "", "VILE, vile! " * 3000]
    model = toxicity.fit([toxicity.counted("vile day")], [toxicity.counted(t) for t in texts], 0.2, epochs=40)
    weight = dict(zip(model.kept.tolist(), model.weights.tolist(), strict=True))
    for t, s in zip(texts, model.scores(texts), strict=True):
        ws = re.findall(r"[a-z]+", (t or "").lower())
        share = lambda w: min(0.1, ws.count(w) / (len(ws) + model.smooth))  # noqa: B023, E731
        z = sum(share(w) * weight.get(int(f), 0) for w in set(ws) for f in toxicity.features([w])[0]) + model.bias
        assert s == pytest.approx(1 / (1 + math.exp(-z)))


@pytest.mark.parametrize("n", [1, 2, 3])
def test_few_positives(spark, n):
    """One to three confirmed texts give a model that ranks the like of them first; a thousand unlabelled copies count once."""
    r = random.Random(n)
    plain = ["".join(r.choices("abcdefgh", k=5)) for _ in range(20000)]
    rows = [(i, " ".join(r.choices(plain, k=40) + (["zzyzx"] * 3 if i <= 2 * n else []))) for i in range(1, 400)]
    rows += [(1000 + i, rows[0][1]) for i in range(1000)]
    labels = [(i, int(i <= n)) for i in range(1, 200)]
    model = toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    s = model.scores([t for _, t in rows[:399]])
    assert set(np.argsort(-s)[: 2 * n]) == set(range(2 * n))
