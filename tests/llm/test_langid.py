"""The recurrent network: gradients against differences, held-out accuracy, edge cases."""

import random

import numpy as np

from confluo.llm import langid

SYLLABLES = {"aa": ["tion", "ing", "the", "er"], "bb": ["eau", "ère", "que", "ment"], "cc": ["ung", "sch", "keit", "ü"]}


def test_gradients():
    m, r = langid.ByteGru(["x", "y", "z"], hidden=4), np.random.default_rng(0)
    x, y, mask = r.integers(97, 110, (6, 3)).astype(np.uint8), np.array([0, 1, 2]), np.ones((6, 3), np.float32)
    grads = m.step(x, y, mask)
    loss = lambda: -np.log(m.positions(x)[:, y, np.arange(3)]).mean()
    for k, g in grads.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        m.p[k][at] += 0.01
        up = loss()
        m.p[k][at] -= 0.02
        down = loss()
        m.p[k][at] += 0.01
        assert abs((up - down) / 0.02 - g[at]) < 1e-3, k


def test_windows_tile_the_text():
    m = langid.ByteGru(["x", "y"])
    texts = [b"", b"abc", b"abcdefgh" * 40]
    off = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    p = m.documents(np.frombuffer(b"".join(texts), np.uint8), off, window=16, block=3)
    assert np.isnan(p[0]).all()
    for i in (1, 2):
        t = np.frombuffer(texts[i], np.uint8)
        total = 0
        for at in range(0, len(t), 16):
            w = np.zeros((16, 1), np.uint8)
            piece = t[at : at + 16]
            w[: len(piece), 0] = piece
            total = total + m.positions(w)[: len(piece), :, 0].sum(0)
        assert np.allclose(p[i], total / len(t), atol=1e-5)


def test_held_out_accuracy(spark):
    r = random.Random(2)
    rows = []
    for i in range(600):
        lang = r.choice(sorted(SYLLABLES))
        rows.append((i, " ".join("".join(r.choices(SYLLABLES[lang], k=r.randint(1, 3))) for _ in range(r.randint(4, 40))), lang))
    rows += [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 !?", "aa"), (None, "tion ing the", None), (1003, "the tion " * 20000, None), (1003, "the tion", None)]
    df = spark.createDataFrame([(*x, "clash") for x in rows], "doc_id long, text string, lang string, score string")
    got = langid.identify(df).collect()
    assert len(got) == len(rows)
    truth = {k: x for k, t, x in rows if k is not None and k < 1000}
    held = [(g.lang_pred, truth[g.doc_id]) for g in got if g.held_out and g.doc_id in truth]
    assert len(held) > 100 and sum(a == b for a, b in held) >= 0.97 * len(held)
    by = {g.doc_id: (g.lang_pred, g.score) for g in got}
    assert by[1000] == by[1001] == by[1002] == ("und", 0.0) and by[1003][0] == "aa"
    assert all(0 <= g.score <= 1 for g in got)
    assert langid.identify(df.limit(0)).count() == 0
