"""Counts kept through edits against counting anew with the tokenizers library."""

import random

from tokenizers import Tokenizer

from confluo.llm import bpe, token_counts

PIECES = ["the", " ", "  ", "\n", "tion", "'s", "é", "漢", "12", " of", "<|endoftext|>", "!!"]


def test_random_edits():
    enc, lib, r = bpe.Encoder(), Tokenizer.from_file(bpe.default_path()), random.Random(8)
    count = lambda t: len(lib.encode(t, add_special_tokens=False).ids)
    for _ in range(400):
        text = "".join(r.choices(PIECES, k=r.randint(0, 80)))
        tree = token_counts.build(enc, text, 8)
        assert tree.total == count(text)
        for _ in range(3):
            edits, at = [], 0
            while at <= len(text) and r.random() < 0.8:
                a = r.randint(at, len(text))
                b = min(len(text), a + r.choice([0, 0, 1, 3, 20]))
                edits.append((a, b, "".join(r.choices(PIECES, k=r.choice([0, 1, 2, 12])))))
                at = b + 1
            want, shift = text, 0
            for a, b, n in edits:
                want = want[: a + shift] + n + want[b + shift :]
                shift += len(n) - (b - a)
            text, _ = token_counts.apply(enc, tree, text, edits)
            assert text == want
            assert tree.total == count(text)
            assert tree.sums[1, 1] == len(text)


def test_documents(spark):
    lib = Tokenizer.from_file(bpe.default_path())
    rows = [(1, "call +1 (743) 555-3824 or a.b@c.org now " * 30), (2, None), (None, ""), (1, "call +1 (743) 555-3824 or a.b@c.org now " * 30), (3, "x" * 2000)]
    df = spark.createDataFrame([(*x, "clash") for x in rows], "doc_id long, text string, edits string")
    got = token_counts.count_and_redact(df).collect()
    want = sorted((str(k), len(lib.encode(t or "").ids), (t or "").count("@") * 2, len(lib.encode((t or "").replace("+1 (743) 555-3824", "[phone]").replace("a.b@c.org", "[mail]")).ids)) for k, t in rows)
    assert sorted((str(g.doc_id), g.n_tokens, g.n_edits, g.n_tokens_after) for g in got) == want
    assert token_counts.count_and_redact(df.limit(0)).count() == 0
