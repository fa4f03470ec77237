"""Tree concatenation against the tokenizers library, on texts made to be hard to join."""

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from confluo.llm import bpe

ALPHABETS = [" \n\t", "ab'sxl ", "'", "a1_ é", "漢字かな", "0123456789", "   a", "!?*'", "e", "́e ", "thing the of er "]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_path())


@pytest.fixture(scope="module")
def enc():
    return bpe.Encoder()


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


def texts(n, most, seed):
    r = random.Random(seed)
    for _ in range(n):
        yield "".join(r.choice(r.choice(ALPHABETS)) * r.choice((1, 1, 1, 2, 9)) for _ in range(r.randint(0, most)))
        a = r.choice(ALPHABETS)
        yield "".join(r.choice(a) for _ in range(r.randint(0, most)))


@pytest.mark.parametrize("leaf", [1, 2, 3, 7, 16])
def test_tree_equals_library(enc, library, leaf):
    for t in texts(150, 60, leaf):
        assert ids(enc.tree(t, leaf)) == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_long_unsplit_runs(enc, library):
    r = random.Random(5)
    for a in ["ab", "e", "0123456789", " ", "\n ", "漢字", "!'", "thes"]:
        t = "".join(r.choice(a) for _ in range(5000))
        assert ids(enc.encode(t)) == library.encode(t, add_special_tokens=False).ids


def test_cached_encoding(enc, library):
    some = [*texts(300, 80, 99), "", None, " a  b ", "x <|endoftext|>y", "<|endoftext|>", "a<|endoftext|> b\n c", "tail \n", "it's don't 'stop  'tis"]
    for t, got in zip(some, enc.encode_many(some), strict=True):
        assert ids(got) == library.encode(t or "", add_special_tokens=False).ids, repr(t)
        assert enc.decode(got) == (t or "") == library.decode(ids(got), skip_special_tokens=False)


def test_documents(spark, library):
    r = random.Random(3)
    long = " ".join("".join(r.choice("abcde") for _ in range(r.randint(1, 9))) for _ in range(300))
    rows = [(1, long, "x"), (1, long, "x"), (2, None, "x"), (None, "", "x"), (3, "z" * 3000, "x"), (4, "'" + "s" * 99 + " \n" * 400, "x"), (5, "a<|endoftext|>" * 50, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe.encode_documents(df, leaf_chars=100, with_ids=True).collect()
    assert len(got) == len(rows)
    want = sorted((str(k), t or "") for k, t, _ in rows)
    assert sorted((str(x["id"]), x["decoded"]) for x in got) == want
    for x in got:
        assert ids(x["ids"]) == library.encode(x["decoded"], add_special_tokens=False).ids and x["n_tokens"] == len(x["ids"]) // 4
    assert bpe.encode_documents(df.limit(0)).count() == 0
