"""The pipeline on planted documents: what each stage keeps, and what comes out packed."""

import random

import corpus_pipeline
from confluo.llm import jaccard, quality


def planted():
    r = random.Random(6)
    word = lambda: "".join(r.choices("abcdefghij", k=r.randint(3, 7)))
    prose = lambda n: " ".join(r.choice(["the", "of", "and", "to", word(), word(), word()]) for _ in range(n))
    clean = [prose(r.randint(80, 200)) for _ in range(120)]
    rows = list(enumerate(clean))
    toxic, poor, near, copies = set(), set(), set(), set()
    for i in range(90):
        w = prose(90).split()
        for _ in range(3):
            w[r.randrange(len(w))] = r.choice(["vile", "nasty"])
        toxic.add(1000 + i)
        rows.append((1000 + i, " ".join(w)))
    for i in range(20):
        poor.add(2000 + i)
        rows.append((2000 + i, r.choice(["too short", "%%% *** " * 60, "one two three four " * 40, "xx yy zz ww " + " ".join(word() for _ in range(70))])))
    for i in range(20):
        w = clean[i].split()
        w[len(w) // 2] = "changed"
        near.add(3000 + i)
        rows.append((3000 + i, " ".join(w)))
    for i in range(20, 40):
        copies.add(4000 + i)
        rows.append((4000 + i, clean[i]))
    return rows, toxic, poor, near | copies


def test_stages(spark, tmp_path):
    rows, toxic, poor, double = planted()
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(k, 1, int(k in toxic)) for k, _ in rows if k < 2000]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    df, left = docs, {k for k, _ in rows}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, df, str(tmp_path))
        if name != "best_fit_packing":
            assert out.columns == docs.columns
        rest = {r.doc_id for r in out.select("doc_id").distinct().collect()}
        gone = left - rest
        if name == "toxicity":
            assert len(gone & toxic) >= 0.97 * len(toxic) and len(gone - toxic) <= 3
        if name == "quality_rules":
            assert gone == poor & left
        if name == "ngram_jaccard_join":
            assert gone == {k for k in double & left if k % 1000 in left}
        left, df = rest, out
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == left


def test_keep_one_with_repeats_and_empty_tables(spark):
    text = "a b c d e f g h i j"
    rows = [(2, text, 1), (1, text, 2), (1, text, 2), (5, None, 3), (5, "", 3), (None, text, 4), (7, "x y", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, t int")
    got = jaccard.keep_one(df).collect()
    assert sorted((str(g.doc_id), str(g.text)) for g in got if g.text and g.text != text) == [("7", "x y")]
    assert sum(g.text == text for g in got) == 1 and sum(not g.text for g in got) == 2
    assert jaccard.keep_one(df.limit(0)).count() == 0 and quality.keep(df.limit(0)).count() == 0


def test_each_stage_on_odd_rows(spark, tmp_path):
    """Null, empty and very long texts, repeated rows, null ids, columns with clashing names, an empty table."""
    r = random.Random(3)
    prose = lambda n: " ".join(r.choice(["the", "of", "and", "calm", "river", "stone", "walks", "slowly", "green"]) + (f"x{r.randrange(10**6)}" if r.random() < 0.5 else "") for _ in range(n))
    long, short = prose(60_000), prose(90)
    rows = [(1, None), (2, ""), (3, long), (4, short), (4, short), (None, prose(80)), (5, short), (6, "\n \t")]
    extra = ", lang string, score double, h long, component long, at long, piece string, length int"
    docs = spark.createDataFrame([(*x, "en", 0.5, 1, 2, 3, "p", 4) for x in rows], "doc_id long, text string" + extra)
    train = [(k, prose(60) + (" vile" * 3 if k % 5 == 0 else "")) for k in range(100, 200)]
    spark.createDataFrame(train + [(1, None)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(k, int(k % 5 == 0)) for k, _ in train] + [(101, None)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    left = {"toxicity": len(rows), "quality_rules": 5, "ngram_jaccard_join": 3}
    df = docs
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
        df = stage(spark, df, str(tmp_path)).cache()
        if name in left:
            assert df.columns == docs.columns and df.count() == left[name]
    got = df.collect()
    assert {x.doc_id for x in got} == {3, 4, None}
    assert sum(x.length for x in got if x.doc_id == 3) > 60_000 and all(0 < x.length <= 1024 for x in got)
    # packing alone takes what the earlier stages would drop
    alone = corpus_pipeline.packed(spark, docs, str(tmp_path)).collect()
    assert [x.length for x in alone if x.doc_id in (1, 2)] == [1, 1] and len({(x.doc_id, x.piece, x.sequence_id, x.offset) for x in alone}) == len(alone)
