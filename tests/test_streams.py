"""Streams of checks: equal to the batch fold, resumed, before 1970, silent candidates, state read back."""

import random
import time
from datetime import datetime, timedelta

import pyarrow as pa
from pyspark.sql import functions as F

from confluo.operators import health
from confluo.scratch import folder
from confluo.streaming.health_stream import _since_success, fold_stream, stored

SCHEMA = "id string, t timestamp, o long, ok boolean"


def run(spark, path, **options):
    src = spark.readStream.schema(SCHEMA).parquet(f"{path}/in")

    def keep(batch, n):
        batch.write.mode("overwrite").parquet(f"{path}/out/batch={n}")

    fold_stream(src, "id", "t", "o", "ok", **options).writeStream.foreachBatch(keep).outputMode("update").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()


def key(r):
    return r.id, r.failures, r.last_check, r.last_success


def test_resumed_stream_equals_batch_over_both_halves(spark):
    rng, path = random.Random(1), folder(spark)
    # ties in time, times before 1970, candidates of one half alone
    rows = [(f"k{rng.randrange(9)}", datetime(1969, 12, 31) + timedelta(hours=rng.randrange(72)), i, rng.random() < 0.25) for i in range(300)] + [("old", datetime(1960, 1, 1), 0, True), ("old", datetime(1961, 1, 1), -5, False), ("new", datetime(1980, 1, 1), 999, False)]
    rows.sort(key=lambda r: (r[1], r[2]))
    df = spark.createDataFrame(rows, SCHEMA)
    half = datetime(1970, 1, 1, 12)
    early = df.where(F.col("t") < half)
    at = early.groupBy("id").agg(F.max(F.struct("t", "o")).alias("m")).select("id", "m.o")
    state = health.fold(early, "id", ["t", "o"], "ok").join(at, "id")
    df.where(F.col("t") >= half).write.parquet(f"{path}/in")
    run(spark, path, state=state)
    want = sorted(map(key, health.fold(df, "id", ["t", "o"], "ok").collect()), key=str)
    assert sorted(map(key, stored(spark, f"{path}/state", "id").collect()), key=str) == want
    # the same checks again change nothing, later ones go on from the stored state
    df.write.mode("append").parquet(f"{path}/in")
    more = spark.createDataFrame([("old", datetime(1990, 1, 1), 1, False), ("k1", datetime(1990, 1, 1), 1, True)], SCHEMA)
    more.write.mode("append").parquet(f"{path}/in")
    run(spark, path, state=state)
    want = sorted(map(key, health.fold(df.unionByName(more), "id", ["t", "o"], "ok").collect()), key=str)
    assert sorted(map(key, stored(spark, f"{path}/state", "id").collect()), key=str) == want


def test_silent_candidates_are_reported(spark):
    path, day = folder(spark), lambda n: datetime(2024, 1, n)
    take = lambda rows: (spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/in"), run(spark, path, quiet="3 days"))
    silent = lambda: {r.id: r.silent for r in stored(spark, f"{path}/state", "id").collect()}
    take([("a", day(1), 1, False), ("b", day(1), 2, True)])
    take([("b", day(3), 3, True)])
    assert silent() == {"a": False, "b": False}
    take([("b", day(6), 4, True)])
    take([("b", day(7), 5, True)])
    assert silent() == {"a": True, "b": False}
    out = spark.read.parquet(f"{path}/out").where("silent").collect()
    assert [(r.id, r.failures, r.last_check) for r in out] == [("a", 1, day(1))]
    take([("a", day(8), 6, False)])
    got = {r.id: r for r in stored(spark, f"{path}/state", "id").collect()}
    assert not got["a"].silent and got["a"].failures == 2


def _halves(spark, path, df, half):
    early = df.where(F.col("t") < half)
    at = early.groupBy("id").agg(F.max(F.struct("t", "o")).alias("m")).select("id", "m.o")
    df.where("t IS NULL").union(df.where(F.col("t") >= half)).coalesce(3).write.parquet(f"{path}/in")
    run(spark, path, state=health.fold(early, "id", ["t", "o"], "ok").join(at, "id"))


def test_many_candidates_cost_little_each(spark):
    """Thirty times the candidates, all with an earlier state, must not take nearly that much longer (F10)."""
    took = []
    for n in (200, 200, 6000):
        path, day = folder(spark), lambda d: F.lit(datetime(2024, 1, d))
        two = [spark.range(n).select(F.concat(F.lit("k"), "id").alias("id"), day(d).alias("t"), F.lit(d).cast("long").alias("o"), (F.col("id") % d == 0).alias("ok")) for d in (2, 3)]
        df = two[0].union(two[1])
        began = time.perf_counter()
        _halves(spark, path, df, datetime(2024, 1, 3))
        took.append(time.perf_counter() - began)
        assert sorted(map(key, stored(spark, f"{path}/state", "id").collect()), key=str) == sorted(map(key, health.fold(df, "id", ["t", "o"], "ok").collect()), key=str)
    assert took[2] < 2.5 * took[1]


def test_stream_equals_batch_in_small_arrow_batches(spark):
    """Checks in no order, over many batches: one frequent candidate, one that never succeeds, unknown outcomes and places,
    checks that come twice, checks without a time (left out)."""
    rng, path, conf = random.Random(3), folder(spark), "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = [(rng.choice(["hot", "hot", "bad", f"k{i % 40}"]), datetime(2024, 1, 1) + timedelta(hours=rng.randrange(300)), rng.choice([None, i]), rng.choice([True, False, False, None])) for i in range(3000)]
    # at one time and place there is one check
    rows = [("bad", t, o, False) if k == "bad" else (k, t, o, ok) for (k, t, o), ok in {r[:3]: r[3] for r in rows}.items()]
    df = spark.createDataFrame(rows, SCHEMA)
    half = datetime(2024, 1, 5)
    again = df.where(F.col("t") >= half).where("hash(id, t, o) % 3 = 0")
    none = spark.createDataFrame([("hot", None, 1, True), ("k1", None, None, False)], SCHEMA)
    old = spark.conf.get(conf)
    try:
        spark.conf.set(conf, 64)
        _halves(spark, path, df.union(again).union(none), half)
        got = sorted(map(key, stored(spark, f"{path}/state", "id").collect()), key=str)
    finally:
        spark.conf.set(conf, old)
    assert got == sorted(map(key, health.fold(df, "id", ["t", "o"], "ok").collect()), key=str)
    assert max(k[1] for k in got) > 500


def test_earlier_checks_are_dropped_before_the_shuffle():
    """A frequent candidate hands its state function what follows its last success in each batch, not all its checks."""
    t = pa.record_batch({"id": ["a"] * 1000 + ["b", None, None], "_at": list(range(1000)) + [5, 2**60, 2**60 + 1], "_ord": [0] * 1003, "_ok": [i == 995 for i in range(1000)] + [None, False, True]})
    mixed = t.take(pa.array(random.Random(1).sample(range(1003), 1003)))
    got = pa.Table.from_batches(_since_success("id")([mixed])).to_pylist()
    assert sorted((str(r["id"]), r["_at"]) for r in got) == [("None", 2**60 + 1), *(("a", i) for i in range(995, 1000)), ("b", 5)]
