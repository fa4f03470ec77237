"""Stores kept by buckets: snapshots that withdraw rows, and upserts that rewrite only what they touch."""

import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from confluo.operators import buckets, health
from confluo.scratch import folder
from confluo.streaming import snapshots

SCHEMA = StructType().add("entity_id", "string").add("source", "string").add("version", "long").add("id", "integer").add("rank", "integer")


def stamps(path):
    return {d: sorted((f, os.stat(f"{path}/{d}/{f}").st_mtime_ns) for f in os.listdir(f"{path}/{d}")) for d in os.listdir(path) if d.startswith("bucket=")}


def test_withdrawn_candidates_fall_to_the_next(spark):
    store = snapshots.Store(folder(spark), SCHEMA, n_buckets=32)
    rank = [F.col("rank"), F.col("id")]
    take = lambda rows, **more: snapshots.refresh(store, spark.createDataFrame(rows, SCHEMA), rank, **more)
    best = lambda: {r.entity_id: (r.source, r.id) for r in store.best(spark).collect()}
    assert take([("x", "a", 1, 1, 1), ("x", "a", 1, 2, 2), ("y", "a", 1, 3, 1), ("x", "b", 1, 4, 3), ("z", "b", 1, 5, 1)])["entities"] == 3
    assert best() == {"x": ("a", 1), "y": ("a", 3), "z": ("b", 5)}
    before = stamps(f"{store.path}/best")
    # x loses its best candidate, y its only one; z is not touched
    assert take([("x", "a", 2, 2, 2)]) == {"entities": 2, "buckets": 2}
    assert best() == {"x": ("a", 2), "z": ("b", 5)}
    after = stamps(f"{store.path}/best")
    assert sum(before[d] == after[d] for d in before) == len(before) - 2
    assert take([("x", "a", 2, 2, 2)])["entities"] == 0 and take([("q", "a", 1, 9, 1)])["entities"] == 0  # again, and late
    assert take([("x", "a", 4, 2, 9), ("w", "a", 3, 7, 1)])["entities"] == 1  # two snapshots: the last counts
    assert best() == {"x": ("b", 4), "z": ("b", 5)}
    take([], emptied=spark.createDataFrame([("b", 5)], "source string, version long"))
    assert best() == {"x": ("a", 2)}
    assert take([("x", "b", 4, 4, 0)])["entities"] == 0  # older than the empty one


def test_random_snapshots_equal_a_batch_and_a_failed_batch_can_run_again(spark, monkeypatch):
    rng = random.Random(5)
    store, rank, lists = snapshots.Store(folder(spark), SCHEMA, n_buckets=8), [F.col("rank"), F.col("source"), F.col("id")], {}
    for version in range(1, 5):
        rows = []
        for source in rng.sample(["a", "b", "c/d", "e=1"], 2):
            lists[source] = [(f"e{rng.randrange(30)}", source, version, i, rng.randrange(5)) for i in range(rng.randrange(1, 25))]
            rows += lists[source]
        df = spark.createDataFrame(rows, SCHEMA)
        if version == 3:  # a batch that fails once bests are written runs again
            real = buckets.overwrite
            monkeypatch.setattr(buckets, "overwrite", lambda df, path, clear=(): real(df, path, clear) if path.endswith("best") else 1 / 0)
            with pytest.raises(ZeroDivisionError):
                snapshots.refresh(store, df, rank)
            monkeypatch.setattr(buckets, "overwrite", real)
        snapshots.refresh(store, df, rank)
        want = {}
        for e, s, _, i, r in (x for rows in lists.values() for x in rows):
            want[e] = min(want.get(e, (r, s, i)), (r, s, i))
        assert {r.entity_id: (r["rank"], r.source, r.id) for r in store.best(spark).collect()} == want
        assert store.candidates(spark).count() == sum(map(len, lists.values()))


def test_upsert_rewrites_only_touched_buckets(spark):
    path, schema = folder(spark), StructType().add("id", "long").add("v", "integer").add("present", "boolean")
    batch = lambda ids, v: spark.createDataFrame([(i, v) for i in ids], "id long, v int")
    state = {}
    for ids, v, full in ((range(200), 1, True), ([3, 500], 2, False), (range(199), 3, True), ([], 4, False), (range(199), 5, True)):
        before = stamps(path) if state else {}
        n = health.upsert_into(path, schema, batch(ids, v), "id", full, n_buckets=64)
        for i in state:
            state[i] = (state[i][0], state[i][1] and not full)
        state |= {i: (v, True) for i in ids}
        got = {r.id: (r.v, r.present) for r in spark.read.schema(schema).parquet(path).collect()}
        assert got == state
        if before:
            now = stamps(path)
            assert sum(now[d] != before.get(d) for d in now) <= n
            if not full:
                assert n <= len(ids)
