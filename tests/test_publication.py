"""Publications: failed and refused writes leave the former version; guards are counted while writing; JSON text."""

import json
import os

import pytest
from pyspark.sql import functions as F

from confluo.scratch import folder
from confluo.sources import feeds, playlists, publication


def lines(df):
    return playlists.arrange(df, [F.col("id")], F.concat(F.lit("u"), F.col("id").cast("string")))


def body(spark, root):
    return sorted(r.value for r in spark.read.text(publication.current(spark, root)).collect())


def test_a_write_that_fails_leaves_the_former_version(spark):
    root = folder(spark)
    assert publication.current(spark, root) is None
    first, seen = publication.publish(lines(spark.range(5)), root, ["value"], {"n": F.count("id")})
    assert seen == {"n": 5} and publication.current(spark, root) == first and len(body(spark, root)) == 6
    broken = spark.range(2000).withColumn("id", F.when(F.col("id") == 1999, F.raise_error(F.lit("half-way")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="half-way"):
        publication.publish(broken.select(F.col("id").cast("string").alias("value")), root, ["value"])
    assert publication.current(spark, root) == first and len(body(spark, root)) == 6
    second, _ = publication.publish(lines(spark.range(7)), root, ["value"])
    assert publication.current(spark, root) == second and len(body(spark, root)) == 8
    publication.publish(lines(spark.range(8)), root, ["value"])
    assert publication.prune(spark, root, keep=2) == 1 and len(body(spark, root)) == 9
    assert not [f for f in os.listdir(root) if f.startswith(".CURRENT-") and not f.endswith(".crc")]


def test_truncated_input_is_refused(spark):
    root = folder(spark)
    df = spark.range(1000).withColumn("source", F.when(F.col("id") % 3 == 0, "a").otherwise("b"))
    metrics, demands = publication.least_rows(F.col("source"), {"a": 300, "b": 600})
    metrics |= {"unresolved": F.count_if(F.col("id") < 0)}
    demands |= {"unresolved": lambda m: m["unresolved"] == 0}
    # counts are of what was written, though the range exchange samples its input before
    first, seen = publication.publish(lines(df), root, ["value"], metrics, demands)
    assert seen == {"rows of a": 334, "rows of b": 666, "unresolved": 0}
    with pytest.raises(publication.Refused) as x:
        publication.publish(lines(df.where("source = 'a' OR id < 100")), root, ["value"], metrics, demands)
    assert x.value.failed == ["rows of b"] and x.value.metrics["rows of b"] == 66
    with pytest.raises(publication.Refused) as x:
        publication.publish(lines(df.withColumn("id", -F.col("id") - 1)), root, ["value"], metrics, demands)
    assert x.value.failed == ["unresolved"]
    assert publication.current(spark, root) == first and len(body(spark, root)) == 1001
    # one pass: the plan that writes reads its input once
    plan = lines(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 1000") == 1


def test_json_text(spark):
    root = folder(spark)
    rows = [(f"k{i}\"\\é{i}", {"s": [f"r{i}", "x,y"], "t": []} if i % 2 else {}) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, v map<string, array<string>>").repartition(7)
    at, _ = publication.publish(feeds.json_map(df, F.col("k"), F.col("v"), partitions=5), root, ["value"])
    parts = sorted(f for f in os.listdir(at) if f.startswith("part-"))
    assert len(parts) > 2
    assert json.loads("".join(open(f"{at}/{f}").read() for f in parts)) == dict(rows)
    assert {r.key: r.value for r in feeds.read_json_map(spark, at, "map<string, array<string>>").collect()} == dict(rows)
    none = feeds.json_map(df.limit(0), F.col("k"), F.col("v"))
    assert [r.value for r in none.collect()] == ["{", "}"]
    for bad in (spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int"), spark.createDataFrame([(None, 1)], "k string, v int")):
        with pytest.raises(Exception, match="key"):
            feeds.json_map(bad, F.col("k"), F.struct("v")).collect()
