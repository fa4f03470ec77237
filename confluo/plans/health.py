"""Health queries: batch fold, upsert, stream fold."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from confluo.operators import buckets, health, resolve, survive
from confluo.plans.registry import query, table
from confluo.plans.resolution import RESOLVE_SQL, aliases, entities, entries
from confluo.scratch import folder, scratch
from confluo.streaming import snapshots
from confluo.streaming.health_stream import fold_stream, on_snapshots, stored

_RUNS = "SELECT user_id, ts, event_id, ok, sum(ok::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM (SELECT *, event_type = 'purchase' AS ok FROM events)"


def _checks(spark, d):
    return table(spark, d, "events").select("user_id", "ts", "event_id", (F.col("event_type") == "purchase").alias("ok"))


_FOLD = f"""WITH r AS ({_RUNS}), f AS (SELECT user_id, count(*) FILTER (NOT ok AND i = mi) AS failures, max(ts) AS last_check, max(ts) FILTER (ok) AS last_success FROM (SELECT *, max(i) OVER (PARTITION BY user_id) AS mi FROM r) GROUP BY user_id)
    SELECT user_id, failures, last_check, last_success, CASE WHEN failures = 0 THEN 'online' WHEN failures <= 2 THEN 'degraded' WHEN failures < 6 THEN 'unstable' ELSE 'offline' END AS status, failures < 6 AS enabled FROM f"""


@query(_FOLD)
def health_fold(spark, d):
    return health.fold(_checks(spark, d), "user_id", ["ts", "event_id"], "ok")


@query(f"SELECT event_id, sum((NOT ok)::INT) OVER (PARTITION BY user_id, i ORDER BY ts, event_id) AS failures FROM ({_RUNS})")
def failure_runs(spark, d):
    return health.runs(_checks(spark, d), "user_id", ["ts", "event_id"], "ok").select("event_id", "failures")


@query(
    """WITH a AS (SELECT user_id, max(value) AS value, count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-10' GROUP BY user_id), b AS (SELECT user_id, max(value) AS value, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11' GROUP BY user_id)
    SELECT coalesce(b.user_id, a.user_id) AS user_id, CASE WHEN b.user_id IS NOT NULL THEN b.value ELSE a.value END AS value, CASE WHEN b.user_id IS NOT NULL THEN b.n ELSE a.n END AS n, b.user_id IS NOT NULL AS present FROM a FULL JOIN b ON a.user_id = b.user_id"""
)
def upsert_present(spark, d):
    e = table(spark, d, "events")
    fold = lambda x: x.groupBy("user_id").agg(F.max("value").alias("value"), F.count("*").alias("n"))
    state = fold(e.where("ts < '2024-01-10'")).withColumn("present", F.lit(True))
    return health.upsert(state, fold(e.where("ts >= '2024-01-10' AND ts < '2024-01-11'")), "user_id")


def _streamed(spark, d, path, where="true", **options):
    """States that a stream of the events' checks has at its end."""
    src = spark.readStream.schema(table(spark, d, "events").schema).parquet(f"{d}/events.parque[t]").where(where)
    checks = src.select("user_id", "ts", "event_id", (F.col("event_type") == "purchase").alias("ok"))

    def keep(batch, n):
        batch.write.mode("overwrite").parquet(f"{path}/out/batch={n}")

    fold_stream(checks, "user_id", "ts", "event_id", "ok", **options).writeStream.foreachBatch(keep).outputMode("update").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(f"{path}/out")
    return got.groupBy("user_id").agg(F.max_by(F.struct("failures", "last_check", "last_success", "status", "enabled"), "batch").alias("s")).select("user_id", "s.*")


@query(f"SELECT user_id, failures, last_check, status, enabled FROM ({_FOLD})")
def health_fold_stream(spark, d):
    """Final states of the fold run as a stream over the events table; equal to health_fold."""
    return _streamed(spark, d, folder(spark)).drop("last_success")


@query(_FOLD)
def health_fold_resumed(spark, d):
    """A stream over later events that goes on from the batch fold of the earlier ones; its states, read back from its
    checkpoint by the state data source, are those of the fold over all."""
    path, early = folder(spark), _checks(spark, d).where("ts < '2024-01-15'")
    last = early.groupBy("user_id").agg(F.max(F.struct("ts", "event_id")).alias("m")).select("user_id", "m.event_id")
    state = health.fold(early, "user_id", ["ts", "event_id"], "ok").join(last, "user_id")
    _streamed(spark, d, path, "ts >= '2024-01-15'", state=state)
    got = stored(spark, f"{path}/state", "user_id")
    of = got.select("user_id", "failures", F.col("last_check").cast("timestamp_ntz").alias("last_check"), F.col("last_success").cast("timestamp_ntz").alias("last_success"))
    return of.withColumn("status", health.status_of(F.col("failures"))).withColumn("enabled", F.col("failures") < health.DISABLE_AFTER)


@query(
    """WITH a AS (SELECT user_id, max(value) AS value, count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-10' GROUP BY user_id), b AS (SELECT user_id, max(value) AS value, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11' GROUP BY user_id),
    c AS (SELECT user_id, max(value) AS value, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-11' AND ts < TIMESTAMP '2024-01-11 06:00:00' GROUP BY user_id),
    ab AS (SELECT coalesce(b.user_id, a.user_id) AS user_id, CASE WHEN b.user_id IS NOT NULL THEN b.value ELSE a.value END AS value, CASE WHEN b.user_id IS NOT NULL THEN b.n ELSE a.n END AS n, b.user_id IS NOT NULL AS present FROM a FULL JOIN b ON a.user_id = b.user_id)
    SELECT coalesce(c.user_id, ab.user_id) AS user_id, CASE WHEN c.user_id IS NOT NULL THEN c.value ELSE ab.value END AS value, CASE WHEN c.user_id IS NOT NULL THEN c.n ELSE ab.n END AS n, c.user_id IS NOT NULL OR ab.present AS present FROM ab FULL JOIN c ON ab.user_id = c.user_id"""
)
def upsert_buckets(spark, d):
    """A state kept in buckets: a first fill, a full run that marks who is gone, and a part of a run that marks nobody."""
    path, e = folder(spark), table(spark, d, "events")
    schema = StructType([e.schema["user_id"], e.schema["value"]]).add("n", LongType()).add("present", BooleanType())
    for span, full in (("ts < '2024-01-10'", True), ("ts >= '2024-01-10' AND ts < '2024-01-11'", True), ("ts >= '2024-01-11' AND ts < '2024-01-11 06:00:00'", False)):
        health.upsert_into(path, schema, e.where(span).groupBy("user_id").agg(F.max("value").alias("value"), F.count("*").alias("n")), "user_id", full, n_buckets=16)
    return buckets.read(spark, path, schema).drop(buckets.BUCKET)


_BEST = "SELECT entity_id, arg_min(p_partkey, (p_size, p_partkey)) AS p_partkey, min(p_size) AS p_size, arg_min(matched_by, (p_size, p_partkey)) AS matched_by FROM"
_RANK = ("p_size", "p_partkey")


def _found(batch, known, named):
    r = resolve.resolve(entries(batch), known, named).select("entity_id", "matched_by", F.col("entry_key").alias("p_partkey"))
    return r.join(batch.select("p_partkey", "p_size", "p_brand"), "p_partkey")


@query(f"{_BEST} ({RESOLVE_SQL}) JOIN part USING (p_partkey) GROUP BY entity_id")
def ingest_rebuild(spark, d):
    """Parts arrive as a stream; each is resolved, and the best candidate of the entities it touches is chosen anew from the
    former best and what arrived, in the buckets that hold these entities."""
    path = folder(spark)
    known, named = scratch(entities(spark, d)), scratch(aliases(spark, d))
    part = table(spark, d, "part").schema
    schema = StructType([StructField("entity_id", StringType()), part["p_partkey"], part["p_size"], StructField("matched_by", StringType())])
    src = spark.readStream.schema(part).parquet(f"{d}/part.parque[t]")
    keep = schema.fieldNames()

    def rebuild(batch, n):
        new = scratch(_found(batch, known, named).select(*keep).withColumn(buckets.BUCKET, buckets.bucket_of("entity_id", 16)))
        only = buckets.touched(new)
        both = buckets.read(spark, f"{path}/best", schema, only).unionByName(new)
        best = survive.survivors(both, ["entity_id", buckets.BUCKET], [F.col(c) for c in _RANK], keep[1:])
        buckets.overwrite(best.select(*keep, buckets.BUCKET), f"{path}/best")

    on_snapshots(src, rebuild, f"{path}/state").awaitTermination()
    return buckets.read(spark, f"{path}/best", schema).drop(buckets.BUCKET)


_NO = "substr(p_brand, 7)::INT"


@query(f"{_BEST} ({RESOLVE_SQL}) JOIN part USING (p_partkey) WHERE NOT ({_NO} % 3 = 1 AND p_partkey % 7 IN (0, 3)) AND NOT ({_NO} % 3 = 2 AND p_partkey % 5 = 0) GROUP BY entity_id")
def snapshot_retraction(spark, d):
    """Three snapshots of parts arrive, the later ones of some brands alone, with parts withdrawn, and one of these again;
    bests are those of each brand's last snapshot."""
    path = folder(spark)
    known, named = scratch(entities(spark, d)), scratch(aliases(spark, d))
    part = table(spark, d, "part")
    fields = [StructField("entity_id", StringType()), StructField("source", StringType()), StructField("version", LongType()), part.schema["p_partkey"], part.schema["p_size"], StructField("matched_by", StringType())]
    store = snapshots.Store(f"{path}/store", StructType(fields), n_buckets=16)
    no = F.substring("p_brand", 7, 9).cast("int") % 3
    lost = lambda k, m, of: (no == k) & (F.col("p_partkey") % m).isin(*of)
    each = (part, part.where((no == 1) & ~lost(1, 7, [0])), part.where(((no == 1) & ~lost(1, 7, [0, 3])) | ((no == 2) & ~lost(2, 5, [0]))))

    def take(batch, n):
        batch = scratch(batch)
        rows = _found(batch, known, named).join(batch.select("p_partkey", "version"), "p_partkey").withColumnRenamed("p_brand", "source")
        snapshots.refresh(store, rows, [F.col(c) for c in _RANK])

    for version, snapshot in enumerate(each):
        snapshot.withColumn("version", F.lit(version).cast("long")).write.mode("append").parquet(f"{path}/in")
        src = spark.readStream.schema(StructType([*part.schema.fields, StructField("version", LongType())])).parquet(f"{path}/in")
        on_snapshots(src, take, f"{path}/state").awaitTermination()
    return store.best(spark).select("entity_id", "p_partkey", "p_size", "matched_by")
