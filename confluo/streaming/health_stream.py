"""Health folded over a stream of checks, and snapshots that trigger a rebuild."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from confluo.operators.health import DISABLE_AFTER, status_of

#: The state of a candidate, as the state data source reads it back.
STATE = "health"
_STATE = "failures int, at long, place long, success long, silent boolean"


def _fold(key: str, quiet: int | None) -> StatefulProcessor:
    # a class of its own here goes to workers by value: they need not have this package
    class _Fold(StatefulProcessor):
        """(failures, time and place of the last check, time of the last success) by candidate; times in microseconds.

        Checks not later than the state's last are dropped, which also makes replays harmless. A candidate without check for
        `quiet` microseconds of event time is reported as silent by a timer, until it is checked again.
        """

        def __init__(self, key: str, quiet: int | None):
            self.key, self.quiet, self.first = key, quiet, None

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.state = handle.getValueState(STATE, _STATE)

        def _keep(self, failures: int, at: int, place: int, success: int | None, silent: bool) -> None:
            self.state.update((failures, at, place, success, silent))
            if self.quiet is not None:
                for t in list(self.handle.listTimers()):
                    self.handle.deleteTimer(t)
                if not silent:
                    self.handle.registerTimer(max(0, (at + self.quiet) // 1000))

        def _row(self, k: tuple, failures: int, at: int, success: int | None, silent: bool) -> Row:
            return Row(**{self.key: k[0], "failures": failures, "_at": at, "_success": success, "silent": silent})

        def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N803  Spark's name
            # a candidate's initial state comes just before its first rows, and need not be asked for again
            old, self.first = self.first[1] if self.first and self.first[0] == key else self.state.get(), None
            failures, success = (old[0], old[3]) if old else (0, None)
            last = (old[1], old[2]) if old else None
            # what one micro-batch has for a candidate, in any order: failures count that are later than its last success
            good, top, failed, room = None, last, [], 1000
            for r in rows:
                when = (r[-3], r[-2])
                if last is not None and when <= last or good is not None and when <= good:
                    continue
                top = when if top is None or when > top else top
                if not r[-1]:
                    failed.append(when)
                    continue
                good = when
                if len(failed) > room:
                    failed = [w for w in failed if w > good]
                    room = max(1000, 2 * len(failed))
            if good is not None:
                failures, success = 0, good[0]
            failures += len({w for w in failed if good is None or w > good})
            self._keep(failures, *top, success, False)
            yield self._row(key, failures, top[0], success, False)

        def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N803  Spark's names
            failures, last, place, success, _ = self.state.get()
            self._keep(failures, last, place, success, True)
            yield self._row(key, failures, last, success, True)

        def handleInitialState(self, key: tuple, initialState: Row, timerValues) -> None:  # noqa: N803  Spark's names
            failures, at, place, success = initialState[-4:]
            self._keep(failures, at, place, success, False)
            self.first = key, (failures, at, place, success, False)

        def close(self) -> None:
            pass

    return _Fold(key, quiet)


def _since_success(key: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    # a function of its own here goes to workers by value, as the state function does
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each batch's checks, those from a candidate's last success there on; earlier ones change no state."""
        for b in batches:
            who = b.column(key).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            ok = b.column("_ok").fill_null(False).to_numpy(zero_copy_only=False)
            by = np.lexsort((ok, b.column("_ord").to_numpy(), b.column("_at").to_numpy(), who))
            rank = np.empty(len(by), np.int64)
            rank[by] = np.arange(len(by))
            last = np.full(len(by), -1)
            np.maximum.at(last, who[ok], rank[ok])
            yield b.filter(pa.array(rank >= last[who]))

    return keep


def fold_stream(checks: DataFrame, key: str, at: str, order: str, ok: str, state: DataFrame | None = None, quiet: str | None = None, late: str = "0 seconds") -> DataFrame:
    """Update-mode stream of each candidate's state as checks arrive: failures, last_check, last_success, silent, status, enabled.

    state: where the stream goes on from, a batch's result: key, failures, last_check, last_success and `order`, the place of
    the last check among those of its time. quiet: an interval of event time after which a candidate without checks is
    reported as silent; checks may be `late` by so much for that. State is kept in RocksDB, so it may outgrow memory. Checks
    without a time are left out.
    """
    spark = checks.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    place = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(-(2**63)))  # noqa: E731  none comes first, as in the fold
    # rows are taken apart in Python value by value, so only a stream with timers has a column of time
    time = [] if quiet is None else [F.col(at).cast("timestamp").alias("_time")]
    src = checks.where(F.col(at).isNotNull()).select(F.col(key), *time, us(at).alias("_at"), place(order).alias("_ord"), F.col(ok).alias("_ok"))
    src = src.mapInArrow(_since_success(key), src.schema)
    if quiet is not None:
        src = src.withWatermark("_time", late)
    kind = checks.schema[key].dataType.simpleString()
    initial = None if state is None else state.select(F.col(key), "failures", us("last_check").alias("_at"), place(order).alias("_ord"), us("last_success").alias("_success")).groupBy(key)
    wait = None if quiet is None else int(pd.Timedelta(quiet).value // 1000)
    # rows, not data frames: a frame for each candidate costs far more than its few checks
    out = src.groupBy(key).transformWithState(_fold(key, wait), f"{key} {kind}, failures int, _at long, _success long, silent boolean", "Update", "None" if quiet is None else "EventTime", initial)
    out = out.select(key, "failures", F.timestamp_micros("_at").alias("last_check"), F.timestamp_micros("_success").alias("last_success"), "silent")
    return out.withColumn("status", status_of(F.col("failures"))).withColumn("enabled", F.col("failures") < DISABLE_AFTER)


def stored(spark: SparkSession, checkpoint: str, key: str) -> DataFrame:
    """What a stream's state holds now, read from its checkpoint: key, failures, last_check, last_success, silent."""
    s = spark.read.format("statestore").option("stateVarName", STATE).load(checkpoint)
    time = lambda c: F.timestamp_micros(F.col(f"value.{c}"))
    return s.select(F.col(f"key.{key}").alias(key), "value.failures", time("at").alias("last_check"), time("success").alias("last_success"), "value.silent")


def on_snapshots(stream: DataFrame, rebuild: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Call the batch job for each arrived snapshot batch."""
    return stream.writeStream.foreachBatch(rebuild).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
