"""Publications: versions written aside, judged by what was counted while they were written, and named by a pointer.

A publication is a folder with versions and a file CURRENT that names one. A new version is written to a folder of its
own; readers go by CURRENT, which is replaced by one rename once the version is whole and its guards hold. A write that
fails, or that a guard refuses, leaves the former version where readers find it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

POINTER = "CURRENT"


class Refused(RuntimeError):
    """A version whose guards don't hold; names are in failed, what was counted in metrics."""

    def __init__(self, failed: list[str], metrics: dict):
        super().__init__(f"not published: {', '.join(failed)}")
        self.failed, self.metrics = failed, metrics


def _fs(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p


def current(spark: SparkSession, root: str) -> str | None:
    """The folder of the version that is published, if any."""
    fs, p = _fs(spark, f"{root}/{POINTER}")
    if not fs.exists(p):
        return None
    with_ = fs.open(p)
    try:
        name = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(with_, "UTF-8").strip()
    finally:
        with_.close()
    return f"{root}/{name}"


def _point(spark: SparkSession, root: str, name: str) -> None:
    """Make CURRENT name a version: written aside and renamed over the former one, which file systems do as one step."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs, aside = _fs(spark, f"{root}/.{POINTER}-{uuid.uuid4().hex}")
    out = fs.create(aside, True)
    out.write(bytearray(f"{name}\n".encode()))
    out.close()
    options = jvm.org.apache.hadoop.fs.Options.Rename
    one = spark.sparkContext._gateway.new_array(options, 1)
    one[0] = options.OVERWRITE
    to = jvm.org.apache.hadoop.fs.Path(f"{root}/{POINTER}")
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(fs.makeQualified(aside), fs.makeQualified(to), one)


def publish(rows: DataFrame, root: str, columns: list[str], metrics: dict[str, Column] | None = None, demands: dict[str, Callable[[dict], bool]] | None = None, save: Callable[[DataFrame, str], None] | None = None) -> tuple[str, dict]:
    """Write columns of rows as a new version and make it the current one; returns its folder and the metrics.

    metrics are aggregates over rows, gathered by the tasks that write (rows is best sorted already: what stands behind the
    last exchange is run once, so nothing counts twice), and demands judge them. save writes a DataFrame to a path, as
    text unless given. Raises Refused if a demand doesn't hold.
    """
    spark, seen = rows.sparkSession, {}
    name = f"v-{uuid.uuid4().hex}"
    out = rows
    if metrics:
        watch = Observation()
        out = rows.observe(watch, *(c.alias(k) for k, c in metrics.items()))
    try:
        (save or (lambda df, to: df.write.text(to)))(out.select(*columns), f"{root}/{name}")
        seen = watch.get if metrics else {}
        if failed := [k for k, holds in (demands or {}).items() if not holds(seen)]:
            raise Refused(failed, seen)
    except BaseException:
        fs, p = _fs(spark, f"{root}/{name}")
        fs.delete(p, True)
        raise
    _point(spark, root, name)
    return f"{root}/{name}", seen


def least_rows(source: Column, expected: dict[str, int]) -> tuple[dict[str, Column], dict[str, Callable[[dict], bool]]]:
    """Metrics and demands that each expected source has at least so many rows."""
    metrics = {f"rows of {s}": F.count_if(source == s) for s in expected}
    return metrics, {f"rows of {s}": lambda m, s=s, n=n: m[f"rows of {s}"] >= n for s, n in expected.items()}


def prune(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete versions but the current one and the latest others, keep in all; returns how many."""
    fs, p = _fs(spark, root)
    now = (current(spark, root) or "").rsplit("/", 1)[-1]
    old = sorted(((s.getModificationTime(), s.getPath()) for s in fs.listStatus(p) if s.getPath().getName().startswith("v-") and s.getPath().getName() != now), key=lambda x: -x[0])
    for _, path in old[max(0, keep - 1) :]:
        fs.delete(path, True)
    return len(old[max(0, keep - 1) :])
