"""Keyed tables kept by a stream, and windows over events (an extension)."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from py4j.java_gateway import JavaObject
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from civicloom.operators.keyed import upsert
from civicloom.operators.pick import distinct_on
from civicloom.sources.sinks import write_report


BUCKETS = 64


def keep_table(stream: DataFrame, path: str, keys: Sequence[str], newest: str, checkpoint: str, policy: dict[str, str] | None = None, buckets: int = BUCKETS) -> StreamingQuery:
    """Upserts each micro-batch into the table at ``path``; a batch replayed changes nothing.

    The table is cut into buckets by key. A batch reads and rewrites only the buckets it touches; a list of which
    version each bucket has is put in place last, so a batch that fails leaves the table as it was. Versions that
    neither of the last two lists names are deleted.
    """

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = distinct_on(batch, keys, [F.desc_nulls_last(newest), F.xxhash64(*batch.columns)]).withColumn("_bucket", _bucket(keys, buckets))
        rows = rows.persist()
        touched = sorted(r["_bucket"] for r in rows.select("_bucket").distinct().collect())  # at most as many as buckets
        now = current_versions(spark, path, number)
        held = [f"{path}/v{now[b]}/_bucket={b}" for b in touched if b in now]
        out = rows
        if held:
            old = spark.read.schema(batch.schema).parquet(*held).withColumn("_bucket", _bucket(keys, buckets))
            out = upsert(old, rows, [*keys, "_bucket"], policy)
        if touched:
            out.repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{path}/v{number}")
        rows.unpersist()
        _put_list(spark, path, number, {**now, **{b: number for b in touched}})

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _files(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def _lists(spark: SparkSession, path: str) -> list[int]:
    fs, at = _files(spark, path)
    folder = at(f"{path}/_lists")
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(folder) if s.getPath().getName().isdigit()) if fs.exists(folder) else []


def current_versions(spark: SparkSession, path: str, before: int | None = None) -> dict[int, int]:
    """The version of every bucket by the newest list (older than ``before``)."""
    found = [n for n in _lists(spark, path) if before is None or n < before]
    if not found:
        return {}
    text = spark.read.text(f"{path}/_lists/{found[-1]}", wholetext=True).first()["value"]
    return {int(b): int(v) for b, v in json.loads(text).items()}


def _put_list(spark: SparkSession, path: str, number: int, versions: dict[int, int]) -> None:
    write_report(spark, f"{path}/_lists/{number}", {str(b): v for b, v in versions.items()})
    fs, at = _files(spark, path)
    lists = _lists(spark, path)
    wanted = {v for n in lists[-2:] for v in current_versions(spark, path, n + 1).values()}
    for n in lists[:-2]:
        fs.delete(at(f"{path}/_lists/{n}"), False)
    for s in fs.listStatus(at(path)):
        name = s.getPath().getName()
        if name[0] == "v" and name[1:].isdigit() and int(name[1:]) not in wanted and int(name[1:]) <= number:
            fs.delete(s.getPath(), True)


def read_kept(spark: SparkSession, path: str, schema: object) -> DataFrame:
    """The kept table as the newest list has it."""
    found = [f"{path}/v{v}/_bucket={b}" for b, v in current_versions(spark, path).items()]
    return spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)


def windowed_counts(events: DataFrame, at: str, by: str, value: str, size: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Number and sum per window and key, of a stream or a table; late rows are dropped after ``late``."""
    marked = events.withWatermark(at, late) if events.isStreaming else events
    w = marked.groupBy(F.window(at, size), by).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return w.select(F.col("window.start").alias("window_start"), by, "n", "total")


def sessions(events: DataFrame, at: str, by: str, gap: str = "30 minutes") -> DataFrame:
    """Sessions of each key: rows no further apart than ``gap``."""
    marked = events.withWatermark(at, gap) if events.isStreaming else events
    s = marked.groupBy(F.session_window(at, gap), by).agg(F.count("*").alias("n"))
    return s.select(F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), by, "n")


def run_to_end(query: StreamingQuery, then: Callable[[], None] | None = None) -> None:
    """Waits until everything there was has been processed."""
    query.awaitTermination()
    if then:
        then()
