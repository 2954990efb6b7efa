"""Named exports with fixed columns and order, and reports."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def export(df: DataFrame, path: str, kind: str, columns: Sequence[str], order: Sequence[str]) -> None:
    """Writes one csv, jsonl or parquet folder; refuses one that exists.

    Decimals keep their digits, an empty result keeps its header, and the folder only appears when complete
    (Spark's committer writes beside it first).
    """
    _write(df.select(*columns).orderBy(*order), path, kind, header=True)


def _write(rows: DataFrame, path: str, kind: str, header: bool) -> None:
    if kind == "parquet":
        rows.write.mode("errorifexists").parquet(path)
    elif kind == "csv":
        rows.write.mode("errorifexists").option("header", header).option("emptyValue", "").csv(path)
    elif kind == "jsonl":
        rows.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("value")).write.mode("errorifexists").text(path)
    else:
        raise ValueError(f"unknown kind {kind}")


def _file_system(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def export_file(df: DataFrame, path: str, columns: Sequence[str], order: Sequence[str], kind: str = "csv") -> None:
    """One csv, jsonl or parquet file on any file system of the cluster; it appears whole and replaces nothing.

    The rows are sorted and written by all tasks beside the target; the parts, which are in order, are then joined
    in the file system's own streams (a parquet file is written by one task) and renamed into place.
    """
    spark = df.sparkSession
    fs, target = _file_system(spark, path)
    if fs.exists(target):
        raise FileExistsError(path)
    beside = f"{path}.{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(beside)
    try:
        rows = df.select(*columns).orderBy(*order)
        _write(rows.coalesce(1) if kind == "parquet" else rows, f"{beside}/parts", kind, header=False)
        parts = sorted((s.getPath() for s in fs.listStatus(jvm.org.apache.hadoop.fs.Path(beside, "parts")) if s.getPath().getName().startswith("part-")), key=lambda p: p.getName())
        whole = jvm.org.apache.hadoop.fs.Path(beside, "whole")
        if kind == "parquet":
            whole = parts[0]
        else:
            out = fs.create(whole, False)
            if kind == "csv":
                out.write(bytearray((",".join(_csv_name(c) for c in columns) + "\n").encode()))
            for part in parts:
                source = fs.open(part)
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 20, False)
                source.close()
            out.close()
        if fs.exists(target) or not fs.rename(whole, target):
            raise FileExistsError(path)
    finally:
        fs.delete(folder, True)


def _csv_name(name: str) -> str:
    return '"' + name.replace('"', '""') + '"' if any(c in name for c in ',"\n') else name


def write_report(spark: SparkSession, path: str, report: Mapping[str, object]) -> None:
    """A small report as JSON with sorted keys; a reader sees the old one or the new one, never a part."""
    fs, target = _file_system(spark, path)
    jvm = spark.sparkContext._jvm
    beside = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    out = fs.create(beside, False)
    out.write(bytearray((json.dumps(report, indent=2, sort_keys=True, default=str) + "\n").encode()))
    out.close()
    replace = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    replace[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri() if target.toUri().getScheme() else fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(beside), fs.makeQualified(target), replace)
