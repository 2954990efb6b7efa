"""Session defaults, table access and the shared staging folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[*]", app: str = "civicloom", **conf: str) -> SparkSession:
    """A session with UTC, ANSI and adaptive execution; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.master(master).appName(app)
    settings = DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of the data folder ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Where the cluster names none (tests on one machine) a temporary folder is set, once.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    made = "file://" + os.path.join(tempfile.gettempdir(), f"civicloom-{os.getpid()}")
    spark.sparkContext.setCheckpointDir(made)
    return made


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as parquet into the shared folder and read it back.

    This cuts the lineage with a durable copy: a lost executor rereads files instead of
    recomputing, and the copy is columnar so later passes prune it. The files go when the
    application ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/staged/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)
