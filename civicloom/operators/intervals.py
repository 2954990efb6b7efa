"""Continuous periods and gaps from overlapping, nested and touching intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Days of a time shard. Within one shard an entity has at most so many distinct start days.
SHARD_DAYS = 4096
#: Days between which shards are cut; what lies outside belongs to the first or last shard.
FIRST_DAY, LAST_DAY = -110_000, 60_000
OPEN_END = "9999-12-31"


def _shard(day: Column, width: int) -> Column:
    low, high = FIRST_DAY // width, LAST_DAY // width
    return F.greatest(F.lit(low), F.least(F.lit(high), F.floor(day / F.lit(width)).cast("int")))


def _merge(spans: DataFrame, by: list[str]) -> DataFrame:
    """Coalesces spans of whole days (first, last) that overlap or touch, within each group ``by``."""
    before = Window.partitionBy(*by).orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*by).orderBy("first", "last").rowsBetween(Window.unboundedPreceding, 0)
    starts = F.coalesce(F.col("first") > F.max("last").over(before) + 1, F.lit(True))
    return (
        spans.withColumn("_new", starts.cast("int")).withColumn("_run", F.sum("_new").over(upto)).groupBy(*by, "_run").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("_run")
    )


def merged_periods(rows: DataFrame, by: list[str], start: str, end: str, shard_days: int = SHARD_DAYS) -> DataFrame:
    """(by..., first, last): the longest stretches of covered days, as day numbers since 1970-01-01.

    Two levels. Each interval is clipped into time shards; within a shard one row per start day is kept,
    the longest, before the shuffle (so an entity with a third of all rows sends at most ``shard_days``
    rows per shard and task), and merged. Then the few pieces of an entity are stitched: pieces that touch
    at a shard boundary coalesce, as pieces that touch anywhere do.

    Both days belong to the interval; a null end is open (9999-12-31). Rows with a null start or an end
    before the start are left out. A null in ``by`` is a value of its own. An empty table gives none.
    """
    first, last = F.unix_date(F.col(start)), F.unix_date(F.coalesce(F.col(end), F.lit(OPEN_END).cast("date")))
    days = rows.filter(F.col(start).isNotNull()).select(*by, first.alias("first"), last.alias("last")).filter(F.col("last") >= F.col("first"))
    low, high = FIRST_DAY // shard_days, LAST_DAY // shard_days
    cut = days.withColumn("_shard", F.explode(F.sequence(_shard(F.col("first"), shard_days), _shard(F.col("last"), shard_days))))
    clipped = (
        cut.withColumn("first", F.when(F.col("_shard") > low, F.greatest(F.col("first"), F.col("_shard") * shard_days)).otherwise(F.col("first")))
        .withColumn("last", F.when(F.col("_shard") < high, F.least(F.col("last"), (F.col("_shard") + 1) * shard_days - 1)).otherwise(F.col("last")))
        .groupBy(*by, "_shard", "first")
        .agg(F.max("last").alias("last"))
    )
    local = _merge(clipped, [*by, "_shard"]).drop("_shard")
    return _merge(local, by)


def periods_and_gaps(rows: DataFrame, by: list[str], start: str, end: str, shard_days: int = SHARD_DAYS) -> DataFrame:
    """(by..., kind, start_date, end_date): periods as ``merged_periods`` and the gaps between them.

    The dates are YYYY-MM-DD. A gap is the uncovered days between two successive periods of a group.
    """
    merged = merged_periods(rows, by, start, end, shard_days)
    following = F.lead("first").over(Window.partitionBy(*by).orderBy("first"))
    both = merged.withColumn("_next", following).withColumn(
        "_span",
        F.explode(
            F.filter(
                F.array(
                    F.struct(F.lit("period").alias("kind"), F.col("first").alias("a"), F.col("last").alias("b")),
                    F.struct(F.lit("gap").alias("kind"), (F.col("last") + 1).alias("a"), (F.col("_next") - 1).alias("b")),
                ),
                lambda s: s["b"].isNotNull(),
            )
        ),
    )
    text = lambda c: F.date_from_unix_date(c).cast("string")
    return both.select(*by, F.col("_span.kind").alias("kind"), text(F.col("_span.a")).alias("start_date"), text(F.col("_span.b")).alias("end_date"))
