"""Expected against loaded, staged against stored, and fingerprints that don't depend on order."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def coverage_cells(df: DataFrame, expected: str, loaded: str) -> DataFrame:
    """Adds missing, surplus and status; an unknown expectation is not zero and a surplus hides no gap."""
    e, n = F.col(expected), F.coalesce(F.col(loaded), F.lit(0))
    return df.withColumns({
        loaded: n, "missing": F.when(e.isNotNull(), F.greatest(e - n, F.lit(0))), "surplus": F.when(e.isNotNull(), F.greatest(n - e, F.lit(0))),
        "status": F.when(e.isNull(), "unknown").when(n >= e, "complete").otherwise("incomplete"),
    })


def known_total(col: str) -> Column:
    """The sum of ``col``, unknown if any part is."""
    return F.when(F.count_if(F.col(col).isNull()) == 0, F.sum(col))


def tally_disagreements(rolls: DataFrame, votes: DataFrame, key: str, tallies: dict[str, Column], optional: Sequence[str] = ()) -> DataFrame:
    """Rolls whose official totals differ from the counted votes.

    ``tallies`` maps an official total's column to the condition its votes meet. Rolls without one of the
    totals that aren't ``optional`` aren't compared; a null optional total isn't either.
    """
    counted = votes.groupBy(key).agg(*[F.count_if(c).alias(f"counted_{t}") for t, c in tallies.items()])
    joined = rolls.join(counted, key, "left").fillna(0, [f"counted_{t}" for t in tallies])
    needed = [F.col(t).isNotNull() for t in tallies if t not in optional]
    differs = [F.coalesce(F.col(f"counted_{t}") != F.col(t), F.lit(False)) for t in tallies]
    return joined.filter(reduce(Column.__and__, needed)).filter(reduce(Column.__or__, differs))


#: A fingerprint gathers the text of so many rows in one value at most; larger tables are hashed by ranges.
FINGERPRINT_ROWS = 20_000


def fingerprint(df: DataFrame, columns: Sequence[str], order: Sequence[str], name: str, most_rows: int = FINGERPRINT_ROWS) -> DataFrame:
    """(t, n, h): row count and md5 of the rows in order.

    Up to ``most_rows`` rows the digest is that of the joined lines, as a database would write them. A larger table is cut
    into blocks of ``most_rows`` rows by their rank, each block's digest is made where it is, and h is the digest
    of the digests: no task holds more than a block.
    """
    line = F.concat_ws("|", *[F.col(c).cast("string") for c in columns])
    rows = df.select(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], line.alias("_line"))
    keys = [f"_o{i}" for i in range(len(order))]
    total = rows.count()
    blocks = _blocked(rows, keys, most_rows) if total > most_rows else rows.withColumn("_b", F.lit(0).cast("bigint"))
    digest = lambda col: F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(col)), lambda r: r["_line"]), "\n").cast("binary"))
    each = blocks.groupBy("_b").agg(F.count("*").alias("n"), digest(F.struct(*keys, "_line")).alias("_line"))
    if total <= most_rows:
        whole = each.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.max("_line").alias("h"))
    else:
        whole = each.agg(F.sum("n").alias("n"), digest(F.struct("_b", "_line")).alias("h"))
    return whole.select(F.lit(name).alias("t"), "n", "h")


def _blocked(rows: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """Rows with ``_b``, their rank by ``keys`` and line over ``size``: ranks are counted per range, so no window holds the table."""
    sort = [*keys, "_line"]
    ranged = rows.repartitionByRange(*sort).withColumn("_p", F.spark_partition_id())
    from civicloom.session import stage

    held = stage(ranged, "ranged")
    before = held.groupBy("_p").agg(F.count("*").alias("_c"))
    start = before.select("_p", (F.sum("_c").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_c")).alias("_start"))  # one row per range
    rank = F.row_number().over(Window.partitionBy("_p").orderBy(*sort)) - 1
    return held.withColumn("_r", rank).join(F.broadcast(start), "_p").withColumn("_b", F.floor((F.col("_r") + F.col("_start")) / size)).drop("_p", "_r", "_start")


def content_hash(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., n, h): row count and an order-independent hash that is summed where the rows are."""
    hashed = F.xxhash64(*columns).cast("decimal(20,0)")
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.sum(hashed).cast("string").alias("h"))


def multiset_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows one side has more often than the other, with ``side``; empty if both hold the same rows."""
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def scalar_counters(counters: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """One row with a counter per entry, each an aggregate of its own table."""
    parts = [df.agg(expr.alias(name)) for name, (df, expr) in counters.items()]
    return reduce(lambda x, y: x.join(y, how="cross"), parts)  # one row each


def archive_reconciliation(targets: DataFrame) -> DataFrame:
    """Members whose rows don't add up: parsed = inserted + existing + rejected, none rejected, some parsed."""
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    adds_up = n("rows_parsed") == n("rows_inserted") + n("rows_existing") + n("rows_rejected")
    return targets.filter(~(adds_up & (n("rows_rejected") == 0) & (n("rows_parsed") > 0)))


def overlapping_terms(spans: DataFrame, start: str, end: str, period_years: int, first_year: int, last_year: int, month: int = 1, day: int = 1) -> DataFrame:
    """``spans`` with ``term_start``: every period of ``period_years`` that a span overlaps.

    Half-open: a span that ends on the day a period begins isn't in it; a null end is open. The periods
    are computed from the span's own years, so this needs no join at all.
    """
    year = lambda c: F.year(c)
    low = F.greatest(F.lit(first_year), F.floor((year(F.col(start)) - 1 - first_year) / period_years) * period_years + first_year)
    high = F.least(F.lit(last_year), F.coalesce(year(F.col(end)), F.lit(last_year)))
    listed = spans.filter(F.col(start).isNotNull()).withColumn("_low", low.cast("int")).withColumn("_high", high.cast("int")).filter("_low <= _high")
    listed = listed.withColumn("_y", F.explode(F.sequence("_low", "_high", F.lit(period_years))))
    at = lambda y: F.make_date(y, F.lit(month), F.lit(day))
    listed = listed.withColumn("term_start", at(F.col("_y")))
    hit = (F.col(start).cast("date") < at(F.col("_y") + period_years)) & F.coalesce(F.col(end).cast("date") > F.col("term_start"), F.lit(True))
    return listed.filter(hit).drop("_low", "_high", "_y")
