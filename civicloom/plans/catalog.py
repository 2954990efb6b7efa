"""Catalog search, facets and status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicloom.session import stage


def search(df: DataFrame, condition: Column, order: list[Column], limit: int) -> tuple[DataFrame, DataFrame]:
    """(the first ``limit`` hits, a row with ``truncated``): the limit is the feature."""
    hits = df.filter(condition)
    return hits.orderBy(*order).limit(limit), hits.limit(limit + 1).agg((F.count("*") > limit).alias("truncated"))


def facets(df: DataFrame, columns: list[str]) -> DataFrame:
    """(facet, value, n) for each column, in one pass over the table."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in columns]))
    return df.select(pairs.alias("p")).groupBy("p.facet", "p.value").agg(F.count("*").alias("n"))


def page_after(df: DataFrame, key: str, after: object, size: int) -> DataFrame:
    """The next ``size`` rows after a key, in order."""
    return df.filter(F.col(key) > F.lit(after)).orderBy(key).limit(size)


def plans_due(plans: DataFrame, cursors: DataFrame, now: Column, key: str = "plan_id", cadence_days: str = "cadence_days", done: str = "updated_at") -> DataFrame:
    """Plans never run, or whose cadence has passed since."""
    joined = plans.join(cursors.select(key, done), key, "left")
    return joined.filter(F.col(done).isNull() | (F.unix_timestamp(now) - F.unix_timestamp(done) >= F.col(cadence_days) * 86400))


def linked_identifiers(pairs: DataFrame) -> DataFrame:
    """(id, root): ids joined by chains of pairs of any length, each with the least id it reaches.

    Each round takes the least root among the neighbours and then the root of that root, until no root changes.
    """
    both = stage(pairs.select(F.col("a"), F.col("b")).unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    reach = stage(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("root")), "reach")
    while True:
        onward = both.join(reach.select(F.col("a").alias("b"), F.col("root").alias("r")), "b").groupBy("a").agg(F.min("r").alias("r"))
        nearer = reach.join(onward, "a", "left").select("a", F.col("root").alias("_old"), F.least("root", F.coalesce("r", "root")).alias("_near"))
        jumped = nearer.join(reach.select(F.col("a").alias("_near"), F.col("root").alias("_far")), "_near", "left")
        after = stage(jumped.select("a", "_old", F.least("_near", F.coalesce("_far", "_near")).alias("root")), "reach")
        reach = after.select("a", "root")
        if after.filter("root != _old").isEmpty():
            return reach.select(F.col("a").alias("id"), "root")
