"""Joins to a table of unique keys that survive a key holding a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A dictionary of at most so many rows is broadcast; its rows are keys plus a few scalars.
BROADCAST_ROWS = 20_000
#: A key is hot when it holds more than this share of the rows; so at most HOT_SHARE keys are hot.
HOT_SHARE = 2_000


def lookup_join(rows: DataFrame, dictionary: DataFrame, on: list[str], n_dictionary: int, broadcast_rows: int = BROADCAST_ROWS, hot_share: int = HOT_SHARE) -> DataFrame:
    """Left join of ``rows`` to ``dictionary``, whose ``on`` columns are unique; no key floods one task.

    A dictionary of checked size is broadcast. A larger one is split: the keys that hold more than one in
    ``hot_share`` of the rows are at most ``hot_share`` many, so their entries are broadcast; what is
    left has no hot key and is joined by a shuffle. Null keys match nothing and are never shuffled.
    """
    if n_dictionary <= broadcast_rows:
        return rows.join(F.broadcast(dictionary), on, "left")
    known = F.lit(True)
    for c in on:
        known = known & F.col(c).isNotNull()
    total = rows.filter(known).count()
    counts = rows.filter(known).groupBy(*on).count().filter(F.col("count") * hot_share > total).select(*on)
    hot = [tuple(r) for r in counts.collect()]  # at most hot_share rows by construction
    added = [c for c in dictionary.columns if c not in on]
    plain = rows.filter(~known)
    for c in added:
        plain = plain.withColumn(c, F.lit(None).cast(dictionary.schema[c].dataType))
    cold_rows, parts = rows.filter(known), []
    if hot:
        keys = rows.sparkSession.createDataFrame(hot, rows.select(*on).schema).select(*on)
        hot_entries = dictionary.join(F.broadcast(keys), on, "left_semi")
        hot_rows = cold_rows.join(F.broadcast(keys), on, "left_semi")
        parts.append(hot_rows.join(F.broadcast(hot_entries), on, "left"))
        cold_rows = cold_rows.join(F.broadcast(keys), on, "left_anti")
    parts.append(cold_rows.join(dictionary.hint("shuffle_merge"), on, "left"))
    out = plain.select(*on, *[c for c in rows.columns if c not in on], *added)
    for part in parts:
        out = out.unionByName(part)
    return out


def salted_join(left: DataFrame, right: DataFrame, on: list[str], n_right: int, broadcast_rows: int = BROADCAST_ROWS, salts: int = 16, hot_share: int = HOT_SHARE) -> DataFrame:
    """Inner equi-join where a key of ``left`` may hold a third of its rows and ``right`` is the smaller side.

    A right side of checked size is broadcast. Of a larger one only the entries of hot keys (more than one in
    ``hot_share`` of the left rows, so at most ``hot_share`` keys) are copied, once per salt, and only their left
    rows are dealt over the salts; all others are joined as they are.
    """
    if n_right <= broadcast_rows:
        return left.join(F.broadcast(right), on)
    total = left.count()
    hot = left.groupBy(*on).count().filter(F.col("count") * hot_share > total).select(*on, F.lit(True).alias("_hot"))
    listed = [tuple(r) for r in hot.collect()]  # at most hot_share rows by construction
    if not listed:
        return left.join(right, on)
    keys = F.broadcast(left.sparkSession.createDataFrame(listed, hot.schema))
    salt = F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int")
    dealt = left.join(keys, on, "left").withColumn("_salt", F.when(F.col("_hot"), salt).otherwise(0)).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    copied = right.join(keys, on, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return dealt.join(copied, [*on, "_salt"]).drop("_salt")


def block_join(left: DataFrame, right: DataFrame, on: list[str], block_rows: int = 2_000, most_hot: int = 20_000) -> DataFrame:
    """All pairs of ``left`` and ``right`` rows with equal keys, for pairs that a caller must inspect whole.

    A key with more than ``block_rows`` rows (or one in ``most_hot`` of all rows, so that at most
    ``most_hot`` keys count as hot and their list is bounded) is cut into blocks: left block i meets right
    block j in a task of its own, so no task holds more than one pair of blocks of a key. One pass over the keys of
    ``right``, which may best be staged, tells whether there is such a key; without one this is a plain join. The
    columns of both sides must differ except for ``on``.
    """
    counts = right.groupBy(*on).count()
    size = counts.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("total"), F.coalesce(F.max("count"), F.lit(0)).alias("most")).first()
    if size["most"] <= block_rows or size["most"] * most_hot <= size["total"]:
        return left.join(right, on)
    hot = counts.filter((F.col("count") > block_rows) & (F.col("count") * most_hot > size["total"]))
    hot = hot.select(*on, F.ceil(F.col("count") / block_rows).cast("int").alias("_blocks"))
    hot = F.broadcast(right.sparkSession.createDataFrame([tuple(r) for r in hot.collect()], hot.schema))  # at most most_hot rows

    def cut(df: DataFrame, mine: str, other: str) -> DataFrame:
        own = [c for c in df.columns if c not in on]
        known = df.join(hot, on, "left").withColumn("_blocks", F.coalesce("_blocks", F.lit(1)))
        return known.withColumn(mine, F.pmod(F.xxhash64(*own), F.col("_blocks")).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).drop("_blocks")

    return cut(left, "_i", "_j").join(cut(right, "_j", "_i"), [*on, "_i", "_j"]).drop("_i", "_j")
