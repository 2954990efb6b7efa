"""One row per key: newest, best ranked, or the only one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def distinct_on(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key by ``order``, which must be total for a stable answer.

    Nulls in a key are a key of their own. Spell out where nulls sort: Spark's default is the
    opposite of PostgreSQL's. The window keeps only one row per key and task before the shuffle.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def latest_per_key(df: DataFrame, keys: Sequence[str], version: str, usable: Column | None = None) -> DataFrame:
    """The newest usable version of each key; with ``usable``, else the newest of all."""
    first = [F.when(usable, 0).otherwise(1)] if usable is not None else []
    return distinct_on(df, keys, [*first, F.desc_nulls_last(version)])


def exactly_one(links: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value): the value of keys linked to one value only; others get null."""
    return links.groupBy(key).agg(F.countDistinct(value).alias("_n"), F.min(value).alias("_v")).select(key, F.when(F.col("_n") == 1, F.col("_v")).alias(value))


def precedence_winner(assertions: DataFrame, ranking: DataFrame, display: DataFrame, entity: str, kind: str = "name_kind", source: str = "dataset_id", vintage: str = "source_vintage", ties: Sequence[str] = ()) -> DataFrame:
    """The winning assertion of each entity: first displayed kind, best rank, newest vintage, then ties.

    ``ranking`` has (kind, source, rank), ``display`` (kind, position); both are small configuration.
    Assertions without a rank or place never win; ``resolved`` refuses to resolve at all while there are any.
    """
    ranked = assertions.join(ranking.select(kind, source, "rank"), [kind, source]).join(display.select(kind, "position"), kind)
    order = [F.asc_nulls_last("position"), F.asc_nulls_last("rank"), F.desc_nulls_last(vintage), F.asc_nulls_last(source), *[F.asc_nulls_last(t) for t in ties]]
    return distinct_on(ranked, [entity], order)


def unranked(counts: DataFrame, ranking: DataFrame, display: DataFrame, kind: str, source: str, extra: str | None = None) -> DataFrame:
    """``counts`` of assertions that no rank covers, with the first reason that applies.

    Reasons, in order: the source is ranked nowhere, the kind is ranked or displayed nowhere, the further
    type ``extra`` is ranked nowhere, or the combination isn't ranked. Each existence is a flag
    from a join with distinct keys, so no row is multiplied.
    """

    def flag(df: DataFrame, from_: DataFrame, on: list[str], name: str) -> DataFrame:
        return df.join(from_.select(*on).distinct().withColumn(name, F.lit(True)), on, "left")

    keys = [kind, source, *([extra] if extra else [])]
    out = flag(counts, ranking, [source], "_s")
    out = flag(flag(out, ranking, [kind], "_k"), display, [kind], "_d")
    out = flag(out, ranking, [extra], "_x") if extra else out.withColumn("_x", F.lit(True))
    out = flag(out, ranking, keys, "_all")
    reason = F.when(F.col("_s").isNull(), "dataset").when(F.col("_k").isNull() | F.col("_d").isNull(), "name_kind").when(F.col("_x").isNull(), "geography_type").otherwise("dataset_kind")
    return out.filter(F.col("_all").isNull() | F.col("_d").isNull()).withColumn("reason", reason).drop("_s", "_k", "_d", "_x", "_all")


def resolved(assertions: DataFrame, ranking: DataFrame, display: DataFrame, entity: str, kind: str = "name_kind", source: str = "dataset_id", vintage: str = "source_vintage", ties: Sequence[str] = ()) -> DataFrame:
    """``precedence_winner`` that fails closed: assertions no rank covers raise an error that names them, and nothing is resolved."""
    counts = assertions.groupBy(source, kind).agg(F.count("*").alias("assertions"))
    bad = unranked(counts, ranking, display, kind, source).orderBy(source, kind)
    listed = bad.limit(21).collect()  # the message, not the data: counts per source and kind
    if listed:
        named = "; ".join(f"{r[source]} {r[kind]} ({r['assertions']}, {r['reason']})" for r in listed[:20])
        raise ValueError(f"unranked assertions: {named}{' and more' if len(listed) > 20 else ''}")
    return precedence_winner(assertions, ranking, display, entity, kind, source, vintage, ties)


def required(df: DataFrame, what: str) -> DataFrame:
    """``df``, unless it is empty: then an error that says what is lacking."""
    if df.isEmpty():
        raise ValueError(f"no {what}")
    return df
