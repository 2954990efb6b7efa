"""Keyed table maintenance as DataFrame functions: what INSERT, UPDATE, DELETE and MERGE would leave behind.

Every function takes the table as it is and the rows that arrive and returns the table as it
becomes; nothing is changed in place, so all outputs of a step see the same input. Keys are compared so that null
equals null. Of several arriving rows with one key the caller picks one first (``pick.distinct_on``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from civicloom.operators.pick import distinct_on

#: How a column is set where a row is already there.
POLICIES = {"new", "old", "new_if_known", "old_if_known", "null", "merge", "add", "increment"}


def _on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [left[k].eqNullSafe(right[k]) for k in keys])


def absent(rows: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key isn't in the table."""
    known = table.select(*keys).distinct()
    return rows.join(known, _on(rows, known, keys), "left_anti")


def present(rows: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is in the table."""
    known = table.select(*keys).distinct()
    return rows.join(known, _on(rows, known, keys), "left_semi")


def insert_absent(table: DataFrame, rows: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """The table plus the rows whose key it lacks; of several with one key the first by ``order``, by all columns if none is given."""
    ordered = order or [F.asc_nulls_last(c) for c in rows.columns if c not in keys and not isinstance(rows.schema[c].dataType, (MapType, VariantType))]
    return table.unionByName(absent(distinct_on(rows, keys, ordered or [F.lit(1)]), table, keys), allowMissingColumns=True)


def upsert(table: DataFrame, rows: DataFrame, keys: Sequence[str], policy: dict[str, str] | None = None, default: str = "new") -> DataFrame:
    """The table after the rows: one full join, each column set by its policy.

    new, old: that side's value. new_if_known, old_if_known: that side's unless null. null: emptied.
    merge: the old map under the new one. add: the sum. increment: one more.
    """
    policy = policy or {}
    assert set(policy.values()) | {default} <= POLICIES, "unknown policy"
    t = table.select(F.struct(*table.columns).alias("t"), *[F.col(k).alias(f"_t_{k}") for k in keys])
    s = rows.select(F.struct(*rows.columns).alias("s"), *[F.col(k).alias(f"_s_{k}") for k in keys])
    both = t.join(s, reduce(Column.__and__, [F.col(f"_t_{k}").eqNullSafe(F.col(f"_s_{k}")) for k in keys]), "full")
    old_there, new_there = F.col("t").isNotNull(), F.col("s").isNotNull()
    out = []
    for c in table.columns:
        old = F.col("t")[c]
        new = F.col("s")[c] if c in rows.columns else F.lit(None).cast(table.schema[c].dataType)
        how = "new" if c in keys else policy.get(c, default if c in rows.columns else "old")
        value = {
            "new": new, "old": old, "new_if_known": F.coalesce(new, old), "old_if_known": F.coalesce(old, new), "null": F.lit(None).cast(table.schema[c].dataType),
            "add": F.coalesce(old, F.lit(0)) + F.coalesce(new, F.lit(0)), "increment": F.coalesce(old, F.lit(0)) + 1,
        }.get(how)
        if how == "merge":
            value = _merged(old, new, F.create_map().cast(table.schema[c].dataType))
        out.append(F.when(old_there & new_there, value).when(old_there, old).otherwise(new).cast(table.schema[c].dataType).alias(c))
    return both.select(*out)


def _merged(old: Column, new: Column, empty: Column) -> Column:
    kept = F.map_filter(F.coalesce(old, empty), lambda k, _: ~F.coalesce(F.map_contains_key(new, k), F.lit(False)))
    return F.when(new.isNull(), old).otherwise(F.map_concat(kept, new))


def diff_action(table: DataFrame, rows: DataFrame, keys: Sequence[str], compared: Sequence[str] | None = None) -> DataFrame:
    """The arriving rows with ``action``: insert, update or unchanged; a write can skip the unchanged."""
    compared = list(compared or [c for c in rows.columns if c not in keys])
    t = table.select(*[F.col(k).alias(f"_t_{k}") for k in keys], F.struct(*compared).alias("_old"))
    joined = rows.join(t, reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_t_{k}")) for k in keys]), "left")
    action = F.when(F.col("_old").isNull(), "insert").when(F.struct(*compared).eqNullSafe(F.col("_old")), "unchanged").otherwise("update")
    return joined.withColumn("action", action).drop("_old", *[f"_t_{k}" for k in keys])


def delete_absent(table: DataFrame, snapshot: DataFrame, keys: Sequence[str], scope: Column | None = None) -> DataFrame:
    """The table without the rows of ``scope`` that the snapshot lacks; rows outside the scope stay."""
    if scope is None:
        return present(table, snapshot, keys)
    marked = table.withColumn("_in", F.coalesce(scope, F.lit(False)))
    kept = present(marked.filter("_in"), snapshot, keys)
    return kept.unionByName(marked.filter(~F.col("_in"))).drop("_in")


def supersede(children: DataFrame, parent: str, artifact: str, rewritten: DataFrame, current: str = "current_artifact") -> DataFrame:
    """The children without those of an older artifact, for exactly the parents that were rewritten.

    ``rewritten`` has (parent, current_artifact).
    """
    now = rewritten.select(F.col(parent).alias("_p"), F.col(current).alias("_a")).distinct()
    joined = children.join(now, F.col(parent) == F.col("_p"), "left")
    return joined.filter(F.col("_p").isNull() | F.col(artifact).eqNullSafe(F.col("_a"))).drop("_p", "_a")


def accumulate(table: DataFrame, seen: DataFrame, keys: Sequence[str], counter: str) -> DataFrame:
    """The table with ``counter`` increased by the rows seen, new keys included."""
    return upsert(table, seen.groupBy(*keys).agg(F.sum(counter).alias(counter)), keys, {counter: "add"})


def fill_from(table: DataFrame, lookup: DataFrame, on: Sequence[str], column: str) -> DataFrame:
    """The table with null ``column`` filled from ``lookup``, unique on ``on``."""
    found = lookup.select(*on, F.col(column).alias("_found"))
    return table.join(found, list(on), "left").withColumn(column, F.coalesce(column, "_found")).drop("_found").select(*table.columns)


def remap(rows: DataFrame, column: str, merged: DataFrame, duplicate: str, survivor: str, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows after duplicates became survivors, rows set aside because their new key was taken).

    Where a repointed row meets the survivor's own row under ``keys``, or another repointed one, the
    survivor's (else the least duplicate's) stays and the other is set aside whole.
    """
    pairs = merged.select(F.col(duplicate).alias("_d"), F.col(survivor).alias("_s")).distinct()
    moved = rows.join(pairs, F.col(column) == F.col("_d"), "left").withColumn("_old", F.col(column)).withColumn("_moved", F.col("_s").isNotNull()).withColumn(column, F.coalesce("_s", column))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("_moved", "_old"))
    ranked = moved.withColumn("_rank", rank)
    back = ranked.filter("_rank > 1 AND _moved").withColumn(column, F.col("_old"))
    return ranked.filter("_rank = 1 OR NOT _moved").select(*rows.columns), back.select(*rows.columns)


def replace_slice(df: DataFrame, path: str, slices: Sequence[str]) -> None:
    """Writes the slices that ``df`` has in place of those at ``path``; other slices stay untouched."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*slices).parquet(path)


def replace_all(table: DataFrame, rows: DataFrame) -> DataFrame:
    """The arriving rows in the table's columns: what deleting everything and inserting them leaves."""
    return table.limit(0).unionByName(rows, allowMissingColumns=True).select(*table.columns)


def guarded_changes(before: DataFrame, after: DataFrame, keys: Sequence[str], guarded: Sequence[str], resolved: DataFrame) -> DataFrame:
    """(keys..., column) of guarded columns that a step changed to anything but what the resolver says; no row means it may be written.

    ``resolved``: (keys..., guarded...). A row the resolver doesn't have mustn't change; new rows count as changed from null.
    """
    b = before.select(*keys, *[F.col(c).alias(f"_b_{c}") for c in guarded])
    r = resolved.select(*keys, *[F.col(c).alias(f"_r_{c}") for c in guarded], F.lit(True).alias("_known"))
    both = after.select(*keys, *guarded).join(b, list(keys), "left").join(r, list(keys), "left")
    wrong = [F.when(~F.col(c).eqNullSafe(F.col(f"_b_{c}")) & ~(F.col("_known").isNotNull() & F.col(c).eqNullSafe(F.col(f"_r_{c}"))), c) for c in guarded]
    return both.select(*keys, F.explode(F.array_compact(F.array(*wrong))).alias("column"))
