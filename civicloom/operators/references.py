"""References to records that are missing, deleted or late."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicloom.functions.text import loose_key
from civicloom.operators.membership_filter import build_filter, might_contain
from civicloom.operators.skew import BROADCAST_ROWS, lookup_join
from civicloom.session import stage

#: Joins the parts of a composite key; it is white space to no one and occurs in no key.
SEPARATOR = "\u0001"


@dataclass(frozen=True)
class Reference:
    """One referring column (or column group) and the table it points to."""

    table: str
    column: str
    record_id: str
    columns: tuple[str, ...]
    at: str
    period: Column
    parent: str
    parent_columns: tuple[str, ...]


def _key(columns: tuple[str, ...]) -> Column:
    return F.concat_ws(SEPARATOR, *[loose_key(F.col(c)) for c in columns])


def parent_keys(parent: DataFrame, columns: tuple[str, ...], loaded_at: str = "loaded_at", deleted_at: str = "deleted_at") -> DataFrame:
    """(key, live_from) with one row per key: the first load of a row that isn't deleted, else null.

    Rows with a null in a key column can't be referred to and are left out.
    """
    known = F.lit(True)
    for c in columns:
        known = known & F.col(c).isNotNull()
    alive = F.when(F.col(deleted_at).isNull(), F.coalesce(F.col(loaded_at), F.lit("0001-01-01").cast("timestamp_ntz")))
    return parent.filter(known).groupBy(_key(columns).alias("key")).agg(F.min(alive).alias("live_from"))


def dangling(rows: DataFrame, parent: DataFrame, ref: Reference, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The references of ``rows`` that don't hold: (table_name, column_name, record_id, period, reason).

    Bloom filters of the parent's keys, as many as the keys need within a bound, prove the definite orphans where they are
    read; only what it lets through is joined with the parent exactly. The reason is ``missing`` (no such
    key), ``deleted`` (only deleted rows have it) or ``late`` (loaded after the referring row).

    Null references are no references. Rows without their own time count as later than any load. Several
    parent rows with one key count as one: it is enough that one of them is alive in time. An empty
    parent makes every reference missing. Repeated rows give repeated results.
    """
    parents = stage(parent_keys(parent, ref.parent_columns), "parents")
    n_parents = parents.count()
    known = F.lit(True)
    for c in ref.columns:
        known = known & F.col(c).isNotNull()
    refs = rows.filter(known).select(
        F.col(ref.record_id).cast("string").alias("record_id"), _key(ref.columns).alias("ref_key"), F.col(ref.at).alias("at"), ref.period.cast("int").alias("period")
    )
    filters = build_filter(parents, "key", n_parents)
    # A definite orphan keeps a null key: it matches nothing and takes no part in a shuffle.
    probed = refs.withColumn("key", F.when(might_contain(filters, F.col("ref_key")), F.col("ref_key"))).drop("ref_key")
    joined = lookup_join(probed, parents.withColumn("has_key", F.lit(True)), ["key"], n_parents, broadcast_rows)
    reason = (
        F.when(F.col("has_key").isNull(), "missing").when(F.col("live_from").isNull(), "deleted").when(F.col("live_from") > F.col("at"), "late")
    )
    return joined.select(F.lit(ref.table).alias("table_name"), F.lit(ref.column).alias("column_name"), "record_id", "period", reason.alias("reason")).filter(F.col("reason").isNotNull())


def dangling_counts(found: DataFrame) -> DataFrame:
    """Dangling references per table, column, period and reason; aggregated before the shuffle."""
    return found.groupBy("table_name", "column_name", "period", "reason").agg(F.count("*").alias("n"))
