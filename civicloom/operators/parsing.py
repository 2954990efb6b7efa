"""Delimited lines into typed rows, with the lines that fail set apart and the reason given."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicloom.operators.skew import BROADCAST_ROWS, lookup_join
from civicloom.session import stage


@dataclass(frozen=True)
class Layout:
    """Columns of one kind of line; ``spare`` allows one more field if it is empty and last."""

    name: str
    columns: tuple[str, ...]
    separator: str = "|"
    spare: bool = False


#: For a trimmed value, the reason why it is invalid, or null.
Rule = Callable[[Column], Column]


def real_date(pattern: str, shape: str, optional: bool = True) -> Rule:
    """A calendar date written as ``pattern``, of the form ``shape``; empty is valid if optional."""

    def rule(v: Column) -> Column:
        good = v.rlike(shape) & F.try_to_timestamp(F.when(v.rlike(shape), v), F.lit(pattern)).isNotNull()
        return F.when(((v == "") & F.lit(optional)) | F.coalesce(good, F.lit(False)), None).otherwise("not a date as " + pattern)

    return rule


def matching(shape: str, reason: str) -> Rule:
    """A value of the form ``shape``."""
    return lambda v: F.when(v.rlike(shape), None).otherwise(reason)


def number_between(low: float, high: float, shape: str, reason: str, optional: bool = True) -> Rule:
    """A number of the form ``shape`` within [low, high]; empty is valid if optional."""

    def rule(v: Column) -> Column:
        x = F.when(v.rlike(shape), v).try_cast("double")
        good = F.coalesce(x.between(low, high), F.lit(False))
        return F.when(((v == "") & F.lit(optional)) | good, None).otherwise(reason)

    return rule


def split_line(line: str, separator: str) -> tuple[list[str] | None, str | None]:
    """Fields of a line in which fields may be quoted, or the reason why its quoting is broken."""
    fields: list[str] = []
    at, end = 0, len(line)
    while True:
        if at < end and line[at] == '"':
            close = line.find('"', at + 1)
            while close >= 0 and line.startswith('"', close + 1):
                close = line.find('"', close + 2)
            if close < 0:
                return None, "quote not closed"
            fields.append(line[at + 1 : close].replace('""', '"'))
            if close + 1 == end:
                return fields, None
            if line[close + 1] != separator:
                return None, "text after the closing quote"
            at = close + 2
        else:
            stop = line.find(separator, at)
            fields.append(line[at:] if stop < 0 else line[at:stop])
            if stop < 0:
                return fields, None
            at = stop + 1


def _quoted(separator: str) -> Callable[[Column], Column]:
    @F.pandas_udf("fields array<string>, broken string")
    def parse(lines: pd.Series) -> pd.DataFrame:
        out = [(None, None) if x is None else split_line(x, separator) for x in lines]
        return pd.DataFrame(out, columns=["fields", "broken"])

    return parse


def split_records(rows: DataFrame, raw: str, separator: str) -> DataFrame:
    """Adds ``fields`` and ``broken`` (what is wrong with the quoting, else null).

    Lines with no quoted field, nearly all of a bulk file, are split in the JVM; only the others visit
    Python, batched. A null line has null fields and is broken.
    """
    sep = "\\" + separator if separator in "|^$.*+?()[]{}\\" else separator
    has_quoted = F.col(raw).rlike(f'(^|{sep})"')
    parsed = rows.withColumn("_q", _quoted(separator)(F.when(has_quoted, F.col(raw))))
    return (
        parsed.withColumn("fields", F.when(has_quoted, F.col("_q.fields")).otherwise(F.split(F.col(raw), sep, -1)))
        .withColumn("broken", F.when(F.col(raw).isNull(), "null line").otherwise(F.col("_q.broken")))
        .drop("_q")
    )


def parse_lines(rows: DataFrame, raw: str, layouts: list[Layout], rules: dict[str, Rule], layout_of: str | None = None, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``rows`` with ``fields`` (trimmed strings), ``layout`` and ``reasons`` (empty: the line is valid).

    The structure is checked line by line: known layout, quoting, number of fields. The values are not:
    each distinct value of a checked column is cast once, what fails makes a dictionary of invalid values
    with reasons, and that is joined back to the lines. The dictionary is staged, so it is computed once.

    All layouts of a call share one separator. Lines of an unknown (or null) layout fail with that
    reason; null lines fail; an empty line has one empty field. Repeated lines stay repeated. Input
    columns called fields, layout or reasons are replaced. An empty table gives an empty result.
    """
    separator = layouts[0].separator
    assert all(x.separator == separator for x in layouts), "one separator a call"
    kind = F.col(layout_of) if layout_of else F.lit(layouts[0].name)
    base = split_records(rows.drop("fields", "layout", "reasons", "broken").withColumn("layout", kind.cast("string")), raw, separator)
    base = base.withColumn("fields", F.transform("fields", lambda x: F.trim(x)))
    structure = F.when(F.col("broken").isNotNull(), F.col("broken")).when(F.col("layout").isNull(), "unknown layout")
    for x in layouts:
        n = len(x.columns)
        fits = F.size("fields") == n
        if x.spare:
            fits = fits | ((F.size("fields") == n + 1) & (F.try_element_at("fields", F.lit(n + 1)) == ""))
        structure = structure.when((F.col("layout") == x.name) & fits, None).when(F.col("layout") == x.name, F.concat(F.lit(f"expected {n} fields, found "), F.size("fields").cast("string")))
    base = base.withColumn("_structure", structure.otherwise("unknown layout"))

    checked = [c for c in rules if any(c in x.columns for x in layouts)]
    for c in checked:
        value = F.lit(None).cast("string")
        for x in layouts:
            if c in x.columns:
                value = F.when((F.col("layout") == x.name) & F.col("_structure").isNull(), F.try_element_at("fields", F.lit(x.columns.index(c) + 1))).otherwise(value)
        base = base.withColumn(f"_v_{c}", value)

    pairs = base.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_v_{c}").alias("value")) for c in checked])).alias("p")).select("p.*")
    distinct = pairs.filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.lit(1).alias("one")).drop("one")
    reason = F.lit(None).cast("string")
    for c in checked:
        reason = F.when(F.col("column") == c, rules[c](F.col("value"))).otherwise(reason)
    invalid = stage(distinct.withColumn("reason", reason).filter(F.col("reason").isNotNull()), "invalid-values")
    sizes = {r["column"]: r["count"] for r in invalid.groupBy("column").count().collect()}  # a row per checked column
    out = base
    for c in checked:
        if c in sizes:
            entries = invalid.filter(F.col("column") == c).select(F.col("value").alias(f"_v_{c}"), F.concat(F.lit(f"{c}: "), F.col("reason")).alias(f"_r_{c}"))
            out = lookup_join(out, entries, [f"_v_{c}"], sizes[c], broadcast_rows)
    found = [F.col(f"_r_{c}") for c in checked if c in sizes]
    reasons = F.filter(F.array(F.col("_structure"), *found), lambda x: x.isNotNull())
    return out.withColumn("reasons", reasons).select(*[c for c in base.columns if not c.startswith("_") and c != "broken"], "reasons")


def typed(parsed: DataFrame, layout: Layout, types: dict[str, Column], keep: list[str]) -> DataFrame:
    """The valid lines of one layout as columns; ``types`` overrides the trimmed string of a column.

    A kept column whose name a layout column also has is prefixed with ``line_``.
    """
    valid = parsed.filter((F.col("layout") == layout.name) & (F.size("reasons") == 0))
    kept = [F.col(c).alias(f"line_{c}" if c in layout.columns else c) for c in keep]
    named = valid.select(*kept, *[F.nullif(F.get("fields", F.lit(i)), F.lit("")).alias(c) for i, c in enumerate(layout.columns)])
    return named.withColumns({c: e for c, e in types.items() if c in layout.columns})


def failed(parsed: DataFrame, keep: list[str]) -> DataFrame:
    """The lines that fail, whole, with every reason."""
    return parsed.filter(F.size("reasons") > 0).select(*keep, "reasons")
