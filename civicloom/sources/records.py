"""Whole XML documents as lossless records, and JSON series."""

from __future__ import annotations

import hashlib
import json
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicloom.functions.scalars import month_start, number_or_null


def element_leaves(root: ET.Element) -> Iterator[tuple[str, str]]:
    """Every (path, value) of a document in order: attributes, text, and text after a child.

    Paths count repeated elements, so equal documents and only they have equal leaves.
    """
    stack = [(root, "/" + root.tag)]
    while stack:
        node, path = stack.pop()
        yield from ((f"{path}/@{k}", v) for k, v in node.attrib.items())
        if (node.text or "").strip() or (not len(node) and not node.attrib):
            yield path, (node.text or "").strip()
        seen: dict[str, int] = {}
        below = []
        for child in node:
            seen[child.tag] = seen.get(child.tag, 0) + 1
            at = f"{path}/{child.tag}[{seen[child.tag]}]"
            if (child.tail or "").strip():
                yield f"{at}/#tail", child.tail.strip()
            below.append((child, at))
        stack.extend(reversed(below))


def element_record(node: ET.Element) -> dict | str:
    """A document as nested dicts: @attribute, #text, #tail, and a list for every child tag."""
    text = (node.text or "").strip()
    if not len(node) and not node.attrib and not (node.tail or "").strip():
        return text
    out: dict = {f"@{k}": v for k, v in node.attrib.items()}
    if text:
        out["#text"] = text
    if (node.tail or "").strip():
        out["#tail"] = node.tail.strip()
    for child in node:
        out.setdefault(child.tag, []).append(element_record(child))
    return out


def record_leaves(record: dict | str, path: str) -> Iterator[tuple[str, str]]:
    """The leaves of a record, spelled as ``element_leaves`` spells them."""
    if not isinstance(record, dict):
        yield path, record
        return
    children = {k: v for k, v in record.items() if isinstance(v, list)}
    if not children and not any(k.startswith("@") for k in record) and "#text" not in record:
        yield path, ""
    for k, v in record.items():
        if k == "#text":
            yield path, v
        elif isinstance(v, list):
            for i, member in enumerate(v, 1):
                yield from record_leaves(member, f"{path}/{k}[{i}]")
        else:
            yield f"{path}/{k}", v


def canonical(record: dict | str) -> str:
    """JSON with sorted keys and no spaces, so equal records have equal texts."""
    return json.dumps(record, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


RECORD = "key string, root string, record string, record_sha256 string, lossless boolean, problem string"


def xml_records(docs: DataFrame, key: str, xml: str) -> DataFrame:
    """(key, root, record, record_sha256, lossless, problem) of each document.

    Each record is checked on the spot: its leaves are the document's, as a multiset. A document that isn't
    well-formed, or null, gives a row with the problem; none stops the job.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k, text in zip(batch["key"], batch["xml"]):
                try:
                    root = ET.fromstring(text)
                    record = element_record(root)
                    same = sorted(element_leaves(root)) == sorted(record_leaves(record, "/" + root.tag))
                    line = canonical(record)
                    out.append((k, root.tag, line, hashlib.sha256(line.encode()).hexdigest(), same, None if same else "leaves differ"))
                except (ET.ParseError, TypeError, ValueError) as e:
                    out.append((k, None, None, None, False, str(e)[:200] or type(e).__name__))
            yield pd.DataFrame(out, columns=[x.split()[0] for x in RECORD.split(", ")])

    return docs.select(F.col(key).cast("string").alias("key"), F.col(xml).cast("string").alias("xml")).mapInPandas(run, RECORD)


def xml_leaf_rows(docs: DataFrame, key: str, xml: str) -> DataFrame:
    """(key, path, value): one row per leaf of each well-formed document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k, text in zip(batch["key"], batch["xml"]):
                try:
                    out += [(k, p, v) for p, v in element_leaves(ET.fromstring(text))]
                except (ET.ParseError, TypeError, ValueError):
                    continue
            yield pd.DataFrame(out, columns=["key", "path", "value"])

    return docs.select(F.col(key).cast("string").alias("key"), F.col(xml).cast("string").alias("xml")).mapInPandas(run, "key string, path string, value string")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(path, xml) of every file under a folder, with any document type declaration removed."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.regexp_replace(F.col("content").cast("string"), r"(?s)<!DOCTYPE[^>\[]*(\[.*?\])?[^>]*>", "").alias("xml"))


def observations(docs: DataFrame, body: str) -> DataFrame:
    """(series_id, period_start, value) of observation lists; "." is null."""
    shape = "struct<series_id:string,observations:array<struct<date:string,value:string>>>"
    parsed = docs.select(F.from_json(F.col(body), shape).alias("j")).select("j.series_id", F.inline("j.observations"))
    return parsed.select("series_id", F.col("date").try_cast("date").alias("period_start"), number_or_null(F.col("value")).alias("value"))


def monthly_series(docs: DataFrame, body: str) -> DataFrame:
    """(series_id, period_start, value) of monthly series; periods that aren't months are left out."""
    shape = "struct<Results:struct<series:array<struct<seriesID:string,data:array<struct<year:string,period:string,value:string>>>>>>"
    series = docs.select(F.from_json(F.col(body), shape).alias("j")).select(F.inline("j.Results.series"))
    rows = series.select(F.col("seriesID").alias("series_id"), F.inline("data"))
    return rows.select("series_id", month_start(F.col("year"), F.col("period")).alias("period_start"), number_or_null(F.col("value")).alias("value")).filter("period_start IS NOT NULL")


def header_rows(docs: DataFrame, body: str, keys: list[str]) -> DataFrame:
    """(keys..., variable, text) of a JSON array of arrays whose first row names the columns."""
    rows = docs.select(F.from_json(F.col(body), "array<array<string>>").alias("a")).select(F.get("a", F.lit(0)).alias("names"), F.explode(F.slice("a", 2, F.greatest(F.size("a") - 1, F.lit(0)))).alias("row"))
    cells = rows.select(F.map_from_arrays("names", "row").alias("m"))
    return cells.select(*[F.col("m")[k].alias(k) for k in keys], F.explode(F.map_filter("m", lambda k, _: ~k.isin(keys))).alias("variable", "text"))
