"""The pN_ queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicloom.llm.addresses import places_of, same_place_pairs
from civicloom.llm.matching import match
from civicloom.llm.packing import pack
from civicloom.llm.reading import fit, reading_levels
from civicloom.llm.tokens import encode
from civicloom.session import table

CAPACITY = 2048
HARD_GRADE = 14.0
MOST_STATES = 26 * 26 * 4
LEAST_WORDS = 20


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    """The token ids of every document."""
    return encode(table(spark, d, "documents").select("doc_id", "text"))


def p9_containers(spark: SparkSession, d: str) -> DataFrame:
    """The container of every document, or of each piece of one longer than a container."""
    sizes = encode(table(spark, d, "documents").select("doc_id", "text"), ids="n", counts_only=True)
    return pack(sizes, "doc_id", "n", CAPACITY).select(F.col("key").alias("doc_id"), "piece", F.col("first").alias("first_token"), F.col("size").alias("n_tokens"), "container")


def p9_fill(spark: SparkSession, d: str) -> DataFrame:
    """How full the containers are."""
    each = p9_containers(spark, d).groupBy("container").agg(F.sum("n_tokens").alias("n"))
    return each.agg(F.count("*").alias("containers"), F.sum("n").alias("tokens"), F.max("n").alias("fullest"), F.round(F.sum("n") / (F.count("*") * CAPACITY), 6).alias("filled"))


def _levels(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").filter(F.col("lang") == "en").select("doc_id", "text")
    return reading_levels(docs, fit(docs, table(spark, d, "reading_label"))).withColumnRenamed("key", "doc_id")


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """English documents that are as demanding as a reading grade of 14 or above."""
    return _levels(spark, d).filter((F.col("n_words") >= LEAST_WORDS) & (F.col("level") >= HARD_GRADE)).select("doc_id").distinct()


def p10_levels(spark: SparkSession, d: str) -> DataFrame:
    """The reading level of each English document."""
    return _levels(spark, d)


def state_codes(spark: SparkSession, d: str) -> dict[str, str]:
    """Letter code of each state by its name and its number (states are few: a code has two letters)."""
    states = table(spark, d, "tiger_feature").filter("layer = 'state'").select(F.get_json_object("raw", "$.STUSPS").alias("code"), F.lower("name").alias("name"), "state_fips").distinct()
    rows = states.filter(F.col("code").rlike("^[A-Z]{2}$")).limit(MOST_STATES + 1).collect()
    if len(rows) > MOST_STATES:
        raise ValueError("more spellings of states than two letters can have")
    return {k: r["code"] for r in rows for k in (r["name"], str(int(r["state_fips"])) if r["state_fips"] else None, r["code"].lower()) if k}


def people(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The people of both sources as records to match: by bioguide, and by icpsr."""
    codes = state_codes(spark, d)
    book = F.create_map(*[F.lit(x) for kv in codes.items() for x in kv]) if codes else F.lit(None).cast("map<string,string>")
    code = lambda c: F.try_element_at(book, F.lower(F.trim(c)))
    staged = table(spark, d, "legislator_stage").filter(F.col("bioguide").isNotNull())
    left = staged.groupBy(F.col("bioguide").alias("id")).agg(
        F.array_sort(F.collect_set(F.concat("full_name", F.lit("\t"), F.coalesce("family_name", F.lit(""))))).alias("names"),
        F.array_sort(F.collect_set(F.year("birthday"))).alias("years"), F.array_sort(F.collect_set(code(F.col("state")))).alias("states"), F.array_sort(F.collect_set("chamber")).alias("chambers"),
        F.min(F.year("first_term_start")).alias("first_year"), F.max(F.year("first_term_start")).alias("last_year"), F.array().cast("array<string>").alias("ids"),
    )
    chamber = F.when(F.lower("chamber") == "senate", "sen").when(F.lower("chamber") == "house", "rep")
    seen = table(spark, d, "voteview_member").filter(F.col("icpsr").isNotNull())
    # A year or state counts once per congress, so that a slip in one congress can be told from the rest.
    right = seen.groupBy(F.col("icpsr").alias("id")).agg(
        F.array_sort(F.collect_set("bioname")).alias("names"), F.array_sort(F.collect_set(F.col("born").cast("int"))).alias("years"),
        F.array_distinct(F.flatten(F.array(F.array_sort(F.collect_set(code(F.col("state_abbrev")))), F.array_sort(F.collect_set(code(F.col("state_icpsr").cast("string"))))))).alias("states"),
        F.array_sort(F.collect_set(chamber)).alias("chambers"), F.min(F.col("congress") * 2 + 1787).alias("first_year"), F.max(F.col("congress") * 2 + 1787).alias("last_year"),
        F.array_sort(F.collect_set(F.when(F.trim("bioguide_id") != "", F.trim("bioguide_id")))).alias("ids"),
    )
    return left, right


def p1_pairs(spark: SparkSession, d: str) -> DataFrame:
    """The pairs of bioguide and icpsr that denote the same person, with the confidence."""
    return match(*people(spark, d)).select(F.col("a").alias("bioguide"), F.col("b").alias("icpsr"), "confidence")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """The pairs of bioguide and icpsr that denote the same person."""
    return p1_pairs(spark, d).select("bioguide", "icpsr").distinct()


def _places(spark: SparkSession, d: str) -> DataFrame:
    columns = {c: c for c in ("address", "building", "suite", "city", "state", "zip")}
    return places_of(table(spark, d, "profile_office"), "office_key", columns, state_codes(spark, d))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """The pairs of offices at the same place."""
    return same_place_pairs(_places(spark, d)).select(F.col("key_a").alias("office_key_a"), F.col("key_b").alias("office_key_b"))


def p3_places(spark: SparkSession, d: str) -> DataFrame:
    """The parts of every office's address."""
    return _places(spark, d).withColumnRenamed("key", "office_key")


QUERIES = {"p3_found": p3_found, "p3_places": p3_places, "p1_found": p1_found, "p1_pairs": p1_pairs, "p8_ids": p8_ids, "p9_containers": p9_containers, "p9_fill": p9_fill, "p10_found": p10_found, "p10_levels": p10_levels}
ORACLE: dict[str, str] = {}
