"""Links between political and census geography, by code only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# The relations of a division and a boundary, and the code of a delegate's district.
LEGAL, DELEGATE, DELEGATE_CODE = "legal_boundary", "delegate_district", "98"


def chamber_code(col: Column) -> Column:
    """A legislative district's code as geography writes it: 7 -> 007, 12a -> 12A, b -> 00B."""
    letter = F.regexp_extract(col, "[a-z]$", 0)
    digits = F.regexp_replace(col, "[a-z]$", "")
    padded = F.concat(F.lpad(digits, 2, "0"), F.upper(letter))
    return F.when(letter == "", F.when(col.rlike("^[0-9]+$"), F.lpad(col, 3, "0"))).when(digits.rlike("^[0-9]*$"), padded)


def id_segments(ocd: Column) -> Column:
    """The segments of a division id below the country, as (key, value) in order; null for an id of another form."""
    parts = F.split(ocd, "/")
    below = F.slice(parts, 3, F.greatest(F.size(parts) - 2, F.lit(0)))
    pairs = F.transform(below, lambda x: F.struct(F.substring_index(x, ":", 1).alias("key"), F.substring_index(x, ":", -1).alias("value")))
    return F.when((F.get(parts, F.lit(0)) == "ocd-division") & (F.get(parts, F.lit(1)) == "country:us"), pairs)


def division_candidates(divisions: DataFrame, states: DataFrame, ocd: str = "ocd_division_id") -> DataFrame:
    """(division_id, geography_type, geoid, relationship_kind) of the divisions whose id gives a code of geography.

    ``states`` has (postal, fips). The id is read by its segments: a home (state, district or territory) and at most one seat. A
    seat of a state is a congressional district (a number, or at-large) or a chamber's district; a home other than a state
    without a seat has a delegate. Anything else gives nothing.
    """
    cut = divisions.select("division_id", id_segments(F.col(ocd)).alias("s")).filter("size(s) BETWEEN 1 AND 2")
    home, seat = F.get("s", F.lit(0)), F.get("s", F.lit(1))
    kind, value = seat["key"], seat["value"]
    district = F.when(value == "at-large", "00").when(value.rlike("^[0-9]+$"), F.lpad(value, 2, "0"))
    in_state = home["key"] == "state"
    geography = F.when(in_state & (kind == "cd"), "congressional_district").when(in_state & kind.isin("sldu", "sldl"), kind).when(home["key"].isin("district", "territory") & kind.isNull(), "congressional_district")
    code = F.when(in_state & (kind == "cd"), district).when(in_state, chamber_code(value)).otherwise(DELEGATE_CODE)
    read = cut.select("division_id", home["value"].alias("postal"), geography.alias("geography_type"), code.alias("code"), F.when(in_state, LEGAL).otherwise(DELEGATE).alias("relationship_kind"))
    listed = read.filter("geography_type IS NOT NULL AND code IS NOT NULL").join(states.select("postal", "fips"), "postal")
    return listed.select("division_id", "geography_type", F.concat("fips", "code").alias("geoid"), "relationship_kind")


def link_divisions(divisions: DataFrame, states: DataFrame, boundaries: DataFrame, ocd: str = "ocd_division_id") -> DataFrame:
    """(division_id, boundary_id, relationship_kind), once each. ``boundaries``: (boundary_id, geography_type, geoid)."""
    return division_candidates(divisions, states, ocd).join(boundaries, ["geography_type", "geoid"]).select("division_id", "boundary_id", "relationship_kind").dropDuplicates(["division_id", "boundary_id"])


def link_report(boundaries: DataFrame, links: DataFrame, kind: str, code: str, boundary: str) -> DataFrame:
    """Per kind: boundaries, linked, placeholders (codes that end in Z) and unlinked."""
    linked = links.select(boundary).distinct().withColumn("_l", F.lit(True))
    holder = F.col(code).rlike("Z+$")
    return boundaries.join(linked, boundary, "left").groupBy(kind).agg(
        F.count("*").alias("boundaries"), F.count_if(F.col("_l")).alias("linked"), F.count_if(F.col("_l").isNull() & holder).alias("placeholder_unlinked"), F.count_if(F.col("_l").isNull() & ~holder).alias("unlinked")
    )


def block_crosswalk(blocks: DataFrame, districts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(whole-block assignments, counts of codes without a district), by state prefix and district code."""
    keyed = blocks.withColumn("geoid", F.concat(F.substring("block_geoid", 1, 2), "district_code"))
    found = keyed.join(districts.select("geoid", "geography_id"), "geoid").select("block_geoid", "geography_id", F.lit("assignment").alias("weight_type"), F.lit(1.0).alias("weight"), F.lit("whole_block_tabulation").alias("quality_flag"))
    lost = keyed.join(districts.select("geoid"), "geoid", "left_anti").groupBy(F.substring("block_geoid", 1, 2).alias("state_fips"), "district_code").agg(F.count("*").alias("n"))
    return found, lost


def relationship_crosswalk(rows: DataFrame) -> DataFrame:
    """Unweighted crosswalk rows from a relationship file; rows with a blank side are left out."""
    return rows.filter(F.col("district_geoid").isNotNull() & F.col("overlap_geoid").isNotNull()).select(
        "district_geoid", "overlap_geoid", F.lit("relationship").alias("method"), F.lit("none").alias("weight_type"), F.lit(None).cast("double").alias("weight"), "area_land_part", "area_water_part"
    )


def bad_weights(crosswalk: DataFrame) -> DataFrame:
    """Crosswalk rows whose weight breaks the rules: null exactly when its type is none, else within 0 and 1."""
    w, kind = F.col("weight"), F.col("weight_type")
    return crosswalk.filter(((kind == "none") != w.isNull()) | (w.isNotNull() & ~w.between(0, 1)))
