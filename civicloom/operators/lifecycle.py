"""Rows that are made, retired and merged: versions of artifacts, divisions, and entities found to be one.

As in ``keyed``, every function takes tables as they are and returns them as they become; all outputs of a step
see the same input.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicloom.operators.keyed import absent, insert_absent
from civicloom.operators.links import division_candidates
from civicloom.operators.pick import distinct_on, latest_per_key

# The states of an artifact nothing was fetched for.
UNFETCHED = ["planned", "downloading", "failed"]


def register_action(arriving: DataFrame, artifacts: DataFrame, keys: Sequence[str] = ("dataset_id", "artifact_key"), intact: Column | None = None) -> DataFrame:
    """``arriving`` with latest_version and action: append, promote or retry.

    Without an earlier version, append. A latest version that nothing was fetched for is promoted in place. The
    same content again is a retry if the arriving row has been fetched and ``intact`` (a condition on the latest
    version, as ``latest_...``) holds; anything else is a new version.
    """
    latest = latest_per_key(artifacts, keys, "artifact_version").select(*keys, F.col("artifact_version").alias("latest_version"), F.col("status").alias("latest_status"), F.col("checksum_sha256").alias("latest_checksum"), F.col("local_path").alias("latest_path"))
    rows = arriving.join(latest, list(keys), "left")
    same = F.col("checksum_sha256").eqNullSafe(F.col("latest_checksum"))
    kept = F.col("checksum_sha256").isNull() | (~(F.col("latest_path").startswith("virtual://") & ~F.col("local_path").startswith("virtual://")) & (intact if intact is not None else F.lit(True)))
    action = (
        F.when(F.col("latest_version").isNull(), "append").when(F.col("latest_checksum").isNull() & F.col("latest_status").isin(UNFETCHED), "promote")
        .when(same & kept & ~F.col("status").isin(UNFETCHED), "retry").otherwise("append")
    )
    return rows.withColumn("action", action).drop("latest_status", "latest_checksum", "latest_path")


def register_artifacts(artifacts: DataFrame, arriving: DataFrame, keys: Sequence[str] = ("dataset_id", "artifact_key"), intact: Column | None = None) -> DataFrame:
    """The artifacts after one arriving row per key: promoted ones take its values, retried ones its state, the rest are appended.

    Metadata (a map) is merged, the arriving value first; a content type that isn't given stays.
    """
    decided = register_action(distinct_on(arriving, keys, [F.asc_nulls_last("checksum_sha256"), F.asc_nulls_last("remote_url")]), artifacts, keys, intact)
    new = {c: F.col(f"n.{c}") for c in arriving.columns}
    touched = decided.filter("action <> 'append'").select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("latest_version").alias("_v"), F.col("action").alias("_action"), F.struct(*arriving.columns).alias("n"))
    on = F.col("artifact_version") == F.col("_v")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    joined = artifacts.join(touched, on, "left")
    out = []
    for c in artifacts.columns:
        old = F.col(c)
        if c in keys or c == "artifact_version" or c not in new:
            out.append(old)
        elif c == "metadata":
            kept = F.map_filter(old, lambda k, _: ~F.coalesce(F.map_contains_key(F.col("n.metadata"), k), F.lit(False)))
            out.append(F.when(F.col("_action").isNull() | F.col("n.metadata").isNull(), old).otherwise(F.map_concat(kept, F.col("n.metadata"))).alias(c))
        elif c in ("status", "remote_url", "error_message"):
            out.append(F.when(F.col("_action").isNotNull(), new[c]).otherwise(old).alias(c))
        elif c == "content_type":
            out.append(F.when(F.col("_action") == "promote", F.coalesce(new[c], old)).otherwise(old).alias(c))
        else:
            out.append(F.when(F.col("_action") == "promote", new[c]).otherwise(old).alias(c))
    appended = decided.filter("action = 'append'").withColumn("artifact_version", (F.coalesce("latest_version", F.lit(0)) + 1).cast(artifacts.schema["artifact_version"].dataType)).drop("latest_version", "action")
    return joined.select(*out).unionByName(appended, allowMissingColumns=True)


def find_or_create(wanted: DataFrame, identifiers: DataFrame, namespace: str, new_id: Column, owner: str = "organization_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(wanted with its owner, new owners, new identifiers) by an outside id: one owner per id, found before one is made."""
    known = identifiers.filter(F.col("namespace") == namespace).select("external_id", F.col(owner).alias("_known"))
    one = distinct_on(wanted, ["external_id"], [F.asc_nulls_last(c) for c in wanted.columns if c != "external_id"])
    found = one.join(known, "external_id", "left").withColumn(owner, F.coalesce("_known", new_id))
    made = found.filter("_known IS NULL").drop("_known")
    return found.drop("_known"), made.drop("external_id"), made.select(owner, F.lit(namespace).alias("namespace"), "external_id")


# Divisions -------------------------------------------------------------------------------------------

# States whose districts end in a letter.
LETTERED = ["ak", "md", "mn", "nd", "sd"]


def seeded_divisions(geography: DataFrame, boundary: DataFrame, states: DataFrame, vintage: str, skip: Sequence[str] = ()) -> DataFrame:
    """(ocd_division_id, label, classification, seeded_from, geoid) for the state districts of a vintage's boundaries.

    The id is built of the state's letters, the chamber and the code: a number, or in some states one with a letter,
    lower case and without leading zeros. Other codes (ZZZ) give none. ``skip``: chamber:geoid. ``states``:
    (postal, fips).
    """
    marked = boundary.filter(F.col("boundary_vintage") == vintage).select("geography_id").distinct()
    names = geography.filter("geography_type = 'state'").select(F.col("geoid").alias("fips"), F.col("name").alias("_state"))
    rows = geography.filter(F.col("geography_type").isin("sldu", "sldl")).join(marked, "geography_id", "left_semi")
    rows = rows.withColumn("fips", F.substring("geoid", 1, 2)).join(states.select("postal", "fips"), "fips").join(names, "fips", "left")
    tail = F.substring("geoid", 3, 99)
    code = F.when(tail.rlike("^[0-9]{3}$"), tail.try_cast("int").cast("string")).when(F.col("postal").isin(LETTERED) & tail.rlike("^[0-9]{2}[A-Z]$"), F.lower(F.regexp_replace(tail, "^0+", "")))
    kept = rows.withColumn("_code", code).filter(F.col("_code").isNotNull() & ~F.concat_ws(":", "geography_type", "geoid").isin(list(skip)))
    ocd = F.concat(F.lit("ocd-division/country:us/state:"), "postal", F.lit("/"), "geography_type", F.lit(":"), "_code")
    return kept.select(ocd.alias("ocd_division_id"), F.concat_ws(" ", F.coalesce("_state", F.upper("postal")), "name").alias("label"), F.col("geography_type").alias("classification"), F.lit("census.tiger").alias("seeded_from"), "geoid")


def seed_divisions(divisions: DataFrame, seeded: DataFrame) -> DataFrame:
    """The divisions plus the seeded ones whose id isn't there."""
    return insert_absent(divisions, seeded, ["ocd_division_id"], [F.asc_nulls_last("geoid")])


def crosswalk_divisions(pairs: DataFrame, geography: DataFrame, boundary: DataFrame, vintage: str) -> DataFrame:
    """Divisions that reviewed pairs (geoid, chamber, ocd_division_id, census_name) name, where the vintage has a boundary of the place."""
    marked = boundary.filter(F.col("boundary_vintage") == vintage).select("geography_id").distinct()
    places = geography.join(marked, "geography_id", "left_semi").select(F.col("geography_type").alias("chamber"), "geoid")
    return pairs.join(places, ["chamber", "geoid"], "left_semi").select("ocd_division_id", F.col("census_name").alias("label"), F.col("chamber").alias("classification"), F.lit("ocd_sld_crosswalk").alias("seeded_from"), "geoid")


def retire_phantoms(divisions: DataFrame, links: DataFrame, posts: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(divisions, links, retired): divisions seeded from a number where a reviewed pair gives the real id go, with their links.

    What carries a post or wasn't seeded from the census is never touched; a second run retires nothing.
    """
    keys = pairs.select(F.col("chamber").alias("classification"), "geoid").distinct()
    named = divisions.filter("seeded_from = 'census.tiger'").join(keys, ["classification", "geoid"], "left_semi")
    retired = absent(absent(named, pairs.select("ocd_division_id"), ["ocd_division_id"]), posts.select("division_id"), ["division_id"]).select("division_id", "ocd_division_id")
    gone = retired.select("division_id")
    return divisions.join(gone, "division_id", "left_anti"), links.join(gone, "division_id", "left_anti"), retired


def wrong_vintage_links(links: DataFrame, boundary: DataFrame, geography: DataFrame, vintage: str, congress: int, legislative_year: str) -> DataFrame:
    """Links whose boundary isn't of the vintage, or of the kind, that their congress or legislative year requires."""
    rows = links.join(boundary.select("boundary_id", "geography_id", "boundary_vintage"), "boundary_id").join(geography.select("geography_id", "geography_type"), "geography_id")
    other = ~F.col("boundary_vintage").eqNullSafe(F.lit(vintage))
    federal = (F.col("congress") == congress) & (other | (F.col("geography_type") != "congressional_district"))
    state = (F.col("legislative_year") == legislative_year) & (other | ~F.col("geography_type").isin("sldu", "sldl"))
    return rows.filter(F.coalesce(federal, F.lit(False)) | F.coalesce(state, F.lit(False))).select("division_id", "boundary_id", "geography_type", "boundary_vintage")


def unlinked_divisions(divisions: DataFrame, links: DataFrame, states: DataFrame) -> DataFrame:
    """(division_id, reason) of divisions no boundary is linked to: their id has a code geography has, or none."""
    coded = division_candidates(divisions, states).select("division_id", F.lit(True).alias("_coded")).distinct()
    rest = divisions.join(links.select("division_id").distinct(), "division_id", "left_anti").join(coded, "division_id", "left")
    return rest.select("division_id", F.when(F.col("_coded"), "no boundary has the code").otherwise("the id gives no code").alias("reason"))


def crosswalk_reconciliation(relationship: DataFrame, blocks: DataFrame, stored: DataFrame, artifact: str) -> DataFrame:
    """One row of counters of an artifact, with ``holds``: staged less those with a blank side are stored, all as they should be."""
    mine = lambda df, c="artifact_id": df.filter(F.col(c) == artifact)
    r = mine(relationship).agg(F.count("*").alias("relationship_staged"), F.count_if(F.col("district_geoid").isNull() | F.col("overlap_geoid").isNull()).alias("relationship_blank_side"))
    b = mine(blocks).agg(F.count("*").alias("block_staged"))
    bad = (F.col("method") == "block_assignment") & ((F.col("weight_type") != "assignment") | ~F.col("weight").eqNullSafe(F.lit(1.0)) | ~F.col("quality_flag").eqNullSafe(F.lit("whole_block_tabulation")))
    s = mine(stored, "source_artifact_id").agg(F.count("*").alias("stored"), F.count_if((F.col("method") == "relationship") & (F.col("weight_type") != "none")).alias("weighted_relationship"), F.count_if(bad).alias("bad_assignment"))
    out = r.join(b, how="cross").join(s, how="cross")  # one row each
    return out.withColumn("holds", (F.col("relationship_staged") - F.col("relationship_blank_side") + F.col("block_staged") == F.col("stored")) & (F.col("weighted_relationship") == 0) & (F.col("bad_assignment") == 0))


# Entities found to be one ------------------------------------------------------------------------------


@dataclass
class Merge:
    """The tables after a merge: each referring table, the rows preserved beside them, the merges that were refused with
    their reason, and one audit row per merge that was applied."""

    tables: dict[str, DataFrame]
    preserved: dict[str, DataFrame]
    refused: DataFrame
    audit: DataFrame


def merge_entities(pairs: DataFrame, identifiers: DataFrame, tables: dict[str, tuple[DataFrame, Sequence[str]]], aborting: Sequence[str] = (), entity: str = "person_id", primary: str = "bioguide") -> Merge:
    """Repoints every table from ``duplicate`` to ``survivor`` for all reviewed ``pairs`` (merge_id, survivor, duplicate) at once.

    ``tables``: name -> (rows, the key the entity is part of). Where a repointed row meets one the survivor has, it is
    set aside whole into ``preserved``; in a table of ``aborting`` such a collision refuses the whole merge
    instead, as does a primary id of the duplicate that the survivor, who has one, doesn't hold. A pair of equal
    sides, or of a side nobody refers to, is refused without harm. A pair's survivor must not be another's duplicate.
    """
    p = pairs.select("merge_id", F.col("survivor").alias("_s"), F.col("duplicate").alias("_d")).distinct()
    reasons = [p.filter("_s = _d").select("merge_id", F.lit("already one").alias("reason"))]
    mine = identifiers.filter(F.col("namespace") == primary).select(F.col(entity).alias("_e"), "external_id")
    held = p.join(mine.withColumnRenamed("_e", "_s"), "_s").groupBy("merge_id").agg(F.collect_set("external_id").alias("_held"))
    other = p.join(mine.withColumnRenamed("_e", "_d"), "_d").join(held, "merge_id").filter(~F.array_contains("_held", F.col("external_id")))
    reasons.append(other.select("merge_id", F.lit("two primary ids").alias("reason")))
    for name in aborting:
        rows, key = tables[name]
        rest = [k for k in key if k != entity]
        d = p.join(rows.select(F.col(entity).alias("_d"), *rest), "_d")
        s = rows.select(F.col(entity).alias("_s"), *rest).distinct()
        reasons.append(d.join(s, ["_s", *rest], "left_semi").select("merge_id", F.lit(f"{name} collides").alias("reason")))
    refused = reasons[0]
    for r in reasons[1:]:
        refused = refused.unionByName(r)
    refused = refused.groupBy("merge_id").agg(F.min("reason").alias("reason"))
    applied = p.join(refused, "merge_id", "left_anti")
    from civicloom.operators.keyed import remap

    out: dict[str, DataFrame] = {}
    preserved: dict[str, DataFrame] = {}
    counts = applied.select("merge_id", F.col("_s").alias("survivor"), F.col("_d").alias("duplicate"))
    for name, (rows, key) in {**tables, "identifiers": (identifiers, ["namespace", "external_id"])}.items():
        moved = rows.join(applied.select(F.col("_d").alias(entity), "merge_id"), entity).groupBy("merge_id").agg(F.count("*").alias(name))
        out[name], preserved[name] = remap(rows, entity, applied, "_d", "_s", list(key))
        counts = counts.join(moved, "merge_id", "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return Merge(out, preserved, refused, counts)
