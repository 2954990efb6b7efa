"""People, bills and votes of an outside publisher, linked by identifiers alone, and every contact it has kept."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicloom.functions.scalars import bill_key

# The schemes that are social accounts, and the jurisdiction of federal bills.
SOCIAL = ["facebook", "instagram", "twitter", "youtube"]
FEDERAL = "ocd-jurisdiction/country:us/government"


def _text(c: str) -> Column:
    return F.nullif(F.trim(F.col(c)), F.lit(""))


def link_people(identifiers: DataFrame, owned: DataFrame, scheme: str = "bioguide") -> DataFrame:
    """(ocd_person_id, guide, person_id, conflict): a link only where the publisher's person has one guide, and that guide one person.

    ``identifiers``: (ocd_person_id, scheme, identifier). ``owned``: (person_id, namespace, external_id).
    """
    rows = identifiers.filter(F.col("scheme") == scheme).select("ocd_person_id", _text("identifier").alias("guide")).filter("guide IS NOT NULL").distinct()
    per_person = rows.groupBy("ocd_person_id").agg(F.count("*").alias("_guides"))
    per_guide = rows.groupBy("guide").agg(F.count("*").alias("_people"))
    mine = owned.filter(F.col("namespace") == scheme).groupBy(F.col("external_id").alias("guide")).agg(F.min("person_id").alias("_owner"))
    out = rows.join(per_person, "ocd_person_id").join(per_guide, "guide").join(mine, "guide", "left")
    conflict = F.when(F.col("_guides") > 1, "person_has_multiple_bioguide_ids").when(F.col("_people") > 1, "bioguide_claimed_by_multiple_people")
    return out.select("ocd_person_id", "guide", F.when(conflict.isNull(), F.col("_owner")).alias("person_id"), conflict.alias("conflict"))


CONTACT = ["ocd_person_id", "source_table", "kind", "scheme", "value", "joins_people"]


def retained_contacts(links: DataFrame, identifiers: DataFrame | None = None, people: DataFrame | None = None, urls: DataFrame | None = None, names: DataFrame | None = None, sources: DataFrame | None = None, offices: DataFrame | None = None, scheme: str = "bioguide") -> DataFrame:
    """Every non-blank contact of six shapes as (CONTACT..., person_id, shared): who holds it, and whether another person does too.

    Only an identifier of the linking scheme joins people; a telephone or an address never does, whoever shares it.
    """
    parts: list[DataFrame] = []

    def add(df: DataFrame, table: str, kind: Column, scheme_: Column, value: Column, joins: Column | None = None) -> None:
        parts.append(df.select("ocd_person_id", F.lit(table).alias("source_table"), kind.alias("kind"), scheme_.alias("scheme"), F.nullif(F.trim(value), F.lit("")).alias("value"), (joins if joins is not None else F.lit(False)).alias("joins_people")))

    if identifiers is not None:
        named = identifiers.filter(_text("scheme").isNotNull())
        add(named, "identifier", F.when(_text("scheme").isin(SOCIAL), "social").otherwise("identifier"), _text("scheme"), F.col("identifier"), _text("scheme") == scheme)
    if people is not None:
        fields = [c for c in people.columns if c != "ocd_person_id"]
        long = people.select("ocd_person_id", *[F.col(c).cast("string").alias(c) for c in fields]).unpivot("ocd_person_id", fields, "field", "value") if fields else None
        if long is not None:
            add(long, "person", F.when(F.col("field") == "email", "email").otherwise("person_field"), F.col("field"), F.col("value"))
    for df, table, kind in ((urls, "link", "link"), (sources, "source", "source")):
        if df is not None:
            note = F.coalesce(_text("note"), F.lit(kind))
            add(df, table, F.lit(kind), note, F.coalesce(_text("url"), note))
    if names is not None:
        add(names, "name", F.lit("name"), F.coalesce(_text("note"), F.lit("name")), F.col("name"))
    if offices is not None:
        long = offices.select("ocd_person_id", F.coalesce(_text("classification"), F.lit("office")).alias("_c"), "address", "voice", "fax", "name").unpivot(["ocd_person_id", "_c"], ["address", "voice", "fax", "name"], "field", "value")
        add(long, "office", F.lit("office"), F.concat_ws(":", "_c", "field"), F.col("value"))
    kept = reduce(DataFrame.unionByName, parts).filter("value IS NOT NULL AND ocd_person_id IS NOT NULL")
    holders = kept.groupBy("scheme", "value").agg((F.min("ocd_person_id") != F.max("ocd_person_id")).alias("shared"))
    owners = links.filter("person_id IS NOT NULL").select("ocd_person_id", "person_id").distinct()
    return kept.join(holders, ["scheme", "value"]).join(owners, "ocd_person_id", "left").select(*CONTACT, "person_id", "shared")


def link_bills(rows: DataFrame, owned: DataFrame) -> DataFrame:
    """(ocd_bill_id, congress, bill_type, bill_number, bill_id) of federal bills; other jurisdictions and labels are left out, not guessed.

    ``rows``: (ocd_bill_id, jurisdiction_id, session, identifier). ``owned``: (bill_id, congress, bill_type, bill_number).
    """
    keyed = rows.filter(F.col("jurisdiction_id") == FEDERAL).select("ocd_bill_id", bill_key(F.col("session"), F.col("identifier")).alias("k")).filter("k IS NOT NULL").select("ocd_bill_id", "k.*")
    known = owned.select("bill_id", *[F.col(c).cast("string").alias(c) for c in ("congress", "bill_type", "bill_number")])
    return keyed.join(known, ["congress", "bill_type", "bill_number"], "left").select("ocd_bill_id", "congress", "bill_type", "bill_number", "bill_id")


def link_votes(events: DataFrame, official: DataFrame) -> DataFrame:
    """(external_id, n_events, first_event, matched): events of one roll call under its key, and whether that roll is held.

    ``events``: (ocd_vote_id, identifier). A key is us-<year>-lower or -upper-<roll>; other identifiers link to nothing. A roll's events are
    counted, not gathered, so one key may have any number.
    """
    keyed = events.filter(F.col("identifier").rlike("^us-[0-9]{4}-(lower|upper)-[0-9]+$"))
    per_key = keyed.groupBy(F.col("identifier").alias("external_id")).agg(F.count("*").alias("n_events"), F.min("ocd_vote_id").alias("first_event"))
    return per_key.join(official.select("external_id", F.lit(True).alias("_m")).distinct(), "external_id", "left").select("external_id", "n_events", "first_event", F.coalesce("_m", F.lit(False)).alias("matched"))


def resolve_one(identifiers: DataFrame, wanted: list[tuple[str, str]], group: str, new_id: str, namespace: str = "bioguide") -> tuple[str, str | None]:
    """(outcome, person) for one group of identifiers, by the rule ``identity.resolve_groups`` has for all of them.

    For single arrivals: the lookup is pushed down to the identifiers asked for. A conflict gives no person.
    """
    from civicloom.operators.identity import resolve_groups

    staged = identifiers.sparkSession.createDataFrame([(group, new_id, n, x) for n, x in wanted] or [(group, new_id, namespace, group)], f"{namespace} string, new_person_id string, namespace string, external_id string")
    row = resolve_groups(staged, identifiers, namespace, namespace=namespace).first()
    return (row["outcome"], None if row["outcome"] in ("multiple_owners", "bioguide_mismatch") else row["person_id"])
