"""Bill files to typed rows: status documents with their collections, texts of versions, and records assembled of parts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicloom.session import stage
from civicloom.sources.rollcalls import parsed_documents, text, whole

_LATEST = "latestAction:struct<actionDate:string,text:string>"
_SUMMARY = "struct<versionCode:string,actionDate:string,actionDesc:string,name:string,updateDate:string,text:string,cdata:struct<text:string>>"
BILL = (
    "bill struct<congress:string,type:string,billType:string,number:string,billNumber:string,title:string,titles:struct<item:array<struct<title:string>>>,"
    f"introducedDate:string,{_LATEST},policyArea:struct<name:string>,"
    "sponsors:struct<item:array<struct<bioguideId:string,fullName:string,party:string,state:string,district:string>>>,"
    "cosponsors:struct<item:array<struct<bioguideId:string,fullName:string,party:string,state:string,district:string,sponsorshipDate:string,isOriginalCosponsor:string>>>,"
    "actions:struct<item:array<struct<actionDate:string,text:string,type:string,actionCode:string>>>,"
    "committees:struct<item:array<struct<systemCode:string,name:string,chamber:string,type:string>>>,"
    "subjects:struct<legislativeSubjects:struct<item:array<struct<name:string>>>>,"
    "textVersions:struct<item:array<struct<type:string,date:string,formats:struct<item:array<struct<url:string>>>>>>,"
    f"summaries:struct<summary:array<{_SUMMARY}>,billSummaries:struct<item:array<{_SUMMARY}>>>,"
    "laws:struct<item:array<struct<type:string,number:string>>>,"
    f"relatedBills:struct<item:array<struct<number:string,congress:string,type:string,title:string,latestTitle:string,{_LATEST},relationshipDetails:struct<item:array<struct<type:string,identifiedBy:string>>>>>>,"
    f"amendments:struct<amendment:array<struct<number:string,congress:string,type:string,chamber:string,purpose:string,description:string,submittedDate:string,proposedDate:string,updateDate:string,{_LATEST},"
    "sponsors:struct<item:array<struct<bioguideId:string,identifiers:struct<bioguideId:string>>>>,amendedAmendment:struct<congress:string,type:string,number:string>>>>,"
    "cboCostEstimates:struct<item:array<struct<pubDate:string,title:string,url:string,description:string>>>>"
)


def bill_files(docs: DataFrame, key: str, xml: str) -> DataFrame:
    """(key, congress, bill_type, bill_number, d, problem) of status documents; a bill without its three keys has a problem.

    A few files spell type and number billType and billNumber.
    """
    parsed = parsed_documents(docs, key, xml, BILL, "billStatus").withColumn("d", F.col("d.bill"))
    keyed = parsed.select(
        "key", "d", "problem", whole(F.col("d.congress")).alias("congress"), F.lower(F.coalesce(text("d.type"), text("d.billType"))).alias("bill_type"), F.coalesce(text("d.number"), text("d.billNumber")).alias("bill_number")
    )
    lacks = F.when(F.col("d").isNull(), "no bill").when(F.col("congress").isNull() | F.col("bill_type").isNull() | F.col("bill_number").isNull(), "no bill identity")
    return keyed.withColumn("problem", F.coalesce("problem", lacks))


def bills(files: DataFrame) -> DataFrame:
    """One row per bill; the title is the first of the listed ones where it has none of its own."""
    listed = F.get(F.filter("d.titles.item", lambda t: F.coalesce(F.trim(t["title"]), F.lit("")) != ""), F.lit(0))["title"]
    return _usable(files).select(
        *KEYS, F.coalesce(text("d.title"), text(listed)).alias("title"), text("d.introducedDate").try_cast("date").alias("introduced_date"),
        text("d.latestAction.actionDate").try_cast("date").alias("latest_action_date"), text("d.latestAction.text").alias("latest_action"),
    )


KEYS = ["key", "congress", "bill_type", "bill_number"]


def _usable(files: DataFrame) -> DataFrame:
    return files.filter("problem IS NULL")


def _items(files: DataFrame, path: str | Column) -> DataFrame:
    """The items of a collection with their place in the file from 1, as (KEYS, source_ordinal, x)."""
    return _usable(files).select(*KEYS, F.posexplode(path).alias("_at", "x")).withColumn("source_ordinal", F.col("_at") + 1).drop("_at")


def bill_identifiers(files: DataFrame) -> DataFrame:
    """(KEYS, namespace, external_id): the bill's own key and the package its file is of."""
    own = F.concat_ws("-", F.col("congress").cast("string"), "bill_type", "bill_number")
    package = F.regexp_replace(F.substring_index("key", "/", -1), r"\.[^.]*$", "")
    pairs = F.array(F.struct(F.lit("us.bill").alias("namespace"), own.alias("external_id")), F.struct(F.lit("govinfo.package").alias("namespace"), package.alias("external_id")))
    return _usable(files).select(*KEYS, F.explode(pairs).alias("p")).select(*KEYS, "p.*")


def bill_sponsorships(files: DataFrame) -> DataFrame:
    """Sponsors and cosponsors who have an id, by place in their list."""
    parts = []
    for role, path in (("sponsor", "d.sponsors.item"), ("cosponsor", "d.cosponsors.item")):
        rows = _items(files, path)
        dated = (text("x.sponsorshipDate").try_cast("date"), text("x.isOriginalCosponsor")) if role == "cosponsor" else (F.lit(None).cast("date"), F.lit(None).cast("string"))
        parts.append(rows.select(*KEYS, "source_ordinal", F.lit(role).alias("role"), text("x.bioguideId").alias("bioguide_id"), text("x.fullName").alias("full_name"), text("x.party").alias("party"), text("x.state").alias("state"), text("x.district").alias("district"), dated[0].alias("sponsorship_date"), dated[1].alias("is_original")))
    return reduce(DataFrame.unionByName, parts).filter("bioguide_id IS NOT NULL")


def bill_actions(files: DataFrame) -> DataFrame:
    """Actions in file order; classification lists the type and code there are, null if there is neither."""
    marks = F.array_compact(F.array(text("x.type"), text("x.actionCode")))
    return _items(files, "d.actions.item").select(*KEYS, "source_ordinal", text("x.actionDate").try_cast("date").alias("action_date"), F.coalesce(F.col("x.text"), F.lit("")).alias("description"), F.when(F.size(marks) > 0, marks).alias("classification"), text("x.actionCode").alias("action_code"), text("x.type").alias("action_type"))


def bill_committees(files: DataFrame) -> DataFrame:
    """Committees with a code, in lower case."""
    rows = _items(files, "d.committees.item").select(*KEYS, "source_ordinal", F.lower(text("x.systemCode")).alias("external_id"), text("x.name").alias("name"), text("x.chamber").alias("chamber"), text("x.type").alias("committee_type"))
    return rows.filter("external_id IS NOT NULL")


def bill_subjects(files: DataFrame) -> DataFrame:
    """The policy area and the legislative subjects, with the id made of the label's words."""
    area = _usable(files).select(*KEYS, F.lit(0).alias("source_ordinal"), F.lit("policy_area").alias("kind"), text("d.policyArea.name").alias("label"))
    rest = _items(files, "d.subjects.legislativeSubjects.item").select(*KEYS, "source_ordinal", F.lit("legislative_subject").alias("kind"), text("x.name").alias("label"))
    return area.unionByName(rest).filter("label IS NOT NULL").withColumn("external_id", F.translate(F.lower("label"), " ", "-"))


def bill_documents(files: DataFrame) -> DataFrame:
    """Text versions with their type, day and first address that is given."""
    url = text(F.get(F.col("x.formats.item"), F.lit(0))["url"])
    kind = F.coalesce(text("x.type"), F.lit("text_version"))
    return _items(files, "d.textVersions.item").select(*KEYS, "source_ordinal", kind.alias("document_type"), text("x.date").alias("published_at"), url.alias("source_url"))


def bill_summaries(files: DataFrame) -> DataFrame:
    """Summaries, from either place files keep them in."""
    new, old = F.col("d.summaries.summary"), F.col("d.summaries.billSummaries.item")
    rows = _items(files, F.when(F.size(new) > 0, new).otherwise(old))
    return rows.select(*KEYS, "source_ordinal", text("x.versionCode").alias("version_code"), text("x.actionDate").try_cast("date").alias("action_date"), F.coalesce(text("x.actionDesc"), text("x.name")).alias("action_description"), text("x.updateDate").alias("update_date"), F.coalesce(text("x.text"), text("x.cdata.text")).alias("text"))


def bill_laws(files: DataFrame) -> DataFrame:
    """Laws the bill became, that have a number."""
    return _items(files, "d.laws.item").select(*KEYS, "source_ordinal", text("x.type").alias("law_type"), text("x.number").alias("law_number")).filter("law_number IS NOT NULL")


def related_bills(files: DataFrame) -> DataFrame:
    """Bills related to this one that have all three keys, with how they are related."""
    how = F.transform(F.coalesce("x.relationshipDetails.item", F.array().cast("array<struct<type:string,identifiedBy:string>>")), lambda r: F.struct(text(r["type"]).alias("type"), text(r["identifiedBy"]).alias("identified_by")))
    rows = _items(files, "d.relatedBills.item").select(
        *KEYS, "source_ordinal", whole(F.col("x.congress")).alias("related_congress"), F.lower(text("x.type")).alias("related_bill_type"), text("x.number").alias("related_bill_number"),
        F.coalesce(text("x.title"), text("x.latestTitle")).alias("title"), text("x.latestAction.actionDate").try_cast("date").alias("latest_action_date"), text("x.latestAction.text").alias("latest_action_text"), how.alias("relationships"),
    )
    return rows.filter("related_congress IS NOT NULL AND related_bill_type IS NOT NULL AND related_bill_number IS NOT NULL")


def bill_amendments(files: DataFrame) -> DataFrame:
    """Amendments that have all three keys; the sponsor by id only, the amended amendment where it has a number."""
    first = F.get(F.col("x.sponsors.item"), F.lit(0))
    amended = F.when(text("x.amendedAmendment.number").isNotNull(), F.struct(text("x.amendedAmendment.congress").alias("congress"), text("x.amendedAmendment.type").alias("type"), text("x.amendedAmendment.number").alias("number")))
    rows = _items(files, "d.amendments.amendment").select(
        *KEYS, "source_ordinal", whole(F.col("x.congress")).alias("amendment_congress"), text("x.type").alias("amendment_type"), text("x.number").alias("amendment_number"), text("x.chamber").alias("chamber"),
        text("x.purpose").alias("purpose"), text("x.description").alias("description"), text("x.submittedDate").alias("submitted_at"), text("x.proposedDate").alias("proposed_at"), text("x.updateDate").alias("update_date"),
        text("x.latestAction.actionDate").try_cast("date").alias("latest_action_date"), text("x.latestAction.text").alias("latest_action_text"),
        F.coalesce(text(first["bioguideId"]), text(first["identifiers"]["bioguideId"])).alias("sponsor_bioguide_id"), amended.alias("amended_amendment"),
    )
    return rows.filter("amendment_congress IS NOT NULL AND amendment_type IS NOT NULL AND amendment_number IS NOT NULL")


def bill_estimates(files: DataFrame) -> DataFrame:
    """Cost estimates published with the bill."""
    return _items(files, "d.cboCostEstimates.item").select(*KEYS, "source_ordinal", text("x.pubDate").alias("published_at"), text("x.title").alias("title"), text("x.url").alias("source_url"), text("x.description").alias("description"))


#: Every collection of a status document by the name of its table.
COLLECTIONS = {
    "identifiers": bill_identifiers, "sponsorships": bill_sponsorships, "actions": bill_actions, "committees": bill_committees, "subjects": bill_subjects, "documents": bill_documents,
    "summaries": bill_summaries, "laws": bill_laws, "related_bills": related_bills, "amendments": bill_amendments, "cost_estimates": bill_estimates,
}


def status_tables(docs: DataFrame, key: str, xml: str) -> dict[str, DataFrame]:
    """The bill table, its eleven collections and the refused files, all of one parse of each document."""
    files = bill_files(docs, key, xml)
    return {"bills": bills(files), **{n: f(files) for n, f in COLLECTIONS.items()}, "refused": files.filter("problem IS NOT NULL").select("key", "problem")}


def text_versions(docs: DataFrame, path: str, xml: str) -> DataFrame:
    """One row per file of a bill's text: identity from the file's name, which is right where the metadata inside isn't.

    BILLS-<congress><type><number><version>.xml. ``stale`` tells that the title inside names another bill;
    ``problem`` a name of another form or a document that isn't well-formed.
    """
    name = F.regexp_replace(F.substring_index(path, "/", -1), r"\.xml$", "")
    shape = "^BILLS-([0-9]+)([a-z]+?)([0-9]+)([a-z]+[0-9]*)$"
    part = lambda i: F.nullif(F.regexp_extract(name, shape, i), F.lit(""))
    bare = F.regexp_replace(F.col(xml), r"(?s)<!DOCTYPE[^>\[]*(\[.*?\])?[^>]*>", "")
    schema = "struct<metadata:struct<dublinCore:struct<title:string,date:string>>,form:struct<`legis-num`:string,`official-title`:string,congress:string,session:string>>"
    plain = F.regexp_replace(bare, "(</?)(?:dc|dcterms):", "$1")
    rows = docs.select(F.col(path).alias("path"), name.alias("package_id"), part(1).cast("int").alias("congress"), part(2).alias("bill_type"), part(3).alias("bill_number"), part(4).alias("version_code"), F.from_xml(plain, schema).alias("d"), F.regexp_extract(bare, r"<\s*([A-Za-z-]+)", 1).alias("document_kind"), F.length(bare).alias("n_chars"))
    rows = stage(rows, "texts")
    said = F.regexp_replace(F.lower(F.col("d.metadata.dublinCore.title")), "[^a-z0-9]+", "")
    stale = said.isNotNull() & ~F.contains(said, F.concat("bill_type", "bill_number"))
    problem = F.when(F.col("congress").isNull(), "name of another form").when(F.col("d").isNull(), "not well-formed")
    return rows.select("path", "package_id", "congress", "bill_type", "bill_number", "version_code", "document_kind", text("d.form.legis-num".replace("legis-num", "`legis-num`")).alias("legislative_number"), text("d.form.`official-title`").alias("official_title"), text("d.metadata.dublinCore.date").alias("stated_date"), F.coalesce(stale, F.lit(False)).alias("stale"), "n_chars", problem.alias("problem"))


# Records that an interface serves in parts -----------------------------------------------------------


def listed_bills(pages: DataFrame, body: str) -> DataFrame:
    """(congress, bill_type, bill_number, update_date, next_offset) of pages of a list; the offset is null on the last page."""
    shape = "struct<bills:array<struct<congress:int,type:string,number:string,updateDate:string>>,pagination:struct<next:string>>"
    rows = pages.select(F.from_json(F.col(body), shape).alias("j"))
    offset = F.nullif(F.regexp_extract("j.pagination.next", "[?&]offset=([0-9]+)", 1), F.lit("")).cast("int")
    return rows.select(offset.alias("next_offset"), F.explode("j.bills").alias("b")).select("b.congress", F.lower("b.type").alias("bill_type"), F.col("b.number").alias("bill_number"), F.col("b.updateDate").alias("update_date"), "next_offset")


#: The parts of a bill and the list each holds.
PARTS = {"actions": "actions", "committees": "committees", "cosponsors": "cosponsors", "subjects": "subjects", "summaries": "summaries", "textversions": "textVersions"}


def assembled_bills(parts: DataFrame, key: str = "bill_key", part: str = "part", body: str = "body") -> DataFrame:
    """(bill_key, congress, bill_type, bill_number, title, items..., missing) from seven parts a bill.

    A part may come in several pages; its items are counted over them. ``missing`` lists the parts that never
    came, so an incomplete bill isn't taken for an empty one.
    """
    head = "struct<bill:struct<congress:int,type:string,number:string,title:string>>"
    item = F.col("_item")
    counts = parts.filter(F.col(part) != "bill").withColumn("_item", F.lit(None).cast("string"))
    for name, field in PARTS.items():
        listed = F.get_json_object(body, f"$.{field}.legislativeSubjects" if name == "subjects" else f"$.{field}")
        counts = counts.withColumn("_item", F.when(F.col(part) == name, listed).otherwise(item))
    tallied = counts.groupBy(key).pivot(part, list(PARTS)).agg(F.sum(F.coalesce(F.json_array_length("_item"), F.lit(0))).alias("n"))
    heads = parts.filter(F.col(part) == "bill").groupBy(key).agg(F.max(F.struct(F.from_json(F.col(body), head)["bill"].alias("b")))["b"].alias("b"))
    both = heads.join(tallied, key, "full")
    missing = F.array_compact(F.array(F.when(F.col("b").isNull(), "bill"), *[F.when(F.col(p).isNull(), p) for p in PARTS]))
    return both.select(key, "b.congress", F.lower("b.type").alias("bill_type"), F.col("b.number").alias("bill_number"), "b.title", *[F.coalesce(p, F.lit(0)).cast("int").alias(f"n_{p}") for p in PARTS], missing.alias("missing"))


