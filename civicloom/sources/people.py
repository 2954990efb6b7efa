"""People, their terms, profiles and committees, from record files (JSON, or YAML where a reader is installed).

Every function takes one record per row as JSON text and gives typed rows; what breaks a rule comes out beside
them with its reason, so a caller can refuse the file whole.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicloom.functions.scalars import ordinal, term_place
from civicloom.session import stage
from civicloom.sources.rollcalls import text

PERSON = (
    "struct<id:map<string,string>,name:struct<first:string,middle:string,last:string,suffix:string,nickname:string,official_full:string>,"
    "other_names:array<struct<last:string,middle:string,end:string>>,bio:struct<birthday:string,gender:string>,"
    "leadership_roles:array<struct<chamber:string,title:string,start:string,end:string>>,"
    "terms:array<struct<type:string,start:string,end:string,state:string,district:string,class:string,party:string,state_rank:string,how:string,`end-type`:string,caucus:string,"
    "office:string,address:string,phone:string,fax:string,contact_form:string,url:string,rss_url:string>>,"
    "social:map<string,string>,offices:array<struct<id:string,address:string,building:string,suite:string,city:string,state:string,zip:string,phone:string,fax:string,hours:string,latitude:string,longitude:string>>>"
)
# The networks of a social record with the fields of the handle and the numeric id; what bounds open names.
NETWORKS = {"twitter": ("twitter", "twitter_id"), "facebook": ("facebook", "facebook_id"), "youtube": ("youtube", "youtube_id"), "instagram": ("instagram", "instagram_id"), "mastodon": ("mastodon", None)}
STABLE_VINTAGE, OPEN_VINTAGE = "0000-00-00", "9999-12-31"


def read_records(docs: DataFrame, path: str, content: str) -> DataFrame:
    """(path, at, record) of files that hold a list or a mapping of records, in JSON or YAML; a mapping's keys come as ``_key``.

    YAML needs a reader on the workers; a file that can't be read gives one row with ``problem``.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for name, body in zip(batch["path"], batch["content"]):
                try:
                    data = _load(name, body)
                    rows = [{"_key": k, "rows": v} for k, v in data.items()] if isinstance(data, dict) else list(data)
                    out += [(name, i, json.dumps(r, default=str, ensure_ascii=False), None) for i, r in enumerate(rows, 1)]
                except Exception as e:  # noqa: BLE001
                    out.append((name, 0, None, str(e)[:200] or type(e).__name__))
            yield pd.DataFrame(out, columns=["path", "at", "record", "problem"])

    return docs.select(F.col(path).alias("path"), F.col(content).cast("string").alias("content")).mapInPandas(run, "path string, at int, record string, problem string")


def _load(name: str, body: str) -> object:
    if name.lower().endswith((".yaml", ".yml")):
        import yaml  # an optional reader

        return yaml.safe_load(body)
    return json.loads(body)


def people_records(records: DataFrame, record: str = "record") -> DataFrame:
    """(bioguide, p, problem): parsed records; one without a well-formed guide has a problem, as has a repeated guide.

    A guide is a letter and six digits; a lower-case letter counts.
    """
    parsed = stage(records.select(F.from_json(F.col(record), PERSON).alias("p")), "people").withColumn("bioguide", F.upper(text(F.try_element_at("p.id", F.lit("bioguide")))))
    n = parsed.groupBy("bioguide").count().filter("count > 1 AND bioguide IS NOT NULL").select("bioguide", F.lit(True).alias("_again"))
    problem = F.when(F.col("bioguide").isNull(), "no guide").when(~F.col("bioguide").rlike("^[A-Z][0-9]{6}$"), "malformed guide").when(F.col("_again"), "repeated guide")
    return parsed.join(n, "bioguide", "left").select("bioguide", "p", problem.alias("problem"))


def people(parsed: DataFrame) -> DataFrame:
    """(bioguide, full_name, given_name, family_name, birthday, gender): the official name, else the two parts, else the guide."""
    n = lambda f: text(F.col(f"p.name.{f}"))
    parts = F.nullif(F.concat_ws(" ", n("first"), n("last")), F.lit(""))
    return parsed.filter("problem IS NULL").select("bioguide", F.coalesce(n("official_full"), parts, "bioguide").alias("full_name"), n("first").alias("given_name"), n("last").alias("family_name"), text("p.bio.birthday").try_cast("date").alias("birthday"), text("p.bio.gender").alias("gender"))


def identifiers(parsed: DataFrame) -> DataFrame:
    """(bioguide, namespace, external_id), once each: an id that is a list gives a row per member."""
    rows = parsed.filter("problem IS NULL").select("bioguide", F.explode("p.id").alias("namespace", "v"))
    listed = F.when(F.col("v").startswith("["), F.from_json("v", "array<string>")).otherwise(F.array("v"))
    return rows.select("bioguide", "namespace", F.explode(listed).alias("x")).select("bioguide", "namespace", text("x").alias("external_id")).filter("external_id IS NOT NULL").distinct()


def names(parsed: DataFrame) -> DataFrame:
    """(bioguide, name_kind, full_name, given_name, family_name, source_vintage): official, middle, suffix, nickname and former names.

    A former name's vintage is the day it ended; one that is open has the last of days.
    """
    ok = parsed.filter("problem IS NULL")
    n = lambda f: text(F.col(f"p.name.{f}"))
    null = F.lit(None).cast("string")
    fixed = F.array(
        F.struct(F.lit("official").alias("name_kind"), n("official_full").alias("full_name"), n("first").alias("given_name"), n("last").alias("family_name")),
        *[F.struct(F.lit(k).alias("name_kind"), n(k).alias("full_name"), null.alias("given_name"), null.alias("family_name")) for k in ("middle", "suffix", "nickname")],
    )
    own = ok.select("bioguide", F.inline(fixed)).withColumn("source_vintage", F.lit(STABLE_VINTAGE))
    other = ok.select("bioguide", F.explode("p.other_names").alias("o"))
    middle, last = text("o.middle"), text("o.last")
    former = other.select("bioguide", F.lit("former").alias("name_kind"), F.concat_ws(" ", middle, last).alias("full_name"), middle.alias("given_name"), last.alias("family_name"), F.coalesce(text("o.end").try_cast("date").cast("string"), F.lit(OPEN_VINTAGE)).alias("source_vintage"))
    return own.unionByName(former.filter("family_name IS NOT NULL")).filter("full_name IS NOT NULL")


def leadership(parsed: DataFrame) -> DataFrame:
    """(bioguide, chamber, title, start_date, end_date), newest end first where a role is listed twice."""
    from civicloom.operators.pick import distinct_on

    rows = parsed.filter("problem IS NULL").select("bioguide", F.explode("p.leadership_roles").alias("r"))
    typed = rows.select("bioguide", text("r.chamber").alias("chamber"), text("r.title").alias("title"), text("r.start").try_cast("date").alias("start_date"), text("r.end").try_cast("date").alias("end_date"))
    good = typed.filter("chamber IN ('house', 'senate') AND title IS NOT NULL AND start_date IS NOT NULL")
    return distinct_on(good, ["bioguide", "chamber", "title", "start_date"], [F.desc_nulls_last("end_date")])


def social_accounts(parsed: DataFrame) -> DataFrame:
    """(bioguide, network, handle, external_id): one row per network a record has a handle or an id of."""
    have = lambda k: text(F.try_element_at("p.social", F.lit(k))) if k else F.lit(None).cast("string")
    rows = F.array(*[F.struct(F.lit(n).alias("network"), have(h).alias("handle"), have(i).alias("external_id")) for n, (h, i) in NETWORKS.items()])
    return parsed.filter("problem IS NULL").select("bioguide", F.inline(rows)).filter("handle IS NOT NULL OR external_id IS NOT NULL")


def unknown_social(parsed: DataFrame) -> DataFrame:
    """(bioguide, field) of social fields no network has."""
    known = [x for pair in NETWORKS.values() for x in pair if x]
    return parsed.select("bioguide", F.explode(F.map_keys("p.social")).alias("field")).filter(~F.col("field").isin(known))


def offices(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(offices, refused offices): coordinates are kept as a pair or not at all; half a pair or no key is refused.

    ``point`` is the pair as binary geometry, longitude first.
    """
    rows = parsed.filter("problem IS NULL").select("bioguide", F.explode("p.offices").alias("o"))
    fields = ["address", "building", "suite", "city", "state", "zip", "phone", "fax", "hours"]
    number = lambda c: text(c).try_cast("double")
    typed = rows.select("bioguide", text("o.id").alias("office_key"), *[text(f"o.{f}").alias(f) for f in fields], number("o.latitude").alias("latitude"), number("o.longitude").alias("longitude"))
    problem = F.when(F.col("office_key").isNull(), "no key").when(F.col("latitude").isNull() != F.col("longitude").isNull(), "half a pair of coordinates")
    marked = typed.withColumn("problem", problem)
    from civicloom.functions.wkb import point_wkb

    return marked.filter("problem IS NULL").drop("problem").withColumn("point", point_wkb(F.col("longitude"), F.col("latitude"))), marked.filter("problem IS NOT NULL")


def terms(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(terms, refused terms) with place and post of each.

    A term needs a chamber, both dates and a state. The state's division is known always, the post where the
    district is (representatives) or the class (senators); the label says which seat.
    """
    rows = parsed.filter("problem IS NULL").select("bioguide", F.posexplode("p.terms").alias("at", "t"))
    t = lambda f: text(F.col(f"t.`{f}`"))
    district, rank = t("district").try_cast("int"), t("class").try_cast("int")
    contact = F.map_filter(F.create_map(*[x for f in ("office", "address", "phone", "fax", "contact_form", "url", "rss_url") for x in (F.lit(f), t(f))]), lambda _, v: v.isNotNull())
    meta = F.map_filter(F.create_map(*[x for f in ("state", "district", "party", "class", "state_rank", "how", "end-type", "caucus") for x in (F.lit({"class": "senate_class", "end-type": "end_type"}.get(f, f)), F.upper(t(f)) if f == "state" else t(f))]), lambda _, v: v.isNotNull())
    typed = rows.select(
        "bioguide", (F.col("at") + 1).alias("source_ordinal"), t("type").alias("chamber"), t("start").try_cast("date").alias("start_date"), t("end").try_cast("date").alias("end_date"),
        F.upper(t("state")).alias("state"), district.alias("district"), rank.alias("senate_class"), contact.alias("contact"), meta.alias("metadata"),
    )
    problem = (
        F.when(~F.coalesce(F.col("chamber").isin("rep", "sen"), F.lit(False)), "chamber is neither rep nor sen").when(F.col("start_date").isNull(), "no start date")
        .when(F.col("end_date").isNull(), "no end date").when(F.col("state").isNull(), "no state")
    )
    seat = F.when(F.col("chamber") == "sen", F.when(F.col("senate_class").isNotNull(), F.concat(F.lit("Class "), F.col("senate_class").cast("string"))))
    seat = F.coalesce(seat, F.when((F.col("chamber") == "rep") & (F.col("district") == 0), "At-Large").when((F.col("chamber") == "rep") & (F.col("district") > 0), F.concat(ordinal(F.col("district")), F.lit(" District"))))
    marked = typed.withColumn("problem", problem)
    good = marked.filter("problem IS NULL").drop("problem")
    placed = good.withColumns({
        "role": F.when(F.col("chamber") == "sen", "senator").otherwise("representative"), "state_ocd": term_place(F.lit("sen"), F.col("state"), F.lit(None).cast("int")),
        "post_label": seat, "post_ocd": F.when(seat.isNotNull(), term_place(F.col("chamber"), F.col("state"), F.col("district"))),
    })
    return placed, marked.filter("problem IS NOT NULL")


def term_memberships(terms_: DataFrame, ids: DataFrame, divisions: DataFrame, posts: DataFrame, house: str, senate: str, artifact: Column) -> DataFrame:
    """One membership per person, organization, role and start: the rows a load would write, for ``keyed.diff_action``.

    ``ids``: (person_id, namespace, external_id). ``divisions``: (division_id, ocd_division_id). ``posts``:
    (post_id, division_id, organization_id, label). Of several the least artifact's stands; a term whose person
    or post isn't known has no row or no post.
    """
    from civicloom.operators.pick import distinct_on

    who = ids.filter("namespace = 'bioguide'").select("person_id", F.col("external_id").alias("bioguide"))
    seats = posts.join(divisions.select("division_id", F.col("ocd_division_id").alias("post_ocd")), "division_id").select("post_id", "post_ocd", F.col("label").alias("post_label"), "organization_id")
    rows = terms_.join(who, "bioguide").withColumn("organization_id", F.when(F.col("chamber") == "rep", house).otherwise(senate)).withColumn("source_artifact_id", artifact)
    joined = rows.join(seats, ["post_ocd", "post_label", "organization_id"], "left")
    picked = distinct_on(joined, ["person_id", "organization_id", "role", "start_date"], [F.asc_nulls_last("source_artifact_id"), F.asc_nulls_last("source_ordinal"), F.asc_nulls_last("bioguide")])
    said = lambda f: F.try_element_at("contact", F.lit(f)).alias(f)
    return picked.select("person_id", "organization_id", "post_id", "role", "start_date", "end_date", "source_artifact_id", "metadata", *[said(f) for f in ("office", "address", "phone", "fax", "contact_form", "url", "rss_url")])


# Committees ------------------------------------------------------------------------------------------

_SUB = "name:string,thomas_id:string,congresses:array<int>,names:map<string,string>,address:string,phone:string,url:string"
COMMITTEE = f"struct<type:string,{_SUB},jurisdiction:string,subcommittees:array<struct<{_SUB}>>>"
MEMBERS = "struct<_key:string,rows:array<struct<bioguide:string,name:string,party:string,rank:int,title:string,chamber:string>>>"


def committee_bodies(records: DataFrame, source: str, record: str = "record") -> tuple[DataFrame, DataFrame]:
    """(bodies, refused bodies) of a committee file: committees and, under parent key plus short key, their subcommittees.

    A body needs a key and a name, a committee a chamber of house, senate or joint; a repeated key is refused.
    """
    parsed = records.select(F.from_json(F.col(record), COMMITTEE).alias("c"))
    null = F.lit(None).cast("string")
    shared = ["congresses", "names", "address", "phone", "url"]
    top = parsed.select(text("c.thomas_id").alias("thomas_key"), null.alias("parent_thomas_key"), F.lit("committee").alias("kind"), text("c.type").alias("chamber"), text("c.name").alias("name"), *[F.col(f"c.{f}").alias(f) for f in shared])
    subs = parsed.select("c", F.explode("c.subcommittees").alias("s"))
    below = subs.select(F.concat(text("c.thomas_id"), text("s.thomas_id")).alias("thomas_key"), text("c.thomas_id").alias("parent_thomas_key"), F.lit("subcommittee").alias("kind"), text("c.type").alias("chamber"), text("s.name").alias("name"), *[F.col(f"s.{f}").alias(f) for f in shared])
    bodies = top.unionByName(below).withColumn("source_file", F.lit(source))
    again = bodies.groupBy("thomas_key").count().filter("count > 1").select("thomas_key", F.lit(True).alias("_again"))
    problem = (
        F.when(F.col("thomas_key").isNull(), "no key").when(F.col("name").isNull(), "no name").when(~F.coalesce(F.col("chamber").isin("house", "senate", "joint"), F.lit(False)), "chamber is none of three").when(F.col("_again"), "repeated key")
    )
    marked = bodies.join(again, "thomas_key", "left").withColumn("problem", problem).drop("_again")
    return marked.filter("problem IS NULL").drop("problem"), marked.filter("problem IS NOT NULL")


def merged_committees(current: DataFrame, historical: DataFrame) -> DataFrame:
    """One row per committee of both files: the current one says what it is, the historical one when it was and its former names."""
    said = ["parent_thomas_key", "kind", "chamber", "name", "address", "phone", "url"]
    c = current.select("thomas_key", F.struct(*said).alias("c"))
    h = historical.select("thomas_key", F.struct(*said).alias("h"), "congresses", F.col("names").alias("former_names"))
    both = c.join(h, "thomas_key", "full").withColumn("b", F.coalesce("c", "h"))
    return both.select("thomas_key", "b.*", F.coalesce("congresses", F.array().cast("array<int>")).alias("congresses"), "former_names", F.when(F.col("c").isNotNull(), "current").otherwise("historical").alias("preferred_file"), (F.col("c").isNotNull() & F.col("h").isNotNull()).alias("has_history"))


def committee_members(records: DataFrame, current: DataFrame, record: str = "record") -> tuple[DataFrame, DataFrame]:
    """(members, refused members) of a membership file.

    A member needs a committee of the current file, a guide once per committee, a name (the same one everywhere), a
    party of majority or minority and a whole rank.
    """
    parsed = records.select(F.from_json(F.col(record), MEMBERS).alias("m")).select(F.col("m._key").alias("thomas_key"), F.posexplode("m.rows").alias("at", "r"))
    rows = parsed.select("thomas_key", (F.col("at") + 1).alias("source_ordinal"), text("r.bioguide").alias("bioguide"), text("r.name").alias("stated_name"), text("r.party").alias("party"), F.col("r.rank").alias("rank"), text("r.title").alias("title"), text("r.chamber").alias("chamber"))
    known = current.select("thomas_key", F.lit(True).alias("_known")).distinct()
    twice = rows.groupBy("thomas_key", "bioguide").count().filter("count > 1").select("thomas_key", "bioguide", F.lit(True).alias("_twice"))
    named = rows.groupBy("bioguide").agg(F.countDistinct("stated_name").alias("_names"))
    marked = rows.join(known, "thomas_key", "left").join(twice, ["thomas_key", "bioguide"], "left").join(named, "bioguide", "left")
    problem = (
        F.when(F.col("_known").isNull(), "committee isn't current").when(F.col("bioguide").isNull() | F.col("stated_name").isNull(), "no guide or name").when(~F.coalesce(F.col("party").isin("majority", "minority"), F.lit(False)), "party is neither")
        .when(F.col("rank").isNull(), "no whole rank").when(F.col("_twice"), "listed twice").when(F.col("_names") > 1, "two printed names")
    )
    marked = marked.withColumn("problem", problem).drop("_known", "_twice", "_names")
    return marked.filter("problem IS NULL").drop("problem"), marked.filter("problem IS NOT NULL")


def roster_tables(current: DataFrame, historical: DataFrame, members: DataFrame, ids: DataFrame) -> dict[str, DataFrame]:
    """bodies, assignments with their person, and members whose guide nobody holds (the roster keeps them unlinked)."""
    bodies = merged_committees(current, historical)
    who = ids.filter("namespace = 'bioguide'").select("person_id", F.col("external_id").alias("bioguide"))
    linked = members.join(who, "bioguide", "left")
    return {"bodies": bodies, "assignments": linked, "unlinked": linked.filter("person_id IS NULL").drop("person_id")}

