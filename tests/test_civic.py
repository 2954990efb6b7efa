from __future__ import annotations

import io
import json
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from civicloom.functions import scalars as S
from civicloom.functions.wkb import polygon_edges
from civicloom.operators import health, lifecycle, links, outside, pick, reconcile
from civicloom.plans import registry
from civicloom.sources import bills, delimited, people, rollcalls, shapes, sinks


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# Roll calls ------------------------------------------------------------------------------------------

HOUSE = """<?xml version="1.0"?><!DOCTYPE rollcall-vote PUBLIC "-//x" "y.dtd"><rollcall-vote><vote-metadata><majority>D</majority><congress>110</congress><session>1st</session>
<committee>U.S. House</committee><rollcall-num>7</rollcall-num><legis-num>H R 1</legis-num><vote-result>{result}</vote-result><action-date>{day}</action-date><action-time time-etz="{etz}">x</action-time>
<vote-totals><totals-by-party><party>Dem</party><yea-total>2</yea-total></totals-by-party><totals-by-party><yea-total>9</yea-total></totals-by-party>
<totals-by-vote><yea-total>2</yea-total><nay-total>1</nay-total></totals-by-vote></vote-totals></vote-metadata>
<vote-data><recorded-vote><legislator name-id="A000001" party="D" state="XA" role="legislator">Abc</legislator><vote>Aye</vote></recorded-vote><recorded-vote><legislator>Zoë</legislator><vote>Present</vote></recorded-vote></vote-data></rollcall-vote>"""


def house(result="Passed", day="4-Jan-2007", etz="14:05"):
    return HOUSE.format(result=result, day=day, etz=etz)


def test_house_rolls(spark):
    docs = [("a", house()), ("b", house("Johnson", etz="99:99")), ("c", house(day="40-Jan-2007")), ("d", "<x/>"), ("e", "<rollcall-vote><vote"), ("f", None), ("g", "<rollcall-vote/>"), ("h", "")]
    files = rollcalls.house_files(spark.createDataFrame(docs, "k string, x string"), "k", "x")
    assert {r.key: r.problem for r in rollcalls.refused(files).collect()} == {
        "c": "action-date is not a day", "d": "root is x", "e": "not well-formed", "f": "no document", "g": "no vote-metadata", "h": "root is absent",
    }
    got = {r.key: r for r in rollcalls.house_rolls(files).collect()}
    assert (got["a"].result, str(got["a"].occurred_at), got["a"].chamber_label, got["a"].yea_total, got["a"].present_total, got["a"].notes) == ("pass", "2007-01-04 19:05:00", "U.S. House", 2, None, [])
    assert (got["b"].result, got["b"].occurred_at, got["b"].notes) == (None, None, ["time_unusable", "result_not_normalized"])
    assert rows(rollcalls.house_party_totals(files).filter("key = 'a'").select("party", "yea_total", "nay_total")) == [("Dem", 2, None)]
    assert [(r.source_ordinal, r.bioguide_id, r.name, r.position) for r in rollcalls.house_votes(files).filter("key = 'a'").orderBy("source_ordinal").collect()] == [(1, "A000001", "Abc", "yes"), (2, None, "Zoë", "other")]


SENATE = """<roll_call_vote><congress>109</congress><session>1</session><congress_year>2005</congress_year><vote_number>54</vote_number><vote_date>{at}</vote_date><modify_date>x</modify_date>
<vote_result>Motion Agreed to</vote_result>{document}<count><yeas>50</yeas><nays>50</nays><present/></count><tie_breaker><by_whom>VP</by_whom><tie_breaker_vote>Yea</tie_breaker_vote></tie_breaker>
<members><member><member_full>X (D-XA)</member_full><vote_cast>Guilty</vote_cast><lis_member_id>S1</lis_member_id></member><member><vote_cast>Nay</vote_cast></member></members></roll_call_vote>"""


def test_senate_rolls_and_their_bills(spark):
    bill = "<document><document_type>H.R.</document_type><document_number>12</document_number></document>"
    named = "<document><document_type>PN</document_type><document_number>12</document_number></document>"
    at = "April 19, 2005,  02:51 PM"
    docs = [("a", SENATE.format(at=at, document=bill)), ("b", SENATE.format(at=at, document=named)), ("c", SENATE.format(at=at, document="")), ("d", SENATE.format(at="soon", document=""))]
    files = rollcalls.senate_files(spark.createDataFrame(docs, "k string, x string"), "k", "x")
    assert rows(rollcalls.refused(files)) == [("d", "vote_date is not a moment")]
    rolls = rollcalls.senate_rolls(files)
    got = {r.key: r for r in rolls.collect()}
    a = got["a"]
    assert (a.result, str(a.occurred_at), a.action_time_etz, a.present_total, a.not_voting_total, a.tie_breaker_vote, a.notes) == ("pass", "2005-04-19 18:51:00", "14:51", 0, None, "Yea", ["modified_unusable"])
    assert (a.link_congress, a.link_bill_type, a.link_bill_number) == (109, "hr", "12") and got["b"].link_bill_type is None and got["c"].link_congress is None
    known = spark.createDataFrame([("B1", "109", "hr", "12")], "bill_id string, congress string, bill_type string, bill_number string")
    assert {r.key: r.bill_id for r in rollcalls.link_bills(rolls, known).collect()} == {"a": "B1", "b": None, "c": None}
    assert [r.position for r in rollcalls.senate_votes(files).filter("key = 'a'").orderBy("source_ordinal").collect()] == ["other", "no"]
    menu = "<vote_summary><congress>109</congress><session>1</session><congress_year>2005</congress_year><votes><vote><vote_number>00054</vote_number><vote_tally><yeas>49</yeas><nays>50</nays></vote_tally></vote><vote><vote_number>55</vote_number></vote></votes></vote_summary>"
    listed = rollcalls.menu_votes(spark.createDataFrame([(menu,)], "x string"), "x")
    assert {r.roll_number: r.problems for r in rollcalls.menu_problems(rolls.filter("key = 'a'"), listed).collect()} == {54: ["yeas"], 55: ["no file"]}


def test_bills_of_any_number_are_linked_by_a_shuffle(spark):
    c = F.col("id")
    rolls = spark.range(900).select(
        c.cast("string").alias("key"), F.when(c % 3 < 2, (100 + c % 20).cast("int")).alias("link_congress"),
        F.when(c % 3 == 0, "hr").when(c % 3 == 1, "sjres").alias("link_bill_type"), F.when((c % 3 < 2) & (c != 6), c.cast("string")).alias("link_bill_number"), F.when(c == 3, "own").alias("bill_id"),
    )
    of = spark.range(0, 900, 2).select(F.concat(F.lit("B"), c).alias("bill_id"), F.explode(F.sequence(F.lit(100), F.lit(119))).alias("congress"), F.lit("hr").alias("bill_type"), c.alias("bill_number"))
    linked = rollcalls.link_bills(rolls, of)
    assert {r.key: r.bill_id for r in linked.collect()} == {str(i): "own" if i == 3 else f"B{i}" if i % 6 == 0 and i != 6 else None for i in range(900)}
    assert linked.count() == 900 and set(linked.columns) == set(rolls.columns)
    plan = linked._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    # The rolls that name no bill don't share a task.
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tasks = rollcalls.link_bills(rolls, of).filter("link_bill_type IS NULL").select(F.spark_partition_id().alias("at")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert tasks > 1


def test_results_of_both_chambers(spark):
    words = ["Amendment Not Adopted", "Motion Agreed to", "Motion Not  Agreed to", "not agreed to", "Not Guilty", "Cloture Rejected", "passed", "H R 5 passed", "Veto Sustained", "", None]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w string")
    got = [tuple(r) for r in df.orderBy("i").select(S.senate_result(F.col("w")), S.house_result(F.col("w"))).collect()]
    assert got == [("fail", None), ("pass", None), ("fail", None), ("fail", "fail"), (None, None), ("fail", None), ("pass", "pass"), ("pass", None), (None, None), (None, None), (None, None)]


def test_outside_rolls_link_to_exactly_one(spark):
    official = spark.createDataFrame([("r1", 110, "house", "1st", 7), ("r2", 110, "house", "2nd", 7), ("r3", 110, "house", "2nd", 7)], "roll_call_id string, congress int, chamber string, congress_session string, roll_number int")
    mine = spark.createDataFrame([("a", 110, "house", 1, 7), ("b", 110, "house", 2, 7), ("c", 110, "house", 3, 7), ("d", 110, "house", 1, None), ("e", 110, "senate", 1, 7)], "k string, congress int, chamber string, session int, clerk_rollnumber int")
    linked = rollcalls.link_outside_rolls(mine, official)
    assert {r.k: (r.matches, r.roll_call_id) for r in linked.collect()} == {"a": (1, "r1"), "b": (2, None), "c": (0, None), "d": (0, None), "e": (0, None)}
    members = spark.createDataFrame([("house", None, 1, ["A"], "B"), ("president", None, None, None, None), ("senate", "p", 1, ["A"], "A")], "chamber string, person_id string, n_people int, guides array<string>, guide string")
    got = rollcalls.link_summary(members, linked, spark.range(3)).first().asDict()
    assert got == {"members": 3, "unlinked_members": 1, "unlinked_presidents": 1, "bioguide_disagreements": 1, "roll_calls": 5, "votes_linked": 1, "votes_ambiguous": 1, "votes_no_clerk_number": 1, "votes_unmatched": 2, "parties": 3}


# Bills -----------------------------------------------------------------------------------------------

BILL = """<billStatus><bill><billNumber>9</billNumber><billType>HR</billType><congress>117</congress><titles><item><title>An Act</title></item></titles><introducedDate>2021-01-03</introducedDate>
<sponsors><item><bioguideId>A000001</bioguideId></item></sponsors><cosponsors><item><bioguideId>B000001</bioguideId><sponsorshipDate>2021-01-05</sponsorshipDate></item><item><fullName>none</fullName></item></cosponsors>
<actions><item><actionDate>2021-01-03</actionDate><text>Introduced</text><type>Intro</type><actionCode>1000</actionCode></item><item><text>x</text></item></actions><committees><item><systemCode>HSJU00</systemCode></item></committees>
<policyArea><name>Crime and Law</name></policyArea><subjects><legislativeSubjects><item><name>Civil actions</name></item></legislativeSubjects></subjects><textVersions><item><date>2021</date></item></textVersions>
<summaries><billSummaries><item><name>Intro</name><cdata><text>Sum</text></cdata></item></billSummaries></summaries><laws><item><type>Public Law</type><number>117-1</number></item><item><type>q</type></item></laws>
<relatedBills><item><number>5</number><congress>117</congress><type>S</type><latestTitle>T</latestTitle><relationshipDetails><item><type>Identical</type></item></relationshipDetails></item><item><number>6</number></item></relatedBills>
<amendments><amendment><number>1</number><congress>117</congress><type>HAMDT</type><sponsors><item><identifiers><bioguideId>C000001</bioguideId></identifiers></item></sponsors></amendment></amendments><cboCostEstimates><item><title>E</title></item></cboCostEstimates></bill></billStatus>"""


def test_status_documents(spark):
    docs = spark.createDataFrame([("p/BILLSTATUS-117hr9.xml", BILL), ("b", "<billStatus><bill><congress>1</congress></bill></billStatus>"), ("c", "<billStatus>"), ("d", None)], "k string, x string")
    t = bills.status_tables(docs, "k", "x")
    assert rows(t["bills"].select("congress", "bill_type", "bill_number", "title")) == [(117, "hr", "9", "An Act")]
    assert rows(t["identifiers"].select("namespace", "external_id")) == [("govinfo.package", "BILLSTATUS-117hr9"), ("us.bill", "117-hr-9")]
    assert rows(t["sponsorships"].select("role", "bioguide_id", F.col("sponsorship_date").cast("string"))) == [("cosponsor", "B000001", "2021-01-05"), ("sponsor", "A000001", None)]
    assert rows(t["actions"].select("source_ordinal", "classification")) == [(1, ["Intro", "1000"]), (2, None)]
    assert rows(t["subjects"].select("kind", "external_id")) == [("legislative_subject", "civil-actions"), ("policy_area", "crime-and-law")]
    assert rows(t["summaries"].select("action_description", "text")) == [("Intro", "Sum")] and rows(t["documents"].select("document_type")) == [("text_version",)]
    assert {n: t[n].count() for n in ("laws", "related_bills", "amendments", "cost_estimates", "committees")} == dict.fromkeys(("laws", "related_bills", "amendments", "cost_estimates", "committees"), 1)
    assert t["amendments"].first().sponsor_bioguide_id == "C000001" and t["related_bills"].first().relationships[0]["type"] == "Identical"
    assert rows(t["refused"]) == [("b", "no bill identity"), ("c", "not well-formed"), ("d", "no document")]


def test_bill_texts_know_themselves_by_their_names(spark):
    v = [("/a/BILLS-119hr23eh.xml", '<?xml version="1.0"?><!DOCTYPE bill PUBLIC "x" "y"><bill><metadata><dublinCore><dc:title>119 HR 23 EH: x</dc:title></dublinCore></metadata><form><legis-num>H. R. 23</legis-num></form></bill>'), ("/a/bad.xml", "<b/>"), ("/a/BILLS-119s5is.xml", "<bill><metadata><dublinCore><dc:title>119 S 6</dc:title></dublinCore></metadata></bill>"), ("/a/BILLS-119s7is.xml", None)]
    got = {r.package_id: r for r in bills.text_versions(spark.createDataFrame(v, "p string, x string"), "p", "x").collect()}
    a = got["BILLS-119hr23eh"]
    assert (a.congress, a.bill_type, a.bill_number, a.version_code, a.legislative_number, a.stale, a.problem) == (119, "hr", "23", "eh", "H. R. 23", False, None)
    assert got["bad"].problem == "name of another form" and got["BILLS-119s5is"].stale and got["BILLS-119s7is"].problem == "not well-formed"


def test_records_in_parts(spark):
    page = '{"bills":[{"congress":117,"type":"HR","number":"9","updateDate":"2021"}],"pagination":{"next":"https://x?offset=250&limit=250"}}'
    assert rows(bills.listed_bills(spark.createDataFrame([(page,), ('{"bills":[{"congress":117,"type":"S","number":"1"}]}',)], "b string"), "b")) == [(117, "hr", "9", "2021", 250), (117, "s", "1", None, None)]
    parts = [("k", "bill", '{"bill":{"congress":117,"type":"HR","number":"9","title":"T"}}'), ("k", "actions", '{"actions":[{},{}]}'), ("k", "actions", '{"actions":[{}]}'), ("k", "subjects", '{"subjects":{"legislativeSubjects":[{}]}}'), ("m", "actions", '{"actions":[]}')]
    got = {r.bill_key: r for r in bills.assembled_bills(spark.createDataFrame(parts, "bill_key string, part string, body string")).collect()}
    assert (got["k"].n_actions, got["k"].n_subjects, got["k"].missing) == (3, 1, ["committees", "cosponsors", "summaries", "textversions"]) and "bill" in got["m"].missing


# People ----------------------------------------------------------------------------------------------


def person(**more):
    return json.dumps({"id": {"bioguide": "A000001", "fec": ["H1", "H2"], "govtrack": 40}, "name": {"first": "Ann", "last": "Bell", "nickname": "Annie"}, **more})


def test_people_and_their_terms(spark):
    term = {"type": "rep", "start": "2007-01-04", "end": "2009-01-03", "state": "xa", "district": 0, "party": "D", "phone": "1"}
    full = person(terms=[term, {**term, "type": "sen", "class": 2, "district": None}, {**term, "type": "gov"}, {**term, "state": " "}], other_names=[{"last": "Old", "end": "1999-01-01"}, {"last": "Open"}], bio={"birthday": "1950-02-03", "gender": "F"},
                  leadership_roles=[{"chamber": "house", "title": "Whip", "start": "2007-01-04"}], social={"twitter": "x", "twitter_id": "5", "odd": "?"}, offices=[{"id": "o1", "latitude": 1.5, "longitude": 2.5}, {"id": "o2", "latitude": 1.5}, {"city": "X"}])
    docs = spark.createDataFrame([("a.json", json.dumps([json.loads(full), {"id": {}}, json.loads(person().replace("A000001", "bad"))])), ("b.json", "{"), ("c.json", json.dumps({"K": [1]}))], "p string, c string")
    records = people.read_records(docs, "p", "c")
    assert {r.path: bool(r.problem) for r in records.collect()} == {"a.json": False, "b.json": True, "c.json": False}
    parsed = people.people_records(records.filter("path = 'a.json'"))
    assert sorted((r.bioguide or "", r.problem or "") for r in parsed.collect()) == [("", "no guide"), ("A000001", ""), ("BAD", "malformed guide")]
    assert rows(people.people(parsed).select("full_name", F.col("birthday").cast("string"))) == [("Ann Bell", "1950-02-03")]
    assert rows(people.identifiers(parsed).select("namespace", "external_id")) == [("bioguide", "A000001"), ("fec", "H1"), ("fec", "H2"), ("govtrack", "40")]
    assert rows(people.names(parsed).select("name_kind", "full_name", "source_vintage")) == [("former", "Old", "1999-01-01"), ("former", "Open", "9999-12-31"), ("nickname", "Annie", "0000-00-00")]
    assert rows(people.social_accounts(parsed)) == [("A000001", "twitter", "x", "5")] and rows(people.unknown_social(parsed)) == [("A000001", "odd")]
    good, bad = people.offices(parsed)
    assert rows(good.select("office_key")) == [("o1",)] and rows(bad.select("problem")) == [("half a pair of coordinates",), ("no key",)]
    assert struct.unpack("<BIdd", good.first().point) == (1, 1, 2.5, 1.5) and people.leadership(parsed).count() == 1
    kept, refused = people.terms(parsed)
    assert rows(kept.select("chamber", "role", "state_ocd", "post_ocd", "post_label")) == [
        ("rep", "representative", "ocd-division/country:us/state:xa", "ocd-division/country:us/state:xa/cd:at-large", "At-Large"), ("sen", "senator", "ocd-division/country:us/state:xa", "ocd-division/country:us/state:xa", "Class 2"),
    ]
    assert rows(refused.select("problem")) == [("chamber is neither rep nor sen",), ("no state",)]
    ids = spark.createDataFrame([("p1", "bioguide", "A000001")], "person_id string, namespace string, external_id string")
    divisions = spark.createDataFrame([("d1", "ocd-division/country:us/state:xa/cd:at-large")], "division_id string, ocd_division_id string")
    posts = spark.createDataFrame([("s1", "d1", "H", "At-Large")], "post_id string, division_id string, organization_id string, label string")
    got = people.term_memberships(kept, ids, divisions, posts, "H", "S", F.lit("art"))
    assert rows(got.select("organization_id", "post_id", "role", "phone")) == [("H", "s1", "representative", "1"), ("S", None, "senator", "1")]


def test_committees(spark):
    current = json.dumps({"type": "house", "name": "Judiciary", "thomas_id": "HSJU", "subcommittees": [{"name": "Courts", "thomas_id": "03"}, {"name": "Odd"}]})
    old = json.dumps({"type": "senate", "name": "Old name", "thomas_id": "HSJU", "congresses": [110, 111]})
    c, refused = people.committee_bodies(spark.createDataFrame([(current,)], "record string"), "current")
    h, _ = people.committee_bodies(spark.createDataFrame([(old,)], "record string"), "historical")
    assert rows(c.select("thomas_key", "parent_thomas_key", "kind")) == [("HSJU", None, "committee"), ("HSJU03", "HSJU", "subcommittee")] and rows(refused.select("problem")) == [("no key",)]
    merged = {r.thomas_key: r for r in people.merged_committees(c, h).collect()}
    assert (merged["HSJU"].name, merged["HSJU"].chamber, merged["HSJU"].congresses, merged["HSJU"].has_history) == ("Judiciary", "house", [110, 111], True)
    row = {"bioguide": "A000001", "name": "Ann", "party": "majority", "rank": 1}
    listed = [("HSJU", [row, {**row, "bioguide": "B000001", "rank": "x"}, {**row, "bioguide": "C000001", "party": "x"}]), ("HSJU03", [{**row, "bioguide": "D000001"}, {**row, "bioguide": "D000001"}]), ("NONE", [row])]
    members, bad = people.committee_members(spark.createDataFrame([(json.dumps({"_key": k, "rows": v}),) for k, v in listed], "record string"), c)
    assert rows(members.select("thomas_key", "bioguide")) == [("HSJU", "A000001")]
    assert rows(bad.select("problem")) == [("committee isn't current",), ("listed twice",), ("listed twice",), ("no whole rank",), ("party is neither",)]
    ids = spark.createDataFrame([("p1", "bioguide", "Z")], "person_id string, namespace string, external_id string")
    assert people.roster_tables(c, h, members, ids)["unlinked"].count() == 1


# Shapes and population files ------------------------------------------------------------------------------


def shape_zip(records, rings_of, kind=5):
    """A zipped shape file of records and the rings of each."""
    dbf_fields = list(records[0])
    head = struct.pack("<BBBBIHH20x", 3, 24, 1, 1, len(records), 32 + 32 * len(dbf_fields) + 1, 1 + 10 * len(dbf_fields))
    dbf = head + b"".join(f.encode().ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([10]) + b"\0" * 15 for f in dbf_fields) + b"\r"
    dbf += b"".join(b" " + b"".join(str(r[f]).encode().ljust(10) for f in dbf_fields) for r in records)
    shp = b"\0" * 100
    for i, rings in enumerate(rings_of, 1):
        if rings is None:
            body = struct.pack("<i", 0)
        else:
            flat = [p for r in rings for p in r]
            starts = [sum(len(r) for r in rings[:k]) for k in range(len(rings))]
            body = struct.pack("<i4dii", kind, 0, 0, 0, 0, len(rings), len(flat)) + struct.pack(f"<{len(rings)}i", *starts) + b"".join(struct.pack("<2d", *p) for p in flat)
        shp += struct.pack(">II", i, len(body) // 2) + body
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("a.shp", shp)
        z.writestr("a.DBF", dbf)
    return out.getvalue()


SQUARE = [(0, 0), (0, 4), (4, 4), (4, 0), (0, 0)]  # clockwise: an outer ring
HOLE = [(1, 1), (2, 1), (2, 2), (1, 2), (1, 1)]


def test_shapefiles(spark, tmp_path):
    records = [{"GEOID": "01", "NAMELSAD": "One", "CDSESSN": "119"}, {"GEOID": "02", "NAMELSAD": "", "CDSESSN": "118"}, {"GEOID": "03", "NAMELSAD": "x", "CDSESSN": "119"}]
    (tmp_path / "a.zip").write_bytes(shape_zip(records, [[SQUARE, HOLE], [SQUARE], None]))
    (tmp_path / "b.zip").write_bytes(b"no zip")
    (tmp_path / "c.zip").write_bytes(shape_zip(records[:1], [[SQUARE]], kind=3))
    read = shapes.read_shapes(spark, str(tmp_path))
    assert {r.path[-5:]: bool(r.problem) for r in read.collect()} == {"a.zip": False, "b.zip": True, "c.zip": True}
    good, bad = shapes.layer_features(read.filter("endswith(path, 'a.zip')"), "cd119", "art")
    assert rows(good.select("geoid", "name", "source_ordinal")) == [("01", "One", 1)]
    assert rows(bad.select("problem")) == [("CDSESSN is not 119",), ("no geometry",)]
    assert len(polygon_edges(bytes(good.first().geom))) == 8 and shapes.transformed(good).first().srid == 4326
    with pytest.raises(ValueError):
        shapes.transformed(good, 3857)
    geography = spark.createDataFrame([("g1", "congressional_district", "01")], "geography_id string, geography_type string, geoid string")
    loaded = shapes.boundaries(good, geography, "2024", "2023-01-03")
    assert rows(loaded.select("geography_id", "boundary_vintage", "source_artifact_id")) == [("g1", "2024", "art")]
    assert rows(shapes.boundary_reconciliation(good, loaded, geography)) == [("cd119", 1, 1, 1, True)]
    assert rows(shapes.boundary_reconciliation(good, loaded.limit(0), geography)) == [("cd119", 1, 1, 0, False)]


def test_decennial_files(spark):
    geo = spark.createDataFrame([("f|x|050|0|0|0|0|7|0500000US01001",), ("f|x|999|0|0|0|0|8|9990000US1",), ("short|line",)], "value string")
    good, bad = shapes.geography_lines(geo)
    assert rows(good) == [("7", "county", "01001")] and bad.count() == 1
    matrix = shapes.segment_matrix(spark.createDataFrame([(1, 10, "P1_001N"), (1, 20, "P1_002N"), (2, 5, "P2_001N")], "segment int, ordinal int, variable_id string"), 1)
    segment = shapes.segment_lines(spark.createDataFrame([("f|x|0|01|7|100|x",)], "value string"))
    assert rows(delimited.segment_values(good, segment, matrix)) == [("01001", "P1", "P1_001N", 100), ("01001", "P1", "P1_002N", None)]


def test_lines_under_a_header(spark):
    lines = [("z", "m", 1, "﻿FIPSTATE,naics,fipscty"), ("z", "m", 2, '99,"1,1",'), ("z", "m", 3, "1,2"), ("z", "m", 4, '"x,2,3'), ("z", "n", 1, "a,a"), ("z", "n", 2, "1,2")]
    good, bad = delimited.with_header(spark.createDataFrame(lines, "archive string, member string, source_ordinal bigint, line string"))
    assert [(r.source_ordinal, r.raw) for r in good.collect()] == [(2, {"fipstate": "99", "naics": "1,1", "fipscty": ""})]
    assert rows(bad.select("member", "source_ordinal", "problem")) == [("m", 3, "ragged row"), ("m", 4, "broken quoting"), ("n", 2, "header has an empty or repeated column")]
    raw = spark.createDataFrame([("a", {"fipstate": "1", "fipscty": None, "naics": "00", "lfo": "", "est": "10", "emp": "x", "qp1": None, "ap": "-4"}), ("a", {"fipstate": "98", "naics": "00"})], "artifact_id string, raw map<string,string>")
    places = spark.createDataFrame([("g", "state", "01")], "geography_id string, geography_type string, geoid string")
    facts, lost = delimited.promoted_business(delimited.business_rows(raw), places)
    assert rows(facts.select("geography_id", "legal_form", "establishments", "employment", "annual_payroll")) == [("g", "-", 10, None, -4)] and rows(lost) == [("98", 1)]
    kinds = spark.createDataFrame([("x/psam_p01.csv",), ("ss06hxa.csv",), ("readme",)], "m string").select("m", delimited.record_type(F.col("m")))
    assert rows(kinds) == [("readme", None), ("ss06hxa.csv", "housing"), ("x/psam_p01.csv", "person")]


def test_cells_that_are_no_numbers_have_a_reason(spark):
    df = spark.createDataFrame([("0500000US01001", "1.5", "N", "abc")], "geo_id string, t_e1 string, t_m1 string, t_e2 string")
    got = {r.field_id: (r.value and float(r.value), r.problem) for r in delimited.survey_rows(df, "geo_id", "T").collect()}
    assert got == {"t_e1": (1.5, None), "t_m1": (None, None), "t_e2": (None, "not a number: abc")}


def test_other_files(spark):
    rel = delimited.relationship_rows(spark.createDataFrame([("0101", " ", "5", "x"), ("0101", "0202", "5", "6")], "d string, o string, l string, w string"), "d", "o", "l", "w")
    assert rows(links.relationship_crosswalk(rel).select("overlap_geoid", "area_water_part")) == [("0202", 6)] and rel.filter("overlap_geoid IS NULL").count() == 1
    good, bad = delimited.block_rows(spark.createDataFrame([("0" * 15, "01"), ("1", "01"), ("0" * 15, None), ("2" * 15, "ZZ")], "b string, c string"), "b", "c")
    assert good.count() == 2 and bad.count() == 2
    found, lost = links.block_crosswalk(good, spark.createDataFrame([("0001", "g1")], "geoid string, geography_id string"))
    assert rows(found.select("geography_id", "weight")) == [("g1", 1.0)] and rows(lost) == [("22", "ZZ", 1)]
    weights = spark.createDataFrame([("none", None), ("none", 1.0), ("population", 0.5), ("population", 1.5), ("population", None)], "weight_type string, weight double")
    assert links.bad_weights(weights).count() == 3
    m = delimited.microdata(spark.createDataFrame([("", "7", "x")], "old string, NEW string, other string"), {"n": ["old", "new"], "gone": ["nothing"]}, {"n": "int"})
    assert rows(m) == [(7, None)]
    assert spark.range(1).select(S.first_known(F.lit(" "), F.lit(None), F.lit("x")), S.congress_start(F.lit(110)).cast("string")).first()[:] == ("x", "2007-01-03")
    targets = spark.createDataFrame([("a", 3, 2, 1, 0), ("b", 3, 2, 0, 0), ("c", 0, 0, 0, 0), ("d", 3, 2, 0, 1)], "m string, rows_parsed int, rows_inserted int, rows_existing int, rows_rejected int")
    assert rows(reconcile.archive_reconciliation(targets).select("m")) == [("b",), ("c",), ("d",)]


def test_slices_are_replaced(spark, tmp_path):
    from civicloom.operators.keyed import replace_slice

    path = str(tmp_path / "t")
    for batch in ([(1, "a"), (2, "b")], [(2, "c")]):
        replace_slice(spark.createDataFrame(batch, "year int, v string"), path, ["year"])
    assert rows(spark.read.parquet(path).select("v", "year")) == [("a", 1), ("c", 2)]


def test_documents_are_read(spark, tmp_path):
    from civicloom.sources.records import header_rows, read_documents

    (tmp_path / "a.xml").write_text('<?xml version="1.0"?><!DOCTYPE x [<!ENTITY y "z">]><x/>')
    assert read_documents(spark, str(tmp_path)).first().xml == '<?xml version="1.0"?><x/>'
    body = json.dumps([["v", "state"], *[[str(i), "01"] for i in range(300)]])
    assert header_rows(spark.createDataFrame([(body,), (None,), ("[]",)], "j string"), "j", ["state"]).count() == 300


# Versions, divisions, merges -------------------------------------------------------------------------------

ARTIFACT = "dataset_id string, artifact_key string, artifact_version int, status string, checksum_sha256 string, local_path string, remote_url string, metadata map<string,string>"


def test_artifacts_append_promote_and_retry(spark):
    have = [("d", "new", 1, "downloaded", "x", "/a", "u", {"a": "1"}), ("d", "plan", 1, "downloaded", "y", "/p0", "u", {}), ("d", "plan", 2, "planned", None, "/p", "u", {"k": "1", "s": "0"}), ("d", "same", 1, "failed", "z", "/s", "u", None)]
    come = [("d", "new", "downloaded", "x2", "/b", "v", {}), ("d", "plan", "downloaded", "c", "/q", "v", {"s": "1"}), ("d", "same", "loaded", "z", "/s", "v", {"m": "1"}), ("d", "first", "planned", None, "/f", "v", None)]
    artifacts, arriving = spark.createDataFrame(have, ARTIFACT), spark.createDataFrame(come, ARTIFACT.replace("artifact_version int, ", ""))
    assert {r.artifact_key: r.action for r in lifecycle.register_action(arriving, artifacts).collect()} == {"new": "append", "plan": "promote", "same": "retry", "first": "append"}
    after = {(r.artifact_key, r.artifact_version): r for r in lifecycle.register_artifacts(artifacts, arriving).collect()}
    assert set(after) == {("new", 1), ("new", 2), ("plan", 1), ("plan", 2), ("same", 1), ("first", 1)}
    assert (after["plan", 2].checksum_sha256, after["plan", 2].local_path, after["plan", 2].metadata) == ("c", "/q", {"k": "1", "s": "1"})
    assert (after["same", 1].status, after["same", 1].local_path, after["same", 1].remote_url) == ("loaded", "/s", "v") and after["plan", 1].status == "downloaded"


def test_owners_are_found_before_they_are_made(spark):
    ids = spark.createDataFrame([("o1", "ocd", "x")], "organization_id string, namespace string, external_id string")
    wanted = spark.createDataFrame([("x", "X"), ("y", "Y"), ("y", "Y2")], "external_id string, name string")
    found, made, named = lifecycle.find_or_create(wanted, ids, "ocd", F.concat(F.lit("new-"), "external_id"))
    assert rows(found.select("external_id", "organization_id")) == [("x", "o1"), ("y", "new-y")] and rows(made.select("name")) == [("Y",)] and rows(named) == [("new-y", "ocd", "y")]


def test_life_of_divisions(spark):
    geography = spark.createDataFrame([("g1", "sldl", "02007", "District 7"), ("g2", "sldu", "0200B", "District B"), ("g3", "sldl", "02ZZZ", "none"), ("g4", "sldl", "25010", "First Suffolk"), ("g5", "state", "02", "Akland"), ("g6", "sldl", "2501A", "x")], "geography_id string, geography_type string, geoid string, name string")
    boundary = spark.createDataFrame([(f"b{i}", f"g{i}", "2024") for i in range(1, 7)], "boundary_id string, geography_id string, boundary_vintage string")
    states = spark.createDataFrame([("ak", "02"), ("ma", "25")], "postal string, fips string")
    seeded = lifecycle.seeded_divisions(geography, boundary, states, "2024")
    assert rows(seeded.select("ocd_division_id", "label")) == [("ocd-division/country:us/state:ak/sldl:7", "Akland District 7"), ("ocd-division/country:us/state:ak/sldu:b", "Akland District B"), ("ocd-division/country:us/state:ma/sldl:10", "MA First Suffolk")]
    have = spark.createDataFrame([("d0", "ocd-division/country:us/state:ak/sldl:7", "old", "sldl", None, None)], "division_id string, ocd_division_id string, label string, classification string, seeded_from string, geoid string")
    divisions = lifecycle.seed_divisions(have, seeded).withColumn("division_id", F.coalesce("division_id", "geoid"))
    assert divisions.count() == 3 and divisions.filter("label = 'old'").count() == 1
    pairs = spark.createDataFrame([("25010", "sldl", "ocd-division/country:us/state:ma/sldl:1st_suffolk", "First Suffolk")], "geoid string, chamber string, ocd_division_id string, census_name string")
    assert lifecycle.crosswalk_divisions(pairs, geography, boundary, "2024").count() == 1 and lifecycle.crosswalk_divisions(pairs, geography, boundary, "2022").count() == 0
    held = spark.createDataFrame([("25010", "b4", 119, None), ("d0", "b1", None, "2024")], "division_id string, boundary_id string, congress int, legislative_year string")
    none = spark.createDataFrame([], "division_id string")
    left, kept, retired = lifecycle.retire_phantoms(divisions, held, none, pairs)
    assert rows(retired.select("division_id")) == [("25010",)] and left.count() == 2 and kept.count() == 1
    assert lifecycle.retire_phantoms(left, kept, none, pairs)[2].count() == 0
    assert lifecycle.retire_phantoms(divisions, held, spark.createDataFrame([("25010",)], "division_id string"), pairs)[2].count() == 0
    assert rows(lifecycle.wrong_vintage_links(held, boundary, geography, "2024", 119, "2024").select("division_id")) == [("25010",)]
    assert lifecycle.wrong_vintage_links(held, boundary, geography, "2022", 119, "2024").count() == 2
    assert rows(lifecycle.unlinked_divisions(divisions, held, states)) == [("0200B", "no boundary has the code")]


def test_crosswalk_counts(spark):
    rel = spark.createDataFrame([("a", "01", "02"), ("a", None, "02"), ("b", "01", "02")], "artifact_id string, district_geoid string, overlap_geoid string")
    blocks = spark.createDataFrame([("a",), ("a",)], "artifact_id string")
    stored = [("a", "relationship", "none", None, None), ("a", "block_assignment", "assignment", 1.0, "whole_block_tabulation"), ("a", "block_assignment", "assignment", 1.0, "whole_block_tabulation")]
    schema = "source_artifact_id string, method string, weight_type string, weight double, quality_flag string"
    assert lifecycle.crosswalk_reconciliation(rel, blocks, spark.createDataFrame(stored, schema), "a").first().holds
    assert not lifecycle.crosswalk_reconciliation(rel, blocks, spark.createDataFrame([*stored[:2], ("a", "block_assignment", "assignment", 0.5, None)], schema), "a").first().holds


def test_merges_are_whole_or_not_at_all(spark):
    ids = spark.createDataFrame([("s1", "bioguide", "A"), ("d1", "fec", "F"), ("s2", "bioguide", "B"), ("d2", "bioguide", "C"), ("s3", "bioguide", "D"), ("d3", "lis", "L")], "person_id string, namespace string, external_id string")
    votes = spark.createDataFrame([("r1", "s1", "yes"), ("r1", "d1", "no"), ("r2", "d1", "yes"), ("r1", "d2", "no"), ("r9", "x", "no")], "roll_call_id string, person_id string, position string")
    terms = spark.createDataFrame([("H", "s3", "rep", 1), ("H", "d3", "rep", 1), ("H", "d1", "rep", 5)], "organization_id string, person_id string, role string, start int")
    pairs = spark.createDataFrame([("m1", "s1", "d1"), ("m2", "s2", "d2"), ("m3", "s3", "d3"), ("m4", "s1", "s1")], "merge_id string, survivor string, duplicate string")
    got = lifecycle.merge_entities(pairs, ids, {"votes": (votes, ["roll_call_id", "person_id"]), "terms": (terms, ["organization_id", "person_id", "role", "start"])}, aborting=["terms"])
    assert rows(got.refused) == [("m2", "two primary ids"), ("m3", "terms collides"), ("m4", "already one")]
    assert rows(got.tables["votes"]) == [("r1", "d2", "no"), ("r1", "s1", "yes"), ("r2", "s1", "yes"), ("r9", "x", "no")] and rows(got.preserved["votes"]) == [("r1", "d1", "no")]
    assert ("F", "s1") in {(r.external_id, r.person_id) for r in got.tables["identifiers"].collect()} and rows(got.audit) == [("m1", "s1", "d1", 2, 1, 1)]


def test_ranking_fails_closed(spark):
    ranking = spark.createDataFrame([("official", "A", 1)], "name_kind string, dataset_id string, rank int")
    display = spark.createDataFrame([("official", 1)], "name_kind string, position int")
    good = spark.createDataFrame([("e", "official", "A", "1", "N")], "entity string, name_kind string, dataset_id string, source_vintage string, full_name string")
    assert pick.resolved(good, ranking, display, "entity").count() == 1
    with pytest.raises(ValueError, match="B official"):
        pick.resolved(good.union(good.withColumn("dataset_id", F.lit("B"))), ranking, display, "entity")
    with pytest.raises(ValueError):
        pick.required(good.limit(0), "artifact")


# Health and registry ---------------------------------------------------------------------------------------


def test_coverage_hides_no_gap(spark):
    expected = spark.createDataFrame([(110, "hr", 5), (110, "s", 5), (111, "hr", None)], "congress int, kind string, expected int")
    loaded = spark.createDataFrame([(110, "hr", 9), (110, "s", 1), (110, "odd", 1), (111, "hr", 2)], "congress int, kind string, loaded int")
    got = {(r.congress, r.kind, r.level): (r.expected, r.loaded, r.missing, r.surplus, r.status) for r in health.coverage_report(expected, loaded, ["congress", "kind"], ["congress"]).collect()}
    assert got[110, None, "total"] == (10, 10, 0, 0, "incomplete") and got[111, None, "total"] == (None, 2, None, None, "unknown")
    assert got[110, "odd", "other"][4] == "unknown" and got[110, "hr", "cell"] == (5, 9, 0, 4, "complete")
    spans = spark.createDataFrame([("a", "2007-01-04", "2009-01-03"), ("a", "2009-01-03", None), ("b", None, None)], "k string, s string, e string").select("k", F.col("s").cast("date").alias("s"), F.col("e").cast("date").alias("e"))
    periods = spark.createDataFrame([(110, "2007-01-03", "2009-01-03"), (111, "2009-01-03", "2011-01-03")], "period int, f string, a string").select("period", F.col("f").cast("date").alias("first_day"), F.col("a").cast("date").alias("after"))
    assert rows(health.period_counts(spans, "k", "s", "e", periods)) == [(110, 1), (111, 1)]


def test_health(spark):
    runs = spark.createDataFrame([("a", "running", "2024-01-01 00:00:00", None, None), ("b", "running", "2024-01-02 00:00:00", None, None), ("c", "succeeded", "2024-01-01 00:00:00", None, None)], "run_id string, status string, started_at string, finished_at string, error_message string")
    runs = runs.withColumn("started_at", F.col("started_at").cast("timestamp")).withColumn("finished_at", F.col("finished_at").cast("timestamp"))
    after = health.fail_stale(runs, F.lit("2024-01-02 06:00:00").cast("timestamp"), 24, "stale")
    assert {r.run_id: r.status for r in after.collect()} == {"a": "failed", "b": "running", "c": "succeeded"}
    got = json.loads(health.health_json({"people": (spark.range(3), F.count("*"))}, runs.select("run_id", "started_at"), "started_at", 2).first().health)
    assert got["people"] == 3 and [r["run_id"] for r in got["latest_runs"]][0] == "b" and len(got["latest_runs"]) == 2
    items = spark.createDataFrame([("x", "healthy"), ("x", "attention"), ("y", "healthy"), ("z", "odd")], "family string, status string")
    families = spark.createDataFrame([("x",), ("y",), ("z",), ("w",)], "family string")
    assert rows(health.worst_status(items, "family", families).select("family", "status")) == [("w", "unknown"), ("x", "attention"), ("y", "healthy"), ("z", "failed")]
    exceptions = spark.createDataFrame([("n", "1", 4), ("n", "2", 5)], "namespace string, external_id string, reference_count int")
    assert health.unresolved_references(exceptions, exceptions.limit(1)).first().n in (4, 5)
    counts = health.loaded_counts({"runs": (runs, ["status"]), "people": (spark.range(2), [])})
    assert rows(counts) == [("people", "", 2), ("runs", "running", 2), ("runs", "succeeded", 1)]


def test_sources_and_snapshots(spark):
    artifacts = spark.createDataFrame([("a1", "k1", 1, "failed", "p", 5), ("a2", "k1", 2, "failed", "p", 6), ("a3", "k2", 1, "loaded", "p", 7)], "artifact_id string, artifact_key string, artifact_version int, status string, product string, bytes_downloaded long")
    plans = spark.createDataFrame([("P", "k1"), ("P", "k2"), ("P", "k3")], "plan_id string, artifact_key string")
    facts = spark.createDataFrame([("a3",), ("a3",)], "source_artifact_id string")
    assert rows(health.artifact_evidence(plans, artifacts, facts)) == [("P", 3, 1, 1, 2, ["k3"])]
    targets = spark.createDataFrame([("a3", "r1", 1, 3, 1, 1, 0), ("a3", "r2", 2, 3, 2, 1, 0)], "artifact_id string, run_id string, recorded_at int, rows_parsed int, rows_inserted int, rows_existing int, rows_rejected int")
    got = health.source_status(artifacts.filter("artifact_id = 'a3'"), facts.withColumnRenamed("source_artifact_id", "artifact_id"), facts, targets, ["product"]).first()
    assert (got.n_artifacts, got.bytes, got.n_staged, got.n_published, got.latest_run, got.reconciles) == (1, 7, 2, 2, 2, True)
    counts = spark.createDataFrame([("118", 5, 0)], "congress string, events int, votes int")
    need = spark.createDataFrame([("118",), ("119",)], "congress string")
    assert rows(health.snapshot_validation(counts, need, "congress", ["events", "votes"])) == [("118", "no votes"), ("119", "missing")]
    src = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "c", "y")], "k int, v string, g string")
    can = spark.createDataFrame([(1, "a", "x"), (2, "z", "x"), (4, "c", "y")], "k int, v string, g string")
    assert rows(health.refresh_preview(src, can, ["k"], "v", "g")) == [("x", 2, 2, 0, 1, 0), ("y", 1, 1, 1, 0, 1)]
    assert rows(health.listing_compare(src, can, ["g"], "k")) == [("x", 2, 2, 2, 0, 0, True), ("y", 1, 1, 0, 1, 1, False)]
    assert rows(health.pending_files(src, can, "k", "v").select("k", "reason")) == [(2, "changed"), (3, "new")]
    assert health.group_sample(src, ["g"], "k", 1).count() == 2
    assert {r.k: r.decision for r in health.acquisition(src.select("k", "v"), can.select("k", "v"), "k", ["v"]).collect()} == {1: "reuse", 2: "download", 3: "download"}
    files = spark.createDataFrame([("/a/x.ZIP", 5, 1), ("/a/b/y", 6, 2), ("/c", 7, 3)], "path string, length long, modificationTime int")
    assert rows(health.file_audit(files, ["/a", "/a/b"])) == [("/a", "zip", 1, 5, 1), ("/a/b", "", 1, 6, 2), (None, "", 1, 7, 3)]
    assert health.approximate_rows(spark.range(10)) == 10


def test_registry(spark):
    providers = spark.createDataFrame([("p", "P")], "provider_id string, name string")
    datasets = spark.createDataFrame([("d", "p", "D"), ("e", "p", "E")], "dataset_id string, provider_id string, title string")
    resources = spark.createDataFrame([("d", "r1"), ("d", "r2")], "dataset_id string, resource_id string")
    snaps = spark.createDataFrame([("d", 1), ("d", 3), ("d", 2)], "dataset_id string, captured_at int")
    assert rows(registry.registry_status(providers, datasets, resources, snaps).select("dataset_id", "resources", "last_snapshot", "state")) == [("d", 2, 3, "ready"), ("e", 0, None, "pending_adapter")]
    shells = spark.createDataFrame([("B1_001", "Total", "T", "U", "int"), ("B1", "x", "x", "x", "x"), ("_1", "x", "x", "x", "x"), (None, None, None, None, None)], "unique_id string, label string, title string, universe string, type string")
    fields = registry.shell_fields(shells, "acs", "2024-01-01")
    assert rows(fields.select("field_id", "description")) == [("B1_E001", "T -- U"), ("B1_M001", "T -- U")] and registry.upsert_fields(fields, fields).count() == 2
    manifest = spark.createDataFrame([("B01", "Age", "Detailed Table", "1,5"), ("B98", "Q", "Detailed Table", "5"), ("C01", "A", "Detailed Table", "5"), ("B02", "Race", "Detailed Table", "1"), ("B03", "x", "Detailed Table", ""), ("S01", "Age", "Subject Tables", "5")], "id string, title string, product string, year string")
    assert rows(registry.relevant_tables(manifest).select("id")) == [("B01",), ("B03",)]
    assert rows(registry.contract_selection(manifest, ["Detailed"], ["b0"], exclude=["b03"]).select("id")) == [("B01",), ("B02",)] and rows(registry.contract_selection(manifest, ["Subject"], terms=["AGE"]).select("id")) == [("S01",)]


def test_ranking_files(spark):
    doc = {"version": 1, "entities": {"person": {"display": ["official", "common"], "kinds": {"official": {"": [{"dataset": "A", "field": "f"}, {"dataset": "B", "field": "g"}]}, "common": {"": [{"dataset": "A", "field": "f"}]}}}}}
    ranks, places = registry.precedence_rows(spark.createDataFrame([(json.dumps(doc),)], "body string"))
    assert rows(ranks.select("name_kind", "dataset_id", "rank")) == [("common", "A", 1), ("official", "A", 1), ("official", "B", 2)] and rows(places.select("name_kind", "position")) == [("common", 2), ("official", 1)]
    known = spark.createDataFrame([("A",), ("B",)], "dataset_id string")
    assert registry.precedence_problems(ranks, places, known).count() == 0
    bad = registry.precedence_problems(ranks, places.filter("name_kind = 'official'"), known.limit(1))
    assert {r.problem for r in bad.collect()} == {"ranked but never displayed", "unknown dataset B"}
    stored = ranks.filter("dataset_id = 'A'").withColumn("rank", F.lit(9)).unionByName(ranks.limit(1).withColumn("dataset_id", F.lit("Z")))
    after, changes = registry.sync_precedence(stored, ranks, registry.precedence_problems(ranks, places, known))
    assert after.count() == 3 and rows(changes) == [("insert", 1), ("removed", 1), ("update", 2)]
    with pytest.raises(ValueError):
        registry.sync_precedence(stored, ranks, bad)
    with pytest.raises(ValueError):
        registry.sync_precedence(stored, ranks.limit(0), bad.limit(0))


def test_gates_and_inventory(spark):
    gates = [("a", "ready", "bioguide", "lis", None, "c1"), ("b", "blocked", "bioguide", "name", [], None), ("c", "odd", "x", None, None, None), ("d", "blocked", "bioguide", "fec", ["e"], None)]
    g = spark.createDataFrame(gates, "dataset_id string, state string, key string, via string, blocked_by array<string>, contract string")
    contracts = spark.createDataFrame([("c1", "a", "approved", True, "core.x"), ("c2", "d", "approved", True, "core.y"), ("c3", "b", None, True, "stage.z")], "contract_id string, dataset_id string, approval string, enabled boolean, target string")
    assert rows(registry.gate_problems(g, contracts, ["a", "zz"])) == [("b", "blocked by nothing"), ("b", "via is a name"), ("c", "key must be bioguide"), ("c", "unknown state"), ("d", "contract writes while blocked: c2"), ("zz", "no gate")]
    ids = spark.createDataFrame([("p1", "lis"), ("p1", "lis"), ("p2", "fec")], "person_id string, namespace string")
    assert {r.dataset_id: r.people_with_via for r in registry.gate_status(g, ids).collect()} == {"a": 1, "b": 0, "c": None, "d": 1}
    ds = spark.createDataFrame([("x", "P"), ("x", "Q"), ("y", " ")], "dataset_id string, provider string")
    assert rows(registry.inventory_problems(ds, ["provider"], refers={"provider": spark.createDataFrame([("P",), (" ",)], "p string")})) == [("x", "repeated"), ("x", "unknown provider Q"), ("y", "no provider")]


def test_baskets_and_plans(spark):
    basket = spark.createDataFrame([("b", "r1"), ("b", "r2")], "basket_id string, resource_id string")
    flips = spark.createDataFrame([("b", "r1"), ("b", "r3"), ("b", "r2"), ("b", "r2")], "basket_id string, resource_id string")
    assert rows(registry.toggle(basket, flips)) == [("b", "r2"), ("b", "r3")]
    hits = spark.createDataFrame([("r2",), ("r9",)], "resource_id string")
    assert registry.add_all(basket, hits, "b").count() == 3 and registry.snapshot_links(hits, basket.withColumnRenamed("basket_id", "snapshot_id"), "b").count() == 3
    assert {r.resource_id: r.gone for r in registry.basket_listing(basket, spark.createDataFrame([("r1", "T")], "resource_id string, title string"), "b").collect()} == {"r1": False, "r2": True}
    items = spark.createDataFrame([("01", 2024), ("02", 2024)], "st string, y int")
    assert rows(registry.planned_artifacts(items, "d", "sld-{y}-{st}", "https://x/{y}/{st}.zip"))[0] == ("d", "sld-2024-01", "https://x/2024/01.zip")
    members, ledger = spark.createDataFrame([("z", "a"), ("z", "b")], "archive string, member string"), spark.createDataFrame([("z", "a", "succeeded"), ("z", "b", "failed")], "archive string, member string, status string")
    assert rows(registry.archive_progress(members, ledger)) == [("z", "b")]
    rel = spark.createDataFrame([("p", 1, "k", "a0")], "product string, period int, kind string, artifact_id string")
    art = spark.createDataFrame([("p", 1, "k", "a1", True), ("p", 2, "k", "a3", True), ("p", 2, "k", "a2", True), ("p", 3, "k", "a4", False)], "product string, period int, kind string, artifact_id string, selected boolean")
    assert rows(registry.publish_releases(rel, art).select("period", "artifact_id")) == [(1, "a0"), (2, "a2")]
    page = spark.createDataFrame([("p", '<a href="x/a.zip">a</a> <A HREF="b.CSV"> <a href="?C=N"> <a href="x/a.zip">')], "page string, html string")
    assert rows(registry.directory_links(page).select("name")) == [("a.zip",), ("b.CSV",)]
    pages = spark.createDataFrame([(3, 0, 100, 100), (3, 100, 100, 100)], "release_offset int, series_offset int, n_items int, page_size int")
    assert rows(registry.crawl_cursor(pages)) == [(3, 200)] and rows(registry.crawl_cursor(pages.union(spark.createDataFrame([(3, 200, 5, 100)], pages.schema)))) == [(4, 0)]


# The outside publisher -------------------------------------------------------------------------------------


def test_outside_people_and_contacts(spark):
    ids = spark.createDataFrame([("o1", "bioguide", "A"), ("o2", "bioguide", "B"), ("o2", "bioguide", "C"), ("o3", "bioguide", "D"), ("o4", "bioguide", "D"), ("o1", "twitter", "x"), ("o1", " ", "y")], "ocd_person_id string, scheme string, identifier string")
    owned = spark.createDataFrame([("p1", "bioguide", "A"), ("p4", "bioguide", "D")], "person_id string, namespace string, external_id string")
    linked = outside.link_people(ids, owned)
    assert rows(linked) == [("o1", "A", "p1", None), ("o2", "B", None, "person_has_multiple_bioguide_ids"), ("o2", "C", None, "person_has_multiple_bioguide_ids"), ("o3", "D", None, "bioguide_claimed_by_multiple_people"), ("o4", "D", None, "bioguide_claimed_by_multiple_people")]
    people_ = spark.createDataFrame([("o1", "a@x", " "), ("o2", "a@x", "F")], "ocd_person_id string, email string, gender string")
    note = spark.createDataFrame([("o1", "http://x", None)], "ocd_person_id string, url string, note string")
    names = spark.createDataFrame([("o1", "Ann", "short")], "ocd_person_id string, name string, note string")
    offices = spark.createDataFrame([("o1", "capitol", "1 Main", "555", None, "x")], "ocd_person_id string, classification string, address string, voice string, fax string, name string")
    kept = outside.retained_contacts(linked, ids, people_, note, names, note, offices)
    got = {(r.ocd_person_id, r.kind, r.scheme, r.value): (r.person_id, r.shared, r.joins_people) for r in kept.collect()}
    assert got["o1", "email", "email", "a@x"] == ("p1", True, False) and got["o1", "identifier", "bioguide", "A"] == ("p1", False, True) and got["o1", "social", "twitter", "x"][1] is False
    assert ("o1", "office", "capitol:voice", "555") in got and ("o1", "link", "link", "http://x") in got and ("o1", "source", "source", "http://x") in got and len(got) == 15


def test_outside_bills_and_votes(spark):
    listed = spark.createDataFrame([("b1", outside.FEDERAL, "118", "HR 0012"), ("b2", outside.FEDERAL, "118", "HB 2"), ("b3", "other", "118", "HR 1"), ("b4", outside.FEDERAL, "2023", "S 1")], "ocd_bill_id string, jurisdiction_id string, session string, identifier string")
    owned = spark.createDataFrame([("B", 118, "hr", "12")], "bill_id string, congress int, bill_type string, bill_number string")
    assert rows(outside.link_bills(listed, owned)) == [("b1", "118", "hr", "12", "B"), ("b4", "2023", "s", "1", None)]
    events = spark.createDataFrame([("e1", "us-2023-lower-5"), ("e2", "us-2023-lower-5"), ("e3", "us-2023-upper-7"), ("e4", "odd"), ("e5", None)], "ocd_vote_id string, identifier string")
    assert rows(outside.link_votes(events, spark.createDataFrame([("us-2023-upper-7",)], "external_id string"))) == [("us-2023-lower-5", 2, "e1", False), ("us-2023-upper-7", 1, "e3", True)]


def test_one_group_resolves_as_all_do(spark):
    ids = spark.createDataFrame([("p1", "bioguide", "A"), ("p1", "fec", "F"), ("p2", "lis", "L")], "person_id string, namespace string, external_id string")
    assert outside.resolve_one(ids, [("bioguide", "A")], "A", "n") == ("matched", "p1")
    assert outside.resolve_one(ids, [("bioguide", "Z")], "Z", "n") == ("new", "n")
    assert outside.resolve_one(ids, [("fec", "F"), ("lis", "L")], "Z", "n") == ("multiple_owners", None)
    assert outside.resolve_one(ids, [("fec", "F")], "Z", "n") == ("bioguide_mismatch", None)


def test_files_appear_whole(spark, tmp_path):
    df = spark.createDataFrame([(i, f"v{i}") for i in range(50)], "k int, v string").repartition(5)
    sinks.export_file(df, str(tmp_path / "a.jsonl"), ["k", "v"], ["k"], "jsonl")
    assert [json.loads(x)["k"] for x in open(tmp_path / "a.jsonl")] == list(range(50))
    sinks.export_file(df, str(tmp_path / "a.parquet"), ["k", "v"], ["k"], "parquet")
    assert [r.k for r in spark.read.parquet(str(tmp_path / "a.parquet")).collect()] == list(range(50))
    sinks.export_file(df.limit(0), str(tmp_path / "e.csv"), ["k", "v"], ["k"])
    assert open(tmp_path / "e.csv").read() == "k,v\n"
    for n in (1, 2):
        sinks.write_report(spark, str(tmp_path / "r.json"), {"n": n})
    assert json.load(open(tmp_path / "r.json")) == {"n": 2}
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["a.jsonl", "a.parquet", "e.csv", "r.json"]


def test_a_large_fingerprint_is_made_by_blocks(spark):
    df = spark.range(1000).select("id", (F.col("id") * 3).alias("v"))
    small = [reconcile.fingerprint(df.repartition(n), ["id", "v"], ["id"], "t", most_rows=100).first() for n in (1, 7)]
    assert small[0] == small[1] and small[0].n == 1000 and len(small[0].h) == 32
    assert reconcile.fingerprint(df.withColumn("v", F.when(F.col("id") == 999, 1).otherwise(F.col("v"))), ["id", "v"], ["id"], "t", most_rows=100).first().h != small[0].h
    assert reconcile.fingerprint(df, ["id", "v"], ["id"], "t").first().n == 1000 and reconcile.fingerprint(df.limit(0), ["id"], ["id"], "t").first()[:] == ("t", 0, None)
