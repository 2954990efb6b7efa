"""The operators of roll calls, bills, people, divisions, merges, health and registries over documents and tables made of
whole driver tables: an order stands for a roll call or a bill, its items for the votes or actions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civicloom.functions import scalars as S
from civicloom.operators import health, keyed, lifecycle, links, outside, pick, reconcile
from civicloom.plans import catalog, registry
from civicloom.session import table as T
from civicloom.sources import bills, people, rollcalls

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):  # noqa: ANN201
    """Registers a function under its name, with its SQL."""

    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _tag(name: str, *inside: Column | str) -> Column:
    return F.concat(F.lit(f"<{name}>"), *[F.lit(x) if isinstance(x, str) else F.coalesce(x.cast("string"), F.lit("")) for x in inside], F.lit(f"</{name}>"))


def _flag(f: str) -> Column:
    return F.count_if(F.col("l_returnflag") == f)


# Documents: the items of an order are few, so one document holds them all.


def _house_documents(s: SparkSession, d: str) -> DataFrame:
    word = F.when(F.col("l_returnflag") == "A", "Yea").when(F.col("l_returnflag") == "R", "No").otherwise("Present")
    vote = F.concat(F.lit('<recorded-vote><legislator name-id="'), F.concat(F.lit("A"), F.lpad(F.col("l_suppkey").cast("string"), 6, "0")), F.lit('" party="'), F.col("l_linestatus"), F.lit('" state="XA" role="legislator">'), F.col("l_partkey"), F.lit("</legislator>"), _tag("vote", word), F.lit("</recorded-vote>"))
    votes = T(s, d, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", vote.alias("v")))), lambda r: r["v"]), "").alias("votes"), _flag("A").alias("y"), _flag("R").alias("n"), _flag("N").alias("p"))
    o = T(s, d, "orders").join(votes, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    result = F.when(F.col("o_orderstatus") == "F", "Passed").when(F.col("o_orderstatus") == "O", "Failed").otherwise("Johnson")
    totals = _tag("totals-by-vote", _tag("yea-total", F.col("y")), _tag("nay-total", F.col("n")), _tag("present-total", F.col("p")))
    party = _tag("totals-by-party", _tag("party", F.col("o_orderpriority")), _tag("yea-total", F.col("y")))
    meta = _tag("vote-metadata", _tag("congress", 100 + F.col("o_orderkey") % 20), _tag("session", "1st"), _tag("rollcall-num", F.col("o_orderkey")), _tag("vote-result", result), _tag("action-date", F.date_format("o_orderdate", "d-MMM-yyyy")), _tag("vote-totals", party, totals))
    return o.select(F.col("o_orderkey").cast("string").alias("k"), F.concat(F.lit('<?xml version="1.0"?>'), _tag("rollcall-vote", meta, _tag("vote-data", F.coalesce("votes", F.lit(""))))).alias("xml"))


_HOUSE = """WITH v AS (SELECT l_orderkey, count(*) FILTER (WHERE l_returnflag = 'A') AS y, count(*) FILTER (WHERE l_returnflag = 'R') AS n, count(*) FILTER (WHERE l_returnflag = 'N') AS p FROM lineitem GROUP BY 1)"""


@query(f"""{_HOUSE} SELECT o_orderkey::int AS roll_number, (100 + o_orderkey % 20)::int AS congress, CASE o_orderstatus WHEN 'F' THEN 'pass' WHEN 'O' THEN 'fail' END AS result, o_orderdate::date AS action_date,
    y::int AS yea_total, n::int AS nay_total, p::int AS present_total, CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'result_not_normalized' ELSE '' END AS notes FROM orders LEFT JOIN v ON l_orderkey = o_orderkey""")
def house_rolls(s: SparkSession, d: str) -> DataFrame:
    """House files to rolls."""
    rolls = rollcalls.house_rolls(rollcalls.house_files(_house_documents(s, d), "k", "xml"))
    return rolls.select("roll_number", "congress", "result", "action_date", "yea_total", "nay_total", "present_total", F.array_join("notes", ",").alias("notes"))


@query("""SELECT l_orderkey::varchar AS key, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, '<recorded-vote><legislator name-id="A' || lpad(l_suppkey::varchar, 6, '0') || '" party="' || l_linestatus || '" state="XA" role="legislator">' || l_partkey || '</legislator><vote>')::int AS source_ordinal,
    'A' || lpad(l_suppkey::varchar, 6, '0') AS bioguide_id, l_partkey::varchar AS name, l_linestatus AS party, CASE l_returnflag WHEN 'A' THEN 'yes' WHEN 'R' THEN 'no' ELSE 'other' END AS position FROM lineitem""")
def house_member_votes(s: SparkSession, d: str) -> DataFrame:
    """House files to member votes, in file order."""
    return rollcalls.house_votes(rollcalls.house_files(_house_documents(s, d), "k", "xml")).select("key", "source_ordinal", "bioguide_id", "name", "party", "position")


@query(f"{_HOUSE} SELECT o_orderkey::varchar AS key, o_orderpriority AS party, y::int AS yea_total, NULL::int AS nay_total FROM orders LEFT JOIN v ON l_orderkey = o_orderkey")
def house_party_totals(s: SparkSession, d: str) -> DataFrame:
    """House files to totals by party."""
    return rollcalls.house_party_totals(rollcalls.house_files(_house_documents(s, d), "k", "xml")).select("key", "party", "yea_total", "nay_total")


def _senate_documents(s: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    member = F.concat(F.lit("<member>"), _tag("lis_member_id", F.concat(F.lit("S"), F.col("l_suppkey"))), _tag("vote_cast", F.when(F.col("l_returnflag") == "A", "Yea").when(F.col("l_returnflag") == "R", "Nay").otherwise("Not Voting")), F.lit("</member>"))
    votes = T(s, d, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", member.alias("v")))), lambda r: r["v"]), "").alias("votes"), _flag("A").alias("y"))
    o = T(s, d, "orders").join(votes, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    result = F.when(k % 5 == 0, "Motion Agreed to").when(k % 5 == 1, "Motion Not Agreed to").when(k % 5 == 2, "Nomination Confirmed").when(k % 5 == 3, "Cloture Rejected").otherwise("Not Guilty")
    document = F.when(k % 3 == 0, _tag("document", _tag("document_type", "H.R."), _tag("document_number", F.col("o_custkey")))).when(k % 3 == 1, _tag("document", _tag("document_congress", 90 + k % 7), _tag("document_type", "S.J.Res."), _tag("document_number", F.col("o_custkey")))).otherwise(_tag("document", _tag("document_type", "PN"), _tag("document_number", F.col("o_custkey"))))
    stamp = F.date_format(F.col("o_orderdate") + F.expr("make_dt_interval(0, cast(o_orderkey % 24 as int), cast(o_orderkey % 60 as int))"), "MMMM d, yyyy,  hh:mm a")
    body = _tag("roll_call_vote", _tag("congress", 100 + k % 20), _tag("session", 1 + k % 2), _tag("congress_year", F.year("o_orderdate")), _tag("vote_number", k), _tag("vote_date", stamp), _tag("vote_result", result), document, _tag("count", _tag("yeas", F.col("y")), "<present/>"), _tag("members", F.coalesce("votes", F.lit(""))))
    return o.select(k.cast("string").alias("k"), body.alias("xml"))


_SENATE = """SELECT o_orderkey::int AS roll_number, (100 + o_orderkey % 20)::int AS congress, CASE o_orderkey % 2 WHEN 0 THEN '1st' ELSE '2nd' END AS congress_session, CASE o_orderkey % 5 WHEN 0 THEN 'pass' WHEN 1 THEN 'fail' WHEN 2 THEN 'pass' WHEN 3 THEN 'fail' END AS result,
    o_orderdate::date AS action_date, lpad((o_orderkey % 24)::varchar, 2, '0') || ':' || lpad((o_orderkey % 60)::varchar, 2, '0') AS action_time_etz,
    CASE o_orderkey % 3 WHEN 0 THEN 100 + o_orderkey % 20 WHEN 1 THEN 90 + o_orderkey % 7 END::int AS link_congress, CASE o_orderkey % 3 WHEN 0 THEN 'hr' WHEN 1 THEN 'sjres' END AS link_bill_type, CASE WHEN o_orderkey % 3 < 2 THEN o_custkey::varchar END AS link_bill_number,
    (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'A')::int AS _y, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) AS _any FROM orders"""


@query(f"SELECT * EXCLUDE (_y, _any), CASE WHEN _any THEN _y ELSE 0 END::int AS yea_total, 0 AS present_total FROM ({_SENATE})")
def senate_rolls(s: SparkSession, d: str) -> DataFrame:
    """Senate files to rolls, with the bill each document names. (No hour of a change of clocks occurs in these days.)"""
    rolls = rollcalls.senate_rolls(rollcalls.senate_files(_senate_documents(s, d), "k", "xml"))
    return rolls.select("roll_number", "congress", "congress_session", "result", "action_date", "action_time_etz", "link_congress", "link_bill_type", "link_bill_number", "yea_total", "present_total")


@query("""SELECT l_orderkey::varchar AS key, 'S' || l_suppkey AS lis_member_id, CASE l_returnflag WHEN 'A' THEN 'yes' WHEN 'R' THEN 'no' ELSE 'not voting' END AS position FROM lineitem""")
def senate_member_votes(s: SparkSession, d: str) -> DataFrame:
    """Senate files to member votes."""
    return rollcalls.senate_votes(rollcalls.senate_files(_senate_documents(s, d), "k", "xml")).select("key", "lis_member_id", "position")


@query(f"SELECT roll_number, CASE WHEN link_bill_type = 'hr' AND c_custkey % 2 = 0 THEN c_name END AS bill_id FROM ({_SENATE}) LEFT JOIN customer ON c_custkey::varchar = link_bill_number AND link_congress = 100 + roll_number % 20")
def senate_bill_links(s: SparkSession, d: str) -> DataFrame:
    """Rolls linked to the bills there are: a bill of each even customer in every congress."""
    rolls = rollcalls.senate_rolls(rollcalls.senate_files(_senate_documents(s, d), "k", "xml"))
    c = T(s, d, "customer").filter("c_custkey % 2 = 0").select(F.col("c_name").alias("bill_id"), F.explode(F.sequence(F.lit(100), F.lit(119))).alias("congress"), F.lit("hr").alias("bill_type"), F.col("c_custkey").alias("bill_number"))
    return rollcalls.link_bills(rolls, c).select("roll_number", "bill_id")


def _official(s: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    return T(s, d, "orders").select(k.cast("string").alias("roll_call_id"), (F.col("o_custkey") % 50).cast("string").alias("congress"), F.when(k % 2 == 0, "house").otherwise("senate").alias("chamber"), F.when(k % 4 < 2, "1st").otherwise("2nd").alias("congress_session"), (k % 700).cast("int").alias("roll_number"))


def _outside_rolls(s: SparkSession, d: str) -> DataFrame:
    e = F.col("event_id")
    return T(s, d, "events").select("event_id", (e % 50).cast("string").alias("congress"), F.when(e % 3 == 0, "house").otherwise("senate").alias("chamber"), (1 + e % 3).cast("int").alias("session"), F.when(e % 7 > 0, (e * 13 % 700)).cast("int").alias("clerk_rollnumber"))


_LINKED = """WITH o AS (SELECT o_orderkey::varchar AS roll_call_id, (o_custkey % 50)::varchar AS congress, CASE WHEN o_orderkey % 2 = 0 THEN 'house' ELSE 'senate' END AS chamber, CASE WHEN o_orderkey % 4 < 2 THEN '1st' ELSE '2nd' END AS cs, (o_orderkey % 700)::int AS roll_number FROM orders),
    e AS (SELECT event_id, (event_id % 50)::varchar AS congress, CASE WHEN event_id % 3 = 0 THEN 'house' ELSE 'senate' END AS chamber, 1 + event_id % 3 AS session, CASE WHEN event_id % 7 > 0 THEN event_id * 13 % 700 END AS n FROM events),
    l AS (SELECT e.event_id, any_value(n) AS n, count(o.roll_call_id) AS matches, CASE WHEN count(o.roll_call_id) = 1 THEN min(o.roll_call_id) END AS roll_call_id FROM e LEFT JOIN o ON o.congress = e.congress AND o.chamber = e.chamber AND o.roll_number = e.n AND ((session = 1 AND cs = '1st') OR (session = 2 AND cs = '2nd')) GROUP BY 1)"""


@query(f"{_LINKED} SELECT event_id, matches, roll_call_id FROM l")
def outside_roll_links(s: SparkSession, d: str) -> DataFrame:
    """Rolls of another source linked where exactly one official roll matches."""
    return rollcalls.link_outside_rolls(_outside_rolls(s, d), _official(s, d)).select("event_id", "matches", "roll_call_id")


@query(f"""{_LINKED}, m AS (SELECT v.*, o.people, o.guides FROM voteview_member v LEFT JOIN (SELECT external_id, count(DISTINCT person_id) AS people, list(DISTINCT external_id) AS guides FROM person_identifier WHERE namespace = 'bioguide' GROUP BY 1) o ON o.external_id = upper(trim(v.bioguide_id)))
    SELECT (SELECT count(*) FROM m) AS members, (SELECT count(*) FROM m WHERE lower(chamber) IN ('house', 'senate') AND people IS NULL) AS unlinked_members, 0 AS unlinked_presidents,
    (SELECT count(*) FROM m WHERE people = 1 AND nullif(trim(bioguide_id), '') IS NOT NULL AND NOT list_contains(guides, bioguide_id)) AS bioguide_disagreements, (SELECT count(*) FROM organization) AS parties, count(*) AS roll_calls,
    count(*) FILTER (WHERE matches = 1) AS votes_linked, count(*) FILTER (WHERE matches > 1) AS votes_ambiguous, count(*) FILTER (WHERE matches = 0 AND n IS NULL) AS votes_no_clerk_number, count(*) FILTER (WHERE matches = 0 AND n IS NOT NULL) AS votes_unmatched FROM l""")
def link_summary(s: SparkSession, d: str) -> DataFrame:
    """Ten counters over linked members and rolls."""
    owners = T(s, d, "person_identifier").filter("namespace = 'bioguide'").groupBy(F.col("external_id").alias("_g")).agg(F.countDistinct("person_id").alias("n_people"), F.min("person_id").alias("person_id"), F.collect_set("external_id").alias("guides"))
    v = T(s, d, "voteview_member").select(F.lower("chamber").alias("chamber"), F.col("bioguide_id").alias("guide"), F.upper(F.trim("bioguide_id")).alias("_g"))
    return rollcalls.link_summary(v.join(owners, "_g", "left"), rollcalls.link_outside_rolls(_outside_rolls(s, d), _official(s, d)), T(s, d, "organization"))


# Bills -----------------------------------------------------------------------------------------------


def _bill_documents(s: SparkSession, d: str) -> DataFrame:
    action = F.concat(F.lit("<item>"), _tag("actionDate", F.date_format("l_shipdate", "yyyy-MM-dd")), _tag("text", F.col("l_partkey")), F.when(F.col("l_returnflag") != "N", _tag("type", F.col("l_returnflag"))).otherwise(""), F.lit("</item>"))
    acts = T(s, d, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", action.alias("v")))), lambda r: r["v"]), "").alias("acts"))
    k = F.col("o_orderkey")
    o = T(s, d, "orders").join(acts, k == F.col("l_orderkey"), "left")
    guide = F.concat(F.lit("C"), F.lpad(F.col("o_custkey").cast("string"), 6, "0"))
    named = F.when(k % 10 == 0, F.concat(_tag("billType", "HR"), _tag("billNumber", k))).otherwise(F.concat(_tag("type", "S"), _tag("number", k)))
    parts = [
        named, _tag("congress", 100 + k % 20), F.when(k % 4 > 0, _tag("title", "Act ", k)).otherwise(_tag("titles", _tag("item", _tag("title", "Listed ", k)))), _tag("introducedDate", F.date_format("o_orderdate", "yyyy-MM-dd")),
        _tag("sponsors", _tag("item", _tag("bioguideId", guide))), _tag("cosponsors", F.when(k % 2 == 0, _tag("item", _tag("bioguideId", guide), _tag("sponsorshipDate", "2001-02-03"))).otherwise(_tag("item", _tag("fullName", "none")))),
        _tag("policyArea", _tag("name", F.col("o_orderpriority"))), _tag("actions", F.coalesce("acts", F.lit(""))), F.when(k % 5 == 0, _tag("laws", _tag("item", _tag("type", "Public Law"), _tag("number", "1-", k)))).otherwise(F.lit("")),
        _tag("relatedBills", _tag("item", _tag("number", k + 1), _tag("congress", "110"), _tag("type", "HR")), _tag("item", _tag("number", "9"))),
    ]
    return o.select(F.concat(F.lit("in/BILLSTATUS-"), k.cast("string"), F.lit(".xml")).alias("k"), _tag("billStatus", _tag("bill", *parts)).alias("xml"))


_BILL = "(100 + o_orderkey % 20)::int AS congress, CASE WHEN o_orderkey % 10 = 0 THEN 'hr' ELSE 's' END AS bill_type, o_orderkey::varchar AS bill_number"


def _files(s: SparkSession, d: str) -> DataFrame:
    return bills.bill_files(_bill_documents(s, d), "k", "xml")


@query(f"SELECT {_BILL}, CASE WHEN o_orderkey % 4 > 0 THEN 'Act ' ELSE 'Listed ' END || o_orderkey AS title, o_orderdate::date AS introduced_date FROM orders")
def bill_rows(s: SparkSession, d: str) -> DataFrame:
    """Status documents to bills."""
    return bills.bills(_files(s, d)).select("congress", "bill_type", "bill_number", "title", "introduced_date")


@query(f"""SELECT {_BILL}, l_shipdate::date AS action_date, l_partkey::varchar AS description, CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS classification FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def bill_actions(s: SparkSession, d: str) -> DataFrame:
    """Status documents to actions."""
    return bills.bill_actions(_files(s, d)).select("congress", "bill_type", "bill_number", "action_date", "description", F.array_join("classification", ",").alias("classification"))


@query(f"""SELECT {_BILL}, 'sponsor' AS role, 'C' || lpad(o_custkey::varchar, 6, '0') AS bioguide_id, NULL::date AS sponsorship_date FROM orders UNION ALL
    SELECT {_BILL}, 'cosponsor', 'C' || lpad(o_custkey::varchar, 6, '0'), DATE '2001-02-03' FROM orders WHERE o_orderkey % 2 = 0""")
def bill_sponsorships(s: SparkSession, d: str) -> DataFrame:
    """Status documents to sponsorships."""
    return bills.bill_sponsorships(_files(s, d)).select("congress", "bill_type", "bill_number", "role", "bioguide_id", "sponsorship_date")


@query(f"""SELECT {_BILL}, 'identifier' AS part, congress || '-' || bill_type || '-' || bill_number AS value FROM (SELECT o_orderkey, {_BILL} FROM orders) UNION ALL SELECT {_BILL}, 'identifier', 'BILLSTATUS-' || o_orderkey FROM orders
    UNION ALL SELECT {_BILL}, 'subject', replace(lower(o_orderpriority), ' ', '-') FROM orders UNION ALL SELECT {_BILL}, 'law', '1-' || o_orderkey FROM orders WHERE o_orderkey % 5 = 0 UNION ALL SELECT {_BILL}, 'related', '110-hr-' || (o_orderkey + 1) FROM orders""")
def bill_collections(s: SparkSession, d: str) -> DataFrame:
    """Status documents to identifiers, subjects, laws and related bills."""
    f = _files(s, d)
    part = lambda df, name, value: df.select("congress", "bill_type", "bill_number", F.lit(name).alias("part"), value.alias("value"))
    related = F.concat_ws("-", F.col("related_congress").cast("string"), "related_bill_type", "related_bill_number")
    return part(bills.bill_identifiers(f), "identifier", F.col("external_id")).unionByName(part(bills.bill_subjects(f), "subject", F.col("external_id"))).unionByName(part(bills.bill_laws(f), "law", F.col("law_number"))).unionByName(part(bills.related_bills(f), "related", related))


# People ----------------------------------------------------------------------------------------------


def _people(s: SparkSession, d: str, guide: Column) -> DataFrame:
    """A record per guide, made of all its staged rows."""
    l = T(s, d, "legislator_stage").withColumn("bioguide", guide)  # noqa: E741
    day = lambda c: F.min(c).cast("date").cast("string")
    one = l.groupBy("bioguide").agg(F.min("full_name").alias("n"), F.min("family_name").alias("f"), day("birthday").alias("b"), F.max("chamber").alias("c"), day("first_term_start").alias("t"), F.array_sort(F.collect_set("external_id")).alias("x"))
    term = F.struct(F.col("c").alias("type"), F.col("t").alias("start"), F.lit("2031-01-03").alias("end"), F.lit("xa").alias("state"), F.lit(3).alias("district"), F.lit(1).alias("class"))
    body = F.struct(F.struct(F.col("bioguide"), F.col("x").alias("fec")).alias("id"), F.struct(F.col("n").alias("official_full"), F.col("f").alias("last")).alias("name"), F.struct(F.col("b").alias("birthday")).alias("bio"), F.array(term).alias("terms"), F.struct(F.col("bioguide").alias("twitter")).alias("social"))
    return people.people_records(one.select(F.to_json(body).alias("record")))


@query("SELECT DISTINCT upper(bioguide) AS bioguide, CASE WHEN bioguide IS NULL THEN 'no guide' WHEN NOT regexp_matches(upper(bioguide), '^[A-Z][0-9]{6}$') THEN 'malformed guide' END AS problem FROM legislator_stage")
def person_records(s: SparkSession, d: str) -> DataFrame:
    """Records of people with what is wrong with their guide. (Guides here have seven digits, so all are refused.)"""
    return _people(s, d, F.col("bioguide")).select("bioguide", "problem").distinct()


_LETTER = "substr(bioguide, 1, 1) || substr(bioguide, 3, 6)"


def _short_people(s: SparkSession, d: str) -> DataFrame:
    """Records under guides without one digit of the tables', so that they are well-formed."""
    return _people(s, d, F.concat(F.substring("bioguide", 1, 1), F.substring("bioguide", 3, 6)))


_SHORT = f"(SELECT {_LETTER} AS bioguide, full_name, family_name, birthday, chamber, first_term_start, external_id FROM legislator_stage)"


@query(f"SELECT bioguide, trim(min(full_name)) AS full_name, nullif(trim(min(family_name)), '') AS family_name, min(birthday)::date AS birthday FROM {_SHORT} GROUP BY 1")
def people_rows(s: SparkSession, d: str) -> DataFrame:
    """Records to people."""
    return people.people(_short_people(s, d)).select("bioguide", "full_name", "family_name", "birthday")


@query(f"SELECT DISTINCT bioguide, 'fec' AS namespace, trim(external_id) AS external_id FROM {_SHORT} WHERE nullif(trim(external_id), '') IS NOT NULL UNION SELECT DISTINCT bioguide, 'bioguide', bioguide FROM {_SHORT}")
def people_identifiers(s: SparkSession, d: str) -> DataFrame:
    """Records to identifiers, a list of them one by one."""
    return people.identifiers(_short_people(s, d))


@query(f"""SELECT bioguide, c AS chamber, t AS start_date, CASE c WHEN 'rep' THEN 'ocd-division/country:us/state:xa/cd:3' ELSE 'ocd-division/country:us/state:xa' END AS post_ocd, CASE c WHEN 'rep' THEN '3rd District' ELSE 'Class 1' END AS post_label
    FROM (SELECT bioguide, max(chamber) AS c, min(first_term_start)::date AS t FROM {_SHORT} GROUP BY 1) WHERE t IS NOT NULL""")
def people_terms(s: SparkSession, d: str) -> DataFrame:
    """Records to terms with their posts; a term without a start is refused."""
    return people.terms(_short_people(s, d))[0].select("bioguide", "chamber", "start_date", "post_ocd", "post_label")


@query(f"SELECT bioguide, 'no start date' AS problem FROM (SELECT bioguide, min(first_term_start) AS t FROM {_SHORT} GROUP BY 1) WHERE t IS NULL")
def refused_terms(s: SparkSession, d: str) -> DataFrame:
    """Terms a load refuses, with the reason."""
    return people.terms(_short_people(s, d))[1].select("bioguide", "problem")


@query(f"""WITH t AS (SELECT bioguide, max(chamber) AS c, min(first_term_start)::date AS t FROM {_SHORT} GROUP BY 1), i AS (SELECT DISTINCT person_id, substr(external_id, 1, 1) || substr(external_id, 3, 6) AS bioguide FROM person_identifier WHERE namespace = 'bioguide')
    SELECT DISTINCT person_id, CASE c WHEN 'rep' THEN 'H' ELSE 'S' END AS organization_id, CASE c WHEN 'rep' THEN 'P3' END AS post_id, t AS start_date FROM t JOIN i USING (bioguide) WHERE t IS NOT NULL""")
def term_memberships(s: SparkSession, d: str) -> DataFrame:
    """Terms to the memberships a load would write."""
    ids = T(s, d, "person_identifier").filter("namespace = 'bioguide'").select("person_id", "namespace", F.concat(F.substring("external_id", 1, 1), F.substring("external_id", 3, 6)).alias("external_id")).distinct()
    divisions = s.createDataFrame([("D3", "ocd-division/country:us/state:xa/cd:3")], "division_id string, ocd_division_id string")
    posts = s.createDataFrame([("P3", "D3", "H", "3rd District")], "post_id string, division_id string, organization_id string, label string")
    return people.term_memberships(people.terms(_short_people(s, d))[0], ids, divisions, posts, "H", "S", F.lit("a")).select("person_id", "organization_id", "post_id", "start_date")


def _committees(s: SparkSession, d: str) -> DataFrame:
    n = T(s, d, "nation").groupBy("n_regionkey").agg(F.collect_list(F.struct(F.col("n_name").alias("name"), F.col("n_nationkey").cast("string").alias("thomas_id"))).alias("subcommittees"))
    return T(s, d, "region").join(n, F.col("r_regionkey") == F.col("n_regionkey")).select(F.to_json(F.struct(F.lit("house").alias("type"), F.col("r_name").alias("name"), F.concat(F.lit("R"), "r_regionkey").alias("thomas_id"), "subcommittees")).alias("record"))


@query("""SELECT 'R' || r_regionkey AS thomas_key, NULL AS parent_thomas_key, 'committee' AS kind, r_name AS name FROM region WHERE r_regionkey IN (SELECT n_regionkey FROM nation) UNION ALL SELECT 'R' || n_regionkey || n_nationkey, 'R' || n_regionkey, 'subcommittee', n_name FROM nation""")
def committee_bodies(s: SparkSession, d: str) -> DataFrame:
    """Committee files to bodies: a region's nations as its subcommittees."""
    return people.committee_bodies(_committees(s, d), "current")[0].select("thomas_key", "parent_thomas_key", "kind", "name")


@query("""SELECT 'R' || n_regionkey || n_nationkey AS thomas_key, s_name AS bioguide, CASE WHEN s_suppkey % 3 = 0 THEN 'party is neither' END AS problem FROM supplier JOIN nation ON n_nationkey = s_nationkey""")
def committee_members(s: SparkSession, d: str) -> DataFrame:
    """Membership files to members, and those that are refused: suppliers of a nation. (A nation has a bounded number in each file.)"""
    sup = T(s, d, "supplier").join(T(s, d, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
    row = F.struct(F.col("s_name").alias("bioguide"), F.col("s_name").alias("name"), F.when(F.col("s_suppkey") % 3 == 0, "x").otherwise("majority").alias("party"), F.lit(1).alias("rank"))
    listed = sup.groupBy(F.concat(F.lit("R"), "n_regionkey", "n_nationkey").alias("_key")).agg(F.collect_list(row).alias("rows")).select(F.to_json(F.struct("_key", "rows")).alias("record"))
    good, bad = people.committee_members(listed, people.committee_bodies(_committees(s, d), "current")[0])
    return good.withColumn("problem", F.lit(None).cast("string")).unionByName(bad).select("thomas_key", "bioguide", "problem")


# Versions, divisions, merges ---------------------------------------------------------------------------

_ARTIFACTS = """a AS (SELECT o_custkey AS k, o_orderkey AS v, CASE o_orderstatus WHEN 'F' THEN 'downloaded' WHEN 'O' THEN 'planned' ELSE 'failed' END AS status, CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority END AS sum FROM orders),
    l AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY k ORDER BY v DESC) = 1),
    n AS (SELECT c_custkey + (c_custkey % 11) * 1000000 * (c_custkey % 11 > 9)::int AS k, CASE WHEN c_nationkey % 2 = 0 THEN 'loaded' ELSE 'failed' END AS status, CASE WHEN c_nationkey % 3 > 0 THEN '1-URGENT' END AS sum FROM customer),
    r AS (SELECT n.k, l.v AS latest_version, CASE WHEN l.v IS NULL THEN 'append' WHEN l.sum IS NULL AND l.status IN ('planned', 'downloading', 'failed') THEN 'promote' WHEN n.sum IS NOT DISTINCT FROM l.sum AND n.status NOT IN ('planned', 'downloading', 'failed') THEN 'retry' ELSE 'append' END AS action FROM n LEFT JOIN l USING (k))"""


def _artifacts(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    o, k = F.col("o_orderstatus"), F.col("c_custkey")
    have = T(s, d, "orders").select(F.lit("d").alias("dataset_id"), F.col("o_custkey").cast("string").alias("artifact_key"), F.col("o_orderkey").alias("artifact_version"), F.when(o == "F", "downloaded").when(o == "O", "planned").otherwise("failed").alias("status"), F.when(o != "O", F.col("o_orderpriority")).alias("checksum_sha256"), F.lit("/p").alias("local_path"), F.lit("u").alias("remote_url"))
    key = k + (k % 11) * 1000000 * (k % 11 > 9).cast("int")
    come = T(s, d, "customer").select(F.lit("d").alias("dataset_id"), key.cast("string").alias("artifact_key"), F.when(F.col("c_nationkey") % 2 == 0, "loaded").otherwise("failed").alias("status"), F.when(F.col("c_nationkey") % 3 > 0, "1-URGENT").alias("checksum_sha256"), F.lit("/q").alias("local_path"), F.lit("v").alias("remote_url"))
    return have, come


@query(f"WITH {_ARTIFACTS} SELECT k::varchar AS artifact_key, latest_version, action FROM r")
def register_actions(s: SparkSession, d: str) -> DataFrame:
    """What arriving artifacts do: append, promote or retry."""
    have, come = _artifacts(s, d)
    return lifecycle.register_action(come, have).select("artifact_key", "latest_version", "action")


@query(f"""WITH {_ARTIFACTS} SELECT a.k::varchar AS artifact_key, a.v AS artifact_version, CASE WHEN r.action IN ('promote', 'retry') THEN n.status ELSE a.status END AS status, CASE WHEN r.action = 'promote' THEN n.sum ELSE a.sum END AS checksum_sha256, CASE WHEN r.action = 'promote' THEN '/q' ELSE '/p' END AS local_path
    FROM a LEFT JOIN r ON r.k = a.k AND r.latest_version = a.v AND r.action <> 'append' LEFT JOIN n ON n.k = r.k UNION ALL SELECT r.k::varchar, coalesce(latest_version, 0) + 1, n.status, n.sum, '/q' FROM r JOIN n USING (k) WHERE action = 'append'""")
def registered_artifacts(s: SparkSession, d: str) -> DataFrame:
    """The artifacts after a registration."""
    have, come = _artifacts(s, d)
    return lifecycle.register_artifacts(have, come).select("artifact_key", "artifact_version", "status", "checksum_sha256", "local_path")


_GEO = "g AS (SELECT geography_id, CASE geography_type WHEN 'county' THEN 'sldl' ELSE geography_type END AS kind, geoid, name, state_fips FROM geography WHERE deleted_at IS NULL), st AS (SELECT DISTINCT lower(raw->>'STUSPS') AS postal, state_fips AS fips FROM tiger_feature WHERE layer = 'state')"


def _districts(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    g = T(s, d, "geography").filter("deleted_at IS NULL").select("geography_id", F.when(F.col("geography_type") == "county", "sldl").otherwise(F.col("geography_type")).alias("geography_type"), "geoid", "name")
    states = T(s, d, "tiger_feature").filter("layer = 'state'").select(F.lower(F.get_json_object("raw", "$.STUSPS")).alias("postal"), F.col("state_fips").alias("fips")).distinct()
    boundary = g.select(F.concat(F.lit("b"), "geography_id").alias("boundary_id"), "geography_id", F.when(F.substring("geoid", -1, 1) == "5", "2022").otherwise("2024").alias("boundary_vintage"))
    return g, states, boundary


@query(f"""WITH {_GEO} SELECT 'ocd-division/country:us/state:' || postal || '/sldl:' || substr(g.geoid, 3)::int AS ocd_division_id, coalesce(n.name, upper(postal)) || ' ' || g.name AS label, g.geoid FROM g JOIN st ON fips = substr(g.geoid, 1, 2) LEFT JOIN g n ON n.kind = 'state' AND n.geoid = fips
    WHERE g.kind = 'sldl' AND substr(g.geoid, 3) ~ '^[0-9]{{3}}$' AND NOT g.geoid LIKE '%5'""")
def seeded_divisions(s: SparkSession, d: str) -> DataFrame:
    """Divisions seeded from a vintage's districts (counties stand for them)."""
    g, states, boundary = _districts(s, d)
    return lifecycle.seeded_divisions(g, boundary, states, "2024").select("ocd_division_id", "label", "geoid")


@query(f"""WITH {_GEO} SELECT g.geography_id AS division_id, kind AS geography_type, CASE WHEN g.geoid LIKE '%5' THEN '2022' ELSE '2024' END AS boundary_vintage FROM g WHERE kind <> 'congressional_district' OR g.geoid LIKE '%5'""")
def wrong_vintage_links(s: SparkSession, d: str) -> DataFrame:
    """Links of one congress to boundaries of another vintage or kind."""
    g, _, boundary = _districts(s, d)
    held = boundary.select(F.col("geography_id").alias("division_id"), "boundary_id", F.lit(119).alias("congress"), F.lit(None).cast("string").alias("legislative_year"))
    return lifecycle.wrong_vintage_links(held, boundary, g, "2024", 119, "2024").select("division_id", "geography_type", "boundary_vintage")


@query(f"""WITH {_GEO}, c AS (SELECT geography_id, fips || CASE WHEN kind = 'congressional_district' AND geography_id < 'n' THEN substr(geoid, 3, 2) WHEN kind = 'state' THEN '98' ELSE lpad(ltrim(substr(geoid, 3), '0'), 3, '0') END AS geoid, CASE kind WHEN 'sldl' THEN 'sldl' ELSE 'congressional_district' END AS kind,
      CASE kind WHEN 'state' THEN 'delegate_district' ELSE 'legal_boundary' END AS relationship_kind FROM g JOIN st ON fips = substr(geoid, 1, 2) WHERE kind IN ('state', 'sldl', 'congressional_district') AND NOT (kind = 'congressional_district' AND geography_id >= 'n') AND NOT (kind = 'sldl' AND ltrim(substr(geoid, 3), '0') = ''))
    SELECT c.geography_id AS division_id, b.geoid AS boundary_id, relationship_kind FROM c JOIN (SELECT DISTINCT kind, geoid FROM g UNION SELECT 'congressional_district', fips || '98' FROM st) b ON b.kind = c.kind AND b.geoid = c.geoid""")
def division_branches(s: SparkSession, d: str) -> DataFrame:
    """All three shapes of division ids linked by code: congressional districts, delegates (98) and chambers' districts."""
    g, states, _ = _districts(s, d)
    home = g.join(states, F.substring("geoid", 1, 2) == F.col("fips"))
    number = F.regexp_replace(F.expr("substr(geoid, 3)"), "^0+(?=.)", "")
    seat = F.when(F.col("geography_type") == "congressional_district", F.concat(F.lit("/cd:"), F.when(number == "0", "at-large").otherwise(number))).when(F.col("geography_type") == "sldl", F.concat(F.lit("/sldl:"), number)).otherwise("")
    ocd = F.concat(F.lit("ocd-division/country:us/"), F.when(F.col("geography_type") == "state", "territory").otherwise("state"), F.lit(":"), "postal", seat)
    kept = home.filter("geography_type IN ('state', 'sldl') OR (geography_type = 'congressional_district' AND geography_id < 'n')").filter(~((F.col("geography_type") == "sldl") & (number == "0")) & ~((F.col("geography_type") == "sldl") & (number == "")))
    boundaries = g.select(F.col("geoid").alias("boundary_id"), "geography_type", "geoid").unionByName(states.select(F.concat("fips", F.lit("98")).alias("boundary_id"), F.lit("congressional_district").alias("geography_type"), F.concat("fips", F.lit("98")).alias("geoid"))).distinct()
    return links.link_divisions(kept.select(F.col("geography_id").alias("division_id"), ocd.alias("ocd_division_id")), states, boundaries)


@query("""SELECT count(*) AS relationship_staged, count(*) FILTER (WHERE l_returnflag = 'N' OR l_discount = 0) AS relationship_blank_side, (SELECT count(*) FROM orders) AS block_staged,
    (SELECT count(*) FROM lineitem WHERE l_returnflag <> 'N' AND l_discount <> 0) + (SELECT count(*) FROM orders) AS stored, 0 AS weighted_relationship, (SELECT count(*) FROM orders WHERE o_orderstatus = 'P') AS bad_assignment, (SELECT count(*) FROM orders WHERE o_orderstatus = 'P') = 0 AS holds FROM lineitem""")
def crosswalk_reconciliation(s: SparkSession, d: str) -> DataFrame:
    """Staged less blank is stored, and every stored row is as it should be."""
    li, o, art = T(s, d, "lineitem"), T(s, d, "orders"), F.lit("a").alias("artifact_id")
    rel = li.select(art, F.when(F.col("l_returnflag") != "N", F.col("l_suppkey")).alias("district_geoid"), F.when(F.col("l_discount") != 0, F.col("l_partkey")).alias("overlap_geoid"))
    stored = rel.filter("district_geoid IS NOT NULL AND overlap_geoid IS NOT NULL").select(F.lit("a").alias("source_artifact_id"), F.lit("relationship").alias("method"), F.lit("none").alias("weight_type"), F.lit(None).cast("double").alias("weight"), F.lit(None).cast("string").alias("quality_flag"))
    blocks = o.select(F.lit("a").alias("source_artifact_id"), F.lit("block_assignment").alias("method"), F.lit("assignment").alias("weight_type"), F.when(F.col("o_orderstatus") == "P", 0.5).otherwise(1.0).alias("weight"), F.lit("whole_block_tabulation").alias("quality_flag"))
    return lifecycle.crosswalk_reconciliation(rel, o.select(art), stored.unionByName(blocks), "a")


def _merge(s: SparkSession, d: str) -> lifecycle.Merge:
    sup = T(s, d, "supplier")
    k = F.col("s_suppkey")
    pairs = sup.filter("s_suppkey % 10 = 1").select(k.cast("string").alias("merge_id"), (k - 1).alias("survivor"), k.alias("duplicate"))
    ids = sup.filter("s_suppkey % 4 < 2").select(k.alias("person_id"), F.lit("bioguide").alias("namespace"), F.concat(F.lit("n"), "s_nationkey").alias("external_id"))
    votes = T(s, d, "lineitem").select("l_orderkey", F.col("l_suppkey").alias("person_id"), "l_linenumber")
    return lifecycle.merge_entities(pairs, ids, {"votes": (votes, ["l_orderkey", "person_id", "l_linenumber"])})


_MERGE = """p AS (SELECT s_suppkey AS d, s_suppkey - 1 AS s FROM supplier WHERE s_suppkey % 10 = 1), i AS (SELECT s_suppkey AS e, 'n' || s_nationkey AS x FROM supplier WHERE s_suppkey % 4 < 2),
    bad AS (SELECT p.d FROM p JOIN i a ON a.e = p.d JOIN i b ON b.e = p.s WHERE a.x <> b.x), ok AS (SELECT * FROM p WHERE d NOT IN (SELECT d FROM bad))"""


@query(f"WITH {_MERGE} SELECT d::varchar AS merge_id, 'two primary ids' AS reason FROM bad")
def merge_refusals(s: SparkSession, d: str) -> DataFrame:
    """Merges refused because both sides have a primary id."""
    return _merge(s, d).refused


@query(f"WITH {_MERGE} SELECT d::varchar AS merge_id, s AS survivor, d AS duplicate, (SELECT count(*) FROM lineitem WHERE l_suppkey = d) AS votes, (SELECT count(*) FROM i WHERE e = d) AS identifiers FROM ok")
def merge_audit(s: SparkSession, d: str) -> DataFrame:
    """One row per merge, with how many rows moved."""
    return _merge(s, d).audit


@query(f"WITH {_MERGE} SELECT l_orderkey, coalesce(ok.s, l_suppkey) AS person_id, l_linenumber FROM lineitem LEFT JOIN ok ON d = l_suppkey QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber, coalesce(ok.s, l_suppkey) ORDER BY ok.s IS NOT NULL, l_suppkey) = 1 OR ok.s IS NULL")
def merged_votes(s: SparkSession, d: str) -> DataFrame:
    """A referring table after all merges."""
    return _merge(s, d).tables["votes"]


# Health and registry -----------------------------------------------------------------------------------


@query("""WITH e AS (SELECT c_nationkey AS part, c_mktsegment AS kind, CASE WHEN c_mktsegment <> 'BUILDING' OR c_nationkey % 2 = 0 THEN count(*) * 10 END AS expected FROM customer GROUP BY 1, 2), l AS (SELECT c_nationkey AS part, c_mktsegment AS kind, count(*) AS loaded FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
    c AS (SELECT part, kind, expected, coalesce(loaded, 0) AS loaded FROM e LEFT JOIN l USING (part, kind)), t AS (SELECT part, NULL AS kind, CASE WHEN count(*) FILTER (WHERE expected IS NULL) = 0 THEN sum(expected) END AS expected, sum(loaded) AS loaded, bool_or(coalesce(loaded < expected, false)) AS gap FROM c GROUP BY 1)
    SELECT part, kind, expected::bigint AS expected, loaded::bigint AS loaded, greatest(expected - loaded, 0)::bigint AS missing, greatest(loaded - expected, 0)::bigint AS surplus, CASE WHEN expected IS NULL THEN 'unknown' WHEN loaded >= expected THEN 'complete' ELSE 'incomplete' END AS status, 'cell' AS level FROM (SELECT *, false AS gap FROM c) WHERE expected IS NOT NULL
    UNION ALL SELECT part, kind, NULL, loaded::bigint, NULL, NULL, 'unknown', 'cell' FROM c WHERE expected IS NULL
    UNION ALL SELECT part, kind, expected::bigint, loaded::bigint, CASE WHEN expected IS NOT NULL THEN greatest(expected - loaded, 0) END::bigint, CASE WHEN expected IS NOT NULL THEN greatest(loaded - expected, 0) END::bigint, CASE WHEN gap THEN 'incomplete' WHEN expected IS NULL THEN 'unknown' WHEN loaded >= expected THEN 'complete' ELSE 'incomplete' END, 'total' FROM t""")
def coverage_report(s: SparkSession, d: str) -> DataFrame:
    """Expected against loaded per cell, with totals in which no surplus hides a gap."""
    c = T(s, d, "customer")
    odd = (F.first("c_mktsegment") != "BUILDING") | (F.first("c_nationkey") % 2 == 0)
    e = c.groupBy(F.col("c_nationkey").alias("part"), F.col("c_mktsegment").alias("kind")).agg(F.when(odd, F.count("*") * 10).alias("expected"))
    l = T(s, d, "orders").join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_nationkey").alias("part"), F.col("c_mktsegment").alias("kind")).agg(F.count("*").alias("loaded"))  # noqa: E741
    return health.coverage_report(e, l, ["part", "kind"], ["part"])


@query("""WITH c AS (SELECT n, make_date(1787 + 2 * n, 1, 3) AS a, make_date(1789 + 2 * n, 1, 3) AS b FROM range(90, 121) r(n)) SELECT n::int AS period, count(DISTINCT person_id) AS n FROM membership JOIN c ON start_date < b AND coalesce(end_date, DATE '9999-12-31') > a GROUP BY 1""")
def people_per_congress(s: SparkSession, d: str) -> DataFrame:
    """Distinct people whose terms overlap each congress."""
    n = F.col("id")
    periods = s.range(90, 121).select(n.cast("int").alias("period"), F.make_date((1787 + 2 * n).cast("int"), F.lit(1), F.lit(3)).alias("first_day"), F.make_date((1789 + 2 * n).cast("int"), F.lit(1), F.lit(3)).alias("after"))
    m = T(s, d, "membership").select("person_id", F.col("start_date").cast("date").alias("start_date"), F.col("end_date").cast("date").alias("end_date"))
    return health.period_counts(m, "person_id", "start_date", "end_date", periods)


@query("""SELECT '{"people":' || (SELECT count(*) FROM person) || ',"unlinked":' || (SELECT count(*) FROM membership WHERE organization_id IS NULL) || ',"latest_runs":[' || string_agg('{"event_id":' || event_id || ',"event_type":"' || event_type || '"}', ',' ORDER BY event_id DESC) || ']}' AS health
    FROM (SELECT event_id, event_type FROM events ORDER BY event_id DESC LIMIT 10)""")
def congress_health(s: SparkSession, d: str) -> DataFrame:
    """Counters and the ten newest runs as one JSON object (the ten are the feature)."""
    counters = {"people": (T(s, d, "person"), F.count("*")), "unlinked": (T(s, d, "membership"), F.count_if(F.col("organization_id").isNull()))}
    return health.health_json(counters, T(s, d, "events").select("event_id", "event_type"), "event_id", 10)


@query("""SELECT coalesce(sum(reference_count), 0)::bigint AS n FROM identity_exception e WHERE NOT EXISTS (SELECT 1 FROM person_identifier p WHERE p.namespace = e.namespace AND p.external_id = e.external_id)""")
def unresolved_references(s: SparkSession, d: str) -> DataFrame:
    """References of exceptions nobody holds by now."""
    return health.unresolved_references(T(s, d, "identity_exception"), T(s, d, "person_identifier"))


@query("SELECT 'roles' AS table_name, role AS part, count(*) AS n FROM membership GROUP BY 2 UNION ALL SELECT 'releases', release_year || '/' || measure, count(*) FROM acs_bulk_estimate GROUP BY 2 UNION ALL SELECT 'people', '', count(*) FROM person")
def loaded_counts(s: SparkSession, d: str) -> DataFrame:
    """Rows of several tables by their own parts."""
    return health.loaded_counts({"roles": (T(s, d, "membership"), ["role"]), "releases": (T(s, d, "acs_bulk_estimate"), ["release_year", "measure"]), "people": (T(s, d, "person"), [])})


@query("""WITH i AS (SELECT user_id AS family, CASE event_type WHEN 'error' THEN 'failed' WHEN 'click' THEN 'attention' ELSE 'healthy' END AS status FROM events) SELECT n::bigint AS family, CASE WHEN count(status) = 0 THEN 'unknown' WHEN bool_or(status = 'failed') THEN 'failed' WHEN bool_or(status = 'attention') THEN 'attention' ELSE 'healthy' END AS status, count(status) AS n
    FROM range(0, 400) r(n) LEFT JOIN i ON family = n GROUP BY 1""")
def worst_status(s: SparkSession, d: str) -> DataFrame:
    """The worst status of each family; one without items is unknown."""
    e = F.col("event_type")
    items = T(s, d, "events").select(F.col("user_id").cast("bigint").alias("family"), F.when(e == "error", "failed").when(e == "click", "attention").otherwise("healthy").alias("status"))
    return health.worst_status(items, "family", s.range(400).select(F.col("id").alias("family")))


@query("""WITH t AS (SELECT source_artifact_id AS artifact_id, count(*) AS s FROM acs_bulk_estimate GROUP BY 1), p AS (SELECT source_artifact_id AS artifact_id, count(*) AS p FROM membership GROUP BY 1),
    a AS (SELECT DISTINCT artifact_id FROM (SELECT artifact_id FROM t UNION SELECT artifact_id FROM p)) SELECT substr(artifact_id, 1, 1) AS product, count(*) AS n_artifacts, coalesce(sum(s), 0)::bigint AS n_staged, coalesce(sum(p), 0)::bigint AS n_published, bool_and(coalesce(s % 2 = 0, false)) AS reconciles FROM a LEFT JOIN t USING (artifact_id) LEFT JOIN p USING (artifact_id) GROUP BY 1""")
def source_status(s: SparkSession, d: str) -> DataFrame:
    """Artifacts with what was staged and published of them; a run reconciles if its rows add up."""
    staged = T(s, d, "acs_bulk_estimate").select(F.col("source_artifact_id").alias("artifact_id"))
    published = T(s, d, "membership").select("source_artifact_id")
    ids = staged.union(published).distinct()
    n = staged.groupBy("artifact_id").agg(F.count("*").alias("n"))
    targets = n.select("artifact_id", F.lit("r").alias("run_id"), F.lit(1).alias("recorded_at"), F.col("n").alias("rows_parsed"), (F.col("n") - F.col("n") % 2).alias("rows_inserted"), F.lit(0).alias("rows_existing"), F.lit(0).alias("rows_rejected"))
    artifacts = ids.select("artifact_id", F.substring("artifact_id", 1, 1).alias("product"), F.lit(1).cast("bigint").alias("bytes_downloaded"))
    return health.source_status(artifacts, staged, published, targets, ["product"]).select("product", "n_artifacts", "n_staged", "n_published", "reconciles")


@query("""SELECT r_regionkey::varchar AS provider_id, r_name AS name, n_nationkey::varchar AS dataset_id, n_name AS title, coalesce(r, 0) AS resources, s AS last_snapshot, CASE WHEN coalesce(r, 0) > 0 THEN 'ready' ELSE 'pending_adapter' END AS state FROM nation JOIN region ON r_regionkey = n_regionkey
    LEFT JOIN (SELECT s_nationkey AS k, count(DISTINCT s_suppkey) AS r FROM supplier GROUP BY 1) a ON a.k = n_nationkey LEFT JOIN (SELECT c_nationkey AS k, max(c_custkey) AS s FROM customer GROUP BY 1) b ON b.k = n_nationkey""")
def registry_status(s: SparkSession, d: str) -> DataFrame:
    """Providers' datasets with resources and snapshots, without fan-out."""
    text = lambda c, n: F.col(c).cast("string").alias(n)
    providers = T(s, d, "region").select(text("r_regionkey", "provider_id"), F.col("r_name").alias("name"))
    datasets = T(s, d, "nation").select(text("n_nationkey", "dataset_id"), text("n_regionkey", "provider_id"), F.col("n_name").alias("title"))
    return registry.registry_status(providers, datasets, T(s, d, "supplier").select(text("s_nationkey", "dataset_id"), F.col("s_suppkey").alias("resource_id")), T(s, d, "customer").select(text("c_nationkey", "dataset_id"), F.col("c_custkey").alias("captured_at")))


@query("""SELECT c_nationkey AS g, count(*) FILTER (WHERE a) AS n_official, count(*) FILTER (WHERE b) AS n_held, count(*) FILTER (WHERE a AND b) AS n_match, count(*) FILTER (WHERE a AND NOT b) AS n_missing, count(*) FILTER (WHERE b AND NOT a) AS n_extra, count(*) FILTER (WHERE a <> b) = 0 AS matches
    FROM (SELECT c_nationkey, c_custkey % 3 > 0 AS a, c_custkey % 5 > 0 AS b FROM customer) WHERE a OR b GROUP BY 1""")
def listing_compare(s: SparkSession, d: str) -> DataFrame:
    """A publisher's listing against what is held."""
    c = T(s, d, "customer").select(F.col("c_nationkey").alias("g"), "c_custkey")
    return health.listing_compare(c.filter("c_custkey % 3 > 0"), c.filter("c_custkey % 5 > 0"), ["g"], "c_custkey")


@query("""SELECT c_custkey AS k, CASE WHEN c_custkey % 5 = 0 THEN 'new' ELSE 'changed' END AS reason FROM customer WHERE c_custkey % 5 = 0 OR c_custkey % 7 = 0""")
def pending_files(s: SparkSession, d: str) -> DataFrame:
    """Listed files that are new or changed."""
    k = F.col("c_custkey")
    c = T(s, d, "customer")
    return health.pending_files(c.select(k.alias("k"), F.lit(1).alias("stamp")), c.filter("c_custkey % 5 > 0").select(k.alias("k"), F.when(k % 7 == 0, 0).otherwise(1).alias("stamp")), "k", "stamp").select("k", "reason")


@query("""SELECT c_nationkey AS g, count(*) FILTER (WHERE a) AS n_source, count(*) FILTER (WHERE b) AS n_canonical, count(*) FILTER (WHERE a AND NOT b) AS n_new, count(*) FILTER (WHERE a AND b AND c_custkey % 7 = 0) AS n_changed, count(*) FILTER (WHERE b AND NOT a) AS n_gone
    FROM (SELECT *, c_custkey % 3 > 0 AS a, c_custkey % 5 > 0 AS b FROM customer) WHERE a OR b GROUP BY 1""")
def refresh_preview(s: SparkSession, d: str) -> DataFrame:
    """What a refresh would do."""
    k = F.col("c_custkey")
    c = T(s, d, "customer").select(k.alias("k"), F.col("c_nationkey").alias("g"), F.lit(1).alias("v"))
    return health.refresh_preview(c.filter("k % 3 > 0"), c.filter("k % 5 > 0").withColumn("v", F.when(F.col("k") % 7 == 0, 0).otherwise(1)), ["k"], "v", "g")


@query("""SELECT p_brand || '_' || m || lpad(p_partkey::varchar, 3, '0') AS field_id, p_type AS label, p_name || ' -- ' || p_brand AS description FROM part, (VALUES ('E'), ('M')) t(m) WHERE p_partkey % 7 > 0""")
def shell_fields(s: SparkSession, d: str) -> DataFrame:
    """Two fields per line of a table-shell file."""
    p = T(s, d, "part")
    shells = p.select(F.when(F.col("p_partkey") % 7 > 0, F.concat("p_brand", F.lit("_"), F.lpad(F.col("p_partkey").cast("string"), 3, "0"))).otherwise(F.col("p_brand")).alias("unique_id"), F.col("p_type").alias("label"), F.col("p_name").alias("title"), F.col("p_brand").alias("universe"), F.lit("int").alias("type"))
    return registry.shell_fields(shells, "acs", "2024-01-01").select("field_id", "label", "description")


@query("""SELECT k FROM (SELECT c_custkey AS k FROM customer WHERE c_custkey % 2 = 0) WHERE k % 3 > 0 UNION ALL SELECT c_custkey FROM customer WHERE c_custkey % 2 = 1 AND c_custkey % 3 = 0""")
def basket_toggle(s: SparkSession, d: str) -> DataFrame:
    """A basket after its resources were toggled."""
    c = T(s, d, "customer").select(F.lit("b").alias("basket_id"), F.col("c_custkey").alias("resource_id"))
    return registry.toggle(c.filter("resource_id % 2 = 0"), c.filter("resource_id % 3 = 0")).select(F.col("resource_id").alias("k"))


# The outside publisher -----------------------------------------------------------------------------------


def _publisher(s: SparkSession, d: str) -> DataFrame:
    return T(s, d, "legislator_stage").select(F.col("new_person_id").alias("ocd_person_id"), F.col("namespace").alias("scheme"), F.col("external_id").alias("identifier"))


@query("""WITH r AS (SELECT DISTINCT new_person_id AS o, trim(external_id) AS g FROM legislator_stage WHERE namespace = 'bioguide' AND trim(external_id) <> ''), a AS (SELECT o, count(*) AS n FROM r GROUP BY 1), b AS (SELECT g, count(*) AS n FROM r GROUP BY 1), w AS (SELECT external_id AS g, min(person_id) AS p FROM person_identifier WHERE namespace = 'bioguide' GROUP BY 1)
    SELECT o AS ocd_person_id, g AS guide, CASE WHEN a.n = 1 AND b.n = 1 THEN p END AS person_id, CASE WHEN a.n > 1 THEN 'person_has_multiple_bioguide_ids' WHEN b.n > 1 THEN 'bioguide_claimed_by_multiple_people' END AS conflict FROM r JOIN a USING (o) JOIN b USING (g) LEFT JOIN w USING (g)""")
def outside_people(s: SparkSession, d: str) -> DataFrame:
    """A publisher's people linked by guide alone."""
    return outside.link_people(_publisher(s, d), T(s, d, "person_identifier"))


@query("""WITH k AS (SELECT new_person_id AS o, 'identifier' AS source_table, trim(namespace) AS scheme, trim(external_id) AS value FROM legislator_stage WHERE trim(namespace) <> '' AND trim(external_id) <> '' UNION ALL SELECT bioguide, 'office', 'district:' || 'voice', trim(phone) FROM profile_office WHERE trim(phone) <> ''
      UNION ALL SELECT bioguide, 'office', 'district:' || 'fax', trim(fax) FROM profile_office WHERE trim(fax) <> '' UNION ALL SELECT bioguide, 'office', 'district:address', trim(address) FROM profile_office WHERE trim(address) <> '' UNION ALL SELECT bioguide, 'office', 'district:name', trim(office_key) FROM profile_office WHERE trim(office_key) <> '')
    SELECT o AS ocd_person_id, source_table, scheme, value, count(DISTINCT o) OVER (PARTITION BY scheme, value) > 1 AS shared, source_table = 'identifier' AND scheme = 'bioguide' AS joins_people FROM k""")
def outside_contacts(s: SparkSession, d: str) -> DataFrame:
    """Contacts of two shapes, kept, with whether another person has the same."""
    offices = T(s, d, "profile_office").select(F.col("bioguide").alias("ocd_person_id"), F.lit("district").alias("classification"), "address", F.col("phone").alias("voice"), "fax", F.col("office_key").alias("name"))
    kept = outside.retained_contacts(outside.link_people(_publisher(s, d), T(s, d, "person_identifier")), _publisher(s, d), offices=offices)
    return kept.select("ocd_person_id", "source_table", "scheme", "value", "shared", "joins_people")


@query("""SELECT 'us-' || (2000 + event_id % 3) || '-lower-' || (user_id % 50) AS external_id, count(*) AS n_events, min(event_id::varchar) AS first_event, (user_id % 50) % 2 = 0 AS matched FROM events WHERE event_type <> 'error' GROUP BY event_id % 3, user_id % 50""")
def outside_votes(s: SparkSession, d: str) -> DataFrame:
    """A publisher's vote events under official roll keys."""
    e, u = F.col("event_id"), F.col("user_id") % 50
    key = F.concat(F.lit("us-"), (2000 + e % 3).cast("string"), F.lit("-lower-"), u.cast("string"))
    events = T(s, d, "events").select(e.cast("string").alias("ocd_vote_id"), F.when(F.col("event_type") != "error", key).otherwise("odd").alias("identifier"))
    official = s.range(150).select(F.concat(F.lit("us-"), (2000 + F.col("id") % 3).cast("string"), F.lit("-lower-"), (F.col("id") / 3).cast("int").cast("string")).alias("external_id"), (F.col("id") / 3).cast("int").alias("u")).filter("u % 2 = 0")
    return outside.link_votes(events, official)


@query("""SELECT p_partkey::varchar AS ocd_bill_id, (100 + p_size)::varchar AS congress, 'hr' AS bill_type, (p_partkey % 40)::varchar AS bill_number, CASE WHEN p_partkey % 40 < 20 THEN 'B' || (100 + p_size) || '-' || (p_partkey % 40) END AS bill_id FROM part WHERE p_partkey % 3 = 0""")
def outside_bills(s: SparkSession, d: str) -> DataFrame:
    """A publisher's bills linked by federal key; state bills are left out."""
    k = F.col("p_partkey")
    label = F.when(k % 3 == 0, F.concat(F.lit("HR "), F.lpad((k % 40).cast("string"), 4, "0"))).otherwise(F.concat(F.lit("HB "), k.cast("string")))
    rows = T(s, d, "part").select(k.cast("string").alias("ocd_bill_id"), F.lit(outside.FEDERAL).alias("jurisdiction_id"), (100 + F.col("p_size")).cast("string").alias("session"), label.alias("identifier"))
    owned = s.range(20).select(F.col("id").alias("n"), F.explode(F.sequence(F.lit(100), F.lit(160))).alias("congress")).select(F.concat(F.lit("B"), F.col("congress").cast("string"), F.lit("-"), F.col("n").cast("string")).alias("bill_id"), "congress", F.lit("hr").alias("bill_type"), F.col("n").alias("bill_number"))
    return outside.link_bills(rows, owned)


@query("""SELECT person_id, external_id, valid_from FROM person_identifier WHERE namespace = 'bioguide' QUALIFY row_number() OVER (PARTITION BY external_id ORDER BY loaded_at DESC NULLS LAST, person_id) = 1""")
def current_owner(s: SparkSession, d: str) -> DataFrame:
    """The newest owner of each guide."""
    rows = pick.required(T(s, d, "person_identifier").filter("namespace = 'bioguide'"), "guide")
    return pick.distinct_on(rows, ["external_id"], [F.desc_nulls_last("loaded_at"), F.asc("person_id")]).select("person_id", "external_id", "valid_from")


# Predicates, arrays and JSON -------------------------------------------------------------------------------


@query("""SELECT p_partkey FROM part WHERE p_name LIKE 'a%' UNION ALL SELECT p_partkey FROM part WHERE p_name ILIKE '%A%' AND p_type ILIKE '%tin%' UNION ALL SELECT p_partkey FROM part WHERE p_brand IN ('Brand#12', 'Brand#34') AND p_size NOT IN (1, 2, 3)""")
def pattern_predicates(s: SparkSession, d: str) -> DataFrame:
    """Prefix and case-blind patterns, membership in lists and its negation, an optional parameter that isn't given."""
    p = T(s, d, "part").filter(S.optional(F.col("p_size"), None))
    hits = [F.col("p_name").like("a%"), F.col("p_name").ilike("%A%") & F.col("p_type").ilike("%tin%"), F.col("p_brand").isin("Brand#12", "Brand#34") & ~F.col("p_size").isin(1, 2, 3)]
    return reduce(DataFrame.unionByName, [p.filter(h).select("p_partkey") for h in hits])


@query("""SELECT event_id, json_exists(props, '$.k') AS has_k, json_exists(props, '$.none') AS has_none, '{"event_type":"' || event_type || '","k":"' || (props->>'k') || '"}' AS built FROM events""")
def json_objects(s: SparkSession, d: str) -> DataFrame:
    """Keys of JSON objects, and objects built without their nulls."""
    k = F.get_json_object("props", "$.k")
    return T(s, d, "events").select("event_id", S.json_has_key(F.col("props"), "k").alias("has_k"), S.json_has_key(F.col("props"), "none").alias("has_none"), F.to_json(F.struct("event_type", k.alias("k"), F.lit(None).cast("string").alias("gone"))).alias("built"))


@query("""SELECT user_id, '[' || string_agg('{"event_id":' || event_id || ',"event_type":"' || event_type || '"}', ',' ORDER BY event_id) || ']' AS listed FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) <= 5) GROUP BY 1""")
def newest_as_json(s: SparkSession, d: str) -> DataFrame:
    """The five newest events of each user as a JSON list in order (the five are the feature, cut before they are gathered)."""
    newest = Window.partitionBy("user_id").orderBy(F.desc("event_id"))
    cut = T(s, d, "events").select("user_id", "event_id", "event_type").withColumn("_rn", F.row_number().over(newest)).filter("_rn <= 5")
    return cut.groupBy("user_id").agg(F.to_json(F.sort_array(F.collect_list(F.struct("event_id", "event_type")))).alias("listed"))


@query("""SELECT c_custkey AS k, list_transform(list_sort(map_keys(m)), lambda x: x || '=' || m[x])[1] AS first, array_to_string(list_transform(list_sort(map_keys(m)), lambda x: x || '=' || m[x]), ',') AS merged FROM (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN map {'a': 'old', 'c': 'kept'} WHEN c_custkey % 3 = 1 THEN map {'a': 'new', 'b': 'x', 'c': 'kept'} ELSE map {'a': 'new', 'b': 'x'} END AS m FROM customer)""")
def upsert_merge(s: SparkSession, d: str) -> DataFrame:
    """Maps merged on conflict: the arriving value wins key by key, the rest is kept."""
    c = T(s, d, "customer").select(F.col("c_custkey").alias("k"))
    old = c.filter("k % 3 < 2").withColumn("m", F.create_map(F.lit("a"), F.lit("old"), F.lit("c"), F.lit("kept")))
    new = c.filter("k % 3 > 0").withColumn("m", F.create_map(F.lit("a"), F.lit("new"), F.lit("b"), F.lit("x")))
    pairs = F.array_sort(F.transform(F.map_entries("m"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return keyed.upsert(old, new, ["k"], {"m": "merge"}).select("k", F.get(pairs, F.lit(0)).alias("first"), F.array_join(pairs, ",").alias("merged"))


@query("SELECT n_nationkey, unnest([n_name, upper(n_name), NULL]) AS name, unnest([1, 2, 3]) AS place FROM nation")
def parallel_arrays(s: SparkSession, d: str) -> DataFrame:
    """Arrays side by side as rows."""
    zipped = F.arrays_zip(F.array("n_name", F.upper("n_name"), F.lit(None).cast("string")).alias("name"), F.array(*[F.lit(i) for i in (1, 2, 3)]).alias("place"))
    return T(s, d, "nation").select("n_nationkey", F.inline(zipped))


@query("""SELECT p_partkey, (100 + p_size)::varchar AS congress, CASE p_partkey % 3 WHEN 0 THEN 'hr' WHEN 1 THEN 'sjres' END AS bill_type, CASE WHEN p_partkey % 3 < 2 THEN p_partkey::varchar END AS bill_number,
    CASE WHEN p_size % 2 = 0 THEN p_size END::bigint AS whole, sha256(p_name) AS digest FROM part""")
def domain_scalars(s: SparkSession, d: str) -> DataFrame:
    """Bill keys from printed labels, strict whole numbers, digests."""
    k = F.col("p_partkey")
    label = F.when(k % 3 == 0, F.concat(F.lit(" HR 00"), k.cast("string"))).when(k % 3 == 1, F.concat(F.lit("sjres"), k.cast("string"))).otherwise(F.concat(F.lit("HB "), k.cast("string")))
    key = S.bill_key((100 + F.col("p_size")).cast("string"), label)
    number = F.concat(F.col("p_size").cast("string"), F.when(F.col("p_size") % 2 == 0, ".0").otherwise(".5"))
    return T(s, d, "part").select("p_partkey", (100 + F.col("p_size")).cast("string").alias("congress"), key["bill_type"].alias("bill_type"), key["bill_number"].alias("bill_number"), S.strict_whole(number).alias("whole"), F.sha2("p_name", 256).alias("digest"))


@query("""SELECT 'left' AS side, * FROM (SELECT l_suppkey, l_returnflag FROM lineitem WHERE l_quantity > 10 EXCEPT ALL SELECT l_suppkey, l_returnflag FROM lineitem WHERE l_quantity < 40) UNION ALL SELECT 'right', * FROM (SELECT l_suppkey, l_returnflag FROM lineitem WHERE l_quantity < 40 EXCEPT ALL SELECT l_suppkey, l_returnflag FROM lineitem WHERE l_quantity > 10)""")
def multiset_difference(s: SparkSession, d: str) -> DataFrame:
    """Rows one of two tables has more often."""
    li = T(s, d, "lineitem")
    return reconcile.multiset_difference(li.filter("l_quantity > 10").select("l_suppkey", "l_returnflag"), li.filter("l_quantity < 40").select("l_suppkey", "l_returnflag"))


@query("""WITH n AS (SELECT n_name, regexp_split_to_array(lower(n_name), '[^a-z0-9]+') AS w FROM nation), t AS (SELECT DISTINCT n_name, substr('  ' || x || ' ', i, 3) AS g FROM (SELECT n_name, unnest(w) AS x FROM n), range(1, 60) r(i) WHERE x <> '' AND i <= length(x) + 1),
    u AS (SELECT DISTINCT substr('  ' || x || ' ', i, 3) AS g FROM (VALUES ('united'), ('stats')) v(x), range(1, 20) r(i) WHERE i <= length(x) + 1)
    SELECT n_name, round(count(*) FILTER (WHERE t.g IN (SELECT g FROM u)) / (count(*) + (SELECT count(*) FROM u) - count(*) FILTER (WHERE t.g IN (SELECT g FROM u))), 6) AS similarity FROM t GROUP BY 1""")
def trigram_search(s: SparkSession, d: str) -> DataFrame:
    """Trigram similarity to a misspelt name."""
    return T(s, d, "nation").select("n_name", F.round(S.trigram_similarity(F.col("n_name"), F.lit("United Stats")), 6).alias("similarity"))


@query("SELECT doc_id, source, row_number() OVER (ORDER BY source DESC NULLS LAST, doc_id)::int AS place FROM documents QUALIFY place <= 100")
def search_page(s: SparkSession, d: str) -> DataFrame:
    """The first hundred hits in the order of bytes, with their places (the limit is the feature)."""
    hits, truncated = catalog.search(T(s, d, "documents").select("doc_id", "source"), F.lit(True), [F.desc("source"), F.asc("doc_id")], 100)
    assert truncated.columns == ["truncated"]
    return hits.withColumn("place", F.row_number().over(Window.orderBy(F.desc("source"), F.asc("doc_id"))))  # a hundred rows


@query("SELECT c_custkey AS k, 'seg' AS column FROM customer WHERE c_custkey % 5 = 0 AND c_custkey % 10 <> 0")
def guarded_changes(s: SparkSession, d: str) -> DataFrame:
    """Columns that a step changed past the resolver."""
    before = T(s, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("seg"))
    after = before.withColumn("seg", F.when(F.col("k") % 5 == 0, F.lit("changed")).otherwise(F.col("seg")))
    return keyed.guarded_changes(before, after, ["k"], ["seg"], after.filter("k % 10 = 0"))
