"""Roll-call files of both chambers to typed rows: the roll, its party totals, its votes, and what couldn't be read.

The documents are parsed by the JVM's XML reader under a schema of the parts that have columns; what has no column
is kept by ``records.xml_records``. A file that lacks what identifies a roll goes to the refused rows with its
reason instead of stopping the load.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicloom.functions.scalars import clerk_day, document_type, eastern_clock, eastern_stamp, house_result, senate_result, vote_position
from civicloom.session import stage

_TOTALS = "`yea-total`:string,`nay-total`:string,`present-total`:string,`not-voting-total`:string"
HOUSE = (
    "`vote-metadata` struct<congress:string,session:string,chamber:string,committee:string,`rollcall-num`:string,`legis-num`:string,"
    "`vote-question`:string,`vote-type`:string,`vote-result`:string,majority:string,`vote-desc`:string,`amendment-num`:string,`amendment-author`:string,"
    "`action-date`:string,`action-time`:struct<_VALUE:string,`_time-etz`:string>,"
    f"`vote-totals`:struct<`totals-by-party`:array<struct<party:string,{_TOTALS}>>,`totals-by-vote`:struct<{_TOTALS}>>>,"
    "`vote-data` struct<`recorded-vote`:array<struct<legislator:struct<_VALUE:string,`_name-id`:string,`_sort-field`:string,`_unaccented-name`:string,"
    "`_party`:string,`_state`:string,`_role`:string>,vote:string>>>"
)
SENATE = (
    "congress string,session string,congress_year string,vote_number string,vote_date string,modify_date string,question string,vote_question_text string,"
    "vote_document_text string,vote_result_text string,vote_title string,vote_result string,majority_requirement string,"
    "document struct<document_congress:string,document_type:string,document_number:string,document_name:string,document_title:string,document_short_title:string>,"
    "amendment struct<amendment_number:string,amendment_to_amendment_number:string,amendment_to_amendment_to_amendment_number:string,"
    "amendment_to_document_number:string,amendment_to_document_short_title:string,amendment_purpose:string>,"
    "count struct<yeas:string,nays:string,present:string,absent:string>,tie_breaker struct<by_whom:string,tie_breaker_vote:string>,"
    "members struct<member:array<struct<lis_member_id:string,member_full:string,last_name:string,first_name:string,party:string,state:string,vote_cast:string>>>"
)
_OPTIONS = {"attributePrefix": "_", "valueTag": "_VALUE", "columnNameOfCorruptRecord": "_bad"}


def text(c: Column | str) -> Column:
    """A text without white space around it; blank is null."""
    return F.nullif(F.trim(F.regexp_replace(F.col(c) if isinstance(c, str) else c, r"^\s+|\s+$", "")), F.lit(""))


def whole(c: Column) -> Column:
    return text(c).try_cast("int")


def root_name(xml: Column) -> Column:
    """The name of a document's first element, after declarations and comments."""
    bare = F.regexp_replace(xml, r"(?s)<\?.*?\?>|<!--.*?-->|<!DOCTYPE[^>\[]*(\[.*?\])?[^>]*>", "")
    return F.nullif(F.regexp_extract(bare, r"<\s*([^\s/>]+)", 1), F.lit(""))


def parsed_documents(docs: DataFrame, key: str, xml: str, schema: str, root: str) -> DataFrame:
    """(key, d, problem): each document under a schema; null, broken and other documents have a problem and no d.

    Each document is parsed once and kept as nested columns, of which a later step reads those it needs; left in
    one plan the parse would be repeated for every column that is taken from it.
    """
    rows = docs.select(F.col(key).cast("string").alias("key"), F.col(xml).cast("string").alias("xml"))
    read = F.from_xml("xml", f"struct<{_as_fields(schema)},_bad:string>", _OPTIONS)
    held = stage(rows.select("key", F.col("xml").isNull().alias("_none"), root_name(F.col("xml")).alias("_root"), read.alias("d")), "documents")
    problem = (
        F.when(F.col("_none"), "no document")
        .when(F.coalesce(F.col("_root"), F.lit("")) != root, F.concat(F.lit("root is "), F.coalesce("_root", F.lit("absent"))))
        .when(F.col("d").isNull() | F.col("d._bad").isNotNull(), "not well-formed")
    )
    return held.select("key", "d", problem.alias("problem"))


def _as_fields(schema: str) -> str:
    """A list of columns as the fields of a struct type."""
    out, depth, start = [], 0, 0
    for i, ch in enumerate(schema + ","):
        depth += (ch in "<(") - (ch in ">)")
        if ch == "," and depth == 0:
            out.append(":".join(schema[start:i].strip().split(" ", 1)))
            start = i + 1
    return ",".join(out)


def _refuse(parsed: DataFrame, needed: list[tuple[Column, str]]) -> DataFrame:
    problem = F.col("problem")
    for lacks, why in needed:
        problem = F.coalesce(problem, F.when(F.coalesce(lacks, F.lit(True)), why))
    return parsed.withColumn("problem", problem)


def house_files(docs: DataFrame, key: str, xml: str) -> DataFrame:
    """(key, d, problem) of House files; congress and roll number must be whole and a day that is given real."""
    m = "d.vote-metadata"
    col = lambda f: F.col(f"d.`vote-metadata`.`{f}`")
    parsed = parsed_documents(docs, key, xml, HOUSE, "rollcall-vote")
    return _refuse(parsed, [
        (F.col("d.`vote-metadata`").isNull(), f"no {m.split('.')[1]}"), (whole(col("congress")).isNull(), "congress is not a number"),
        (whole(col("rollcall-num")).isNull(), "rollcall-num is not a number"), (text(col("action-date")).isNotNull() & clerk_day(text(col("action-date"))).isNull(), "action-date is not a day"),
    ])


def house_rolls(files: DataFrame) -> DataFrame:
    """One row per usable House file. ``notes`` names what the file had but no column could take."""
    m = lambda f: text(F.col(f"d.`vote-metadata`.`{f}`"))
    total = lambda f: whole(F.col(f"d.`vote-metadata`.`vote-totals`.`totals-by-vote`.`{f}`"))
    etz = text(F.col("d.`vote-metadata`.`action-time`.`_time-etz`"))
    rolls = files.filter("problem IS NULL").select(
        "key", m("congress").cast("int").alias("congress"), m("rollcall-num").cast("int").alias("roll_number"), m("session").alias("congress_session"),
        F.coalesce(m("chamber"), m("committee")).alias("chamber_label"), m("legis-num").alias("legislative_number"), m("vote-question").alias("question"), m("vote-type").alias("vote_type"),
        m("vote-result").alias("vote_result"), m("majority").alias("majority_party"), m("vote-desc").alias("vote_description"), m("amendment-num").alias("amendment_number"),
        m("amendment-author").alias("amendment_author"), clerk_day(m("action-date")).alias("action_date"), etz.alias("action_time_etz"),
        total("yea-total").alias("yea_total"), total("nay-total").alias("nay_total"), total("present-total").alias("present_total"), total("not-voting-total").alias("not_voting_total"),
    )
    rolls = rolls.withColumn("occurred_at", eastern_clock(F.col("action_date"), F.col("action_time_etz"))).withColumn("result", house_result(F.col("vote_result")))
    notes = F.array(F.when(F.col("action_time_etz").isNotNull() & F.col("occurred_at").isNull(), "time_unusable"), F.when(F.col("vote_result").isNotNull() & F.col("result").isNull(), "result_not_normalized"))
    return rolls.withColumn("notes", F.array_compact(notes))


def house_party_totals(files: DataFrame) -> DataFrame:
    """(key, party, four totals) of the parties a file names."""
    rows = files.filter("problem IS NULL").select("key", F.explode("d.`vote-metadata`.`vote-totals`.`totals-by-party`").alias("t"))
    totals = {"yea_total": "yea-total", "nay_total": "nay-total", "present_total": "present-total", "not_voting_total": "not-voting-total"}
    return rows.select("key", text(F.col("t.party")).alias("party"), *[whole(F.col(f"t.`{s}`")).alias(n) for n, s in totals.items()]).filter("party IS NOT NULL")


def house_votes(files: DataFrame) -> DataFrame:
    """One row per recorded vote, with its place in the file from 1."""
    rows = files.filter("problem IS NULL").select("key", F.posexplode("d.`vote-data`.`recorded-vote`").alias("at", "v"))
    who = lambda f: F.col(f"v.legislator.`{f}`")
    raw = F.coalesce(text(F.col("v.vote")), F.lit(""))
    return rows.select(
        "key", (F.col("at") + 1).alias("source_ordinal"), text(who("_name-id")).alias("bioguide_id"), text(who("_VALUE")).alias("name"), who("_sort-field").alias("sort_name"),
        who("_unaccented-name").alias("unaccented_name"), who("_party").alias("party"), who("_state").alias("state"), who("_role").alias("role"), raw.alias("position_raw"), vote_position(raw).alias("position"),
    )


def senate_files(docs: DataFrame, key: str, xml: str) -> DataFrame:
    """(key, d, problem) of Senate files; congress, number, year and the moment of the vote are needed."""
    parsed = parsed_documents(docs, key, xml, SENATE, "roll_call_vote")
    needed = [(whole(F.col(f"d.{f}")).isNull(), f"{f} is not a number") for f in ("congress", "vote_number", "congress_year")]
    return _refuse(parsed, [*needed, (eastern_stamp(text(F.col("d.vote_date"))).isNull(), "vote_date is not a moment")])


def senate_rolls(files: DataFrame) -> DataFrame:
    """One row per usable Senate file, with the key of the bill its document names (null for anything but a bill).

    A count printed as an empty element is zero, one that isn't printed unknown. Old files give no congress of the
    document: it is the roll's own.
    """
    t = lambda f: text(F.col(f"d.{f}"))
    count = lambda f: F.when(F.col("d.count").isNotNull() & F.col(f"d.count.{f}").isNotNull(), F.coalesce(whole(F.col(f"d.count.{f}")), F.lit(0)))
    kind, number = document_type(t("document.document_type")), t("document.document_number")
    bill = kind.isNotNull() & number.rlike("^[0-9]+$")
    session = whole(F.col("d.session"))
    blocks = {
        "document": ["document_type", "document_number", "document_name", "document_title", "document_short_title"],
        "amendment": ["amendment_number", "amendment_to_amendment_number", "amendment_to_amendment_to_amendment_number", "amendment_to_document_number", "amendment_to_document_short_title", "amendment_purpose"],
        "tie_breaker": ["tie_breaker_vote"],
    }
    rolls = files.filter("problem IS NULL").select(
        "key", whole(F.col("d.congress")).alias("congress"), whole(F.col("d.vote_number")).alias("roll_number"), whole(F.col("d.congress_year")).alias("roll_year"), session.alias("session_number"),
        F.when(session == 1, "1st").when(session == 2, "2nd").when(session == 3, "3rd").otherwise(t("session")).alias("congress_session"),
        *[t(f).alias(f) for f in ("question", "vote_question_text", "vote_document_text", "vote_result_text", "vote_title", "vote_result", "majority_requirement")],
        eastern_stamp(t("vote_date")).alias("occurred_at"), eastern_stamp(t("modify_date")).alias("modified_at"), t("modify_date").alias("_modified"), whole(F.col("d.document.document_congress")).alias("document_congress"),
        *[t(f"{b}.{f}").alias(f) for b, fields in blocks.items() for f in fields], t("tie_breaker.by_whom").alias("tie_breaker_by"),
        *[count(f).alias(n) for n, f in (("yea_total", "yeas"), ("nay_total", "nays"), ("present_total", "present"), ("not_voting_total", "absent"))],
        F.when(bill, F.coalesce(whole(F.col("d.document.document_congress")), whole(F.col("d.congress")))).alias("link_congress"), F.when(bill, kind).alias("link_bill_type"), F.when(bill, number).alias("link_bill_number"),
    )
    rolls = rolls.withColumn("result", senate_result(F.col("vote_result")))
    rolls = rolls.withColumn("action_date", F.from_utc_timestamp("occurred_at", "America/New_York").cast("date")).withColumn("action_time_etz", F.date_format(F.from_utc_timestamp("occurred_at", "America/New_York"), "HH:mm"))
    notes = F.array(F.when(F.col("_modified").isNotNull() & F.col("modified_at").isNull(), "modified_unusable"), F.when(F.col("vote_result").isNotNull() & F.col("result").isNull(), "result_not_normalized"))
    return rolls.withColumn("notes", F.array_compact(notes)).drop("_modified")


def senate_votes(files: DataFrame) -> DataFrame:
    """One row per member of a Senate file, with its place in the file from 1."""
    rows = files.filter("problem IS NULL").select("key", F.posexplode("d.members.member").alias("at", "m"))
    raw = F.coalesce(text(F.col("m.vote_cast")), F.lit(""))
    return rows.select(
        "key", (F.col("at") + 1).alias("source_ordinal"), text("m.lis_member_id").alias("lis_member_id"), text("m.member_full").alias("name"), text("m.last_name").alias("last_name"),
        text("m.first_name").alias("first_name"), text("m.party").alias("party"), text("m.state").alias("state"), raw.alias("position_raw"), vote_position(raw).alias("position"),
    )


def refused(files: DataFrame) -> DataFrame:
    """(key, problem) of the files that gave no roll."""
    return files.filter("problem IS NOT NULL").select("key", "problem")


def menu_votes(docs: DataFrame, xml: str) -> DataFrame:
    """(congress, session_number, roll_year, roll_number, issue, result, yeas, nays) of a session's list of votes."""
    schema = "struct<congress:string,session:string,congress_year:string,votes:struct<vote:array<struct<vote_number:string,vote_date:string,issue:string,question:string,result:string,vote_tally:struct<yeas:string,nays:string>>>>>"
    rows = docs.select(F.from_xml(xml, schema).alias("d")).select("d.congress", "d.session", "d.congress_year", F.explode("d.votes.vote").alias("v"))
    return rows.select(
        whole(F.col("congress")).alias("congress"), whole(F.col("session")).alias("session_number"), whole(F.col("congress_year")).alias("roll_year"), whole(F.col("v.vote_number")).alias("roll_number"),
        text("v.issue").alias("issue"), text("v.result").alias("result"), whole(F.col("v.vote_tally.yeas")).alias("yeas"), whole(F.col("v.vote_tally.nays")).alias("nays"),
    )


def menu_problems(rolls: DataFrame, menu: DataFrame) -> DataFrame:
    """(congress, session_number, roll_number, problems) where a roll and its line in the list disagree.

    Compared are the year and both tallies, each only where both sides state it; a line without a file and a file
    without a line are problems of their own.
    """
    keys = ["congress", "session_number", "roll_number"]
    left = rolls.select(*keys, F.col("roll_year").alias("_year"), F.col("yea_total").alias("_yeas"), F.col("nay_total").alias("_nays"), F.lit(True).alias("_file"))
    both = left.join(menu.select(*keys, "roll_year", "yeas", "nays", F.lit(True).alias("_line")), keys, "full")
    differ = [F.when(F.col(a) != F.col(b), name) for name, a, b in (("year", "_year", "roll_year"), ("yeas", "_yeas", "yeas"), ("nays", "_nays", "nays"))]
    lacks = F.when(F.col("_file").isNull(), "no file").when(F.col("_line").isNull(), "not listed")
    return both.select(*keys, F.array_compact(F.array(lacks, *differ)).alias("problems")).filter(F.size("problems") > 0)


def link_bills(rolls: DataFrame, bills: DataFrame) -> DataFrame:
    """Rolls with ``bill_id`` set where it is null and the bill their document names is known; others stay as they are.

    ``rolls`` as ``senate_rolls`` gives them. ``bills``: (bill_id, congress, bill_type, bill_number), unique on the
    last three. Both sides are always shuffled: where bills are made by a generator, the planner's guess of their
    size is too low by its factor, and it would broadcast millions. Rolls that name no bill are dealt by their own key.
    """
    named = bills.select(F.col("bill_id").alias("_bill"), F.col("congress").cast("int").alias("_congress"), F.col("bill_type").alias("_type"), F.col("bill_number").cast("string").alias("_number"))
    kind = F.when(F.col("link_bill_number").isNotNull(), F.col("link_bill_type"))  # null matches nothing, whatever stands beside it
    number = F.coalesce("link_bill_number", F.col("key").cast("string"))
    out = rolls.join(named.hint("shuffle_merge"), (F.col("link_congress") == F.col("_congress")) & (kind == F.col("_type")) & (number == F.col("_number")), "left")
    return out.withColumn("bill_id", F.coalesce("bill_id", "_bill") if "bill_id" in rolls.columns else F.col("_bill")).drop("_bill", "_congress", "_type", "_number")


def link_outside_rolls(outside: DataFrame, official: DataFrame) -> DataFrame:
    """``outside`` rolls with ``matches`` and ``roll_call_id``, set only where exactly one official roll matches.

    ``outside``: congress, chamber, session (1 or 2; others link to nothing), clerk_rollnumber. ``official``:
    roll_call_id, congress, chamber, congress_session (1st, 2nd), roll_number. Official rolls are counted per key
    before the join, so nothing fans out.
    """
    keys = ["congress", "chamber", "_session", "_number"]
    known = official.select(F.col("congress").cast("string").alias("congress"), "chamber", F.col("congress_session").alias("_session"), F.col("roll_number").cast("int").alias("_number"), "roll_call_id")
    per_key = known.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("roll_call_id").alias("_id"))
    session = F.when(F.col("session") == 1, "1st").when(F.col("session") == 2, "2nd")
    rows = outside.withColumn("congress", F.col("congress").cast("string")).withColumn("_session", session).withColumn("_number", F.col("clerk_rollnumber").cast("int"))
    out = rows.join(per_key, keys, "left").withColumn("matches", F.coalesce("_n", F.lit(0)))
    return out.withColumn("roll_call_id", F.when(F.col("matches") == 1, F.col("_id"))).select(*outside.columns, "matches", "roll_call_id")


def link_summary(members: DataFrame, outside: DataFrame, parties: DataFrame) -> DataFrame:
    """One row of ten counters over linked members and rolls: one pass over each table.

    ``members``: chamber, person_id, and n_people, guides, guide as the owners of the number hold them. ``outside``
    as ``link_outside_rolls`` gives it.
    """
    guide = F.nullif(F.trim("guide"), F.lit(""))
    m = members.agg(
        F.count("*").alias("members"), F.count_if(F.col("chamber").isin("house", "senate") & F.col("person_id").isNull()).alias("unlinked_members"),
        F.count_if((F.col("chamber") == "president") & F.col("person_id").isNull()).alias("unlinked_presidents"),
        F.count_if((F.col("n_people") == 1) & guide.isNotNull() & ~F.array_contains("guides", F.col("guide"))).alias("bioguide_disagreements"),
    )
    n = F.col("matches")
    r = outside.agg(
        F.count("*").alias("roll_calls"), F.count_if(n == 1).alias("votes_linked"), F.count_if(n > 1).alias("votes_ambiguous"),
        F.count_if((n == 0) & F.col("clerk_rollnumber").isNull()).alias("votes_no_clerk_number"), F.count_if((n == 0) & F.col("clerk_rollnumber").isNotNull()).alias("votes_unmatched"),
    )
    return m.join(r, how="cross").join(parties.agg(F.count("*").alias("parties")), how="cross")  # one row each
