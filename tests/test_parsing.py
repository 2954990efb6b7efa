from __future__ import annotations

import csv
import re
from datetime import datetime
from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from civicloom.operators.parsing import Layout, failed, matching, parse_lines, real_date, split_line, typed
from civicloom.queries.data_problems import FEC_LAYOUTS, MEMBER_LAYOUT, QUERIES, _fec, _members

D = "/root/testdata/sf0.01"


def expected_failure(line, layout, checks):
    if line is None:
        return True
    fields, broken = split_line(line, layout.separator)
    if broken:
        return True
    fields = [f.strip(" ") for f in fields]
    n = len(layout.columns)
    if not (len(fields) == n or layout.spare and len(fields) == n + 1 and fields[-1] == ""):
        return True
    return any(not ok(fields[layout.columns.index(c)]) for c, ok in checks.items())


def is_day(v):
    try:
        return v == "" or bool(re.fullmatch("[0-9]{8}", v) and datetime.strptime(v, "%m%d%Y"))
    except ValueError:
        return False


def is_score(v):
    return v == "" or bool(re.fullmatch(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?", v, re.A)) and abs(float(v)) <= 1


FEC = {"transaction_dt": is_day, "transaction_amt": lambda v: bool(re.fullmatch(r"[+-]?(\d+(\.\d{0,2})?|\.\d{1,2})", v, re.A)), "sub_id": lambda v: bool(re.fullmatch(r"\d{19}", v, re.A))}
MEMBER = {
    "congress": lambda v: bool(re.fullmatch(r"\d+", v, re.A)), "icpsr": lambda v: bool(re.fullmatch(r"\d+", v, re.A)), "nominate_dim1": is_score,
    "born": lambda v: v == "" or bool(re.fullmatch(r"\d{4}(\.0)?", v, re.A)) and 1700 <= float(v) <= 2010,
}


def test_whole_tables_against_row_by_row_checks(spark):
    layouts = {x.name: x for x in FEC_LAYOUTS}
    for name, parsed in (("fec_row", _fec(spark, D)), ("voteview_line", _members(spark, D))):
        rows = spark.read.parquet(f"{D}/{name}.parquet").collect()
        want = {(r.artifact_id, r.source_ordinal) for r in rows if expected_failure(r.raw, layouts[r.family] if name == "fec_row" else MEMBER_LAYOUT, FEC if name == "fec_row" else MEMBER)}
        assert {(r.artifact_id, r.source_ordinal) for r in failed(parsed, ["artifact_id", "source_ordinal"]).collect()} == want
        assert len(want) > 10


def test_valid_lines_of_every_family_come_out_once(spark):
    layouts = {x.name: x for x in FEC_LAYOUTS}
    rows = spark.read.parquet(f"{D}/fec_row.parquet").collect()
    want = {}
    for r in rows:
        if not expected_failure(r.raw, layouts[r.family], FEC):
            fields = [f.strip(" ") for f in split_line(r.raw, "|")[0]]
            want[r.artifact_id, r.source_ordinal] = (r.family, r.cycle, {c: f for c, f in zip(layouts[r.family].columns, fields) if f})
    found = [r.asDict() for name in QUERIES if name.startswith("p4_valid_") and name != "p4_valid_members" for r in QUERIES[name](spark, D).collect()]
    assert len(found) == len(want) == len({(r["artifact_id"], r["source_ordinal"]) for r in found})
    assert {r["family"] for r in found} == set(layouts)
    for r in found:
        family, cycle, fields = want[r.pop("artifact_id"), r.pop("source_ordinal")]
        assert (r.pop("family"), r.pop("cycle")) == (family, cycle) and set(r) == set(layouts[family].columns)
        typed_row = {c: v.strftime("%m%d%Y") if c == "transaction_dt" else v for c, v in r.items() if v is not None}
        assert typed_row.pop("transaction_amt") == Decimal(fields.pop("transaction_amt")) and typed_row == fields


LAYOUT = Layout("x", ("a", "d"), ",", True)
RULES = {"a": matching("^[0-9]+$", "not digits"), "d": real_date("MMddyyyy", "^[0-9]{8}$")}


def test_edges(spark):
    lines = [None, "", "1,", "1,02302020", "1,02292020", "x,13012020", '"1",01012020', '"1"x,01012020', '"1,01012020', "1,01012020,", "1,01012020,z", " 7 , 01012020 ", '1"2,', "9" * 50000 + ",", '"' + '""' * 20000 + '",']
    df = spark.createDataFrame([(i, x, "clash") for i, x in enumerate(lines)], "i int, raw string, fields string")
    for limit in (1000, 0):
        parsed = parse_lines(df, "raw", [LAYOUT], RULES, broadcast_rows=limit)
        reasons = {r.i: r.reasons for r in parsed.collect()}
        assert [i for i in range(len(lines)) if not reasons[i]] == [2, 4, 6, 9, 11, 13]
        assert reasons[0] == ["null line"] and reasons[1] == ["expected 2 fields, found 1"] and reasons[3] == ["d: not a date as MMddyyyy"]
        assert len(reasons[5]) == 2 and reasons[7] == ["text after the closing quote"] and reasons[8] == ["quote not closed"] and reasons[10] == ["expected 2 fields, found 3"]
    assert {r.a for r in typed(parsed, LAYOUT, {}, ["i"]).collect()} >= {"1", "7"}
    assert parse_lines(df.limit(0), "raw", [LAYOUT], RULES).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet='ab",| ', max_size=6), min_size=1, max_size=5))
def test_written_lines_read_back(fields):
    import io

    out = io.StringIO()
    csv.writer(out, lineterminator="", quoting=csv.QUOTE_ALL).writerow(fields)
    assert split_line(out.getvalue(), ",") == (fields, None)
