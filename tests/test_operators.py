from __future__ import annotations

import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from civicloom.functions import scalars as S
from civicloom.operators import checks, identity, keyed, links, pick, reconcile
from civicloom.operators.skew import block_join, lookup_join, salted_join
from civicloom.plans.catalog import linked_identifiers
from civicloom.sources import archives, delimited, records, sinks
from civicloom.streaming.tables import current_versions, keep_table, read_kept

rows = lambda df: sorted(map(tuple, df.collect()), key=repr)


def test_upserts_are_idempotent_and_null_safe(spark):
    t = spark.createDataFrame([(1, "a", {"x": "1"}), (None, "n", None), (3, None, {"y": "2"})], "k int, v string, m map<string,string>")
    s = spark.createDataFrame([(1, None, {"x": "9", "z": "3"}), (None, "N", {"q": "1"}), (4, "d", None)], "k int, v string, m map<string,string>")
    once = keyed.upsert(t, s, ["k"], {"v": "new_if_known", "m": "merge"})
    got = {r.k: (r.v, r.m) for r in once.collect()}
    assert got == {1: ("a", {"x": "9", "z": "3"}), None: ("N", {"q": "1"}), 3: (None, {"y": "2"}), 4: ("d", None)}
    again = keyed.upsert(once, s, ["k"], {"v": "new_if_known", "m": "merge"})
    assert {r.k: (r.v, r.m) for r in again.collect()} == got
    assert sorted(r.action for r in keyed.diff_action(t, t, ["k"], ["v"]).collect()) == ["unchanged"] * 3
    assert keyed.insert_absent(t, t, ["k"]).count() == 3
    assert keyed.delete_absent(t, s, ["k"]).count() == 2
    with pytest.raises(AssertionError):
        keyed.upsert(t, s, ["k"], {"v": "guess"})


def test_remap_sets_collisions_aside(spark):
    votes = spark.createDataFrame([("r1", "dup"), ("r1", "keep"), ("r2", "dup"), ("r3", "other")], "roll string, person string")
    kept, aside = keyed.remap(votes, "person", spark.createDataFrame([("dup", "keep")], "d string, s string"), "d", "s", ["roll", "person"])
    assert rows(kept) == [("r1", "keep"), ("r2", "keep"), ("r3", "other")] and rows(aside) == [("r1", "dup")]


def test_links_that_are_ambiguous_link_nobody(spark):
    ids = spark.createDataFrame([("p1", "bioguide", "A"), ("p2", "bioguide", "B"), ("p3", "bioguide", "C"), ("p3", "icpsr", "30"), ("p4", "bioguide", "D")], "person_id string, namespace string, external_id string")
    r = spark.createDataFrame([("10", "A"), ("20", "B"), ("21", "B"), ("30", ""), ("30", "A"), ("40", None), ("50", "A"), ("50", "D"), ("60", "D ")], "icpsr string, bioguide string")
    linked, new = identity.link_numbers(r, ids)
    got = {(x.icpsr, x.bioguide): x.person_id for x in linked.collect()}
    assert got[("30", "")] == "p3" and got[("30", "A")] is None and got[("20", "B")] is None and got[("40", None)] is None and got[("50", "A")] is None
    assert rows(new) == []


def test_linking_one_number(spark):
    ids = spark.createDataFrame([("p1", "bioguide", "A")], "person_id string, namespace string, external_id string")
    linked, new = identity.link_numbers(spark.createDataFrame([("10", "A"), ("10", "")], "icpsr string, bioguide string"), ids)
    assert {(x.bioguide, x.person_id) for x in linked.collect()} == {("A", "p1"), ("", None)} and rows(new) == [("p1", "10")]


def test_skew_joins_lose_nothing(spark):
    left = spark.createDataFrame([("hot", i) for i in range(500)] + [("c", 1), (None, 2), ("zz", 3)], "k string, v int")
    right = spark.createDataFrame([("hot", 1), ("c", 2), ("d", 3)], "k string, w int")
    want = rows(left.join(right, "k", "left"))
    assert rows(lookup_join(left, right, ["k"], 3, 10, 10)) == want == rows(lookup_join(left, right, ["k"], 3, 0, 10))
    inner = rows(left.join(right, "k"))
    assert rows(salted_join(left, right, ["k"], 3, 10)) == inner == rows(salted_join(left, right, ["k"], 3, 0))
    twice = left.filter("k = 'hot'").select("k", F.col("v").alias("u"))
    assert block_join(left, twice, ["k"], 50).count() == 500 * 500


def test_coverage_and_fingerprints(spark):
    c = reconcile.coverage_cells(spark.createDataFrame([("a", 5, 3), ("b", None, 3), ("c", 2, None), ("d", 2, 4)], "k string, e int, n int"), "e", "n")
    assert {r.k: (r.missing, r.surplus, r.status) for r in c.collect()} == {"a": (2, 0, "incomplete"), "b": (None, None, "unknown"), "c": (2, 0, "incomplete"), "d": (0, 2, "complete")}
    df = spark.range(50).select("id", (F.col("id") * 2).alias("v"))
    assert rows(reconcile.content_hash(df, ["id", "v"])) == rows(reconcile.content_hash(df.orderBy(F.desc("id")), ["id", "v"]))
    assert reconcile.multiset_difference(df, df).count() == 0 and reconcile.multiset_difference(df, df.union(df.limit(1))).count() == 1


def test_pick_and_checks(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "a", 3), (2, "b", 1), (None, "c", 1)], "k int, v string, n int")
    assert pick.distinct_on(df, ["k"], [F.desc_nulls_last("n")]).count() == 3
    assert {r.k: r.v for r in pick.exactly_one(df, "k", "v").collect()} == {1: "a", 2: "b", None: "c"}
    assert checks.not_null(df, ["n"]).count() == 1 and checks.unique(df, ["k"]).count() == 1 and checks.accepted_values(df, "v", ["a"]).count() == 2


def test_codes(spark):
    d = spark.createDataFrame([("1", "ocd-division/country:us/state:ak/cd:at-large"), ("2", "ocd-division/country:us/state:ak/sldu:b"), ("3", "ocd-division/country:us/territory:pr"), ("4", "ocd-division/country:us/state:ak/sldl:12a"), ("5", "ocd-division/country:us/state:ak/sldl:7"), ("6", None), ("7", "x")], "division_id string, ocd_division_id string")
    s = spark.createDataFrame([("ak", "02"), ("pr", "72")], "postal string, fips string")
    assert {r.division_id: r.geoid for r in links.division_candidates(d, s).collect()} == {"1": "0200", "2": "0200B", "3": "7298", "4": "0212A", "5": "02007"}
    f = spark.createDataFrame([("Yea", "Motion Not Agreed to", "H.R.", "HR 0012", "4-Jan-2007", "January 4, 2007, 02:05 PM", "0500000US99001", "1.5"), ("Guilty", "Nomination Confirmed", "X", "HB 2", "bad", "no", "0100000US", "2.0")], "p string, r string, t string, b string, c string, e string, g string, w string")
    got = f.select(S.vote_position(F.col("p")), S.senate_result(F.col("r")), S.document_type(F.col("t")), S.bill_key(F.lit("110"), F.col("b"))["bill_number"], S.clerk_day(F.col("c")).cast("string"), S.eastern_stamp(F.col("e")).cast("string"), S.geography_of(F.col("g"))["geoid"], S.strict_whole(F.col("w"))).collect()
    assert tuple(got[0]) == ("yes", "fail", "hr", "12", "2007-01-04", "2007-01-04 19:05:00", "99001", None)
    assert tuple(got[1]) == ("other", "pass", None, None, None, None, None, 2)


def test_records_are_lossless(spark):
    xml = '<bill n="1"><title>A &amp; B</title>run <b/>on<actions><item>x</item><item k="2">y</item></actions></bill>'
    df = spark.createDataFrame([("a", xml), ("b", "<broken"), ("c", None), ("d", "<e/>")], "k string, x string")
    got = {r.key: r for r in records.xml_records(df, "k", "x").collect()}
    assert got["a"].lossless and got["d"].lossless and not got["b"].lossless and got["c"].problem
    assert json.loads(got["a"].record)["@n"] == "1"
    assert ("a", "/bill/title[1]/#tail", "run") in {tuple(r) for r in records.xml_leaf_rows(df, "k", "x").collect()}


def test_sources_and_sinks(spark, tmp_path):
    path = str(tmp_path / "s.dat")
    with open(path, "w") as f:
        f.write("GEO_ID|B25001_E001|B25001_M001\n0500000US99001|100|N\n0100000US|300|11\n0400000US99|-999999999|.\n0500000US99|1|1\n0400000US123|1|1\n")
    got = {(r.geoid, r.field_id): r.value for r in delimited.survey_rows(delimited.read_delimited(spark, path, "|"), "geo_id", "B25001").collect()}
    assert len(got) == 4 and got[("99001", "b25001_e001")] == 100 and got[("99", "b25001_e001")] is None
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("itCont.TXT", "a|b\nc|d\n")
        z.writestr("readme.md", "no")
    archives.register(spark)
    lines = spark.read.format("ziplines").option("path", str(tmp_path / "*.zip")).option("member", ".txt").load()
    assert [(r.source_ordinal, r.line) for r in lines.collect()] == [(1, "a|b"), (2, "c|d")]
    wide = spark.createDataFrame([("01/02/2024", "5.1", "N/A"), ("01/03/2024", "", "4")], "day string, m1 string, y1 string")
    assert {(r.tenor, str(r.value)) for r in delimited.tenors_long(wide, "day").collect()} == {("m1", "5.100000000"), ("y1", "4.000000000")}
    out = str(tmp_path / "out.csv")
    df = spark.createDataFrame([(2, "b"), (1, "a")], "k int, v string")
    sinks.export_file(df, out, ["k", "v"], ["k"])
    assert open(out).read() == "k,v\n1,a\n2,b\n"
    with pytest.raises(FileExistsError):
        sinks.export_file(df, out, ["k", "v"], ["k"])
    sinks.export(df, str(tmp_path / "j"), "jsonl", ["k", "v"], ["k"])
    with pytest.raises(Exception):  # noqa: B017
        sinks.export(df, str(tmp_path / "j"), "jsonl", ["k", "v"], ["k"])
    pop = spark.createDataFrame([("050", "1", "1", "10", "11"), ("999", "1", "1", "1", "1")], "sumlev string, state string, county string, popestimate2020 string, popestimate2021 string")
    assert {(r.geoid, r.estimate_year, r.population) for r in delimited.population_rows(delimited.to_stage(pop, "a")).collect()} == {("01001", 2020, 10), ("01001", 2021, 11)}


def test_series(spark):
    d = spark.createDataFrame([('{"series_id":"S","observations":[{"date":"2024-01-01","value":"."},{"date":"2024-02-01","value":"2"}]}',), (None,)], "j string")
    assert [r.value for r in records.observations(d, "j").orderBy("period_start").collect()] == [None, 2]
    b = spark.createDataFrame([('{"Results":{"series":[{"seriesID":"X","data":[{"year":"2024","period":"M13","value":"1"},{"year":"2024","period":"M02","value":"3"}]}]}}',)], "j string")
    assert [(str(r.period_start), r.value) for r in records.monthly_series(b, "j").collect()] == [("2024-02-01", 3)]
    h = spark.createDataFrame([('[["NAME","V1","state"],["a","5","01"]]',)], "j string")
    assert rows(records.header_rows(h, "j", ["NAME", "state"])) == [("a", "01", "V1", "5")]


def test_stream_keeps_a_table(spark, tmp_path):
    source, kept = str(tmp_path / "in"), str(tmp_path / "t")
    schema = "k int, v string, at int"
    spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], schema).write.parquet(source)
    for _ in range(2):
        keep_table(spark.readStream.schema(schema).parquet(source), kept, ["k"], "at", str(tmp_path / "cp")).awaitTermination()
    spark.createDataFrame([(2, "d", 5), (3, "e", 5)], schema).write.mode("append").parquet(source)
    keep_table(spark.readStream.schema(schema).parquet(source), kept, ["k"], "at", str(tmp_path / "cp")).awaitTermination()
    assert rows(read_kept(spark, kept, schema)) == [(1, "b", 2), (2, "d", 5), (3, "e", 5)]
    newest = current_versions(spark, kept)
    assert len(newest) <= 3 and len(set(newest.values())) <= 2
    assert os.path.exists(kept)


def test_chains(spark):
    assert {tuple(r) for r in linked_identifiers(spark.createDataFrame([("a", "b"), ("b", "c"), ("d", "e")], "a string, b string")).collect()} == {("a", "a"), ("b", "a"), ("c", "a"), ("d", "d"), ("e", "d")}


def test_linked_identifiers_over_a_long_chain(spark):
    chain = spark.createDataFrame([(f"{i:02}", f"{i + 1:02}") for i in range(40)], "a string, b string")
    assert {tuple(r) for r in linked_identifiers(chain).collect()} == {(f"{i:02}", "00") for i in range(41)}


def test_segment_values_of_a_large_matrix(spark):
    from civicloom.sources.delimited import segment_values

    n = 10_500
    geo = spark.createDataFrame([(1, "01")], "logrecno int, geoid string")
    segment = spark.createDataFrame([(1, [str(i) for i in range(n)])], "logrecno int, fields array<string>")
    matrix = spark.range(n).selectExpr("concat('v', id) AS variable_id", "'t' AS table_id", "cast(id AS int) AS position")
    got = {r.variable_id: r.value for r in segment_values(geo, segment, matrix).collect()}
    assert got == {f"v{i}": i for i in range(n)}
