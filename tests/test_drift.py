from __future__ import annotations

from datetime import date

from civicloom.operators.drift import field_changes, field_lines, long_path_values, path_statistics, registered, typed_values, wide_path_values

SCHEMA = "dataset_id string, field_id string, label string, data_type string, valid_from date, valid_to date, change string"


def fields(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)


ROWS = [
    ("d", "keep", "Count of the vote", "int", date(2010, 1, 1), None),
    ("d", "keep", "Count of the vote", "int4", date(2010, 1, 1), None),
    ("d", "old_id", "Estimate!!Total!!rooms", "integer", date(2010, 1, 1), date(2012, 3, 1)),
    ("d", "new_id", "Tot., rooms, Est.", "numeric", date(2012, 3, 2), date(9999, 12, 31)),
    ("d", "rent", "Rent of the unit", "text", date(2010, 1, 1), date(2011, 12, 31)),
    ("d", "rent_cd", "Rent of the unit (net)", "text", date(2012, 1, 1), None),
    ("d", "kind", "Kind", "varchar", date(2010, 1, 1), date(2012, 12, 31)),
    ("d", "kind", "Kind", "DATE", date(2013, 1, 1), None),
    ("d", "gap", None, "int", date(2010, 1, 1), date(2011, 1, 1)),
    ("d", "gap", None, "int", date(2013, 5, 1), None),
    ("d", "shy", None, "int", date(2010, 8, 1), date(2011, 5, 1)),
    ("d", "bad", "Bad", "int", date(2012, 5, 1), date(2011, 5, 1)),
    ("e", "H1_E004", None, "int", date(2010, 1, 1), date(2011, 12, 31)),
    ("e", "H1_004E", "Estimate!!Total", "int", date(2012, 1, 1), None),
]


def test_changes(spark):
    releases = registered(fields(spark, ROWS), 2014)
    got = {tuple(r) for r in field_changes(releases, 2014).collect()}
    assert got == {
        ("d", "renamed", "old_id", "new_id", 2012), ("d", "removed", "rent", "rent", 2012), ("d", "added", "rent_cd", "rent_cd", 2012), ("d", "retyped", "kind", "kind", 2013),
        ("d", "removed", "gap", "gap", 2011), ("d", "added", "gap", "gap", 2013), ("e", "renamed", "H1_E004", "H1_004E", 2012),
    }
    assert field_changes(registered(fields(spark, []), 2014), 2014).count() == 0


def test_one_table_with_failed_casts(spark):
    releases = registered(fields(spark, ROWS), 2014)
    lines = field_lines(releases, field_changes(releases, 2014)).filter("dataset_id = 'd'")
    facts = spark.createDataFrame([(2011, "old_id", "5"), (2011, "old_id", "5.5"), (2012, "new_id", "5.5"), (2013, "kind", "2020-01-01"), (2013, "kind", "soon"), (2013, "odd", "1"), (2013, "new_id", None), (2013, None, "1")], "release_year int, field_id string, value string")
    maps = long_path_values(facts, ["release_year"], "field_id", "value")
    got = {(r.release_year, r.field_id, r.item, r.item_type, r.value_text, r.failed) for r in typed_values(maps, ["release_year"], lines, lines.count(), []).collect()}
    assert got == {
        (2011, "old_id", "new_id", "decimal", "5", False), (2011, "old_id", "new_id", "decimal", "5.5", True), (2012, "new_id", "new_id", "decimal", "5.5", False), (2013, "kind", "kind", "text", "2020-01-01", False),
        (2013, "kind", "kind", "text", "soon", True), (2013, "odd", "odd", "text", "1", False), (2013, "new_id", "new_id", "decimal", None, False),
    }
    stats = {(r.release_year, r.path): (r.n, r.n_null, r.raw_types) for r in path_statistics(maps, ["release_year"]).collect()}
    assert stats[(2011, "old_id")] == (2, 0, {"decimal": 1, "integer": 1}) and stats[(2013, "new_id")] == (1, 1, {"null": 1})
    wide = wide_path_values(spark.createDataFrame([(1, "a", 2.5)], "f int, x string, y double"), ["f"]).first().cells
    assert wide["y"].raw_type == "double" and wide["x"].value == "a"


def test_a_field_may_be_renamed_any_number_of_times(spark):
    n = 40
    releases = spark.createDataFrame([("d", 1980 + i, f"f{i:02}", "integer") for i in range(n)], "dataset_id string, release int, field_id string, type string")
    changes = spark.createDataFrame([("d", "renamed", f"f{i - 1:02}", f"f{i:02}", 1980 + i) for i in range(1, n)], "dataset_id string, change string, field_id string, new_field_id string, release_year int")
    assert {r.item for r in field_lines(releases, changes).collect()} == {f"f{n - 1:02}"}
    assert field_lines(releases.limit(0), changes).count() == 0
