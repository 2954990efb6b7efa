"""The pN_ queries of the core: dangling references, lines that fail, places, periods, drifting fields."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicloom.functions.text import loose_key
from civicloom.operators.drift import field_changes, field_lines, long_path_values, path_statistics, registered, typed_values
from civicloom.operators.intervals import periods_and_gaps
from civicloom.operators.parsing import Layout, Rule, failed, matching, number_between, parse_lines, real_date, typed
from civicloom.operators.references import Reference, dangling, dangling_counts
from civicloom.operators.spatial import containing_regions, located, near_pairs
from civicloom.session import stage, table

LAST_RELEASE = 2025
NEAR_METRES = 250.0

# The columns of each kind of line, in file order.
CONTRIBUTION = (
    "cmte_id amndt_ind rpt_tp transaction_pgi image_num transaction_tp entity_tp name city state zip_code employer occupation "
    "transaction_dt transaction_amt other_id tran_id file_num memo_cd memo_text sub_id"
).split()
TO_CANDIDATE = (
    "cmte_id amndt_ind rpt_tp transaction_pgi image_num transaction_tp entity_tp name city state zip_code employer occupation "
    "transaction_dt transaction_amt other_id cand_id tran_id file_num memo_cd memo_text sub_id"
).split()
EXPENDITURE = (
    "cmte_id amndt_ind rpt_yr rpt_tp image_num line_num form_tp_cd sched_tp_cd name city state zip_code transaction_dt transaction_amt "
    "transaction_pgi purpose category category_desc memo_cd memo_text entity_tp sub_id file_num tran_id back_ref_tran_id"
).split()
MEMBER = "congress chamber icpsr state_icpsr district_code state_abbrev party_code bioname bioguide_id born died nominate_dim1 nominate_dim2".split()

FEC_LAYOUTS = [
    Layout("indiv", tuple(CONTRIBUTION), "|", True),
    Layout("oth", tuple(CONTRIBUTION), "|", True),
    Layout("pas2", tuple(TO_CANDIDATE), "|", True),
    Layout("oppexp", tuple(EXPENDITURE), "|", True),
]
MEMBER_LAYOUT = Layout("voteview_line", tuple(MEMBER), ",")
FEC_RULES: dict[str, Rule] = {
    "transaction_dt": real_date("MMddyyyy", "^[0-9]{8}$"),
    "transaction_amt": matching(r"^[+-]?([0-9]+(\.[0-9]{0,2})?|\.[0-9]{1,2})$", "not an amount"),
    "sub_id": matching("^[0-9]{19}$", "not 19 digits"),
}
MEMBER_RULES: dict[str, Rule] = {
    "congress": matching("^[0-9]+$", "not digits"),
    "icpsr": matching("^[0-9]+$", "not digits"),
    "born": number_between(1700, 2010, r"^[0-9]{4}(\.0)?$", "not a year from 1700 to 2010"),
    "nominate_dim1": number_between(-1, 1, r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$", "not a number from -1 to 1"),
}


def references() -> list[tuple[Reference, str]]:
    """The four referring columns and their parent tables."""
    return [
        (Reference("membership", "person_id", "membership_id", ("person_id",), "loaded_at", F.year("start_date"), "person", ("person_id",)), "person"),
        (Reference("membership", "organization_id", "membership_id", ("organization_id",), "loaded_at", F.year("start_date"), "organization", ("organization_id",)), "organization"),
        (Reference("acs_bulk_estimate", "geography_id", "acs_bulk_estimate_id", ("geography_id",), "loaded_at", F.col("release_year"), "geography", ("geography_id",)), "geography"),
        (Reference("identity_exception", "external_id", "identity_exception_id", ("namespace", "external_id"), "first_seen_at", F.col("congress"), "person_identifier", ("namespace", "external_id")), "person_identifier"),
    ]


def _dangling(spark: SparkSession, d: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [dangling(table(spark, d, r.table), table(spark, d, parent), r) for r, parent in references()])


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Every dangling reference of the four columns."""
    return _dangling(spark, d).select("table_name", "column_name", "record_id")


def p2_counts(spark: SparkSession, d: str) -> DataFrame:
    """Dangling references per table, column, period and reason."""
    return dangling_counts(_dangling(spark, d))


def _fec(spark: SparkSession, d: str) -> DataFrame:
    return parse_lines(table(spark, d, "fec_row"), "raw", FEC_LAYOUTS, FEC_RULES, "family")


def _members(spark: SparkSession, d: str) -> DataFrame:
    return parse_lines(table(spark, d, "voteview_line"), "raw", [MEMBER_LAYOUT], MEMBER_RULES)


def _failures(spark: SparkSession, d: str) -> DataFrame:
    keep = ["artifact_id", "source_ordinal"]
    parts = [failed(p, keep).select(F.lit(n).alias("table_name"), *keep, "reasons") for n, p in (("fec_row", _fec(spark, d)), ("voteview_line", _members(spark, d)))]
    return parts[0].unionByName(parts[1])


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """The lines that fail, once each however often they were delivered."""
    return _failures(spark, d).select("table_name", "artifact_id", "source_ordinal").distinct()


def p4_reasons(spark: SparkSession, d: str) -> DataFrame:
    """The failing lines with every reason."""
    return _failures(spark, d).select("table_name", "artifact_id", "source_ordinal", F.array_join("reasons", "; ").alias("reason"))


def p4_valid_members(spark: SparkSession, d: str) -> DataFrame:
    """The valid member lines as typed rows."""
    whole = lambda c: F.col(c).try_cast("double").try_cast("int")
    types = {c: whole(c) for c in ("congress", "state_icpsr", "district_code", "party_code", "born", "died")} | {c: F.col(c).try_cast("double") for c in ("nominate_dim1", "nominate_dim2")}
    return typed(_members(spark, d), MEMBER_LAYOUT, types, ["artifact_id", "source_ordinal"])


def _valid_fec(spark: SparkSession, d: str, families: list[str]) -> DataFrame:
    """The valid lines of families with the same columns as typed rows."""
    parsed = _fec(spark, d)
    types = {"transaction_dt": F.try_to_timestamp("transaction_dt", F.lit("MMddyyyy")).cast("date"), "transaction_amt": F.col("transaction_amt").try_cast("decimal(18,2)")}
    return reduce(DataFrame.unionByName, [typed(parsed, x, types, ["artifact_id", "source_ordinal", "family", "cycle"]) for x in FEC_LAYOUTS if x.name in families])


def p4_valid_contributions(spark: SparkSession, d: str) -> DataFrame:
    """The valid contribution lines (indiv and oth) as typed rows."""
    return _valid_fec(spark, d, ["indiv", "oth"])


def p4_valid_to_candidates(spark: SparkSession, d: str) -> DataFrame:
    """The valid lines of what committees gave to candidates (pas2) as typed rows."""
    return _valid_fec(spark, d, ["pas2"])


def p4_valid_expenditures(spark: SparkSession, d: str) -> DataFrame:
    """The valid lines of operating expenditures (oppexp) as typed rows."""
    return _valid_fec(spark, d, ["oppexp"])


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Continuous periods and gaps of each person in each role, over all organizations."""
    terms = table(spark, d, "membership").filter(F.col("person_id").isNotNull()).select(loose_key(F.col("person_id")).alias("person_id"), "role", "start_date", "end_date")
    return periods_and_gaps(terms, ["person_id", "role"], "start_date", "end_date").select("person_id", "role", "kind", "start_date", "end_date")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Offices near each other and the regions that contain them."""
    offices = located(table(spark, d, "profile_office"), "office_key", "latitude", "longitude")
    regions = table(spark, d, "tiger_feature").select(F.concat_ws(":", "layer", "geoid").alias("region"), "geom")
    near = near_pairs(offices, NEAR_METRES).select(F.lit("near").alias("relation"), "key_a", "key_b")
    within = containing_regions(offices, regions, "region", "geom").select(F.lit("within").alias("relation"), F.col("key").alias("key_a"), F.col("region").alias("key_b"))
    return near.unionByName(within)


def _drift(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    facts = table(spark, d, "acs_bulk_estimate")
    maps = long_path_values(facts, ["release_year"], "field_id", "value", ["table_id", "measure"])
    statistics = path_statistics(maps, ["release_year"], ["table_id", "measure"])
    releases = stage(registered(table(spark, d, "dataset_field"), LAST_RELEASE), "releases")
    return releases, field_changes(releases, LAST_RELEASE, statistics, "bulk.acs5"), statistics


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Every change of a field from release to release."""
    return _drift(spark, d)[1].select("dataset_id", "change", "field_id", "new_field_id", F.col("release_year").cast("int").alias("release_year"))


def _one_table(spark: SparkSession, d: str) -> DataFrame:
    releases, changes, _ = _drift(spark, d)
    lines = stage(field_lines(releases, stage(changes, "changes")).filter("dataset_id = 'bulk.acs5'"), "lines")
    keep = ["acs_bulk_estimate_id", "geography_id", "table_id", "measure"]
    maps = long_path_values(table(spark, d, "acs_bulk_estimate"), ["release_year"], "field_id", "value", keep)
    return typed_values(maps, ["release_year"], lines, lines.count(), keep)


def p7_table(spark: SparkSession, d: str) -> DataFrame:
    """The estimates of all releases in one table, under the id each field has at last, typed."""
    return _one_table(spark, d)


def p7_failed_casts(spark: SparkSession, d: str) -> DataFrame:
    """Values that aren't of the registered type, per release and field."""
    return _one_table(spark, d).groupBy("release_year", "field_id", "item_type").agg(F.count("*").alias("n"), F.count_if("failed").alias("n_failed")).filter("n_failed > 0")


QUERIES = {
    "p2_found": p2_found,
    "p2_counts": p2_counts,
    "p4_found": p4_found,
    "p4_reasons": p4_reasons,
    "p4_valid_members": p4_valid_members,
    "p4_valid_contributions": p4_valid_contributions,
    "p4_valid_to_candidates": p4_valid_to_candidates,
    "p4_valid_expenditures": p4_valid_expenditures,
    "p5_found": p5_found,
    "p6_found": p6_found,
    "p7_found": p7_found,
    "p7_table": p7_table,
    "p7_failed_casts": p7_failed_casts,
}

_KEY = "lower(trim({}, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '))"


def _p2_sql(child: str, column: str, rid: str, at: str, period: str, parent: str, pairs: list[str]) -> str:
    on = " AND ".join(f"{_KEY.format('c.' + x)} = {_KEY.format('p.' + x)}" for x in pairs)
    return f"""SELECT '{child}' AS table_name, '{column}' AS column_name, c.{rid} AS record_id, {period} AS period,
        CASE WHEN count(p.{pairs[0]}) = 0 THEN 'missing' WHEN count(p.{pairs[0]}) FILTER (WHERE p.deleted_at IS NULL) = 0 THEN 'deleted'
             WHEN min(p.loaded_at) FILTER (WHERE p.deleted_at IS NULL) > c.{at} THEN 'late' END AS reason
        FROM {child} c LEFT JOIN {parent} p ON {on} WHERE c.{column} IS NOT NULL GROUP BY c.{rid}, c.{at}, {period}"""


_P2 = "WITH f AS (" + " UNION ALL ".join(
    [
        _p2_sql("membership", "person_id", "membership_id", "loaded_at", "year(c.start_date)::int", "person", ["person_id"]),
        _p2_sql("membership", "organization_id", "membership_id", "loaded_at", "year(c.start_date)::int", "organization", ["organization_id"]),
        _p2_sql("acs_bulk_estimate", "geography_id", "acs_bulk_estimate_id", "loaded_at", "c.release_year", "geography", ["geography_id"]),
        _p2_sql("identity_exception", "external_id", "identity_exception_id", "first_seen_at", "c.congress", "person_identifier", ["namespace", "external_id"]),
    ]
) + ")"

ORACLE = {
    "p2_found": _P2 + " SELECT table_name, column_name, record_id FROM f WHERE reason IS NOT NULL",
    "p2_counts": _P2 + " SELECT table_name, column_name, period, reason, count(*) AS n FROM f WHERE reason IS NOT NULL GROUP BY ALL",
    "p6_found": f"""WITH t AS (SELECT {_KEY.format('person_id')} AS person_id, role, start_date AS a, coalesce(end_date, DATE '9999-12-31') AS b FROM membership
          WHERE start_date IS NOT NULL AND coalesce(end_date, DATE '9999-12-31') >= start_date),
        m AS (SELECT *, max(b) OVER (PARTITION BY person_id, role ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM t),
        r AS (SELECT *, sum(CASE WHEN before IS NULL OR (a - before) > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY person_id, role ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS run FROM m),
        p AS (SELECT person_id, role, min(a) AS a, max(b) AS b FROM r GROUP BY person_id, role, run),
        g AS (SELECT *, lead(a) OVER (PARTITION BY person_id, role ORDER BY a) AS nxt FROM p)
        SELECT person_id, role, 'period' AS kind, strftime(a, '%Y-%m-%d') AS start_date, strftime(b, '%Y-%m-%d') AS end_date FROM p
        UNION ALL SELECT person_id, role, 'gap', strftime(b + 1, '%Y-%m-%d'), strftime(nxt - 1, '%Y-%m-%d') FROM g WHERE nxt IS NOT NULL""",
}


def _split_sql(table: str, sep: str, keep: str) -> str:
    """The lines of a table cut into trimmed fields ``f``, null where the quoting is broken."""
    s = "\\" + sep if sep == "|" else sep
    one = f'"(?:[^"]|"")*"|[^"{s}][^{s}]*|'
    return f"""SELECT {keep}, CASE WHEN regexp_full_match(raw || '{sep}', '(?s)(?:(?:{one}){s})+') THEN list_transform(regexp_extract_all(raw || '{sep}', '(?s)({one}){s}', 1),
        lambda x: trim(CASE WHEN starts_with(x, '"') THEN replace(substr(x, 2, len(x) - 2), '""', '"') ELSE x END, ' ')) END AS f FROM {table}"""


def _at(layouts: list[Layout], column: str) -> str:
    """The field a column is at, by family."""
    return "CASE " + " ".join(f"WHEN family = '{x.name}' THEN f[{x.columns.index(column) + 1}]" for x in layouts if column in x.columns) + " END"


_FEC_SQL = f"""l AS ({_split_sql('fec_row', '|', 'artifact_id, source_ordinal, family, cycle')}), v AS (SELECT *, {_at(FEC_LAYOUTS, 'transaction_dt')} AS dt, {_at(FEC_LAYOUTS, 'transaction_amt')} AS amt, {_at(FEC_LAYOUTS, 'sub_id')} AS sub,
    CASE family {' '.join(f"WHEN '{x.name}' THEN {len(x.columns)}" for x in FEC_LAYOUTS)} END AS n FROM l),
    ok AS (SELECT *, coalesce(f IS NOT NULL AND (len(f) = n OR (len(f) = n + 1 AND f[n + 1] = '')) AND (dt = '' OR (regexp_full_match(dt, '[0-9]{{8}}') AND try_strptime(dt, '%m%d%Y') IS NOT NULL))
      AND regexp_full_match(amt, '[+-]?([0-9]+(\.[0-9]{{0,2}})?|\.[0-9]{{1,2}})') AND regexp_full_match(sub, '[0-9]{{19}}'), false) AS good FROM v)"""
_MEMBER_SQL = f"""m AS ({_split_sql('voteview_line', ',', 'artifact_id, source_ordinal')}), mok AS (SELECT *, coalesce(f IS NOT NULL AND len(f) = 13 AND regexp_full_match(f[1], '[0-9]+') AND regexp_full_match(f[3], '[0-9]+')
      AND (f[10] = '' OR (regexp_full_match(f[10], '[0-9]{{4}}(\.0)?') AND try_cast(f[10] AS double) BETWEEN 1700 AND 2010)) AND (f[12] = '' OR (regexp_full_match(f[12], '[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?') AND try_cast(f[12] AS double) BETWEEN -1 AND 1)), false) AS good FROM m)"""


def _typed_sql(layout: Layout) -> str:
    """The valid lines of a layout as typed columns."""
    types = {"transaction_dt": "try_strptime(nullif({}, ''), '%m%d%Y')::date", "transaction_amt": "nullif({}, '')::decimal(18,2)"}
    columns = ", ".join(types.get(c, "nullif({}, '')").format(f"f[{i}]") + f" AS {c}" for i, c in enumerate(layout.columns, 1))
    return f"SELECT artifact_id, source_ordinal, family, cycle, {columns} FROM ok WHERE good AND family = '{layout.name}'"


def _member_columns() -> str:
    types = dict.fromkeys(("congress", "state_icpsr", "district_code", "party_code", "born", "died"), "try_cast(try_cast(nullif({}, '') AS double) AS int)") | dict.fromkeys(("nominate_dim1", "nominate_dim2"), "try_cast(nullif({}, '') AS double)")
    return ", ".join(types.get(c, "nullif({}, '')").format(f"f[{i}]") + f" AS {c}" for i, c in enumerate(MEMBER, 1))


ORACLE |= {
    "p4_found": f"WITH {_FEC_SQL}, {_MEMBER_SQL} SELECT DISTINCT 'fec_row' AS table_name, artifact_id, source_ordinal FROM ok WHERE NOT good UNION SELECT DISTINCT 'voteview_line', artifact_id, source_ordinal FROM mok WHERE NOT good",
    "p4_valid_contributions": f"WITH {_FEC_SQL} {_typed_sql(FEC_LAYOUTS[0])} UNION ALL {_typed_sql(FEC_LAYOUTS[1])}",
    "p4_valid_to_candidates": f"WITH {_FEC_SQL} {_typed_sql(FEC_LAYOUTS[2])}",
    "p4_valid_expenditures": f"WITH {_FEC_SQL} {_typed_sql(FEC_LAYOUTS[3])}",
    "p4_valid_members": f"WITH {_MEMBER_SQL} SELECT artifact_id, source_ordinal, {_member_columns()} FROM mok WHERE good",
}
