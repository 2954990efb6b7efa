"""The engine's own operators, each over whole tables of the driver, with the SQL that says the same."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicloom.functions import scalars as S
from civicloom.operators import checks, identity, keyed, links, pick, reconcile
from civicloom.plans import catalog, marts
from civicloom.session import table as T
from civicloom.sources.delimited import to_stage
from civicloom.streaming.tables import sessions, windowed_counts

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


def _votes(s: SparkSession, d: str) -> DataFrame:
    flag = F.col("l_returnflag")
    position = F.when(flag == "A", "yes").when(flag == "R", "no").otherwise("other")
    return T(s, d, "lineitem").select(F.col("l_orderkey").alias("roll_call_id"), position.alias("position"), "l_suppkey", "l_partkey")


# Marts ---------------------------------------------------------------------------------------------


@query("""WITH v AS (SELECT l_orderkey, count(*) FILTER (WHERE l_returnflag = 'A') AS yea_count, count(*) FILTER (WHERE l_returnflag = 'R') AS nay_count,
    count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'R')) AS other_count, count(*) AS total_votes FROM lineitem GROUP BY 1)
    SELECT o_orderkey AS roll_call_id, o_custkey AS bill_id, o_orderstatus AS result, c_name AS bill_title, c_mktsegment AS bill_type, coalesce(yea_count, 0) AS yea_count,
    coalesce(nay_count, 0) AS nay_count, coalesce(other_count, 0) AS other_count, coalesce(total_votes, 0) AS total_votes
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN v ON l_orderkey = o_orderkey""")
def mart_roll_call_results(s: SparkSession, d: str) -> DataFrame:
    """Orders as roll calls, customers as bills, line items as votes."""
    rolls = T(s, d, "orders").select(F.col("o_orderkey").alias("roll_call_id"), F.col("o_custkey").alias("bill_id"), F.col("o_orderstatus").alias("result"))
    bills = T(s, d, "customer").select(F.col("c_custkey").alias("bill_id"), F.col("c_name").alias("bill_title"), F.col("c_mktsegment").alias("bill_type"))
    return marts.roll_call_results(rolls, bills, _votes(s, d)).select("roll_call_id", "bill_id", "result", "bill_title", "bill_type", "yea_count", "nay_count", "other_count", "total_votes")


@query("""SELECT c_nationkey AS geography_id, n_name AS geography_name, o_orderpriority AS field_id, year(o_orderdate)::int AS period_year, sum(o_totalprice::decimal(18,2))::double / count(*) AS value_numeric_avg,
    min(o_totalprice::decimal(18,2)) AS value_numeric_min, max(o_totalprice::decimal(18,2)) AS value_numeric_max, count(*) AS observation_count
    FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""")
def mart_geography_year(s: SparkSession, d: str) -> DataFrame:
    """Order totals by nation, priority and year."""
    m = T(s, d, "orders").join(T(s, d, "customer").select("c_custkey", F.col("c_nationkey").alias("geography_id")), F.col("o_custkey") == F.col("c_custkey")).withColumnRenamed("o_orderpriority", "field_id").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))
    g = T(s, d, "nation").select(F.col("n_nationkey").alias("geography_id"), F.col("n_name").alias("geography_name"))
    return marts.geography_year(m, g, "geography_id", "o_orderdate", "o_totalprice", ["field_id"], ["geography_name"])


@query("""SELECT g.geography_type, a.release_year, a.field_id, round(avg(a.value), 6)::double AS value_avg, min(a.value)::double AS value_min, max(a.value)::double AS value_max, count(*) AS observation_count
    FROM acs_bulk_estimate a JOIN geography g ON g.geography_id = a.geography_id GROUP BY ALL""")
def mart_survey_panel(s: SparkSession, d: str) -> DataFrame:
    """Survey estimates by kind of geography, release and field."""
    g = T(s, d, "geography").select("geography_id", "geography_type")
    joined = T(s, d, "acs_bulk_estimate").select("geography_id", "release_year", "field_id", "value").join(g, "geography_id")
    return joined.groupBy("geography_type", "release_year", "field_id").agg(
        F.round(F.avg("value"), 6).cast("double").alias("value_avg"), F.min("value").cast("double").alias("value_min"), F.max("value").cast("double").alias("value_max"), F.count("*").alias("observation_count")
    )


# Reconciliation ------------------------------------------------------------------------------------


@query("""SELECT o_orderpriority AS geography_type, count(*) AS boundaries, count(l.k) AS linked, count(*) FILTER (WHERE l.k IS NULL AND o_orderstatus ~ 'O+$') AS placeholder_unlinked,
    count(*) FILTER (WHERE l.k IS NULL AND NOT o_orderstatus ~ 'O+$') AS unlinked FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem) l ON k = o_orderkey GROUP BY 1""")
def conditional_link_report(s: SparkSession, d: str) -> DataFrame:
    """Orders linked to line items, per priority; status O counts as a placeholder."""
    b = T(s, d, "orders").select(F.col("o_orderpriority").alias("geography_type"), F.regexp_replace("o_orderstatus", "O", "Z").alias("code"), F.col("o_orderkey").alias("b"))
    return links.link_report(b, T(s, d, "lineitem").select(F.col("l_orderkey").alias("b")), "geography_type", "code", "b")


@query("""WITH o AS (SELECT o_orderkey AS k, (o_orderkey % 3)::bigint AS yea_total, CASE WHEN o_orderstatus <> 'P' THEN (o_orderkey % 4)::bigint END AS nay_total, CASE WHEN o_orderkey % 2 = 0 THEN (o_orderkey % 5)::bigint END AS other_total FROM orders)
    SELECT k, yea_total, nay_total, other_total, count(*) FILTER (WHERE l_returnflag = 'A') AS counted_yea_total, count(*) FILTER (WHERE l_returnflag = 'R') AS counted_nay_total, count(*) FILTER (WHERE l_returnflag = 'N') AS counted_other_total
    FROM o LEFT JOIN lineitem ON l_orderkey = k WHERE nay_total IS NOT NULL GROUP BY ALL
    HAVING count(*) FILTER (WHERE l_returnflag = 'A') <> yea_total OR count(*) FILTER (WHERE l_returnflag = 'R') <> nay_total OR (other_total IS NOT NULL AND count(*) FILTER (WHERE l_returnflag = 'N') <> other_total)""")
def tally_disagreements(s: SparkSession, d: str) -> DataFrame:
    """Official totals (made from the key) against counted line items."""
    k = F.col("o_orderkey")
    rolls = T(s, d, "orders").select(k.alias("k"), (k % 3).alias("yea_total"), F.when(F.col("o_orderstatus") != "P", k % 4).alias("nay_total"), F.when(k % 2 == 0, k % 5).alias("other_total"))
    f = F.col("l_returnflag")
    return reconcile.tally_disagreements(rolls, T(s, d, "lineitem").withColumnRenamed("l_orderkey", "k"), "k", {"yea_total": f == "A", "nay_total": f == "R", "other_total": f == "N"}, ["other_total"])


@query("""WITH e AS (SELECT c_mktsegment AS cell, CASE WHEN c_mktsegment <> 'BUILDING' THEN count(*) * 10 END AS expected FROM customer GROUP BY 1),
    l AS (SELECT c_mktsegment AS cell, count(*) AS loaded FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)
    SELECT cell, expected, coalesce(loaded, 0) AS loaded, CASE WHEN expected IS NOT NULL THEN greatest(expected - coalesce(loaded, 0), 0) END AS missing,
    CASE WHEN expected IS NOT NULL THEN greatest(coalesce(loaded, 0) - expected, 0) END AS surplus,
    CASE WHEN expected IS NULL THEN 'unknown' WHEN coalesce(loaded, 0) >= expected THEN 'complete' ELSE 'incomplete' END AS status FROM e LEFT JOIN l USING (cell)""")
def coverage_cells(s: SparkSession, d: str) -> DataFrame:
    """Expected against loaded orders per market segment."""
    c = T(s, d, "customer")
    e = c.groupBy(F.col("c_mktsegment").alias("cell")).agg(F.when(F.first("c_mktsegment") != "BUILDING", F.count("*") * 10).alias("expected"))
    l = T(s, d, "orders").join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_mktsegment").alias("cell")).agg(F.count("*").alias("loaded"))  # noqa: E741
    return reconcile.coverage_cells(e.join(l, "cell", "left"), "expected", "loaded")


@query("""SELECT (SELECT count(*) FROM lineitem) AS staged, (SELECT count(*) FROM lineitem WHERE l_returnflag = 'N' OR l_discount = 0) AS blank_side, (SELECT count(*) FROM orders) AS stored,
    (SELECT count(*) FROM orders WHERE o_orderstatus IS DISTINCT FROM 'F' AND o_totalprice > 100000) AS bad""")
def reconcile_counts(s: SparkSession, d: str) -> DataFrame:
    """Counters of several tables in one row."""
    li, o, n = T(s, d, "lineitem"), T(s, d, "orders"), F.count("*")
    return reconcile.scalar_counters({
        "staged": (li, n), "blank_side": (li.filter("l_returnflag = 'N' OR l_discount = 0"), n), "stored": (o, n),
        "bad": (o.filter(~F.col("o_orderstatus").eqNullSafe("F") & (F.col("o_totalprice") > 100000)), n),
    })


@query("""SELECT 'nation' AS t, count(*) AS n, md5(string_agg(concat_ws('|', n_nationkey, n_name, n_regionkey), chr(10) ORDER BY n_nationkey)) AS h FROM nation
    UNION ALL SELECT 'supplier', count(*), md5(string_agg(concat_ws('|', s_suppkey, s_name, s_nationkey), chr(10) ORDER BY s_suppkey)) FROM supplier""")
def fingerprint(s: SparkSession, d: str) -> DataFrame:
    """Row counts and digests of ordered rows."""
    parts = [reconcile.fingerprint(T(s, d, t), c, c[:1], t) for t, c in (("nation", ["n_nationkey", "n_name", "n_regionkey"]), ("supplier", ["s_suppkey", "s_name", "s_nationkey"]))]
    return parts[0].unionByName(parts[1])


@query()
def content_hashes(s: SparkSession, d: str) -> DataFrame:
    """Order-independent digests of the fact table by release."""
    return reconcile.content_hash(T(s, d, "acs_bulk_estimate"), ["acs_bulk_estimate_id", "geography_id", "field_id", "value"], ["release_year"])


@query("""SELECT c_mktsegment AS part, CASE WHEN count(*) FILTER (WHERE c_acctbal < 0) = 0 THEN round(sum(c_acctbal), 2) END AS total FROM customer GROUP BY 1""")
def unknown_total(s: SparkSession, d: str) -> DataFrame:
    """A total that is unknown if any part is."""
    known = T(s, d, "customer").select("c_mktsegment", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("x"))
    return known.groupBy(F.col("c_mktsegment").alias("part")).agg(F.round(reconcile.known_total("x"), 2).alias("total"))


@query("""WITH t AS (SELECT y, make_date(y, 1, 3) AS a, make_date(y + 2, 1, 3) AS b FROM range(1995, 2002, 2) r(y)), s AS (SELECT o_orderkey, o_orderdate::date AS f, max(l_shipdate)::date AS u FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2)
    SELECT o_orderkey, f AS start_date, u AS end_date, a AS term_start FROM s JOIN t ON f < b AND coalesce(u, DATE '9999-12-31') > a""")
def interval_overlap(s: SparkSession, d: str) -> DataFrame:
    """Orders and the two-year terms their time overlaps."""
    shipped = T(s, d, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").cast("date").alias("end_date"))
    spans = T(s, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("start_date")).join(shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", "start_date", "end_date")
    return reconcile.overlapping_terms(spans, "start_date", "end_date", 2, 1995, 2001, 1, 3)


@query("""SELECT m.membership_id, c.n::int AS congress FROM membership m JOIN (SELECT n, make_date(1787 + 2 * n, 1, 3) AS a, make_date(1789 + 2 * n, 1, 3) AS b FROM range(1, 121) r(n)) c
    ON m.start_date < c.b AND coalesce(m.end_date, DATE '9999-12-31') > c.a WHERE m.start_date IS NOT NULL""")
def membership_congresses(s: SparkSession, d: str) -> DataFrame:
    """Every congress a term overlaps."""
    out = reconcile.overlapping_terms(T(s, d, "membership").select("membership_id", "start_date", "end_date"), "start_date", "end_date", 2, 1789, 2027, 1, 3)
    return out.select("membership_id", ((F.year("term_start") - 1787) / 2).cast("int").alias("congress"))


# Picking -------------------------------------------------------------------------------------------


@query("SELECT user_id, event_id, ts, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) = 1")
def distinct_on_latest(s: SparkSession, d: str) -> DataFrame:
    """The last event of each user."""
    return pick.distinct_on(T(s, d, "events").select("user_id", "event_id", "ts", "event_type"), ["user_id"], [F.desc("ts"), F.asc("event_id")])


@query("SELECT user_id, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN event_type <> 'error' THEN 0 ELSE 1 END, event_id DESC NULLS LAST) = 1")
def latest_usable(s: SparkSession, d: str) -> DataFrame:
    """The newest event that isn't an error, else the newest."""
    return pick.latest_per_key(T(s, d, "events").select("user_id", "event_id", "value", "event_type"), ["user_id"], "event_id", F.col("event_type") != "error").select("user_id", "event_id", "value")


_RANK = "(VALUES ('official', 'BUILDING', 1), ('official', 'MACHINERY', 2), ('common', 'HOUSEHOLD', 1), ('common', 'FURNITURE', 2)) r(name_kind, dataset_id, rank)"


def _ranking(s: SparkSession) -> DataFrame:
    return s.createDataFrame([("official", "BUILDING", 1), ("official", "MACHINERY", 2), ("common", "HOUSEHOLD", 1), ("common", "FURNITURE", 2)], "name_kind string, dataset_id string, rank int")


def _assertions(s: SparkSession, d: str) -> DataFrame:
    return T(s, d, "customer").select(F.col("c_nationkey").alias("entity"), F.when(F.col("c_custkey") % 2 == 0, "official").otherwise("common").alias("name_kind"), F.col("c_mktsegment").alias("dataset_id"), F.substring("c_name", 17, 2).alias("source_vintage"), F.col("c_name").alias("full_name"))


_ASSERTIONS = "(SELECT c_nationkey AS entity, CASE WHEN c_custkey % 2 = 0 THEN 'official' ELSE 'common' END AS name_kind, c_mktsegment AS dataset_id, substr(c_name, 17, 2) AS source_vintage, c_name AS full_name FROM customer) a"


@query(f"""SELECT entity, name_kind, dataset_id, source_vintage, full_name FROM {_ASSERTIONS} JOIN {_RANK} USING (name_kind, dataset_id) JOIN (VALUES ('official', 2), ('common', 1)) p(name_kind, position) USING (name_kind)
    QUALIFY row_number() OVER (PARTITION BY entity ORDER BY position, rank, source_vintage DESC, dataset_id, full_name) = 1""")
def precedence_winner(s: SparkSession, d: str) -> DataFrame:
    """The winning name of each nation by kind, rank, vintage and ties."""
    display = s.createDataFrame([("official", 2), ("common", 1)], "name_kind string, position int")
    return pick.precedence_winner(_assertions(s, d), _ranking(s), display, "entity", ties=["full_name"]).select("entity", "name_kind", "dataset_id", "source_vintage", "full_name")


@query(f"""SELECT CASE WHEN dataset_id NOT IN (SELECT dataset_id FROM {_RANK}) THEN 'dataset' WHEN name_kind NOT IN (SELECT name_kind FROM {_RANK}) OR name_kind <> 'official' THEN 'name_kind' ELSE 'dataset_kind' END AS reason,
    dataset_id, name_kind, assertions FROM (SELECT dataset_id, name_kind, count(*) AS assertions FROM {_ASSERTIONS} GROUP BY 1, 2) WHERE (name_kind, dataset_id) NOT IN (SELECT name_kind, dataset_id FROM {_RANK}) OR name_kind <> 'official'""")
def unranked_reason(s: SparkSession, d: str) -> DataFrame:
    """Assertions no rank covers, with the first reason."""
    counts = _assertions(s, d).groupBy("dataset_id", "name_kind").agg(F.count("*").alias("assertions"))
    display = s.createDataFrame([("official", 1)], "name_kind string, position int")
    return pick.unranked(counts, _ranking(s), display, "name_kind", "dataset_id").select("reason", "dataset_id", "name_kind", "assertions")


@query("SELECT p_brand || '/' || p_size AS code, CASE WHEN count(DISTINCT p_partkey) = 1 THEN min(p_partkey) END AS p_partkey FROM part GROUP BY 1")
def exactly_one_link(s: SparkSession, d: str) -> DataFrame:
    """The part of a brand and size where there is but one."""
    return pick.exactly_one(T(s, d, "part").select(F.concat("p_brand", F.lit("/"), F.col("p_size").cast("string")).alias("code"), "p_partkey"), "code", "p_partkey")


# Keyed maintenance ---------------------------------------------------------------------------------

_SOURCE = "(SELECT c_custkey + (c_custkey % 3) * 1000000 AS k, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE upper(c_mktsegment) || '!' END AS seg, c_acctbal + 1 AS bal, c_nationkey AS nat FROM customer WHERE c_custkey % 4 < 3)"
_TARGET = "(SELECT c_custkey AS k, c_mktsegment AS seg, c_acctbal AS bal, c_nationkey AS nat FROM customer WHERE c_custkey % 2 = 0)"


def _table(s: SparkSession, d: str) -> DataFrame:
    return T(s, d, "customer").filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("seg"), F.col("c_acctbal").alias("bal"), F.col("c_nationkey").alias("nat"))


def _rows(s: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    return T(s, d, "customer").filter("c_custkey % 4 < 3").select((k + (k % 3) * 1000000).alias("k"), F.when(k % 5 != 0, F.concat(F.upper("c_mktsegment"), F.lit("!"))).alias("seg"), (F.col("c_acctbal") + 1).alias("bal"), F.col("c_nationkey").alias("nat"))


@query(f"SELECT * FROM {_TARGET} UNION ALL SELECT * FROM {_SOURCE} s WHERE NOT EXISTS (SELECT 1 FROM {_TARGET} t WHERE t.k = s.k)")
def insert_absent(s: SparkSession, d: str) -> DataFrame:
    """Insert what isn't there."""
    return keyed.insert_absent(_table(s, d), _rows(s, d), ["k"])


@query(f"SELECT coalesce(s.k, t.k) AS k, CASE WHEN s.k IS NULL THEN t.seg ELSE s.seg END AS seg, CASE WHEN s.k IS NULL THEN t.bal ELSE s.bal END AS bal, CASE WHEN s.k IS NULL THEN t.nat ELSE s.nat END AS nat FROM {_TARGET} t FULL JOIN {_SOURCE} s ON s.k = t.k")
def upsert_overwrite(s: SparkSession, d: str) -> DataFrame:
    """Rows that arrive replace those there."""
    return keyed.upsert(_table(s, d), _rows(s, d), ["k"])


@query(f"""SELECT coalesce(s.k, t.k) AS k, coalesce(s.seg, t.seg) AS seg, CASE WHEN s.k IS NOT NULL AND t.k IS NOT NULL THEN t.bal + s.bal ELSE coalesce(t.bal, s.bal) END AS bal,
    CASE WHEN s.k IS NOT NULL AND t.k IS NOT NULL THEN NULL ELSE coalesce(t.nat, s.nat) END AS nat FROM {_TARGET} t FULL JOIN {_SOURCE} s ON s.k = t.k""")
def upsert_mixed(s: SparkSession, d: str) -> DataFrame:
    """A policy per column: known new value, sum, emptied."""
    return keyed.upsert(_table(s, d), _rows(s, d), ["k"], {"seg": "new_if_known", "bal": "add", "nat": "null"})


@query(f"SELECT coalesce(s.k, t.k) AS k, coalesce(t.seg, s.seg) AS seg, coalesce(t.bal, s.bal) AS bal, coalesce(t.nat, s.nat) AS nat FROM {_TARGET} t FULL JOIN {_SOURCE} s ON s.k = t.k")
def upsert_keep_known(s: SparkSession, d: str) -> DataFrame:
    """Values there win."""
    return keyed.upsert(_table(s, d), _rows(s, d), ["k"], default="old_if_known")


@query(f"SELECT s.*, CASE WHEN t.k IS NULL THEN 'insert' WHEN (s.seg, s.bal) IS DISTINCT FROM (t.seg, t.bal) THEN 'update' ELSE 'unchanged' END AS action FROM (SELECT k, CASE WHEN k % 3 = 0 THEN seg || '?' ELSE seg END AS seg, bal, nat FROM (SELECT c_custkey AS k, c_mktsegment AS seg, c_acctbal AS bal, c_nationkey AS nat FROM customer)) s LEFT JOIN {_TARGET} t ON t.k = s.k")
def diff_action(s: SparkSession, d: str) -> DataFrame:
    """What each arriving row would do."""
    all_ = T(s, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("seg"), F.col("c_acctbal").alias("bal"), F.col("c_nationkey").alias("nat"))
    return keyed.diff_action(_table(s, d), all_.withColumn("seg", F.when(F.col("k") % 3 == 0, F.concat("seg", F.lit("?"))).otherwise(F.col("seg"))), ["k"], ["seg", "bal"])


@query("""SELECT l_orderkey, l_linenumber, l_suppkey, l_returnflag FROM lineitem WHERE l_returnflag <> 'N' OR (l_orderkey, l_suppkey) IN (SELECT l_orderkey, l_suppkey FROM lineitem WHERE l_quantity > 25)""")
def delete_absent(s: SparkSession, d: str) -> DataFrame:
    """Within a scope, rows the snapshot lacks go."""
    li = T(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_quantity")
    return keyed.delete_absent(li.drop("l_quantity"), li.filter("l_quantity > 25"), ["l_orderkey", "l_suppkey"], F.col("l_returnflag") == "N")


@query("""WITH r AS (SELECT l_orderkey AS k, max(l_linenumber) AS m FROM lineitem WHERE l_orderkey % 3 = 0 GROUP BY 1)
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem LEFT JOIN r ON k = l_orderkey WHERE k IS NULL OR l_linenumber = m""")
def supersede(s: SparkSession, d: str) -> DataFrame:
    """Of rewritten parents only the current version's children stay."""
    li = T(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    now = li.filter("l_orderkey % 3 = 0").groupBy("l_orderkey").agg(F.max("l_linenumber").alias("current_artifact"))
    return keyed.supersede(li, "l_orderkey", "l_linenumber", now)


@query("SELECT user_id, event_type, sum(n) AS seen_count FROM (SELECT user_id, event_type, 1 AS n FROM events UNION ALL SELECT DISTINCT user_id, event_type, 100 FROM events WHERE user_id % 2 = 0) GROUP BY 1, 2")
def accumulate(s: SparkSession, d: str) -> DataFrame:
    """Counters that grow with what is seen."""
    e = T(s, d, "events")
    before = e.filter("user_id % 2 = 0").select("user_id", "event_type").distinct().withColumn("seen_count", F.lit(100).cast("bigint"))
    return keyed.accumulate(before, e.select("user_id", "event_type", F.lit(1).cast("bigint").alias("seen_count")), ["user_id", "event_type"], "seen_count")


@query("SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END, m) AS person_id, o_orderpriority FROM orders LEFT JOIN (SELECT o_orderpriority AS p, min(o_custkey) AS m FROM orders GROUP BY 1) ON p = o_orderpriority")
def fill_from_lookup(s: SparkSession, d: str) -> DataFrame:
    """Nulls filled from another table."""
    o = T(s, d, "orders")
    rows = o.select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey")).alias("person_id"), "o_orderpriority")
    return keyed.fill_from(rows, o.groupBy("o_orderpriority").agg(F.min("o_custkey").alias("person_id")), ["o_orderpriority"], "person_id")


@query("""WITH m AS (SELECT l_orderkey, l_suppkey AS old, CASE WHEN l_suppkey % 10 = 1 THEN l_suppkey - 1 ELSE l_suppkey END AS new, l_linenumber FROM lineitem)
    SELECT l_orderkey, l_linenumber, new AS l_suppkey FROM m QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber, new ORDER BY old <> new, old) = 1 OR old = new""")
def remap_merge(s: SparkSession, d: str) -> DataFrame:
    """Suppliers merged into survivors."""
    sup = T(s, d, "supplier").filter("s_suppkey % 10 = 1").select(F.col("s_suppkey").alias("dup"), (F.col("s_suppkey") - 1).alias("keep"))
    return keyed.remap(T(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey"), "l_suppkey", sup, "dup", "keep", ["l_orderkey", "l_linenumber", "l_suppkey"])[0]


# Identity ------------------------------------------------------------------------------------------


@query("""WITH wanted AS (SELECT bioguide, min(new_person_id) AS new_person_id FROM legislator_stage GROUP BY 1),
    owners AS (SELECT s.bioguide, i.person_id FROM legislator_stage s JOIN person_identifier i ON i.namespace = s.namespace AND i.external_id = s.external_id
      UNION SELECT w.bioguide, i.person_id FROM wanted w JOIN person_identifier i ON i.namespace = 'bioguide' AND i.external_id = w.bioguide),
    summary AS (SELECT w.bioguide, w.new_person_id, coalesce(list(o.person_id ORDER BY o.person_id) FILTER (WHERE o.person_id IS NOT NULL), []) AS owner_ids FROM wanted w LEFT JOIN owners o ON o.bioguide = w.bioguide GROUP BY ALL),
    shared AS (SELECT owner_ids[1] AS o FROM summary WHERE len(owner_ids) = 1 GROUP BY 1 HAVING count(*) > 1)
    SELECT bioguide, new_person_id, array_to_string(owner_ids, ',') AS owners, CASE WHEN len(owner_ids) = 0 THEN 'new' WHEN len(owner_ids) > 1 THEN 'multiple_owners' WHEN owner_ids[1] IN (SELECT o FROM shared) THEN 'bioguide_mismatch'
      WHEN EXISTS (SELECT 1 FROM person_identifier b WHERE b.person_id = owner_ids[1] AND b.namespace = 'bioguide' AND b.external_id <> bioguide) THEN 'bioguide_mismatch' ELSE 'matched' END AS outcome,
      coalesce(owner_ids[1], new_person_id) AS person_id FROM summary""")
def identity_groups(s: SparkSession, d: str) -> DataFrame:
    """Who staged legislators are, by identifiers."""
    out = identity.resolve_groups(T(s, d, "legislator_stage"), T(s, d, "person_identifier"))
    return out.select("bioguide", "new_person_id", F.array_join("owner_ids", ",").alias("owners"), "outcome", "person_id")


def _known_numbers(s: SparkSession, d: str) -> DataFrame:
    owned = T(s, d, "person_identifier").filter("namespace = 'bioguide'").select("person_id", "namespace", "external_id")
    numbered = owned.filter(F.col("external_id").rlike("[05]$")).select("person_id", F.lit("icpsr").alias("namespace"), F.concat(F.lit("10"), F.substring("external_id", 5, 4)).alias("external_id"))
    return owned.unionByName(numbered)


_IDS = "(SELECT person_id, namespace, external_id FROM person_identifier WHERE namespace = 'bioguide' UNION ALL SELECT person_id, 'icpsr', '10' || substr(external_id, 5, 4) FROM person_identifier WHERE namespace = 'bioguide' AND external_id ~ '[05]$')"


@query(f"""WITH ids AS {_IDS}, num AS (SELECT external_id AS icpsr, list(DISTINCT person_id) AS people FROM ids WHERE namespace = 'icpsr' GROUP BY 1), gd AS (SELECT external_id AS g, list(DISTINCT person_id) AS people FROM ids WHERE namespace = 'bioguide' GROUP BY 1),
    bios AS (SELECT v.congress, v.chamber, v.icpsr, v.bioguide_id, nullif(trim(v.bioguide_id), '') AS g, num.people AS np, gd.people AS gp FROM voteview_member v LEFT JOIN num ON num.icpsr = v.icpsr LEFT JOIN gd ON gd.g = nullif(trim(v.bioguide_id), '')),
    known AS (SELECT person_id, list(DISTINCT external_id) AS gs FROM ids WHERE namespace = 'bioguide' GROUP BY 1),
    claimed AS (SELECT DISTINCT icpsr, gp[1] AS p FROM bios WHERE len(gp) = 1 AND np IS NULL AND gp[1] NOT IN (SELECT person_id FROM ids WHERE namespace = 'icpsr')),
    amb AS (SELECT icpsr FROM claimed GROUP BY 1 HAVING count(DISTINCT p) > 1 UNION SELECT a.icpsr FROM claimed a JOIN claimed b ON a.p = b.p AND a.icpsr <> b.icpsr),
    safe AS (SELECT * FROM claimed WHERE icpsr NOT IN (SELECT icpsr FROM amb))
    SELECT b.congress, b.chamber, b.icpsr, b.bioguide_id, CASE WHEN len(np) = 1 AND (g IS NULL OR k.gs IS NULL OR list_contains(k.gs, b.bioguide_id)) THEN np[1] WHEN s.p IS NOT NULL AND len(gp) = 1 AND gp[1] = s.p THEN s.p END AS person_id
    FROM bios b LEFT JOIN known k ON k.person_id = np[1] AND len(np) = 1 LEFT JOIN safe s ON s.icpsr = b.icpsr""")
def icpsr_linking(s: SparkSession, d: str) -> DataFrame:
    """Members linked by number or by an agreeing guide, never ambiguously."""
    rows = T(s, d, "voteview_member").select("congress", "chamber", "icpsr", F.col("bioguide_id").alias("bioguide"))
    return identity.link_numbers(rows, _known_numbers(s, d))[0].withColumnRenamed("bioguide", "bioguide_id")


@query("SELECT namespace, external_id, min(new_person_id) AS new_person_id FROM legislator_stage GROUP BY 1, 2 HAVING count(DISTINCT new_person_id) = 1")
def unconflicted_identifiers(s: SparkSession, d: str) -> DataFrame:
    """Identifiers one person claims."""
    return identity.drop_conflicted(T(s, d, "legislator_stage").select("namespace", "external_id", "new_person_id"), "new_person_id")[0]


@query("SELECT bioguide, office_key, phone, count(DISTINCT bioguide) OVER (PARTITION BY phone) > 1 AS shared FROM profile_office WHERE phone IS NOT NULL")
def shared_contacts(s: SparkSession, d: str) -> DataFrame:
    """Telephone numbers two people share."""
    return identity.shared_values(T(s, d, "profile_office").filter("phone IS NOT NULL").select("bioguide", "office_key", "phone"), "bioguide", ["phone"])


# Joins and sets ------------------------------------------------------------------------------------


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def anti_join(s: SparkSession, d: str) -> DataFrame:
    """Orders without line items."""
    return T(s, d, "orders").select("o_orderkey").join(T(s, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti")


@query("SELECT namespace, external_id, bioguide FROM legislator_stage WHERE (namespace, external_id) IN (SELECT namespace, external_id FROM person_identifier)")
def tuple_semi_join(s: SparkSession, d: str) -> DataFrame:
    """Staged identifiers that are known."""
    return keyed.present(T(s, d, "legislator_stage").select("namespace", "external_id", "bioguide"), T(s, d, "person_identifier"), ["namespace", "external_id"])


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'A') OR NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
def either_absent(s: SparkSession, d: str) -> DataFrame:
    """Orders that lack one of two kinds of items: both flags in one aggregate, then one join."""
    f = T(s, d, "lineitem").groupBy("l_orderkey").agg(F.max(F.col("l_returnflag") == "A").alias("a"), F.max(F.col("l_returnflag") == "R").alias("r"))
    both = f.filter("a AND r").select("l_orderkey")
    return T(s, d, "orders").select("o_orderkey").join(both, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti")


@query("SELECT a.l_orderkey, a.l_linenumber AS old_version, b.l_linenumber AS new_version FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_suppkey = b.l_suppkey AND a.l_linenumber < b.l_linenumber")
def self_join_versions(s: SparkSession, d: str) -> DataFrame:
    """Older versions beside newer ones of one key."""
    li = T(s, d, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber")
    return li.withColumnRenamed("l_linenumber", "old_version").join(li.withColumnRenamed("l_linenumber", "new_version"), ["l_orderkey", "l_suppkey"]).filter("old_version < new_version").drop("l_suppkey")


@query("SELECT c_custkey, n_nationkey, n_name FROM customer JOIN nation ON substr(c_name, 17, 2) = lpad(n_nationkey::varchar, 2, '0')")
def computed_key_join(s: SparkSession, d: str) -> DataFrame:
    """A join on keys both sides derive."""
    c = T(s, d, "customer").select("c_custkey", F.substring("c_name", 17, 2).alias("k"))
    n = T(s, d, "nation").select("n_nationkey", "n_name", F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("k"))
    return c.join(n, "k").drop("k")


@query("SELECT 'customer' AS kind, c_nationkey AS nation, count(*) AS n FROM customer GROUP BY 2 UNION ALL SELECT 'supplier', s_nationkey, count(*) FROM supplier GROUP BY 2")
def union_tagged(s: SparkSession, d: str) -> DataFrame:
    """Two aggregates under tags."""
    part = lambda t, k, p: T(s, d, t).groupBy(F.col(k).alias("nation")).agg(F.count("*").alias("n")).withColumn("kind", F.lit(p))
    return part("customer", "c_nationkey", "customer").unionByName(part("supplier", "s_nationkey", "supplier"))


@query("""(SELECT 'intersect' AS op, x FROM (SELECT c_nationkey AS x FROM customer INTERSECT SELECT s_nationkey FROM supplier)) UNION ALL (SELECT 'except', x FROM (SELECT n_nationkey AS x FROM nation EXCEPT SELECT c_nationkey FROM customer WHERE c_acctbal > 9000))
    UNION ALL (SELECT 'union', x FROM (SELECT c_nationkey AS x FROM customer UNION SELECT s_nationkey FROM supplier))""")
def set_operations(s: SparkSession, d: str) -> DataFrame:
    """Intersection, difference and union of keys."""
    c, p, n = T(s, d, "customer").select(F.col("c_nationkey").alias("x")), T(s, d, "supplier").select(F.col("s_nationkey").alias("x")), T(s, d, "nation").select(F.col("n_nationkey").alias("x"))
    rich = T(s, d, "customer").filter("c_acctbal > 9000").select(F.col("c_nationkey").alias("x"))
    tag = lambda df, op: df.withColumn("op", F.lit(op))
    return reduce(DataFrame.unionByName, [tag(c.intersect(p), "intersect"), tag(n.exceptAll(rich.distinct()).distinct(), "except"), tag(c.union(p).distinct(), "union")])


@query("""SELECT l_suppkey AS x, count(*) FILTER (WHERE l_returnflag = 'A') > 0 AS a, count(*) FILTER (WHERE l_returnflag = 'R') AS r, count(DISTINCT l_orderkey) AS orders, count(l_partkey) AS parts, array_to_string(list_sort(list(DISTINCT l_returnflag)), ',') AS flags,
    max(l_quantity) AS most FROM lineitem GROUP BY 1""")
def grouped_aggregates(s: SparkSession, d: str) -> DataFrame:
    """Conditional, distinct and array aggregates in one pass."""
    f = F.col("l_returnflag")
    return T(s, d, "lineitem").groupBy(F.col("l_suppkey").alias("x")).agg(
        (F.count_if(f == "A") > 0).alias("a"), F.count_if(f == "R").alias("r"), F.countDistinct("l_orderkey").alias("orders"), F.count("l_partkey").alias("parts"), F.array_join(F.array_sort(F.collect_set(f)), ",").alias("flags"), F.max("l_quantity").alias("most")
    )


@query("SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(s: SparkSession, d: str) -> DataFrame:
    """Keys that occur more than once."""
    return checks.unique(T(s, d, "events").select("user_id", "event_type"), ["user_id", "event_type"])


@query("SELECT address, count(DISTINCT bioguide) AS people FROM profile_office WHERE address IS NOT NULL GROUP BY 1 HAVING count(DISTINCT bioguide) > 1")
def ambiguous_keys(s: SparkSession, d: str) -> DataFrame:
    """Addresses of several people."""
    return T(s, d, "profile_office").filter("address IS NOT NULL").groupBy("address").agg(F.countDistinct("bioguide").alias("people")).filter("people > 1")


@query("""SELECT 'not_null' AS rule, count(*) AS n FROM membership WHERE start_date IS NULL OR organization_id IS NULL UNION ALL SELECT 'accepted', count(*) FROM voteview_member WHERE chamber NOT IN ('House', 'Senate')
    UNION ALL SELECT 'relationship', count(*) FROM membership WHERE person_id NOT IN (SELECT person_id FROM person) UNION ALL SELECT 'unique', count(*) FROM (SELECT 1 FROM legislator_stage GROUP BY namespace, external_id HAVING count(*) > 1)""")
def data_tests(s: SparkSession, d: str) -> DataFrame:
    """How many rows break each rule."""
    m = T(s, d, "membership")
    found = {
        "not_null": checks.not_null(m, ["start_date", "organization_id"]), "accepted": checks.accepted_values(T(s, d, "voteview_member"), "chamber", ["House", "Senate"]),
        "relationship": checks.relationship(m, "person_id", T(s, d, "person"), "person_id"), "unique": checks.unique(T(s, d, "legislator_stage"), ["namespace", "external_id"]),
    }
    return reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("n")).withColumn("rule", F.lit(r)) for r, df in found.items()])


# Scalars and parsing -------------------------------------------------------------------------------


@query("""SELECT c_custkey, CASE WHEN substr(c_name, 10) ~ '^-?[0-9]+$' THEN substr(c_name, 10)::bigint END AS whole, CASE WHEN c_mktsegment ~ '^-?[0-9]+$' THEN 1 END AS none,
    c_custkey || CASE WHEN c_custkey % 100 BETWEEN 10 AND 20 THEN 'th' WHEN c_custkey % 10 = 1 THEN 'st' WHEN c_custkey % 10 = 2 THEN 'nd' WHEN c_custkey % 10 = 3 THEN 'rd' ELSE 'th' END AS nth,
    trim(regexp_replace(lower(c_name), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM customer""")
def guarded_cast(s: SparkSession, d: str) -> DataFrame:
    """Casts that can't fail, ordinals and slugs."""
    return T(s, d, "customer").select("c_custkey", S.guarded_int(F.expr("substr(c_name, 10)")).alias("whole"), S.guarded_int(F.col("c_mktsegment")).cast("int").alias("none"), S.ordinal(F.col("c_custkey")).alias("nth"), S.slug(F.col("c_name")).alias("slug"))


@query("""SELECT bioguide, chamber, congress_day, place FROM (SELECT DISTINCT bioguide, chamber, first_term_start AS congress_day, CASE WHEN chamber = 'sen' THEN 'ocd-division/country:us/state:' || lower(state) ELSE 'ocd-division/country:us/state:' || lower(state) || '/cd:' || 'at-large' END AS place FROM legislator_stage)""")
def term_places(s: SparkSession, d: str) -> DataFrame:
    """The division of each term's post."""
    rows = T(s, d, "legislator_stage").select("bioguide", "chamber", F.col("first_term_start").alias("congress_day"), "state").distinct()
    return rows.select("bioguide", "chamber", "congress_day", S.term_place(F.col("chamber"), F.col("state"), F.lit(0)).alias("place")).distinct()


@query("""SELECT p_partkey, k AS year, v AS value FROM (SELECT p_partkey, unnest([2020, 2021, 2022]) AS k, unnest([p_size, p_size * 2, CASE WHEN p_size > 25 THEN p_size * 3 END]) AS v FROM part) WHERE v IS NOT NULL""")
def unpivot_years(s: SparkSession, d: str) -> DataFrame:
    """Wide year columns as rows, through the stage map."""
    wide = T(s, d, "part").select("p_partkey", F.col("p_size").alias("v2020"), (F.col("p_size") * 2).alias("v2021"), F.when(F.col("p_size") > 25, F.col("p_size") * 3).alias("v2022"))
    staged = to_stage(wide, "a").select(F.col("raw")["p_partkey"].try_cast("bigint").alias("p_partkey"), F.explode("raw").alias("k", "v"))
    return staged.filter(F.col("k").rlike("^v[0-9]{4}$")).select("p_partkey", F.substring("k", 2, 4).cast("int").alias("year"), S.guarded_int(F.col("v")).cast("int").alias("value")).filter("value IS NOT NULL")


@query("SELECT event_id, (props->>'k')::bigint AS k, event_type || '-' || lpad(props->>'k', 4, '0') AS code FROM events")
def json_fields(s: SparkSession, d: str) -> DataFrame:
    """Fields of JSON text, and a padded code."""
    k = F.get_json_object("props", "$.k")
    return T(s, d, "events").select("event_id", S.guarded_int(k).alias("k"), F.concat("event_type", F.lit("-"), F.lpad(k, 4, "0")).alias("code"))


@query("SELECT geoid, name, raw->>'STUSPS' AS postal, state_fips || CASE WHEN layer = 'cd119' THEN substr(geoid, 3) ELSE '' END AS code, count(*) AS staged FROM tiger_feature GROUP BY ALL")
def staged_features(s: SparkSession, d: str) -> DataFrame:
    """Features with codes from their attributes."""
    code = F.concat("state_fips", F.when(F.col("layer") == "cd119", F.expr("substr(geoid, 3)")).otherwise(""))
    return T(s, d, "tiger_feature").groupBy("geoid", "name", F.get_json_object("raw", "$.STUSPS").alias("postal"), code.alias("code")).agg(F.count("*").alias("staged"))


@query("""WITH st AS (SELECT DISTINCT lower(raw->>'STUSPS') AS postal, state_fips AS fips FROM tiger_feature WHERE layer = 'state'),
    cand AS (SELECT g.geography_id AS division_id, st.fips || substr(g.geoid, 3, 2) AS geoid FROM geography g JOIN st ON st.fips = g.state_fips WHERE g.geography_type = 'congressional_district')
    SELECT c.division_id, f.geoid AS boundary_id, 'legal_boundary' AS relationship_kind FROM cand c JOIN (SELECT DISTINCT geoid FROM tiger_feature WHERE layer = 'cd119') f ON f.geoid = c.geoid""")
def division_links(s: SparkSession, d: str) -> DataFrame:
    """Divisions linked to boundaries by code."""
    f = T(s, d, "tiger_feature")
    states = f.filter("layer = 'state'").select(F.lower(F.get_json_object("raw", "$.STUSPS")).alias("postal"), F.col("state_fips").alias("fips")).distinct()
    g = T(s, d, "geography").filter("geography_type = 'congressional_district'").join(states, F.col("state_fips") == F.col("fips"))
    number = F.regexp_replace(F.substring("geoid", 3, 2), "^0(?=[1-9])", "")
    divisions = g.select(F.col("geography_id").alias("division_id"), F.concat(F.lit("ocd-division/country:us/state:"), "postal", F.lit("/cd:"), number).alias("ocd_division_id"))
    boundaries = f.filter("layer = 'cd119'").select(F.col("geoid").alias("boundary_id"), F.lit("congressional_district").alias("geography_type"), "geoid").distinct()
    return links.link_divisions(divisions, states, boundaries)


# Catalog -------------------------------------------------------------------------------------------


@query("SELECT 'lang' AS facet, lang AS value, count(*) AS n FROM documents GROUP BY 2 UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY 2")
def document_facets(s: SparkSession, d: str) -> DataFrame:
    """Documents by language and by source."""
    return catalog.facets(T(s, d, "documents"), ["lang", "source"])


@query("SELECT doc_id FROM documents WHERE contains(lower(coalesce(text, '')), 'committee') AND contains(lower(coalesce(text, '')), 'budget')")
def all_terms_search(s: SparkSession, d: str) -> DataFrame:
    """Documents with every word of a query."""
    return T(s, d, "documents").filter(S.all_terms(F.col("text"), "Committee budget")).select("doc_id")


@query("""SELECT doc_id FROM (SELECT doc_id, ' ' || regexp_replace(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+', ' ', 'g') || ' ' AS t FROM documents) WHERE (contains(t, ' tax credit ') AND NOT contains(t, ' governor ')) OR contains(t, ' vacatur ')""")
def web_search(s: SparkSession, d: str) -> DataFrame:
    """A search-box query with a phrase, an exclusion and an alternative."""
    return T(s, d, "documents").filter(S.web_query(F.col("text"), '"tax credit" -governor or vacatur')).select("doc_id")


@query("SELECT event_id, user_id FROM events WHERE event_id > 500 ORDER BY event_id LIMIT 100")
def keyset_page(s: SparkSession, d: str) -> DataFrame:
    """The next hundred events after a key (the page is the feature)."""
    return catalog.page_after(T(s, d, "events").select("event_id", "user_id"), "event_id", 500, 100)


@query("""SELECT user_id AS plan_id, (user_id % 10 + 1)::int AS cadence_days, u AS updated_at FROM (SELECT DISTINCT user_id FROM events) LEFT JOIN (SELECT user_id AS v, max(ts) AS u FROM events WHERE event_type = 'click' GROUP BY 1) ON v = user_id
    WHERE u IS NULL OR epoch(TIMESTAMP '2024-02-05') - floor(epoch(u)) >= (user_id % 10 + 1) * 86400""")
def due_plans(s: SparkSession, d: str) -> DataFrame:
    """Plans whose cadence has passed."""
    e = T(s, d, "events")
    plans = e.select(F.col("user_id").alias("plan_id")).distinct().withColumn("cadence_days", (F.col("plan_id") % 10 + 1).cast("int"))
    done = e.filter("event_type = 'click'").groupBy(F.col("user_id").alias("plan_id")).agg(F.max("ts").alias("updated_at"))
    return catalog.plans_due(plans, done, F.lit("2024-02-05 00:00:00").cast("timestamp_ntz"))


# Streaming (an extension), over the table as a bounded input ----------------------------------------


@query("SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def hourly_windows(s: SparkSession, d: str) -> DataFrame:
    """Events per hour and type."""
    return windowed_counts(T(s, d, "events"), "ts", "event_type", "value").withColumn("total", F.round("total", 4)).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("""WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events), g AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e)
    SELECT min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, user_id, count(*) AS n FROM g GROUP BY user_id, k""")
def user_sessions(s: SparkSession, d: str) -> DataFrame:
    """Sessions of each user."""
    out = sessions(T(s, d, "events"), "ts", "user_id")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")})
