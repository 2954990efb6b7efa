from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from civicloom.operators.membership_filter import build_filter, might_contain
from civicloom.operators.references import Reference, dangling, dangling_counts
from civicloom.operators.skew import block_join, salted_join

T1, T2, T3 = datetime(2026, 1, 1), datetime(2026, 2, 1), datetime(2026, 3, 1)
PARENT = "k string, loaded_at timestamp_ntz, deleted_at timestamp_ntz, extra int"


def run(spark, rows, parents, limit):
    child = spark.createDataFrame(rows, "id string, ref string, at timestamp_ntz, y int, key int, found string")
    ref = Reference("child", "ref", "id", ("ref",), "at", F.col("y"), "parent", ("k",))
    return dangling(child, spark.createDataFrame(parents, PARENT), ref, limit)


def test_reasons_by_broadcast_and_by_shuffle(spark):
    parents = [("A", T1, None, 1), ("b", T3, None, 1), ("c", T1, T2, 1), (None, T1, None, 1), ("d", T1, T2, 1), (" D ", T2, None, 1)]
    rows = [("1", " a\t", T2, 1, 0, "x"), ("2", "B", T2, 1, 0, "x"), ("3", "c", T2, 2, 0, "x"), ("4", "zz", T2, None, 0, "x"), ("5", None, T2, 1, 0, "x"), ("6", "d", T2, 1, 0, "x"), ("7", "d", T1, 1, 0, "x"), ("4", "zz", T2, None, 0, "x"), ("8", "", T2, 1, 0, "x")]
    rows += [(f"h{i}", "a", T2, 1, 0, "x") for i in range(60)]
    for limit in (1000, 0):
        got = sorted((r.record_id, r.reason) for r in run(spark, rows, parents, limit).collect())
        assert got == [("2", "late"), ("3", "deleted"), ("4", "missing"), ("4", "missing"), ("7", "late"), ("8", "missing")]
    counts = {(r.period, r.reason): r.n for r in dangling_counts(run(spark, rows, parents, 1000)).collect()}
    assert counts == {(1, "late"): 2, (2, "deleted"): 1, (None, "missing"): 2, (1, "missing"): 1}


def test_empty_tables(spark):
    assert run(spark, [], [("a", T1, None, 1)], 10).count() == 0
    assert [r.reason for r in run(spark, [("1", "a", T1, 1, 0, "x")], [], 10).collect()] == ["missing"]


def test_filter_has_no_false_negatives(spark):
    keys = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("k"))
    bloom = build_filter(keys, "k", 3000)
    assert keys.filter(might_contain(bloom, F.col("k"))).count() == 3000
    strangers = spark.range(3000).select(F.concat(F.lit("x"), "id").alias("k"))
    assert strangers.filter(might_contain(bloom, F.col("k"))).count() < 150
    assert build_filter(keys.limit(0), "k", 0) == []


def test_filters_grow_with_the_keys(spark):
    keys = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("k"))
    filters = build_filter(keys, "k", 3000, filter_keys=400)
    assert len(filters) == 8 and keys.filter(might_contain(filters, F.col("k"))).count() == 3000
    strangers = spark.range(3000).select(F.concat(F.lit("x"), "id").alias("k"))
    assert strangers.filter(might_contain(filters, F.col("k"))).count() < 150


def test_joins_survive_hot_keys(spark):
    left = spark.range(900).select(F.when(F.col("id") < 600, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("a"))
    right = spark.range(0, 900, 3).select(F.col("id").alias("k"), (F.col("id") + 1).alias("b")).unionByName(spark.createDataFrame([(0, 7), (0, 8)], "k long, b long"))
    want = sorted(map(tuple, left.join(right, "k").collect()))
    assert sorted(map(tuple, salted_join(left, right, ["k"], 302, broadcast_rows=10).collect())) == want
    assert sorted(map(tuple, salted_join(left.filter("k > 0"), right, ["k"], 302, broadcast_rows=10, hot_share=5).collect())) == sorted(x for x in want if x[0])
    for rows in (10, 10_000):
        assert sorted((r.k, r.a, r.b) for r in block_join(right, left, ["k"], block_rows=rows).collect()) == want
    assert block_join(right, left.limit(0), ["k"]).count() == 0
