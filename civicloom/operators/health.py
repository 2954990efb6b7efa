"""What is there against what should be: coverage with totals, health counters, and the state of sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicloom.operators.pick import distinct_on
from civicloom.operators.reconcile import coverage_cells, known_total


def coverage_report(expected: DataFrame, loaded: DataFrame, keys: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """(keys..., expected, loaded, missing, surplus, status, level) for each cell and a total per ``group``.

    ``expected``: (keys, expected), null where unknown. ``loaded``: (keys, loaded). A total is unknown if any part
    is, and incomplete if any part is: a surplus elsewhere hides no gap. Loaded cells nobody expects have an
    unknown expectation of their own and level ``other``; they don't count in the totals.
    """
    both = expected.withColumn("_listed", F.lit(True)).join(loaded, list(keys), "full")
    cells = coverage_cells(both, "expected", "loaded").withColumn("level", F.when(F.col("_listed"), "cell").otherwise("other")).drop("_listed")
    listed = cells.filter("level = 'cell'")
    gap = F.max((F.col("status") == "incomplete").cast("int")) == 1
    totals = listed.groupBy(*group).agg(known_total("expected").alias("expected"), F.sum("loaded").alias("loaded"), gap.alias("_gap"))
    totals = coverage_cells(totals, "expected", "loaded").withColumn("status", F.when(F.col("_gap"), "incomplete").otherwise(F.col("status"))).drop("_gap").withColumn("level", F.lit("total"))
    return cells.unionByName(totals, allowMissingColumns=True)


def period_counts(spans: DataFrame, key: str, start: str, end: str, periods: DataFrame) -> DataFrame:
    """(period, n): distinct keys whose span overlaps each period. ``periods``: (period, first_day, after), a few dozen rows.

    Half-open, an open end is forever. The periods are broadcast after a check that they are few, and distinct keys
    are found per period before they are counted, so a person with many terms counts once.
    """
    if periods.limit(1_001).count() > 1_000:
        raise ValueError("more than a thousand periods")
    hit = (F.col(start) < F.col("after")) & F.coalesce(F.col(end) > F.col("first_day"), F.lit(True))
    each = spans.filter(F.col(start).isNotNull()).join(F.broadcast(periods), hit).select("period", key).distinct()
    return each.groupBy("period").agg(F.count(key).alias("n"))


def loaded_counts(tables: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """(table_name, part, n) over several tables, each by its own columns, in one table."""
    out = None
    for name, (df, by) in tables.items():
        part = F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in by]) if by else F.lit("")
        one = df.groupBy(part.alias("part")).agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "part", "n")
        out = one if out is None else out.unionByName(one)
    assert out is not None, "no table"
    return out


def health_json(counters: dict[str, tuple[DataFrame, Column]], runs: DataFrame, order: str, n_latest: int = 10) -> DataFrame:
    """(health): one JSON object of counters and the newest runs, newest first; nulls are left out, no run is an empty list.

    ``n_latest`` is the feature. The runs are cut to it before they are gathered.
    """
    row = None
    for name, (df, value) in counters.items():
        one = df.agg(value.alias(name))
        row = one if row is None else row.join(one, how="cross")  # one row each
    assert row is not None, "no counter"
    latest = runs.orderBy(F.desc_nulls_last(order), *[F.asc_nulls_last(c) for c in runs.columns if c != order]).limit(n_latest)
    listed = latest.agg(F.sort_array(F.collect_list(F.struct(order, *[c for c in runs.columns if c != order])), asc=False).alias("latest_runs"))
    both = row.join(listed, how="cross")  # one row each
    return both.select(F.to_json(F.struct(*counters, "latest_runs")).alias("health"))


def unresolved_references(exceptions: DataFrame, identifiers: DataFrame) -> DataFrame:
    """(n): references of recorded exceptions whose identifier nobody holds by now."""
    keys = ["namespace", "external_id"]
    return exceptions.join(identifiers.select(*keys).distinct(), keys, "left_anti").agg(F.coalesce(F.sum("reference_count"), F.lit(0)).alias("n"))


def fail_stale(runs: DataFrame, now: Column, hours: int, message: str, running: str = "running") -> DataFrame:
    """The runs with those that have been running too long marked failed; their finish is ``now``."""
    stale = F.coalesce((F.col("status") == running) & (F.unix_timestamp(now) - F.unix_timestamp("started_at") > hours * 3600), F.lit(False))
    changed = {"status": F.when(stale, "failed").otherwise(F.col("status")), "error_message": F.when(stale, message).otherwise(F.col("error_message")), "finished_at": F.when(stale, now).otherwise(F.col("finished_at"))}
    return runs.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in runs.columns])


def worst_status(items: DataFrame, family: str, families: DataFrame, order: Sequence[str] = ("healthy", "attention", "failed"), empty: str = "unknown") -> DataFrame:
    """(family, status, n): the worst status of each family's items; a family without items is unknown.

    A status that isn't listed counts as the worst.
    """
    rank = F.coalesce(F.array_position(F.array(*[F.lit(o) for o in order]), F.col("status")).cast("int"), F.lit(0))
    found = items.groupBy(family).agg(F.max(F.when(rank == 0, len(order)).otherwise(rank)).alias("_r"), F.count("*").alias("n"))
    out = families.select(family).distinct().join(found, family, "left")
    return out.select(family, F.coalesce(F.get(F.array(*[F.lit(o) for o in order]), F.col("_r") - 1), F.lit(empty)).alias("status"), F.coalesce("n", F.lit(0)).alias("n"))


def artifact_evidence(plans: DataFrame, artifacts: DataFrame, facts: DataFrame) -> DataFrame:
    """(plan_id, n_expected, n_missing, n_failed, n_facts, missing) of plans' artifacts.

    ``plans``: (plan_id, artifact_key), the newest usable version of a key stands for it. ``facts``:
    (source_artifact_id) one row per fact, counted before the join.
    """
    usable = F.col("status") != "failed"
    current = distinct_on(artifacts, ["artifact_key"], [F.when(usable, 0).otherwise(1), F.desc("artifact_version")]).select("artifact_key", "artifact_id", "status")
    n = facts.groupBy(F.col("source_artifact_id").alias("artifact_id")).agg(F.count("*").alias("_facts"))
    rows = plans.join(current, "artifact_key", "left").join(n, "artifact_id", "left")
    lacks = F.col("artifact_id").isNull()
    return rows.groupBy("plan_id").agg(
        F.count("artifact_key").alias("n_expected"), F.count_if(lacks & F.col("artifact_key").isNotNull()).alias("n_missing"), F.count_if(F.col("status") == "failed").alias("n_failed"), F.coalesce(F.sum("_facts"), F.lit(0)).alias("n_facts"),
        F.array_sort(F.collect_set(F.when(lacks, F.col("artifact_key")))).alias("missing"),
    )


def source_status(artifacts: DataFrame, staged: DataFrame, published: DataFrame, targets: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by..., n_artifacts, bytes, n_staged, n_published, latest_run, reconciles) per group of artifacts.

    Staged and published rows are counted per artifact before they meet it; ``targets`` (artifact_id, run_id,
    recorded_at, rows_parsed, rows_inserted, rows_existing, rows_rejected) counts with its latest run only.
    """
    n = lambda df, name, key: df.groupBy(F.col(key).alias("artifact_id")).agg(F.count("*").alias(name))
    newest = distinct_on(targets, ["artifact_id"], [F.desc_nulls_last("recorded_at"), F.desc_nulls_last("run_id")])
    adds_up = F.coalesce("rows_parsed", F.lit(0)) == F.coalesce("rows_inserted", F.lit(0)) + F.coalesce("rows_existing", F.lit(0)) + F.coalesce("rows_rejected", F.lit(0))
    rows = artifacts.join(n(staged, "_s", "artifact_id"), "artifact_id", "left").join(n(published, "_p", "source_artifact_id"), "artifact_id", "left")
    rows = rows.join(newest.select("artifact_id", F.col("recorded_at").alias("_at"), adds_up.alias("_ok")), "artifact_id", "left")
    return rows.groupBy(*by).agg(
        F.count("*").alias("n_artifacts"), F.sum("bytes_downloaded").alias("bytes"), F.coalesce(F.sum("_s"), F.lit(0)).alias("n_staged"), F.coalesce(F.sum("_p"), F.lit(0)).alias("n_published"),
        F.max("_at").alias("latest_run"), F.bool_and(F.coalesce("_ok", F.lit(False))).alias("reconciles"),
    )


def snapshot_validation(counts: DataFrame, required: DataFrame, key: str, measures: Sequence[str]) -> DataFrame:
    """(key, problem) of required parts that a snapshot lacks or holds empty; no row means it may be used."""
    both = required.select(key).distinct().join(counts.withColumn("_there", F.lit(True)), key, "left")
    problem = F.when(F.col("_there").isNull(), "missing")
    for m in measures:
        problem = problem.when(F.coalesce(F.col(m), F.lit(0)) <= 0, f"no {m}")
    return both.withColumn("problem", problem).filter("problem IS NOT NULL").select(key, "problem")


def refresh_preview(source: DataFrame, canonical: DataFrame, keys: Sequence[str], version: str, group: str) -> DataFrame:
    """(group, n_source, n_canonical, n_new, n_changed, n_gone) of what a refresh would do, without doing it."""
    s = source.select(*keys, F.col(version).alias("_s"), F.col(group).alias("_gs"))
    c = canonical.select(*keys, F.col(version).alias("_c"), F.col(group).alias("_gc"), F.lit(True).alias("_in"))
    both = s.withColumn("_out", F.lit(True)).join(c, list(keys), "full").withColumn(group, F.coalesce("_gs", "_gc"))
    a, b = F.col("_out").isNotNull(), F.col("_in").isNotNull()
    return both.groupBy(group).agg(F.count_if(a).alias("n_source"), F.count_if(b).alias("n_canonical"), F.count_if(a & ~b).alias("n_new"), F.count_if(a & b & ~F.col("_s").eqNullSafe(F.col("_c"))).alias("n_changed"), F.count_if(b & ~a).alias("n_gone"))


def listing_compare(official: DataFrame, held: DataFrame, group: Sequence[str], key: str) -> DataFrame:
    """(group..., n_official, n_held, n_match, n_missing, n_extra, matches): a publisher's listing against what is held."""
    o = official.select(*group, key).distinct().withColumn("_o", F.lit(True))
    both = o.join(held.select(*group, key).distinct().withColumn("_h", F.lit(True)), [*group, key], "full")
    a, b = F.col("_o").isNotNull(), F.col("_h").isNotNull()
    out = both.groupBy(*group).agg(F.count_if(a).alias("n_official"), F.count_if(b).alias("n_held"), F.count_if(a & b).alias("n_match"), F.count_if(a & ~b).alias("n_missing"), F.count_if(b & ~a).alias("n_extra"))
    return out.withColumn("matches", (F.col("n_missing") == 0) & (F.col("n_extra") == 0))


def pending_files(listing: DataFrame, held: DataFrame, key: str, stamp: str) -> DataFrame:
    """Listed files that aren't held, or are held with another stamp, with ``reason``."""
    have = held.groupBy(key).agg(F.max(stamp).alias("_held"))
    rows = listing.join(have, key, "left")
    reason = F.when(F.col("_held").isNull(), "new").when(~F.col(stamp).eqNullSafe(F.col("_held")), "changed")
    return rows.withColumn("reason", reason).filter("reason IS NOT NULL").drop("_held")


def group_sample(files: DataFrame, group: Sequence[str], key: str, per_group: int) -> DataFrame:
    """``per_group`` files of each group, the same ones every time: those whose keys hash least. Sampling is the feature."""
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.xxhash64(key), key))
    return files.withColumn("_rn", rank).filter(F.col("_rn") <= per_group).drop("_rn")


def acquisition(offered: DataFrame, held: DataFrame, key: str, marks: Sequence[str]) -> DataFrame:
    """``offered`` with ``decision``: reuse where every mark (etag, modified, size) is known and the same, else download."""
    rows = offered.join(held.select(key, *[F.col(m).alias(f"_{m}") for m in marks]), key, "left")
    same = F.lit(True)
    for m in marks:
        same = same & F.coalesce(F.col(m) == F.col(f"_{m}"), F.lit(False))
    return rows.withColumn("decision", F.when(same, "reuse").otherwise("download")).drop(*[f"_{m}" for m in marks])


def file_audit(files: DataFrame, roots: Sequence[str]) -> DataFrame:
    """(root, extension, n, bytes, newest) of a listing (path, length, modificationTime): no file is opened.

    A file counts under the longest root its path begins with; others under none.
    """
    root = F.lit(None).cast("string")
    for r in sorted(roots, key=len):
        root = F.when(F.col("path").startswith(r), r).otherwise(root)
    name = F.substring_index("path", "/", -1)
    extension = F.when(F.contains(name, F.lit(".")), F.lower(F.substring_index(name, ".", -1))).otherwise("")
    return files.groupBy(root.alias("root"), extension.alias("extension")).agg(F.count("*").alias("n"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("newest"))


def listed_files(spark: object, path: str) -> DataFrame:
    """(path, length, modificationTime) of every file below a path; the content column is pruned, so no file is read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", "modificationTime")  # type: ignore[attr-defined]


def approximate_rows(df: DataFrame) -> int | None:
    """The optimiser's row estimate of a table, without a scan; None where there is none (never taken for zero)."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.rowCount().get())) if stats.rowCount().isDefined() else None
