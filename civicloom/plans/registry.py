"""What a catalog says of its sources: status, fields, selections, rankings and gates, as tables of facts and of problems."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicloom.operators.keyed import absent, upsert


def registry_status(providers: DataFrame, datasets: DataFrame, resources: DataFrame, snapshots: DataFrame) -> DataFrame:
    """(provider_id, name, dataset_id, title, resources, last_snapshot, state): both sides are aggregated before the join, so
    neither multiplies the other."""
    r = resources.groupBy("dataset_id").agg(F.countDistinct("resource_id").alias("resources"))
    s = snapshots.groupBy("dataset_id").agg(F.max("captured_at").alias("last_snapshot"))
    rows = datasets.join(providers.select("provider_id", "name"), "provider_id").join(r, "dataset_id", "left").join(s, "dataset_id", "left")
    n = F.coalesce("resources", F.lit(0))
    return rows.select("provider_id", "name", "dataset_id", "title", n.alias("resources"), "last_snapshot", F.when(n > 0, "ready").otherwise("pending_adapter").alias("state"))


def shell_fields(shells: DataFrame, dataset_id: str, valid_from: str) -> DataFrame:
    """Two fields (estimate and margin) per line of a table-shell file: B19013_001 gives B19013_E001 and B19013_M001.

    Lines without a table and a number are left out; the description joins title and universe.
    """
    t = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    table, number = F.substring_index(t("unique_id"), "_", 1), F.regexp_replace(t("unique_id"), "^[^_]*_?", "")
    good = F.contains(t("unique_id"), F.lit("_")) & (table != "") & (number != "")
    description = F.when(t("universe") != "", F.concat(t("title"), F.lit(" -- "), t("universe"))).otherwise(t("title"))
    rows = shells.filter(good).select(F.lit(dataset_id).alias("dataset_id"), table.alias("_t"), number.alias("_n"), t("label").alias("label"), t("type").alias("data_type"), description.alias("description"), F.lit(valid_from).cast("date").alias("valid_from"), F.explode(F.array(F.lit("E"), F.lit("M"))).alias("_m"))
    return rows.select("dataset_id", F.concat("_t", F.lit("_"), "_m", "_n").alias("field_id"), "label", "data_type", "description", "valid_from")


def upsert_fields(fields: DataFrame, arriving: DataFrame) -> DataFrame:
    """The field dictionary after a release's fields, one row per dataset, field and first day."""
    from civicloom.operators.pick import distinct_on

    keys = ["dataset_id", "field_id", "valid_from"]
    return upsert(fields, distinct_on(arriving, keys, [F.asc_nulls_last(c) for c in arriving.columns if c not in keys]), keys)


def relevant_tables(manifest: DataFrame, excluded_prefixes: Sequence[str] = ("B98", "B99"), term: str = "5", without: Sequence[str] = ()) -> DataFrame:
    """Detailed tables of a manifest (id, product, year) that carry something of their own: no collapsed (C) tables, none of the
    excluded prefixes, none whose years are known and lack the term."""
    known = F.nullif(F.trim(F.coalesce(F.col("year"), F.lit(""))), F.lit(""))
    listed = F.coalesce(F.array_contains(F.split(known, ","), term), F.lit(True))
    return manifest.filter((F.col("product") == "Detailed Table") & ~F.col("id").startswith("C") & ~F.substring("id", 1, 3).isin([*excluded_prefixes, *without]) & listed)


def contract_selection(manifest: DataFrame, products: Sequence[str], prefixes: Sequence[str] = (), include: Sequence[str] = (), add: Sequence[str] = (), exclude: Sequence[str] = (), terms: Sequence[str] = ()) -> DataFrame:
    """The tables a contract selects: by prefix, id or a word of the title, of accepted products, less the excluded ids. Ids in any case."""
    key, title = F.upper("id"), F.lower("title")
    hits = [key.startswith(p.upper()) for p in prefixes] + [F.contains(title, F.lit(t.lower())) for t in terms] + [key.isin([i.upper() for i in (*include, *add)])]
    product = reduce(Column.__or__, [F.col("product").startswith(p) for p in products], F.lit(False))
    return manifest.filter(F.coalesce(reduce(Column.__or__, hits) & product, F.lit(False)) & ~key.isin([i.upper() for i in exclude]))


# Ranking files ---------------------------------------------------------------------------------------

PRECEDENCE = "struct<version:int,entities:map<string,struct<display:array<string>,kinds:map<string,map<string,array<struct<dataset:string,field:string>>>>>>>"


def precedence_rows(documents: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """((entity, name_kind, geography_type, dataset_id, rank, field), (entity, name_kind, position)): ranks and places are those in the lists, from 1.

    A document maps each entity to its display list and, per kind and type ('' where there is none), its ordered sources.
    """
    d = documents.select(F.from_json(F.col(body), PRECEDENCE).alias("d")).select(F.explode("d.entities").alias("entity", "e"))
    places = d.select("entity", F.posexplode("e.display").alias("_p", "name_kind")).select("entity", "name_kind", (F.col("_p") + 1).alias("position"))
    kinds = d.select("entity", F.explode("e.kinds").alias("name_kind", "_types")).select("entity", "name_kind", F.explode("_types").alias("geography_type", "_sources"))
    ranks = kinds.select("entity", "name_kind", "geography_type", F.posexplode("_sources").alias("_r", "s"))
    return ranks.select("entity", "name_kind", "geography_type", F.col("s.dataset").alias("dataset_id"), (F.col("_r") + 1).alias("rank"), F.col("s.field").alias("field")), places


def precedence_problems(ranks: DataFrame, places: DataFrame, datasets: DataFrame) -> DataFrame:
    """(entity, name_kind, problem): unknown or repeated datasets, sources without a field, kinds ranked but not displayed or displayed twice,
    entities without any rank. No row means that the file may be synced."""
    keys = ["entity", "name_kind"]
    known = datasets.select("dataset_id", F.lit(True).alias("_k")).distinct()
    parts = [
        ranks.join(known, "dataset_id", "left").filter("_k IS NULL").select(*keys, F.concat(F.lit("unknown dataset "), F.coalesce("dataset_id", F.lit(""))).alias("problem")),
        ranks.groupBy(*keys, "geography_type", "dataset_id").count().filter("count > 1").select(*keys, F.concat(F.lit("dataset twice: "), F.coalesce("dataset_id", F.lit(""))).alias("problem")),
        ranks.filter(F.coalesce(F.trim("field"), F.lit("")) == "").select(*keys, F.lit("source without a field").alias("problem")),
        ranks.select(*keys).distinct().join(places.select(*keys), keys, "left_anti").select(*keys, F.lit("ranked but never displayed").alias("problem")),
        places.groupBy(*keys).count().filter("count > 1").select(*keys, F.lit("displayed twice").alias("problem")),
        places.select("entity").distinct().join(ranks.select("entity").distinct(), "entity", "left_anti").select("entity", F.lit(None).cast("string").alias("name_kind"), F.lit("no kinds").alias("problem")),
    ]
    return reduce(DataFrame.unionByName, parts).distinct()


def sync_precedence(stored: DataFrame, ranks: DataFrame, problems: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ranking after the file, (action, n)): everything the file says is written, what it dropped is pruned.

    A file with problems, or an empty one, is refused before anything changes.
    """
    listed = [f"{r['entity']} {r['name_kind']}: {r['problem']}" for r in problems.limit(20).collect()]
    if listed or ranks.isEmpty():
        raise ValueError("ranking not synced: " + ("; ".join(listed) or "the file ranks nothing"))
    keys = ["entity", "name_kind", "geography_type", "dataset_id"]
    from civicloom.operators.keyed import diff_action

    changes = diff_action(stored, ranks, keys, ["rank", "field"]).groupBy("action").agg(F.count("*").alias("n"))
    pruned = absent(stored, ranks, keys).agg(F.count("*").alias("n")).select(F.lit("removed").alias("action"), "n")
    return ranks.select(*stored.columns), changes.unionByName(pruned)


# Gates -----------------------------------------------------------------------------------------------

# The states of a gate and what can't be a namespace.
GATE_STATES = ["ready", "blocked", "not_applicable"]
NAME_LIKE = ["name", "full_name", "last_name", "label"]


def gate_problems(gates: DataFrame, contracts: DataFrame, required: Sequence[str], key: str = "bioguide") -> DataFrame:
    """(dataset_id, problem) of person-join gates (dataset_id, state, key, via, blocked_by, contract).

    People join by identifier, never by name: the key is fixed, the way a namespace. A blocked gate says by what, a ready one has an approved
    contract, and while a gate isn't ready no enabled contract of its dataset writes past the stage.
    """
    c = contracts.select(F.col("contract_id").alias("contract"), (F.col("approval") == "approved").alias("_approved"))
    g = gates.join(c, "contract", "left")
    via = F.nullif(F.trim("via"), F.lit(""))
    rules = [
        (~F.coalesce(F.col("state").isin(GATE_STATES), F.lit(False)), "unknown state"),
        (~F.col("key").eqNullSafe(F.lit(key)), f"key must be {key}"),
        (F.lower(via).isin(NAME_LIKE), "via is a name"),
        ((F.col("state") == "blocked") & (F.coalesce(F.size("blocked_by"), F.lit(0)) < 1), "blocked by nothing"),
        ((F.col("state") == "ready") & via.isNull(), "ready without a namespace"),
        ((F.col("state") == "ready") & ~F.coalesce(F.col("_approved"), F.lit(False)), "ready without an approved contract"),
    ]
    marks = F.array_compact(F.array(*[F.when(F.coalesce(cond, F.lit(False)), why) for cond, why in rules]))
    own = g.select("dataset_id", F.explode(marks).alias("problem"))
    writes = contracts.filter("enabled AND NOT startswith(target, 'stage.')").select("dataset_id", F.col("contract_id").alias("_c"))
    past = gates.filter("state <> 'ready'").join(writes, "dataset_id").select("dataset_id", F.concat(F.lit("contract writes while blocked: "), "_c").alias("problem"))
    wanted = gates.sparkSession.createDataFrame([(r,) for r in required] or [], "dataset_id string")
    lacking = absent(wanted, gates, ["dataset_id"]).select("dataset_id", F.lit("no gate").alias("problem"))
    return own.unionByName(past).unionByName(lacking)


def gate_status(gates: DataFrame, identifiers: DataFrame) -> DataFrame:
    """(dataset_id, state, via, people_with_via): people are counted once per namespace, unknown without one."""
    n = identifiers.groupBy(F.col("namespace").alias("via")).agg(F.countDistinct("person_id").alias("people_with_via"))
    rows = gates.select("dataset_id", "state", "via").join(n, "via", "left")
    return rows.select("dataset_id", "state", "via", F.when(F.col("via").isNotNull(), F.coalesce("people_with_via", F.lit(0))).alias("people_with_via"))


def inventory_problems(datasets: DataFrame, required: Sequence[str], key: str = "dataset_id", refers: dict[str, DataFrame] | None = None) -> DataFrame:
    """(key, problem): blank required columns, repeated keys, references to nothing (``refers``: column -> table of its values)."""
    parts = [datasets.filter(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "").select(key, F.lit(f"no {c}").alias("problem")) for c in required]
    parts.append(datasets.groupBy(key).count().filter("count > 1").select(key, F.lit("repeated").alias("problem")))
    for c, values in (refers or {}).items():
        known = values.select(F.col(values.columns[0]).alias(c)).distinct()
        parts.append(datasets.filter(F.col(c).isNotNull()).join(known, c, "left_anti").select(key, F.concat(F.lit(f"unknown {c} "), F.col(c).cast("string")).alias("problem")))
    return reduce(DataFrame.unionByName, parts)


# Baskets -----------------------------------------------------------------------------------------------


def toggle(basket: DataFrame, toggled: DataFrame, keys: Sequence[str] = ("basket_id", "resource_id")) -> DataFrame:
    """The basket's rows after each of the toggled was put in or taken out; one toggled an even number of times stays as it was."""
    odd = toggled.groupBy(*keys).count().filter("count % 2 = 1").select(*keys)
    return absent(basket, odd, keys).unionByName(absent(odd, basket, keys), allowMissingColumns=True)


def add_all(basket: DataFrame, hits: DataFrame, basket_id: str) -> DataFrame:
    """The basket plus every resource of a search that it lacks."""
    keys = ["basket_id", "resource_id"]
    rows = hits.select(F.lit(basket_id).alias("basket_id"), "resource_id").distinct()
    return basket.unionByName(absent(rows, basket, keys), allowMissingColumns=True)


def basket_listing(basket: DataFrame, resources: DataFrame, basket_id: str) -> DataFrame:
    """The resources of a basket, with ``gone`` where the catalog has them no more."""
    mine = basket.filter(F.col("basket_id") == basket_id).select("resource_id")
    return mine.join(resources.withColumn("_in", F.lit(True)), "resource_id", "left").withColumn("gone", F.col("_in").isNull()).drop("_in")


def snapshot_links(resources: DataFrame, links: DataFrame, snapshot_id: str) -> DataFrame:
    """The snapshot links plus one for each resource it saw that isn't linked to it yet."""
    rows = resources.select(F.lit(snapshot_id).alias("snapshot_id"), "resource_id").distinct()
    return links.unionByName(absent(rows, links, ["snapshot_id", "resource_id"]), allowMissingColumns=True)


# Selecting files -----------------------------------------------------------------------------------------


def planned_artifacts(items: DataFrame, dataset_id: str, key: str, url: str, **columns: str) -> DataFrame:
    """(dataset_id, artifact_key, remote_url, ...) of what a release publishes: patterns with {column} for each item."""

    def filled(pattern: str) -> Column:
        import re

        bits = re.split(r"\{(\w+)\}", pattern)
        return F.concat(*[F.col(b).cast("string") if i % 2 else F.lit(b) for i, b in enumerate(bits) if b or i % 2])

    return items.select(F.lit(dataset_id).alias("dataset_id"), filled(key).alias("artifact_key"), filled(url).alias("remote_url"), *[filled(p).alias(c) for c, p in columns.items()]).distinct()


def archive_progress(members: DataFrame, ledger: DataFrame) -> DataFrame:
    """The members of archives that a resumed load still has to take: those without a completed entry in the ledger."""
    keys = ["archive", "member"]
    done = ledger.filter("status = 'succeeded'").select(*keys).distinct()
    return members.join(done, keys, "left_anti")


def publish_releases(releases: DataFrame, artifacts: DataFrame) -> DataFrame:
    """The releases plus one row per selected artifact whose (product, period, kind) has none yet."""
    from civicloom.operators.keyed import insert_absent

    keys = ["product", "period", "kind"]
    return insert_absent(releases, artifacts.filter("selected").select(*keys, "artifact_id"), keys, [F.asc("artifact_id")])


def directory_links(pages: DataFrame, html: str = "html", pattern: str = r"[^\"?]+\.(?:zip|csv|dat|xml|txt)") -> DataFrame:
    """(page, href, name) of the files a directory page links to, once each."""
    found = pages.select("page", F.explode(F.regexp_extract_all(F.col(html), F.lit(f'(?i)href="({pattern})"'), F.lit(1))).alias("href"))
    return found.distinct().select("page", "href", F.substring_index("href", "/", -1).alias("name"))


def crawl_cursor(pages: DataFrame) -> DataFrame:
    """(release_offset, series_offset) from which a two-level paging crawl resumes: after the last page that was kept.

    ``pages``: (release_offset, series_offset, n_items, page_size). A short page ends its release.
    """
    last = pages.agg(F.max(F.struct("release_offset", "series_offset", "n_items", "page_size")).alias("p")).filter("p IS NOT NULL").select("p.*")
    short = F.col("n_items") < F.col("page_size")
    return last.select(F.when(short, F.col("release_offset") + 1).otherwise(F.col("release_offset")).alias("release_offset"), F.when(short, F.lit(0)).otherwise(F.col("series_offset") + F.col("page_size")).alias("series_offset"))
