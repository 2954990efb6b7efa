"""Who is who, by identifiers alone; names are never a key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def resolve_groups(staged: DataFrame, identifiers: DataFrame, group: str = "bioguide", new_id: str = "new_person_id", namespace: str = "bioguide") -> DataFrame:
    """(group, new_id, owner_ids, outcome, person_id) for each group of staged identifiers.

    new: nobody owns any of them. matched: one person owns some. multiple_owners: two or more do.
    bioguide_mismatch: the one owner has another primary id, or another group resolves to that owner.
    The owners come from two equi-joins; an OR would make every pair meet.
    """
    s = staged.select(F.col(group).alias("g"), F.col(new_id).alias("new"), "namespace", "external_id")
    i = identifiers.select("person_id", "namespace", "external_id")
    wanted = s.groupBy("g").agg(F.min("new").alias("new"))
    direct = s.join(i, ["namespace", "external_id"]).select("g", "person_id")
    primary = i.filter(F.col("namespace") == namespace).select("person_id", F.col("external_id").alias("g"))
    owners = direct.unionByName(wanted.join(primary, "g").select("g", "person_id")).distinct()
    summary = wanted.join(owners.groupBy("g").agg(F.array_sort(F.collect_set("person_id")).alias("owner_ids")), "g", "left").withColumn("owner_ids", F.coalesce("owner_ids", F.array().cast("array<string>")))
    summary = summary.withColumn("owner", F.when(F.size("owner_ids") == 1, F.get("owner_ids", F.lit(0))))
    shared = summary.filter(F.col("owner").isNotNull()).groupBy("owner").count().filter("count > 1").select("owner", F.lit(True).alias("_shared"))
    ids = primary.groupBy(F.col("person_id").alias("owner")).agg(F.min("g").alias("_low"), F.max("g").alias("_high"))
    joined = summary.join(shared, "owner", "left").join(ids, "owner", "left")
    other = F.coalesce((F.col("_low") != F.col("g")) | (F.col("_high") != F.col("g")), F.lit(False))
    outcome = F.when(F.size("owner_ids") == 0, "new").when(F.size("owner_ids") > 1, "multiple_owners").when(F.col("_shared") | other, "bioguide_mismatch").otherwise("matched")
    return joined.select(F.col("g").alias(group), F.col("new").alias(new_id), "owner_ids", outcome.alias("outcome"), F.coalesce(F.get("owner_ids", F.lit(0)), F.col("new")).alias("person_id"))


def drop_conflicted(pairs: DataFrame, person: str = "person_id") -> tuple[DataFrame, DataFrame]:
    """(identifiers of one person, identifiers that several people claim)."""
    claims = pairs.groupBy("namespace", "external_id").agg(F.countDistinct(person).alias("_n"), F.min(person).alias(person))
    return claims.filter("_n = 1").drop("_n"), claims.filter("_n > 1").drop("_n", person)


def _owners(identifiers: DataFrame, namespace: str, key: str, prefix: str) -> DataFrame:
    return identifiers.filter(F.col("namespace") == namespace).groupBy(F.col("external_id").alias(key)).agg(F.countDistinct("person_id").alias(f"{prefix}_n"), F.min("person_id").alias(f"{prefix}_person"))


def link_numbers(rows: DataFrame, identifiers: DataFrame, number: str = "icpsr", guide: str = "bioguide") -> tuple[DataFrame, DataFrame]:
    """(rows with person_id or null, new (person_id, number) identifiers), from one state of ``identifiers``.

    A number that one person owns links when the row's guide is empty or that person's. A number
    nobody owns links, and becomes the person's, when the guide is one person's who has no number yet; unless
    the number is claimed for two people or the person by two numbers, which links nobody.
    """
    r = rows.withColumn("_guide", F.nullif(F.trim(F.col(guide)), F.lit("")))
    r = r.join(_owners(identifiers, number, number, "_num"), number, "left").join(_owners(identifiers, guide, "_guide", "_gd"), "_guide", "left")
    guides = identifiers.filter(F.col("namespace") == guide).groupBy(F.col("person_id").alias("_num_person")).agg(F.collect_set("external_id").alias("_guides"))
    r = r.join(guides, "_num_person", "left")
    numbered = identifiers.filter(F.col("namespace") == number).select(F.col("person_id").alias("_gd_person")).distinct()
    claimed = r.filter((F.col("_gd_n") == 1) & F.col("_num_n").isNull()).select(number, "_gd_person").distinct().join(numbered, "_gd_person", "left_anti")
    one_person = claimed.groupBy(number).agg(F.count("*").alias("_k")).filter("_k = 1").select(number)
    one_number = claimed.groupBy("_gd_person").agg(F.count("*").alias("_k")).filter("_k = 1").select("_gd_person")
    contested = claimed.join(one_number, "_gd_person", "left_anti").select(number).distinct()
    safe = claimed.join(one_person, number, "left_semi").join(contested, number, "left_anti").select(number, F.col("_gd_person").alias("_safe"))
    out = r.join(safe, number, "left")
    agrees = F.col("_guide").isNull() | F.col("_guides").isNull() | F.array_contains("_guides", F.col(guide))
    person = F.when((F.col("_num_n") == 1) & agrees, F.col("_num_person")).when((F.col("_gd_n") == 1) & (F.col("_gd_person") == F.col("_safe")), F.col("_safe"))
    return out.withColumn("person_id", person).select(*rows.columns, "person_id"), safe.select(F.col("_safe").alias("person_id"), number)


def shared_values(contacts: DataFrame, person: str, value: list[str]) -> DataFrame:
    """``contacts`` with ``shared``: whether another person has the same value too."""
    n = contacts.groupBy(*value).agg(F.countDistinct(person).alias("_n"))
    return contacts.join(n, value, "left").withColumn("shared", F.coalesce(F.col("_n") > 1, F.lit(False))).drop("_n")
