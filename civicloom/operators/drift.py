"""Fields that are added, removed, renamed or retyped from file to file, and one table of all files."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicloom.session import stage

#: What an abbreviated word of a label stands for; "" drops a word that carries no meaning.
# Fixed values.
WORDS = {
    "of": "", "the": "", "and": "", "est": "estimate", "tot": "total", "moe": "margin error", "yrs": "years", "yr": "year", "pers": "persons", "hhld": "household",
    "hh": "household", "cmte": "committee", "dist": "district", "estab": "establishment", "addr": "address", "amt": "amount", "cat": "category", "id": "identifier",
    "qtr": "quarter", "med": "median", "num": "number", "no": "number", "nbr": "number", "cnt": "count", "pct": "percent", "desc": "description", "avg": "average", "dt": "date",
}
# The spellings of each type.
TYPES = {
    "integer": "int int2 int4 int8 integer smallint bigint tinyint long short serial",
    "decimal": "decimal numeric number float float4 float8 double real money double_precision",
    "text": "text varchar string char character str nvarchar character_varying",
    "date": "date timestamp datetime timestamptz",
}


def type_class(col: Column) -> Column:
    """integer, decimal, text or date, however spelled, with or without a size; else the word itself."""
    word = F.regexp_replace(F.lower(F.trim(F.regexp_replace(col, r"\(.*$", ""))), r"\s+", "_")
    out = F.when(col.isNull(), None)
    for name, spelled in TYPES.items():
        out = out.when(word.isin(spelled.split()), name)
    return out.otherwise(word)


def words_of(label: Column) -> Column:
    """The words of a label in lower case, abbreviations written out, sorted: its wording doesn't matter."""
    pairs = [F.lit(x) for kv in WORDS.items() for x in kv]
    book = F.create_map(*pairs)
    split = F.filter(F.split(F.lower(label), "[^\\p{L}\\p{N}]+"), lambda w: w != "")
    full = F.transform(split, lambda w: F.coalesce(F.try_element_at(book, w), w))
    return F.array_sort(F.filter(F.flatten(F.transform(full, lambda w: F.split(w, " "))), lambda w: w != ""))


def long_path_values(rows: DataFrame, file: list[str], path: str, value: str, keep: list[str] = []) -> DataFrame:  # noqa: B006
    """(file..., keep..., cells): rows of one path and value each as path-value maps with raw types."""
    text = F.col(value).cast("string")
    raw = F.when(text.isNull(), "null").when(text.rlike(r"^[+-]?[0-9]+(\.0*)?$"), "integer").when(text.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), "decimal")
    raw = raw.when(text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}"), "date").otherwise("text")
    return rows.filter(F.col(path).isNotNull()).select(*file, *keep, F.create_map(F.col(path), F.struct(text.alias("value"), raw.alias("raw_type"))).alias("cells"))


def wide_path_values(rows: DataFrame, file: list[str]) -> DataFrame:
    """(file..., cells): rows with a column per path as path-value maps; the raw type is the column's."""
    paths = [c for c in rows.columns if c not in file]
    cells = [x for c in paths for x in (F.lit(c), F.struct(F.col(f"`{c}`").cast("string").alias("value"), F.lit(rows.schema[c].dataType.simpleString()).alias("raw_type")))]
    return rows.select(*file, F.create_map(*cells).alias("cells"))


def path_statistics(maps: DataFrame, file: list[str], keep: list[str] = []) -> DataFrame:  # noqa: B006
    """(file..., path, keep..., n, n_null, raw_types): one row per file and path, aggregated before the shuffle."""
    cells = maps.select(*file, *keep, F.explode("cells").alias("path", "cell"))
    first = cells.groupBy(*file, *keep, "path", F.col("cell.raw_type").alias("raw_type")).agg(F.count("*").alias("k"))
    return first.groupBy(*file, "path", *keep).agg(
        F.sum("k").alias("n"), F.sum(F.when(F.col("raw_type") == "null", F.col("k")).otherwise(0)).alias("n_null"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("raw_type", "k")))).alias("raw_types")
    )


def registered(fields: DataFrame, last_release: int) -> DataFrame:
    """(dataset_id, release, field_id, label, type): the fields of each yearly release.

    A field belongs to release Y when a row of it is valid on 1 July of Y; valid_to null or far off
    means still valid; rows without valid_from or with validity that ends before it begins belong nowhere.
    Several rows of one field valid that day count once: the type is that of the row valid from the
    latest day (the greater type on a tie), the label too, but a label is preferred to none.
    """
    mid = lambda c: F.make_date(F.year(c), F.lit(7), F.lit(1))
    end = F.coalesce(F.col("valid_to"), F.lit("9999-12-31").cast("date"))
    first = F.year("valid_from") + (F.col("valid_from") > mid("valid_from")).cast("int")
    last = F.least(F.lit(last_release), F.year(end) - (end < F.make_date(F.year(end), F.lit(7), F.lit(1))).cast("int"))
    valid = fields.filter(F.col("valid_from").isNotNull() & F.col("field_id").isNotNull()).withColumn("_a", first).withColumn("_b", last).filter(F.col("_a") <= F.col("_b"))
    spread = valid.select("dataset_id", "field_id", "label", type_class(F.col("data_type")).alias("type"), "valid_from", F.explode(F.sequence("_a", "_b")).alias("release"))
    return spread.groupBy("dataset_id", "release", "field_id").agg(
        F.max_by("type", F.struct("valid_from", "type")).alias("type"), F.max_by("label", F.struct(F.col("label").isNotNull(), "valid_from", "label")).alias("label")
    )


def _same_words(a: list[str], b: list[str]) -> bool:
    """Whether two sorted word lists match word for word, a word also by an abbreviation of it."""
    if len(a) != len(b):
        return False
    rest = list(b)
    for w in sorted(a, key=len, reverse=True):
        found = next((x for x in rest if x == w), None) or next((x for x in rest if _shortens(x, w) or _shortens(w, x)), None)
        if found is None:
            return False
        rest.remove(found)
    return True


def _shortens(short: str, long: str) -> bool:
    if len(short) < 2 or len(short) >= len(long) or short[0] != long[0] or any(c.isdigit() for c in short):
        return False
    letters = iter(long)
    return all(c in letters for c in short)


def _id_form(col: Column) -> Column:
    """What stays of an id under respelling: letters and digits in lower case, without a marking prefix or suffix."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(col), "^x_", ""), "_cd$", ""), "[^a-z0-9]", "")


def _line_form(col: Column) -> Column:
    """table|measure|line of an id that numbers lines (H1_E004, H1_004E, H1X_004PE), else null."""
    shape = r"(?i)^([a-z]+[0-9]+)x?_?(?:([em])([0-9]+)|([0-9]+)p?([em]))(?:_cd)?$"
    part = lambda i: F.nullif(F.regexp_extract(col, shape, i), F.lit(""))
    return F.lower(F.concat(part(1), F.lit("|"), F.coalesce(part(2), part(5)), F.lit("|"), F.coalesce(part(3), part(4)).cast("int").cast("string")))


def field_changes(releases: DataFrame, last_release: int, statistics: DataFrame | None = None, used_dataset: str | None = None) -> DataFrame:
    """(dataset_id, change, field_id, new_field_id, release_year): each release against the one before.

    ``releases`` is as ``registered`` gives. A field that goes and one that comes are one field renamed
    when their labels have the same words (order, separators, case and abbreviations aside), or, where
    one has no label in any release, when their ids have the same form and the other's label has no
    qualifier. Ids compare as written. Empty tables give no changes. ``statistics`` are path
    statistics of the data (release, path, table_id, measure): fields whose data belong to
    different tables or measures are never one. Several candidates pair off by the closest ids.
    """
    r = releases.select("dataset_id", "release", "field_id", "type", "label")
    whole = Window.partitionBy("dataset_id", "field_id")
    r = r.withColumn("label", F.coalesce("label", F.max("label").over(whole)))
    if statistics is not None:
        evidence = statistics.groupBy(F.col("release_year").alias("release"), F.col("path").alias("field_id")).agg(F.min(F.concat_ws("|", "table_id", "measure")).alias("source")).withColumn("dataset_id", F.lit(used_dataset))
        r = r.join(evidence, ["dataset_id", "release", "field_id"], "left").withColumn("source", F.max("source").over(whole))
    else:
        r = r.withColumn("source", F.lit(None).cast("string"))
    begins = releases.groupBy("dataset_id").agg(F.min("release").alias("first"))
    inorder = whole.orderBy("release")
    r = r.withColumns({"prev": F.lag("release").over(inorder), "prev_type": F.lag("type").over(inorder), "next": F.lead("release").over(inorder)}).join(begins, "dataset_id")
    kept = F.col("prev") == F.col("release") - 1
    retyped = r.filter(kept & ~F.col("type").eqNullSafe(F.col("prev_type"))).select("dataset_id", F.lit("retyped").alias("change"), "field_id", F.col("field_id").alias("new_field_id"), F.col("release").alias("release_year"))
    detail = [words_of(F.col("label")).alias("words"), F.coalesce(_line_form(F.col("field_id")), _id_form(F.col("field_id"))).alias("form"), "source", "label"]
    comes = r.filter(~F.coalesce(kept, F.lit(False)) & (F.col("release") > F.col("first"))).select("dataset_id", F.col("release").alias("y"), "field_id", *detail)
    goes = r.filter((F.col("release") < last_release) & ~F.coalesce(F.col("next") == F.col("release") + 1, F.lit(False))).select("dataset_id", (F.col("release") + 1).alias("y"), "field_id", *detail)

    initials = F.concat_ws("", F.array_sort(F.transform("words", lambda w: F.substring(w, 1, 1))))
    side = lambda df, s: df.select("dataset_id", "y", *[F.col(c).alias(f"{c}_{s}") for c in ("field_id", "words", "form", "source", "label")], F.explode(F.array(F.concat(F.lit("w"), F.coalesce(initials, F.lit(""))), F.concat(F.lit("i"), "form"))).alias("block"))

    @F.pandas_udf("boolean")
    def same_words(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([x is not None and y is not None and _same_words(list(x), list(y)) for x, y in zip(a, b)])

    met = side(goes, "old").join(side(comes, "new"), ["dataset_id", "y", "block"]).filter(~F.coalesce(F.col("source_old") != F.col("source_new"), F.lit(False)))
    unlabelled = F.col("words_old").isNull() | F.col("words_new").isNull()
    plain = F.coalesce(~F.coalesce("label_old", "label_new").rlike(r"\([^()]*\)\W*$"), F.lit(True))  # a bracket at the end is a qualifier, of which the id tells nothing
    letters = lambda c: F.array_join(F.array_sort(F.split(c, "")), "")
    spelled = F.coalesce(F.levenshtein(letters(F.when(F.col("words_old").isNull(), F.col("form_old")).otherwise(F.col("form_new"))), letters(F.array_join(F.coalesce("words_old", "words_new"), ""))) <= 3, F.lit(True))
    by_id = (F.col("form_old") == F.col("form_new")) & plain & (F.contains("form_old", F.lit("|")) | spelled)
    agree = met.withColumn("same", F.when(unlabelled, by_id).otherwise(same_words("words_old", "words_new"))).filter("same")
    scored = agree.withColumn("exact", F.coalesce(F.col("words_old") == F.col("words_new"), F.lit(False))).withColumn("apart", F.levenshtein("form_old", "form_new"))
    scored = scored.groupBy("dataset_id", "y", "field_id_old", "field_id_new").agg(F.max("exact").alias("exact"), F.min("apart").alias("apart"))
    best = lambda mine, other: F.row_number().over(Window.partitionBy("dataset_id", "y", mine).orderBy(F.desc("exact"), "apart", other))
    pairs = scored.withColumn("i", best("field_id_old", "field_id_new")).withColumn("j", best("field_id_new", "field_id_old")).filter((F.col("i") == 1) & (F.col("j") == 1)).select("dataset_id", "y", "field_id_old", "field_id_new")
    renamed = pairs.select("dataset_id", F.lit("renamed").alias("change"), F.col("field_id_old").alias("field_id"), F.col("field_id_new").alias("new_field_id"), F.col("y").alias("release_year"))
    lone = lambda df, s, change: df.join(pairs.select("dataset_id", "y", F.col(f"field_id_{s}").alias("field_id")), ["dataset_id", "y", "field_id"], "left_anti").select("dataset_id", F.lit(change).alias("change"), "field_id", F.col("field_id").alias("new_field_id"), F.col("y").alias("release_year"))
    return retyped.unionByName(renamed).unionByName(lone(goes, "old", "removed")).unionByName(lone(comes, "new", "added"))


def field_lines(releases: DataFrame, changes: DataFrame) -> DataFrame:
    """(dataset_id, release, field_id, item, item_type): the id a field has at last, through all renamings.

    Each unbroken stretch of releases under one id points to the stretch it was renamed to; pointers
    are doubled until none moves, so a field may be renamed any number of times. item_type is the type that
    holds all values of the item: its own, decimal for integers and decimals, else text.
    """
    w = Window.partitionBy("dataset_id", "field_id").orderBy("release")
    spells = releases.withColumn("_new", F.coalesce((F.lag("release").over(w) != F.col("release") - 1).cast("int"), F.lit(1))).withColumn("start", F.max(F.when(F.col("_new") == 1, F.col("release"))).over(w)).drop("_new")
    nodes = spells.groupBy("dataset_id", "field_id", "start").agg(F.max("release").alias("stop"))
    renamed = changes.filter("change = 'renamed'").select("dataset_id", "field_id", F.col("new_field_id").alias("to_id"), F.col("release_year").alias("to_start"))
    links = nodes.join(renamed.withColumn("stop", F.col("to_start") - 1), ["dataset_id", "field_id", "stop"], "left").select(
        "dataset_id", "field_id", "start", F.coalesce("to_id", "field_id").alias("to_id"), F.coalesce("to_start", "start").alias("to_start")
    )
    links = stage(links, "links")
    moved = True
    while moved:
        onward = links.select("dataset_id", F.col("field_id").alias("to_id"), F.col("start").alias("to_start"), F.col("to_id").alias("end_id"), F.col("to_start").alias("end_start"))
        further = (F.col("end_id") != F.col("to_id")) | (F.col("end_start") != F.col("to_start"))
        doubled = links.join(onward, ["dataset_id", "to_id", "to_start"]).select("dataset_id", "field_id", "start", F.col("end_id").alias("to_id"), F.col("end_start").alias("to_start"), further.alias("_moved"))
        held = stage(doubled, "links")  # a plan that joins itself would double each round
        moved, links = not held.filter("_moved").isEmpty(), held.drop("_moved")
    lines = spells.join(links, ["dataset_id", "field_id", "start"]).select("dataset_id", "release", "field_id", "type", F.col("to_id").alias("item"), F.col("to_start").alias("item_start"))
    kinds = lines.groupBy("dataset_id", "item", "item_start").agg(F.array_sort(F.collect_set("type")).alias("kinds"))
    held = F.when(F.size("kinds") == 1, F.get("kinds", F.lit(0))).when(F.array_except("kinds", F.array(F.lit("integer"), F.lit("decimal"))) == F.array().cast("array<string>"), "decimal").otherwise("text")
    return lines.join(kinds.withColumn("item_type", held).drop("kinds"), ["dataset_id", "item", "item_start"]).drop("item_start")


def typed_values(maps: DataFrame, file: list[str], lines: DataFrame, n_lines: int, keep: list[str]) -> DataFrame:
    """The cells of all files in one table: item, typed columns, and ``failed`` where a value isn't of the type.

    A field's own registered type decides whether a value fails; a failed value stays as text. Cells of
    fields registered in no release keep their id as item and are text. ``lines`` has release, field_id,
    type, item, item_type, unique by release and field.
    """
    from civicloom.operators.skew import lookup_join

    cells = maps.select(*file, *keep, F.explode("cells").alias("path", "cell")).select(*file, *keep, F.col(file[0]).alias("release"), F.col("path").alias("field_id"), F.col("cell.value").alias("value"))
    joined = lookup_join(cells, lines.select("release", "field_id", "type", "item", "item_type"), ["release", "field_id"], n_lines)
    v, kind = F.col("value"), F.col("type")
    number = v.try_cast("decimal(38,9)")
    good = F.when(v.isNull() | kind.isNull() | (kind == "text"), True).when(kind == "integer", number.isNotNull() & (number == F.floor(number))).when(kind == "decimal", number.isNotNull()).when(kind == "date", v.try_cast("date").isNotNull()).otherwise(True)
    good = F.coalesce(good, F.lit(False))
    return joined.select(
        *file, *keep, "field_id", F.coalesce("item", "field_id").alias("item"), F.coalesce("item_type", F.lit("text")).alias("item_type"),
        F.when(good & F.col("item_type").isin("integer", "decimal"), number).alias("value_number"), F.when(good & (F.col("item_type") == "date"), v.try_cast("date")).alias("value_date"),
        v.alias("value_text"), (~good).alias("failed"),
    )
