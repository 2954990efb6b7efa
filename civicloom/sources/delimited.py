"""Delimited bulk files to stage rows and long facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicloom.functions.scalars import geography_of, guarded_int, number_or_null, number_or_reason
from civicloom.operators.parsing import split_records

#: A matrix of columns of at most so many rows is broadcast.
MATRIX_ROWS = 10_000


def read_delimited(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8", lower: bool = True) -> DataFrame:
    """A file with a header, every column a string, names in lower case."""
    df = spark.read.option("header", True).option("sep", sep).option("encoding", encoding).option("mode", "PERMISSIVE").option("escape", '"').csv(path)
    names = [c.strip().lower() if lower else c.strip() for c in df.columns]
    if len(set(names)) != len(names) or "" in names:
        raise ValueError(f"header of {path} has an empty or repeated column")
    return df.toDF(*names)


def to_stage(df: DataFrame, artifact_id: str, **literals: str) -> DataFrame:
    """Stage rows: the record as a map, with where it came from."""
    record = F.create_map(*[x for c in df.columns for x in (F.lit(c), F.col(f"`{c}`").cast("string"))])
    return df.select(F.lit(artifact_id).alias("artifact_id"), *[F.lit(v).alias(k) for k, v in literals.items()], record.alias("raw"))


def population_rows(stage: DataFrame, prefix: str = "popestimate") -> DataFrame:
    """One row per year from wide population columns: (geoid, geography_type, estimate_year, population)."""
    level = F.col("raw")["sumlev"]
    kind = F.when(level == "050", "county").when(level == "040", "state").when(level == "010", "nation")
    geoid = F.when(level == "050", F.concat(F.lpad(F.col("raw")["state"], 2, "0"), F.lpad(F.coalesce(F.col("raw")["county"], F.lit("")), 3, "0"))).when(level == "040", F.lpad(F.col("raw")["state"], 2, "0")).when(level == "010", "1")
    listed = stage.filter(kind.isNotNull()).select("artifact_id", kind.alias("geography_type"), geoid.alias("geoid"), F.explode("raw").alias("k", "v"))
    shape = f"^{prefix}([0-9]{{4}})$"
    return listed.filter(F.col("k").rlike(shape)).select("artifact_id", "geography_type", "geoid", F.regexp_extract("k", shape, 1).cast("int").alias("estimate_year"), guarded_int(F.col("v")).alias("population")).filter("population IS NOT NULL")


def business_rows(stage: DataFrame) -> DataFrame:
    """Business patterns with guarded numbers; anything that isn't a number is null."""
    raw = F.col("raw")
    whole = lambda c: guarded_int(raw[c])
    geoid = F.concat(F.lpad(raw["fipstate"], 2, "0"), F.coalesce(F.lpad(raw["fipscty"], 3, "0"), F.lit("")))
    return stage.select("artifact_id", geoid.alias("geoid"), raw["naics"].alias("naics"), F.coalesce(F.nullif(raw["lfo"], F.lit("")), F.lit("-")).alias("legal_form"), whole("est").alias("establishments"), whole("emp").alias("employment"), whole("qp1").alias("first_quarter_payroll"), whole("ap").alias("annual_payroll"))


def survey_rows(df: DataFrame, geo_id: str, table_id: str) -> DataFrame:
    """Estimates and margins from a wide survey table, long: states and counties only, markers null.

    ``problem`` says where a cell is neither a number nor a marker; a load refuses the table if there is any.
    """
    values = [c for c in df.columns if c != geo_id]
    place = geography_of(F.col(geo_id))
    cells = F.create_map(*[x for c in values for x in (F.lit(c), F.col(f"`{c}`").cast("string"))])
    listed = df.withColumn("_g", place).filter(F.col("_g").isNotNull()).select("_g.*", F.explode(cells).alias("field_id", "text"))
    measure = F.when(F.upper("field_id").rlike("_M[0-9]+$|_[0-9]+M$"), "margin_of_error").otherwise("estimate")
    return listed.select("geography_type", "geoid", F.lit(table_id).alias("table_id"), "field_id", measure.alias("measure"), number_or_reason(F.col("text"))[0].alias("value"), number_or_reason(F.col("text"))[1].alias("problem"))


def with_header(lines: DataFrame, sep: str = ",", lower: bool = True) -> tuple[DataFrame, DataFrame]:
    """((archive, member, source_ordinal, raw map), refused lines) of members whose first line names their columns.

    ``lines`` as ``archives.ZipLines`` gives them. A header with a blank or repeated name refuses its member, a line with
    another number of fields itself. Quoted fields may hold separators and doubled quotes; lines end a record.
    """
    cut = split_records(lines.withColumn("line", F.regexp_replace("line", "^\ufeff", "")), "line", sep).withColumnRenamed("fields", "f")
    named = F.transform("f", lambda x: F.trim(F.lower(x) if lower else x))
    heads = cut.filter("source_ordinal = 1").select("archive", "member", named.alias("_names"))
    good = (F.size(F.array_distinct("_names")) == F.size("_names")) & ~F.array_contains("_names", "")
    rows = cut.filter("source_ordinal > 1").join(heads.withColumn("_ok", good), ["archive", "member"])
    problem = F.when(~F.coalesce(F.col("_ok"), F.lit(False)), "header has an empty or repeated column").when(F.col("broken").isNotNull(), "broken quoting").when(F.size("f") != F.size("_names"), "ragged row")
    marked = rows.withColumn("problem", problem)
    kept = marked.filter("problem IS NULL").select("archive", "member", "source_ordinal", F.map_from_arrays("_names", "f").alias("raw"))
    return kept, marked.filter("problem IS NOT NULL").select("archive", "member", "source_ordinal", "line", "problem")


def record_type(member: Column) -> Column:
    """Person or housing records by a microdata file's name: psam_p.., ss06p.. or csv_pus.., and the same with h; else null."""
    name = F.lower(F.substring_index(member, "/", -1))
    return F.when(name.rlike("^(psam_|ss[0-9]{2}|csv_)p"), "person").when(name.rlike("^(psam_|ss[0-9]{2}|csv_)h|^household"), "housing")


def promoted_business(rows: DataFrame, geography: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(facts with geography_id, counts of codes without a place): a code of two digits is a state, of five a county."""
    kind = F.when(F.length("geoid") == 2, "state").when(F.length("geoid") == 5, "county")
    placed = rows.withColumn("geography_type", kind).join(geography.select("geography_id", "geography_type", "geoid"), ["geography_type", "geoid"], "left")
    lost = placed.filter("geography_id IS NULL").groupBy("geoid").agg(F.count("*").alias("n"))
    return placed.filter("geography_id IS NOT NULL").drop("geography_type", "geoid"), lost


def segment_values(geo: DataFrame, segment: DataFrame, matrix: DataFrame) -> DataFrame:
    """Values of a numbered segment by the matrix of its columns.

    ``geo``: (logrecno, geoid). ``segment``: (logrecno, fields array). ``matrix``: (variable_id, table_id,
    position from 0), broadcast up to MATRIX_ROWS rows and shuffled beyond. Joined on logrecno.
    """
    cells = segment.select("logrecno", F.posexplode("fields").alias("position", "text"))
    small = matrix.limit(MATRIX_ROWS + 1).count() <= MATRIX_ROWS
    placed = cells.join(F.broadcast(matrix) if small else matrix.hint("shuffle_merge"), "position")
    return placed.join(geo.select("logrecno", "geoid"), "logrecno").select("geoid", "table_id", "variable_id", guarded_int(F.col("text")).alias("value"))


def relationship_rows(df: DataFrame, district: str, overlap: str, land: str, water: str) -> DataFrame:
    """Rows of a relationship file; a blank side stays as null."""
    blank = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    return df.select(blank(district).alias("district_geoid"), blank(overlap).alias("overlap_geoid"), guarded_int(F.col(land)).alias("area_land_part"), guarded_int(F.col(water)).alias("area_water_part"))


def block_rows(df: DataFrame, block: str, code: str) -> tuple[DataFrame, DataFrame]:
    """(block assignments, refused rows): a block has fifteen digits and a code isn't blank."""
    ok = F.col(block).rlike("^[0-9]{15}$") & (F.trim(F.coalesce(F.col(code), F.lit(""))) != "")
    good = F.coalesce(ok, F.lit(False))
    return df.filter(good).select(F.col(block).alias("block_geoid"), F.trim(code).alias("district_code")), df.filter(~good)


def tenors_long(df: DataFrame, day: str, pattern: str = "MM/dd/yyyy") -> DataFrame:
    """A yield curve's columns as rows: (period_start, tenor, value); what isn't a number is left out."""
    tenors = [c for c in df.columns if c != day]
    long = df.select(F.try_to_timestamp(F.col(day), F.lit(pattern)).cast("date").alias("period_start"), *[F.col(f"`{c}`").cast("string").alias(c) for c in tenors]).unpivot("period_start", tenors, "tenor", "text")
    return long.select("period_start", "tenor", number_or_null(F.col("text")).alias("value")).filter("value IS NOT NULL")


def microdata(df: DataFrame, names: dict[str, list[str]], types: dict[str, str]) -> DataFrame:
    """Harmonised columns from alternative source names: the first that is there and not blank."""
    have = {c.lower(): c for c in df.columns}

    def pick(options: list[str]) -> Column:
        found = [F.nullif(F.trim(F.col(have[o.lower()]).cast("string")), F.lit("")) for o in options if o.lower() in have]
        return F.coalesce(*found) if found else F.lit(None).cast("string")

    return df.select(*[pick(o).try_cast(types.get(n, "string")).alias(n) for n, o in names.items()])
