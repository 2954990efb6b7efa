"""Shapefiles in zip archives, and population files whose columns are given by a matrix."""

from __future__ import annotations

import io
import json
import struct
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicloom.functions.wkb import Ring, multipolygon

FEATURE = "path string, source_ordinal bigint, raw string, geom binary, problem string"


def dbf_records(data: bytes, encoding: str = "utf-8") -> Iterator[dict[str, str | None]]:
    """The records of an attribute table in order; blank values are null. Deleted records keep their place."""
    count, start, width = struct.unpack_from("<IHH", data, 4)
    fields, at, offset = [], 32, 1
    while at < start - 1 and data[at] != 0x0D:
        name = data[at : at + 11].split(b"\0")[0].decode("ascii", "replace")
        size = data[at + 16]
        fields.append((name, offset, size))
        at, offset = at + 32, offset + size
    for i in range(count):
        row = data[start + i * width : start + (i + 1) * width]
        yield {n: row[o : o + s].decode(encoding, "replace").strip("\0 ") or None for n, o, s in fields}


def _area(ring: Ring) -> float:
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, [*ring[1:], ring[0]])) / 2


def _within(point: tuple[float, float], ring: Ring) -> bool:
    x, y = point
    inside = False
    for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]]):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            inside = not inside
    return inside


def grouped_rings(rings: list[Ring]) -> list[list[Ring]]:
    """Polygons of a shape's rings: clockwise rings are outer, others holes of the smallest outer ring around them."""
    outer = [[r] for r in rings if _area(r) <= 0]
    for hole in (r for r in rings if _area(r) > 0):
        around = [p for p in outer if _within(hole[0], p[0])]
        if around:
            min(around, key=lambda p: abs(_area(p[0]))).append(hole)
        else:
            outer.append([hole])  # a ring drawn the wrong way round stands for itself
    return outer


def shp_polygons(data: bytes) -> Iterator[bytes | None]:
    """The polygons of a shape file in order as binary geometry; a null shape is null, another kind an error."""
    at = 100
    while at + 8 <= len(data):
        (words,) = struct.unpack_from(">I", data, at + 4)
        body, at = at + 8, at + 8 + 2 * words
        (kind,) = struct.unpack_from("<i", data, body)
        if kind == 0:
            yield None
            continue
        if kind not in (5, 15, 25):
            raise ValueError(f"shape type {kind} is no polygon")
        parts, points = struct.unpack_from("<ii", data, body + 36)
        starts = [*struct.unpack_from(f"<{parts}i", data, body + 44), points]
        flat = struct.unpack_from(f"<{2 * points}d", data, body + 44 + 4 * parts)
        every = list(zip(flat[0::2], flat[1::2]))
        yield multipolygon(grouped_rings([every[a:b] for a, b in zip(starts, starts[1:])]))


def read_shapes(spark: SparkSession, path: str) -> DataFrame:
    """(path, source_ordinal, raw, geom, problem): the features of every zipped shape file under a path.

    Read through the file system of the cluster, one archive a task. ``raw`` holds the attributes as JSON. An
    archive without exactly one shape and one attribute table, or that can't be read, gives one row with the problem.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        pick = lambda end: [m for m in z.namelist() if m.lower().endswith(end)]
                        shp, dbf = pick(".shp"), pick(".dbf")
                        if len(shp) != 1 or len(dbf) != 1:
                            raise ValueError("not one shape and one attribute table")
                        shapes, records = list(shp_polygons(z.read(shp[0]))), list(dbf_records(z.read(dbf[0])))
                    if len(shapes) != len(records):
                        raise ValueError(f"{len(shapes)} shapes for {len(records)} records")
                    rows = [(name, i, json.dumps(r, ensure_ascii=False), g, None) for i, (r, g) in enumerate(zip(records, shapes), 1)]
                except (ValueError, struct.error, zipfile.BadZipFile, IndexError) as e:
                    rows = [(name, 0, None, None, str(e)[:200] or type(e).__name__)]
                yield pd.DataFrame(rows, columns=[x.split()[0] for x in FEATURE.split(", ")])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, FEATURE)


# The field of the id, of the name, and the constants a layer must carry.
LAYERS = {
    "state": ("GEOID", "NAME", {}), "county": ("GEOID", "NAME", {}), "cd119": ("GEOID", "NAMELSAD", {"CDSESSN": "119"}), "sldu": ("GEOID", "NAMELSAD", {"LSY": "2024"}), "sldl": ("GEOID", "NAMELSAD", {"LSY": "2024"}),
    "zcta520": ("GEOID20", "ZCTA5CE20", {}), "zcta510": ("GEOID10", "ZCTA5CE10", {}), "tract": ("GEOID", "NAMELSAD", {}), "place": ("GEOID", "NAMELSAD", {}),
}


def layer_features(shapes: DataFrame, layer: str, artifact_id: str) -> tuple[DataFrame, DataFrame]:
    """(stage rows, refused rows) of a layer: id, name, state and county codes, and the geometry as read.

    A feature needs an id, a geometry and the layer's constants.
    """
    key, name, constants = LAYERS[layer]
    field = lambda f: F.nullif(F.trim(F.get_json_object("raw", f"$.{f}")), F.lit(""))
    problem = F.coalesce("problem", F.when(field(key).isNull(), "no id"), F.when(F.col("geom").isNull(), "no geometry"), *[F.when(~field(f).eqNullSafe(F.lit(v)), f"{f} is not {v}") for f, v in constants.items()])
    rows = shapes.select(
        F.lit(artifact_id).alias("artifact_id"), F.lit(layer).alias("layer"), "source_ordinal", field(key).alias("geoid"), field(name).alias("name"), field("STATEFP").alias("state_fips"), field("COUNTYFP").alias("county_fips"), "raw", "geom", problem.alias("problem")
    )
    return rows.filter("problem IS NULL").drop("problem"), rows.filter("problem IS NOT NULL").select("artifact_id", "layer", "source_ordinal", "problem")


def transformed(features: DataFrame, from_srid: int = 4269, to_srid: int = 4326) -> DataFrame:
    """Features with ``srid``: North American datum to world datum.

    The two agree within about two metres and the transformation between them without a grid file is the
    identity, which is what a spatial database applies by default; other pairs are refused.
    """
    if (from_srid, to_srid) not in ((4269, 4326), (4326, 4326), (4269, 4269)):
        raise ValueError(f"no transformation from {from_srid} to {to_srid}")
    return features.withColumn("srid", F.lit(to_srid))


def boundary_type(layer: Column) -> Column:
    """The geography a layer's features bound."""
    return F.when(layer.isin("zcta510", "zcta520"), "zcta").when(layer == "cd119", "congressional_district").otherwise(layer)


def boundaries(features: DataFrame, geography: DataFrame, vintage: str, valid_from: str | None = None, valid_to: str | None = None) -> DataFrame:
    """(geography_id, boundary_vintage, valid_from, valid_to, geom, source_artifact_id), one per place, for ``keyed.upsert``."""
    from civicloom.operators.pick import distinct_on

    placed = features.withColumn("geography_type", boundary_type(F.col("layer"))).join(geography.select("geography_id", "geography_type", "geoid"), ["geography_type", "geoid"])
    one = distinct_on(placed, ["geography_id"], [F.asc("artifact_id"), F.asc("source_ordinal")])
    return one.select("geography_id", F.lit(vintage).alias("boundary_vintage"), F.lit(valid_from).cast("date").alias("valid_from"), F.lit(valid_to).cast("date").alias("valid_to"), "geom", F.col("artifact_id").alias("source_artifact_id"))


def boundary_reconciliation(features: DataFrame, loaded: DataFrame, geography: DataFrame) -> DataFrame:
    """(layer, staged_rows, staged_geoids, loaded_boundaries, agrees): all of a layer's features became boundaries.

    ``loaded``: (geography_id, source_artifact_id). Both sides are counted before they meet.
    """
    typed = features.withColumn("geography_type", boundary_type(F.col("layer")))
    staged = typed.groupBy("layer").agg(F.count("*").alias("staged_rows"), F.countDistinct("geoid").alias("staged_geoids"))
    hit = typed.select("layer", "geography_type", "geoid", F.col("artifact_id").alias("source_artifact_id")).distinct().join(geography.select("geography_id", "geography_type", "geoid"), ["geography_type", "geoid"])
    found = hit.join(loaded.select("geography_id", "source_artifact_id").distinct(), ["geography_id", "source_artifact_id"], "left_semi").groupBy("layer").agg(F.countDistinct("geography_id").alias("loaded_boundaries"))
    out = staged.join(found, "layer", "left").withColumn("loaded_boundaries", F.coalesce("loaded_boundaries", F.lit(0)))
    return out.withColumn("agrees", (F.col("staged_geoids") == F.col("loaded_boundaries")) & (F.col("staged_rows") > 0))


# Decennial files --------------------------------------------------------------------------------------

# Summary levels kept, by the geography they are of.
SUMMARY_LEVELS = {"010": "nation", "040": "state", "050": "county", "140": "tract", "500": "congressional_district", "610": "sldu", "620": "sldl"}


def geography_lines(lines: DataFrame, line: str = "value", levels: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """((logrecno, geography_type, geoid), refused lines) of a pipe-separated geography file.

    A line needs nine fields; the third is the summary level, the eighth the record number, the ninth the long
    id whose part after US is the code. Other levels are left out.
    """
    levels = levels or SUMMARY_LEVELS
    parts = F.split(F.col(line), "[|]")
    cut = lines.select(F.col(line).alias("line"), parts.alias("f"))
    good = cut.filter(F.size("f") >= 9)
    kind = F.lit(None).cast("string")
    for level, name in levels.items():
        kind = F.when(F.trim(F.get("f", F.lit(2))) == level, name).otherwise(kind)
    code = F.substring_index(F.trim(F.get("f", F.lit(8))), "US", -1)
    rows = good.select(F.trim(F.get("f", F.lit(7))).alias("logrecno"), kind.alias("geography_type"), F.when(kind == "nation", "1").otherwise(code).alias("geoid")).filter("geography_type IS NOT NULL")
    return rows, cut.filter(F.size("f") < 9).select("line", F.lit("fewer than nine fields").alias("problem"))


def segment_lines(lines: DataFrame, line: str = "value", skip: int = 5) -> DataFrame:
    """(logrecno, fields) of a numbered segment: the fifth field is the record number, the values follow."""
    parts = F.split(F.col(line), "[|]")
    return lines.select(F.trim(F.get(parts, F.lit(4))).alias("logrecno"), F.slice(parts, skip + 1, F.greatest(F.size(parts) - skip, F.lit(0))).alias("fields"))


def segment_matrix(columns: DataFrame, segment: int) -> DataFrame:
    """(variable_id, table_id, position) of a segment's values, counted from 0 in the order of the list.

    ``columns``: (segment, ordinal, variable_id), as listed by the publisher; the table is the variable's part
    before the underscore.
    """
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy("segment").orderBy("ordinal")) - 1
    return columns.filter(F.col("segment") == segment).withColumn("position", rank).select("variable_id", F.substring_index("variable_id", "_", 1).alias("table_id"), "position")
