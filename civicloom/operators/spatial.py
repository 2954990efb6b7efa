"""Points near other points, and regions that contain points."""

from __future__ import annotations

from collections.abc import Iterator
from math import sin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicloom.functions.wkb import polygon_edges
from civicloom.operators.skew import BROADCAST_ROWS, block_join, lookup_join, salted_join
from civicloom.session import stage

EARTH_M = 6_371_008.8
#: Height of a latitude strip and width of a longitude cell, in degrees.
STRIP, CELL = 0.25, 1.0
#: Edges kept in broadcast strips at most; more are joined by a salted shuffle.
BROADCAST_EDGES = 500_000
#: Edges of a region in one strip that are kept in one row; a strip with more is cut into blocks.
BLOCK_EDGES = 2_000
_STRIP = ["region", "shape", "strip"]


def located(rows: DataFrame, key: str, lat: str, lon: str) -> DataFrame:
    """(key, lat, lon), distinct, of the rows whose coordinates are both present and possible."""
    ok = F.col(key).isNotNull() & F.col(lat).between(-90, 90) & F.col(lon).between(-180, 180)
    return rows.filter(ok).select(F.col(key).alias("key"), F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon")).distinct()


def sphere_metres(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance (haversine) of two points in degrees."""
    a1, a2 = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((a2 - a1) / 2), 2) + F.cos(a1) * F.cos(a2) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.asin(F.least(F.lit(1.0), F.sqrt(h))) * (2 * EARTH_M)


def near_pairs(points: DataFrame, metres: float) -> DataFrame:
    """(key_a, key_b), key_a < key_b: the pairs of different keys at most ``metres`` apart.

    ``points`` is as ``located`` gives. Points become places in space, in cubes of twice the
    distance; a point also visits the cubes its surroundings reach, and pairs are sought at the smaller
    key's own cube, so each is met once, poles and the date line included. A cube that holds very many
    points is cut into blocks, so no task gets all of it.
    """
    side = 2 * metres
    la, lo = F.radians("lat"), F.radians("lon")
    xyz = points.withColumns({"x": F.cos(la) * F.cos(lo) * EARTH_M, "y": F.cos(la) * F.sin(lo) * EARTH_M, "z": F.sin(la) * EARTH_M})
    cube = lambda c: F.floor(c / side).cast("int")
    reach = metres * 1.000001
    own = xyz.select(*[cube(F.col(c)).alias(f"c{c}") for c in "xyz"], *[F.col(c).alias(f"{c}_a") for c in ("key", "lat", "lon", "x", "y", "z")])
    span = lambda c: F.explode(F.sequence(cube(F.col(c) - reach), cube(F.col(c) + reach)))
    visits = xyz
    for c in "xyz":
        visits = visits.withColumn(f"c{c}", span(c))
    visits = visits.select("cx", "cy", "cz", *[F.col(c).alias(f"{c}_b") for c in ("key", "lat", "lon", "x", "y", "z")])
    chord = 2 * EARTH_M * sin(metres / (2 * EARTH_M)) * 1.000001
    square = sum(((F.col(f"{c}_a") - F.col(f"{c}_b")) * (F.col(f"{c}_a") - F.col(f"{c}_b")) for c in "xyz"), F.lit(0.0))
    pairs = block_join(own, visits, ["cx", "cy", "cz"]).filter((F.col("key_a") < F.col("key_b")) & (square <= chord * chord))
    exact = sphere_metres(F.col("lat_a"), F.col("lon_a"), F.col("lat_b"), F.col("lon_b")) <= metres
    return pairs.filter(exact).select("key_a", "key_b").distinct()


def region_strips(regions: DataFrame, region: str, geom: str, block_edges: int = BLOCK_EDGES) -> DataFrame:
    """(region, shape, strip, block, x_low, x_high, edges): the edges of each region in each latitude strip they touch.

    Equal shapes of a region count once. A strip with more than ``block_edges`` edges is cut into blocks of about so many, so
    no row holds more than about that. x_low and x_high bound the region in that block of the strip.
    """
    shapes = regions.filter(F.col(region).isNotNull() & F.col(geom).isNotNull()).select(F.col(region).alias("region"), F.col(geom).alias("geom")).withColumn("shape", F.sha2("geom", 256)).dropDuplicates(["region", "shape"])

    def edges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(r, s, *e) for r, s, g in zip(batch["region"], batch["shape"], batch["geom"]) for e in polygon_edges(bytes(g))]
            yield pd.DataFrame(out, columns=["region", "shape", "x1", "y1", "x2", "y2"])

    listed = stage(shapes.mapInPandas(edges, "region string, shape string, x1 double, y1 double, x2 double, y2 double"), "edges")
    strip = lambda y: F.floor(y / STRIP).cast("int")
    cut = listed.withColumn("strip", F.explode(F.sequence(strip(F.least("y1", "y2")), strip(F.greatest("y1", "y2")))))
    sizes = cut.groupBy(*_STRIP).count()
    if (sizes.agg(F.max("count")).first()[0] or 0) <= block_edges:
        blocked = cut.withColumn("block", F.lit(0))
    else:
        large = stage(sizes.filter(F.col("count") > block_edges).select(*_STRIP, F.ceil(F.col("count") / block_edges).cast("int").alias("_n")), "large-strips")
        known = lookup_join(cut, large, _STRIP, large.count())
        blocked = known.withColumn("block", F.pmod(F.xxhash64("x1", "y1", "x2", "y2"), F.coalesce("_n", F.lit(1))).cast("int")).drop("_n")
    return blocked.groupBy(*_STRIP, "block").agg(
        F.min(F.least("x1", "x2")).alias("x_low"), F.max(F.greatest("x1", "x2")).alias("x_high"), F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("edges")
    )


def containing_regions(points: DataFrame, regions: DataFrame, region: str, geom: str, broadcast_edges: int = BROADCAST_EDGES, block_edges: int = BLOCK_EDGES) -> DataFrame:
    """(key, region): the regions whose shape contains each point of ``points`` (as ``located`` gives).

    Crossing parity. The edges of all rings are binned into latitude strips; a point meets the regions of
    its strip whose extent includes its longitude, and the crossings of the ray to its east with the
    edges of one region are counted, over all blocks of the strip: odd is inside, so holes are outside and ring directions don't matter.
    An edge owns its lower end and not its upper, so a vertex counts once. A point exactly on an
    edge or vertex, of a hole too, counts as contained.
    """
    strips = stage(region_strips(regions, region, geom, block_edges), "region-strips")
    measured = strips.agg(F.coalesce(F.sum(F.size("edges")), F.lit(0)).alias("n"), F.count("*").alias("rows"), F.coalesce(F.max("block"), F.lit(0)).alias("blocks")).first()
    small = measured["n"] <= broadcast_edges
    limit = measured["rows"] if small else -1
    cell = lambda x: F.floor(x / CELL).cast("int")
    whole = strips.groupBy(*_STRIP).agg(F.min("x_low").alias("x_low"), F.max("x_high").alias("x_high")) if measured["blocks"] else strips
    extents = whole.select(*_STRIP, "x_low", "x_high", F.explode(F.sequence(cell(F.col("x_low")), cell(F.col("x_high")))).alias("cell"))
    binned = points.withColumn("strip", F.floor(F.col("lat") / STRIP).cast("int")).withColumn("cell", cell(F.col("lon")))
    n_extents = extents.count()
    candidates = salted_join(binned, extents, ["strip", "cell"], n_extents, BROADCAST_ROWS if small else -1).filter(F.col("lon").between(F.col("x_low"), F.col("x_high"))).select("key", "lat", "lon", "region", "shape", "strip")
    met = salted_join(candidates, strips.select(*_STRIP, "edges"), _STRIP, measured["rows"], limit)
    px, py = F.col("lon"), F.col("lat")

    def crossing(e: Column) -> Column:
        apart = (e["y1"] > py) != (e["y2"] > py)
        return apart & (px < e["x1"] + (py - e["y1"]) * (e["x2"] - e["x1"]) / F.when(apart, e["y2"] - e["y1"]).otherwise(1.0))

    def touching(e: Column) -> Column:
        within = px.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])) & py.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
        return within & ((e["x2"] - e["x1"]) * (py - e["y1"]) == (e["y2"] - e["y1"]) * (px - e["x1"]))

    crossings, touches = F.size(F.filter("edges", crossing)), F.exists("edges", touching)
    if not measured["blocks"]:
        return met.filter((crossings % 2 == 1) | touches).select("key", "region").distinct()
    each = met.groupBy("key", "lat", "lon", "region", "shape").agg(F.sum(crossings).alias("n"), F.max(touches).alias("on"))
    return each.filter((F.col("n") % 2 == 1) | F.col("on")).select("key", "region").distinct()
