from __future__ import annotations

import math
import random
import struct

from civicloom.functions.wkb import polygon_edges
from civicloom.operators.spatial import EARTH_M, containing_regions, located, near_pairs


def wkb(rings, order="<"):
    body = struct.pack(order + "I", len(rings))
    for r in rings:
        body += struct.pack(order + "I", len(r)) + b"".join(struct.pack(order + "2d", *p) for p in r)
    return struct.pack("B", order == "<") + struct.pack(order + "I", 3) + body


def multi(polygons):
    return b"\x00" + struct.pack(">I", 6) + struct.pack(">I", len(polygons)) + b"".join(polygons)


def metres(a, b):
    x, y = math.radians(a[0]), math.radians(b[0])
    h = math.sin((y - x) / 2) ** 2 + math.cos(x) * math.cos(y) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * EARTH_M * math.asin(min(1, math.sqrt(h)))


def test_near_against_all_pairs(spark):
    rng = random.Random(1)
    rows = [(f"k{i:03}", 40 + rng.random() * 0.02, -90 + rng.random() * 0.02) for i in range(250)]
    rows += [(f"p{i}", 89.9999 - rng.random() * 0.002, rng.random() * 360 - 180) for i in range(40)]
    rows += [("d1", 0.0, 179.9995), ("d2", 0.0, -179.9995), ("n1", None, 1.0), ("n2", 91.0, 1.0), ("n3", float("nan"), 1.0), (None, 0.0, 179.9995)]
    rows += [(f"same{i:02}", 10.0, 10.0) for i in range(30)] + [("same00", 10.0, 10.0)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "key string, lat double, lon double, x string")
    good = sorted({r for r in rows if r[0] and r[1] is not None and abs(r[1]) <= 90})
    want = {(a[0], b[0]) for i, a in enumerate(good) for b in good[i + 1 :] if a[0] != b[0] and metres(a[1:], b[1:]) <= 250}
    got = [tuple(r) for r in near_pairs(located(df, "key", "lat", "lon"), 250.0).collect()]
    assert len(got) == len(set(got)) and set(got) == want and ("d1", "d2") in want


def test_regions_with_holes_parts_and_boundaries(spark):
    square = [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]
    hole = [(1, 1), (1, 2), (2, 2), (2, 1), (1, 1)]
    regions = [("holed", wkb([square, hole])), ("holed", wkb([square, hole])), ("parts", multi([wkb([square], ">"), wkb([[(10, 0), (11, 0), (11, 1), (10, 1)]])])), ("none", None)]
    r = spark.createDataFrame(regions, "region string, geom binary")
    points = {"in": (3, 3), "hole": (1.5, 1.5), "second": (0.5, 10.5), "out": (5, 5), "vertex": (0, 0), "edge": (2, 0), "rim": (1, 1.5), "left": (2, -1)}
    p = spark.createDataFrame([(k, float(a), float(b)) for k, (a, b) in points.items()], "key string, lat double, lon double")
    want = {("in", "holed"), ("in", "parts"), ("hole", "parts"), ("second", "parts"), ("vertex", "holed"), ("vertex", "parts"), ("edge", "holed"), ("edge", "parts"), ("rim", "holed"), ("rim", "parts")}
    for limit in (500_000, 0):
        for block in (2_000, 2):
            assert {tuple(x) for x in containing_regions(p, r, "region", "geom", limit, block).collect()} == want
    assert containing_regions(p, r.limit(0), "region", "geom").count() == 0
    assert len(polygon_edges(regions[0][1])) == 8


def test_whole_tables_against_ray_casting(spark):
    from civicloom.queries.data_problems import p5_found

    d = "/root/testdata/sf0.001"
    shapes = {f"{r.layer}:{r.geoid}": polygon_edges(bytes(r.geom)) for r in spark.read.parquet(f"{d}/tiger_feature.parquet").collect()}
    offices = {(r.office_key, r.latitude, r.longitude) for r in spark.read.parquet(f"{d}/profile_office.parquet").collect() if r.latitude is not None and r.longitude is not None and abs(r.latitude) <= 90 and abs(r.longitude) <= 180}
    want = set()
    for k, y, x in offices:
        for region, edges in shapes.items():
            if sum((y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1) for x1, y1, x2, y2 in edges) % 2:
                want.add((k, region))
    got = {(r.key_a, r.key_b) for r in p5_found(spark, d).filter("relation = 'within'").collect()}
    assert got == want and want
