"""Well-known binary geometry: polygons to edges, rings to polygons, points."""

from __future__ import annotations

import struct
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

Ring = Sequence[tuple[float, float]]


def multipolygon(polygons: Sequence[Sequence[Ring]]) -> bytes:
    """A MultiPolygon of polygons, each an outer ring and its holes, least byte first."""
    out = [struct.pack("<BII", 1, 6, len(polygons))]
    for rings in polygons:
        out.append(struct.pack("<BII", 1, 3, len(rings)))
        for ring in rings:
            out.append(struct.pack(f"<I{2 * len(ring)}d", len(ring), *[v for p in ring for v in p]))
    return b"".join(out)


def _points(x: pd.Series, y: pd.Series) -> pd.Series:
    return pd.Series([None if a != a or b != b else struct.pack("<BIdd", 1, 1, a, b) for a, b in zip(x.astype("float64"), y.astype("float64"))])


def point_wkb(x: Column, y: Column) -> Column:
    """A point, longitude first; null where either coordinate is."""
    return F.pandas_udf(_points, BinaryType())(x.cast("double"), y.cast("double"))


def polygon_edges(data: bytes) -> list[tuple[float, float, float, float]]:
    """Edges (x1, y1, x2, y2) of all rings of a Polygon or MultiPolygon; other shapes have none.

    Takes either byte order, also per part, a Z or M value per point in either notation, and a reference
    system id. Rings that aren't closed are closed.
    """
    edges: list[tuple[float, float, float, float]] = []

    def shape(at: int) -> int:
        order = "<" if data[at] else ">"
        (kind,) = struct.unpack_from(order + "I", data, at + 1)
        at += 5
        if kind & 0x20000000:
            at += 4
        width = 2 + bool(kind & 0x80000000) + bool(kind & 0x40000000)
        kind &= 0xFFFF
        width = {0: width, 1: 3, 2: 3, 3: 4}[kind // 1000]
        kind %= 1000
        (n,) = struct.unpack_from(order + "I", data, at)
        at += 4
        if kind == 6:
            for _ in range(n):
                at = shape(at)
        elif kind == 3:
            for _ in range(n):
                (m,) = struct.unpack_from(order + "I", data, at)
                values = struct.unpack_from(f"{order}{m * width}d", data, at + 4)
                at += 4 + 8 * m * width
                xs, ys = values[0::width], values[1::width]
                for i in range(m):
                    j = i + 1 if i + 1 < m else 0
                    if xs[i] != xs[j] or ys[i] != ys[j]:
                        edges.append((xs[i], ys[i], xs[j], ys[j]))
        return at

    shape(0)
    return edges
