"""Items of varying length into containers of fixed capacity with little space left unused."""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicloom.session import stage

#: Hash shards in which items of one size are numbered side by side, so no size is one task's.
SHARDS = 64


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Bins for items given as size -> number: [(sizes in the bin, how many bins are alike)].

    Best two fit. A bin is filled greedily, with the largest item left that fits, until none does. Then its
    smallest item gives way to the two unpacked items that together fill the widened gap most tightly,
    if they fill it better. Which bin comes out depends only on which sizes are left in what number, so as
    many alike are closed at once as the numbers allow. Each step takes one size as often as it goes and leaves less
    than half of what there was of it, less than capacity / size after the first time, so a size limits
    log2(capacity) + 2 steps at most: the steps depend on the sizes, not on the number of items.
    """
    left = {s: n for s, n in counts.items() if 0 < s <= capacity and n > 0}
    sizes = np.array(sorted(left), dtype=np.int64)
    bins: list[tuple[dict[int, int], int]] = []
    while left:
        listed = sizes.tolist()
        used: Counter[int] = Counter()
        gap = capacity
        at = len(listed)
        while gap > 0 and (at := bisect_right(listed, gap, 0, at)) > 0:
            size = listed[at - 1]
            take = min(gap // size, left[size])
            used[size] += take
            gap -= take * size
            at -= 1
        if gap > 0:
            smallest = min(used)
            room = gap + smallest
            free = np.array([left[s] - used[s] + (s == smallest) for s in listed], dtype=np.int64)
            free[bisect_right(listed, smallest) - 1] -= 1  # the item that gives way isn't one of the two
            usable = sizes[free > 0]
            if len(usable):
                partner = np.searchsorted(usable, room - usable, side="right") - 1
                mine = np.arange(len(usable))
                spare = free[free > 0] > 1
                partner = np.where((partner > mine) | ((partner == mine) & spare), partner, np.where(partner >= mine, mine - 1, partner))
                sums = np.where(partner >= 0, usable + usable[np.maximum(partner, 0)], 0)
                k = int(np.argmax(sums))
                if smallest < sums[k] <= room:
                    used[smallest] -= 1
                    used[int(usable[k])] += 1
                    used[int(usable[partner[k]])] += 1
        used = Counter({s: n for s, n in used.items() if n > 0})
        times = min(left[s] // n for s, n in used.items())
        bins.append((dict(used), times))
        for s, n in used.items():
            left[s] -= n * times
        if any(left[s] == 0 for s in used):
            left = {s: n for s, n in left.items() if n > 0}
            sizes = np.array(sorted(left), dtype=np.int64)
    return bins


def places(bins: list[tuple[dict[int, int], int]]) -> tuple[dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], int]:
    """Per size: (first rank, first container, items of the size in a container) of each kind of bin; and the number of containers."""
    rows: dict[int, list[tuple[int, int, int]]] = {}
    ranks: Counter[int] = Counter()
    total = 0
    for used, times in bins:
        for size, n in used.items():
            rows.setdefault(size, []).append((ranks[size], total, n))
            ranks[size] += n * times
        total += times
    return {s: tuple(np.array(c, dtype=np.int64) for c in zip(*r)) for s, r in rows.items()}, total


def pack(items: DataFrame, key: str, size: str, capacity: int) -> DataFrame:
    """(key, piece, first, size, container): every item in a container of ``capacity``, none overfull.

    An item is split only if it alone exceeds the capacity: into full pieces and a rest; ``first`` is where
    the piece begins. Items of size 0 (or null) take no space and are spread over the containers. Items
    with a null key are items like any other. An empty table gives an empty result.

    The driver plans on the number of items of each size, at most ``capacity`` numbers however many
    items there are; the items are numbered within their size shard by shard, and look their container up.
    """
    kept = items.select(F.col(key).alias("key"), F.greatest(F.coalesce(F.col(size).cast("long"), F.lit(0)), F.lit(0)).alias("whole"))
    full = F.floor(F.col("whole") / capacity)
    pieces = kept.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("whole") / capacity) - 1, F.lit(0).cast("long")))))
    pieces = pieces.withColumn("size", F.when(F.col("piece") < full, F.lit(capacity).cast("long")).otherwise(F.col("whole") - full * capacity))
    pieces = pieces.select("key", F.col("piece").cast("int").alias("piece"), (F.col("piece") * capacity).alias("first"), F.col("size").cast("int").alias("size"), F.pmod(F.xxhash64("key", "piece"), F.lit(SHARDS)).cast("int").alias("shard"))
    pieces = stage(pieces, "pieces")
    cells = pieces.groupBy("size", "shard").agg(F.count("*").alias("n"))
    known = cells.groupBy("size").agg(F.sum("n").alias("n")).collect()  # at most capacity + 1 rows
    table, n_bins = places(plan_bins({r["size"]: r["n"] for r in known}, capacity))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("size").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = cells.select("size", "shard", before.alias("offset"))
    number = F.row_number().over(Window.partitionBy("size", "shard").orderBy("key", "piece"))
    ranked = pieces.withColumn("rank", number - 1).join(offsets, ["size", "shard"]).withColumn("rank", F.col("rank") + F.col("offset"))
    ranked = ranked.withColumn("spread", F.pmod(F.xxhash64("key"), F.lit(max(1, n_bins)))).select("key", "piece", "first", "size", "rank", "spread")

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch["spread"].to_numpy(np.int64).copy()
            sizes, ranks = batch["size"].to_numpy(), batch["rank"].to_numpy()
            order = np.argsort(sizes, kind="stable")
            cuts = np.flatnonzero(np.diff(sizes[order])) + 1
            for part in np.split(order, cuts):
                if len(part) and sizes[part[0]] > 0:
                    starts, first_bin, each = table[int(sizes[part[0]])]
                    at = np.searchsorted(starts, ranks[part], side="right") - 1
                    out[part] = first_bin[at] + (ranks[part] - starts[at]) // each[at]
            yield batch[["key", "piece", "first", "size"]].assign(container=out)

    kind = kept.schema["key"].dataType.simpleString()
    return ranked.mapInPandas(assign, f"key {kind}, piece int, first long, size int, container long")
