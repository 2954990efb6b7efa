"""A Bloom filter over keys that is built and probed inside the JVM."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.classic.column import Column as ClassicColumn
from pyspark.sql.internal import InternalFunction

#: Bits of one filter at most (1 MiB), the keys it holds with one false positive in a hundred, and filters at most. A filter
#: is a literal of the plan, so 16 MiB bound what is sent to the executors whatever the number of keys. Up to
#: 14 million keys the error stays at 1 %; at 28 million it is about 10 %, at 50 million a third, and the exact
#: check of what passes then does the work.
MAX_BITS, FILTER_KEYS, MAX_FILTERS = 1 << 23, 875_000, 16


def build_filter(keys: DataFrame, column: str, expected: int, fpp: float = 0.01, filter_keys: int = FILTER_KEYS) -> list[bytes]:
    """Serialised Bloom filters of the non-null values of ``column``, one per range of their hashes; none if there are no values.

    The number of filters grows with the keys. Every task folds its keys into filters of fixed size, and only filters
    are shuffled.
    """
    shards = min(MAX_FILTERS, max(1, math.ceil(expected / filter_keys)))
    items = max(1, math.ceil(expected / shards))
    bits = min(MAX_BITS, max(1024, math.ceil(-items * math.log(fpp) / math.log(2) ** 2)))
    agg = InternalFunction._invoke_internal_function_over_columns(
        "bloom_filter_agg", F.xxhash64(column), F.lit(min(items, 4_000_000)).cast("long"), F.lit(bits).cast("long")
    )
    rows = keys.filter(F.col(column).isNotNull()).groupBy(_shard(F.col(column), shards).alias("s")).agg(agg.alias("f")).collect()  # a row per filter
    found = {r["s"]: bytes(r["f"]) for r in rows if r["f"] is not None}
    return [found.get(i, b"") for i in range(shards)] if found else []


def _shard(column: Column, shards: int) -> Column:
    """The range of a key's hash; another hash than the filters use, so that a filter's bits stay evenly spread."""
    return F.pmod(F.hash(column), F.lit(shards)).cast("int")


def might_contain(filters: list[bytes], column: Column) -> Column:
    """True where the filters can't rule ``column`` out; without a filter nothing is contained."""
    if not filters:
        return F.lit(False)
    from pyspark.sql import SparkSession

    jvm = SparkSession.active().sparkContext._jvm
    wrap = jvm.org.apache.spark.sql.classic.ExpressionUtils

    def one(serialised: bytes) -> Column:
        if not serialised:
            return F.lit(False)
        expr = jvm.org.apache.spark.sql.catalyst.expressions.BloomFilterMightContain(
            wrap.expression(F.lit(bytearray(serialised))._jc), wrap.expression(F.xxhash64(column)._jc)
        )
        return F.coalesce(ClassicColumn(wrap.column(expr)), F.lit(False))

    if len(filters) == 1:
        return one(filters[0])
    shard, out = _shard(column, len(filters)), F.lit(False)
    for i, serialised in enumerate(filters):
        out = F.when(shard == i, one(serialised)).otherwise(out)
    return out
