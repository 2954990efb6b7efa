"""Column expressions on strings that several operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Unicode counts as white space.
WHITE_SPACE = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip(col: Column) -> Column:
    """``col`` without white space of any kind at both ends; null stays null."""
    return F.btrim(col, F.lit(WHITE_SPACE))


def loose_key(col: Column) -> Column:
    """A key as references compare it: lower case, no white space at the ends."""
    return F.lower(strip(col))
