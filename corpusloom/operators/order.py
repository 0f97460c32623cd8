"""Explicit row order.

Spark tables have no order, yet "first wins" needs one.  Every corpus frame
therefore carries ``ord``, one LONG that sorts by source, then by row.  It
depends on the data only, never on partitioning, and a fixed-width key keeps
``min`` inside hash aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ROW_BITS = 53  # row position inside a source
FILE_ROW_BITS = 33  # row position inside one file of a source
MAX_SOURCES = 1 << (63 - ROW_BITS)
MAX_FILES = 1 << (ROW_BITS - FILE_ROW_BITS)


def order_key(source_ord: Column, row_ord: Column) -> Column:
    return F.shiftleft(source_ord.cast("bigint"), ROW_BITS) + row_ord


def source_of(ord_: Column) -> Column:
    """Position of the source in the source list."""
    return F.shiftright(ord_, ROW_BITS).cast("int")


def sort_hex(key: Column) -> Column:
    """A LONG >= 0 as fixed-width hex, so that text order is number order."""
    return F.lpad(F.hex(key), 16, "0")


def shuffle_key(seed: int, *parts: Column) -> Column:
    """Pseudo-random order of rows: a hash of the seed and the row identity.

    Independent of partitioning and reproducible in any engine with SHA-256.
    """
    return F.sha2(F.concat_ws("#", F.lit(str(seed)), *[p.cast("string") for p in parts]), 256)
