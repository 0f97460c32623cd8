"""Array expressions whose cost grows in proportion to the array."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import let

CHUNK = 64


def running_sum(steps: Column) -> Column:
    """Inclusive running sums of an array of INT.

    Appending to an array copies it, so sums are made per chunk and shifted by
    the sums of the chunks before.
    """

    def append(sums: Column, x: Column) -> Column:
        return F.concat(sums, F.array(F.coalesce(F.get(sums, F.size(sums) - 1), F.lit(0)) + x))

    none = F.array().cast("array<int>")
    chunk_ids = F.sequence(F.lit(0), (F.greatest(F.size(steps) - 1, F.lit(0)) / CHUNK).cast("int"))
    parts = F.transform(chunk_ids, lambda c: F.aggregate(F.slice(steps, c * CHUNK + 1, CHUNK), none, append))

    def shift(p: Column) -> Column:
        sums = F.transform(p, lambda x: F.coalesce(F.get(x, F.size(x) - 1), F.lit(0)))
        return let(F.aggregate(sums, F.array(F.lit(0)), append), lambda before: F.flatten(
            F.transform(p, lambda xs, c: F.transform(xs, lambda x: x + F.get(before, c)))))

    return let(parts, shift)
