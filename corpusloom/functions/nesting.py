"""Nested, delimited regions of a text, found without Python.

A text is cut at its delimiters.  One fold over the delimiters carries the
nesting depth and writes one mark per delimiter, in chunks, because appending
copies what is there; the text between them never enters the fold.  Regions do
not overlap, so the closer of a region is found by counting closers.

Marks: ``0`` a closer outside every region (kept), ``x`` the same but dropped,
``1`` opens an outermost region, ``2`` lies inside one, ``3`` closes one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.arrays import running_sum
from corpusloom.functions.text import let

MARKS = 256  # marks of a chunk


def folded_marks(delimiters: Column, start: Column, move: Callable[[Column, Column], Column]) -> Column:
    """Mark string for the delimiters: ``move(state, delimiter)`` is the struct ``(state, mark)`` that follows."""
    begin = F.struct(start.alias("state"), F.lit("").alias("marks"), F.array().cast("array<string>").alias("done"))

    def step(before: Column, d: Column) -> Column:
        full = F.length(before["marks"]) >= MARKS
        done = F.when(full, F.concat(before["done"], F.array(before["marks"]))).otherwise(before["done"])
        marks = F.when(full, "").otherwise(before["marks"])
        return let(move(before["state"], d), lambda m: F.struct(
            m["state"].alias("state"), F.concat(marks, m["mark"]).alias("marks"), done.alias("done")))

    return F.aggregate(delimiters, begin, step, lambda s: F.concat(F.array_join(s["done"], ""), s["marks"]))


def _marks(delimiters: Column, opens: Callable[[Column, Column], Column],
           closes: Callable[[Column], Column], stray: str) -> Column:
    """Mark string for the delimiters; ``opens`` sees delimiter and depth."""

    def move(depth: Column, d: Column) -> Column:
        top = depth == 0

        def to(new_depth: Column, mark: Column) -> Column:
            return F.struct(new_depth.alias("state"), mark.alias("mark"))

        return (
            F.when(opens(d, depth), to(depth + 1, F.when(top, "1").otherwise("2")))
            .when(~top & closes(d), to(depth - 1, F.when(depth == 1, "3").otherwise("2")))
            .otherwise(to(depth, F.when(top, stray).otherwise("2")))
        )

    return folded_marks(delimiters, F.lit(0), move)


class _Cut:
    """A text cut at its delimiters, with everything bound once."""

    def __init__(self, cut: Column):
        self.delimiters, self.texts, self.flags, self.closers, self.closed = (
            cut["delimiters"], cut["texts"], cut["flags"], cut["closers"], cut["closed"]
        )

    def flag(self, i: Column) -> Column:
        return F.element_at(self.flags, i + 1)

    def text_after(self, i: Column) -> Column:
        return F.element_at(self.texts, i + 2)

    def close_of(self, i: Column) -> Column:
        """1-based place of the delimiter closing the region opened at ``i``, or 0."""
        return F.coalesce(F.get(self.closers, F.get(self.closed, i)), F.lit(0))

    def inner(self, i: Column, close: Column) -> Column:
        """Text between the delimiter at ``i`` and the 1-based place ``close``."""
        count = F.greatest(close - i - 2, F.lit(0))
        return F.concat(self.text_after(i), F.array_join(F.zip_with(
            F.slice(self.delimiters, i + 2, count), F.slice(self.texts, i + 3, count),
            lambda d, t: F.concat(d, t),
        ), ""))

    def rebuild(self, piece: Callable[[Column, Column, Column], Column]) -> Column:
        """Leading text plus ``piece(delimiter, place, flag)`` for every delimiter."""
        parts = F.transform(
            self.delimiters, lambda d, i: let(self.flag(i), lambda f: piece(d, i, f))
        )
        return F.concat(F.element_at(self.texts, 1), F.array_join(parts, ""))


def _cut(text: Column, pattern: str, marks: Callable[[Column], Column], body: Callable[[_Cut], Column]) -> Column:
    delimiters = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def with_marks(ds: Column) -> Column:
        def with_flags(flags: Column) -> Column:
            # Places of the closers, and how many of them there are up to each delimiter.
            closers = F.filter(F.transform(flags, lambda f, i: F.when(f == "3", i + 1)), lambda i: i.isNotNull())
            closed = running_sum(F.transform(flags, lambda f: F.when(f == "3", 1).otherwise(0)))
            return let(
                F.struct(
                    ds.alias("delimiters"), F.split(text, pattern, -1).alias("texts"),
                    flags.alias("flags"), closers.alias("closers"), closed.alias("closed"),
                ),
                lambda cut: body(_Cut(cut)),
            )

        return let(F.split(marks(ds), ""), with_flags)

    return let(delimiters, with_marks)


def drop_regions(text: Column, pattern: str, opener: str, closer: str, keep_stray_closer: bool) -> Column:
    """Text outside the regions; an unclosed region reaches the end."""
    return _cut(
        text, pattern,
        lambda ds: _marks(ds, lambda d, _depth: d == opener, lambda d: d == closer, "0" if keep_stray_closer else "x"),
        lambda cut: cut.rebuild(
            lambda d, i, f: F.when(f == "0", F.concat(d, cut.text_after(i)))
            .when(f.isin("x", "3"), cut.text_after(i)).otherwise("")
        ),
    )


def map_regions(text: Column, pattern: str, opener: str, closer: str,
                render: Callable[[Column], Column]) -> Column:
    """Replace every outermost region by ``render(inner text)``.

    Delimiters nested inside a region stay in the inner text; an unclosed
    region reaches the end of the text and loses the width of its closer there.
    """

    def piece(cut: _Cut, d: Column, i: Column, f: Column) -> Column:
        close = cut.close_of(i)
        open_end = let(
            cut.inner(i, F.size(cut.delimiters) + 1),
            lambda rest: F.substring(rest, F.lit(1), F.greatest(F.length(rest) - len(closer), F.lit(0))),
        )
        inner = F.when(close > 0, cut.inner(i, close)).otherwise(open_end)
        return (
            F.when(f == "0", F.concat(d, cut.text_after(i))).when(f == "3", cut.text_after(i))
            .when(f == "1", let(inner, render)).otherwise("")
        )

    return _cut(
        text, pattern, lambda ds: _marks(ds, lambda d, _depth: d == opener, lambda d: d == closer, "0"),
        lambda cut: cut.rebuild(lambda d, i, f: piece(cut, d, i, f)),
    )
