"""Rows by their place in a long order, found by counting instead of sorting.

A few rows of an interval of the order are drawn as pivots, and one pass counts the
rows in front of each. The interval between the two pivots around the wanted place is
searched next, until it is short. Every pass reads sort columns only, in rows the scan
cannot rule out by the leading one, and returns a handful of numbers: nothing is
shuffled, and no task holds what lies in front of the place.

Rows that are alike in all sort columns cannot be told apart; an interval of such rows
is not searched further.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows drawn from an interval; each is one count of the pass.
PIVOTS = 32

#: Types whose values can be drawn and compared with.
COMPARED = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)


@dataclass(frozen=True)
class OrderKey:
    """A column of the order."""

    name: str
    dtype: T.DataType
    descending: bool = False
    missing_first: bool = False

    def column(self) -> Column:
        column = F.col(self.name)
        if self.descending:
            return column.desc_nulls_first() if self.missing_first else column.desc_nulls_last()
        return column.asc_nulls_first() if self.missing_first else column.asc_nulls_last()

    def drawn(self) -> Column:
        """The value in a form that reaches Python and comes back unchanged."""
        column = F.col(self.name)
        if isinstance(self.dtype, T.TimestampType):
            column = F.unix_micros(column)
        elif isinstance(self.dtype, T.TimestampNTZType):
            column = column.cast("string")
        return column.alias(self.name)

    def literal(self, value) -> Column:
        if isinstance(self.dtype, T.TimestampType):
            return F.timestamp_micros(F.lit(value))
        return F.lit(value).cast(self.dtype)

    def before(self, value) -> Column:
        """Whether a row's value comes before ``value``; never NULL."""
        column = F.col(self.name)
        if value is None:
            return F.lit(False) if self.missing_first else column.isNotNull()
        bound = self.literal(value)
        before = F.coalesce(column > bound if self.descending else column < bound, F.lit(False))
        return column.isNull() | before if self.missing_first else before

    def at_or_after(self, value) -> Column:
        """The complement, in a form scans can evaluate."""
        column = F.col(self.name)
        if value is None:
            return F.lit(True) if self.missing_first else column.isNull()
        bound = self.literal(value)
        after = column <= bound if self.descending else column >= bound
        return after if self.missing_first else column.isNull() | after

    def at_or_before(self, value) -> Column:
        column = F.col(self.name)
        if value is None:
            return column.isNull() if self.missing_first else F.lit(True)
        bound = self.literal(value)
        before = column >= bound if self.descending else column <= bound
        return column.isNull() | before if self.missing_first else before

    def same(self, value) -> Column:
        return F.col(self.name).isNull() if value is None else F.col(self.name).eqNullSafe(self.literal(value))


@dataclass(frozen=True)
class Interval:
    """Rows from ``first`` on and in front of ``end``, both rows of the order or None;
    ``skipped`` rows lie in front of it, ``size`` in it."""

    first: tuple | None = None
    end: tuple | None = None
    skipped: int = 0
    size: int | None = field(default=None)


class Order:
    """A total order over the rows of a DataFrame."""

    def __init__(self, df: DataFrame, keys: Sequence[OrderKey]):
        self.df, self.keys = df, list(keys)

    def columns(self) -> list[Column]:
        return [key.column() for key in self.keys]

    def before(self, row: tuple) -> Column:
        found = F.lit(False)
        for key, value in zip(reversed(self.keys), reversed(row), strict=True):
            found = key.before(value) | (key.same(value) & found)
        return found

    def inside(self, interval: Interval) -> DataFrame:
        df, lead = self.df, self.keys[0]
        if interval.first is not None:
            df = df.filter(lead.at_or_after(interval.first[0])).filter(~self.before(interval.first))
        if interval.end is not None:
            df = df.filter(lead.at_or_before(interval.end[0])).filter(self.before(interval.end))
        return df

    def split(self, interval: Interval) -> list[Interval]:
        """The interval cut at pivots, in order, with exact sizes."""
        part = self.inside(interval).select(*(key.name for key in self.keys))
        names = [key.name for key in self.keys]
        # the smallest hashes: a fair draw that a retried task repeats
        drawn = part.orderBy(F.xxhash64(*names), *self.columns()).limit(PIVOTS).select(*(key.drawn() for key in self.keys)).collect()
        pivots = list(dict.fromkeys(tuple(row) for row in drawn))
        counts = part.agg(F.count("*"), *(F.count(F.when(self.before(pivot), 1)) for pivot in pivots)).first()
        cuts = sorted(zip(counts[1:], range(len(pivots)), strict=True))
        out, first, at = [], interval.first, 0
        for count, i in cuts:
            if count > at:
                out.append(Interval(first, pivots[i], interval.skipped + at, count - at))
            first, at = pivots[i], max(count, at)
        out.append(Interval(first, interval.end, interval.skipped + at, counts[0] - at))
        return [piece for piece in out if piece.size]

    def narrowed(self, place: int, short: int, start: Interval | None = None) -> Interval | None:
        """An interval of at most ``short`` rows around a place, if rows can be told
        apart so far; None beyond the last row."""
        at = start or Interval()
        while at.size is None or at.size > short:
            pieces = self.split(at)
            inside = [p for p in pieces if p.skipped <= place < p.skipped + p.size]
            if not inside:
                return None
            if at.size == inside[0].size:
                break
            at = inside[0]
        return at

    def row(self, place: int, short: int, start: Interval | None = None) -> tuple | None:
        """The sort values of the row at a place."""
        at = self.narrowed(place, short, start)
        if at is None:
            return None
        found = self.inside(at).orderBy(*self.columns()).offset(place - at.skipped).limit(1)
        return tuple(found.select(*(key.drawn() for key in self.keys)).first())


def page(order: Order, start: int, rows: int | None, short: int) -> DataFrame:
    """Rows from place ``start`` on, ``rows`` of them or all, in order. Only what lies
    about the page is sorted when the result is read."""
    if rows == 0:
        return order.df.limit(0)
    if rows is not None and rows <= short:
        first = order.narrowed(start, short)
        if first is None:
            return order.df.limit(0)
        end = None
        if start + rows > first.skipped + first.size and first.end is not None:
            last = order.narrowed(start + rows - 1, short, Interval(first.end, None, first.skipped + first.size))
            end = last.end if last is not None else None
        else:
            end = first.end
        part = order.inside(replace(first, end=end))
        return part.orderBy(*order.columns()).offset(start - first.skipped).limit(rows)
    first = order.row(start, short) if start else None
    if start and first is None:
        return order.df.limit(0)
    end = None if rows is None else order.row(start + rows, short)
    return order.inside(Interval(first, end)).orderBy(*order.columns())
