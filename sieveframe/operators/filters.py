"""Value filters: in, range, any-bit, all-bits, their complements, and a
registry for more.

A filter is a function of the DataFrame it is applied to, because its literals
take the type of the column it looks at:

    df.filter(in_filter("size", "(2, 3)")(df))
    apply_filters(df, in_filter("size", "(2, 3)"), ~range_filter("price", "[5 TO *]"))

Filters are two-valued. A row without a value fails ``in`` and ``range`` and
passes their complements; bit filters read a missing value as 0.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.resolve import FRACTIONAL, INSTANT, Expr, describe, resolve, type_of
from ..functions.scalars import long_value
from ..functions.values import (
    RangeText,
    ValueTextError,
    check_comparable,
    list_literal,
    list_value,
    parse_list,
    parse_mask,
    parse_range,
    same_value_column,
    typed_literal,
)
from .skew import AUTO, keyed_join

#: Builds the predicate of a filter from the column, its type and the complement flag.
Predicate = Callable[[Column, T.DataType, bool], Column]

#: Longest literal list that is kept inside the plan; longer ones become a join.
LITERAL_LIST_LIMIT = 1_000


class ValueFilter:
    """A predicate over one value expression, bound to a DataFrame when called."""

    def __init__(self, name: str, value: Expr, build: Predicate, negated: bool = False):
        self.name = name
        self.value = value
        self.negated = negated
        self._build = build

    def __call__(self, df: DataFrame) -> Column:
        """Predicate for ``df.filter``, in a form scans can evaluate."""
        column = resolve(df, self.value)
        return self._build(column, type_of(df, column), self.negated)

    def flag(self, df: DataFrame) -> Column:
        """The same as a true/false value that is never NULL, for projections."""
        return F.coalesce(self(df), F.lit(self.negated))

    def __invert__(self) -> ValueFilter:
        return ValueFilter(self.name, self.value, self._build, not self.negated)

    def __repr__(self) -> str:
        return f"{'not ' if self.negated else ''}{self.name}({describe(self.value)})"


def complement(predicate: Column, missing: Column | None = None) -> Column:
    """Two-valued not. ``missing`` says where ``predicate`` is NULL; naming the
    column's own null test there keeps the result readable for parquet scans."""
    return (predicate.isNull() if missing is None else missing) | ~predicate


def in_filter(value: Expr, values: str | Iterable, not_: bool = False) -> ValueFilter:
    """The value is one of a list: ``"(2, 3)"``, ``"2"`` or a Python list. A listed
    ``None``, and a number the column's type cannot hold, equals no value."""
    items = parse_list(values) if values is None or isinstance(values, str) else list(values)
    if not items:
        raise ValueTextError("no value in list")

    def build(column: Column, dtype: T.DataType, negated: bool) -> Column:
        check_comparable(dtype, "in")
        listed = [literal for item in items if (literal := list_literal(item, dtype)) is not None]
        found = column.isin(*listed) if listed else F.lit(False)
        return complement(found, column.isNull()) if negated else found

    return ValueFilter("in", value, build, not_)


def range_filter(
    value: Expr, text: str | None = None, *, lower=None, upper=None,
    incl: bool = True, incu: bool = True, not_: bool = False,
) -> ValueFilter:
    """The value lies in ``"[a TO b]"`` / ``"(a TO b)"``, or, without a text,
    between ``lower`` and ``upper``; ``*`` or ``None`` is an open end."""
    ends = RangeText(lower, upper, incl, incu) if text is None else parse_range(text)

    def build(column: Column, dtype: T.DataType, negated: bool) -> Column:
        check_comparable(dtype, "range")
        tests = []
        if ends.lower is not None:
            low = typed_literal(ends.lower, dtype)
            tests.append(column >= low if ends.include_lower else column > low)
        if ends.upper is not None:
            high = typed_literal(ends.upper, dtype)
            tests.append(column <= high if ends.include_upper else column < high)
        elif tests and isinstance(dtype, FRACTIONAL):
            # Spark sorts NaN above every number; an upper end already shuts it out
            tests.append(~F.isnan(column))
        if isinstance(dtype, FRACTIONAL) and any(_is_nan(e) for e in (ends.lower, ends.upper)):
            # nothing compares with NaN
            tests = [F.lit(False)]
        if not tests:
            return column.isNull() if negated else column.isNotNull()
        inside = reduce(Column.__and__, tests)
        return complement(inside, column.isNull()) if negated else inside

    return ValueFilter("range", value, build, not_)


def _is_nan(end) -> bool:
    return end is not None and "nan" in str(end).lower()


def _mask_filter(name: str, value: Expr, mask_text, not_: bool, test) -> ValueFilter:
    mask = parse_mask(mask_text)

    def build(column: Column, dtype: T.DataType, negated: bool) -> Column:
        check_comparable(dtype, name)
        bits = long_value(column, dtype).bitwiseAND(F.lit(mask).cast("bigint"))
        hit = test(bits, F.lit(mask).cast("bigint"))
        return ~hit if negated else hit

    return ValueFilter(name, value, build, not_)


def bit_any_filter(value: Expr, mask: str | int | list, not_: bool = False) -> ValueFilter:
    """Any bit of the mask is set: ``"(0b01100, 0x1)"``."""
    return _mask_filter("bit", value, mask, not_, lambda bits, _: bits != 0)


def bit_all_filter(value: Expr, mask: str | int | list, not_: bool = False) -> ValueFilter:
    """Every bit of the mask is set."""
    return _mask_filter("cbit", value, mask, not_, lambda bits, mask: bits == mask)


# --- named filters --------------------------------------------------------------

_BUILT_IN: dict[str, Callable[..., ValueFilter]] = {
    "in": in_filter,
    "range": lambda value, text, l=None, u=None, **options: range_filter(
        value, text, lower=l, upper=u, **options
    ),
    "bit": bit_any_filter,
    "cbit": bit_all_filter,
}
_custom: dict[str, Callable[..., Column]] = {}


def register_filter(name: str, builder: Callable[..., Column]) -> None:
    """Add a filter: ``builder(column, dtype, value, **options)`` returns the
    predicate. The built-in names cannot be replaced."""
    if not name or not callable(builder):
        raise ValueError("a filter needs a name and a builder")
    _custom[name] = builder


def build_filter(name: str, column: Expr, value=None, not_: bool = False, **options) -> ValueFilter:
    """Filter by name. Built-in names win over registered ones."""
    if name in _BUILT_IN:
        return _BUILT_IN[name](column, value, not_=not_, **options)
    if name not in _custom:
        raise LookupError(f"unknown filter {name!r}")
    builder = _custom[name]

    def build(target: Column, dtype: T.DataType, negated: bool) -> Column:
        predicate = builder(target, dtype, value, **options)
        return complement(predicate) if negated else predicate

    return ValueFilter(name, column, build, not_)


# --- applying filters -------------------------------------------------------------


def bind(df: DataFrame, predicate: ValueFilter | Expr) -> Column:
    return resolve(df, predicate)


def apply_filters(df: DataFrame, *filters: ValueFilter | Expr) -> DataFrame:
    """Rows that pass every filter. Catalyst merges them into one predicate and
    hands the scan whatever part it can evaluate."""
    for predicate in filters:
        df = df.filter(bind(df, predicate))
    return df


def filter_in(
    df: DataFrame, value: Expr, values: str | Iterable | DataFrame, not_: bool = False
) -> DataFrame:
    """``in`` for lists of any length. Short lists stay a scan predicate. Longer
    ones, and lists held in the first column of a DataFrame, become a semi join
    (anti join for the complement); items are read the same way in either form.
    Spark broadcasts the list only if it is small enough by its own measure;
    otherwise frequent and missing values of ``df`` are spread over many tasks. The least
    and the greatest value of a longer list reach the scan in front of the semi join.
    In a DataFrame, what is missing, unreadable or not a value of the column's
    type equals nothing."""
    if not isinstance(values, DataFrame):
        items = parse_list(values) if isinstance(values, str) else list(values)
        if len(items) <= LITERAL_LIST_LIMIT:
            return df.filter(in_filter(value, items, not_)(df))
    column = resolve(df, value)
    dtype = type_of(df, column)
    check_comparable(dtype, "in")
    if isinstance(values, DataFrame):
        first = values.schema[0]
        listed = values.select(same_value_column(F.col(f"`{first.name}`"), first.dataType, dtype).alias("__listed"))
        # distinct: each task sends a repeated value once
        listed = listed.filter(F.col("__listed").isNotNull()).distinct()
    else:
        listed = _list_rows(df.sparkSession, items, dtype)
        if not not_:
            df = df.filter(_between_listed(column, items, dtype))
    how = "left_anti" if not_ else "left_semi"
    return keyed_join(df.withColumn("__value", column), "__value", listed, "__listed", how, AUTO).drop("__value")


def _between_listed(column: Column, items: list, dtype: T.DataType) -> Column:
    """A range that holds every listed value, for the scan: files and row groups beyond
    it are not read."""
    if isinstance(dtype, (*INSTANT, T.DateType, T.BooleanType)):
        return column.isNotNull()
    values = [value for item in items if (value := list_value(item, dtype)) is not None]
    if not values or any(value != value for value in values):  # NaN lies beyond every end
        return column.isNotNull()
    return (column >= F.lit(min(values)).cast(dtype)) & (column <= F.lit(max(values)).cast(dtype))


def _list_rows(spark: SparkSession, items: list, dtype: T.DataType) -> DataFrame:
    """``__listed``: the distinct values of a list."""
    schema = T.StructType().add("__listed", dtype)
    if isinstance(dtype, (*INSTANT, T.DateType)):
        # date math is a Column expression, so these stay literals, some at a time
        literals = [literal for item in items if (literal := list_literal(item, dtype)) is not None]
        one = spark.range(1)
        parts = [
            one.select(F.explode(F.array(*literals[i:i + LITERAL_LIST_LIMIT])).alias("__listed"))
            for i in range(0, len(literals), LITERAL_LIST_LIMIT)
        ]
        return reduce(DataFrame.union, parts).distinct() if parts else spark.createDataFrame([], schema)
    values = dict.fromkeys(value for item in items if (value := list_value(item, dtype)) is not None)
    return spark.createDataFrame([(value,) for value in values], schema)


def with_constant_score(df: DataFrame, score: float = 1.0) -> DataFrame:
    """Every row gets the same score."""
    return df.withColumn("score", F.lit(score).cast("float"))
