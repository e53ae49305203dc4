"""Value functions: numbers, random values, distance and typed access."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .dates import utc_instant
from .resolve import FRACTIONAL, INSTANT, INTEGRAL, Expr, resolve, type_of

# Fixed values
INT_MAX = 2**31 - 1
EARTH_RADIUS_KM = 6371.0087714
INT_BITS = {"byte": 8, "short": 16, "int": 32}


def _col(value: Column | str | int | float) -> Column:
    if isinstance(value, Column):
        return value
    return F.col(value) if isinstance(value, str) else F.lit(value)


def field(name: str) -> Column:
    """A column as a value."""
    return F.col(name)


def log10(value: Column | str) -> Column:
    """Base-10 logarithm; NULL for values that have none."""
    return F.log10(_col(value))


def mul(a: Column | str | float, b: Column | str | float) -> Column:
    """Product as a double."""
    return _col(a).cast("double") * _col(b).cast("double")


def geodist(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in kilometres between points in degrees."""
    lat1, lon1, lat2, lon2 = (F.radians(_col(v).cast("double")) for v in (lat1, lon1, lat2, lon2))
    h = (
        F.pow(F.sin((lat2 - lat1) / 2), 2)
        + F.cos(lat1) * F.cos(lat2) * F.pow(F.sin((lon2 - lon1) / 2), 2)
    )
    # rounding may push h over 1 for opposite points
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def _check_random(max: int, seed: int | None) -> None:
    if isinstance(max, bool) or not isinstance(max, int):
        raise TypeError(f"max must be an int, not {max!r}")
    if not 0 < max <= INT_MAX:
        raise ValueError(f"max must lie in 1..{INT_MAX}, not {max}")
    if seed is not None and (isinstance(seed, bool) or not isinstance(seed, int)):
        raise TypeError(f"seed must be a number, not {seed!r}")


def rand_int(max: int = INT_MAX, seed: int | None = None) -> Column:
    """Random int in ``[0, max)``.

    With a seed the values repeat as long as the partitioning does. Project it
    before aggregating over it.
    """
    _check_random(max, seed)
    draw = F.rand() if seed is None else F.rand(seed)
    return F.floor(draw * F.lit(max)).cast("int")


def hash_rand_int(keys: list[Column | str], max: int = INT_MAX, seed: int = 0) -> Column:
    """Pseudo-random int in ``[0, max)`` that depends on the row's keys and the
    seed only: the same under any partitioning and on any retried task."""
    _check_random(max, seed)
    return F.pmod(F.xxhash64(*[_col(k) for k in keys], F.lit(seed)), F.lit(max)).cast("int")


def exists(value: Column | str) -> Column:
    """Whether the row has a value."""
    return _col(value).isNotNull()


def long_value(column: Column, dtype: T.DataType) -> Column:
    """``column`` as a long the way an integral accessor reads it: missing is 0,
    fractions are cut toward zero, too large values stop at the ends, instants
    are epoch milliseconds."""
    if isinstance(dtype, T.TimestampNTZType):
        value = F.unix_millis(utc_instant(column))
    elif isinstance(dtype, T.TimestampType):
        value = F.unix_millis(column)
    elif isinstance(dtype, FRACTIONAL):
        value = _saturated(column, 64).cast("bigint")
    elif isinstance(dtype, (*INTEGRAL, T.BooleanType)):
        value = column.cast("bigint")
    elif isinstance(dtype, T.DecimalType):
        value = column.try_cast("bigint")
    else:
        raise TypeError(f"no numeric value in a {dtype.simpleString()} column")
    return F.coalesce(value, F.lit(0).cast("bigint"))


def _saturated(column: Column, bits: int) -> Column:
    top, kind = 2.0 ** (bits - 1), "bigint" if bits == 64 else "int"
    highest, lowest = F.lit(2 ** (bits - 1) - 1).cast(kind), F.lit(-(2 ** (bits - 1))).cast(kind)
    return (
        F.when(F.isnan(column), F.lit(0).cast(kind))
        .when(column >= top, highest)
        .when(column <= -top, lowest)
        .otherwise(column.try_cast(kind))
    )


def _wrapped(number: Column, bits: int) -> Column:
    return F.shiftright(F.shiftleft(number, 64 - bits), 64 - bits)


def as_type(value: Expr, kind: str) -> Callable[[DataFrame], Column]:
    """Typed access to a value: ``byte short int long float double bool object
    exists``. The numeric and bool forms read a missing value as 0 / false, and
    narrow like two's-complement integers do."""
    if kind not in (*INT_BITS, "long", "float", "double", "bool", "object", "exists"):
        raise ValueError(f"unknown value type {kind!r}")

    def build(df: DataFrame) -> Column:
        column = resolve(df, value)
        return read_as(column, type_of(df, column), kind)

    return build


def read_as(column: Column, dtype: T.DataType, kind: str) -> Column:
    """``as_type`` for a column whose type is known."""
    if kind == "object":
        return column
    if kind == "exists":
        return column.isNotNull()
    if kind == "long":
        return long_value(column, dtype)
    if kind in INT_BITS:
        if isinstance(dtype, FRACTIONAL):
            number = F.coalesce(_saturated(column, 32), F.lit(0)).cast("bigint")
        else:
            number = long_value(column, dtype)
        return _wrapped(number, INT_BITS[kind]).cast(kind)
    if kind == "bool":
        if isinstance(dtype, T.BooleanType):
            return F.coalesce(column, F.lit(False))
        return F.coalesce(column, F.lit(0)) != 0
    if isinstance(dtype, (*INSTANT, T.BooleanType)):
        column = long_value(column, dtype)
    return F.coalesce(column.cast(kind), F.lit(0).cast(kind))
