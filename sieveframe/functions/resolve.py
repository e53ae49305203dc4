"""Turning what a caller names (a column name, a Column, or a function of the
DataFrame) into a Column of a given DataFrame, and asking for its type."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A column name, a Column, or a function that builds a Column for a DataFrame.
Expr = str | Column | Callable[[DataFrame], Column]

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FRACTIONAL = (T.FloatType, T.DoubleType)
INSTANT = (T.TimestampType, T.TimestampNTZType)


def resolve(df: DataFrame, expr: Expr) -> Column:
    """The Column that ``expr`` stands for in ``df``."""
    if isinstance(expr, Column):
        return expr
    if isinstance(expr, str):
        return F.col(expr)
    return expr(df)


def type_of(df: DataFrame, column: Column) -> T.DataType:
    """Type of ``column`` in ``df``. Analysis only, no job runs."""
    return df.select(column).schema[0].dataType


def describe(expr: Expr) -> str:
    return expr if isinstance(expr, str) else str(expr)
