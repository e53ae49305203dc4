"""Named value functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column

from . import scalars

Builder = Callable[..., Column]

_functions: dict[str, Builder] = {
    "field": scalars.field,
    "geodist": scalars.geodist,
    "log": scalars.log10,
    "mul": scalars.mul,
    "rand": scalars.rand_int,
}


def register_function(name: str, builder: Builder) -> None:
    """Make ``builder`` callable by name. It returns a Column; wrap a
    ``pandas_udf`` for what Column expressions cannot say."""
    if not name or not callable(builder):
        raise ValueError("a function needs a name and a builder")
    _functions[name] = builder


def call_function(name: str, *args, **options) -> Column:
    if name not in _functions:
        raise LookupError(f"unknown function {name!r}")
    return _functions[name](*args, **options)
