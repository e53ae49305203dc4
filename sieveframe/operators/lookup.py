"""Cross-collection lookup: one field of the row with the same key elsewhere.

A lookup is a left join against at most one row per key, so it never changes
the number of rows. The result is an ordinary column: project it, sort by it,
filter on it.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.resolve import type_of
from ..functions.scalars import long_value
from ..functions.values import same_value_column
from .skew import AUTO, keyed_join

if TYPE_CHECKING:
    from ..sources.catalog import Catalog

MODES = ("object", "numeric", "exists")

_KEY, _HIT = "__key", "__hit"


def first_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of every key in ``order``.

    Each task keeps one row per key before the shuffle (Spark plans a partial
    group limit for ``row_number() = 1``), so a key with very many rows sends
    one row per task, not all of them.
    """
    keys = [key] if isinstance(key, str) else list(key)
    window = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(window)).filter("__rank = 1").drop("__rank")


def lookup(
    main: DataFrame,
    target: DataFrame,
    key: str,
    field: str | Sequence[str],
    mode: str = "object",
    default=None,
    target_key: str | None = None,
    order: Sequence[Column] | None = None,
    name: str | Sequence[str] | None = None,
    unique: bool = False,
    hot_keys: list | str | None = AUTO,
    spread_by: list[str] | None = None,
    may_broadcast: bool = True,
) -> DataFrame:
    """``main`` with one more column, read from ``target`` by key.

    ``field``
        What to read. A list reads several fields of the same row in one join;
        ``name`` and ``default`` are then lists too.
    ``mode``
        ``object``: the value; ``default`` where no row has the key.
        ``numeric``: the value as a number, 0 without a row or without a value.
        ``exists``: whether a row has the key.
    ``order``
        Which row is first when a key repeats in ``target``; without it, the one
        with the smallest value. Skipped with ``unique=True``, a promise that no
        key repeats.
    ``hot_keys``
        Keys that hold a large share of ``main``. Their rows, and rows without a
        key, are dealt out over many tasks when ``target`` is too large to
        broadcast. By default they are looked for then (one pass over the key
        column); ``None`` leaves skew to adaptive execution.
    ``spread_by``
        Columns of ``main`` that tell the rows of one key apart, such as its own
        unique key. Without it the whole row is used.
    A stream's ``target``, unless it is a stream itself or ``unique``, is reduced to one
    row per key and stored when the stream is set up; its micro-batches read that. A
    changed target is taken up when the stream is set up again.

    ``may_broadcast``
        ``False`` keeps a small ``target`` from being broadcast.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    several = not isinstance(field, str)
    fields = list(field) if several else [field]
    names = fields if name is None else list(name) if several else [name]
    defaults = [None] * len(fields) if default is None else list(default) if several else [default]
    if not len(fields) == len(names) == len(defaults) > 0:
        raise ValueError("fields, names and defaults must match")
    target_key = target_key or key
    for frame, column, what in ((main, key, "key"), (target, target_key, "target key"),
                                *((target, f, "target field") for f in fields)):
        if column not in frame.columns:
            raise LookupError(f"{what} {column!r} not found")
    for new in names:
        if new in main.columns:
            raise ValueError(f"there is a column {new!r} already; give the result a name")
    found = _first_values(main, target, key, fields, mode, target_key, order, unique)
    if main.isStreaming and not target.isStreaming and not unique:
        from ..sources.shared import materialize  # the catalog there needs this module

        # once a stream, not once a micro-batch
        found = materialize(found)
    joined = keyed_join(main, key, found, _KEY, "left", hot_keys, spread_by, may_broadcast)
    hit = F.col(_HIT).isNotNull()
    values = {}
    for i, (new, missing) in enumerate(zip(names, defaults)):
        value = hit if mode == "exists" else F.col(_value(i))
        if mode == "numeric":
            value = F.coalesce(value, F.lit(0).cast(found.schema[_value(i)].dataType))
        elif mode == "object" and missing is not None:
            value = F.when(hit, value).otherwise(F.lit(missing).cast(found.schema[_value(i)].dataType))
        values[new] = value
    return joined.withColumns(values).drop(*found.columns)


def _value(i: int) -> str:
    return f"__value_{i}"


def _first_values(main, target, key, fields, mode, target_key, order, unique) -> DataFrame:
    """``__key``, ``__hit`` and the values, with one row per key."""
    target = target.filter(F.col(target_key).isNotNull())
    key_type = main.schema[key].dataType
    # a key of another type is a key only where it is the same value
    keyed = same_value_column(F.col(target_key), target.schema[target_key].dataType, key_type)
    if target.schema[target_key].dataType != key_type:
        target = target.filter(keyed.isNotNull())
    if mode == "exists":
        rows = target.select(keyed.alias(_KEY), F.lit(True).alias(_HIT))
        return rows if unique else rows.dropDuplicates([_KEY])
    values = {_value(i): _read(target, f, mode) for i, f in enumerate(fields)}
    if order is None and len(fields) == 1 and not unique:
        # the smallest value alone needs no ranking
        rows = target.select(keyed.alias(_KEY), values[_value(0)].alias(_value(0)))
        return rows.groupBy(_KEY).agg(F.min(_value(0)).alias(_value(0)), F.lit(True).alias(_HIT))
    rows = target.withColumns({_KEY: keyed, _HIT: F.lit(True), **values})
    if not unique:
        # the values end the order, so a retried task settles ties the same way
        ends = [F.col(v).asc_nulls_last() for v in values if not _is_map(rows, v)]
        rows = first_per_key(rows, _KEY, [*(order or ()), *ends])
    return rows.select(_KEY, _HIT, *values)


def _is_map(df: DataFrame, column: str) -> bool:
    return "map<" in df.schema[column].dataType.simpleString()


def _read(target: DataFrame, field: str, mode: str) -> Column:
    value = F.col(field)
    dtype = type_of(target, value)
    if mode == "numeric" and not isinstance(dtype, (T.BooleanType, T.NumericType)):
        return F.when(value.isNotNull(), long_value(value, dtype))
    return value


def split_ref(ref: str, prefix: str = "") -> tuple[str, str]:
    """``collection.field``; the field may hold dots itself."""
    text = ref.removeprefix(prefix)
    parts = [part for part in (p.strip() for p in text.split(".")) if part]
    if len(parts) < 2:
        raise ValueError(f"{ref!r} must name a collection and a field")
    return parts[0], ".".join(parts[1:])


def lookup_ref(
    catalog: Catalog, main: str | DataFrame, ref: str, mode: str = "object",
    key: str | None = None, prefix: str = "", name: str | None = None, **options,
) -> DataFrame:
    """``lookup`` by the name ``collection.field``, with the key, the declared
    default of the field and the key's uniqueness taken from the catalog.

    ``prefix`` is cut off first, for names that carry one.
    """
    collection, field = split_ref(ref, prefix)
    target = catalog.collection(collection)
    if field not in target.df.columns:
        raise LookupError(f"collection {collection!r} has no field {field!r}")
    if isinstance(main, str):
        key = key or catalog.key(main)
        main = catalog.table(main)
    key = key or target.key
    options.setdefault("default", target.defaults.get(field))
    options.setdefault("unique", target.unique)
    return lookup(
        main, target.df, key, field, mode=mode, target_key=target.key,
        name=name or f"{collection}.{field}", **options,
    )
