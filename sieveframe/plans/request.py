"""One request on a collection: condition, filters, fields, order and page.

Everything becomes one logical plan, so conditions reach the scan, unused
columns are never read, and a sorted page is a top-k.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.resolve import Expr, resolve, type_of
from ..operators.filters import ValueFilter, apply_filters, with_constant_score
from ..sources.shared import materialize
from .ranks import COMPARED, Order, OrderKey, page

# The default page.
DEFAULT_START = 0
DEFAULT_ROWS = 10

#: Rows in front of a page's end that a top-k may hold: each scan task sends up to that
#: many rows to one task. Of longer orders the part around the page is found by counting.
TOP_K_LIMIT = 10_000


@dataclass(frozen=True)
class SortKey:
    expr: Expr
    descending: bool = False


def asc(expr: Expr) -> SortKey:
    return SortKey(expr)


def desc(expr: Expr) -> SortKey:
    return SortKey(expr, True)


def _sort_key(item: SortKey | Expr) -> SortKey:
    if isinstance(item, SortKey):
        return item
    if isinstance(item, str):
        name, _, direction = item.strip().rpartition(" ")
        if name and direction.lower() in ("asc", "desc"):
            return SortKey(name.strip(), direction.lower() == "desc")
    return SortKey(item)


def _order_key(name: str, dtype: T.DataType, descending: bool) -> OrderKey:
    """Missing strings and booleans sort last both ways; missing numbers and
    dates come first ascending and last descending."""
    last = descending or isinstance(dtype, (T.StringType, T.BooleanType))
    return OrderKey(name, dtype, descending, not last)


def _directed(column: Column, dtype: T.DataType, descending: bool) -> Column:
    first = _order_key("", dtype, descending).missing_first
    if descending:
        return column.desc_nulls_last()
    return column.asc_nulls_first() if first else column.asc_nulls_last()


def sort_columns(df: DataFrame, order: Sequence[SortKey | Expr]) -> list[Column]:
    """Sort expressions for ``df.orderBy``."""
    out = []
    for item in map(_sort_key, order):
        column = resolve(df, item.expr)
        out.append(_directed(column, type_of(df, column), item.descending))
    return out


def select(
    df: DataFrame,
    where: ValueFilter | Expr | None = None,
    filters: Sequence[ValueFilter | Expr] = (),
    fields: Sequence[str | tuple[str, Expr | ValueFilter]] = ("*",),
    order: Sequence[SortKey | Expr] = (),
    start: int = DEFAULT_START,
    rows: int | None = DEFAULT_ROWS,
    key: str | Sequence[str] | None = None,
    return_sort_values: bool = False,
) -> DataFrame:
    """Rows of ``df`` that pass ``where`` and all ``filters``.

    ``fields`` lists ``"*"``, column names, ``"score"`` (1.0 for every hit) and
    ``(alias, expression)`` pairs. ``order`` lists names, ``"name desc"``,
    expressions or ``asc()`` / ``desc()``. A page (``rows`` not ``None``) needs
    ``key``, the unique key, which ends the sort: without it, rows of equal sort
    value could change pages between runs. ``return_sort_values`` adds the sort
    keys as columns ``sort_1``, ``sort_2``, ...
    """
    if start < 0 or (rows is not None and rows < 0):
        raise ValueError("start and rows must not be negative")
    hits = apply_filters(df, *([] if where is None else [where]), *filters)
    if "score" in fields and "score" not in hits.columns:
        hits = with_constant_score(hits)
    # sort expressions become columns first: a random sort key must be drawn once
    # per row, and the returned sort values must be those that were sorted by
    added, sort_keys = {}, []
    for i, item in enumerate(map(_sort_key, order)):
        column = resolve(hits, item.expr)
        name = f"__sort_{i}"
        added[name] = column
        sort_keys.append(_order_key(name, type_of(hits, column), item.descending))
    sorting = [k.column() for k in sort_keys]
    keyed = hits.withColumns(added) if added else hits
    out = _project(keyed, hits.columns, fields)
    if return_sort_values:
        out += [F.col(name).alias(f"sort_{i + 1}") for i, name in enumerate(added)]
    keys = [] if key is None else [key] if isinstance(key, str) else list(key)
    if rows is None and not start:
        sorting += [F.col(k).asc() for k in keys] if sorting else []
        return (keyed.orderBy(*sorting) if sorting else keyed).select(*out)
    if not keys:
        raise ValueError("a page needs the unique key of the collection")
    if rows is not None and start + rows <= TOP_K_LIMIT:
        ordered = keyed.orderBy(*sorting, *[F.col(k).asc() for k in keys])
        return (ordered.offset(start) if start else ordered).limit(rows).select(*out)
    # what is searched carries nothing but fields and sort keys
    ends = {f"__key_{i}": F.col(k) for i, k in enumerate(keys)}
    carried = keyed.select(*out, *added, *[c.alias(n) for n, c in ends.items()])
    sort_keys += [OrderKey(n, carried.schema[n].dataType, missing_first=True) for n in ends]
    return _deep(carried, sort_keys, start, rows).drop(*added, *ends)


def _project(df: DataFrame, columns: list[str], fields) -> list[Column]:
    out: list[Column] = []
    for item in fields:
        if item == "*":
            out += [F.col(f"`{c}`") for c in columns if c != "score" or "score" not in fields]
        elif isinstance(item, str):
            out.append(F.col(f"`{item}`") if item in df.columns else F.col(item))
        else:
            alias, expr = item
            column = expr.flag(df) if isinstance(expr, ValueFilter) else resolve(df, expr)
            out.append(column.alias(alias))
    return out


def deep_page(df: DataFrame, order: Sequence[SortKey | Expr], start: int, rows: int | None) -> DataFrame:
    """A page far down the order, which must tell all rows apart. Where it begins and
    ends is found by counting, so nothing in front of it is sorted or moved."""
    added, sort_keys = {}, []
    for i, item in enumerate(map(_sort_key, order)):
        column = resolve(df, item.expr)
        added[f"__sort_{i}"] = column
        sort_keys.append(_order_key(f"__sort_{i}", type_of(df, column), item.descending))
    return _deep(df.withColumns(added), sort_keys, start, rows).drop(*added)


def _deep(df: DataFrame, keys: list[OrderKey], start: int, rows: int | None) -> DataFrame:
    # what differs from one reading to the next is read once
    if not df._jdf.queryExecution().analyzed().deterministic():
        df = materialize(df)
    if all(isinstance(key.dtype, COMPARED) for key in keys):
        return page(Order(df, keys), start, rows, TOP_K_LIMIT)
    ordered = df.orderBy(*[key.column() for key in keys]).offset(start)
    return ordered if rows is None else ordered.limit(rows)


def num_found(
    df: DataFrame, where: ValueFilter | Expr | None = None, filters: Sequence[ValueFilter | Expr] = ()
) -> DataFrame:
    """``num_found``: hits before paging, counted per task and then summed."""
    hits = apply_filters(df, *([] if where is None else [where]), *filters)
    return hits.agg(F.count("*").alias("num_found"))
