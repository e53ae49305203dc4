"""Adding and deleting rows by key, defaults, and sorted export.

DataFrames do not change: each function returns the new state of the
collection. Small change sets never make Spark shuffle the large collection.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.resolve import Expr
from ..functions.values import typed_literal
from .filters import ValueFilter, bind, complement, filter_in
from .lookup import first_per_key
from .skew import fits_broadcast


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def upsert_latest(
    current: DataFrame,
    incoming: DataFrame,
    key: str | Sequence[str],
    order: str | Sequence[str],
    current_unique: bool = False,
) -> DataFrame:
    """Insert or replace by key; per key the row that is latest by ``order`` stays.

    With ``current_unique=True`` (the normal state of a collection: one row per
    key) only rows that change are compared. ``incoming`` is reduced to one row
    per key. When it is small enough for Spark to broadcast it, two anti joins drop
    what it replaces and what is already newer, and ``current`` is read without being
    shuffled. Otherwise one full outer join settles every key: each side is read and
    exchanged once, by the key under which the changes were reduced.

    Without it both sides are ranked together, with one row per key and task
    kept before the shuffle.

    In every form rows of equal order are replaced by incoming ones, the content
    of the rows settles ties within one side, and a missing key is one key.
    """
    keys, orders = _keys(key), _keys(order)
    latest_first = [F.col(c).desc_nulls_last() for c in orders]
    if not current_unique:
        both = current.withColumn("__new", F.lit(0)).unionByName(incoming.withColumn("__new", F.lit(1)), allowMissingColumns=True)
        return first_per_key(both, keys, [*latest_first, F.desc("__new"), *content_order(both)]).drop("__new")
    if not fits_broadcast(incoming):
        return _merged(current, incoming, keys, orders)
    changes = first_per_key(incoming, keys, [*latest_first, *content_order(incoming)])
    stamp = F.struct(*[F.col(c) for c in orders])
    change_stamps = changes.select(*keys, stamp.alias("__stamp"))
    # only keys that occur on both sides matter here, so this stays as small as the change set
    changed = changes.select(*[F.col(k).alias(f"__k_{i}") for i, k in enumerate(keys)])
    current_stamps = current.select(*keys, stamp.alias("__stamp")).join(changed, _same(keys), "left_semi")
    kept = _anti(current.withColumn("__mine", stamp), change_stamps, keys, "__mine <= __stamp")
    added = _anti(changes.withColumn("__mine", stamp), current_stamps, keys, "__mine < __stamp")
    return kept.unionByName(added, allowMissingColumns=True)


def _merged(current: DataFrame, incoming: DataFrame, keys: list[str], orders: list[str]) -> DataFrame:
    """Current rows with the changes, by one full outer join. Both sides are keyed by a
    struct, which is never NULL and equal where all its parts are, so that the changes
    need no second exchange after they were reduced to one row per key."""
    shape = current.limit(0).unionByName(incoming.limit(0), allowMissingColumns=True).schema
    types = {f.name: f.dataType for f in shape}
    own = F.struct(*[F.col(k).cast(types[k]) for k in keys])
    latest = [F.col(c).desc_nulls_last() for c in orders]
    changes = first_per_key(incoming.withColumn("__new_key", own), "__new_key", [*latest, *content_order(incoming)])

    def side(df: DataFrame, name: str, key: Column) -> DataFrame:
        row = F.struct(*[(F.col(f"`{f}`") if f in df.columns else F.lit(None)).cast(t).alias(f) for f, t in types.items()])
        stamp = F.struct(*[F.col(c).cast(types[c]) for c in orders])
        return df.select(key.alias(f"__{name}_key"), row.alias(f"__{name}"), stamp.alias(f"__{name}_stamp"))

    old, new = side(current, "old", own), side(changes, "new", F.col("__new_key"))
    both = old.join(new.hint("merge"), F.col("__old_key") == F.col("__new_key"), "full_outer")
    newer = F.col("__old").isNull() | (F.col("__new").isNotNull() & (F.col("__new_stamp") >= F.col("__old_stamp")))
    return both.select(F.when(newer, F.col("__new")).otherwise(F.col("__old")).alias("__row")).select("__row.*")


def _anti(rows: DataFrame, stamps: DataFrame, keys: list[str], older: str) -> DataFrame:
    renamed = stamps.select(*[F.col(k).alias(f"__k_{i}") for i, k in enumerate(keys)], "__stamp")
    return rows.join(renamed, [*_same(keys), F.expr(older)], "left_anti").drop("__mine")


def _same(keys: list[str]) -> list[Column]:
    return [F.col(k).eqNullSafe(F.col(f"__k_{i}")) for i, k in enumerate(keys)]


def content_order(df: DataFrame) -> list[Column]:
    """An order by what rows hold, so that a retried task settles ties the same way."""
    return [F.col(f"`{f.name}`").desc_nulls_last() for f in df.schema if "map<" not in f.dataType.simpleString()]


def delete_by_ids(df: DataFrame, ids: DataFrame | Iterable, key: str) -> DataFrame:
    """Rows whose key is not among ``ids`` (a list, or a DataFrame whose first
    column holds them). Rows without a key stay."""
    if isinstance(ids, DataFrame) and key in ids.columns:
        ids = ids.select(key)
    return filter_in(df, key, ids, not_=True)


def delete_by_query(df: DataFrame, predicate: ValueFilter | Expr) -> DataFrame:
    """Rows the predicate does not hold for."""
    if isinstance(predicate, ValueFilter):
        return df.filter((~predicate)(df))
    return df.filter(complement(bind(df, predicate)))


def with_defaults(df: DataFrame, defaults: Mapping[str, object], now=None) -> DataFrame:
    """Fill missing fields with their declared defaults: constants, or date
    texts such as ``NOW`` for date fields. Fields the rows lack are added."""
    filled: dict[str, Column] = {}
    for name, value in defaults.items():
        if name in df.columns:
            filled[name] = F.coalesce(F.col(name), typed_literal(value, df.schema[name].dataType, now))
        elif value == "NOW":
            filled[name] = typed_literal(value, T.TimestampType(), now)
        else:
            filled[name] = F.lit(value)
    return df.withColumns(filled) if filled else df


def export_sorted(
    df: DataFrame, order: Sequence[Column], path: str, key: str | Sequence[str], mode: str = "error"
) -> None:
    """Write the whole result in sorted order: file after file, rows in order.

    Spark samples the sort keys and range-partitions by them. ``key`` ends the
    sort, so rows that share one sort value still spread over many files.
    """
    ends = [F.col(k) for k in _keys(key)]
    df.orderBy(*order, *ends).write.mode(mode).parquet(path)
