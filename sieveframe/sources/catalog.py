"""Named collections: a DataFrame with its key, defaults and aliases."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators import writes
from ..operators.lookup import lookup_ref
from .shared import materialize

# Field name endings and the type they give.
SUFFIX_TYPES: dict[str, T.DataType] = {
    "_i": T.IntegerType(),
    "_s": T.StringType(),
    "_l": T.LongType(),
    "_t": T.StringType(),
    "_b": T.BooleanType(),
    "_f": T.FloatType(),
    "_d": T.DoubleType(),
    "_dt": T.TimestampType(),
}


def schema_for(names: Iterable[str], explicit: Mapping[str, T.DataType] | None = None) -> T.StructType:
    """Schema of fields typed by name ending, or explicitly."""
    fields = []
    for name in names:
        dtype = (explicit or {}).get(name)
        if dtype is None:
            ending = "_" + name.rsplit("_", 1)[-1] if "_" in name else None
            if ending not in SUFFIX_TYPES:
                raise LookupError(f"no type for field {name!r}")
            dtype = SUFFIX_TYPES[ending]
        fields.append(T.StructField(name, dtype, True))
    return T.StructType(fields)


class ReadOnlyError(PermissionError):
    """A change to a collection that was registered read-only."""


@dataclass(frozen=True)
class Collection:
    df: DataFrame
    key: str
    unique: bool = False
    read_only: bool = False
    defaults: Mapping[str, object] = field(default_factory=dict)


class Catalog:
    """Collections and aliases by name."""

    def __init__(self) -> None:
        self._collections: dict[str, Collection] = {}
        self._aliases: dict[str, list[str]] = {}

    def register(
        self, name: str, df: DataFrame, key: str, *, unique: bool = False, read_only: bool = False,
        defaults: Mapping[str, object] | None = None,
    ) -> None:
        """Add a collection. ``unique`` promises that no key repeats, which saves the
        step that makes lookups and upserts see one row per key."""
        if not name or "," in name:
            raise ValueError(f"not a collection name: {name!r}")
        if key not in df.columns:
            raise LookupError(f"key {key!r} not found in {name!r}")
        self._collections[name] = Collection(df, key, unique, read_only, dict(defaults or {}))

    def register_parquet(self, spark: SparkSession, name: str, path: str, key: str, **options) -> None:
        """Add the collection stored at ``path``."""
        self.register(name, spark.read.parquet(path), key, **options)

    def alias(self, name: str, members: str | Iterable[str]) -> None:
        """A name for several collections: ``"a,b"`` or a list."""
        names = _names(members)
        if not names:
            raise ValueError(f"alias {name!r} has no members")
        self._aliases[name] = names

    def collection(self, name: str) -> Collection:
        """The collection of that name; not an alias."""
        if name not in self._collections:
            raise LookupError(f"collection {name!r} not found")
        return self._collections[name]

    def members(self, names: str | Iterable[str]) -> list[str]:
        """Collections behind a comma list of names. Aliases are opened one
        level deep; each collection is listed once."""
        opened = [m for name in _names(names) for m in self._aliases.get(name, [name])]
        return list(dict.fromkeys(opened))

    def table(self, names: str | Iterable[str]) -> DataFrame:
        """All rows of a collection, an alias, or a comma list of them. Rows
        that occur in two members stay; fields a member lacks are NULL."""
        frames = [self.collection(m).df for m in self.members(names)]
        if not frames:
            raise LookupError("no collection named")
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

    def key(self, names: str | Iterable[str]) -> str:
        keys = {self.collection(m).key for m in self.members(names)}
        if len(keys) != 1:
            raise LookupError(f"members of {names!r} have different keys: {sorted(keys)}")
        return keys.pop()

    def select(self, names: str | Iterable[str], **request) -> DataFrame:
        """``plans.request.select`` on a collection, with its key."""
        from ..plans.request import select

        request.setdefault("key", self.key(names))
        return select(self.table(names), **request)

    def lookup(self, main: str | DataFrame, ref: str, **options) -> DataFrame:
        """``operators.lookup.lookup_ref`` in this catalog."""
        return lookup_ref(self, main, ref, **options)

    # --- changes --------------------------------------------------------------
    # A change puts a new DataFrame in place of the old one; readers that hold the
    # old one keep their snapshot. ``settle`` stores the state and cuts the lineage
    # after many changes. For changes that arrive as a stream and must outlive the
    # session, see ``streaming.UpsertTable``.

    def upsert(self, name: str, incoming: DataFrame, order: str | list[str]) -> None:
        """Add rows, replacing those with the same key. Missing fields get
        their declared defaults."""
        target = self._changeable(name)
        # one instant for all of them, taken now and not when the rows are read
        incoming = writes.with_defaults(incoming, target.defaults, now=datetime.now(timezone.utc))
        df = writes.upsert_latest(
            target.df, incoming, target.key, order, current_unique=target.unique
        )
        self._collections[name] = replace(target, df=df, unique=True)

    def delete_by_ids(self, name: str, ids) -> None:
        target = self._changeable(name)
        df = writes.delete_by_ids(target.df, ids, target.key)
        self._collections[name] = replace(target, df=df)

    def delete_by_query(self, name: str, predicate) -> None:
        target = self._changeable(name)
        df = writes.delete_by_query(target.df, predicate)
        self._collections[name] = replace(target, df=df)

    def settle(self, name: str) -> None:
        """Store the present state of a collection in the checkpoint folder."""
        target = self._changeable(name)
        self._collections[name] = replace(target, df=materialize(target.df))

    def _changeable(self, name: str) -> Collection:
        target = self.collection(name)
        if target.read_only:
            raise ReadOnlyError(f"collection {name!r} is read-only")
        return target


def _names(names: str | Iterable[str]) -> list[str]:
    parts = names.split(",") if isinstance(names, str) else names
    return [p.strip() for p in parts if p.strip()]
