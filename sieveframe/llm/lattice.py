"""Embedding near-duplicates by lattice hashing.

Unit vectors are turned by random rotations. A table takes ``8 * blocks`` of the turned
coordinates, scales and shifts them, and decodes every eight to the nearest point of the
lattice E8; the points are the vector's cell. Each vector is filed in its own cell and
visits the ``probes`` neighbouring cells it lies nearest to (a step by one of the 240
shortest lattice vectors each), in every table. Vectors that meet in a cell are compared
by cosine in double precision, so nothing below ``least`` links; of pairs at a cosine of
just 0.93, 0.999 meet with the default tables (measured; README).

Work:

* Equal vectors of one label are one node from the start, with the number of their rows.
* Only numbers are moved to find the cells in which anything can meet; cells without two
  members to compare end there. Vectors are sent to the rest.
* Cells with more than ``cell`` members are cut into squares of at most that many a side,
  so no task holds more. Comparisons within a cell still grow with the square of its
  *different* vectors, since each row's links are counted exactly.
* A square gives each member's number of links and a spanning forest, never its pairs. A
  pair that meets in several tables counts in the first, which both vectors' cells tell.

Choosing parameters: one more of ``blocks`` divides the strangers that meet by some
hundreds and takes more tables to keep the share of pairs found, so it is for labels of
many millions of vectors.

Rows: vectors that are NULL, zero or hold a NULL or a component that is not finite, and
rows without a label, link with nothing; they are kept. Shorter vectors count as ending
in zeros. Rows with equal vectors link, also under one id. A NULL id is never a
component's id unless no other member has one, and such a row is not kept. Other columns
are not read. An empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.shared import materialize
from .graph import connected_components

LEAST = 0.93
TABLES = 8
BLOCKS = 2
PROBES = 4
#: Size of a unit vector in lattice units, for vectors of ``WIDTH`` coordinates; longer
#: ones are scaled up, as each of their coordinates holds less.
SCALE, WIDTH = 3.5, 64
CELL = 2048
SEED = 12
#: Rows compared with a whole square, and vectors decoded, at a time.
STRIP, SLICE = 256, 2048


def shortest() -> np.ndarray:
    """The 240 shortest vectors of E8: two coordinates of one, or all of a half with an
    even number of minus signs."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            out.append([a if k == i else b if k == j else 0.0 for k in range(8)])
    out.extend(list(signs) for signs in itertools.product((0.5, -0.5), repeat=8) if sum(s < 0 for s in signs) % 2 == 0)
    return np.array(out)


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest whole points with an even sum: the worst coordinate gives way."""
    point = np.rint(x)
    off = x - point
    worst = np.abs(off).argmax(-1, keepdims=True)
    odd = point.sum(-1, keepdims=True) % 2 != 0
    step = np.where(np.take_along_axis(off, worst, -1) >= 0, 1.0, -1.0)
    turned = point.copy()
    np.put_along_axis(turned, worst, np.take_along_axis(point, worst, -1) + step, -1)
    return np.where(odd, turned, point)


def nearest(x: np.ndarray) -> np.ndarray:
    """Nearest points of E8 to rows of eight coordinates: even whole points, or those
    moved by a half."""
    whole, half = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    closer = ((x - whole) ** 2).sum(-1, keepdims=True) <= ((x - half) ** 2).sum(-1, keepdims=True)
    return np.where(closer, whole, half)


class Hashing:
    """Rotations, shifts and probing of all tables, the same in every task."""

    def __init__(self, width: int, tables: int = TABLES, blocks: int = BLOCKS, probes: int = PROBES, scale: float = SCALE, seed: int = SEED):
        own = 8 * blocks
        self.width = -(-max(width, own) // own) * own
        self.tables, self.blocks, self.probes = tables, blocks, probes
        rng = np.random.default_rng(seed)
        turns = [np.linalg.qr(rng.normal(size=(self.width, self.width)))[0] for _ in range(-(-tables * own // self.width))]
        self.turn = np.concatenate(turns, axis=1)[:, :tables * own] * (scale * np.sqrt(self.width / WIDTH))
        self.shift = rng.uniform(0, 2, tables * own)
        self.roots = shortest()
        self.mix = rng.integers(1, 1 << 62, own, dtype=np.int64) * 2 + 1

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        """int64 keys of shape (rows, tables, 1 + probes): the own cell, then those visited."""
        unit = np.zeros((len(vectors), self.width))
        unit[:, :vectors.shape[1]] = vectors / np.linalg.norm(vectors, axis=1)[:, None]
        x = (unit @ self.turn + self.shift).reshape(len(unit), self.tables, self.blocks, 8)
        point = nearest(x)
        # the nearest borders are those of the roots that lie most along what is left
        along = ((x - point) @ self.roots.T).reshape(len(unit), self.tables, -1)
        towards = np.argpartition(-along, self.probes, axis=-1)[..., :self.probes]
        doubled = (2 * point).astype(np.int64).reshape(len(unit), self.tables, -1)
        steps = (2 * self.roots).astype(np.int64) @ self.mix.reshape(self.blocks, 8).T  # roots by blocks
        with np.errstate(over="ignore"):
            own = (doubled * self.mix).sum(-1)
            visited = own[..., None] + steps.T.reshape(-1)[towards]
        return np.concatenate([own[..., None], visited], axis=-1)


def padded(column: pa.ListArray, width: int) -> np.ndarray:
    """Rows of a list column as a matrix, zeros at the end, largest component 1."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width))
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out / np.abs(out).max(1, keepdims=True)


def _filed(nodes: DataFrame, hashing: Hashing, width: int) -> DataFrame:
    """``nodes`` with keys, all tables one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                keys = hashing.cells(padded(part.column("vector"), width)).reshape(part.num_rows, -1)
                ends = np.arange(0, keys.size + 1, keys.shape[1], dtype=np.int32)
                listed = pa.ListArray.from_arrays(ends, pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns, listed], [*part.schema.names, "keys"])

    return nodes.mapInArrow(run, T.StructType([*nodes.schema.fields, T.StructField("keys", T.ArrayType(T.LongType()))]))


def links(nodes: DataFrame, width: int, hashing: Hashing, least: float = LEAST, cell: int = CELL) -> DataFrame:
    """Links found among ``nodes`` (node, label, vector, copies): rows (a, b, NULL) of
    spanning forests, and rows (a, NULL, n) that add n to a's links."""
    keyed = materialize(_filed(nodes, hashing, width))
    per_table = 1 + hashing.probes
    place = F.posexplode("keys").alias("at", "key")
    filed = keyed.select("node", "label", place).select(
        "node", "label", F.floor(F.col("at") / per_table).cast("int").alias("slot"), "key", (F.col("at") % per_table == 0).alias("own"))
    where = ["label", "slot", "key"]
    sizes = filed.groupBy(*where).agg(F.count(F.when(F.col("own"), 1)).alias("n"), F.count(F.when(~F.col("own"), 1)).alias("v"))
    # stored, so that Spark knows how small it is
    sizes = materialize(sizes.filter("n > 0 and n + v > 1"))
    met = filed.join(sizes, where)
    members, visitors = F.ceil(F.col("n") / cell).cast("int"), F.ceil(F.col("v") / cell).cast("int")
    mine = F.pmod(F.xxhash64("node"), F.when(F.col("own"), members).otherwise(visitors)).cast("int")
    met = met.select(*where, "node", "own", F.col("n").alias("n"), members.alias("members"), visitors.alias("visitors"), mine.alias("mine"))
    # squares of the members' parts p and q <= p; those of part p and visitors have q below zero
    mine, pair = F.col("mine"), "array<struct<p:int,q:int>>"
    parts = F.sequence(F.lit(0), F.col("members") - 1)
    among = F.transform(parts, lambda o: F.struct(F.greatest(o, mine).alias("p"), F.least(o, mine).alias("q"))).cast(pair)
    visited = F.transform(F.sequence(F.lit(1), F.col("visitors")), lambda o: F.struct(mine.alias("p"), (-o).alias("q"))).cast(pair)
    visiting = F.transform(parts, lambda o: F.struct(o.alias("p"), (-mine - 1).alias("q"))).cast(pair)
    squares = F.when(~F.col("own"), visiting).otherwise(F.concat(
        F.when(F.col("n") > 1, among).otherwise(F.array().cast(pair)), F.when(F.col("visitors") > 0, visited).otherwise(F.array().cast(pair))))
    dealt = met.select(*where, "node", "own", "mine", F.explode(squares).alias("s")).select(*where, "s.p", "s.q", "node", "own", "mine")
    whole = dealt.join(keyed.select("node", "vector", "copies", "keys"), "node")
    square = [*where, "p", "q"]
    routed = whole.repartition(*square).sortWithinPartitions(*square, "node")
    # inside a square its name is not needed, only where it ends
    tagged = routed.select(F.xxhash64(*square).alias("square"), "slot", "p", "q", "own", "mine", "node", "copies", "vector", "keys")
    return tagged.mapInArrow(_compared(width, hashing, least), "a long, b long, n long")


def _compared(width: int, hashing: Hashing, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # rows of a square that may go on in the next batch
        for batch in batches:
            squares = batch.column("square").to_numpy()
            starts = np.r_[0, np.flatnonzero(squares[1:] != squares[:-1]) + 1, len(squares)] if len(squares) else [0]
            for a, b in itertools.pairwise(starts):
                if held and held[0].column("square")[0].as_py() != squares[a]:
                    yield from compared(held)
                    held = []
                held.append(batch.slice(a, b - a))
        if held:
            yield from compared(held)

    def compared(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        number = {name: rows.column(name).to_numpy(zero_copy_only=False) for name in ("node", "copies", "own", "p", "q", "mine")}
        vectors = padded(rows.column("vector"), width)
        vectors /= np.linalg.norm(vectors, axis=1)[:, None]
        keys = rows.column("keys").flatten().to_numpy().reshape(len(vectors), hashing.tables, -1)
        slot = rows.column("slot")[0].as_py()
        if number["q"][0] < 0:
            one, other = np.flatnonzero(~number["own"]), np.flatnonzero(number["own"])
        else:
            one, other = np.flatnonzero(number["mine"] == number["q"]), np.flatnonzero(number["mine"] == number["p"])
        degree, forest = link_square(vectors, keys, slot, number["copies"], one, other, least)
        linked = np.flatnonzero(degree)
        if len(linked):
            node, nothing = number["node"], np.full
            yield pa.RecordBatch.from_arrays([
                pa.array(np.r_[node[linked], node[forest[0]]]),
                pa.array(np.r_[nothing(len(linked), 0), node[forest[1]]], mask=np.r_[nothing(len(linked), True), nothing(len(forest[0]), False)]),
                pa.array(np.r_[degree[linked], nothing(len(forest[0]), 0)], mask=np.r_[nothing(len(linked), False), nothing(len(forest[0]), True)]),
            ], ["a", "b", "n"])

    return run


def link_square(vectors, keys, slot: int, copies, one, other, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Number of linked rows (with their copies) of each member, and the links of a
    spanning forest, among pairs of ``one`` and ``other`` that meet in no earlier table."""
    degree, label, out = np.zeros(len(vectors), np.int64), np.arange(len(vectors)), []
    same = len(one) == len(other) and bool((one == other).all())
    for at in range(0, len(one), STRIP):
        rows = one[at:at + STRIP]
        near = vectors[rows] @ vectors[other].T >= least
        if same:
            near &= rows[:, None] < other[None, :]
        i, j = np.nonzero(near)
        i, j = rows[i], other[j]
        for table in range(slot):
            if not len(i):
                break
            x, y = keys[i, table], keys[j, table]
            met = (x[:, :1] == y).any(1) | (x == y[:, :1]).any(1)
            i, j = i[~met], j[~met]
        # here a pair that visits both ways meets twice
        x, y = keys[i, slot], keys[j, slot]
        both = (x[:, 0] > y[:, 0]) & (x[:, :1] == y).any(1)
        i, j = i[~both], j[~both]
        np.add.at(degree, i, copies[j])
        np.add.at(degree, j, copies[i])
        for a, b in _forest(label, i, j):
            out.append((a, b))
    return degree, np.array(out, np.int64).reshape(-1, 2).T


def _forest(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs that join two labels; ``label`` is kept up to date."""
    edges = np.flatnonzero(np.r_[True, i[1:] != i[:-1], True]) if len(i) else []
    for a, b in itertools.pairwise(edges):
        row, others = i[a], j[a:b]
        fresh = others[label[others] != label[row]]
        if len(fresh):
            joined, first = np.unique(label[fresh], return_index=True)
            yield from ((row, other) for other in fresh[first])
            label[np.isin(label, joined)] = label[row]


def near_duplicates(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", *, least: float = LEAST,
    tables: int = TABLES, blocks: int = BLOCKS, probes: int = PROBES, scale: float = SCALE, cell: int = CELL, seed: int = SEED,
) -> DataFrame:
    """id, n_links, component_id and kept of every row."""
    if not 0 < least <= 1:
        raise ValueError("the least cosine lies above 0 and not above 1")
    vector = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    usable = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    rows = table.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), vector.alias("vector"))
    rows = rows.withColumn("links", F.coalesce(usable, F.lit(False)) & F.col("label").isNotNull())
    # -0.0 is 0.0, and zeros at the end change nothing
    plain = F.transform("vector", lambda x: x + F.lit(0.0))
    last = F.array_max(F.transform("vector", lambda x, i: F.when(x != 0, i + 1).otherwise(0)))
    rows = rows.withColumn("vector", F.when(F.col("links"), F.slice(plain, F.lit(1), last)))
    # equal rows are told by two hashes, 128 bits; only numbers go back to them
    rows = rows.withColumns({"h": F.xxhash64("label", "vector"), "g": F.xxhash64(F.lit(seed), "vector", "label")})
    able = rows.filter("links")
    nodes = able.groupBy("h", "g").agg(
        F.first("label").alias("label"), F.first("vector").alias("vector"), F.count("*").alias("copies"), F.min("id").alias("least"))
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()))
    width = nodes.agg(F.max(F.size("vector"))).first()[0]
    if width is None:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.col("id").isNotNull().alias("kept"))
    found = materialize(links(nodes, width, Hashing(width, tables, blocks, probes, scale, seed), least, cell))
    degree = found.filter("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    grouped = materialize(connected_components(found.filter("b is not null").select("a", "b")))
    members = grouped.join(nodes.select("node", "least"), "node")
    smallest = members.groupBy("component").agg(F.min("least").alias("smallest"))
    moved = members.join(smallest, "component").select("node", "smallest")
    known = nodes.select("node", "h", "g", "copies", "least").join(degree, "node", "left").join(moved, "node", "left")
    # stored, so that the last join has nothing above its shuffles and a frequent vector can be split
    known = materialize(known.select(
        "h", "g", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("smallest", "least").alias("component_id")))
    linked = able.select("id", "h", "g").join(known, ["h", "g"]).select("id", "n_links", "component_id")
    rest = rows.filter("not links").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.union(rest).select(
        F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def oracle_sql(least: float = LEAST) -> str:
    """The same in DuckDB SQL, by comparing every pair of a label; ids must differ."""
    return (
        "with recursive v as (select vec_id, label, list_transform(embedding, lambda x: x::double) as e from embeddings),"
        " ok as (select vec_id, label, e from v where label is not null and len(e) > 0 and len(list_filter(e, lambda x: x is null or isnan(x) or isinf(x))) = 0"
        " and len(list_filter(e, lambda x: x <> 0)) > 0),"
        f" l as materialized (select x.vec_id as a, y.vec_id as b from ok x join ok y on x.label = y.label and x.vec_id <> y.vec_id"
        f" where list_cosine_similarity(x.e, y.e) >= {least}),"
        " reach as (select vec_id as a, vec_id as b from v union select r.a, l.b from reach r join l on r.b = l.a),"
        " c as (select a, min(b) as component_id from reach group by a),"
        " d as (select a, count(*) as n from l group by a)"
        " select vec_id, coalesce(n, 0) as n_links, component_id, coalesce(vec_id = component_id, false) as kept"
        " from v left join d on d.a = vec_id left join c on c.a = vec_id"
    )
