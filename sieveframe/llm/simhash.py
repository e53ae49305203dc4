"""Near-duplicates by SimHash, found through deletion-variant signatures.

A fingerprint holds 64 bits: a bit is set where more than half of the shingles'
hashes have it set. Two fingerprints link if they differ in at most ``radius``
bits. Cut into ``radius // 2 + 1`` segments, two such fingerprints have a segment
that differs in one bit at most. So each segment is filed whole, and once for
every bit with that bit blanked; an equality join on these signatures meets every
link, and the full distance decides.

Work per bucket:

* Documents with one fingerprint are one node from the start.
* A bucket of whole segments compares its members; a bucket with a blanked bit
  only compares members that have the bit with members that lack it, since the
  others meet elsewhere.
* Buckets without a pair to compare are dropped by their counts before any row is
  moved. Buckets with more than ``cell`` members are cut into cells, so no task
  holds more than two cells' worth of one.
* A cell gives the links of a spanning forest, at most one fewer than its members,
  never its pairs. Components are then joined across cells.

Rows: NULL and empty texts, and texts of white space, have the fingerprint zero,
which links like any other. Repeated rows link. A NULL id is kept; it is never a
component id unless no other member has an id. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import materialize
from .graph import connected_components

BITS = 64
SHINGLE = 3
RADIUS = 3
SEED = 42
#: Members of a bucket that are compared at once.
CELL = 4096

_FOLD = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint of a whole text."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()
    if not words:
        return 0
    runs = zip(*(words[i:] for i in range(shingle)), strict=False) if len(words) >= shingle else [words]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(b" ".join(run), SEED) for run in runs], np.uint64)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    set_bits = bits.sum(0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(set_bits, bitorder="little").view(np.int64)[0])


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    @F.pandas_udf("long")
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(text, shingle) for text in texts], dtype="int64")

    return found(text)


def segments(radius: int) -> list[tuple[int, int]]:
    """(first bit, width) of the segments for a radius."""
    count = radius // 2 + 1
    ends = [BITS * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(ends, ends[1:], strict=False)]


def _signed(bits: int) -> int:
    return bits - (1 << BITS) if bits >> (BITS - 1) else bits


def signatures(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, slot, value, side): every segment whole and with each bit blanked.
    ``slot`` names segment and bit; ``side`` is the blanked bit."""
    plan = [(first, width, bit) for first, width in segments(radius) for bit in range(-1, width)]
    slots = F.array(*(
        F.struct(F.lit(slot).alias("slot"), F.lit(first).alias("first"), F.lit(_signed((1 << width) - 1)).cast("long").alias("mask"),
                 F.lit(max(bit, 0)).alias("bit"), F.lit(0 if bit < 0 else _signed(1 << bit)).cast("long").alias("blank"))
        for slot, (first, width, bit) in enumerate(plan)
    ))
    rows = prints.select("fp", F.explode(slots).alias("s"))
    segment = F.expr("shiftrightunsigned(fp, s.first) & s.mask")
    return rows.select(
        "fp", "s.slot", segment.bitwiseAND(F.expr("~s.blank")).alias("value"),
        F.when(F.col("s.blank") == 0, 0).otherwise(F.expr("cast(shiftrightunsigned(shiftrightunsigned(fp, s.first) & s.mask, s.bit) & 1 as int)")).alias("side"),
        (F.col("s.blank") == 0).alias("whole"),
    )


def links(prints: DataFrame, radius: int = RADIUS, cell: int = CELL) -> DataFrame:
    """Links (a, b) that connect exactly the fingerprints which links of at most
    ``radius`` bits connect. ``prints`` holds each fingerprint once, as ``fp``."""
    # the few bytes of a fingerprint become dozens of rows, so they are dealt to all tasks first
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    filed = signatures(prints.repartition(tasks, "fp"), radius)
    sizes = filed.groupBy("slot", "value").agg(
        F.count(F.when(F.col("side") == 0, 1)).alias("n0"), F.count(F.when(F.col("side") == 1, 1)).alias("n1"),
        F.first("whole").alias("whole"),
    ).filter("whole and n0 > 1 or n0 > 0 and n1 > 0").drop("whole")
    # stored, so that Spark knows how small it is
    met = filed.join(materialize(sizes), ["slot", "value"])
    blocks0, blocks1 = (F.ceil(F.col(n) / cell).cast("int") for n in ("n0", "n1"))
    own = F.pmod(F.xxhash64("fp"), F.when(F.col("side") == 0, blocks0).otherwise(blocks1)).cast("int")
    across = F.when(F.col("side") == 0, blocks1).otherwise(blocks0)
    other = F.when(
        F.col("whole"), F.when(blocks0 == 1, F.array(F.lit(0))).otherwise(F.array_remove(F.sequence(F.lit(0), blocks0 - 1), own))
    ).otherwise(F.sequence(F.lit(0), across - 1))
    dealt = met.select("slot", "value", "fp", "side", "whole", own.alias("own"), F.explode(other).alias("other"))
    swap = F.col("whole") & (F.col("own") > F.col("other")) | ~F.col("whole") & (F.col("side") == 1)
    cells = dealt.select(
        "slot", "value", F.when(swap, F.col("other")).otherwise(F.col("own")).alias("p"),
        F.when(swap, F.col("own")).otherwise(F.col("other")).alias("q"), "side", "fp",
    )
    keys = ["slot", "value", "p", "q"]
    sorted_cells = cells.repartition(*keys).sortWithinPartitions(*keys, "side", "fp")
    return sorted_cells.mapInArrow(_forests(radius), "a long, b long").distinct()


def _forests(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # rows of a cell that may go on in the next batch
        for batch in batches:
            rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(6)])
            if held:
                rows = np.concatenate([*held, rows], axis=1)
            if not rows.shape[1]:
                continue
            starts = np.flatnonzero(np.r_[True, (rows[:4, 1:] != rows[:4, :-1]).any(0)])
            held = [rows[:, starts[-1]:]]
            yield from _linked(rows[:, :starts[-1]], starts, radius)
        if held:
            yield from _linked(held[0], np.array([0, held[0].shape[1]]), radius)

    return run


def _linked(rows: np.ndarray, starts: np.ndarray, radius: int) -> Iterator[pa.RecordBatch]:
    """Links within the cells that begin at ``starts[:-1]``."""
    fps, side, found = rows[5].view(np.uint64), rows[4], []
    counts = np.diff(starts)
    two = starts[:-1][counts == 2]
    near = two[np.bitwise_count(fps[two] ^ fps[two + 1]) <= radius]
    found.append(np.stack([fps[near], fps[near + 1]]))
    for start, count in zip(starts[:-1][counts > 2], counts[counts > 2], strict=True):
        found.append(forest(fps[start:start + count], side[start:start + count], radius))
    a, b = np.concatenate(found, axis=1).view(np.int64)
    if len(a):
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def forest(fps: np.ndarray, side: np.ndarray, radius: int) -> np.ndarray:
    """Links of a spanning forest of the members of a cell: between its sides if
    it has two, else among all."""
    one = np.flatnonzero(side == 1)
    rows, others = (np.arange(len(fps)),) * 2
    if 0 < len(one) < len(fps):
        zero = np.flatnonzero(side == 0)
        rows, others = (one, zero) if len(one) < len(zero) else (zero, one)
    label, out = np.arange(len(fps)), []
    for row in rows:
        near = others[np.bitwise_count(fps[others] ^ fps[row]) <= radius]
        fresh = near[label[near] != label[row]]
        if len(fresh):
            joined, first = np.unique(label[fresh], return_index=True)
            out.extend((row, other) for other in fresh[first])
            label[np.isin(label, joined)] = label[row]
    pairs = np.array(out, np.int64).reshape(-1, 2).T
    return fps[pairs]


def cluster(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = SHINGLE, radius: int = RADIUS,
    cell: int = CELL,
) -> DataFrame:
    """id, fp, text_hash and component_id (smallest id reachable) of every document."""
    prints = materialize(docs.select(
        F.col(id_col).alias("id"), fingerprints(F.col(text_col), shingle).alias("fp"), F.xxhash64(text_col).alias("text_hash"),
    ))
    return _labelled(prints, radius, cell).withColumnRenamed("id", id_col)


def _labelled(prints: DataFrame, radius: int, cell: int) -> DataFrame:
    nodes = materialize(prints.groupBy("fp").agg(F.min("id").alias("least")))
    return labelled(prints, links(nodes.select("fp"), radius, cell), nodes)


def labelled(prints: DataFrame, linked: DataFrame, nodes: DataFrame) -> DataFrame:
    """``prints`` (id, fp, text_hash) with component_id, given the links (a, b) between
    fingerprints and the ``least`` id of each."""
    grouped = materialize(connected_components(linked))
    linked = grouped.join(nodes, grouped["node"] == nodes["fp"]).select("fp", "component", "least")
    smallest = linked.groupBy("component").agg(F.min("least").alias("smallest"))
    moved = linked.join(smallest, "component").select("fp", "smallest")
    # stored, so that the last join has nothing above its shuffles and a frequent fingerprint can be split
    owner = materialize(nodes.join(moved, "fp", "left").select("fp", F.coalesce("smallest", "least").alias("component_id")))
    return prints.join(owner, "fp").select("id", "fp", "text_hash", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """id, fingerprint (16 hex digits) and component_id of every document."""
    found = cluster(docs, id_col, text_col, **options)
    return found.select(id_col, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each component, that with the smallest id (then the smallest
    text hash); all columns as they were. Of repeated rows one stays."""
    return keep_smallest(docs, cluster(docs, id_col, text_col, **options), id_col, text_col)


def keep_smallest(docs: DataFrame, clusters: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The row of each cluster with the smallest id, of what ``cluster`` returns."""
    found = clusters.select(F.col(id_col).alias("id"), "text_hash", "component_id", "fp")
    # a component without any id is one fingerprint group of its own
    group = F.struct("component_id", F.when(F.col("component_id").isNull(), F.col("fp")))
    kept = found.groupBy(group.alias("g")).agg(F.min(F.struct(F.col("id").isNull(), "id", "text_hash")).alias("k"))
    kept = kept.select(F.col("k.id").alias("__id"), F.col("k.text_hash").alias("__hash"))
    often = found.groupBy("id", "text_hash").count().filter("count > 1").select("id", "text_hash", F.lit(True).alias("__often"))
    kept = kept.join(often, kept["__id"].eqNullSafe(often["id"]) & (kept["__hash"] == often["text_hash"]), "left")
    kept = materialize(kept.select("__id", "__hash", F.coalesce("__often", F.lit(False)).alias("__often")))
    keyed = docs.withColumn("__own_hash", F.xxhash64(text_col))

    def of(rows: DataFrame) -> DataFrame:
        same = keyed[id_col].eqNullSafe(rows["__id"]) & (keyed["__own_hash"] == rows["__hash"])
        return keyed.join(rows, same).select(*(keyed[c] for c in docs.columns), "__id", "__hash")

    once = of(kept.filter("not __often")).drop("__id", "__hash")
    repeated = of(kept.filter("__often")).dropDuplicates(["__id", "__hash"]).drop("__id", "__hash")
    return once.union(repeated)
