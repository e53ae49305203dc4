"""Shards of nearly equal bytes by minimax contiguous partition.

Documents with equal texts stay together. They are ordered by a hash of the text,
whose upper part names one of ``ATOMS`` atomic groups; a group has all documents
of its texts, and the groups' sizes are the sequence to cut. The smallest capacity
that lets a greedy walk over the sequence fill at most ``shards`` shards is found
by binary search; there the sequence is cut. The sequence has a fixed length, so
this search is a small computation on the driver whatever the table's size, and a
group is a small part of a shard unless one text is large itself.

Slots number a shard's documents without gaps. A shard is dealt into buckets of
about ``BUCKET`` rows by hash; buckets are numbered on their own, and the counts
of the buckets before are added.

Rows: NULL text has no bytes and no checksum, and forms one group; repeated rows
each have a slot. Empty shards are possible when there are fewer groups than
shards, or one group outweighs the rest. An empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import materialize

SHARDS = 40
ATOMS = 1 << 17
BUCKET = 8192
ROW_BYTES = 16


def smallest_capacity(sizes: Sequence[int], shards: int) -> int:
    """Least capacity for which a greedy walk needs at most ``shards`` shards."""
    ends = list(accumulate(sizes))
    total = ends[-1] if ends else 0
    low, high = max([-(-total // shards), *sizes]), total
    while low < high:
        middle = (low + high) // 2
        if len(greedy_cuts(ends, middle)) < shards:
            high = middle
        else:
            low = middle + 1
    return low


def greedy_cuts(ends: Sequence[int], capacity: int) -> list[int]:
    """Where shards after the first begin, given running totals of the sizes."""
    cuts, at = [], bisect_right(ends, capacity)
    while at < len(ends):
        cuts.append(at)
        at = bisect_right(ends, ends[at - 1] + capacity, lo=at)
    return cuts


def shard_of(atom: Column, cuts: Sequence[int]) -> Column:
    return sum(((atom >= cut).cast("int") for cut in cuts), F.lit(0))


def slots(rows: DataFrame, group: str, spread: Sequence[str], bucket: int = BUCKET) -> DataFrame:
    """``rows`` with ``slot``: 0, 1, ... within each group."""
    counts = rows.groupBy(group).agg(F.count("*").alias("__n"))
    dealt = rows.join(counts, group).withColumn("__bucket", F.pmod(F.xxhash64(*spread), F.ceil(F.col("__n") / bucket))).drop("__n")
    before = dealt.groupBy(group, "__bucket").agg(F.count("*").alias("__n"))
    order = Window.partitionBy(group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = materialize(before.select(group, "__bucket", F.coalesce(F.sum("__n").over(order), F.lit(0)).alias("__before")))
    within = F.row_number().over(Window.partitionBy(group, "__bucket").orderBy(*spread)) - 1
    numbered = dealt.withColumn("__within", within).join(before, [group, "__bucket"])
    return numbered.withColumn("slot", F.col("__within") + F.col("__before")).drop("__bucket", "__within", "__before")


def partition(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shards: int = SHARDS, atoms: int = ATOMS,
    bucket: int = BUCKET,
) -> DataFrame:
    """id, size, text_crc32, shard and slot of every document."""
    rows = materialize(docs.select(
        F.col(id_col).alias("id"), (F.coalesce(F.octet_length(text_col), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text_col).alias("text_crc32"), F.pmod(F.xxhash64(text_col), F.lit(atoms)).cast("int").alias("atom"),
    ))
    sums = rows.groupBy("atom").agg(F.sum("size").alias("size")).collect()  # a row for each atom, ATOMS at most
    sizes = [0] * atoms
    for atom, size in sums:
        sizes[atom] = size
    cuts = greedy_cuts(list(accumulate(sizes)), smallest_capacity(sizes, shards))
    placed = rows.withColumn("shard", shard_of(F.col("atom"), cuts)).drop("atom")
    return slots(placed, "shard", ["id", "text_crc32", "size"], bucket).withColumnRenamed("id", id_col)
