"""Mixing sources to target weights by pivotal rounding.

Every source has a target size. A document of it is wanted target / source size
times, which is seldom a whole number: the whole part is copied, the fraction is a
probability to round. Pivotal rounding takes a pair with fractions and moves words
from one to the other, at random up or down, until one of the two is whole; the
other goes on. Words are moved, not probabilities, so the words a source takes
stay the same at each step, and a document keeps its expected number of copies.
A pair is a document and the pool of the shorter ones in its chunk, whose fractions
move together. (Between two single documents the shorter is settled first, so the
longest of the source would be left to the end, and with it the largest miss. A
document whose words the pool can only make up for one way goes that way.)

The steps form a tree: a source's documents are dealt by hash into chunks of
about ``CHUNK``; a chunk is folded and leaves one document with a fraction, mostly
its shortest; these are dealt into chunks again, level by level, until a source has
one left, which is rounded to the nearest. So a source misses its target by half
that document. A level is one shuffle of narrow rows on (source, chunk); texts are
never shuffled, and a source with most of the rows has more chunks, not larger ones.

Random choices come from hashes of the documents' ids and texts, so reruns agree
however the table is split.

Rows: NULL text has size 0; a document without words takes nothing; NULL is a
source of its own, the last. Repeated rows are rounded one by one. Without any word
all targets are 0. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import materialize
from .common import SPACE

WEIGHTS = (5, 2, 1)
SHARE = 1.5
LARGEST = 2.0
CHUNK = 64
SEED = 0


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def ordered(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` with ``rank``, from 0, by the columns, NULL last. Ranges of rows are
    numbered on their own; only their counts meet."""
    keys = [k for c in columns for k in (F.col(c).isNull(), F.col(c))]
    parts = materialize(df.repartitionByRange(*keys).withColumn("__part", F.spark_partition_id()))
    counts = parts.groupBy("__part").agg(F.count("*").alias("n")).collect()  # a row for each partition
    first, total = [], 0
    for row in sorted(counts):
        first += [F.lit(row["__part"]), F.lit(total).cast("long")]
        total += row["n"]
    if not first:
        return df.withColumn("rank", F.lit(0).cast("long"))
    within = F.row_number().over(Window.partitionBy("__part").orderBy(*keys)) - 1
    return parts.withColumn("rank", within + F.create_map(*first)[F.col("__part")]).drop("__part")


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, largest: float = LARGEST) -> DataFrame:
    """(source, source_size, ...) with rank, weight and target.

    The shares are ``weights`` in turn of ``share`` times all sizes. A target stops
    at ``largest`` times its source; each round shares what is left by weight among
    the others, until none is above. A round is one sum over the sources.
    """
    ranked = ordered(sources, "source")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = materialize(ranked.withColumn("weight", weight.cast("double")))
    most = F.col("source_size") * largest
    level, stopped = 0.0, -1
    while True:
        above = F.col("weight") * level >= most
        row = ranked.agg(
            F.sum("source_size").alias("total"), F.sum(F.when(above, most).otherwise(0.0)).alias("held"),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))).alias("free"), F.count(F.when(above, 1)).alias("stopped"),
        ).first()
        if row["stopped"] == stopped or not row["free"]:
            break
        level, stopped = (row["total"] * share - row["held"]) / row["free"], row["stopped"]
    return ranked.withColumn("target", F.least(F.col("weight") * level, most))


def _step(acc: Column, doc: Column, seed: int) -> Column:
    """Pair a document with the pool of those after it in its chunk.

    ``shift + scale * p`` is the present fraction of a document of the pool, ``inside`` the
    words the pool's fractions stand for, ``outside`` the words they lack to 1.
    """
    p = F.least(F.greatest(acc["shift"] + acc["scale"] * doc["p"], F.lit(0.0)), F.lit(1.0))
    gives, takes = p * doc["size"], (1 - p) * doc["size"]
    inside, outside = F.greatest(acc["inside"] - gives, F.lit(0.0)), F.greatest(acc["outside"] - takes, F.lit(0.0))

    def state(up, shift, scale, inside, outside) -> Column:
        """The document settled by ``up``, or, if that is a fraction, left open while the pool settles."""
        settled = F.struct(*(doc[c].alias(c) for c in ("size", "place", "id", "text_hash")), F.lit(up).alias("p"))
        return F.struct(
            F.concat(acc["done"], F.array(settled)).alias("done"), shift.alias("shift"), scale.alias("scale"),
            F.lit(inside).alias("inside"), F.lit(outside).alias("outside"),
        )

    up, down = F.least(takes, inside), F.least(gives, outside)
    draw = F.pmod(F.xxhash64(doc["place"], F.lit(seed)), F.lit(1 << 53)) / float(1 << 53)
    zero = F.lit(0.0)
    less, more = 1 - takes / inside, 1 - gives / outside
    raised = F.when(takes <= inside, F.when(takes == 0, state(1.0, acc["shift"], acc["scale"], inside, outside)).otherwise(
        state(1.0, acc["shift"] * less, acc["scale"] * less, inside * less, outside + takes)
    )).otherwise(state(p + inside / doc["size"], zero, zero, zero, inside + outside))
    lowered = F.when(gives <= outside, F.when(gives == 0, state(0.0, acc["shift"], acc["scale"], inside, outside)).otherwise(
        state(0.0, 1 - more + acc["shift"] * more, acc["scale"] * more, inside + gives, outside * more)
    )).otherwise(state(p - outside / doc["size"], F.lit(1.0), zero, inside + outside, zero))
    payable = F.when((takes <= inside) & (gives > outside), F.lit(True)).when((takes > inside) & (gives <= outside), F.lit(False))
    return F.when(F.coalesce(payable, draw * (up + down) < down), raised).otherwise(lowered)


def _fold(items: DataFrame, id_type: str, seed: int) -> DataFrame:
    """(rank, chunk, open, size, place, id, text_hash, p): the rows of each chunk,
    longest first, settled with p 0 or 1, but for one that may be ``open``."""
    one = f"struct<size:bigint,place:bigint,id:{id_type},text_hash:bigint,p:double>"
    gathered = items.groupBy("rank", "chunk").agg(
        F.sort_array(F.collect_list(F.struct("size", "place", "id", "text_hash", "p")), asc=False).alias("docs"),
        F.sum("size").alias("words"),
    )
    inside = F.aggregate("docs", F.lit(0.0), lambda total, doc: total + doc["size"] * doc["p"])
    start = F.struct(
        F.array().cast(f"array<{one}>").alias("done"), F.lit(0.0).alias("shift"), F.lit(1.0).alias("scale"),
        F.col("inside"), (F.col("words") - F.col("inside")).alias("outside"),
    )
    folded = gathered.withColumn("inside", inside).select(
        "rank", "chunk", F.aggregate("docs", start, lambda acc, doc: _step(acc, doc, seed))["done"].alias("done")
    )
    rows = folded.select("rank", "chunk", F.inline("done"))
    return rows.select("rank", "chunk", (~F.col("p").isin(0.0, 1.0)).alias("open"), "size", "place", "id", "text_hash", "p")


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *,
    weights: Sequence[int] = WEIGHTS, share: float = SHARE, largest: float = LARGEST, chunk: int = CHUNK, seed: int = SEED,
) -> DataFrame:
    """id, text_hash, source, size, source_size, target, copies and taken (words) of every document."""
    sized = materialize(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.xxhash64(text_col).alias("text_hash"),
        word_count(F.col(text_col)).alias("size"),
    ))
    id_type = sized.schema["id"].dataType.simpleString()
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.when(F.col("size") > 0, 1)).alias("n"))
    wanted = targets(sums, weights, share, largest)
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    wanted = materialize(
        wanted.withColumn("whole", F.floor(copies)).withColumn("p", copies - F.floor(copies))
        .withColumn("chunks", F.ceil(F.col("n") / chunk))
    )
    rows = sized.join(wanted.select(F.col("source").alias("s"), "rank", "p", "chunks"), F.col("source").eqNullSafe(F.col("s"))).drop("s", "source")
    rows = rows.withColumn("place", F.xxhash64("id", "text_hash", F.lit(seed)))
    fractional = (F.col("size") > 0) & (F.col("p") > 0)
    settled = rows.filter(~fractional).select("rank", "size", "place", "id", "text_hash", F.lit(0.0).alias("p"))
    level = rows.filter(fractional).withColumn("chunk", F.pmod("place", "chunks")).select("rank", "chunk", "size", "place", "id", "text_hash", "p")
    most = wanted.agg(F.max("chunks")).first()[0] or 0
    depth = 0
    while True:
        folded = materialize(_fold(level, id_type, seed + depth))
        settled = settled.union(folded.filter("not open").select(settled.columns))
        carried = folded.filter("open")
        if most <= 1:
            break
        # the chunks of the level before are the items of the next one
        depth, most = depth + 1, -(-most // chunk)
        counts = wanted.select("rank", F.ceil(F.col("n") / float(chunk ** (depth + 1))).alias("chunks"))
        dealt = F.pmod(F.xxhash64("chunk", F.lit(seed + depth)), "chunks")
        level = carried.join(counts, "rank").withColumn("chunk", dealt).select(level.columns)
    last = carried.withColumn("p", F.when(F.col("p") >= 0.5, 1.0).otherwise(0.0)).select(settled.columns)
    rounded = settled.union(last).join(wanted.select("rank", "source", "source_size", "target", "whole"), "rank")
    times = (F.col("whole") + F.col("p")).cast("long")
    return rounded.select(
        F.col("id").alias(id_col), "text_hash", F.col("source").alias(source_col), "size", "source_size", "target",
        times.alias("copies"), (F.col("size") * times).alias("taken"),
    )


def repeat_to_targets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """Every document as often as the mix takes it, all columns as they were.
    Rows with equal id, text and source stand for each other."""
    taken = mix(docs, id_col, text_col, source_col, **options)
    taken = taken.groupBy(F.col(id_col).alias("__id"), F.col("text_hash").alias("__hash"), F.col(source_col).alias("__source")).agg(
        F.sum("copies").alias("__copies"), F.count("*").alias("__rows"))
    taken = materialize(taken.filter("__copies > 0"))
    keyed = docs.withColumn("__own_hash", F.xxhash64(text_col))

    def of(rows: DataFrame) -> DataFrame:
        same = keyed[id_col].eqNullSafe(rows["__id"]) & (keyed["__own_hash"] == rows["__hash"]) & keyed[source_col].eqNullSafe(rows["__source"])
        return keyed.join(rows, same)

    once = of(taken.filter("__rows = 1"))
    repeated = of(taken.filter("__rows > 1")).dropDuplicates(["__id", "__hash", "__source"])
    both = once.union(repeated)
    return both.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(docs.columns)
