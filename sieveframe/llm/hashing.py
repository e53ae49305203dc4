"""Nearest neighbours by multi-index hashing of learned binary codes.

Codes: vectors are lengthened by one coordinate so that the largest inner product
is the smallest angle, centred, reduced by principal components, and rotated so
that their signs lose least (iterative quantization). The signs are the code.

Search: a code is cut into ``substrings``; each block of the index has a table for
each substring, from its value to the codes that have it. Two codes within a
Hamming radius have a substring within radius / substrings (rounded down), so
probing all values that near retrieves every code within the radius. Those are
checked in full and reranked by the exact inner product of the vectors.

The radius is learned with the rotation, on a bounded sample of ``FIT_ROWS``
vectors: the smallest one that holds ``RECALL`` of the sample's own neighbours, one
bit added. In a block with fewer than ``k`` codes in the radius, the radius grows
until it has them, so a query always gets ``k`` neighbours if there are that many.

The stated queries meet the rows in cells of one query block and one index block,
both dealt by hash, of at most about ``BLOCK`` rows each; a cell gives ``k`` rows for
a query. Nothing is collected or broadcast but the model. Vectors that many rows
share fall into as many blocks as other rows do.

Rows: vectors that are NULL, empty, zero, or hold NULL or a component that is not
finite, and rows with a NULL id, take no part. Shorter vectors count as ending in
zeros. Rows that repeat a query's id are not its candidates; rows that repeat a
candidate's id each count. Ties go to the smaller id. Empty tables give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

NEAREST = 20
EVERY = 20
BITS = 64
SUBSTRINGS = 8
FIT_ROWS = 4096
FIT_QUERIES = 512
RECALL = 0.97
ROUNDS = 30
BLOCK = 8192
SEED = 0
#: Buckets of a table whose members are collected one by one.
FEW = 8


@dataclass(frozen=True)
class Model:
    """Lengthening, centre, projection with rotation, and radius."""

    width: int
    norm: float
    center: np.ndarray
    projection: np.ndarray
    radius: int

    def lengthened(self, vectors: np.ndarray, as_query: bool = False) -> np.ndarray:
        """One more coordinate makes all candidates equally long; queries have 0 there."""
        squares = np.einsum("ij,ij->i", vectors, vectors)
        if as_query:
            scaled, last = vectors * (self.norm / np.sqrt(squares))[:, None], np.zeros(len(vectors))
        else:
            scaled, last = vectors, np.sqrt(np.maximum(self.norm ** 2 - squares, 0))
        return np.concatenate([scaled, last[:, None]], axis=1)

    def codes(self, vectors: np.ndarray, as_query: bool = False) -> np.ndarray:
        """uint8 rows of packed signs."""
        return np.packbits((self.lengthened(vectors, as_query) - self.center) @ self.projection > 0, axis=1)


def distances(code: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return np.bitwise_count(code ^ codes).sum(-1, dtype=np.int32)


def learn(vectors: np.ndarray, norm: float, rows: int, k: int, seed: int = SEED) -> Model:
    """Rotation and radius from sampled vectors of a table of ``rows`` rows."""
    width = vectors.shape[1]
    bare = Model(width, norm, np.zeros(width + 1), np.zeros((width + 1, 0)), 0)
    long = bare.lengthened(vectors)
    center = long.mean(0)
    components = np.linalg.svd(long - center, full_matrices=False)[2][:BITS].T
    reduced = (long - center) @ components
    bits = reduced.shape[1]
    rotation = np.linalg.qr(np.random.default_rng(seed).normal(size=(bits, bits)))[0]
    for _ in range(ROUNDS):
        left, _, right = np.linalg.svd(np.where(reduced @ rotation > 0, 1.0, -1.0).T @ reduced)
        rotation = (left @ right).T
    model = Model(width, norm, center, components @ rotation, bits)
    # A neighbour among k of all rows is one among k_sample of the sample.
    k_sample = int(np.clip(np.ceil(k * len(vectors) / max(rows, 1)), 1, max(len(vectors) - 1, 1)))
    own, asked = model.codes(vectors), model.codes(vectors[:FIT_QUERIES], True)
    needed = []
    for query in range(len(asked)):
        near = vectors @ vectors[query]
        near[query] = -np.inf
        nearest = np.argsort(-near, kind="stable")[:k_sample]
        needed.append(distances(asked[query], own[nearest[nearest != query]]))
    found = np.sort(np.concatenate(needed)) if needed else np.zeros(0, int)
    radius = int(found[min(int(np.ceil(RECALL * len(found))), len(found) - 1)]) + 1 if len(found) else bits
    return Model(width, norm, center, model.projection, min(radius, bits))


class Tables:
    """Substring tables of a block of codes."""

    def __init__(self, codes: np.ndarray, substrings: int):
        self.codes = codes
        self.parts = np.array_split(np.arange(codes.shape[1]), min(substrings, codes.shape[1]))
        # the values in use, where each one's members begin, the members, and each code's value
        self.tables = []
        for part in self.parts:
            values = codes[:, part]
            order = np.lexsort(values.T[::-1])
            kept, first, own = np.unique(values[order], axis=0, return_index=True, return_inverse=True)
            of_code = np.empty(len(order), np.int64)
            of_code[order] = own.ravel()
            self.tables.append((kept, np.r_[first, len(order)], order, of_code))

    def within(self, code: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Every code within the radius, and the distances: pigeonhole probing, then the full check."""
        near = radius // len(self.parts)
        seen = np.zeros(len(self.codes), bool)
        for part, (values, starts, order, of_code) in zip(self.parts, self.tables, strict=True):
            probed = distances(code[part], values) <= near
            buckets = np.flatnonzero(probed)
            if len(buckets) > FEW:
                seen |= probed[of_code]  # the members of many buckets at once
                continue
            for bucket in buckets:
                seen[order[starts[bucket]:starts[bucket + 1]]] = True
        found = np.flatnonzero(seen)
        full = distances(code, self.codes[found])
        return found[full <= radius], full[full <= radius]


def search_block(model: Model, queries: np.ndarray, vectors: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int, substrings: int):
    """For each query: the places and scores of its k nearest in the block."""
    tables = Tables(model.codes(vectors), substrings)
    for query, code, own_id in zip(queries, model.codes(queries, True), own, strict=True):
        mine, radius = ids == own_id, model.radius
        while True:
            found, _ = tables.within(code, radius)
            found = found[~mine[found]]
            if len(found) >= k or radius >= 8 * tables.codes.shape[1]:
                break
            radius += 2
        # row by row in the same order, so that equal vectors have equal scores
        scores = (vectors[found] * query).sum(1)
        if len(found) > k:
            least = np.partition(scores, len(scores) - k)[len(scores) - k]
            found, scores = found[scores >= least], scores[scores >= least]
        best = np.lexsort((ids[found], -scores))[:k]
        yield found[best], scores[best]


def search(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, every: int = EVERY, k: int = NEAREST,
    substrings: int = SUBSTRINGS, block: int = BLOCK, fit_rows: int = FIT_ROWS, seed: int = SEED,
) -> DataFrame:
    """query_id, rank, id and score of the ``k`` nearest of each row whose id is
    divisible by ``every``, among all rows but its own."""
    vector = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    usable = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    rows = table.select(F.col(id_col).cast("long").alias("id"), vector.alias("vector")).filter(F.col("id").isNotNull() & F.coalesce(usable, F.lit(False)))
    square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    held = rows.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("width"), F.sqrt(F.max(square)).alias("norm"), F.count(F.when(F.col("id") % every == 0, 1)).alias("queries")).first()
    result = f"query_id long, rank int, {id_col} long, score double"
    if not held["queries"]:
        return table.sparkSession.createDataFrame([], result)
    width = held["width"]
    sample = rows.filter(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(held["n"])) < fit_rows).toPandas().sort_values("id")
    if not len(sample):
        sample = rows.limit(1).toPandas()
    model = learn(padded(sample["vector"], width), held["norm"], held["n"], k, seed)

    index_blocks, query_blocks = -(-held["n"] // block), -(-held["queries"] // block)

    def cells(df: DataFrame, own: int, others: int, seed: int) -> DataFrame:
        mine = F.pmod(F.xxhash64("id", "vector", F.lit(seed)), F.lit(own)).cast("int")
        return df.select("id", "vector", mine.alias("own"), F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias("other"))

    asked = cells(rows.filter(F.col("id") % every == 0), query_blocks, index_blocks, seed + 1).groupBy("own", "other")
    index = cells(rows, index_blocks, query_blocks, seed + 2).groupBy("other", "own")

    def run(queries: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(members):
            ids = members["id"].to_numpy()
            own = queries["id"].to_numpy()
            found = search_block(model, padded(queries["vector"], width), padded(members["vector"], width), ids, own, k, substrings)
            out = [(own_id, ids[place], score) for own_id, (places, scores) in zip(own, found, strict=True) for place, score in zip(places, scores, strict=True)]
        return pd.DataFrame(out, columns=["query_id", "id", "score"]).astype({"query_id": "int64", "id": "int64", "score": "float64"})

    best = asked.cogroup(index).applyInPandas(run, "query_id long, id long, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    ranked = best.withColumn("rank", place).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")


def padded(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for row, vector in zip(out, vectors, strict=True):
        row[:len(vector)] = vector
    return out
