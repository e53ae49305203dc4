import math

import numpy as np
import pytest

from sieveframe.llm import hashing


def frame(spark, vectors, ids=None):
    rows = [(int(i), [None if x is None else float(x) for x in v] if v is not None else None) for i, v in zip(ids if ids is not None else range(len(vectors)), vectors, strict=True)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS id", "2 AS vector", "3 AS own", "4 AS other", "5 AS score")


def nearest_by_hand(vectors, ids, query, k):
    scores = (vectors * vectors[query]).sum(1)
    places = [i for i in np.lexsort((ids, -scores)) if ids[i] != ids[query]][:k]
    return [(int(ids[i]), scores[i]) for i in places]


@pytest.mark.parametrize("block", [8192, 150])
def test_recall_against_brute_force(spark, block):
    pick = np.random.default_rng(3)
    centers = pick.normal(size=(12, 24))
    vectors = (centers[pick.integers(0, 12, 1000)] + pick.normal(size=(1000, 24)) * 0.6).astype(np.float32).astype(float)
    vectors *= pick.uniform(0.5, 2, (1000, 1)).astype(np.float32)
    vectors = vectors.astype(np.float32).astype(float)
    got = hashing.search(frame(spark, vectors), block=block, k=20, fit_rows=400).toPandas()
    hits = 0
    for query, rows in got.groupby("query_id"):
        rows = rows.sort_values("rank")
        assert rows["rank"].tolist() == list(range(1, 21))
        want = nearest_by_hand(vectors, np.arange(1000), query, 20)
        hits += len({i for i, _ in want} & set(rows["vec_id"]))
        exact = (vectors[rows["vec_id"]] * vectors[query]).sum(1)
        assert np.allclose(exact, rows["score"], rtol=0, atol=1e-12)
        assert rows.sort_values(["score", "vec_id"], ascending=[False, True])["vec_id"].tolist() == rows["vec_id"].tolist()
    assert got["query_id"].nunique() == 50 and hits / 1000 >= 0.9


def test_probing_finds_every_code_within_the_radius():
    pick = np.random.default_rng(5)
    codes = pick.integers(0, 256, (500, 8), np.uint8)
    codes[100:300] = codes[0] ^ (1 << pick.integers(0, 8, (200, 8)) * (pick.random((200, 8)) < 0.4)).astype(np.uint8)
    tables = hashing.Tables(codes, 8)
    for radius in (0, 3, 9, 20, 64):
        found, full = tables.within(codes[0], radius)
        want = np.flatnonzero(hashing.distances(codes[0], codes) <= radius)
        assert found.tolist() == want.tolist() and (full == hashing.distances(codes[0], codes[want])).all()


def test_equal_vectors_tie_to_smaller_ids(spark):
    got = hashing.search(frame(spark, [[1.0, 2.0, 3.0]] * 300), k=5, block=40).toPandas()
    for query, rows in got.groupby("query_id"):
        assert rows.sort_values("rank")["vec_id"].tolist() == [i for i in range(6) if i != query][:5]


def test_odd_rows(spark):
    vectors = [[1, 0, 0], None, [], [0, 0, 0], [1, None, 0], [math.nan, 1, 0], [math.inf, 0, 0], [2, 1], [0, 1, 1], [0, 1, 1]]
    df = frame(spark, vectors, [0, 1, 2, 3, 4, 5, 6, 7, 8, 8]).union(frame(spark, [[1, 1, 1]], [0]).selectExpr("CAST(NULL AS long)", *frame(spark, [[1]]).columns[1:]))
    got = sorted(map(tuple, hashing.search(df, every=20, k=20).collect()))
    assert [(q, r, v, s) for q, r, v, s in got] == [(0, 1, 7, 2.0), (0, 2, 8, 0.0), (0, 3, 8, 0.0)]
    assert hashing.search(df.limit(0)).count() == 0
    assert hashing.search(df.filter("vec_id = 0")).count() == 0
    assert hashing.search(df.filter("vec_id = 7")).count() == 0
