import zlib
from itertools import accumulate

import numpy as np
import pytest

from odd_rows import no_documents, odd_documents  # noqa: F401
from sieveframe.llm import sharding


def best_by_hand(sizes, shards):
    """Smallest largest sum over all ways to cut into at most ``shards`` runs."""
    ends = [0, *accumulate(sizes)]
    best = ends[:]
    for _ in range(shards - 1):
        best = [min(max(best[j], ends[i] - ends[j]) for j in range(i + 1)) for i in range(len(ends))]
    return best[-1]


@pytest.mark.parametrize("shards", [1, 2, 5, 40])
def test_capacity_is_the_smallest(shards):
    pick = np.random.default_rng(shards)
    for sizes in (pick.integers(1, 50, 30).tolist(), [7], [1000, 1, 1, 1], [0, 0, 5, 0], []):
        capacity = sharding.smallest_capacity(sizes, shards)
        assert capacity == (best_by_hand(sizes, shards) if sizes else 0)
        if sum(sizes):
            cuts = [0, *sharding.greedy_cuts(list(accumulate(sizes)), capacity), len(sizes)]
            assert len(cuts) - 1 <= shards and max(sum(sizes[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)) <= capacity


def test_shards_and_slots(spark):
    docs = spark.createDataFrame([(i, f"text {i % 300} " * (1 + i % 9)) for i in range(3000)], "doc_id long, text string")
    got = sharding.partition(docs, shards=7, bucket=50).join(docs, "doc_id").toPandas()
    assert len(got) == 3000 and got["shard"].between(0, 6).all()
    assert (got.groupby("text")["shard"].nunique() == 1).all()
    for _, rows in got.groupby("shard"):
        assert sorted(rows["slot"]) == list(range(len(rows)))
    bytes_ = got.groupby("shard")["size"].sum()
    groups = got.groupby("text")["size"].sum()
    assert bytes_.max() <= got["size"].sum() / 7 + groups.max()
    assert [zlib.crc32(t.encode()) for t in got["text"]] == got["text_crc32"].tolist()


def test_one_text_on_most_rows(spark):
    docs = spark.range(2000).selectExpr("id AS doc_id", "if(id < 1500, 'same', cast(id AS string)) AS text")
    got = sharding.partition(docs, shards=4, bucket=100).toPandas()
    assert sorted(got["slot"].groupby(got["shard"]).max() + 1) == sorted(got["shard"].value_counts())


def test_odd_rows(odd_documents, no_documents):
    got = sharding.partition(odd_documents).toPandas()
    texts = odd_documents.select("text").toPandas()["text"]
    assert sorted(got["size"]) == sorted(len((t or "").encode()) + 16 for t in texts)
    assert got["text_crc32"].isna().sum() == texts.isna().sum()
    for _, rows in got.groupby("shard"):
        assert sorted(rows["slot"]) == list(range(len(rows)))
    assert sharding.partition(no_documents).count() == 0
