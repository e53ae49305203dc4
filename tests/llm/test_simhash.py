import re

import numpy as np
import pytest
import xxhash

from odd_rows import no_documents, odd_documents  # noqa: F401
from sieveframe.llm import graph, simhash


def print_by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return bits - (1 << 64) if bits >> 63 else bits


def components_by_hand(fps, radius):
    owner = list(range(len(fps)))

    def find(x):
        while owner[x] != x:
            x = owner[x]
        return x

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[i] ^ fps) <= radius):
            a, b = find(i), find(int(j))
            owner[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("radius,cell", [(3, 4096), (3, 8), (1, 8), (5, 4096)])
def test_links_connect_what_all_pairs_connect(spark, radius, cell):
    pick = np.random.default_rng(7)
    fps = set(pick.integers(0, 2**64, 200, np.uint64).tolist())
    for center in list(fps)[:4]:
        at = center
        for _ in range(60):
            at = at if pick.random() < 0.5 else center
            for bit in pick.choice(64, pick.integers(1, 5), replace=False):
                at ^= 1 << int(bit)
            fps.add(at)
    fps = np.array(sorted(fps), np.uint64)
    signed = fps.view(np.int64).tolist()
    order = np.argsort(signed)
    fps, signed = fps[order], sorted(signed)
    want = {signed[i]: signed[c] for i, c in enumerate(components_by_hand(fps, radius))}
    prints = spark.createDataFrame([(fp,) for fp in signed], "fp long")
    got = {r.node: r.component for r in graph.connected_components(simhash.links(prints, radius, cell)).collect()}
    assert {fp: got.get(fp, fp) for fp in signed} == want


def test_long_chain(spark):
    edges = spark.range(300).selectExpr("id AS a", "id + 1 AS b").union(spark.createDataFrame([(900, 901), (5, 5)], "a long, b long"))
    got = {r.node: r.component for r in graph.connected_components(edges).collect()}
    assert got == {**dict.fromkeys(range(301), 0), 900: 900, 901: 900}


def test_fingerprints_and_components(spark, odd_documents):
    got = simhash.near_duplicates(odd_documents).toPandas()
    docs = odd_documents.select("doc_id", "text").toPandas()
    want = sorted("%016x" % (print_by_hand(t) % 2**64) for t in docs["text"])
    assert sorted(got["fingerprint"]) == want
    fps = np.array([int(f, 16) for f in got["fingerprint"]], np.uint64)
    groups = components_by_hand(fps, 3)
    for group in set(groups):
        rows = got[[g == group for g in groups]]
        assert set(rows["component_id"].fillna(-1)) == {rows["doc_id"].fillna(-1).min() if rows["doc_id"].isna().all() else rows["doc_id"].min()}


def test_one_document_of_each_group_stays(spark, odd_documents, no_documents):
    kept = simhash.drop_near_duplicates(odd_documents)
    assert kept.columns == odd_documents.columns
    components = simhash.near_duplicates(odd_documents).select("component_id").distinct().count()
    rows = kept.toPandas()
    assert len(rows) == components and (rows["doc_id"].dropna().value_counts() == 1).all()
    assert simhash.drop_near_duplicates(no_documents).count() == 0
    assert simhash.near_duplicates(no_documents).count() == 0


def test_repeated_rows_leave_one(spark):
    docs = spark.createDataFrame([(3, "a b c d"), (3, "a b c d"), (4, "a b c d")], "doc_id long, text string")
    assert [tuple(r) for r in simhash.drop_near_duplicates(docs).collect()] == [(3, "a b c d")]
