import re

import pytest

from odd_rows import no_documents, odd_documents  # noqa: F401
from sieveframe.llm import mixing


def targets_by_hand(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + [n for n in sizes if n is None]
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    left, stopped = share * sum(sizes.values()), {}
    while True:
        free = [n for n in names if n not in stopped]
        total = sum(weight[n] for n in free)
        above = [n for n in free if weight[n] * (left - sum(stopped.values())) / total >= most * sizes[n]]
        if not above:
            return {**stopped, **{n: weight[n] * (left - sum(stopped.values())) / total for n in free}}
        stopped.update((n, most * sizes[n]) for n in above)
        if len(stopped) == len(names):
            return stopped


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, " ".join(["w"] * (1 + i * i % 97)), ("b", "a", None, "é", "z")[min(i % 7, 4)]) for i in range(1500)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


@pytest.mark.parametrize("chunk", [64, 4])
def test_sources_come_near_their_targets(docs, chunk):
    got = mixing.mix(docs, chunk=chunk).toPandas()
    assert len(got) == 1500 and got["doc_id"].nunique() == 1500
    sizes = {None if k == "-" else k: v for k, v in got.fillna({"source": "-"}).groupby("source")["size"].sum().items()}
    want = targets_by_hand(sizes)
    for name, rows in got.fillna({"source": "-"}).groupby("source"):
        name = None if name == "-" else name
        assert rows["source_size"].iloc[0] == sizes[name]
        assert rows["target"].iloc[0] == pytest.approx(want[name])
        assert abs(rows["taken"].sum() - want[name]) <= rows["size"].max() / 2 + 1e-6
    assert (got["taken"] == got["size"] * got["copies"]).all() and got["copies"].between(0, 2).all()
    x = got["target"] / got["source_size"]
    assert ((got["copies"] - x).abs() < 1).all()


def test_reruns_agree_on_other_partitions(docs):
    one, two = (mixing.mix(d).orderBy("doc_id").select("doc_id", "taken").collect() for d in (docs, docs.repartition(7, "text")))
    assert one == two


def test_draws_are_fair(spark):
    # in 300 sources of equal documents each place is taken as often as the target asks
    docs = spark.range(300 * 9).selectExpr("id AS doc_id", "concat('s', id % 300) AS source", "repeat('w ', cast(5 + id div 300 AS int)) AS text")
    got = mixing.mix(docs, weights=(1,), share=1.4).toPandas()
    assert got.groupby(got["doc_id"] // 300)["copies"].mean().tolist() == pytest.approx([1.4] * 9, abs=0.12)


def test_documents_are_repeated(docs):
    taken = mixing.mix(docs)
    rows = mixing.repeat_to_targets(docs)
    assert rows.columns == docs.columns
    want = {r.doc_id: r.copies for r in taken.collect() if r.copies}
    assert {r.doc_id: r["count"] for r in rows.groupBy("doc_id").count().collect()} == want


def test_odd_rows(odd_documents, no_documents):
    got = mixing.mix(odd_documents).toPandas()
    texts = odd_documents.select("text").toPandas()["text"]
    assert sorted(got["size"]) == sorted(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts)
    assert (got["taken"] <= 2 * got["size"]).all() and (got[got["size"] == 0]["taken"] == 0).all()
    repeated = mixing.repeat_to_targets(odd_documents)
    assert repeated.columns == odd_documents.columns
    assert repeated.selectExpr("sum(size(filter(split(text, '[ \\t-\\r]+'), x -> x <> '')))").first()[0] == got["taken"].sum()
    assert mixing.repeat_to_targets(no_documents).count() == 0
    assert mixing.mix(odd_documents.filter("trim(text) = ''")).agg({"taken": "sum"}).first()[0] == 0
