import numpy as np

from odd_rows import no_documents, odd_documents  # noqa: F401
from sieveframe.llm import quality


def good(i):
    return f"The report of day {i} says that nothing much has happened, and that all people went home early. " * 2


def bad(i):
    return f"BUY{i}$$$ NOW!!! " * 30


def test_learns_from_rows_that_are_not_held_out(spark):
    rows = [(i, good(i) if i % 3 else bad(i)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(400)] + [(None, 0), (5, None)], "doc_id long, quality int")
    got = quality.classify(docs, quality.fit(docs, labels)).toPandas()
    assert len(got) == 400 and got["score"].between(0, 1).all()
    assert (got["predicted"] == (got["doc_id"] % 3 > 0)).all()
    assert ((got["score"] >= 0.3) == (got["predicted"] == 1)).all()
    assert 0 < got["held_out"].mean() < 0.5


def test_cut_lies_at_the_share_of_bad_rows():
    pick = np.random.default_rng(1)
    a, b = pick.normal(1, 1, (300, len(quality.MEASURES))), pick.normal(0, 1, (100, len(quality.MEASURES)))
    model = quality.fit_pairs(a, b)
    assert (model.scores(np.concatenate([a, b])) < quality.CUT_SCORE).sum() == 100


def test_odd_rows(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(1, 1), (4, 0), (4, 0), (2, 0), (99, 1)], "doc_id long, quality int")
    for marked in (labels, labels.limit(0), labels.filter("quality = 1")):
        got = quality.classify(odd_documents, quality.fit(odd_documents, marked)).toPandas()
        assert len(got) == odd_documents.count() and got["score"].between(0, 1).all()
    model = quality.fit(odd_documents, labels.limit(0))
    assert set(quality.classify(odd_documents, model).toPandas()["score"]) == {0.5}
    assert quality.keep_good(odd_documents, model).columns == odd_documents.columns
    assert quality.classify(no_documents, quality.fit(no_documents, labels)).count() == 0


def test_cut_of_a_capped_sample_lies_at_the_share_of_all_bad_rows(spark, monkeypatch):
    monkeypatch.setattr(quality, "RANGES", 16)
    pick = np.random.default_rng(2)
    rows = []
    for i in range(2000):
        marked_bad = i % 10 == 0
        words = good(i).split() + bad(i).split()[:int(pick.integers(0, 25)) + 10 * marked_bad]
        rows.append((i, " ".join(words), int(not marked_bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = quality.fit(docs, docs.select("doc_id", "quality"), fit_rows=60)
    got = quality.classify(docs, model).join(docs, "doc_id").filter("not held_out").toPandas()
    tied = (got["score"] - quality.CUT_SCORE).abs().lt(1e-9).sum()
    assert abs((got["predicted"] == 0).sum() - (got["quality"] == 0).sum()) <= tied


def test_smallest_values(spark, monkeypatch):
    monkeypatch.setattr(quality, "RANGES", 8)
    values = [float(v) for v in np.random.default_rng(4).normal(size=300).round(1)]
    df = spark.createDataFrame([(v,) for v in values], "value double")
    assert [quality.smallest(df, rank) for rank in (1, 40, 150, 300)] == [sorted(values)[rank - 1] for rank in (1, 40, 150, 300)]
