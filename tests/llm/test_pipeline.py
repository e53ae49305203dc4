from odd_rows import no_documents, odd_documents  # noqa: F401
import corpus_pipeline
from sieveframe.llm import mixing, simhash
from sieveframe.sources.shared import materialize

SF = "/root/testdata/sf0.001"


def test_stages_follow_from_one_another(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = {}
    at = docs
    for name, stage in corpus_pipeline.STAGES:
        seen[name] = at
        at = materialize(stage(spark, at, SF))
        if name != "packing":
            assert at.columns == docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "language identification", "SimHash near-dedup", "mixing", "packing"]
    good = seen["language identification"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert good.join(labels, "doc_id").filter("quality = 0").count() == 0
    assert docs.join(labels, "doc_id").filter("quality = 1").join(good, "doc_id", "left_anti").count() == 0
    unique = seen["mixing"]
    assert unique.count() == simhash.near_duplicates(seen["SimHash near-dedup"]).select("component_id").distinct().count()
    mixed = seen["packing"]
    assert mixed.count() == mixing.mix(unique).agg({"copies": "sum"}).first()[0]
    assert at.filter("start = 0").count() == mixed.count()


def test_odd_documents_pass_through(spark, odd_documents):
    docs = odd_documents
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF))
    assert docs.count() > 0


def test_no_documents_pass_through(spark, no_documents):
    docs = no_documents
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF))
    assert docs.count() == 0
