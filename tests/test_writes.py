import time
from datetime import datetime

import pytest
from conftest import ids
from pyspark.sql import functions as F

from sieveframe import (
    Catalog, ReadOnlyError, delete_by_ids, delete_by_query, export_sorted, filter_in, in_filter, num_found,
    copy_field, get_by_ids, schema_for, sort_columns, terms_doc_freq, upsert_latest, with_defaults,
)

SCHEMA = "id int, ts int, v string"


@pytest.fixture(scope="module")
def current(spark):
    return spark.createDataFrame([(1, 1, "a"), (2, 5, "b"), (3, 3, "c"), (4, None, "d")], SCHEMA)


@pytest.fixture(scope="module")
def incoming(spark):
    return spark.createDataFrame([(2, 4, "old"), (3, 3, "same"), (4, 1, "d2"), (5, 1, "e1"), (5, 2, "e2"), (1, 2, "a2")], SCHEMA)


def test_upsert(current, incoming):
    expected = {(1, 2, "a2"), (2, 5, "b"), (4, 1, "d2"), (5, 2, "e2")}
    ranked = {tuple(r) for r in upsert_latest(current, incoming, "id", "ts").collect()}
    assert ranked - {(3, 3, "c"), (3, 3, "same")} == expected and len(ranked) == 5
    merged = {tuple(r) for r in upsert_latest(current, incoming, "id", "ts", current_unique=True).collect()}
    assert merged == expected | {(3, 3, "same")}


def test_upsert_forms_agree(spark):
    both = spark.range(3000).select(
        (F.col("id") * 7919 % 211).cast("int").alias("id"), (F.col("id") * 31 % 3001).cast("int").alias("ts"),
        F.col("id").cast("string").alias("v"),
    )
    old, new = both.filter("ts % 3 = 0"), both.filter("ts % 3 <> 0")
    state = upsert_latest(old.limit(0), old, "id", "ts")
    ranked = upsert_latest(old, new, "id", "ts").collect()
    assert sorted(ranked) == sorted(upsert_latest(state, new, "id", "ts", current_unique=True).collect())
    assert len(ranked) == both.select("id").distinct().count()


def test_small_change_set_does_not_shuffle_the_collection(spark, tmp_path, incoming):
    spark.range(1000).selectExpr("cast(id as int) id", "0 ts", "'x' v").write.parquet(str(tmp_path / "big"))
    big = spark.read.parquet(str(tmp_path / "big"))
    stored = str(tmp_path / "small")
    incoming.write.parquet(stored)
    df = upsert_latest(big, spark.read.parquet(stored), "id", "ts", current_unique=True)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    # only the change set is exchanged by key, once per use
    assert "WindowGroupLimit" in plan


def test_deletes(spark, current):
    assert ids(delete_by_ids(current, [2, 3], "id")) == [1, 4]
    assert ids(delete_by_ids(current, "(2, 3)", "id")) == [1, 4]
    listed = spark.createDataFrame([("x", 2), ("y", 9)], "other string, id int")
    assert ids(delete_by_ids(current, listed, "id")) == [1, 3, 4]
    assert ids(delete_by_query(current, in_filter("ts", "(1, 3)"))) == [2, 4]
    assert ids(delete_by_query(current, F.col("ts") > 2)) == [1, 4]
    with_null = current.unionByName(spark.createDataFrame([(None, 1, "n")], SCHEMA))
    assert delete_by_ids(with_null, [1], "id").count() == 4
    assert delete_by_ids(with_null, listed, "id").count() == 4


def test_defaults(spark):
    df = spark.createDataFrame([(1, None, None), (2, "x", datetime(2020, 1, 1))], "id int, s string, t timestamp")
    got = {r.id: r for r in with_defaults(df, {"s": "none", "t": "NOW", "n": 3, "added": "NOW"}).collect()}
    assert (got[1].s, got[2].s, got[1].n) == ("none", "x", 3)
    assert got[2].t == datetime(2020, 1, 1) and got[1].t == got[2].added
    assert with_defaults(df, {}) is df


def test_export_is_sorted_file_after_file(spark, tmp_path):
    df = spark.range(2000).select("id", (F.col("id") % 2).alias("k"))
    path = str(tmp_path / "out")
    # one value holds half of the rows; the key at the end of the sort splits it
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    export_sorted(df.repartition(4), sort_columns(df, ["k desc"]), path, "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)
    files = sorted(p for p in (tmp_path / "out").iterdir() if p.suffix == ".parquet")
    assert len(files) > 2
    rows = [tuple(r) for f in files for r in spark.read.parquet(str(f)).collect()]
    assert rows == [(i, 1) for i in range(1, 2000, 2)] + [(i, 0) for i in range(0, 2000, 2)]


def test_catalog(spark, current, incoming):
    catalog = Catalog()
    catalog.register("docs", current, "id", defaults={"v": "none"})
    catalog.register("fixed", current, "id", read_only=True)
    assert ids(catalog.select("docs", order=["id desc"], rows=2)) == [3, 4]
    before = catalog.table("docs")
    catalog.upsert("docs", spark.createDataFrame([(9, 1, None)], SCHEMA), "ts")
    assert before.count() == 4 and catalog.table("docs").filter("id = 9").first().v == "none"
    catalog.delete_by_ids("docs", [9])
    catalog.delete_by_query("docs", in_filter("v", "a"))
    catalog.settle("docs")
    assert ids(catalog.table("docs")) == [2, 3, 4]
    for change in (lambda: catalog.upsert("fixed", incoming, "ts"), lambda: catalog.delete_by_ids("fixed", [1]),
                   lambda: catalog.delete_by_query("fixed", in_filter("id", "1")), lambda: catalog.settle("fixed")):
        with pytest.raises(ReadOnlyError):
            change()
    for name in ("nope", "docs,nope", ""):
        with pytest.raises(LookupError):
            catalog.table(name)
    with pytest.raises(LookupError):
        catalog.register("x", current, "nope")


def test_document_by_random_id(spark):
    uuid = "0c8f6c2e-0d1f-4b0c-9c0e-6f1f3c1b7a55"
    catalog = Catalog()
    catalog.register("docs", spark.createDataFrame([], "id string, stamp int"), "id")
    catalog.upsert("docs", spark.createDataFrame([(uuid, 1)], "id string, stamp int"), "stamp")
    assert [r.id for r in catalog.select("docs", where=in_filter("id", uuid)).collect()] == [uuid]


def test_alias(spark, current):
    catalog = Catalog()
    other = spark.createDataFrame([(1, "z", 2.5)], "id int, v string, w double")
    catalog.register("a", current, "id")
    catalog.register("b", other, "id")
    catalog.alias("both", "a, b,a")
    catalog.alias("outer", ["both"])
    assert catalog.members("both,b") == ["a", "b"]
    df = catalog.table("both")
    assert df.columns == ["id", "ts", "v", "w"] and sorted(ids(df)) == [1, 1, 2, 3, 4]
    assert num_found(catalog.table("both,a,b")).first().num_found == 5
    with pytest.raises(LookupError):
        catalog.table("outer")
    with pytest.raises(ValueError):
        catalog.alias("none", " ,")


def test_schema_for():
    schema = schema_for(["price_f", "name_s", "seen_dt", "id"], {"id": schema_for(["x_i"])[0].dataType})
    assert [f.dataType.simpleString() for f in schema] == ["float", "string", "timestamp", "int"]
    with pytest.raises(LookupError):
        schema_for(["plain"])


def test_get_and_copy(spark, current):
    assert ids(get_by_ids(current, "id", [1, 4, 77])) == [1, 4]
    df = spark.createDataFrame([("a", None, ["x", "y"], 5)], "p string, q string, r array<string>, n int")
    assert copy_field(df, ["p", "q", "r", "n"], "text").first().text == "a x y 5"


def test_terms(spark):
    df = spark.createDataFrame([(1, "The cat, the hat"), (2, "cat"), (1, "cat!"), (None, "cat"), (3, None)], "id int, t string")
    got = {r.term: r.doc_freq for r in terms_doc_freq(df, "id", "t").collect()}
    assert got == {"the": 1, "cat": 2, "hat": 1}
    digits = spark.createDataFrame([(1, "a1 b22 22"), (2, "22")], "id int, t string")
    got = {r.term: r.doc_freq for r in terms_doc_freq(digits, "id", "t", "[0-9]+", unique_key=True).collect()}
    assert got == {"1": 1, "22": 2}


@pytest.mark.parametrize("unique", [False, True])
def test_equal_order_and_missing_keys(spark, unique):
    old = spark.createDataFrame([(1, 5, "old"), (None, 5, "old"), (2, 9, "old")], "id int, ts int, v string")
    new = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (None, 5, "new"), (2, 8, "new")], "id int, ts int, v string")
    got = upsert_latest(old, new, "id", "ts", current_unique=unique).collect()
    assert sorted((r.id or 0, r.v) for r in got) == [(0, "new"), (1, "b"), (2, "old")]


def test_now_is_taken_once(spark):
    catalog = Catalog()
    start = spark.createDataFrame([], "id int, at timestamp")
    catalog.register("c", start, "id", defaults={"at": "NOW"})
    catalog.upsert("c", spark.createDataFrame([(1, None)], "id int, at timestamp"), "id")
    first = catalog.table("c").first().at
    time.sleep(1.1)
    assert catalog.table("c").first().at == first


def test_large_change_set_meets_the_collection_once(spark, current, incoming, tmp_path):
    """One full outer join: each side is read once and exchanged once, NULL keys are one key."""
    wide = current.selectExpr("*", "id * 2 AS extra").union(spark.createDataFrame([(None, 3, "none", 1)], f"{SCHEMA}, extra int"))
    more = incoming.union(spark.createDataFrame([(None, 2, "older"), (None, 3, "none2"), (9, None, "n"), (9, None, "m")], SCHEMA))
    wide.write.parquet(str(tmp_path / "state"))
    more.write.parquet(str(tmp_path / "changes"))
    state, changes = (spark.read.parquet(str(tmp_path / name)) for name in ("state", "changes"))
    small = upsert_latest(state, changes, "id", "ts", current_unique=True).collect()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        merged = upsert_latest(state, changes, "id", "ts", current_unique=True)
        rows = merged.collect()
        plan = merged._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(map(str, rows)) == sorted(map(str, small)) and len(rows) == 7
    assert merged.columns == state.columns
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("FileScan") == 2


def test_long_list_reaches_the_scan(spark, tmp_path):
    spark.range(5000).selectExpr("id", "concat('k', id) AS s", "cast(id as double) AS d").write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    listed = [str(i) for i in range(1000, 2500)] + [None]
    found = filter_in(rows, "id", listed)
    assert found.count() == 1500
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,1000)" in plan and "LessThanOrEqual(id,2499)" in plan
    assert filter_in(rows, "s", [f"k{i}" for i in range(1500)]).count() == 1500
    assert filter_in(rows, "d", ["NaN", *listed]).count() == 1500
