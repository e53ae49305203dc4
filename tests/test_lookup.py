import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from sieveframe import Catalog, desc, filter_in, find_hot_keys, lookup, lookup_ref, mul, select
from sieveframe.operators.lookup import split_ref


@pytest.fixture(scope="module")
def main(spark):
    return spark.createDataFrame([("1", 100), ("2", 50), ("3", 9)], "id string, my_i int")


@pytest.fixture(scope="module")
def sub(spark):
    return spark.createDataFrame([("1", 20), ("2", 80)], "id string, other_i int")


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_modes(main, sub):
    assert rows(lookup(main, sub, "id", "other_i"), "id", "other_i") == [("1", 20), ("2", 80), ("3", None)]
    assert rows(lookup(main, sub, "id", "other_i", mode="numeric"), "id", "other_i") == [("1", 20), ("2", 80), ("3", 0)]
    assert rows(lookup(main, sub, "id", "other_i", mode="exists", name="hit"), "id", "hit") == [("1", True), ("2", True), ("3", False)]
    assert lookup(main, sub, "id", "other_i").columns == ["id", "my_i", "other_i"]


def test_sort_by_looked_up_value(main, sub):
    df = lookup(main, sub, "id", "other_i", mode="numeric", name="v")
    by_value = select(df, fields=["id"], order=[desc(mul("v", 2))], key="id", return_sort_values=True).collect()
    assert [(r.id, r.sort_1) for r in by_value] == [("2", 160.0), ("1", 40.0), ("3", 0.0)]
    by_id = select(df, fields=["v"], order=["id desc"], key="id").collect()
    assert [r.v for r in by_id] == [0, 80, 20]


def test_missing_value_is_not_a_missing_row(spark, main):
    target = spark.createDataFrame([("1", None), ("2", 7), (None, 99)], "id string, v int")
    got = lookup(main, target, "id", "v", default=-1)
    assert rows(got, "id", "v") == sorted([("1", None), ("2", 7), ("3", -1)], key=str) or set(rows(got.fillna(-9), "id", "v")) == {("1", -9), ("2", 7), ("3", -1)}
    assert set(rows(lookup(main, target, "id", "v", mode="numeric"), "id", "v")) == {("1", 0), ("2", 7), ("3", 0)}
    assert set(rows(lookup(main, target, "id", "v", mode="exists"), "id", "v")) == {("1", True), ("2", True), ("3", False)}


def test_first_match_and_row_count(spark):
    main = spark.createDataFrame([(i % 7 if i % 10 else None, i) for i in range(500)], "k int, n int")
    target = spark.createDataFrame([(i % 5, i, 1000 - i) for i in range(300)], "k int, a int, b int")
    for options in ({}, {"hot_keys": []}, {"hot_keys": [1, 2]}):
        smallest = lookup(main, target, "k", "a", **options)
        assert smallest.count() == 500
        expected = {(i % 7 if i % 10 else None, i, (i % 7) if i % 10 and i % 7 < 5 else None) for i in range(500)}
        assert {tuple(r) for r in smallest.collect()} == expected
        last = lookup(main, target, "k", "a", order=[F.col("b").asc()], **options)
        expected = {(k, n, None if a is None else 295 + a) for k, n, a in expected}
        assert {tuple(r) for r in last.collect()} == expected


def test_one_row_per_task_before_the_shuffle(spark):
    target = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = plan_of(lookup(spark.range(3).withColumnRenamed("id", "k"), target, "k", "id", order=[F.col("id").desc()]))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_keys_of_other_name_and_type(spark, main):
    target = spark.createDataFrame([(1, "x"), (3, "z")], "sub_id bigint, v string")
    got = lookup(main, target, "id", "v", target_key="sub_id")
    assert {tuple(r) for r in got.select("id", "v").collect()} == {("1", "x"), ("2", None), ("3", "z")}


def test_checks(main, sub):
    for bad in (("nope", "other_i"), ("id", "nope")):
        with pytest.raises(LookupError):
            lookup(main, sub, *bad)
    with pytest.raises(ValueError):
        lookup(main, sub, "id", "other_i", mode="text")
    with pytest.raises(ValueError):
        lookup(main, sub, "id", "other_i", name="my_i")


def test_names(main, sub):
    assert split_ref("sub.other_i") == ("sub", "other_i")
    assert split_ref("_x_sub.a.b", prefix="_x_") == ("sub", "a.b")
    for bad in ("sub", "sub.", ".", ""):
        with pytest.raises(ValueError):
            split_ref(bad)
    catalog = Catalog()
    catalog.register("main", main, "id")
    catalog.register("sub", sub, "id", defaults={"other_i": 5})
    got = lookup_ref(catalog, "main", "_x_sub.other_i", prefix="_x_", name="v")
    assert rows(got, "id", "v") == [("1", 20), ("2", 80), ("3", 5)]
    assert "sub.other_i" in catalog.lookup("main", "sub.other_i").columns
    catalog.alias("both", "main,sub")
    assert catalog.lookup("both", "sub.other_i", name="v").count() == 5
    for bad in ("none.other_i", "sub.nope"):
        with pytest.raises(LookupError):
            catalog.lookup("main", bad)


def test_hot_keys(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 10 == 1, F.lit(9)).otherwise(F.col("id") + 100).alias("k")
    )
    assert sorted(find_hot_keys(df, "k", 0.05)) == [7, 9]
    assert find_hot_keys(df, "k", 0.2) == [7]
    assert find_hot_keys(df.limit(0), "k") == []
    # hot rows meet their value in many tasks
    target = spark.createDataFrame([(7, "hot"), (9, "warm"), (101, "cold")], "k bigint, v string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    spark.conf.set("spark.sql.shuffle.partitions", 16)
    try:
        wide = df.withColumn("n", F.monotonically_increasing_id())
        def tasks(hot):
            got = lookup(wide, target, "k", "v", hot_keys=hot).filter("v = 'hot'")
            return got.groupBy(F.spark_partition_id()).count().count(), got.count()
        assert tasks([]) == (1, 10_000)
        for hot in ([7, 9], "auto"):
            spread, n = tasks(hot)
            assert spread >= 12 and n == 10_000
        listed = spark.createDataFrame([(7,)] * 500 + [(9,), (None,)], "v bigint")
        kept = filter_in(wide, "k", listed)
        assert kept.count() == 12_000
        assert kept.groupBy(F.spark_partition_id()).count().count() >= 12
        assert filter_in(wide, "k", listed, not_=True).count() == 18_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 10 * 1024 * 1024)
        spark.conf.set("spark.sql.adaptive.enabled", True)
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_filters_pass_below_a_salted_lookup(spark, main, sub, tmp_path):
    main.write.parquet(str(tmp_path / "m"))
    stored = spark.read.parquet(str(tmp_path / "m"))
    plan = plan_of(lookup(stored, sub, "id", "other_i", hot_keys=["1"]).filter("my_i > 60"))
    assert "GreaterThan(my_i,60)" in plan


def test_several_fields_come_from_one_row(spark, main):
    target = spark.createDataFrame([("1", 5, "b"), ("1", 3, "z"), ("2", None, "a"), ("2", 8, "c")], "id string, n int, s string")
    got = lookup(main, target, "id", ["n", "s"], name=["a", "b"], default=[-1, "none"])
    assert rows(got, "id", "a", "b") == [("1", 3, "z"), ("2", 8, "c"), ("3", -1, "none")]
    by_text = lookup(main, target, "id", ["n", "s"], order=[F.col("s").asc()])
    assert {tuple(r) for r in by_text.select("id", "n", "s").collect()} == {("1", 5, "b"), ("2", None, "a"), ("3", None, None)}
    assert plan_of(got).count("FileScan") + plan_of(got).count("LocalTableScan") + plan_of(got).count("ExistingRDD") == 2
    with pytest.raises(ValueError):
        lookup(main, target, "id", ["n", "s"], name=["a"])


def test_keys_of_another_type_are_the_same_value(spark):
    main = spark.createDataFrame([(1,), (2,)], "id int")
    target = spark.createDataFrame([(1.5, "half"), (2.0, "two"), (1e300, "far")], "id double, v string")
    assert sorted((r.id, r.v) for r in lookup(main, target, "id", "v").collect()) == [(1, None), (2, "two")]


def test_copied_rows_are_never_broadcast(spark):
    main = spark.range(1000).selectExpr("id % 3 AS k", "id AS v")
    target = spark.range(3).selectExpr("id AS k", "id * 10 AS w")
    assert "BroadcastHashJoin" in plan_of(lookup(main, target, "k", "w", hot_keys=[1]))
    spread = lookup(main, target, "k", "w", hot_keys=[1], may_broadcast=False)
    assert "SortMergeJoin" in plan_of(spread) and "Broadcast" not in plan_of(spread)
    assert all(r.w == r.k * 10 for r in spread.collect())


@pytest.mark.parametrize("dtype", ["decimal(10,2)", "float", "boolean", "timestamp", "date", "string", "smallint"])
def test_hot_keys_of_all_types(spark, dtype):
    value = {"timestamp": "timestamp_seconds(1)", "date": "date'2024-01-01'", "string": "'x'"}.get(dtype, f"cast(1 as {dtype})")
    other = {"timestamp": "timestamp_seconds(id)", "date": "date_add(date'2024-01-01', cast(id as int))", "string": "cast(id as string)"}.get(dtype, f"cast(id % 100 as {dtype})")
    main = spark.range(500).selectExpr(f"if(id < 250, {value}, {other}) AS k", "id AS v")
    hot = find_hot_keys(main, "k", 0.3)
    assert hot == [main.filter("v = 0").first().k]
    target = main.select("k").distinct().selectExpr("k", "1 AS w")
    assert lookup(main, target, "k", "w", may_broadcast=False).filter("w = 1").count() == 500
