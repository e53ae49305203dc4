from collections import Counter
from datetime import datetime

import pytest
from conftest import ids, plan_of
from pyspark.sql import functions as F

from sieveframe import (
    apply_filters, bit_all_filter, bit_any_filter, build_filter, filter_in, in_filter, log10,
    num_found, range_filter, rand_int, register_filter, select, with_constant_score,
)
from sieveframe.functions.values import ValueTextError

NAN = float("nan")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(
        [(1, 0), (2, 2), (3, 3), (4, 4)], "id int, my_int int"
    ).withColumn("my_long", F.lit(None).cast("bigint"))


@pytest.fixture(scope="module")
def docs5(docs, spark):
    return docs.unionByName(spark.createDataFrame([(5, None, None)], docs.schema))


def test_match_all(docs):
    assert ids(docs) == [1, 2, 3, 4]
    assert num_found(docs).first().num_found == 4
    assert {r.score for r in with_constant_score(docs).collect()} == {1.0}


FILTERS = [
    (None, in_filter("my_int", "(2, 3)"), [2, 3]),
    (in_filter("my_int", "4"), None, [4]),
    (lambda df: df.id.between(1, 3), in_filter("my_int", "(3,4)"), [3]),
    (in_filter("my_int", "(0,4)", not_=True), None, [2, 3]),
    (lambda df: df.id.between(1, 3), in_filter("my_long", "(3,4)"), []),
    (None, range_filter("my_int", "[2 TO 3]"), [2, 3]),
    (range_filter("my_int", "(3 TO 4]"), None, [4]),
    (lambda df: df.id == 3, range_filter("my_int", "[3 TO 4]"), [3]),
    (range_filter("my_int", "[2 TO 3]", not_=True), None, [1, 4]),
    (lambda df: df.id == 3, range_filter("my_long", "[3 TO 4]"), []),
    (None, bit_any_filter("my_int", "(0b10)"), [2, 3]),
    (None, bit_any_filter("my_int", "(0x1)"), [3]),
    (None, bit_any_filter("my_int", "(3)"), [2, 3]),
    (None, bit_all_filter("my_int", "(0b10)"), [2, 3]),
    (None, bit_all_filter("my_int", "(0x1)"), [3]),
    (None, bit_all_filter("my_int", "(3)"), [3]),
]


@pytest.mark.parametrize("where,extra,expected", FILTERS)
def test_filters(docs, where, extra, expected):
    assert ids(select(docs, where=where, filters=[extra] if extra else [], rows=None)) == expected


def test_filter_as_main_query_scores_one(docs):
    hit = select(docs, where=in_filter("my_int", "4"), fields=["id", "score"], key="id").collect()
    assert [tuple(r) for r in hit] == [(4, 1.0)]


MISSING = [
    (~in_filter("my_int", "(0,4)"), [2, 3, 5]),
    (~range_filter("my_int", "[2 TO 3]"), [1, 4, 5]),
    (bit_any_filter("my_int", "0"), []),
    (bit_all_filter("my_int", "0"), [1, 2, 3, 4, 5]),
    (~bit_any_filter("my_int", "(3)"), [1, 4, 5]),
    (~bit_all_filter("my_int", "0"), []),
    (range_filter("my_int", "[* TO *]"), [1, 2, 3, 4]),
    (~range_filter("my_int", "[* TO *]"), [5]),
    (range_filter("my_int", "[* TO 2]"), [1, 2]),
    (range_filter("my_int", "[3 TO *]"), [3, 4]),
    (range_filter("my_int", lower="2", upper="4", incl=False, incu=False), [3]),
    (range_filter("my_int"), [1, 2, 3, 4]),
]


@pytest.mark.parametrize("predicate,expected", MISSING)
def test_missing_values(docs5, predicate, expected):
    assert ids(apply_filters(docs5, predicate)) == expected
    flagged = docs5.select("id", predicate.flag(docs5).alias("f"))
    assert flagged.filter("f is null").count() == 0
    assert ids(flagged.filter("f")) == expected


def test_complement_splits_any_table_in_two(spark):
    df = spark.range(0, 2000).select(
        F.col("id"),
        F.when(F.col("id") % 7 != 0, (F.col("id") * 37 % 101).cast("int")).alias("i"),
        F.when(F.col("id") % 5 != 0, F.when(F.col("id") % 11 == 0, F.lit(NAN)).otherwise(F.col("id") / 3)).alias("d"),
        F.when(F.col("id") % 3 != 0, F.concat(F.lit("v"), F.col("id") % 13)).alias("s"),
        F.when(F.col("id") % 4 != 0, F.col("id") % 2 == 0).alias("b"),
    )
    predicates = [
        in_filter("i", "(1, 5, 99)"), range_filter("i", "[10 TO 50)"), bit_any_filter("i", "(0b101)"),
        bit_all_filter("i", "(3)"), in_filter("d", "(1.0, NaN)"), range_filter("d", "(5 TO *]"),
        range_filter("d", "[5 TO 100]"), bit_any_filter("d", "6"), in_filter("s", "(v1, v12)"),
        range_filter("s", "[v1 TO v5]"), in_filter("b", "true"), bit_any_filter("b", "1"),
        build_filter("odd_even", "i") if register_filter("odd_even", lambda c, t, v: c % 2 == 0) is None else None,
    ]
    for predicate in predicates:
        yes, no = ids(apply_filters(df, predicate)), ids(apply_filters(df, ~predicate))
        assert sorted(yes + no) == list(range(2000)), predicate
        assert ids(apply_filters(df, ~~predicate)) == yes
    everything = set(ids(apply_filters(df, bit_any_filter("i", "5"))))
    assert set(ids(apply_filters(df, bit_all_filter("i", "5")))) <= everything


def test_float_literals_and_nan(spark):
    df = spark.createDataFrame([(1, 10.34), (2, NAN), (3, -0.0), (4, None)], "id int, f float")
    assert ids(apply_filters(df, in_filter("f", "10.34"))) == [1]
    assert ids(apply_filters(df, in_filter("f", "0"))) == [3]
    assert ids(apply_filters(df, range_filter("f", "[5 TO *]"))) == [1]
    assert ids(apply_filters(df, ~range_filter("f", "[5 TO *]"))) == [2, 3, 4]
    assert ids(apply_filters(df, ~range_filter("f", "[* TO 5]"))) == [1, 2, 4]
    assert ids(apply_filters(df, range_filter("f", "[* TO *]"))) == [1, 2, 3]
    assert ids(apply_filters(df, range_filter("f", "[0 TO NaN]"))) == []
    assert ids(apply_filters(df, ~range_filter("f", "[NaN TO *]"))) == [1, 2, 3, 4]


def test_bits_of_fractions_and_extremes(spark):
    df = spark.createDataFrame(
        [(1, 2.7), (2, -1.5), (3, 1e300), (4, -1e300), (5, NAN), (6, None)], "id int, d double"
    )
    assert ids(apply_filters(df, bit_any_filter("d", "2"))) == [1, 2, 3]
    assert ids(apply_filters(df, bit_all_filter("d", "0x7fffffffffffffff"))) == [2, 3]


def test_dates(spark):
    rows = [(1, datetime(2020, 1, 1)), (2, datetime(2020, 1, 31, 12)), (3, None)]
    for kind in ("timestamp", "timestamp_ntz"):
        df = spark.createDataFrame(rows, f"id int, t {kind}")
        assert ids(apply_filters(df, in_filter("t", "(2020-01-01T00:00:00Z, 2019-02-01T00:00:00Z+1YEAR/YEAR)"))) == [1]
        assert ids(apply_filters(df, range_filter("t", "[2020-01-01T00:00:00Z TO 2020-02-01T00:00:00Z-1DAY/DAY)"))) == [1]
        assert ids(apply_filters(df, ~range_filter("t", "[* TO NOW]"))) == [3]
        assert ids(apply_filters(df, bit_all_filter("t", "0"))) == [1, 2, 3]
        millis = int(datetime(2020, 1, 1).timestamp() * 1000)
        assert 1 in ids(apply_filters(df, bit_all_filter("t", millis)))


def test_expressions(docs):
    assert ids(apply_filters(docs, range_filter(log10("my_int"), "[0.3 TO 0.5]"))) == [2, 3]
    assert ids(apply_filters(docs, in_filter(F.col("my_int") * 2, "(4, 8)"))) == [2, 4]
    assert ids(apply_filters(docs, range_filter(rand_int(20), "[0 TO 20)"))) == [1, 2, 3, 4]


def test_bad_input_fails_when_built(spark, docs):
    empty = docs.limit(0)
    with pytest.raises(ValueTextError):
        in_filter("my_int", "(a)")(empty)
    for text in (None, "", "  "):
        for make in (in_filter, bit_any_filter, bit_all_filter):
            with pytest.raises(ValueTextError):
                make("my_int", text)
    with pytest.raises(ValueTextError):
        range_filter("my_int", " ")
    with pytest.raises(ValueTextError):
        bit_any_filter("my_int", "(0b2)")
    arrays = spark.createDataFrame([(1, [1])], "id int, a array<int>")
    for predicate in (in_filter("a", "1"), range_filter("a", "[1 TO 2]"), bit_any_filter("a", "1"), bit_all_filter("a", "1")):
        with pytest.raises(TypeError):
            predicate(arrays)
    with pytest.raises(TypeError):
        bit_any_filter("s", "1")(spark.createDataFrame([("x",)], "s string"))


def test_named_filters(docs5):
    assert ids(apply_filters(docs5, build_filter("in", "my_int", "(2,3)", not_=True))) == [1, 4, 5]
    assert ids(apply_filters(docs5, build_filter("range", "my_int", l="2", u="4", incu=False))) == [2, 3]
    assert ids(apply_filters(docs5, build_filter("cbit", "my_int", "3"))) == [3]
    register_filter("above", lambda column, dtype, value, by=0: column > value + by)
    assert ids(apply_filters(docs5, build_filter("above", "my_int", 2, by=1))) == [4]
    assert ids(apply_filters(docs5, build_filter("above", "my_int", 2, by=1, not_=True))) == [1, 2, 3, 5]
    register_filter("in", lambda column, dtype, value: F.lit(False))
    assert ids(apply_filters(docs5, build_filter("in", "my_int", "(2,3)"))) == [2, 3]
    with pytest.raises(LookupError):
        build_filter("nope", "my_int", "1")


def test_long_lists_become_joins(spark, docs5):
    long = [2, 3, *range(100, 3000)]
    assert ids(filter_in(docs5, "my_int", long)) == [2, 3]
    assert ids(filter_in(docs5, "my_int", [str(v) for v in long], not_=True)) == [1, 4, 5]
    assert ids(filter_in(docs5, "my_int", "(2, 3)")) == [2, 3]
    listed = spark.createDataFrame([(2,), (3,), (3,), (None,)], "v bigint")
    assert ids(filter_in(docs5, "my_int", listed)) == [2, 3]
    assert ids(filter_in(docs5, "my_int", listed, not_=True)) == [1, 4, 5]
    assert filter_in(docs5, "my_int", listed).columns == docs5.columns


def test_predicates_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).select("id", (F.col("id") / 2).alias("d"), F.lit(datetime(2020, 1, 1)).alias("t")).write.parquet(path)
    df = spark.read.parquet(path)

    def pushed(predicate):
        text = plan_of(apply_filters(df, predicate))
        return text[text.index("PushedFilters:"):].split("ReadSchema")[0]

    assert "In(id, [2,3])" in pushed(in_filter("id", "(2, 3)"))
    assert "Or(IsNull(id),Not(In(id, [2,3])))" in pushed(in_filter("id", "(2, 3)", not_=True))
    closed = pushed(range_filter("d", "[2 TO 5)"))
    assert "GreaterThanOrEqual(d,2.0)" in closed and "LessThan(d,5.0)" in closed
    assert "Or(IsNull(d)" in pushed(~range_filter("d", "[2 TO 5)"))
    assert "GreaterThanOrEqual(t,2019-" in pushed(range_filter("t", "[2020-01-01T00:00:00Z-1YEAR TO *]"))


@pytest.mark.parametrize("negated", [False, True])
@pytest.mark.parametrize("dtype,rows,items,filler", [
    ("int", [1, 2, 3, None], [1, "2", None, 2.5], -7),
    ("bigint", [1, 2**40, None], [str(2**40), 1.0], "-8"),
    ("decimal(10,2)", ["10.35", "10.34", None], ["10.345", "10.34"], 77),
    ("decimal(10,2)", ["5", "6", None], [5, "6.000"], 77),
    ("boolean", [True, False, None], ["TRUE"], "true"),
    ("boolean", [True, False, None], ["yes"], "no"),
    ("double", [0.0, 1.5, None], ["-0.0", "1.5d"], 9.75),
    ("string", ["a", "b", "1", None], ["a", 1, None], "zz"),
    ("timestamp", ["2024-01-02 00:00:00", "2024-01-03 00:00:00", None], ["2024-01-01T00:00:00Z+1DAY"], "1999-01-01T00:00:00Z"),
    ("date", ["2024-01-02", "2024-01-03", None], ["2024-01-01T00:00:00Z+1DAY"], "1999-01-01T00:00:00Z"),
])
def test_lists_mean_the_same_at_any_length(spark, dtype, rows, items, filler, negated):
    df = spark.createDataFrame([(str(r) if r is not None else None,) for r in rows], "t string").selectExpr(f"CAST(t AS {dtype}) AS v")
    got = [Counter(r.v for r in filter_in(df, "v", items + [filler] * n, not_=negated).collect()) for n in (0, 1000 - len(items), 1001)]
    assert got[0] == got[1] == got[2]
    hits = Counter(r.v for r in filter_in(df, "v", items, not_=not negated).collect())
    assert hits + got[0] == Counter(r.v for r in df.collect())


@pytest.mark.parametrize("n", [1, 2000])
def test_bad_items_fail_while_the_query_is_built(spark, n):
    df = spark.createDataFrame([(1,)], "v int")
    with pytest.raises(ValueError):
        filter_in(df, "v", ["x"] * n)


def test_list_tables_of_another_type(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "v int")
    texts = spark.createDataFrame([("1",), (" 2 ",), ("x",), (None,)], "t string")
    halves = spark.createDataFrame([(1.0,), (2.5,)], "d double")
    assert sorted(r.v for r in filter_in(df, "v", texts).collect()) == [1, 2]
    assert sorted(r.v for r in filter_in(df, "v", halves).collect()) == [1]
    assert sorted(r.v for r in filter_in(df, "v", halves, not_=True).collect()) == [2, 3]
