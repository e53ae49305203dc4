from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from sieveframe import (
    as_type, call_function, date_math, exists, field, geodist, hash_rand_int, instant_column, log10,
    mul, rand_int, register_function, select,
)

DATES = {
    "1995-12-31T23:59:59Z": datetime(1995, 12, 31, 23, 59, 59),
    "1995-12-31T23:59:59.999Z": datetime(1995, 12, 31, 23, 59, 59, 999000),
    "1995-12-31T23:59:59Z/YEAR": datetime(1995, 1, 1),
    "1995-12-31T23:59:59Z/MONTHS": datetime(1995, 12, 1),
    "1995-12-31T23:59:59Z/DATE": datetime(1995, 12, 31),
    "1995-12-31T23:59:59Z/HOUR": datetime(1995, 12, 31, 23),
    "1995-12-31T23:59:59Z/MINUTE": datetime(1995, 12, 31, 23, 59),
    "1995-12-31T23:59:59.987654Z/SECOND": datetime(1995, 12, 31, 23, 59, 59),
    "1995-12-31T23:59:59.987654Z/MILLISECOND": datetime(1995, 12, 31, 23, 59, 59, 987000),
    "2000-01-31T10:00:00Z+1MONTH": datetime(2000, 2, 29, 10),
    "2000-02-29T10:00:00Z+1YEAR": datetime(2001, 2, 28, 10),
    "2000-01-31T10:00:00Z-1DAY+6MONTHS+3DAYS/DAY": datetime(2000, 8, 2),
    "1960-03-01T00:00:00Z-1SECOND": datetime(1960, 2, 29, 23, 59, 59),
    "1960-03-01T05:06:07.5Z/MONTH": datetime(1960, 3, 1),
    "1969-12-31T23:59:59.25Z/HOUR-90MINUTES": datetime(1969, 12, 31, 21, 30),
    "2300-05-05T05:05:05Z/YEAR+1MONTH": datetime(2300, 2, 1),
    "2020-06-01T00:00:00Z+25MILLIS": datetime(2020, 6, 1, 0, 0, 0, 25000),
    "NOW/DAY+1DAY": datetime(2021, 3, 5),
}
NOW = datetime(2021, 3, 4, 5, 6, 7, tzinfo=timezone.utc)
BAD_DATES = ["", "yesterday", "2020-01-01", "2020-01-01T00:00:00", "2020-02-30T00:00:00Z", "NOW+1", "NOW/WEEK", "NOW DAY", "now"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_dates(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = spark.createDataFrame([(t,) for t in [*DATES, *BAD_DATES]], "s string").repartition(2)
        for row in texts.select(
            "s", instant_column(F.col("s"), NOW, ntz=True).alias("n"),
            F.unix_micros(instant_column(F.col("s"), NOW)).alias("u"),
        ).collect():
            expected = DATES.get(row.s)
            assert row.n == expected, row.s
            if expected is None:
                assert row.u is None
            else:
                whole = int(expected.replace(tzinfo=timezone.utc, microsecond=0).timestamp())
                assert row.u == whole * 1_000_000 + expected.microsecond, row.s
        literals = [date_math(t, NOW, ntz=True).alias(f"c{i}") for i, t in enumerate(DATES)]
        assert list(spark.range(1).select(*literals).first()) == list(DATES.values())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("text", BAD_DATES)
def test_bad_dates(text):
    with pytest.raises(ValueError):
        date_math(text)


def test_now_is_the_query_start(spark):
    row = spark.range(1).select((F.current_timestamp() - date_math("NOW")).cast("string")).first()
    assert "0 00:00:00" in row[0]


def test_rand_range_and_types(spark):
    df = spark.range(5000)
    drawn = select(df, fields=["*", ("rand", rand_int(20))], rows=None)
    assert drawn.schema["rand"].dataType.simpleString() == "int"
    low, high, kinds = drawn.agg(F.min("rand"), F.max("rand"), F.count_distinct("rand")).first()
    assert low == 0 and high == 19 and kinds == 20
    widest = df.select(rand_int().alias("r")).agg(F.min("r"), F.max("r")).first()
    assert 0 <= widest[0] and widest[1] < 2**31 - 1


def test_rand_seed(spark):
    df = spark.range(100)

    def draw(seed):
        return [r[0] for r in df.select(rand_int(1000, seed)).collect()]

    assert draw(5) == draw(5) != draw(6)
    orders = {tuple(r.id for r in select(spark.range(4), order=[rand_int()], rows=None).collect()) for _ in range(8)}
    assert len(orders) > 1


def test_hash_rand_does_not_depend_on_partitioning(spark):
    df = spark.range(1000).select("id", hash_rand_int(["id"], 7, 3).alias("r"))
    again = spark.range(1000).repartition(13).select("id", hash_rand_int(["id"], 7, 3).alias("r"))
    assert sorted(df.collect()) == sorted(again.collect())
    assert {r.r for r in df.collect()} == set(range(7))


@pytest.mark.parametrize("args", [(0,), (-1,), (2**31,)])
def test_rand_bad_range(args):
    with pytest.raises(ValueError):
        rand_int(*args)


@pytest.mark.parametrize("args", [("5",), (5, "1"), (True,), (5, 1.5)])
def test_rand_bad_types(args):
    with pytest.raises(TypeError):
        rand_int(*args)


def test_numbers(spark):
    row = spark.createDataFrame([(100, 3)], "a int, b int").select(
        log10("a").alias("l"), mul("a", "b").alias("m"), mul("a", 2).alias("m2"), field("b").alias("f"),
        exists("a").alias("e"), geodist(F.lit(0), F.lit(0), F.lit(0), F.lit(180)).alias("half"),
        geodist(F.lit(52.52), F.lit(13.405), F.lit(48.8566), F.lit(2.3522)).alias("km"),
        geodist(F.lit(10), F.lit(20), F.lit(10), F.lit(20)).alias("zero"),
    )
    assert row.schema["m"].dataType.simpleString() == "double"
    r = row.first()
    assert (round(r.l, 12), r.m, r.m2, r.f, r.e, r.zero) == (2.0, 300.0, 200.0, 3, True, 0.0)
    assert abs(r.half - 20015.1) < 0.1 and abs(r.km - 877.5) < 1.0


def test_typed_access(spark):
    df = spark.createDataFrame([(1, 300, 2.9, True), (2, -129, -1e12, False), (3, None, None, None)],
                               "id int, i int, d double, b boolean")
    kinds = ["byte", "short", "int", "long", "float", "double", "bool", "exists"]
    got = {r.id: r for r in select(df, fields=["id"] + [
        (f"{c}_{k}", as_type(c, k)) for c in ("i", "d") for k in kinds] + [("b_long", as_type("b", "long")), ("obj", as_type("i", "object"))], rows=None).collect()}
    assert (got[1].i_byte, got[2].i_byte, got[3].i_byte) == (44, 127, 0)
    assert (got[1].i_short, got[1].i_int, got[3].i_long) == (300, 300, 0)
    assert (got[1].d_int, got[2].d_int, got[2].d_long, got[2].d_byte) == (2, -(2**31), -(10**12), 0)
    assert (got[1].i_bool, got[3].i_bool, got[3].i_exists, got[1].d_exists) == (True, False, False, True)
    assert (got[3].d_double, got[3].d_float, got[1].b_long, got[3].obj) == (0.0, 0.0, 1, None)
    with pytest.raises(ValueError):
        as_type("i", "decimal")


def test_named_functions(spark):
    register_function("twice", lambda c: F.col(c) * 2)
    assert spark.range(3).select(call_function("twice", "id")).collect()[2][0] == 4
    assert spark.range(1).select(call_function("rand", 1)).first()[0] == 0
    with pytest.raises(LookupError):
        call_function("nope")
