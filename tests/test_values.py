import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveframe.functions.values import (
    ValueTextError, end_column, list_column, mask_column, mask_number_column, parse_list,
    parse_mask, parse_mask_number, parse_range, range_parts_column, trim_column, typed_column,
    typed_literal,
)

LISTS = {
    "1": ["1"], "200": ["200"], "10.34": ["10.34"], "eng": ["eng"], "abc-_123": ["abc-_123"],
    "1,2,3": ["1,2,3"], "(1,2,3)": ["1", "2", "3"], " (1, 2, 3)": ["1", "2", "3"],
    " ( 1 , 2 , 3 ) ": ["1", "2", "3"], "(a,,b)": ["a", "b"],
}
BAD_LISTS = ["(1,2", "()", "( , )", "", "   "]
RANGES = {
    "[10 TO 20]": ("10", "20", True, True), "(10 TO 20]": ("10", "20", False, True),
    "(10 TO 20)": ("10", "20", False, False), " [ 10 TO 20 ] ": ("10", "20", True, True),
    "[* TO 5]": (None, "5", True, True), "[ TO 5]": (None, "5", True, True),
    "[5 TO *)": ("5", None, True, False), "[* TO *]": (None, None, True, True),
}
BAD_RANGES = ["[10 TO20]", "[1 TO ]", "[1 TO 2 TO 3]", "10 TO 20", "[10 to 20]", "[1,2]", "{1 TO 2}", "[1 TO 2", ""]
NUMBERS = {"16": 16, "0123": 123, "0x00100": 256, "0X0": 0, "0xf": 15, "0b100": 4, "0B10": 2, "-7": -7,
           "+3": 3, "0x-5": -5, "9223372036854775807": 2**63 - 1, "0x7fffffffffffffff": 2**63 - 1}
BAD_NUMBERS = ["0b2", "0xg", "0a123", "9223372036854775808", "0xffffffffffffffff", "1.5", "0x", "0b"]


@pytest.mark.parametrize("text,expected", LISTS.items())
def test_list(text, expected):
    assert parse_list(text) == expected


def test_list_separator_is_literal():
    assert parse_list("(1#2#3,4)", "#") == ["1", "2", "3,4"]
    assert parse_list("(a.b.c)", ".") == ["a", "b", "c"]


@pytest.mark.parametrize("text", [*BAD_LISTS, None])
def test_bad_list(text):
    with pytest.raises(ValueTextError):
        parse_list(text)


@pytest.mark.parametrize("text,expected", RANGES.items())
def test_range(text, expected):
    r = parse_range(text)
    assert (r.lower, r.upper, r.include_lower, r.include_upper) == expected


@pytest.mark.parametrize("text", [*BAD_RANGES, None])
def test_bad_range(text):
    with pytest.raises(ValueTextError):
        parse_range(text)


@pytest.mark.parametrize("text,expected", NUMBERS.items())
def test_number(text, expected):
    assert parse_mask_number(text) == expected


@pytest.mark.parametrize("text", BAD_NUMBERS)
def test_bad_number(text):
    with pytest.raises(ValueTextError):
        parse_mask_number(text)


def test_mask_is_or_of_all_numbers():
    assert parse_mask("(0b01100, 0x1)") == 13
    assert parse_mask("3") == 3 and parse_mask(8) == 8 and parse_mask([1, "0x4"]) == 5


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "s string").withColumn("t", trim_column(F.col("s")))


def test_columns_read_like_the_plain_forms(spark):
    t = F.col("t")
    got = texts(spark, [*LISTS, *BAD_LISTS]).select("s", list_column(t).alias("l")).collect()
    for row in got:
        assert (row.l or []) == LISTS.get(row.s, []) or row.s in ("", "   ")
    df = texts(spark, [*RANGES, *BAD_RANGES]).withColumn("p", range_parts_column(t))
    p = F.col("p")
    for row in df.select("s", "p", end_column(p, 0).alias("lo"), end_column(p, 1).alias("hi")).collect():
        if row.s in RANGES:
            assert (row.lo, row.hi) == RANGES[row.s][:2]
        else:
            assert row.p is None
    for row in texts(spark, [*NUMBERS, *BAD_NUMBERS]).select("s", mask_number_column(t).alias("n")).collect():
        assert row.n == NUMBERS.get(row.s), row.s
    masks = {"(1, 2, 0x10)": 19, "(1, zz)": None, "()": None, "7": 7}
    for row in texts(spark, masks).select("s", mask_column(list_column(t)).alias("m")).collect():
        assert row.m == masks[row.s]


GOOD = [
    (T.ByteType(), "-128", -128), (T.ShortType(), "+5", 5), (T.IntegerType(), "2147483647", 2147483647),
    (T.LongType(), "12", 12), (T.DoubleType(), "1e3", 1000.0), (T.DoubleType(), ".5d", 0.5),
    (T.BooleanType(), "TRUE", True), (T.BooleanType(), "yes", False), (T.StringType(), "a b", "a b"),
]
BAD = [(T.ByteType(), "128"), (T.IntegerType(), "1.0"), (T.LongType(), "x"), (T.DoubleType(), "1,5"),
       (T.TimestampType(), "2020-01-01"), (T.TimestampNTZType(), "2020-13-01T00:00:00Z")]


def test_typed_literals(spark):
    one = spark.range(1)
    for dtype, text, value in GOOD:
        row = one.select(typed_literal(text, dtype).alias("a"), typed_column(F.lit(text), dtype).alias("b"))
        assert row.schema["a"].dataType == dtype
        assert tuple(row.first()) == (value, value)
    assert one.select(typed_literal("abc", "char")).first()[0] == "a"


@pytest.mark.parametrize("dtype,text", BAD)
def test_bad_literals_fail_when_built(spark, dtype, text):
    with pytest.raises(ValueError):
        typed_literal(text, dtype)
    assert spark.range(1).select(typed_column(F.lit(text), dtype)).first()[0] is None
