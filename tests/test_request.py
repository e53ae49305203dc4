import random

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from sieveframe import asc, desc, in_filter, num_found, rand_int, select, sort_columns
from sieveframe.plans import request


@pytest.fixture(scope="module")
def items(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "b"]), rng.choice([None, True, False])) for i in range(200)]
    return spark.createDataFrame(rows, "id int, n int, s string, b boolean")


def values(df, column="id"):
    return [r[column] for r in df.collect()]


def test_default_page(items):
    assert values(select(items, key="id")) == list(range(10))
    assert values(select(items, key="id", start=5, rows=3)) == [5, 6, 7]
    assert values(select(items, key="id", start=198)) == [198, 199]
    assert select(items, key="id", rows=0).count() == 0
    assert select(items, rows=None).count() == 200


def test_page_needs_a_key(items):
    with pytest.raises(ValueError):
        select(items, order=["n"])
    for page in ({"start": -1}, {"rows": -1}):
        with pytest.raises(ValueError):
            select(items, key="id", **page)


@pytest.mark.parametrize("column,direction,missing_first", [
    ("n", "asc", True), ("n", "desc", False), ("s", "asc", False), ("s", "desc", False), ("b", "asc", False), ("b", "desc", False),
])
def test_missing_values_in_sorts(items, column, direction, missing_first):
    rows = select(items, order=[f"{column} {direction}"], rows=200, key="id").collect()
    missing = [r for r in rows if r[column] is None]
    present = [r for r in rows if r[column] is not None]
    assert rows == (missing + present if missing_first else present + missing)
    assert missing == sorted(missing, key=lambda r: r.id)
    assert [r[column] for r in present] == sorted((r[column] for r in present), reverse=direction == "desc")


def test_fields(items):
    assert select(items, fields=["*", "score"], rows=None).columns == ["id", "n", "s", "b", "score"]
    df = select(items, fields=["id", ("twice", F.col("n") * 2), ("hit", in_filter("s", "a"))], rows=None)
    assert df.columns == ["id", "twice", "hit"] and df.filter("hit is null").count() == 0


def test_sort_values_are_those_sorted_by(items):
    got = select(items, fields=["id"], order=[desc(rand_int(1000)), asc("n")], key="id", rows=50, return_sort_values=True)
    drawn = [r.sort_1 for r in got.collect()]
    assert drawn == sorted(drawn, reverse=True)


def test_pages_join_up(items):
    whole = values(select(items, order=["n desc", "s"], rows=200, key="id"))
    pages = [v for start in range(0, 200, 30) for v in values(select(items, order=["n desc", "s"], start=start, rows=30, key="id"))]
    assert pages == whole


def test_deep_pages(spark, items, monkeypatch):
    expected = values(select(items, order=["n desc"], rows=200, key="id"))
    monkeypatch.setattr(request, "TOP_K_LIMIT", 20)
    assert values(select(items, order=["n desc"], start=150, rows=17, key="id")) == expected[150:167]
    assert values(select(items, order=["n desc"], start=190, rows=None, key="id")) == expected[190:]
    assert values(select(items, order=["n desc"], start=0, rows=200, key="id")) == expected
    narrow = select(items, fields=["s", ("m", F.col("n") + 1)], order=["n desc"], start=150, rows=17, key="id", return_sort_values=True)
    assert narrow.columns == ["s", "m", "sort_1"]
    assert [r.m for r in narrow.collect()] == [None if r.sort_1 is None else r.sort_1 + 1 for r in narrow.collect()]


def test_deep_pages_by_counting(spark, items, monkeypatch, tmp_path):
    """Nothing is stored or moved to find the page; what is read is cut by the leading sort column."""
    path = str(tmp_path / "rows")
    spark.range(5000).selectExpr("id", "id % 700 AS n", "if(id % 9 = 0, null, concat('s', id % 40)) AS s", "cast(id % 11 / 3 as float) AS f",
                                 "timestamp_micros(id % 50 * 1000001) AS t").write.parquet(path)
    rows = spark.read.parquet(path)
    monkeypatch.setattr(request, "TOP_K_LIMIT", 60)
    for order, pages in ((["s", "n"], ((3000, 25), (0, 100))), (["t desc", "f"], ((4990, 30), (4700, None))), ([], ((5000, 5),))):
        expected = [r.id for r in rows.orderBy(*sort_columns(rows, order), "id").select("id").collect()]
        for start, count in pages:
            got = [r.id for r in select(rows, fields=["id"], order=order, start=start, rows=count, key="id").collect()]
            assert got == expected[start:None if count is None else start + count]
    page = select(rows, fields=["id"], order=["n desc"], start=3000, rows=25, key="id")
    assert page.inputFiles() and all(path in f for f in page.inputFiles())
    plan = plan_of(page)
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan and "GreaterThanOrEqual(n," in plan and "LessThanOrEqual(n," in plan
    monkeypatch.setattr(request, "TOP_K_LIMIT", 10)
    same = select(rows.selectExpr("1 AS one", "id"), fields=["one"], start=100, rows=7, key="one")  # no key tells these apart
    assert same.count() == 7
    drawn = select(rows, fields=["id"], order=[desc(rand_int(1000))], key="id", start=2000, rows=50, return_sort_values=True).collect()
    assert [r.sort_1 for r in drawn] == sorted((r.sort_1 for r in drawn), reverse=True) and len(drawn) == 50


def test_plan_of_a_page(spark, tmp_path):
    path = str(tmp_path / "wide")
    spark.range(100).select("id", *[(F.col("id") * i).alias(f"c{i}") for i in range(5)]).write.parquet(path)
    plan = plan_of(select(spark.read.parquet(path), where=in_filter("c1", "(1, 2)"), fields=["id"], order=["c2 desc"], key="id"))
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan
    assert "ReadSchema: struct<id:bigint,c1:bigint,c2:bigint>" in plan


def test_num_found(items):
    assert num_found(items, where=in_filter("s", "a"), filters=[F.col("n") > 1]).first().num_found == items.filter("s = 'a' and n > 1").count()
    assert len(sort_columns(items, ["n", asc("s"), F.col("b")])) == 3
