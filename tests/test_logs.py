from datetime import datetime, timedelta

import pytest

from sieveframe import (
    classify_requests, is_update_request, log_history, name_tree, normalize_code, parse_request_log, request_params, unknown_code,
)

T0 = datetime(2024, 1, 1)
EVENT = "id int, time timestamp_ntz, level string, logger string, message string, trace string"


def event(i, level, message, logger="testlogger"):
    return (i, T0 + timedelta(seconds=i), level, logger, message, None)


def history(spark, events, **options):
    return [r.message for r in log_history(spark.createDataFrame(events, EVENT), "time", "level", id_col="id", **options).collect()]


def test_history(spark):
    events = [event(1, "WARN", "This is a test message"), event(2, "INFO", "test info message")]
    assert history(spark, events) == ["This is a test message"]
    assert history(spark, events, threshold="info", since=T0 + timedelta(seconds=1)) == ["test info message"]
    assert history(spark, events, threshold="Warn", since=T0 + timedelta(seconds=1)) == []
    assert history(spark, events, threshold="all") == ["test info message", "This is a test message"]
    assert history(spark, events, threshold="OFF") == []
    with pytest.raises(ValueError):
        history(spark, events, threshold="loud")


def test_history_is_bounded_before_since(spark):
    events = [event(i, "ERROR" if i % 2 else "DEBUG", str(i)) for i in range(200)]
    assert history(spark, events) == [str(i) for i in range(199, 99, -2)]
    assert history(spark, events, size=10, since=T0) == [str(i) for i in range(199, 179, -2)]
    assert history(spark, events, size=3, since=T0 + timedelta(seconds=197)) == ["199"]


def test_name_tree(spark):
    df = spark.createDataFrame([(n,) for n in ["a.b.c", "a.b.c", "a.x", "a", "z", None, ""]], "n string")
    assert {tuple(r) for r in name_tree(df, "n").collect()} == {
        ("a", True), ("a.b", False), ("a.b.c", True), ("a.x", True), ("z", True), ("root", True)}
    assert name_tree(df, "n", include_root=False).count() == 5
    own_root = spark.createDataFrame([("root",), ("root.a",)], "n string")
    assert name_tree(own_root, "n").groupBy("name").count().filter("count > 1").count() == 0


PARAMS = {
    "a=1&b=2&a=3": {"a": ["1", "3"], "b": ["2"]}, "q=%E4%BD%A0+x%3D1&=v&k=&k&&": {"q": ["你 x=1"]}, "a=b=c": {"a": ["b=c"]},
    "": {}, None: {}, "bad=%zz": {"bad": [None]},
}


def test_request_params(spark):
    df = spark.createDataFrame([(t,) for t in PARAMS], "q string")
    got = {r.q: r.params for r in request_params(df, "q").collect()}
    assert got == PARAMS
    pairs = sorted((r.q, r.k, str(r.v)) for r in request_params(df, "q", as_rows=True).collect())
    assert pairs == sorted((q, k, str(v)) for q, m in PARAMS.items() for k, vs in m.items() for v in vs)
    with pytest.raises(Exception):
        request_params(df, "q", strict=True).collect()


def test_codes(spark):
    codes = [400, 401, 403, 404, 409, 415, 500, 503, 510, 408, 429]
    df = spark.createDataFrame([(c,) for c in [*codes, 1000000002, 0, None]], "c int")
    got = {r.c: (r.n, r.u) for r in df.select("c", normalize_code("c").alias("n"), unknown_code("c").alias("u")).collect()}
    assert all(got[c] == (c, None) for c in codes)
    assert got[1000000002] == (0, 1000000002) and got[0] == (0, None) and got[None] == (0, None)


def test_classification(spark):
    df = spark.createDataFrame([(1, 2000, None), (2, 2001, None), (3, 50, 40), (4, None, 10), (5, 5000, 6000)], "id int, wait int, allowed int")
    got = {r.id: r.code for r in classify_requests(df, "wait", "allowed").collect()}
    assert got == {1: 200, 2: 408, 3: 408, 4: 200, 5: 200}
    assert classify_requests(df, "wait").filter("code = 408").count() == 2
    assert classify_requests(df, "wait", 100).filter("code = 408").count() == 3


def test_request_log(spark):
    lines = [
        "12:00:00.123 [query-1] rid=7 path=/select core=docs RS=120 WT=3 ET=15 r=10.0.0.1:5000 params={q=id:1&x={y}} hits=3 status=0 QTime=12 ",
        "12:00:01.000 [query-2] rid=8 path=/select core= RS=99 WT=2500 ET= r=local tip=Timeout_In_Queue params={q=*:* hits=9}",
        "12:00:02.000 [update 3] rid=9 path=/update core=docs RS=5 WT=0 ET=1 r=local status=0 QTime=1",
        "nonsense",
    ]
    df = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "i int, line string")
    r = parse_request_log(df, "line").orderBy("i").collect()
    assert (r[0].rid, r[0].path, r[0].core, r[0].request_size, r[0].wait_time, r[0].execute_time) == (7, "/select", "docs", 120, 3, 15)
    assert (r[0].remote_address, r[0].params, r[0].hits, r[0].status, r[0].qtime) == ("10.0.0.1:5000", "q=id:1&x={y}", 3, 0, 12)
    assert (r[0].time, r[0].thread, r[0].tip) == ("12:00:00.123", "query-1", None)
    assert (r[1].tip, r[1].core, r[1].execute_time, r[1].hits, r[1].params) == ("Timeout_In_Queue", None, None, None, "q=*:* hits=9")
    assert (r[2].thread, r[2].params, r[2].status, r[2].qtime) == ("update 3", None, 0, 1)
    assert all(v is None for v in r[3][2:])


def test_update_paths(spark):
    paths = {"/update": True, "/update/json": True, "/updates": False, "/select": False, "": False, None: False}
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert {r.p: r.u for r in df.select("p", is_update_request("p").alias("u")).collect()} == paths
