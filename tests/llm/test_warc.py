import base64
import gzip
import hashlib
import os

import duckdb
import pytest

from sieveframe.llm import warc

COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i * 7 - 50, f"http://a/{i}", f"<p>page {i % 40 if i % 3 else i}</p>" * (1 + i % 5) + "é") for i in range(300)]
    rows += [(9001, None, None), (9002, "x y\nz", ""), (2**62, "u", "far"), (-2**62, "u", "far"), (9003, "u", "z" * 400_000)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS id", "2 AS bytes", "3 AS shard", "'x' AS sha1", "4 AS first_id")


def files_of(archive):
    return {name: open(f"{archive.folder}/{name}", "rb").read() for name in sorted(os.listdir(archive.folder)) if name.endswith(".gz")}


def test_round_trip_equals_sql(spark, pages):
    archive = warc.write(pages, shard_bytes=20_000, file_bytes=2_000)
    got = warc.read(spark, archive)
    con = duckdb.connect()
    con.register("pages", pages.select("page_id", "html").toPandas())
    want = con.sql(f"SELECT {', '.join(COLUMNS)} FROM ({warc.oracle_sql()}) ORDER BY page_id").fetchall()
    assert [tuple(r) for r in got.select(COLUMNS).orderBy("page_id").collect()] == want
    texts = {r.page_id: (r.html or "").encode() for r in pages.collect()}
    for row in got.filter("record_type = 'response'").collect():
        assert bytes(row.payload) == texts[row.page_id]
        assert row.payload_digest == base64.b32encode(hashlib.sha1(texts[row.page_id]).digest()).decode()
    files = files_of(archive)
    assert len(files) > 3 and len({name[:13] for name in files}) > 1
    # ids ascend through the files
    order = [r.page_id for name in files for r in got.filter(f"file = '{name}'").select("page_id").collect()]
    assert order == sorted(order)


def test_same_table_gives_same_files(spark, pages):
    one = warc.write(pages, shard_bytes=20_000, file_bytes=2_000)
    two = warc.write(pages.repartition(9, "url"), shard_bytes=20_000, file_bytes=2_000)
    assert files_of(one) == files_of(two)


def test_records_are_single_members(spark, pages):
    archive = warc.write(pages.filter("page_id between 0 and 100"))
    (raw,) = files_of(archive).values()
    assert gzip.decompress(raw).count(b"WARC/1.1\r\n") == raw.count(b"\x1f\x8b\x08\x00\x00\x00\x00\x00")


def test_leftovers_are_not_read(spark, pages):
    archive = warc.write(pages.filter("page_id < 100"))
    open(f"{archive.folder}/part-99999999-000000.warc.gz", "wb").write(b"left by a lost attempt")
    assert warc.read(spark, archive).count() == pages.filter("page_id < 100").count()


def test_small_payloads_stay_responses(spark, pages):
    archive = warc.write(pages, least_bytes=1_000_000)
    assert warc.read(spark, archive, with_payload=False).filter("record_type = 'revisit'").count() == 0


def test_odd_rows(spark, pages):
    rows = [(None, None, None), (None, "u", "same"), (5, "u", "same"), (5, "u", "same"), (7, "v", "same")]
    archive = warc.write(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = sorted((r.page_id is None, r.page_id or 0, r.record_type, r.refers_to) for r in warc.read(spark, archive).collect())
    assert got == [
        (False, 5, "response", None), (False, 5, "revisit", 5), (False, 7, "revisit", 5), (True, 0, "response", None), (True, 0, "revisit", 5),
    ]
    assert warc.read(spark, warc.write(pages.limit(0))).count() == 0


def test_a_changed_byte_fails(spark, pages):
    archive = warc.write(pages.filter("page_id between 0 and 30"))
    (name,) = files_of(archive)
    raw = gzip.decompress(open(f"{archive.folder}/{name}", "rb").read())
    open(f"{archive.folder}/{name}", "wb").write(gzip.compress(raw.replace(b"<p>page", b"<p>PAGE", 1)))
    with pytest.raises(Exception, match="digest|length"):
        warc.read(spark, archive).count()
