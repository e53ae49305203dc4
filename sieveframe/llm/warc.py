"""Deterministic, sharded WARC archives.

Records are sorted by id within shards that are ranges of ids. The ranges depend
on the ids and sizes alone: a histogram of bytes over the id range, refined where
a bin is heavier than a shard, is cut at every ``shard_bytes``. A task writes the
shards it gets and rolls to a new file when the compressed file reaches
``file_bytes``. Headers are made anew from the row: record ids are derived from
id and digest, dates are the one given, payload and block digests are computed.
Every record is a gzip member of its own. The same table gives the same files.

Of records with equal payloads of ``least_bytes`` bytes or more, that with the
smallest id is a response; the others are revisits that refer to it and carry no
payload. The smallest ids come from one sum per digest, so a payload that many
rows share is one row there.

Commit: a task writes under a temporary name of its attempt and reports the files
it finished; these reports are stored. Then the files they name get their final
names, and a manifest of files is written last. A reader only opens files of the
manifest, so files of lost or repeated attempts are never read; renaming a file
that has its name already does nothing.

Rows: NULL payload counts as empty, NULL url becomes ``urn:record:<id>``. Rows that
repeat an id are written one by one, ordered by digest and url; of those with equal
payloads one is the response. A NULL id sorts first and has no id header. An empty
table gives an archive without files.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import posixpath
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import materialize, shared_dir

SHARD_BYTES = 1 << 26
FILE_BYTES = 1 << 24
DATE = "1970-01-01T00:00:00Z"
#: Bins of one round of the histogram.
BINS = 1024
ID_HEADER = "X-Record-Number"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REPORT = "shard long, sequence long, temporary string, name string, records long, bytes long"


@dataclass(frozen=True)
class Archive:
    """A committed archive: its folder and the manifest in it."""

    folder: str
    manifest: str


# --- planning ---------------------------------------------------------------------


def shard_starts(sizes: DataFrame, shard_bytes: int) -> list[int]:
    """First ids of the shards after the first. ``sizes`` has ``id`` and ``bytes``."""
    ends = sizes.agg(F.min("id").alias("low"), F.max("id").alias("high")).first()
    if ends["low"] is None:
        return []
    weights = _histogram(sizes, int(ends["low"]), int(ends["high"]), shard_bytes)
    starts, filled = [], 0
    for first, weight in weights:
        if filled and filled + weight > shard_bytes:
            starts.append(first)
            filled = 0
        filled += weight
    return starts


def _histogram(sizes: DataFrame, low: int, high: int, most: int) -> list[tuple[int, int]]:
    """(first id, bytes) of bins in order; a bin over ``most`` holds one id."""
    width = max(-(-(high - low + 1) // BINS), 1)
    # decimals, since the distance of two longs may not be a long
    place = F.floor((F.col("id").cast("decimal(20,0)") - low) / width).cast("int")
    rows = sizes.filter(F.col("id").between(low, high)).groupBy(place.alias("bin")).agg(F.sum("bytes").alias("bytes")).collect()
    found = []
    for at, weight in sorted((row["bin"], int(row["bytes"])) for row in rows):
        first = low + at * width
        if weight > most and width > 1:
            found += _histogram(sizes, first, min(first + width - 1, high), most)
        else:
            found.append((first, weight))
    return found


def plan_records(pages: DataFrame, id_col: str, url_col: str, payload_col: str, least_bytes: int) -> DataFrame:
    """id, url, payload, bytes, sha1 (hex), turn, first_id: ``turn`` numbers rows of the first id."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("bytes", F.octet_length("payload").cast("long")).withColumn("sha1", F.sha1("payload"))
    shared = rows.filter(F.col("bytes") >= least_bytes).groupBy("sha1").agg(F.min("id").alias("first_id"), F.count("*").alias("n"))
    # payloads that occur once need no lookup; stored, so that Spark knows how small this is
    shared = materialize(shared.filter("n > 1").select("sha1", "first_id"))
    return rows.join(shared, "sha1", "left")


# --- writing ----------------------------------------------------------------------


def write(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", *, folder: str | None = None,
    least_bytes: int = 0, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES, date: str = DATE,
) -> Archive:
    """Write every row as a record and commit the archive. ``folder`` must be one
    that all executors reach; the default is a new one in the shared folder."""
    spark = pages.sparkSession
    folder = (folder or shared_dir(spark)).rstrip("/")
    rows = plan_records(pages, id_col, url_col, payload_col, least_bytes)
    starts = shard_starts(pages.select(F.col(id_col).cast("long").alias("id"), (F.coalesce(F.octet_length(payload_col), F.lit(0)) + 512).alias("bytes")), shard_bytes)
    # each range of ids one shard; few of them, so a plain list in the plan
    shard = F.lit(0)
    if starts:
        edges = F.array(*map(F.lit, starts))
        shard = F.size(F.filter(edges, lambda edge: edge <= F.col("id")))
    dealt = rows.withColumn("shard", shard.cast("long"))
    ordered = dealt.repartition(len(starts) + 1, "shard").sortWithinPartitions("shard", F.col("id").asc_nulls_first(), "sha1", "url")
    needed = ordered.select(
        "shard", "id", "url", "sha1", "bytes", "first_id",
        # a revisit's payload is not needed
        F.when(F.col("first_id").isNull() | (F.col("id") <= F.col("first_id")), F.col("payload")).alias("payload"),
    )
    reports = materialize(needed.mapInArrow(_writer(folder, file_bytes, date), REPORT))
    renamed = reports.repartition(max(1, spark.sparkContext.defaultParallelism), "name").mapInArrow(_renamer(folder), REPORT)
    manifest = f"{folder}/manifest"
    renamed.select("shard", "sequence", "name", "records", "bytes").write.mode("overwrite").parquet(manifest)
    return Archive(folder, manifest)


def _file_system(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{posixpath.abspath(folder)}")


def _writer(folder: str, file_bytes: int, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _file_system(folder)
        out = _Rolling(fs, root, file_bytes, date)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for row in batch.slice(at, 256).to_pylist():
                    out.add(row)
        out.close()
        columns = list(zip(*out.reports, strict=True)) or [()] * 6
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
        names = ["shard", "sequence", "temporary", "name", "records", "bytes"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return run


class _Rolling:
    """Files of one task: one open at a time."""

    def __init__(self, fs: pafs.FileSystem, root: str, file_bytes: int, date: str):
        self.fs, self.root, self.file_bytes, self.date = fs, root, file_bytes, date
        self.attempt = uuid.uuid4().hex
        self.reports: list[tuple] = []
        self.stream = None
        self.shard = self.sequence = -1
        self.last = None

    def add(self, row: dict) -> None:
        if self.stream is None or row["shard"] != self.shard or self.size >= self.file_bytes:
            self.open(row["shard"])
        # rows sorted by id and digest: a repeated row with this payload is a revisit of itself
        key = (row["id"], row["sha1"])
        is_response = row["first_id"] is None or (row["id"] == row["first_id"] and key != self.last)
        if row["first_id"] is not None and row["id"] is None:
            is_response = False
        self.last = key
        self.put(record(row, None if is_response else row["first_id"], self.date))
        self.records += 1

    def open(self, shard: int) -> None:
        self.close()
        self.sequence = self.sequence + 1 if shard == self.shard else 0
        self.shard = shard
        self.name = f"part-{shard:08d}-{self.sequence:06d}.warc.gz"
        self.temporary = f"_temporary/{self.attempt}/{self.name}"
        self.fs.create_dir(f"{self.root}/_temporary/{self.attempt}", recursive=True)
        self.stream = self.fs.open_output_stream(f"{self.root}/{self.temporary}", compression=None)
        self.size = self.records = 0
        self.put(info_record(self.name, self.date))

    def put(self, raw: bytes) -> None:
        packed = gzip.compress(raw, 6, mtime=0)
        self.stream.write(packed)
        self.size += len(packed)

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.reports.append((self.shard, self.sequence, self.temporary, self.name, self.records, self.size))
            self.stream = None


def _renamer(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _file_system(folder)
        for batch in batches:
            for row in batch.to_pylist():
                at = f"{root}/{row['temporary']}"
                if fs.get_file_info(at).type == pafs.FileType.File:
                    fs.move(at, f"{root}/{row['name']}")
            yield batch

    return run


def _digest(raw: bytes) -> str:
    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


def record_id(number: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'record:{number}:{digest}')}>"


def _joined(fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields)
    return head.encode() + f"Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def info_record(name: str, date: str) -> bytes:
    block = b"format: WARC File Format 1.1\r\n"
    return _joined([
        ("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(None, name)), ("WARC-Date", date), ("WARC-Filename", name),
        ("Content-Type", "application/warc-fields"), ("WARC-Block-Digest", f"sha1:{_digest(block)}"),
    ], block)


def record(row: dict, refers_to: int | None, date: str) -> bytes:
    """A response, or, if ``refers_to`` is an id, a revisit of it."""
    digest = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
    is_revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['bytes']}\r\n\r\n".encode()
    block = http if is_revisit else http + (row["payload"] or b"")
    # a header is one line without control characters
    url = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in row["url"] or f"urn:record:{row['id']}")
    fields = [
        ("WARC-Type", "revisit" if is_revisit else "response"), ("WARC-Record-ID", record_id(row["id"], digest)),
        ("WARC-Date", date), ("WARC-Target-URI", url), ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{_digest(block)}"),
    ]
    if row["id"] is not None:
        fields.append((ID_HEADER, row["id"]))
    if is_revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)), (f"{ID_HEADER}-Of-Original", refers_to)]
    return _joined(fields, block)


# --- reading ----------------------------------------------------------------------

ROWS = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "payload binary, file string"
)


def read(spark: SparkSession, archive: Archive, with_payload: bool = True) -> DataFrame:
    """The records of an archive. Digests are checked against the bytes read; a
    record that does not match fails the job."""
    files = spark.read.parquet(archive.manifest).select("name", "bytes").orderBy(F.xxhash64("name"))
    tasks = max(1, spark.sparkContext.defaultParallelism)
    return files.select("name").repartition(tasks, "name").mapInArrow(_reader(archive.folder, with_payload), ROWS)


def _reader(folder: str, with_payload: bool):
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.string()]
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload", "file"]

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _file_system(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with fs.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for fields, block in records(stream):
                        if fields["warc-type"] == "warcinfo":
                            continue
                        row = parsed(fields, block, name)
                        rows.append(row if with_payload else (*row[:6], None, name))
                        held += len(row[6] or b"") if with_payload else 100
                        if held > 16_000_000:
                            yield packed(rows)
                            rows, held = [], 0
                if rows:
                    yield packed(rows)

    return run


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of every record; one in memory at a time."""
    for raw in members(stream):
        head, _, rest = raw.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        fields = {name.lower(): value for name, _, value in (line.partition(": ") for line in lines[1:])}
        length = int(fields["content-length"])
        if rest[length:] != b"\r\n\r\n":
            raise ValueError("a record's length does not match its block")
        yield fields, rest[:length]


def members(stream, size: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a stream, unpacked."""
    raw = stream.read(size)
    while raw:
        unpack, out = zlib.decompressobj(31), io.BytesIO()
        while not unpack.eof:
            if not raw:
                raise ValueError("an archive ends within a record")
            out.write(unpack.decompress(raw))
            raw = unpack.unused_data if unpack.eof else stream.read(size)
        yield out.getvalue()
        raw = raw or stream.read(size)


def parsed(fields: dict[str, str], block: bytes, name: str) -> tuple:
    if fields["warc-block-digest"] != f"sha1:{_digest(block)}":
        raise ValueError(f"{name}: a block does not match its digest")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(line[16:]) for line in http.decode().split("\r\n") if line.lower().startswith("content-length: "))
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if fields["warc-type"] == "response" and (len(payload) != length or _digest(payload) != digest):
        raise ValueError(f"{name}: a payload does not match its digest")
    number, original = fields.get(ID_HEADER.lower()), fields.get(f"{ID_HEADER}-Of-Original".lower())
    return (
        None if number is None else int(number), fields["warc-target-uri"], length, digest, fields["warc-type"],
        None if original is None else int(original), payload if fields["warc-type"] == "response" else None, name,
    )


def oracle_sql(table: str = "pages") -> str:
    """What reading back the archive gives, in DuckDB's SQL. Base 32 has 4 digits
    for 5 hexadecimal ones."""
    piece = "CAST('0x' || substr(h, CAST(5 * g + 1 AS BIGINT), 5) AS BIGINT)"
    digits = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(({piece} >> {shift}) & 31 AS BIGINT) + 1, 1)" for shift in (15, 10, 5, 0))
    return f"""
WITH p AS (
    SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM {table}
), d AS (
    SELECT *, array_to_string(list_transform(range(8), lambda g: {digits}), '') AS payload_digest,
        min(page_id) OVER (PARTITION BY h) AS first_id
    FROM p
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d
"""
