"""WARC archives of individually compressed records under one embedded Zstandard dictionary."""

from __future__ import annotations

import base64
import datetime
import hashlib
import struct
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import sampled, shared_dir, table, tidied, written

#: Magic number of the leading skippable frame that holds the dictionary.
DICT_FRAME = 0x184D2A5D
#: The dictionary's size, the records it is built from and the bytes that each may give.
DICT_BYTES, DICT_RECORDS, DICT_RECORD_BYTES = 64 << 10, 512, 64 << 10
LEVEL = 3
#: A task starts another archive beyond this many compressed bytes.
ARCHIVE_BYTES = 256 << 20
DATE = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def build_record(page_id, url: str | None, payload: bytes, refers_to=None) -> bytes:
    """A response record, or a revisit of the record of page refers_to, without its payload."""
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_line(url)}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"X-Page-Id: {'' if page_id is None else page_id}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page-Id: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def _line(url: str | None) -> str:
    return "".join(c for c in url or "" if c not in "\r\n")


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """(headers by lower-case name, payload without the HTTP head)."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    block = rest[: int(headers["content-length"])]
    if len(block) < int(headers["content-length"]) or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("record is cut off")
    return headers, block.partition(b"\r\n\r\n")[2]


def train_dictionary(samples: list[bytes], size: int = DICT_BYTES) -> bytes:
    """A Zstandard dictionary from records; empty if they are too few or too short for one."""
    try:
        return zstandard.train_dictionary(min(size, max(sum(map(len, samples)) // 8, 256)), samples, threads=0).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


class Writer:
    """Writes an archive: the dictionary in a leading skippable frame, then a frame for each record."""

    def __init__(self, out, dictionary: bytes):
        self.out, self.size = out, 0
        held = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if held:
            held.precompute_compress(level=LEVEL)
        self.pack = (zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_checksum=True, write_content_size=True) if held else zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)).compress
        self._put(struct.pack("<II", DICT_FRAME, len(dictionary)) + dictionary)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def add(self, record: bytes) -> tuple[int, int]:
        at, frame = self.size, self.pack(record)
        self._put(frame)
        return at, len(frame)


def read_archive(source, step: int = 1 << 20) -> Iterator[bytes]:
    """The records of an archive, one at a time, from a readable stream."""
    head = _exactly(source, 8)
    magic, size = struct.unpack("<II", head)
    if magic != DICT_FRAME:
        raise ValueError("archive does not begin with a dictionary frame")
    dictionary = _exactly(source, size)
    unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdDecompressor()
    rest, one, parts = b"", unpack.decompressobj(), []
    while True:
        data, rest = rest or source.read(step), b""
        if not data:
            break
        parts.append(one.decompress(data))
        if one.eof:
            yield b"".join(parts)
            rest, one, parts = one.unused_data, unpack.decompressobj(), []
    if any(parts):
        raise ValueError("archive is cut off")


def _exactly(source, n: int) -> bytes:
    out = b""
    while len(out) < n:
        if not (got := source.read(n - len(out))):
            raise ValueError("archive is cut off")
        out += got
    return out


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The store and the path in it; a path without scheme is local."""
    return pafs.FileSystem.from_uri(uri) if ":/" in uri else (pafs.LocalFileSystem(), uri)


def plan(pages: DataFrame) -> DataFrame:
    """Adds payload (binary), and refers_to: the largest page_id with an equal payload, if that isn't the row's own.

    A digest is shuffled with page_id alone, pre-aggregated; the payload crosses once, joined by page_id and digest, so
    a payload that many pages share makes no hot key."""
    p = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    keys = p.select("page_id", F.sha1("payload").alias("sha"), F.length("payload").alias("size"))
    least = keys.groupBy("sha", "size").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).where("n > 1")
    copies = keys.join(least, ["sha", "size"]).where("page_id < keeper").groupBy("page_id", F.col("sha").alias("sha_")).agg(F.max("keeper").alias("refers_to"))
    return p.withColumn("sha_", F.sha1("payload")).join(copies, ["page_id", "sha_"], "left").drop("sha_")


def write(pages: DataFrame, folder: str, records: int = DICT_RECORDS) -> DataFrame:
    """Writes (page_id, url, html) to archives below folder, which all executors reach; returns its table of
    (path, records, bytes), already written.

    Null html counts as empty. Of equal payloads, the record of the largest page_id is the response and the others revisit
    it; empty payloads too. Repeated rows with that page_id are all responses; a null page_id is less than any other.
    The dictionary is built from about `records` pages, those with the least hashes of page_id and html, at most 64 KiB of each. Each
    attempt of a task writes its own files and only those of successful ones are in the table: a lost executor leaves at
    most unused files. Columns other than these three are ignored."""
    some = sampled(pages, records, "page_id", "html").select("page_id", "url", F.substring(F.encode(F.coalesce("html", F.lit("")), "UTF-8"), 1, DICT_RECORD_BYTES).alias("payload"))
    dictionary = train_dictionary([build_record(r.page_id, r.url, bytes(r.payload)) for r in some.toLocalIterator()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = stream = path = None
        n, done = 0, []
        for b in batches:
            for page_id, url, payload, refers_to in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to"))):
                if writer is None:
                    path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
                    fs, at = file_system(path)
                    fs.create_dir(at.rpartition("/")[0], recursive=True)
                    stream = fs.open_output_stream(at, compression=None)  # else the name would have it packed twice
                    writer, n = Writer(stream, dictionary), 0
                writer.add(build_record(page_id, url, payload or b"", refers_to))
                n += 1
                if writer.size >= ARCHIVE_BYTES:
                    stream.close()
                    done.append((path, n, writer.size))
                    writer = None
        if writer is not None:
            stream.close()
            done.append((path, n, writer.size))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done]), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64())], names=["path", "records", "bytes"])

    return written(plan(pages).mapInArrow(tidied(run), "path string, records bigint, bytes bigint"))


def read(archives: DataFrame) -> DataFrame:
    """The records of archives (path): page_id, url, record_type, payload_bytes, payload_digest, refers_to, html (null for
    revisits). Response payloads are hashed again and must agree with their header."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column("path").to_pylist():
                fs, at = file_system(path)
                with fs.open_input_stream(at, compression=None) as source:
                    rows, size = [], 0
                    for raw in read_archive(source):
                        h, payload = parse_record(raw)
                        kind, sha = h["warc-type"], h["warc-payload-digest"].removeprefix("sha1:")
                        if kind == "response" and digest(payload) != sha:
                            raise ValueError(f"digest of {h['warc-record-id']} differs")
                        whole = kind == "response"
                        rows.append((int(h["x-page-id"]) if h["x-page-id"] else None, h["warc-target-uri"], kind, len(payload) if whole else int(h["x-payload-length"]), sha, int(h["x-refers-to-page-id"]) if "x-refers-to-page-id" in h else None, payload.decode("utf-8") if whole else None))
                        size += len(payload)
                        if size > 4 << 20:
                            yield batch(rows)
                            rows, size = [], 0
                    if rows:
                        yield batch(rows)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "html"])

    spread = max(1, int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return archives.select("path").repartition(spread, "path").mapInArrow(tidied(run), "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, html string")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = write(table(spark, sf_dir, "pages"), f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}")
    return read(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: DuckDB's own statement of op2: sha1 in hexadecimal is turned into base 32 digit by digit.
OP2_SQL = """
with p as (select page_id, coalesce(html, '') as h from pages),
q as (select page_id, octet_length(encode(h)) as n, sha1(h) as x, max(page_id) over (partition by h) as keeper from p)
select page_id, cast(n as bigint) as payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + cast((('0x' || substr(x, cast(1 + (i // 8) * 10 as int), 10))::bigint >> (35 - 5 * (i % 8))) & 31 as int), 1)), '') as payload_digest,
  case when page_id = keeper then 'response' else 'revisit' end as record_type,
  case when page_id = keeper then null else keeper end as refers_to
from q
"""
