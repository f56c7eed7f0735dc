"""Operator 8, WARC archives with a two-level capture index.

Pages become WARC/1.1 records, each a gzip member, in archive files of bounded size.  Of records with equal payloads the
one with the largest page_id is a response; the others are revisits that refer to it and hold the HTTP head alone.

The index sorts captures by (reversed-host URL key, page_id) into files; a file is a run of compressed blocks of
BLOCK_LINES captures with a sparse directory (first key, offset, length of each block) at its end.  A lookup finds the file
among the files' first keys (level 0, one row a file), binary-searches that file's directory, reads one block, and
binary-searches its lines for the archive, offset and length of the record, which is then read by range.  Lookups are dealt
out by index file and sorted, so that each block is read once.

Defined cases: null html is the empty payload; a null url has the key ``-`` and no target URI; a null page_id counts as
smaller than any other, and pages of one payload without any page_id are all responses; repeated rows are captures of
their own, and with equal payloads all rows of the largest page_id are responses; a payload shorter than min_bytes is
always a response; an empty table writes no files and gives no rows.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafwork.llm.shared import ASCII_LOWER, fresh_path, open_fs, staged, table, write_file

ARCHIVE_BYTES, BLOCK_LINES = 64 << 20, 512
#: Bytes of records that a reader holds before it hands them on; a larger record is handed on alone.
HELD = 16 << 20
DATE = "2000-01-01T00:00:00Z"  # the tables have no capture time
MAGIC = b"CIX1"
_URL = re.compile(r"://([^/?#]*)(.*)", re.S)
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def safe(text: str) -> str:
    """Control characters and spaces percent-encoded: header lines and keys stay on their line."""
    return _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", text)


def url_key(url: str | None) -> str:
    """'http://www.Example.com:80/a?b' -> 'com,example,www:80)/a?b'; '-' for null, the text itself without a host."""
    if url is None:
        return "-"
    m = _URL.search(url)
    if not m:
        return safe(url)
    host, colon, port = m[1].translate(ASCII_LOWER).rpartition("@")[2].partition(":")
    return safe(",".join(reversed(host.split("."))) + colon + port + ")" + m[2])


def order_of(page_id: int | None) -> str:
    """Text that sorts as the id does; null first."""
    return "" if page_id is None else f"{page_id + (1 << 63):020d}"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, is_revisit: bool) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if is_revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if is_revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {safe(url)}")
    head.append(f"WARC-Payload-Digest: sha1:{payload_digest(payload)}")
    if is_revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    packer = zlib.compressobj(3, wbits=31)
    return packer.compress("\r\n".join(head).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n") + packer.flush()


def parse_record(data: bytes) -> dict:
    """page_id, url, record_type, refers_to, digest, payload (None for a revisit) and payload_bytes of a record."""
    raw = zlib.decompress(data, wbits=31)
    top, _, rest = raw.partition(b"\r\n\r\n")
    head = dict(x.split(": ", 1) for x in top.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = rest[: int(head["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    told = dict(x.split(b": ", 1) for x in http.split(b"\r\n")[1:])
    number = lambda v: int(v[len("<urn:page:") : -1]) if v and v != "<urn:page:>" else None
    revisit = head["WARC-Type"] == "revisit"
    return {
        "page_id": number(head["WARC-Record-ID"]), "url": head.get("WARC-Target-URI"), "record_type": head["WARC-Type"], "refers_to": number(head.get("WARC-Refers-To")),
        "digest": head["WARC-Payload-Digest"].removeprefix("sha1:"), "payload": None if revisit else payload, "payload_bytes": int(told[b"Content-Length"]) if revisit else len(payload),
    }


def with_role(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, refers_to): refers_to is not null for revisits.  Only ids and digests are grouped; payloads
    move once, dealt by page_id, so that many copies of one payload are no heavier for a task than other pages."""
    rows = pages.select(F.col("page_id").cast("bigint"), "url", F.encode(F.coalesce("html", F.lit("")), "utf-8").alias("payload"))
    digests = staged(rows.select("page_id", F.sha1("payload").alias("sha"), F.octet_length("payload").alias("n")), "warc-digests")
    largest = digests.where(F.col("n") >= min_bytes).groupBy("sha").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("copies")).where("copies > 1").drop("copies")
    revisits = digests.join(largest, "sha").where("NOT (page_id <=> refers_to)").select(F.col("page_id").alias("of"), F.col("sha").alias("of_sha"), "refers_to").distinct()
    joined = rows.withColumn("sha", F.sha1("payload")).join(revisits, F.col("page_id").eqNullSafe(F.col("of")) & (F.col("sha") == F.col("of_sha")), "left")
    return joined.select("page_id", "url", "payload", "refers_to")


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Writes the archives; returns a capture (key, page, file, offset, length) for each page."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        told: list[tuple[str, str, int, int]] = []
        size = 0

        def close() -> pa.RecordBatch:
            path = f"{folder}/pages-{uuid.uuid4().hex}.warc.gz"
            write_file(path, held)
            key, page, offset, length = zip(*told)
            return pa.RecordBatch.from_pydict({"key": key, "page": page, "file": [path] * len(told), "offset": pa.array(offset, pa.int64()), "length": pa.array(length, pa.int64())})

        for batch in batches:
            for page_id, url, payload, refers_to in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to"))):
                data = record(page_id, url, payload, refers_to, refers_to is not None)
                told.append((url_key(url), order_of(page_id), size, len(data)))
                held.append(data)
                size += len(data)
                if size >= ARCHIVE_BYTES:
                    yield close()
                    held, told, size = [], [], 0
        if held:
            yield close()

    return staged(with_role(pages, min_bytes).mapInArrow(write, "key string, page string, file string, offset bigint, length bigint"), "warc-captures")


def write_index(captures: DataFrame, folder: str) -> DataFrame:
    """Writes the index files; returns level 0: (first, last, path), one row a file."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines: list[str] = []
        blocks: list[bytes] = []
        directory: list[tuple[str, int, int]] = []
        size, first, last = 0, None, None

        def close() -> None:
            nonlocal size
            data = zlib.compress("\n".join(lines).encode("utf-8", "surrogatepass"), 6)
            directory.append((lines[0].rpartition("\t")[0], size, len(data)))
            blocks.append(data)
            size += len(data)
            lines.clear()

        for batch in batches:
            for key, page, file, offset, length in zip(*(batch.column(c).to_pylist() for c in ("key", "page", "file", "offset", "length"))):
                last = f"{key}\t{page}"
                first = first if first is not None else last
                lines.append(f"{last}\t{json.dumps([file.rpartition('/')[2], offset, length])}")
                if len(lines) == BLOCK_LINES:
                    close()
        if lines:
            close()
        if blocks:
            path = f"{folder}/captures-{uuid.uuid4().hex}.cdx"
            told = json.dumps(directory).encode("utf-8", "surrogatepass")
            write_file(path, [*blocks, told, struct.pack("<QQ", size, len(told)), MAGIC])
            yield pa.RecordBatch.from_pydict({"first": [first], "last": [last], "path": [path]})

    n = max(1, int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = captures.repartitionByRange(n, "key", "page").sortWithinPartitions("key", "page")
    return staged(ordered.mapInArrow(write, "first string, last string, path string"), "warc-index")


class IndexFile:
    def __init__(self, uri: str) -> None:
        fs, path = open_fs(uri)
        self.file = fs.open_input_file(path)
        end = self.file.size()
        offset, length, magic = struct.unpack("<QQ4s", self.file.read_at(20, end - 20))
        if magic != MAGIC:
            raise ValueError(f"{uri} is no capture index")
        self.directory = json.loads(self.file.read_at(length, offset).decode("utf-8", "surrogatepass"))
        self.firsts = [d[0] for d in self.directory]
        self.held: tuple[int, list[str]] = (-1, [])

    def lines(self, block: int) -> list[str]:
        if self.held[0] != block:
            _, offset, length = self.directory[block]
            self.held = (block, zlib.decompress(self.file.read_at(length, offset)).decode("utf-8", "surrogatepass").split("\n"))
        return self.held[1]

    def find(self, wanted: str) -> Iterator[tuple[str, int, int]]:
        """(archive, offset, length) of all captures of a key and page."""
        block = max(0, bisect.bisect_left(self.firsts, wanted) - 1)
        while block < len(self.directory) and self.firsts[block] <= wanted:
            lines = self.lines(block)
            at = bisect.bisect_left(lines, wanted)
            while at < len(lines) and lines[at].startswith(wanted + "\t"):
                yield tuple(json.loads(lines[at].rpartition("\t")[2]))
                at += 1
            block += 1


def fetch(lookups: DataFrame, index: DataFrame, archives: str) -> DataFrame:
    """The records of the captures of lookups (page_id, url), repeated ones once, read by range from the archives."""
    files = sorted((r["first"], r["last"], r["path"]) for r in index.collect())  # level 0: one row a file
    schema = "page_id bigint, url string, record_type string, refers_to bigint, payload_digest string, payload_bytes bigint, payload binary"
    spark = lookups.sparkSession
    if not files:
        return spark.createDataFrame([], schema)
    firsts, lasts, paths = ([f[i] for f in files] for i in range(3))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = sorted({f"{url_key(u)}\t{order_of(p)}" for p, u in zip(batch.column("page_id").to_pylist(), batch.column("url").to_pylist())})
            out = []
            for w in wanted:
                k = max(0, bisect.bisect_left(firsts, w) - 1)
                while k < len(files) and firsts[k] <= w:
                    if w <= lasts[k]:
                        out.append((k, w))
                    k += 1
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.int32()), pa.array([w for _, w in out], pa.string())], names=["file", "wanted"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index_file: tuple[int, IndexFile | None] = (-1, None)
        opened: dict = {}
        for batch in batches:
            spans = []
            for k, wanted in zip(batch.column("file").to_pylist(), batch.column("wanted").to_pylist()):
                if index_file[0] != k:
                    index_file = (k, IndexFile(paths[k]))
                spans += index_file[1].find(wanted)
            spans.sort()
            at = 0
            while at < len(spans):
                rows, held = [], 0
                while at < len(spans) and len(rows) < 256 and (not rows or held < HELD):
                    archive, offset, length = spans[at]
                    at, held = at + 1, held + length
                    if archive not in opened:
                        if len(opened) >= 64:
                            opened.pop(next(iter(opened))).close()
                        fs, path = open_fs(f"{archives}/{archive}")
                        opened[archive] = fs.open_input_file(path)
                    r = parse_record(opened[archive].read_at(length, offset))
                    if r["payload"] is not None and payload_digest(r["payload"]) != r["digest"]:
                        raise ValueError(f"{archive} at {offset}: the payload doesn't match its digest")
                    rows.append((r["page_id"], r["url"], r["record_type"], r["refers_to"], r["digest"], r["payload_bytes"], r["payload"]))
                kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload"])

    placed = lookups.select(F.col("page_id").cast("bigint"), "url").mapInArrow(place, "file int, wanted string").distinct()
    return placed.repartitionById(len(files), F.col("file")).sortWithinPartitions("file", "wanted").mapInArrow(read, schema)


def archive_pages(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes pages as archives with their index, and returns what lookups of all pages read back."""
    folder = fresh_path(pages.sparkSession, "warc")
    index = write_index(write_archives(pages, folder, min_bytes), f"{folder}/index")
    return fetch(pages.select("page_id", "url"), index, folder)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
