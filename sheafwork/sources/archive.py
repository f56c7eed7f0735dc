"""Archives of the PAK kind as a Spark data source: ``spark.read.format("pak").load(path)``.

Layout: ``PAK``, version (1 byte), header size and data size (i32) | index tree | four bytes | payloads.  A node is its
name (u8 length and bytes), flags (u8) and, for a directory (bit 0), a child count (i32) with the children, for a file its
position (i32, or f64 with bit 1), size (u32) and Adler-32 (u32).

Rows are (path, flags, pos, size, adler) and, with option payload=true, content.  Files are dealt out in runs of about
``split`` bytes where the plan is made; indexes, and payloads by range, are read inside the tasks."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

MOST_CHILDREN = 10_000_000


class FormatError(ValueError):
    pass


@dataclass(frozen=True)
class Entry:
    path: str
    flags: int
    pos: int
    size: int
    adler: int


def full_uri(uri: str) -> str:
    return uri if "://" in uri or uri.startswith("file:") else f"file://{uri}"


def opened(uri: str):
    fs, path = pafs.FileSystem.from_uri(full_uri(uri))
    return fs.open_input_file(path)


def read_header(head: bytes) -> tuple[int, int, int]:
    """(version, header size, data size)"""
    if len(head) < 12 or head[:3] != b"PAK":
        raise FormatError("no PAK archive")
    return head[3], *struct.unpack("<ii", head[4:12])


def read_tree(raw: bytes, strict: bool = True) -> tuple[list[Entry], int]:
    """All files of an index tree and the number of its directories; the tree is walked without recursion."""
    at = 0

    def take(n: int) -> bytes:
        nonlocal at
        if at + n > len(raw):
            raise FormatError(f"the index ends at {len(raw)} within a node")
        out = raw[at : at + n]
        at += n
        return out

    entries, dirs = [], 0
    todo = [("", 1)]  # (folder, nodes of it still to come)
    while todo:
        folder, left = todo.pop()
        if not left:
            continue
        todo.append((folder, left - 1))
        try:
            name = take(take(1)[0]).decode("utf-8")
        except UnicodeDecodeError as e:
            raise FormatError(f"a name before {at} is no UTF-8") from e
        if strict and "\\" in name:
            raise FormatError(f"backslash in {name!r}")
        flags = take(1)[0]
        path = f"{folder}/{name}" if folder else name
        if flags & 1:
            n = struct.unpack("<i", take(4))[0]
            if n < 0 or n > MOST_CHILDREN or strict and n > len(raw):
                raise FormatError(f"{n} children of {path!r}")
            dirs += 1
            todo.append((path, n))
        else:
            if flags & 2:
                where = struct.unpack("<d", take(8))[0]
                if strict and (where != int(where) or where < 0):
                    raise FormatError(f"position {where} of {path!r}")
                pos = int(where)
            else:
                pos = struct.unpack("<i", take(4))[0]
            size, adler = struct.unpack("<II", take(8))
            entries.append(Entry(path, flags, pos, size, adler))
    if strict and at != len(raw):
        raise FormatError(f"{len(raw) - at} bytes of the index are left")
    return entries, dirs


def load_index(uri: str, strict: bool = True) -> tuple[list[Entry], int, int]:
    """(entries, first byte of the payloads, directories) of an archive."""
    with opened(uri) as f:
        _, header, _ = read_header(f.read_at(12, 0))
        entries, dirs = read_tree(f.read_at(header - 16, 12), strict)
        return entries, header, dirs


#: Tasks that a read is dealt to at most.
MOST_TASKS = 512


@dataclass
class Files(InputPartition):
    """Archives (uri, this run, of so many) whose members a task reads."""

    runs: list[tuple[str, int, int]]


class PakReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.uri = options["path"]
        self.strict = options.get("strict", "true").lower() == "true"
        self.payload = options.get("payload", "false").lower() == "true"
        self.split = int(options.get("split", 64 << 20))

    def partitions(self) -> list[Files]:
        """The runs of one archive, or of all ``.pak`` files below a folder.  The plan has the files' names and lengths; indexes are read
        in tasks.  A file of over ``split`` bytes is dealt to several tasks, each with the members that begin in its run; smaller
        ones share tasks, and where there would be more than MOST_TASKS, a task has more than ``split`` bytes."""
        fs, path = pafs.FileSystem.from_uri(full_uri(self.uri))
        info = fs.get_file_info(path)
        if info.type != pafs.FileType.Directory:
            files = [(self.uri, info.size)]
        else:
            found = sorted((f.path, f.size) for f in fs.get_file_info(pafs.FileSelector(path, recursive=True)) if f.path.endswith(".pak"))
            files = [(full_uri(self.uri).rstrip("/") + f.removeprefix(path.rstrip("/")), size) for f, size in found]
        most = max(self.split, -(-sum(size or 0 for _, size in files) // MOST_TASKS))
        tasks: list[list[tuple[str, int, int]]] = [[]]
        held = 0
        for uri, size in files:
            n = max(1, -(-(size or 0) // most))
            for k in range(n):
                if tasks[-1] and held + (size or 0) / n > most:
                    tasks.append([])
                    held = 0
                tasks[-1].append((uri, k, n))
                held += (size or 0) / n
        return [Files(t) for t in tasks]

    def read(self, part: Files) -> Iterator[tuple]:
        for uri, k, n in part.runs:
            entries, base, _ = load_index(uri, self.strict)
            end = max((e.pos for e in entries), default=0) + 1
            yield from self.members(uri, base, [e for e in sorted(entries, key=lambda e: e.pos) if min(max(e.pos * n // end, 0), n - 1) == k])

    def members(self, uri: str, base: int, entries: list[Entry]) -> Iterator[tuple]:
        if not self.payload:
            yield from ((e.path, e.flags, e.pos, e.size, e.adler) for e in entries)
            return
        with opened(uri) as f:
            for e in entries:
                content = f.read_at(e.size, base + e.pos)
                if len(content) != e.size:
                    raise FormatError(f"{e.path} goes beyond the end of the archive")
                if self.strict and zlib.adler32(content) != e.adler:
                    raise FormatError(f"{e.path} doesn't match its checksum")
                yield e.path, e.flags, e.pos, e.size, e.adler, content


class PakSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "pak"

    def schema(self) -> str:
        return "path string, flags int, pos bigint, size bigint, adler bigint" + (", content binary" if self.options.get("payload", "false").lower() == "true" else "")

    def reader(self, schema) -> PakReader:
        return PakReader(self.options)


def write_pak(uri: str, files: dict[str, bytes], version: int = 0, wide: frozenset[str] = frozenset(), harmed: frozenset[str] = frozenset()) -> None:
    """An archive with these files, for tests and small exports; ``wide`` names get 64-bit positions, and of ``harmed`` ones the last
    byte is not the one that the checksum is of."""
    tree: dict = {}
    for name in files:
        *folders, leaf = name.split("/")
        node = tree
        for x in folders:
            node = node.setdefault(x, {})
        node[leaf] = name
    data = bytearray()

    def node(name: str, what) -> bytes:
        head = bytes([len(name.encode())]) + name.encode()
        if isinstance(what, dict):
            return head + b"\x01" + struct.pack("<i", len(what)) + b"".join(node(k, v) for k, v in what.items())
        body, pos = files[what], len(data)
        data.extend(body[:-1] + bytes([body[-1] ^ 1]) if what in harmed and body else body)
        return head + (b"\x02" + struct.pack("<d", pos) if what in wide else b"\x00" + struct.pack("<i", pos)) + struct.pack("<II", len(body), zlib.adler32(body))

    index = node("", tree)
    fs, path = pafs.FileSystem.from_uri(full_uri(uri))
    fs.create_dir(path.rpartition("/")[0] or ".", recursive=True)
    with fs.open_output_stream(path) as f:
        f.write(b"PAK" + bytes([version]) + struct.pack("<ii", 12 + len(index) + 4, len(data)) + index + b"DATA" + bytes(data))


def directories(entries: DataFrame) -> DataFrame:
    """The directories that an entry list has."""
    parts = F.split("path", "/")
    return entries.where(F.size(parts) > 1).select(F.explode(F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))).alias("path")).distinct()


def with_prefix(entries: DataFrame, prefix: str) -> DataFrame:
    """The listing (size, path) of the members below a prefix, by path."""
    return entries.where(F.col("path").startswith(prefix)).select("size", "path").orderBy("path")
