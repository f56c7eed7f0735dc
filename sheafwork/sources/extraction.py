"""Members of archives as files: extraction that checks before it puts a file in place, and that can be stopped and run again.

A member is written under a name of its own attempt, checked, and then renamed, so a task that dies, or runs twice, leaves no half
file under a member's name.  A run begins by hashing what is there already and moves only what differs; what is wrong goes to a
ledger and not to the folder."""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafwork.session import staged, tasks_of
from sheafwork.sources.archive import FormatError, full_uri, load_index, opened

CHUNK = 4 << 20
ENTRY = "uri string, base bigint, path string, flags int, pos bigint, size bigint, adler bigint"
MANIFEST = "uri string, path string, size bigint, adler bigint, sha256 string, action string, problem string"


def entries_of(archives: DataFrame, strict: bool = True) -> DataFrame:
    """(uri, base, path, flags, pos, size, adler, problem) of all members of archives (uri): each index is read in a task.  An archive
    that can't be read is one row with its problem."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*[c.split()[0] for c in ENTRY.split(", ")], "problem"]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                try:
                    entries, base, _ = load_index(uri, strict)
                    rows = [(uri, base, e.path, e.flags, e.pos, e.size, e.adler, None) for e in entries]
                except (FormatError, OSError) as e:
                    rows = [(uri, None, None, None, None, None, None, str(e))]
                for i in range(0, len(rows), 1 << 16):
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[i : i + (1 << 16)]), kinds)], names=names)

    return archives.select("uri").mapInArrow(work, f"{ENTRY}, problem string")


def unsafe(path: str) -> bool:
    """Whether a member's name leads out of a folder."""
    parts = path.split("/")
    return path.startswith("/") or "\\" in path or "\0" in path or any(p in ("", ".", "..") for p in parts)


def hashed(fs: pafs.FileSystem, path: str) -> tuple[int, int, str] | None:
    """(size, Adler-32, SHA-256) of a file; None if there is none."""
    if fs.get_file_info(path).type != pafs.FileType.File:
        return None
    size, adler, sha = 0, 1, hashlib.sha256()
    with fs.open_input_stream(path) as f:
        while data := f.read(CHUNK):
            size, adler = size + len(data), zlib.adler32(data, adler)
            sha.update(data)
    return size, adler, sha.hexdigest()


def put_member(source, base: int, pos: int, size: int, adler: int, fs: pafs.FileSystem, target: str) -> tuple[str | None, str, str | None]:
    """(sha256, action, problem) of one member: ``kept`` if the file is there and right, ``written`` or ``refused``."""
    there = hashed(fs, target)
    if there and there[:2] == (size, adler):
        return there[2], "kept", None
    part, found, sha, at = f"{target}.{uuid.uuid4().hex}.part", 1, hashlib.sha256(), 0
    fs.create_dir(target.rpartition("/")[0], recursive=True)
    try:
        with fs.open_output_stream(part) as out:
            while at < size:
                data = source.read_at(min(CHUNK, size - at), base + pos + at)
                if not data:
                    break
                found, at = zlib.adler32(data, found), at + len(data)
                sha.update(data)
                out.write(data)
        if at < size or found != adler:
            return None, "refused", f"ends after {at} of {size} bytes" if at < size else f"checksum {found:08x} instead of {adler:08x}"
        fs.move(part, target)
        return sha.hexdigest(), "written", None
    finally:
        if fs.get_file_info(part).type == pafs.FileType.File:
            fs.delete_file(part)


def extract(entries: DataFrame, folder: str) -> DataFrame:
    """Puts the members (entries_of) of archives below a folder; returns the run's report (uri, path, size, adler, sha256, action,
    problem), made once.  Members lie in tasks by runs of their archive; a folder has each path once, so of several archives with
    one path the first by name wins and the others are refused.  The number of tasks is given, as rows of few bytes stand for files,
    and archives come in another order than their names', so that tasks do not all make files in the same folder at a time."""
    good = entries.where("problem IS NULL")
    first = good.groupBy("path").agg(F.min(F.struct("uri", "pos")).alias("_first"))
    owned = good.join(first, "path").withColumn("taken", (F.col("_first.uri") != F.col("uri")) | (F.col("_first.pos") != F.col("pos"))).drop("_first")
    dealt = owned.repartition(tasks_of(entries), "uri", F.expr("pos DIV (64 * 1024 * 1024)")).sortWithinPartitions(F.xxhash64("uri"), "uri", "pos")
    root = full_uri(folder)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, below = pafs.FileSystem.from_uri(root)
        name, source = None, None
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if r["taken"] or unsafe(r["path"]):
                    result = (None, "refused", "another member has the path" if r["taken"] else "the name leads out of the folder")
                else:
                    if r["uri"] != name:
                        name, source = r["uri"], opened(r["uri"])
                    result = put_member(source, r["base"], r["pos"], r["size"], r["adler"], fs, f"{below}/{r['path']}")
                rows.append((r["uri"], r["path"], r["size"], r["adler"], *result))
            kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 7, kinds)], names=[c.split()[0] for c in MANIFEST.split(", ")])

    done = dealt.mapInArrow(work, MANIFEST)
    unread = entries.where("problem IS NOT NULL").select("uri", "path", "size", "adler", F.lit(None).cast("string").alias("sha256"), F.lit("refused").alias("action"), "problem")
    return staged(done.unionByName(unread), "extraction")


def manifest_of(report: DataFrame) -> DataFrame:
    """(path, size, adler, sha256) of what a run left in place, the same for every run that ends."""
    return report.where("action <> 'refused'").select("path", "size", "adler", "sha256")


def summary_of(report: DataFrame) -> DataFrame:
    """(action, members, bytes) of a run."""
    return report.groupBy("action").agg(F.count("*").alias("members"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))


def verify(manifest: DataFrame, folder: str) -> DataFrame:
    """The ledger of files that are not as a manifest says: (path, problem), problem being missing, size or content.  Without the
    archive; each file is read once."""
    root = full_uri(folder)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, below = pafs.FileSystem.from_uri(root)
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                there = hashed(fs, f"{below}/{r['path']}")
                problem = "missing" if there is None else "size" if there[0] != r["size"] else "content" if there[2] != r["sha256"] else None
                if problem:
                    rows.append((r["path"], problem))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in (zip(*rows) if rows else [(), ()])], names=["path", "problem"])

    return manifest.select("path", "size", "sha256").mapInArrow(work, "path string, problem string")


def archives_below(spark: SparkSession, folder: str) -> DataFrame:
    """(uri) of the archives below a folder, which Spark lists."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.pak").load(folder)
    return files.select(F.col("path").alias("uri"))
