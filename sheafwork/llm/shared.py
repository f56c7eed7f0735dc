"""What the operators of this subpackage share: tables, the shared folder, folds and small numpy helpers.

Files that one task writes and another reads go below ``spark.checkpoint.dir``, which the driver and all
executors see.  Paths are URIs and are opened through ``pyarrow.fs``, so any file system it knows will do.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafwork.session import shared_folder, spread  # noqa: F401  operators take spread from here

#: The six ASCII whitespace bytes that separate words everywhere in this subpackage.
SPACES = b" \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows that are drawn for each range of in_ranges, code points of a text that count in its bounds, and where many rows begin alike.
RANGE_SAMPLE, RANGE_PREFIX, LONG_PREFIX = 60, 100, 3200
#: Rows of which so long a beginning is drawn at most.
MOST_LONG = 20_000
ASCII_LOWER = str.maketrans(UPPER, LOWER)
BETWEEN_WORDS = re.compile(rb"[\x20\x09-\x0D]")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def few(df: DataFrame, most: int) -> DataFrame:
    """df with a hint to broadcast it if it has at most that many rows, which are counted; rows are to be short."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def shared_dir(spark: SparkSession) -> str:
    """URI of the folder that driver and executors share."""
    found = shared_folder(spark)
    return found if "://" in found or found.startswith("file:") else f"file://{os.path.abspath(found)}"


def fresh_path(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder, deleted when the driver's JVM ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    fs.mkdirs(where)
    fs.deleteOnExit(where)
    return path


def staged(df: DataFrame, tag: str) -> DataFrame:
    """df written once as Parquet in the shared folder and read again: lineage ends there, and a lost executor costs
    a read instead of the work above."""
    spark = df.sparkSession
    path = fresh_path(spark, tag)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that run within drop their shuffle files when they end, not when the driver next collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def write_file(uri: str, parts: list[bytes | memoryview]) -> None:
    """Writes a file under another name and renames it: a task that dies leaves no half file under the name."""
    fs, path = open_fs(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(part) as out:
        for x in parts:
            out.write(x)
    fs.move(part, path)


def read_range(uri: str, start: int, length: int) -> bytes:
    fs, path = open_fs(uri)
    with fs.open_input_file(path) as f:
        return f.read_at(length, start)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def fold(c: Column, parts: int) -> Column:
    """crc32 of the id as text modulo parts; -1 for a null id, which therefore is in no fold."""
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % parts, F.lit(-1))


def n_words(c: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("long")


def byte_words(text: str | None) -> list[bytes]:
    """The words of a text after A-Z are lower-cased, as UTF-8.  ``bytes.split`` separates at just the six SPACES."""
    return text.translate(ASCII_LOWER).encode("utf-8", "surrogatepass").split() if text else []


def word_strips(text: str | None, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """byte_words of a text in lists from about ``size`` bytes each, so that a very long text is never held as a list of words."""
    data = text.translate(ASCII_LOWER).encode("utf-8", "surrogatepass") if text else b""
    at = 0
    while at < len(data):
        cut = BETWEEN_WORDS.search(data, at + size)
        end = cut.start() if cut else len(data)
        yield data[at:end].split()
        at = end


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(31))
        x = x * np.uint64(0x9E3779B97F4A7C15)
        x = x ^ (x >> np.uint64(29))
        x = x * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def in_ranges(docs: DataFrame, n: int, descending: bool = False, seed: int = 11) -> DataFrame:
    """docs (doc_id, text) with ``bucket``: at most n even ranges in the order of (doc_id, text), or of descending doc_id and
    ascending text; null ids come first, or last.

    Bounds are taken from about RANGE_SAMPLE rows for each range, as (doc_id, first RANGE_PREFIX code points of the text), so rows
    that share an id, or have none, are spread too; where a range's worth of rows share both (a licence, a head that many texts
    have), from their first LONG_PREFIX code points.  A row finds its range by a coarse and a fine list of bounds."""
    prefix = F.left(F.coalesce("text", F.lit("")), F.lit(LONG_PREFIX))
    total = docs.count()
    rows = docs.select("doc_id", F.left(prefix, F.lit(RANGE_PREFIX)).alias("p"), prefix.alias("long"))
    if total > n * RANGE_SAMPLE:
        rows = rows.sample(False, n * RANGE_SAMPLE / total, seed)
    sign = -1 if descending else 1
    order = lambda r: (r[0] is not None, sign * r[0] if r[0] is not None else 0, (r[1] or "").encode("utf-8", "surrogatepass"))
    drawn = list(map(tuple, rows.select("doc_id", "p").collect()))  # about n * RANGE_SAMPLE rows
    alike = {k for k, times in Counter(drawn).items() if times >= RANGE_SAMPLE}
    if alike:
        heads = docs.sparkSession.createDataFrame(list(alike), T.StructType([docs.schema["doc_id"], T.StructField("p", T.StringType())])).select(F.col("doc_id").alias("_i"), F.col("p").alias("_p"))
        tied = rows.join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("_i")) & (F.col("p") == F.col("_p")), "left_semi")
        longer = [tuple(r) for r in hash_sample(tied, F.col("long"), MOST_LONG).select("doc_id", "long").limit(2 * MOST_LONG).collect()]
        times = max(1, sum(x in alike for x in drawn) // max(1, len(longer)))  # each stands for as many rows as were drawn
        drawn = [x for x in drawn if x not in alike] + longer * times
    got = sorted(drawn, key=lambda r: ((not order(r)[0]) if descending else order(r)[0], *order(r)[1:]))
    bounds = list(dict.fromkeys(got[len(got) * k // n] for k in range(1, n))) if got else []
    step = max(1, int(len(bounds) ** 0.5))
    kind = f"array<struct<id:{docs.schema['doc_id'].dataType.simpleString()},p:string>>"
    listed = lambda some: F.from_json(F.lit(json.dumps([{"id": i, "p": p} for i, p in some])), kind)
    id_, none = F.col("doc_id"), F.col("doc_id").isNull()

    def reached(b: Column) -> Column:
        """Whether a row is at a bound or behind it."""
        before = (b["id"] > id_) | (b["id"].isNotNull() & none) if descending else (b["id"] < id_) | (b["id"].isNull() & ~none)
        return F.coalesce(before, F.lit(False)) | (b["id"].eqNullSafe(id_) & (b["p"] <= prefix))

    count = lambda some: F.size(F.filter(some, reached))
    coarse = count(listed(bounds[::step])) if bounds else F.lit(0)
    found = docs.withColumn("_coarse", coarse)
    begin = F.greatest(F.col("_coarse") - 1, F.lit(0)) * step
    fine = F.when(F.col("_coarse") == 0, 0).otherwise(begin + count(F.slice(listed(bounds), begin + 1, F.lit(step)))) if bounds else F.lit(0)
    return found.withColumn("bucket", fine.cast("int")).drop("_coarse")


def hash_sample(df: DataFrame, key: Column, most: int, seed: int = 0) -> DataFrame:
    """About ``most`` rows of df chosen by a hash of key, all of them if there are fewer: the same rows at every run,
    whatever the partitions."""
    n = df.count()
    if n <= most:
        return df
    return df.where(F.pmod(F.xxhash64(key.cast("string"), F.lit(seed)), F.lit(1 << 40)) < int((1 << 40) * most / n))
