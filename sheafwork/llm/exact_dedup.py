"""Operator 11, exact duplicates by counting quotient filters and a comparison of bytes.

Texts are equal when they are the same after each run of ASCII white space became one space.  Every partition counts the 64-bit
fingerprints of its texts in quotient filters, cut into shards of the fingerprints' range; a shard's filters from all partitions
merge into one without loss.  A fingerprint that the merged filter counts once has a text of its own: that row is done, and its
text is never moved.  The texts of all other fingerprints are compared byte by byte: they are grouped by the text itself, after a
first grouping within each task, so a text is sent once by each task however many copies there are, and texts that only share a
fingerprint part again.

Memory: a task holds up to HELD fingerprints before it writes a filter, a merge the distinct fingerprints of one shard, about
2 ** SHARD.  The fingerprints that repeat are broadcast up to BROADCAST of them (counted first; 8 bytes each) and joined by a
shuffle beyond that.

Defined cases: null counts as empty, and empty texts are equal; texts of any length are hashed and compared whole; of rows alike
in doc_id and text just one stays; a null doc_id stays only where the group has no other, and then keep_id is null; an empty table
gives no rows; columns other than doc_id and text are dropped, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafwork.llm.quotient_filter import QuotientFilter
from sheafwork.llm.shared import spread, staged, table

SPACES = r"[\x20\x09-\x0D]+"
#: Fingerprints of a filter, bits of a merged shard's fingerprints, shards at least (as bits), rows of a broadcast.
HELD, SHARD, FEWEST, BROADCAST = 1 << 20, 22, 3, 1_000_000


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def fingerprint(text: Column, bits: int = 64) -> Column:
    """The upper bits of the text's hash, as the lower bits of a bigint."""
    return F.shiftrightunsigned(F.xxhash64(text), 64 - bits) if bits < 64 else F.xxhash64(text)


def partition_filters(prints: DataFrame, shards: int) -> DataFrame:
    """(shard, filter) of prints (fp): filters of each partition, one for each shard (the upper ``shards`` bits) that it has."""

    def cut(fps: list[np.ndarray]) -> pa.RecordBatch:
        every = QuotientFilter.of(np.concatenate(fps))
        of = (every.fps >> np.uint64(64 - shards)).astype(np.int32)
        edges = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)] if len(of) else [0]
        low = every.fps & np.uint64((1 << (64 - shards)) - 1)
        parts = [QuotientFilter(64 - shards, low[i:j], every.counts[i:j]).to_bytes() for i, j in zip(edges, edges[1:])]
        return pa.RecordBatch.from_arrays([pa.array(of[edges[:-1]], pa.int32()), pa.array(parts, pa.binary())], names=["shard", "filter"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy().view(np.uint64))
            n += len(batch)
            if n >= HELD:
                yield cut(held)
                held, n = [], 0
        if n:
            yield cut(held)

    return prints.select("fp").mapInArrow(work, "shard int, filter binary")


def merged_filters(filters: DataFrame) -> DataFrame:
    """(shard, filter), one row for each shard."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come in order of shard."""
        at, waiting, n = None, [], 0

        def closed() -> pa.RecordBatch:
            whole = QuotientFilter.merged(waiting, waiting[0].bits)
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([whole.to_bytes()], pa.binary())], names=["shard", "filter"])

        for batch in batches:
            for shard, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                if shard != at and waiting:
                    yield closed()
                    waiting, n = [], 0
                at = shard
                waiting.append(QuotientFilter.from_bytes(data.as_py()))
                n += len(waiting[-1].fps)
                if n >= HELD and len(waiting) > 1:
                    waiting = [QuotientFilter.merged(waiting, waiting[0].bits)]
                    n = 0  # what is merged already doesn't count, so that each merge adds HELD fingerprints
        if waiting:
            yield closed()

    return filters.repartition("shard").sortWithinPartitions("shard").mapInArrow(work, "shard int, filter binary")


def repeated(filters: DataFrame, shards: int) -> DataFrame:
    """(fp, n) of the fingerprints that merged filters count more than once."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                f = QuotientFilter.from_bytes(data.as_py())
                many = np.flatnonzero(f.counts > 1)
                fps = f.fps[many] | np.uint64(shard << (64 - shards))
                for i in range(0, len(many), 1 << 16):
                    yield pa.RecordBatch.from_arrays([pa.array(fps[i : i + (1 << 16)].view(np.int64)), pa.array(f.counts[many[i : i + (1 << 16)]])], names=["fp", "n"])

    return filters.mapInArrow(work, "fp bigint, n bigint")


def exact_duplicates(docs: DataFrame, bits: int = 64) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of docs.  ``bits``: of the fingerprints, fewer to test
    what happens to texts that share one."""
    texts = spread(docs.select("doc_id", "text")).select("doc_id", normalised(F.col("text")).alias("norm")).withColumn("fp", fingerprint(F.col("norm"), bits))
    prints = staged(texts.select("doc_id", "fp", F.sha2(F.col("norm"), 256).alias("sha"), F.monotonically_increasing_id().alias("row")), "exact-prints")
    total = prints.count()
    shards = max(FEWEST, (total >> SHARD).bit_length())
    many = staged(repeated(merged_filters(partition_filters(prints, shards)), shards).select("fp"), "exact-repeated")
    routed = F.broadcast(many) if many.limit(BROADCAST + 1).count() <= BROADCAST else many
    # The bytes: a group is one text; its first row is found among the small rows.
    same = texts.select("fp", "norm").join(routed, "fp", "left_semi").groupBy("fp", "norm").agg(F.count("*").alias("group_size"))
    same = same.select("fp", F.sha2(F.col("norm"), 256).alias("sha"), "group_size")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    firsts = prints.join(routed, "fp", "left_semi").groupBy("fp", "sha").agg(first)
    groups = staged(same.join(firsts, ["fp", "sha"]).select(F.col("fp").alias("of"), F.col("sha").alias("text"), "group_size", F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row")), "exact-groups")
    found = prints.join(groups, (F.col("fp") == F.col("of")) & (F.col("sha") == F.col("text")), "left")
    alone = F.col("of").isNull()
    return found.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"), F.col("sha").alias("text_sha256"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH texts AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY t)
"""
