"""Operator 9, SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints of 64 bits link at Hamming distance 3 or less.  Each bit position gets one of the 15 non-zero vectors of
{0,1}**4; for each of the 15 non-zero v, table v keeps the bits whose vector has an odd product with v.  Three or fewer
differing positions put three or fewer linear conditions on v, so some non-zero v meets all of them: in that table the
two fingerprints agree on every kept bit.  No pair within the radius is missed, whatever the data.

Work is done on distinct fingerprints.  Within a bucket (table, kept bits) a task compares up to BLOCK fingerprints and
returns links of a spanning forest, never all pairs; its memory is bounded by a strip of comparisons, however many of them are
links.  A bucket over BLOCK, that is a large group of near copies, is dealt anew by a second covering, over the bits that its table
left out: its members agree on all others, so again no pair is missed, and each part is smaller.  What is still over BLOCK
after that is cut into blocks, whose pairs are dealt out as tasks of their own, so every pair is compared in any case.
Components come from star contraction of the links.

Defined cases: a text without words (null, empty, white space) has fingerprint zero and links like any other; very long texts are
hashed whole, in strips of words; repeated rows share a fingerprint and so a component; rows with a null doc_id count for no
component's smallest id, and a component of such rows alone has a null id; an empty table gives an empty result; columns other than
doc_id and text are dropped, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafwork.llm.shared import spread, staged, table, word_strips

RADIUS, BITS, SHINGLE, SEED = 3, 64, 3, 42
#: Fingerprints of a bucket that one task compares at once, and comparisons of a strip.
BLOCK, STRIP = 4096, 1 << 20


def masks(radius: int = RADIUS, among: Sequence[int] = range(BITS)) -> list[int]:
    """The 2**(radius + 1) - 1 masks of the covering of some bit positions."""
    n = (1 << (radius + 1)) - 1
    return [sum(1 << i for k, i in enumerate(among) if ((k % n + 1) & v).bit_count() & 1) for v in range(1, n + 1)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    hash_ = xxhash.xxh64_intdigest
    ones, n, words = np.zeros(BITS, np.int64), 0, []
    for strip in word_strips(text):
        words = words[-(shingle - 1) :] + strip if shingle > 1 else strip
        for i in range(0, len(words) - shingle + 1, 1 << 14):
            some = words[i : i + (1 << 14) + shingle - 1]
            if shingle == 3:
                h = np.array([hash_(b"%b %b %b" % x, SEED) for x in zip(some, some[1:], some[2:])], "<u8")
            else:
                h = np.array([hash_(b" ".join(some[j : j + shingle]), SEED) for j in range(len(some) - shingle + 1)], "<u8")
            ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            n += len(h)
    if not n:  # fewer words than a shingle has
        return hash_(b" ".join(words), SEED) if words else 0
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id of its own type, fp): fp holds the fingerprint's bits as a signed number."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([simhash(t, shingle) for t in batch.column("text").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps)], names=["doc_id", "fp"])

    return spread(docs.select("doc_id", "text")).mapInArrow(work, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp bigint")


def forest(a: np.ndarray, b: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links within a (b None) or between a and b, as (smaller, larger) fingerprints.

    Links are found and joined strip by strip, so memory is that of one strip even where all pairs are links."""
    other = a if b is None else b
    nodes = a if b is None else np.concatenate([a, b])
    shift = 0 if b is None else len(a)
    parent = np.arange(len(nodes))
    step = max(1, STRIP // max(1, len(other)))
    for i in range(0, len(a), step):
        near = np.bitwise_count((a[i : i + step, None] ^ other[None, :]).view(np.uint64)) <= radius  # of signed numbers, it counts the absolute value
        x, y = np.nonzero(near)
        x, y = x + i, y + shift
        while True:  # label propagation with jumps; labels only fall
            p, q = parent[x], parent[y]
            low = np.minimum(p, q)
            new = parent.copy()
            for to in (x, y, p, q):
                np.minimum.at(new, to, low)
            new = new[new]
            if (new == parent).all():
                break
            parent = new
    while (parent[parent] != parent).any():
        parent = parent[parent]
    own = np.flatnonzero(parent != np.arange(len(nodes)))
    return [(min(p, q), max(p, q)) for p, q in zip(nodes[parent[own]].tolist(), nodes[own].tolist())]


def bucket(table_: Column, *parts: Column) -> Column:
    """A number for a table and kept bits; its lower four bits are the table's number.  Buckets whose numbers meet by chance are
    compared together, which finds no wrong link."""
    return F.shiftleft(F.xxhash64(table_, *parts), 4).bitwiseOR(table_.cast("bigint"))


def bucket_links(dealt: DataFrame, radius: int) -> DataFrame:
    """(a, b, bucket, block) of dealt (bucket, fp): links of the buckets up to BLOCK; of larger ones, the members come back as a,
    with their bucket and the block of BLOCK that they are in, and b is null."""
    out = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("bucket", pa.int64()), ("block", pa.int32())])

    def links_batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
        a, b = zip(*links) if links else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.nulls(len(a), pa.int64()), pa.nulls(len(a), pa.int32())], schema=out)

    def members_batch(of: int, fp: np.ndarray, block: int) -> pa.RecordBatch:
        n = len(fp)
        return pa.RecordBatch.from_arrays([pa.array(fp), pa.nulls(n, pa.int64()), pa.array(np.full(n, of, np.int64)), pa.array(np.full(n, block, np.int32))], schema=out)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come in order of bucket."""
        at, held, block = None, np.zeros(0, np.int64), 0
        found: list[tuple[int, int]] = []

        def close() -> Iterator[pa.RecordBatch]:
            if block:
                if len(held):
                    yield members_batch(at, held, block)
            elif len(held) > 1:
                found.extend(forest(held, None, radius))

        for batch in batches:
            of, fp = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)] if len(of) else [0]
            for i, j in zip(cuts, cuts[1:]):
                if int(of[i]) != at:
                    yield from close()
                    at, held, block = int(of[i]), np.zeros(0, np.int64), 0
                held = fp[i:j] if not len(held) else np.concatenate([held, fp[i:j]])
                while len(held) > BLOCK:
                    yield members_batch(at, held[:BLOCK], block)
                    held, block = held[BLOCK:], block + 1
            yield links_batch(found)
            found.clear()
        if at is not None:
            yield from close()
            yield links_batch(found)

    n = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = dealt.select("bucket", "fp").repartition(n, "bucket").sortWithinPartitions("bucket", "fp")
    return staged(ordered.mapInArrow(work, "a bigint, b bigint, bucket bigint, block int"), "simhash-links")


def edges(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): links that connect just the fingerprints within the radius of each other.  fps: distinct fp."""
    first = masks(radius)
    keys = F.array(*[bucket(F.lit(k), F.col("fp").bitwiseAND(F.lit(signed(m)))) for k, m in enumerate(first)])
    found = bucket_links(fps.select("fp", F.explode(keys).alias("bucket")), radius)
    links, large = found.where("b IS NOT NULL").select("a", "b"), found.where("b IS NULL")
    if large.isEmpty():
        return links.distinct()
    # The members of a large bucket agree on what its table kept; a second covering is over the bits that it left out.
    rest = [[signed(m) for m in masks(radius, [i for i in range(BITS) if not kept >> i & 1])] for kept in first]
    left_out = F.element_at(F.array(*[F.array(*map(F.lit, r)) for r in rest]), (F.col("bucket").bitwiseAND(15) + 1).cast("int"))
    keys = F.transform(left_out, lambda m, k: bucket(k, F.col("bucket"), F.col("a").bitwiseAND(m)))
    found = bucket_links(large.select(F.col("a").alias("fp"), F.explode(keys).alias("bucket")), radius)
    links, large = links.unionByName(found.where("b IS NOT NULL").select("a", "b")), found.where("b IS NULL")
    if large.isEmpty():
        return links.distinct()
    blocks = large.groupBy("bucket").agg((F.max("block") + 1).alias("blocks"))
    pairs = large.join(blocks, "bucket").select("bucket", F.col("a").alias("fp"), "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    pairs = pairs.select("bucket", "fp", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))

    def compare(key: tuple, data: pa.Table) -> pa.Table:
        fp, block = data.column("fp").to_numpy(), data.column("block").to_numpy()
        lo, hi = key[1].as_py(), key[2].as_py()
        got = forest(fp, None, radius) if lo == hi else forest(fp[block == lo], fp[block == hi], radius)
        a, b = zip(*got) if got else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return links.unionByName(pairs.groupBy("bucket", "lo", "hi").applyInArrow(compare, "a bigint, b bigint")).distinct()


def components(links: DataFrame, most: int = 60) -> DataFrame:
    """(node, root) for every node of links (a, b): root is the smallest node reachable.

    Alternating star contraction: a round joins every node to the least neighbour of its own neighbours, larger ones
    first, then smaller ones.  Rounds grow with the logarithm of a component's size; each is written to the shared folder,
    and the loop ends when a round changes nothing."""
    now = staged(links.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).where("lo <> hi").distinct(), "stars")
    for _ in range(most):
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(now.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("m").alias("lo"), F.col("v").alias("hi")).where("lo <> hi").distinct()
        down = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(down, "hi").select(F.col("m").alias("a"), F.explode(F.array("lo", "hi")).alias("b")).where("a <> b")
        after = staged(small.select(F.col("a").alias("lo"), F.col("b").alias("hi")).distinct(), "stars")
        sums = [x.agg(F.count("*"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first() for x in (now, after)]
        now = after
        if sums[0] == sums[1]:
            break
    else:
        raise RuntimeError(f"components did not settle in {most} rounds")
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of docs."""
    prints = staged(with_fingerprint(docs, shingle), "simhash")
    first = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = components(edges(first.select("fp"), radius))
    of = first.join(roots, first.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    least = of.groupBy("root").agg(F.min("least").alias("component_id"))
    named = of.join(least, "root").select(F.col("fp").alias("of"), "component_id")
    return prints.join(named, prints.fp == named.of).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").withColumn("doc_id", F.col("doc_id").cast("bigint")))
