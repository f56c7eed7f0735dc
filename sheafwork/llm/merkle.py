"""Operator 2, document fingerprints: a Merkle tree over the paragraphs and sections of a text.

Leaves are the paragraphs' sentences (cut after 8 words if longer, counted from the start of the sentence, so that an
edit moves no other leaf), then come paragraphs (lines), sections (runs of paragraphs that end at a blank line or after a
paragraph whose hash is 0 modulo 8) and the root.  Equal roots mean equal texts; :func:`diff` goes down the differing
branches of two fingerprints and names the edited paragraphs.  The fingerprint is the root and the leaf digests in order, sections
divided by ``/`` and paragraphs by ``.``, so that any two fingerprints can be compared without their texts.

Defined cases: a null text is the empty text; two empty texts have likeness 1, an empty and another one 0; rows with
equal ids are ordered by text; rows with a null id come last; a table of one row has that row as its next document;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheafwork.llm.shared import RANGE_PREFIX, in_ranges, table

#: A sentence or table cell with its closing marks, or up to 8 of its words.
LEAF = re.compile(r"\s*(?:[^\s.!?|]+\s*){1,8}[.!?|]*\S{0,8}\s*|\s*[.!?|]+\s*|\s+")
LEAF_HEX, ROOT_HEX, SECTION_EVERY = 6, 32, 8


def digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


@dataclass
class Tree:
    root: bytes
    #: sections -> paragraphs -> leaf digests
    sections: list[list[list[bytes]]]

    def fingerprint(self) -> str:
        return self.root.hex() + ":" + "/".join(".".join("".join(x.hex()[:LEAF_HEX] for x in p) for p in s) for s in self.sections)


def build_tree(text: str | None) -> Tree:
    sections: list[list[list[bytes]]] = [[]]
    tops: list[bytes] = []
    nodes: list[bytes] = []
    if text:
        for line in text.split("\n"):
            leaves = [digest(x.encode("utf-8", "surrogatepass")) for x in LEAF.findall(line)] or [digest(b"")]
            top = digest(b"".join(leaves))
            sections[-1].append(leaves)
            nodes.append(top)
            if not line.strip() or top[0] % SECTION_EVERY == 0:
                tops.append(digest(b"".join(nodes)))
                sections.append([])
                nodes = []
    if nodes:
        tops.append(digest(b"".join(nodes)))
    return Tree(digest(b"".join(tops) if text else b"empty"), [s for s in sections if s])


def leaves_of(fingerprint: str) -> list[str]:
    """The leaf digests of a fingerprint."""
    body = fingerprint[ROOT_HEX + 1 :].replace("/", "").replace(".", "")
    return [body[i : i + LEAF_HEX] for i in range(0, len(body), LEAF_HEX)]


def likeness(a: str, b: str) -> float:
    """Share of the leaves of two fingerprints that match, each leaf counted as often as it occurs: 1 for equal roots."""
    if a[:ROOT_HEX] == b[:ROOT_HEX]:
        return 1.0
    x, y = leaves_of(a), leaves_of(b)
    if not x or not y:
        return 0.0
    return 2 * (Counter(x) & Counter(y)).total() / (len(x) + len(y))


def differing(a: list[str], b: list[str]) -> tuple[list[int], list[int]]:
    """Places of a and of b that no common subsequence of equal nodes matches."""
    left, right = [], []
    for kind, i, j, k, m in SequenceMatcher(None, a, b, autojunk=False).get_opcodes():
        if kind != "equal":
            left += range(i, j)
            right += range(k, m)
    return left, right


def diff(a: str, b: str) -> list[tuple[str, int, int]]:
    """The paragraphs in which the texts of two fingerprints differ, as (side, section, paragraph): equal roots end the search,
    and only sections that differ are entered.  A node's digest is made of its leaves', which the fingerprints hold."""
    if a[:ROOT_HEX] == b[:ROOT_HEX]:
        return []
    x, y = ([s for s in p[ROOT_HEX + 1 :].split("/") if s] for p in (a, b))
    own, other = differing(x, y)
    paragraphs = [[(i, j, p) for i in some for j, p in enumerate(z[i].split("."))] for z, some in ((x, own), (y, other))]
    left, right = differing(*[[p for *_, p in some] for some in paragraphs])
    return [("a", *paragraphs[0][k][:2]) for k in left] + [("b", *paragraphs[1][k][:2]) for k in right]


def edit(text: str, following: str) -> str:
    """The last half of a text replaced by as many of the first code points of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def with_next(docs: DataFrame) -> DataFrame:
    """(bucket, doc_id, text, turn): documents dealt out in descending order of doc_id.  The first document of every
    bucket is repeated at the end of the bucket before (turn 1), so that each task sees every next document; the first
    bucket's goes to the end of the last.

    Only the heads of the buckets, an id and the start of a text each, come to the driver; texts are shuffled once."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    spark = docs.sparkSession
    n = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = in_ranges(docs, n, descending=True)
    # the place of a row in the order: null ids last, larger ids first, then the text, of which a prefix will do here
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.bitwise_not("doc_id").alias("id"), F.left("text", F.lit(RANGE_PREFIX)).alias("p"))
    heads = dealt.groupBy("bucket").agg(F.min(place).alias("head")).select("bucket", "head.*").collect()  # one row a bucket
    if not heads:
        return dealt.select("bucket", "doc_id", "text", F.lit(0).alias("turn"))
    order = sorted(r["bucket"] for r in heads)
    before = {b: order[i - 1] for i, b in enumerate(order)}  # of the first: the last
    firsts = spark.createDataFrame([(r["bucket"], r["id"], r["p"], before[r["bucket"]]) for r in heads], "at int, id bigint, p string, before int")
    rank = Window.partitionBy("before").orderBy("text")
    turned = (
        dealt.join(F.broadcast(firsts), (F.col("bucket") == F.col("at")) & F.bitwise_not("doc_id").eqNullSafe(F.col("id")) & (F.left("text", F.lit(RANGE_PREFIX)) == F.col("p")))
        .withColumn("rn", F.row_number().over(rank)).where("rn = 1")
        .select(F.col("before").alias("bucket"), "doc_id", "text", F.lit(1).alias("turn"))
    )
    both = dealt.select("bucket", "doc_id", "text", F.lit(0).alias("turn")).unionByName(turned)
    return both.repartitionById(n, F.col("bucket")).sortWithinPartitions("bucket", "turn", F.col("doc_id").desc_nulls_last(), "text")


OUT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None
    for batch in batches:
        rows = []
        for bucket, doc_id, text, turn in zip(*(batch.column(c).to_pylist() for c in ("bucket", "doc_id", "text", "turn"))):
            own = build_tree(text).fingerprint()
            if held is not None and held[0] == bucket:
                _, at, before, print_ = held
                edited = edit(before, text)
                changed = build_tree(edited).fingerprint()
                sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                rows.append((at, len(before), sha, print_, changed, likeness(print_, changed), likeness(print_, own)))
            held = (bucket, doc_id, text, own) if not turn else None
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), OUT)] if rows else [pa.array([], f.type) for f in OUT], schema=OUT)


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and how near it is to the edited text and to the
    next document in descending order of doc_id."""
    return with_next(docs).mapInArrow(fingerprint_batches, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
