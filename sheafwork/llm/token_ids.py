"""Operator 7, token-ID output: documents as Simple-8b coded token ids in files, and back.

A file holds the documents of one range of doc_id in ascending order::

    magic "SH8B" | u32 blocks | u64 documents | u64 ids | per block: u64 byte offset, u32 words, u32 ids
    | per document: i64 doc_id, u8 null flag, u64 ids | the words of all blocks

Numbers are little-endian.  Blocks hold 1024 ids (the last fewer), so any block can be decoded alone through its offset.
Texts are dealt out by ranges of (doc_id, text); each task writes the files of its ranges under a fresh name and returns
their paths, so that only what a finished task wrote is ever read.

Defined cases: a null text is the empty text and gives the end id alone; a null doc_id comes before all others; rows
with equal ids are ordered by text; no rows give no files and no result rows.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheafwork.llm.shared import fresh_path, in_ranges, open_fs, staged, table, write_file
from sheafwork.llm.simple8b import decode_blocks, encode

#: Ids of a block, and of so many blocks as are packed at once.
MAGIC, BLOCK, STRIDE = b"SH8B", 1024, 1 << 18
#: Blocks that are read and decoded at once.
AT_ONCE = 256
END_ID = 0
#: Pieces whose ids a worker keeps; when full it starts anew, so its memory is bounded.
CACHE = 1_000_000
#: Ids after which a file is closed.
FILE_IDS = 1 << 23
#: Documents of a file, so that a file of empty ones is bounded too, and rows that a reader hands on at a time.
FILE_DOCS, READ_ROWS = 1 << 18, 1 << 14
#: Punctuation that the pattern keeps together and apart from letters; without the apostrophe, which begins its own parts.
MARKS = ".,;:!?*&%$#|()+-=/"
# White_Space of the Unicode character database, the \s of the tokenizer's own pattern, and all of it but space and \n.
WHITE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
ODD = WHITE.replace(" ", "").replace("\n", "")
PIECE = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
#: Texts with other white space than single spaces and newlines between words, or at an end.
IRREGULAR = re.compile(f"[ \n][ \n]|[{ODD}]|^[ \n]|[ \n]$")
#: The same as single searches, which are many times as quick.
PAIRS = ("  ", " \n", "\n ", "\n\n")
ODD_CHARS = [chr(c) for c in range(0x3001) if re.match(f"[{ODD}]", chr(c))]
ODD_ASCII = [c for c in ODD_CHARS if c.isascii()]


def irregular(text: str) -> bool:
    """Whether a text, which is not empty, has white space other than single spaces and line feeds between other characters."""
    if text[0] in " \n" or text[-1] in " \n":
        return True
    for pair in PAIRS:
        if pair in text:
            return True
    for c in ODD_ASCII if text.isascii() else ODD_CHARS:
        if c in text:
            return True
    return False


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: bytes that print stand for themselves, the
    others for the code points from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + k) for k, b in enumerate(others)}


class PieceTokenizer(dict):
    """Ids of whole texts, from ids of their pieces; the dictionary has the packed ids of `` `` + key.

    A byte-level BPE never merges across the borders that its pattern sets, and such a border is always between white
    space and what follows it but for one space.  So a text's ids are those of its pieces (a run of other characters
    with the space before it, or white space), and a piece seen before needs no second encoding.  Texts that hold one
    of the added tokens, and all texts if the tokenizer is of another kind, are encoded whole."""

    def __init__(self, path: str) -> None:
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.dtype, self.code = (np.uint16, "H") if self.tokenizer.get_vocab_size() <= 1 << 16 else (np.uint32, "I")
        self.packed = [array(self.code, [i]).tobytes() for i in range(1 + max(self.tokenizer.get_vocab().values(), default=0))]
        self.marks: dict[str, bytes] = {}
        self.letters = byte_letters()
        #: the byte-level pre-tokenizer's pattern
        self.pattern = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
        probe = "a bc, it's 12\n\nß  x"
        level = isinstance(self.tokenizer.pre_tokenizer, pre_tokenizers.ByteLevel) and self.tokenizer.normalizer is None
        self.by_piece = level and [i for p in PIECE.findall(probe) for i in self.unpack(self.piece(p))] == self.whole(probe)

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def unpack(self, packed: bytes) -> list[int]:
        return np.frombuffer(packed, self.dtype).tolist()

    def merged(self, part: str) -> bytes:
        """What the pattern keeps together."""
        word = part.replace(" ", "Ġ") if part.isascii() and part.isprintable() else part.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.letters)
        return b"".join([self.packed[t.id] for t in self.model.tokenize(word)])

    def mark(self, part: str) -> bytes:
        """Of a run of punctuation."""
        if part not in self.marks:
            if len(self.marks) >= CACHE:
                self.marks.clear()
            self.marks[part] = self.merged(part)
        return self.marks[part]

    def piece(self, piece: str) -> bytes:
        if piece.isalpha():
            return self.merged(piece)
        base = piece.rstrip(MARKS)  # most pieces are a word and the marks behind it, which the pattern parts
        if base != piece and base.isalpha():
            return self.merged(base) + self.mark(piece[len(base) :])
        if base != piece and base[:1] == " " and base[1:].isalpha():
            return self[base[1:]] + self.mark(piece[len(base) :])
        return b"".join(self[p[1:]] if p[:1] == " " and len(p) > 1 and p[1:] != piece[1:] else self.merged(p) for p in self.pattern.findall(piece))

    def __missing__(self, key: str) -> bytes:
        if len(self) >= CACHE:
            self.clear()
        if key.isalpha():
            if key.isascii():
                out = b"".join([self.packed[t.id] for t in self.model.tokenize("Ġ" + key)])
            else:
                out = self.merged(f" {key}")
        elif (base := key.rstrip(MARKS)) != key and base.isalpha():  # a word and the marks behind it
            out = self[base] + self.mark(key[len(base) :])
        elif key[:1] == "\n":
            out = self.mark("\n") + self.piece(key[1:])
        else:
            out = self.piece(f" {key}")
        self[key] = out
        return out

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, self.dtype)
        if not self.by_piece or self.added and self.added.search(text):
            return np.array(self.whole(text), self.dtype)
        if irregular(text):
            packed = b"".join(self[p[1:]] if p[0] == " " and len(p) > 1 and not p.isspace() else self.piece(p) for p in PIECE.findall(text))
        else:
            first, *rest = text.replace("\n", " \n").split(" ")
            packed = self.piece(first) + b"".join(map(self.__getitem__, rest))
        return np.frombuffer(packed, self.dtype)


_TOKENIZERS: dict[str, PieceTokenizer] = {}


def tokenizer(path: str) -> PieceTokenizer:
    """One for each worker process, kept from task to task."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = PieceTokenizer(path)
    return _TOKENIZERS[path]


def pack_file(docs: list[tuple[int | None, np.ndarray]]) -> list[bytes]:
    """The bytes of a file with these (doc_id, ids)."""
    ids = np.concatenate([x for _, x in docs]) if docs else np.zeros(0, np.uint32)
    coded = [encode(ids[i : i + STRIDE], BLOCK) for i in range(0, len(ids), STRIDE)]
    words = np.concatenate([w for w, _ in coded]) if coded else np.zeros(0, np.uint64)
    counts = np.concatenate([c for _, c in coded]) if coded else np.zeros(0, np.int64)
    starts = np.arange(0, len(ids), BLOCK, dtype=np.int64)
    sizes = np.diff(np.append(starts, len(ids)))
    offset = len(MAGIC) + 20 + 16 * len(starts) + 17 * len(docs)
    blocks = b"".join(struct.pack("<QII", offset + 8 * int(at), int(w), int(n)) for at, w, n in zip(np.cumsum(counts) - counts, counts, sizes))
    index = b"".join(struct.pack("<qBQ", d or 0, d is None, len(x)) for d, x in docs)
    return [MAGIC + struct.pack("<IQQ", len(starts), len(docs), len(ids)), blocks, index, words.astype("<u8").tobytes()]


class TokenFile:
    """Reads a file's documents or single blocks by range reads."""

    def __init__(self, uri: str) -> None:
        fs, path = open_fs(uri)
        self.file = fs.open_input_file(path)
        head = self.file.read_at(24, 0)
        if head[:4] != MAGIC:
            raise ValueError(f"{uri} is no token file")
        blocks, docs, self.n_ids = struct.unpack("<IQQ", head[4:])
        raw = self.file.read_at(16 * blocks + 17 * docs, 24)
        self.blocks = np.frombuffer(raw, dtype=[("offset", "<u8"), ("words", "<u4"), ("ids", "<u4")], count=blocks)
        self.docs = np.frombuffer(raw, dtype=[("doc_id", "<i8"), ("null", "u1"), ("ids", "<u8")], count=docs, offset=16 * blocks)

    def decoded(self, first: int, end: int) -> np.ndarray:
        """The ids of blocks [first, end), by one range read."""
        b = self.blocks[first:end]
        words = np.frombuffer(self.file.read_at(8 * int(b["words"].sum()), int(b["offset"][0])), "<u8")
        return decode_blocks(words, b["words"], b["ids"])

    def ids(self, start: int, end: int) -> np.ndarray:
        """The ids [start, end) of the file."""
        if start >= end:
            return np.zeros(0, np.uint64)
        first = start // BLOCK
        return self.decoded(first, (end - 1) // BLOCK + 1)[start - first * BLOCK : end - first * BLOCK]

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """All documents in order; a block is decoded once, many at a time."""
        held, k = np.zeros(0, np.uint64), 0
        for doc_id, null, n in self.docs.tolist():
            while len(held) < n:
                held = np.concatenate([held, self.decoded(k, k + AT_ONCE)])
                k += AT_ONCE
            yield None if null else doc_id, held[:n]
            held = held[n:]


def write_token_files(docs: DataFrame, tokenizer_path: str, out: str) -> DataFrame:
    """Writes the files and returns the manifest (bucket, part, path, docs, ids), one row per file; a range of doc_id has its
    files in the order of part.  A file is closed at FILE_IDS ids or FILE_DOCS documents, which is also what a task holds."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = in_ranges(docs, n).repartitionById(n, F.col("bucket")).sortWithinPartitions("bucket", F.col("doc_id").asc_nulls_first(), "text").select("bucket", "doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, at, part, size, held = tokenizer(tokenizer_path), None, 0, 0, []

        def flush() -> pa.RecordBatch:
            path = f"{out}/ids-{at:06d}-{part:06d}-{uuid.uuid4().hex}.s8b"
            write_file(path, pack_file(held))
            return pa.RecordBatch.from_pydict({"bucket": pa.array([at], pa.int32()), "part": pa.array([part], pa.int32()), "path": [path], "docs": [len(held)], "ids": [size]})

        for batch in batches:
            for bucket, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("bucket", "doc_id", "text"))):
                if held and (bucket != at or size >= FILE_IDS or len(held) >= FILE_DOCS):
                    yield flush()
                    part, size, held = (part + 1 if bucket == at else 0), 0, []
                at = bucket
                ids = np.append(coder.encode(text), coder.dtype(END_ID))
                held.append((doc_id, ids))
                size += len(ids)
        if held:
            yield flush()

    return staged(dealt.mapInArrow(write, "bucket int, part int, path string, docs bigint, ids bigint"), "token-manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files.  The manifest has one row per file; what comes before a
    range is added up on the driver (one row a range), what comes before a file within its range in Spark."""
    spark = manifest.sparkSession
    ranges = manifest.groupBy("bucket").agg(F.sum("ids").alias("ids"), F.count("*").alias("files")).orderBy("bucket").collect()
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    if not ranges:
        return spark.createDataFrame([], schema)
    begin = np.cumsum([0, *[r["ids"] for r in ranges]]).tolist()
    starts = spark.createDataFrame([(r["bucket"], first) for r, first in zip(ranges, begin)], "bucket int, first bigint")
    before = F.coalesce(F.sum("ids").over(Window.partitionBy("bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    where = manifest.withColumn("before", before).join(F.broadcast(starts), "bucket").select("path", (F.col("first") + F.col("before")).alias("first"))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, first in zip(batch.column("path").to_pylist(), batch.column("first").to_pylist()):
                rows, start = [], first
                for doc_id, ids in TokenFile(path).documents():
                    rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    start += len(ids)
                    if len(rows) >= READ_ROWS:
                        yield batch_of(rows)
                        rows = []
                if rows:
                    yield batch_of(rows)

    return where.repartition(min(sum(r["files"] for r in ranges), 20_000)).mapInArrow(read, schema)


def encode_documents(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """Writes docs as token files in the shared folder and returns what is read from them."""
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("byte_bpe_50k.json")
    return read_token_files(write_token_files(docs, str(tokenizer_path), fresh_path(docs.sparkSession, "token-ids")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"))
