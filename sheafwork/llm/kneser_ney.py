"""Operator 4, language-model scoring: interpolated modified Kneser-Ney, counted in Spark, held in sorted hash arrays.

Words are 64-bit hashes.  Texts are cut into tokens once and kept as token chunks in the shared folder; all later steps
read those, so that a chunk is the same whenever it is read.

*Counting.*  Map tasks add up the n-grams of a chunk and deal them to buckets by the hash of their context (all but the last
word); those of frequent words are dealt by their last word too, so that no bucket gets all followers of one word.  A file
holds many buckets, one after another, with a directory at its end.  A file's task adds up one bucket at a time, appends it
as an array of ascending n-gram hashes with their counts, and hands on what the table of the next shorter n-grams needs:
the n-grams without their first word (raw counts, and 1 as continuation count), and for each context what its followers add
up to (their counts, and how many were seen once, twice and more).  These are added up in the same way, down to single
words.  All orders are one job.

*Scoring.*  Each chunk asks for its different n-grams, dealt to the file that has them.  A worker memory-maps that one file
and answers bucket by bucket for all chunks (in a store that can't be mapped, it reads each bucket by its range).  The
answers meet at the chunk, in the order of its questions.

The query uses order 2.  Order 3 gives the same code one more pass; on these texts four fifths of all trigrams occur once,
and their arrays alone would pass the disk budget (see the README).

Defined cases: null and empty texts are the end token alone; without training texts every token is unknown and has
probability 1; rows with a null id are not held out, so they teach; repeated rows count as often as they occur.  Counts have
64 bits (one byte in arrays, with a list of the larger ones beside), so none overflows.
"""

from __future__ import annotations

import json
import mmap
import uuid
from collections import OrderedDict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafwork.llm.shared import byte_words, fold, fresh_path, mix64, open_fs, read_range, shuffles_dropped, staged, table

ORDER = 2
#: Hashes of the marks before the first and after the last word of a text; 0 is no word's hash but by chance.
BEGIN, END = np.uint64(1), np.uint64(2)
#: Characters of a token chunk (one longer text is a chunk of its own), words whose hash a worker keeps, tokens of training
#: text for each bucket, files of a table (beyond that many buckets, files hold several), files a worker keeps mapped.
CHUNK_CHARS, KEPT_WORDS, BUCKET_TOKENS, MOST_FILES, MOST_MAPPED = 10_000_000, 300_000, 1_250_000, 10_000, 64
#: Words of more than this share of the tokens are dealt with their followers, or of more than 1 / (4 x buckets) if that is
#: larger: at most some 10**6 words.
LEAST_SHARE = 1e-6
#: What a table counts: of an n-gram, its raw and continuation counts, then the sums over its followers.
COUNTS = ("raw", "cont", "total", "one", "two", "more")


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        h = xxhash.xxh64_intdigest(word, 7)
        self[word] = h
        return h


_HASHES = WordHashes()


def hashes_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, each text's end mark included, and the number of tokens of each text."""
    get = _HASHES.__getitem__
    flat: list[int] = []
    sizes = np.empty(len(texts), np.int64)
    for i, t in enumerate(texts):
        words = byte_words(t)
        flat.extend(map(get, words))
        flat.append(int(END))
        sizes[i] = len(words) + 1
    return np.array(flat, np.uint64), sizes


def context_columns(tokens: np.ndarray, sizes: np.ndarray, order: int) -> list[np.ndarray]:
    """The order words of the n-gram that ends at each token: BEGIN stands before a text's first word."""
    first = np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = np.arange(len(tokens))
    cols = []
    for back in range(order - 1, 0, -1):
        c = np.full(len(tokens), BEGIN, np.uint64)
        ok = at - back >= first
        c[ok] = tokens[at[ok] - back]
        cols.append(c)
    return [*cols, tokens]


def join_hash(cols: list[np.ndarray]) -> np.ndarray:
    """One hash for each row of words; that of one word is the word itself."""
    h = cols[0]
    with np.errstate(over="ignore"):
        for c in cols[1:]:
            h = mix64(h * np.uint64(0x2545F4914F6CDD1D) + c)
    return h


# -- arrays on their way -------------------------------------------------------------------------------------------------


def added_up(cols: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """(hashes, cols, counts): equal rows of words together, in the order of their hashes; counts summed."""
    key = join_hash(cols)
    if not len(key):
        return key, cols, counts
    order = np.argsort(key, kind="stable")
    key = key[order]
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[new], [c[order[new]] for c in cols], [np.add.reduceat(c[order], new) for c in counts]


def small_counts(c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts as bytes; those of 255 and more as 255, and their places and values beside."""
    at = np.flatnonzero(c >= 255)
    return np.minimum(c, 255).astype(np.uint8), at.astype("<u8"), c[at].astype("<u8")


def coded(c: np.ndarray) -> bytes:
    small, at, big = small_counts(c)
    return np.array([len(at)], "<u8").tobytes() + at.tobytes() + big.tobytes() + small.tobytes()


def decoded(data: bytes | memoryview, n: int, at: int) -> tuple[np.ndarray, int]:
    """(counts, where they end) of n coded counts that begin at a place."""
    m = int(np.frombuffer(data, "<u8", 1, at)[0])
    c = np.frombuffer(data, np.uint8, n, at + 8 + 16 * m).astype(np.int64)
    c[np.frombuffer(data, "<u8", m, at + 8)] = np.frombuffer(data, "<u8", m, at + 8 + 8 * m)
    return c, at + 8 + 16 * m + n


def packed(cols: list[np.ndarray], counts: list[np.ndarray]) -> bytes:
    """N-grams that stand together by context: each context once, with the number of its last words."""
    n = len((cols + counts)[0])
    out = [np.array([n], "<u8").tobytes()]
    if len(cols) > 1:
        new = np.concatenate([[True], np.any([c[1:] != c[:-1] for c in cols[:-1]], axis=0)]) if n else np.zeros(0, bool)
        begin = np.flatnonzero(new)
        out += [np.array([len(begin)], "<u8").tobytes(), *(c[begin].astype("<u8").tobytes() for c in cols[:-1]), coded(np.diff(np.append(begin, n)))]
    out += [c.astype("<u8").tobytes() for c in cols[-1:]] + [coded(c) for c in counts]
    return b"".join(out)


def unpacked(data: bytes, n_cols: int, n_counts: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    n, at = int(np.frombuffer(data, "<u8", 1)[0]), 8
    cols, counts = [], []
    if n_cols > 1:
        m, at = int(np.frombuffer(data, "<u8", 1, at)[0]), at + 8
        own = [np.frombuffer(data, "<u8", m, at + 8 * m * k) for k in range(n_cols - 1)]
        times, at = decoded(data, m, at + 8 * m * (n_cols - 1))
        cols = [np.repeat(c, times) for c in own]
    if n_cols:
        cols.append(np.frombuffer(data, "<u8", n, at))
        at += 8 * n
    for _ in range(n_counts):
        c, at = decoded(data, n, at)
        counts.append(c)
    return cols, counts


def together(parts: list[bytes], n_cols: int, n_counts: int) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """added_up() of packed arrays."""
    some = [unpacked(x, n_cols, n_counts) for x in parts]
    parts.clear()
    return added_up([np.concatenate(c) for c in zip(*[p[0] for p in some])], [np.concatenate(c) for c in zip(*[p[1] for p in some])])


def among(x: np.ndarray, sorted_: np.ndarray) -> np.ndarray:
    if not len(sorted_):
        return np.zeros(len(x), bool)
    return sorted_[np.minimum(np.searchsorted(sorted_, x), len(sorted_) - 1)] == x


@dataclass(frozen=True)
class Layout:
    """How n-grams are dealt: equal ranges of hashes are buckets, runs of buckets are files."""

    buckets: int
    files: int
    frequent: np.ndarray  # words, ascending

    def bucket(self, cols: list[np.ndarray], key: np.ndarray) -> np.ndarray:
        by = key
        if len(cols) > 1:
            split = np.logical_and.reduce([among(c, self.frequent) for c in cols[:-1]])
            by = np.where(split, key, join_hash(cols[:-1]))
        return ((by >> np.uint64(32)) * np.uint64(self.buckets)) >> np.uint64(32)

    def file(self, bucket: int) -> int:
        return bucket * self.files // self.buckets


def runs(x: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(value, begin, end) of the runs of equal values; only values that occur cost anything."""
    if len(x):
        cut = np.concatenate([[0], np.flatnonzero(x[1:] != x[:-1]) + 1, [len(x)]])
        yield from zip(x[cut[:-1]].tolist(), cut[:-1].tolist(), cut[1:].tolist())


SENT = pa.schema([("file", pa.int32()), ("what", pa.string()), ("bucket", pa.int64()), ("data", pa.binary())])
SENT_DDL = "file int, what string, bucket bigint, data binary"


def sent(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), SENT)] if rows else [pa.array([], f.type) for f in SENT], schema=SENT)


def dealt(key: np.ndarray, cols: list[np.ndarray], counts: list[np.ndarray], layout: Layout) -> pa.RecordBatch:
    """One row for each bucket that gets something, its n-grams in the order of their contexts."""
    order = np.argsort(join_hash(cols[:-1]), kind="stable") if len(cols) > 1 else np.arange(len(key))
    bucket = layout.bucket(cols, key)[order]
    by = np.argsort(bucket, kind="stable")
    order, bucket = order[by], bucket[by]
    cols, counts = [c[order] for c in cols], [c[order] for c in counts]
    return sent([(layout.file(b), f"grams{len(cols)}", b, packed([c[s:e] for c in cols], [c[s:e] for c in counts])) for b, s, e in runs(bucket)])


# -- token chunks --------------------------------------------------------------------------------------------------------


@dataclass
class Chunk:
    ids: list[int | None]
    learn: np.ndarray  # of each text: whether the model learns from it
    sizes: np.ndarray
    words: np.ndarray  # the different ones, ascending
    index: np.ndarray  # of each token: its place among the words

    def to_bytes(self) -> bytes:
        """Tokens as places in the list of words, frequent ones first, in byte planes that compress well."""
        order = np.argsort(-np.bincount(self.index, minlength=len(self.words)), kind="stable")
        place = np.empty(len(order), "<u4")
        place[order] = np.arange(len(order))
        planes = pa.compress(np.ascontiguousarray(place[self.index].view(np.uint8).reshape(-1, 4).T).tobytes(), codec="zstd", asbytes=True)
        n = len(self.ids)
        return b"".join([np.array([n, len(self.index), len(self.words)], "<u8").tobytes(), np.array([i or 0 for i in self.ids], "<i8").tobytes(), bytes(i is None for i in self.ids),
                         self.learn.astype(np.uint8).tobytes(), self.sizes.astype("<u8").tobytes(), self.words[order].astype("<u8").tobytes(), planes])

    @classmethod
    def from_bytes(cls, data: bytes) -> Chunk:
        n, n_tokens, n_own = np.frombuffer(data, "<u8", 3).tolist()
        at = 24
        ids, null = np.frombuffer(data, "<i8", n, at).tolist(), data[at + 8 * n : at + 9 * n]
        at += 9 * n
        learn, sizes, own = np.frombuffer(data, np.uint8, n, at).astype(bool), np.frombuffer(data, "<u8", n, at + n).astype(np.int64), np.frombuffer(data, "<u8", n_own, at + 9 * n)
        planes = np.frombuffer(pa.decompress(data[at + 9 * n + 8 * n_own :], 4 * n_tokens, codec="zstd", asbytes=True), np.uint8)
        order = np.argsort(own)
        place = np.empty(n_own, np.int64)
        place[order] = np.arange(n_own)
        return cls([None if x else i for i, x in zip(ids, null)], learn, sizes, own[order], place[np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()])

    @property
    def tokens(self) -> np.ndarray:
        return self.words[self.index]

    def learned(self) -> np.ndarray:
        """Of each token: whether the model learns from its text."""
        return np.repeat(self.learn, self.sizes)


CHUNK_DDL = "path string, at bigint, length bigint, tokens bigint, learned bigint"


def tokenised(docs: DataFrame, learn: Column | None = None) -> DataFrame:
    """Writes docs (doc_id if there is one, text) as token chunks; one row (path, at, length, tokens, learned) for each.  The
    model learns from the rows where learn is true, from all if it isn't given."""
    folder = fresh_path(docs.sparkSession, "tokens")
    doc_id = F.col("doc_id").cast("bigint") if "doc_id" in docs.columns else F.lit(None).cast("bigint")
    rows = docs.select(doc_id.alias("doc_id"), "text", (F.lit(True) if learn is None else F.coalesce(learn, F.lit(False))).alias("learn"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, out, at = f"{folder}/{uuid.uuid4().hex}.tok", None, 0
        held: list[tuple] = []
        size = 0

        def chunk() -> pa.RecordBatch:
            nonlocal out, at
            ids, texts, learns = zip(*held)
            tokens, sizes = hashes_of(texts)
            own = np.array(learns, bool)
            data = Chunk(list(ids), own, sizes, *np.unique(tokens, return_inverse=True)).to_bytes()
            if out is None:
                fs, local = open_fs(path)
                fs.create_dir(local.rpartition("/")[0], recursive=True)
                out = fs.open_output_stream(local)
            out.write(data)
            row = {"path": [path], "at": [at], "length": [len(data)], "tokens": [len(tokens)], "learned": [int(sizes[own].sum())]}
            at += len(data)
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "learn"))):
                held.append(row)
                size += len(row[1] or "")
                if size >= CHUNK_CHARS:
                    yield chunk()
                    held, size = [], 0
        if held:
            yield chunk()
        if out is not None:
            out.close()

    return staged(rows.mapInArrow(work, CHUNK_DDL), "token-chunks")


def read_chunk(path: str, at: int, length: int) -> Chunk:
    return Chunk.from_bytes(read_range(path, at, length))


def spread(chunks: DataFrame) -> DataFrame:
    """The chunks' rows (path, at, length), few to a task."""
    return chunks.select("path", "at", "length").repartition(max(1, min(chunks.count(), 20_000)))


# -- tables in files -----------------------------------------------------------------------------------------------------


class TableWriter:
    """A table's file: for each bucket its ascending keys and its coded counts, at the end the directory and where that is."""

    def __init__(self, folder: str, table: str, file: int) -> None:
        self.path, self.at, self.directory = f"{folder}/{table}-{file}-{uuid.uuid4().hex}.arr", 0, []
        fs, local = open_fs(self.path)
        fs.create_dir(local.rpartition("/")[0], recursive=True)
        self.out = fs.open_output_stream(local)

    def add(self, bucket: int, key: np.ndarray, counts: list[np.ndarray]) -> None:
        data, ends = key.astype("<u8").tobytes(), []
        for c in counts:
            ends.append(len(data))
            small, at, big = small_counts(c)
            data += np.array([len(at)], "<u8").tobytes() + at.tobytes() + big.tobytes() + small.tobytes() + bytes(-len(small) % 8)
        self.out.write(data)
        self.directory.append((bucket, self.at, len(data), len(key), *ends, *[0] * (len(COUNTS) - len(ends))))
        self.at += len(data)

    def close(self) -> None:
        self.out.write(np.array(self.directory, "<u8").tobytes())
        self.out.write(np.array([self.at, len(self.directory)], "<u8").tobytes())
        self.out.close()


class TableFile:
    """Finds keys in a table's file, which is memory-mapped where the store allows it."""

    def __init__(self, path: str) -> None:
        self.path, self.map = path, None
        fs, local = open_fs(path)
        if fs.type_name == "local":
            with open(local, "rb") as f:
                self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
            size = len(self.map)
        else:
            size = fs.get_file_info(local).size
        begin, n = np.frombuffer(self.data(size - 16, 16), "<u8").tolist()
        width = 4 + len(COUNTS)
        self.directory = {b: where for b, *where in np.frombuffer(self.data(begin, 8 * width * n), "<u8").reshape(-1, width).tolist()}

    def data(self, at: int, length: int) -> bytes | memoryview:
        return memoryview(self.map)[at : at + length] if self.map is not None else read_range(self.path, at, length)

    def find(self, bucket: int, wanted: np.ndarray, n_counts: int) -> list[np.ndarray]:
        """The counts of wanted keys of one bucket, 0 where a key isn't there."""
        out = [np.zeros(len(wanted), np.int64) for _ in range(n_counts)]
        if bucket not in self.directory:
            return out
        at, length, n, *ends = self.directory[bucket]
        data = self.data(at, length)
        keys = np.frombuffer(data, "<u8", n)
        place = np.minimum(np.searchsorted(keys, wanted), n - 1)
        hit = np.flatnonzero(keys[place] == wanted)
        place = place[hit]
        for c, end in zip(out, ends):
            m = int(np.frombuffer(data, "<u8", 1, end)[0])
            found = np.frombuffer(data, np.uint8, n, end + 8 + 16 * m)[place].astype(np.int64)
            full = np.flatnonzero(found == 255)
            if len(full):
                where, values = np.frombuffer(data, "<u8", m, end + 8), np.frombuffer(data, "<u8", m, end + 8 + 8 * m)
                found[full] = values[np.searchsorted(where, place[full])]
            c[hit] = found
        return out


_MAPPED: OrderedDict[str, TableFile] = OrderedDict()


def table_file(path: str) -> TableFile:
    """An open file; a worker keeps the MOST_MAPPED last used, the others' maps end with their last array."""
    if path in _MAPPED:
        _MAPPED.move_to_end(path)
    else:
        _MAPPED[path] = TableFile(path)
        while len(_MAPPED) > MOST_MAPPED:
            _MAPPED.popitem(last=False)
    return _MAPPED[path]


# -- counting ------------------------------------------------------------------------------------------------------------


@dataclass
class Model:
    order: int
    layout: Layout
    #: by length of the n-grams and file: its path
    files: dict[int, dict[int, str]] = field(default_factory=dict)
    discounts: dict[int, tuple[float, float, float]] = field(default_factory=dict)
    tokens: int = 0  # of the training texts
    vocabulary: int = 0  # different ones
    bigrams: int = 0  # sum of the continuation counts
    kinds: tuple[int, int, int] = (0, 0, 0)  # words with continuation count 1, 2, more

    def columns(self, n: int) -> int:
        """Counts of the table of n-grams: the longest have their raw counts alone."""
        return 1 if n == self.order else len(COUNTS)


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Of counts 1, 2 and more, from the numbers of n-grams that occur 1, 2, 3 and 4 times."""
    n1, n2, n3, n4 = n
    if not n1 or not n2:
        return (0.5, 0.5, 0.5)
    y = n1 / (n1 + 2 * n2)
    d = [k - (k + 1) * y * b / a if a else 0.5 * k for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return tuple(min(max(x, 0.05), k) for x, k in zip(d, (1.0, 2.0, 3.0)))


def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, list[bytes]]]:
    """(what, file, bucket, data) of rows that are sorted by what and bucket."""
    at, held = None, []
    for batch in batches:
        for file, what, bucket, data in zip(*(batch.column(c).to_pylist() for c in SENT.names)):
            if at is not None and at != (what, file, bucket):
                yield *at, held
                held = []
            at = (what, file, bucket)
            held.append(data)
    if held:
        yield *at, held


def frequent_words(chunks: DataFrame, share: float) -> np.ndarray:
    """Words of more than this share of the tokens to learn from, and BEGIN.  A word is reported by the chunks where it has
    that share, so at most 1 / share of them come from each; what chunks below it hold isn't added, and the number only decides
    where n-grams go."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for where in zip(*(batch.column(c).to_pylist() for c in ("path", "at", "length"))):
                chunk = read_chunk(*where)
                often = np.bincount(chunk.index[chunk.learned()], minlength=len(chunk.words))
                mine = np.flatnonzero(often > share * max(1, often.sum()))
                yield pa.RecordBatch.from_pydict({"word": pa.array(chunk.words[mine].view(np.int64)), "n": pa.array(often[mine])})

    total = chunks.agg(F.sum("learned")).first()[0] or 0
    found = spread(chunks).mapInArrow(work, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") > share * total)
    return np.unique(np.append(found.select("word").toPandas()["word"].to_numpy(np.int64).view(np.uint64), BEGIN))  # at most 1 / share


def count_chunks(chunks: DataFrame, order: int = ORDER) -> Model:
    """The model of the chunks' texts to learn from."""
    if order < 2:
        raise ValueError("the order has to be 2 or more")
    spark = chunks.sparkSession
    folder = fresh_path(spark, "kneser-ney")
    learned = chunks.agg(F.sum("learned")).first()[0] or 0
    buckets = max(1, -(-int(learned) // BUCKET_TOKENS))
    layout = Layout(buckets, min(buckets, MOST_FILES), frequent_words(chunks, max(1 / (4 * buckets), LEAST_SHARE)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for where in zip(*(batch.column(c).to_pylist() for c in ("path", "at", "length"))):
                chunk = read_chunk(*where)
                tokens, sizes = chunk.tokens[chunk.learned()], chunk.sizes[chunk.learn]
                if len(tokens):
                    yield dealt(*added_up(context_columns(tokens, sizes, order), [np.ones(len(tokens), np.int64)]), layout)

    def adder(level: int):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            writer, at_file, facts = None, 0, np.zeros(7, np.int64)

            def told() -> pa.RecordBatch:
                writer.close()
                return sent([(0, "told", 0, json.dumps([level, at_file, writer.path, *facts.tolist()]).encode())])

            for what, file, bucket, parts in groups(batches):
                if what == "told":
                    yield sent([(0, what, 0, x) for x in parts])
                    continue
                if writer is None or at_file != file:
                    if writer is not None:
                        yield told()
                    writer, at_file, facts = TableWriter(folder, what, file), file, np.zeros(7, np.int64)
                key, cols, counts = together(parts, level, 1 if level == order else len(COUNTS))
                writer.add(bucket, key, counts)
                raw, adjusted = counts[0], counts[0 if level == order else 1]
                facts += [int((raw > 0).sum()), *(int((adjusted == i).sum()) for i in (1, 2, 3, 4)), int(raw.sum()), int(adjusted.sum())]
                if level > 1:
                    there = raw > 0
                    cols, raw, adjusted = [c[there] for c in cols], raw[there], adjusted[there]
                    one, none = np.ones(len(raw), np.int64), np.zeros(len(raw), np.int64)
                    yield dealt(*added_up(cols[1:], [raw, one, none, none, none, none]), layout)
                    yield dealt(*added_up(cols[:-1], [none, none, adjusted, *((x).astype(np.int64) for x in (adjusted == 1, adjusted == 2, adjusted > 2))]), layout)
            if writer is not None:
                yield told()

        return work

    rows = spread(chunks).mapInArrow(cut, SENT_DDL)
    for level in range(order, 0, -1):
        rows = rows.repartitionById(layout.files, F.col("file")).sortWithinPartitions("what", "file", "bucket").mapInArrow(adder(level), SENT_DDL)
    with shuffles_dropped(spark):
        told = [json.loads(r["data"]) for r in rows.where("what = 'told'").select("data").collect()]  # one row a file
    model = Model(order, layout)
    for k in range(1, order + 1):
        model.files[k] = {file: path for n, file, path, *_ in told if n == k}
        facts = [sum(t[3 + i] for t in told if t[0] == k) for i in range(7)]
        model.discounts[k] = discounts(facts[1:5])
        if k == 1:
            model.vocabulary, model.tokens, model.bigrams = facts[0], facts[5], facts[6]
            model.kinds = (facts[1], facts[2], facts[0] - facts[1] - facts[2])
    return model


def count(docs: DataFrame, order: int = ORDER) -> Model:
    """The model of all texts of docs."""
    return count_chunks(tokenised(docs), order)


# -- scoring -------------------------------------------------------------------------------------------------------------


@dataclass
class Question:
    """What texts ask of the table of n-grams: different keys in the order of (bucket, key)."""

    n: int
    keys: np.ndarray
    buckets: np.ndarray
    own: np.ndarray  # of each token: the place of the n-gram that ends at it
    context: np.ndarray | None  # and of the one that ends before it


def questions(model: Model, words: np.ndarray, index: np.ndarray, sizes: np.ndarray) -> Iterator[Question]:
    """From short to long."""
    cols = context_columns(words[index], sizes, model.order)
    for n in range(1, model.order + 1):
        if n == 1:
            keys = np.union1d(words, [BEGIN])
            parts = [keys]
            own = np.searchsorted(keys, words)[index]
            before = np.concatenate([[0], own[:-1]])
            before[np.cumsum(sizes) - sizes] = np.searchsorted(keys, BEGIN)
        else:
            parts = cols[model.order - n :]
            if n < model.order:
                parts = [np.concatenate(x) for x in zip(parts, cols[model.order - n - 1 : -1])]
            keys, first, place = np.unique(join_hash(parts), return_index=True, return_inverse=True)
            parts, own, before = [c[first] for c in parts], place[: len(index)], place[len(index) :]
        bucket = model.layout.bucket(parts, keys)
        order = np.argsort(bucket, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        yield Question(n, keys[order], bucket[order], rank[own], rank[before] if n < model.order else None)


def discount_of(c: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.where(c == 0, 0.0, np.where(c == 1, d[0], np.where(c == 2, d[1], d[2])))


def probabilities(model: Model, words: np.ndarray, index: np.ndarray, sizes: np.ndarray, answer: Callable[[Question], list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Of each token: its raw count in training, and its probability after the words before; answer gives a table's counts."""
    p, known, total, gamma = np.ones(len(index)), None, None, None
    for q in questions(model, words, index, sizes):
        found = answer(q)
        d = model.discounts[q.n]
        if q.n == 1:
            known = found[0][q.own]
            if not model.bigrams:
                return known, p
            left = sum(x * n for x, n in zip(d, model.kinds)) / model.bigrams
            p = (np.maximum(found[1] - discount_of(found[1], d), 0) / model.bigrams + left / (model.vocabulary + 1))[q.own]
        else:
            c = found[0 if q.n == model.order else 1]
            p = np.maximum(c - discount_of(c, d), 0)[q.own] / total + gamma * p
        if q.n < model.order:
            e = model.discounts[q.n + 1]
            whole = np.maximum(found[2], 1)
            total = whole[q.context]
            gamma = np.where(found[2] > 0, (e[0] * found[3] + e[1] * found[4] + e[2] * found[5]) / whole, 1.0)[q.context]
    return known, p


def score_tokens(model: Model, tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """probabilities() by looking into all files at hand: for a few texts."""

    def answer(q: Question) -> list[np.ndarray]:
        found = []
        for b, s, e in runs(q.buckets):
            found.append(table_file(model.files[q.n][model.layout.file(b)]).find(b, q.keys[s:e], model.columns(q.n)))
        return [np.concatenate(c) for c in zip(*found)]

    return probabilities(model, *np.unique(tokens, return_inverse=True), sizes, answer)


def score_chunks(chunks: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of all texts of chunks."""
    layout = model.layout
    n_chunks = max(1, min(chunks.count(), 20_000))
    where = ["path", "at", "length"]
    asked = "file int, n int, bucket bigint, path string, at bigint, length bigint, data binary"

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in zip(*(batch.column(c).to_pylist() for c in where)):
                chunk = read_chunk(*at)
                for q in questions(model, chunk.words, chunk.index, chunk.sizes):
                    cut = list(runs(q.buckets))
                    yield pa.RecordBatch.from_pydict({
                        "file": pa.array([layout.file(b) for b, *_ in cut], pa.int32()), "n": pa.array([q.n] * len(cut), pa.int32()), "bucket": pa.array([b for b, *_ in cut], pa.int64()),
                        **{c: [x] * len(cut) for c, x in zip(where, at)}, "data": pa.array([packed_keys(q.keys[s:e]) for _, s, e in cut], pa.binary()),
                    })

    def reply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = []
            for file, n, bucket, keys in zip(*(batch.column(c).to_pylist() for c in ("file", "n", "bucket", "data"))):
                wanted, path = unpacked_keys(keys), model.files[n].get(file)
                data.append(packed([], table_file(path).find(bucket, wanted, model.columns(n)) if path else [np.zeros(len(wanted), np.int64)] * model.columns(n)))
            yield batch.set_column(batch.schema.get_field_index("data"), "data", pa.array(data, pa.binary()))

    def total(key: tuple, rows: pa.Table) -> pa.Table:
        chunk = read_chunk(*(k.as_py() for k in key))
        parts: dict[int, list[tuple[int, bytes]]] = {}
        for n, b, x in zip(*(rows.column(c).to_pylist() for c in ("n", "bucket", "data"))):
            parts.setdefault(n, []).append((b, x))

        def answer(q: Question) -> list[np.ndarray]:
            some = [unpacked(x, 0, model.columns(q.n))[1] for _, x in sorted(parts.pop(q.n))]
            return [np.concatenate(c) for c in zip(*some)]

        raw, p = probabilities(model, chunk.words, chunk.index, chunk.sizes, answer)
        first = np.cumsum(chunk.sizes) - chunk.sizes
        base = np.log10((raw + 0.5) / (model.tokens + 0.5 * (model.vocabulary + 1)))
        return pa.table({
            "doc_id": pa.array(chunk.ids, pa.int64()), "n_tokens": chunk.sizes, "n_known": np.add.reduceat((raw > 0).astype(np.int64), first),
            "base_score": np.add.reduceat(base, first), "score": np.add.reduceat(np.log10(p), first),
        })

    replies = spread(chunks).mapInArrow(ask, asked).repartitionById(layout.files, F.col("file")).sortWithinPartitions("n", "file", "bucket").mapInArrow(reply, asked)
    return replies.repartition(n_chunks, *where).groupBy(*where).applyInArrow(total, "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double")


def packed_keys(keys: np.ndarray) -> bytes:
    """Ascending hashes by the steps between them, in byte planes, as many as the largest step takes: the highest compress."""
    steps = np.diff(keys)
    width = max(1, (int(steps.max()).bit_length() + 7) // 8) if len(steps) else 1
    return bytes([width]) + keys[:1].astype("<u8").tobytes() + np.ascontiguousarray(steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unpacked_keys(data: bytes) -> np.ndarray:
    width = data[0]
    raw = np.frombuffer(data, np.uint8, offset=9).reshape(width, -1).T
    steps = np.zeros((len(raw), 8), np.uint8)
    steps[:, :width] = raw
    return np.cumsum(np.concatenate([np.frombuffer(data, "<u8", 1, 1), steps.view("<u8").ravel()]), dtype=np.uint64)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of docs (doc_id, text)."""
    return score_chunks(tokenised(docs), model)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold(F.col("doc_id"), 5) == 1
    chunks = tokenised(table(spark, sf_dir, "documents").select("doc_id", "text"), ~held_out)
    model = count_chunks(chunks)
    return score_chunks(chunks, model).select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("bigint").alias("train_tokens"), "base_score", "score")
