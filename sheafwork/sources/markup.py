"""Text exports in XML, with inner markup kept as it is written.

Spark's xml source turns tag names into columns and rewrites inner tags; here entry ids are tag names and values are raw
spans.  So files are read whole and scanned with offsets inside tasks, one file at a time."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TAG = re.compile(r"<(/?)([A-Za-z_][\w.:-]*)((?:\s+[\w.:-]+\s*=\s*(?:\"[^\"]*\"|'[^']*'))*)\s*(/?)>")
_ATTR = re.compile(r"([\w.:-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)')")
#: Tags that are part of a text, not of the tree.
INLINE = {"br", "b", "i", "u", "font", "img", "item", "skill", "color"}
#: Rows, and characters of values, in a batch that a scan hands on.
MOST_ROWS, MOST_CHARS = 1 << 14, 1 << 22


def attributes(raw: str) -> dict[str, str]:
    return {k: html.unescape(a or b) for k, a, b in _ATTR.findall(raw)}


def leaves(xml: str) -> Iterator[tuple[str, str, str, str]]:
    """(sheet, entry, path, value) of <sheet name><Entry><col>text</col><list><line0>…: path is tag[idx] joined by dots,
    idx counting equal tags below one parent, value the raw inner span."""
    stack: list[tuple[str, int, bool, Counter, str]] = []  # tag, end of its opening tag, has children, counts, step
    sheet = ""
    for m in _TAG.finditer(xml):
        close, tag, attrs, self_closed = m.groups()
        if tag in INLINE and stack and len(stack) > 3:
            continue
        if close:
            if not stack or stack[-1][0] != tag:
                raise ValueError(f"</{tag}> at {m.start()} closes nothing")
            _, begin, parent, _, step = stack.pop()
            if not parent and len(stack) >= 3:
                yield sheet, stack[2][0], ".".join([*[s[4] for s in stack[3:]], step]), xml[begin : m.start()]
            continue
        if stack:
            counts = stack[-1][3]
            step = f"{tag}[{counts[tag]}]"
            counts[tag] += 1
            stack[-1] = (*stack[-1][:2], True, *stack[-1][3:])
        else:
            step = f"{tag}[0]"
        if tag == "sheet" and len(stack) == 1:
            sheet = attributes(attrs).get("name", "")
        if self_closed:
            if len(stack) >= 3:
                yield sheet, stack[2][0], ".".join([*[s[4] for s in stack[3:]], step]), ""
        else:
            stack.append((tag, m.end(), False, Counter(), step))
    if stack:
        raise ValueError(f"<{stack[-1][0]}> is not closed")


def texts(xml: str) -> Iterator[tuple[str, str]]:
    """(key, value) of nested <g id><t id>text</t></g>: the key joins ids from the outermost in; without an id, ``?``."""
    stack: list[tuple[str, str, int]] = []
    for m in _TAG.finditer(xml):
        close, tag, attrs, self_closed = m.groups()
        if tag not in ("g", "t"):
            continue
        if close:
            kind, key, begin = stack.pop()
            if kind == "t":
                yield "/".join([*[k for t, k, _ in stack if t == "g"], key]), xml[begin : m.start()]
        elif self_closed:
            if tag == "t":
                yield "/".join([*[k for t, k, _ in stack if t == "g"], attributes(attrs).get("id", "?")]), ""
        else:
            stack.append((tag, attributes(attrs).get("id", "?"), m.end()))


def header(xml: str) -> dict[str, str]:
    """Attributes of the root element."""
    m = _TAG.search(xml)
    return attributes(m[3]) if m else {}


# -- the second reader: an index of value spans ----------------------------------------------------------------------------


def value_spans(data: bytes) -> Iterator[tuple[str, str, str, int, int, int]]:
    """(sheet, row, path, nth, start, length) of every value of an export, start and length in bytes of the file.

    This scanner shares nothing with leaves(): it goes over the bytes from one ``<`` to the next, steps over quoted attributes,
    comments and declarations, and keeps a stack of open elements.  Where several values have one path, each is there: nth counts
    them, none is overwritten."""
    stack: list[list] = []  # [tag, begin of its content, children, counts, step]
    sheet, at, nth = b"", 0, Counter()
    inline = {t.encode() for t in INLINE}

    def past(mark: bytes, begin: int) -> int:
        found = data.find(mark, begin)
        if found < 0:
            raise ValueError(f"what begins at {begin} does not end")
        return found + len(mark)

    while (at := data.find(b"<", at)) >= 0:
        if data.startswith(b"<!--", at):
            at = past(b"-->", at)
            continue
        if data[at + 1 : at + 2] in (b"?", b"!"):
            at = past(b">", at)
            continue
        begin, end, quote = at, at + 1, 0
        while end < len(data) and (quote or data[end] != 0x3E):
            c = data[end]
            quote = 0 if quote == c else quote or (c if c in b"\"'" else 0)
            end += 1
        if end >= len(data):
            raise ValueError(f"the tag at {begin} does not end")
        body, at = data[begin + 1 : end], end + 1
        if body.startswith(b"/"):
            tag = body[1:].strip()
            if tag in inline and len(stack) > 3 and stack[-1][0] != tag:
                continue
            if not stack or stack[-1][0] != tag:
                raise ValueError(f"</{tag.decode()}> at {begin} closes nothing")
            _, start, children, _, step = stack.pop()
            if not children and len(stack) >= 3:
                key = (sheet, stack[2][0], b".".join([*[x[4] for x in stack[3:]], step]))
                yield key[0].decode(), key[1].decode(), key[2].decode(), nth[key], start, begin - start
                nth[key] += 1
            continue
        closed = body.endswith(b"/")
        tag = (body[:-1] if closed else body).split(None, 1)[0]
        if tag in inline and len(stack) > 3:
            continue
        step = tag + b"[0]"
        if stack:
            step = tag + b"[%d]" % stack[-1][3][tag]
            stack[-1][3][tag] += 1
            stack[-1][2] = True
        if tag == b"sheet" and len(stack) == 1:
            sheet = attributes(body.decode()).get("name", "").encode()
        if not closed:
            stack.append([tag, at, False, Counter(), step])
        elif len(stack) >= 3:
            key = (sheet, stack[2][0], b".".join([*[x[4] for x in stack[3:]], step]))
            yield key[0].decode(), key[1].decode(), key[2].decode(), nth[key], at, 0
            nth[key] += 1
    if stack:
        raise ValueError(f"<{stack[-1][0].decode()}> is not closed")


def span_index(spark: SparkSession, path: str) -> DataFrame:
    """(file, sheet, row, path, nth, start, length) of the values of all exports below a path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(F.col("path").alias("file"), "content")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["file", "sheet", "row", "path", "nth", "start", "length"]
        kinds = [pa.string()] * 4 + [pa.int32()] + [pa.int64()] * 2
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                some: list[tuple] = []
                for span in value_spans(content.as_py()):
                    some.append((file, *span))
                    if len(some) == 1 << 14:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some), kinds)], names=names)
                        some = []
                if some:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some), kinds)], names=names)

    return files.mapInArrow(work, "file string, sheet string, row string, path string, nth int, start bigint, length bigint")


def read_spans(index: DataFrame, partitions: int) -> DataFrame:
    """index with value: each span's bytes, read again from its file by range.  Spans are dealt by file and place, so a file is opened
    once for a run of its spans."""
    schema = T.StructType([*index.schema.fields, T.StructField("value", T.StringType())])
    ordered = index.repartitionByRange(partitions, "file", "start").sortWithinPartitions("file", "start")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, handle = None, None
        for batch in batches:
            values = []
            for file, start, length in zip(*[batch.column(c).to_pylist() for c in ("file", "start", "length")]):
                if file != name:
                    fs, where = pafs.FileSystem.from_uri(file)
                    name, handle = file, fs.open_input_file(where)
                values.append(handle.read_at(length, start).decode())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.string())], names=[*batch.schema.names, "value"])

    return ordered.mapInArrow(work, schema)


def _scan(df: DataFrame, rows, schema: str) -> DataFrame:
    """rows of each (locale, value), handed on in batches of many: a batch for each text costs more than the text."""
    names = [x.split()[0] for x in schema.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        put = lambda some: pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*some)], names=names)
        some: list[tuple] = []
        size = 0
        for batch in batches:
            for locale, value in zip(batch.column("locale").to_pylist(), batch.column("value")):
                for row in rows(value.as_py()):
                    some.append((locale, *row))
                    size += len(row[-1])
                    if len(some) >= MOST_ROWS or size >= MOST_CHARS:
                        yield put(some)
                        some, size = [], 0
        if some:
            yield put(some)

    return df.select(F.col("locale").cast("string"), "value").mapInArrow(work, schema)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(locale, value): the folder above each file is its locale."""
    return spark.read.text(path, wholetext=True).select(F.element_at(F.split("_metadata.file_path", "/"), -2).alias("locale"), "value")


def read_export(files: DataFrame) -> DataFrame:
    return _scan(files, leaves, "locale string, sheet string, row string, path string, value string")


def read_texts(files: DataFrame) -> DataFrame:
    return _scan(files, texts, "locale string, key string, value string")
