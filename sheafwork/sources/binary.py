"""Binary payloads: object notation, texture headers, float grids.

Files come as rows of binaryFile or as payloads of an archive; each is decoded by itself inside a task."""

from __future__ import annotations

import json
import struct
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

# The tags of the object notation, and the forms of a string word's top two bits.
TAGS = {"zero": 0, "u8": 1, "i32": 2, "f64": 3, "true": 4, "false": 5, "null": 6, "empty_object": 7, "object_u8": 8, "object_i32": 9, "string": 10, "empty_array": 11, "array_u8": 12, "array_i32": 13}
REPEATED, ASCII, UTF8 = 0, 1, 2
#: Pixels that float_grid hands on together.
MOST_PIXELS = 1 << 18


class NotationError(ValueError):
    pass


def encode_value(value: object, magic: bytes = b"HBSON\x00") -> bytes:
    """The bytes of a value.  An ASCII string that came before is written as its number."""
    seen: dict[str, int] = {}
    out = bytearray(magic)

    def text(s: str) -> bytes:
        if s in seen:
            return struct.pack("<i", seen[s])
        raw = s.encode()
        form = ASCII if s.isascii() else UTF8
        if form == ASCII:  # only these are numbered
            seen[s] = len(seen)
        word = form << 30 | len(raw)
        return struct.pack("<I", word) + raw

    def several(kind: str, n: int) -> bytes:
        return bytes((TAGS[f"{kind}_u8"], n)) if n < 256 else bytes([TAGS[f"{kind}_i32"]]) + struct.pack("<i", n)

    def put(v: object) -> None:
        if v is None:
            out.append(TAGS["null"])
        elif v is True or v is False:
            out.append(TAGS["true" if v else "false"])
        elif isinstance(v, int):
            if v == 0:
                out.append(TAGS["zero"])
            elif 0 < v < 256:
                out.extend((TAGS["u8"], v))
            elif -(1 << 31) <= v < 1 << 31:
                out.extend(bytes([TAGS["i32"]]) + struct.pack("<i", v))
            else:
                out.extend(bytes([TAGS["f64"]]) + struct.pack("<d", v))
        elif isinstance(v, float):
            out.extend(bytes([TAGS["f64"]]) + struct.pack("<d", v))
        elif isinstance(v, str):
            out.extend(bytes([TAGS["string"]]) + text(v))
        elif isinstance(v, dict):
            if not v:
                out.append(TAGS["empty_object"])
                return
            out.extend(several("object", len(v)))
            for k, x in v.items():
                out.extend(text(k))
                put(x)
        elif isinstance(v, (list, tuple)):
            if not v:
                out.append(TAGS["empty_array"])
                return
            out.extend(several("array", len(v)))
            for x in v:
                put(x)
        else:
            raise NotationError(f"no tag for {type(v).__name__}")

    put(value)
    return bytes(out)


# -- written forms ----------------------------------------------------------------------------------------------------------
# One value can be written in several ways: a small number in one byte, four or eight, a count in one or four, a text in full or as
# the number of an earlier one.  A form tape keeps the way that was taken beside each value, so the same bytes can be written again.


@dataclass(frozen=True)
class Form:
    """One step of a document, in the order of its bytes.  what: ``value`` (a tag with its value or count) or ``key``; form: that of
    the string's word, if there is one."""

    what: str
    tag: int
    value: object = None
    form: int | None = None


CONTAINERS = {TAGS["object_u8"], TAGS["object_i32"], TAGS["array_u8"], TAGS["array_i32"]}
OBJECTS = {TAGS["object_u8"], TAGS["object_i32"]}
NUMBERS = {TAGS["u8"]: "<B", TAGS["i32"]: "<i", TAGS["object_u8"]: "<B", TAGS["object_i32"]: "<i", TAGS["array_u8"]: "<B", TAGS["array_i32"]: "<i"}
PLAIN = {TAGS["zero"]: 0, TAGS["true"]: True, TAGS["false"]: False, TAGS["null"]: None}
TAG_NAMES = {v: k for k, v in TAGS.items()}


def read_forms(data: bytes, magic: bytes = b"HBSON\x00") -> list[Form]:
    """The form tape of a blob; nesting may be of any depth.  Bytes behind the value are an error."""
    if not data.startswith(magic):
        raise NotationError("no object notation")
    at, strings, tape = len(magic), 0, []

    def take(n: int) -> bytes:
        nonlocal at
        if at + n > len(data):
            raise NotationError(f"ends within a value at {at}")
        at += n
        return data[at - n : at]

    def text(what: str) -> Form:
        nonlocal strings
        word = struct.unpack("<I", take(4))[0]
        form, n = word >> 30, word & 0x3FFFFFFF
        if form == REPEATED:
            if n >= strings:
                raise NotationError(f"string {n} of {strings}")
            return Form(what, TAGS["string"], n, form)
        raw = take(n)
        try:
            raw.decode("ascii" if form == ASCII else "utf-8")
        except UnicodeDecodeError as e:
            raise NotationError(f"a string before {at} is not of its form") from e
        strings += form == ASCII
        return Form(what, TAGS["string"], raw, form)

    left = [(False, 1)]  # (of an object, members still to come)
    while left:
        keyed, n = left.pop()
        if not n:
            continue
        left.append((keyed, n - 1))
        if keyed:
            tape.append(text("key"))
        tag = take(1)[0]
        if tag not in TAG_NAMES:
            raise NotationError(f"tag {tag} at {at - 1}")
        if tag == TAGS["string"]:
            tape.append(text("value"))
        elif tag == TAGS["f64"]:
            tape.append(Form("value", tag, take(8)))  # as bytes: not every number of eight bytes keeps its bits as a float
        elif tag in NUMBERS:
            value = struct.unpack(NUMBERS[tag], take(struct.calcsize(NUMBERS[tag])))[0]
            tape.append(Form("value", tag, value))
            if tag in CONTAINERS:
                if value < 0:
                    raise NotationError(f"{value} members at {at}")
                left.append((tag in OBJECTS, value))
        else:
            tape.append(Form("value", tag))
    if at != len(data):
        raise NotationError(f"{len(data) - at} bytes behind the value")
    return tape


def write_forms(tape: list[Form], magic: bytes = b"HBSON\x00") -> bytes:
    """The bytes that a form tape says."""
    out = bytearray(magic)
    for step in tape:
        if step.what == "value":
            out.append(step.tag)
        if step.form is not None:
            body = b"" if step.form == REPEATED else step.value
            out += struct.pack("<I", step.form << 30 | (step.value if step.form == REPEATED else len(body))) + body
        elif step.tag == TAGS["f64"]:
            out += step.value
        elif step.tag in NUMBERS:
            out += struct.pack(NUMBERS[step.tag], step.value)
    return bytes(out)


def value_of(tape: list[Form]) -> object:
    """The value that a form tape says; the last of equal keys counts."""
    strings: list[str] = []

    def text(step: Form) -> str:
        if step.form == REPEATED:
            return strings[step.value]
        s = step.value.decode()
        if step.form == ASCII:
            strings.append(s)
        return s

    root: list = []
    open_: list[tuple[list | dict, int]] = [(root, 1)]  # (container, members still to come)
    key = None
    for step in tape:
        while not open_[-1][1]:
            open_.pop()
        if step.what == "key":
            key = text(step)
            continue
        if step.form is not None:
            value: object = text(step)
        elif step.tag == TAGS["f64"]:
            value = struct.unpack("<d", step.value)[0]
        elif step.tag in CONTAINERS or step.tag in (TAGS["empty_object"], TAGS["empty_array"]):
            value = {} if step.tag in OBJECTS or step.tag == TAGS["empty_object"] else []
        else:
            value = PLAIN.get(step.tag, step.value)
        into, n = open_[-1]
        open_[-1] = (into, n - 1)
        if isinstance(into, dict):
            into[key] = value
        else:
            into.append(value)
        if step.tag in CONTAINERS:
            open_.append((value, step.value))
    return root[0]


def decode_value(data: bytes, magic: bytes = b"HBSON\x00") -> object:
    """The value of a blob; the last of equal keys counts, and bytes behind the value are an error."""
    return value_of(read_forms(data, magic))


def notation_forms(blobs: DataFrame) -> DataFrame:
    """(path, forms, same, problem) of blobs (path, content): how often each written form occurs, as ``tag`` or for texts ``repeated``,
    ``ascii`` or ``utf8``, and whether the tape writes the same bytes again.  Each blob is read by itself."""
    names = {REPEATED: "repeated", ASCII: "ascii", UTF8: "utf8"}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for content in batch.column("content"):
                data = content.as_py() or b""
                try:
                    tape = read_forms(data)
                    counts = Counter(names.get(x.form, "other") if x.form is not None else TAG_NAMES[x.tag] for x in tape)
                    rows.append((sorted(counts.items()), write_forms(tape) == data, None))
                except NotationError as e:
                    rows.append((None, None, str(e)))
            forms, same, problem = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(forms, pa.map_(pa.string(), pa.int64())), pa.array(same, pa.bool_()), pa.array(problem, pa.string())], names=["path", "forms", "same", "problem"])

    return blobs.select(F.col("path").cast("string").alias("path"), "content").mapInArrow(work, "path string, forms map<string,bigint>, same boolean, problem string")


@F.pandas_udf(BinaryType())
def json_to_notation(text: pd.Series) -> pd.Series:
    """Object notation of JSON texts."""
    return text.map(lambda t: encode_value(json.loads(t)), na_action="ignore")


@F.pandas_udf(StringType())
def notation_to_json(content: pd.Series) -> pd.Series:
    """JSON text of object-notation blobs, ready for parse_json."""
    return content.map(lambda b: json.dumps(decode_value(bytes(b)), ensure_ascii=False), na_action="ignore")


def by_magic(files: DataFrame, magic: bytes = b"HBSON\x00") -> DataFrame:
    return files.where(F.hex(F.substring("content", 1, len(magic))) == magic.hex().upper())


def u32(content: Column, offset: int) -> Column:
    """Little-endian number in bytes offset .. offset + 3."""
    h = F.hex(F.substring(content, offset + 1, 4))
    return F.conv(F.concat(*[F.substring(h, 7 - 2 * k, 2) for k in range(4)]), 16, 10).cast("bigint")


def dds_header(content: Column) -> Column:
    """(format, width, height, mips) of a texture header; null without its magic."""
    four = F.replace(F.decode(F.substring(content, 85, 4), "UTF-8"), F.lit("\x00"), F.lit(""))
    bits, alpha = u32(content, 88), u32(content, 80).bitwiseAND(F.lit(0x41)) == 0x41
    plain = F.when(alpha & (bits == 32), "RGBA8").otherwise(F.concat(F.lit("uncompressed"), bits.cast("string"), F.lit("bit")))
    fmt = F.when(four != "", four).otherwise(plain)
    mips = F.when(u32(content, 8).bitwiseAND(F.lit(0x20000)) != 0, u32(content, 28)).otherwise(F.lit(1).cast("bigint"))
    return F.when(F.hex(F.substring(content, 1, 4)) == "44445320", F.struct(fmt.alias("format"), u32(content, 16).alias("width"), u32(content, 12).alias("height"), mips.alias("mips")))


def float_grid(df: DataFrame, content: str, keep: list[str]) -> DataFrame:
    """Square grids of little-endian f32 as pixels: (…keep, row, col, value).  Grids are handed on together, up to MOST_PIXELS or one
    larger grid in a batch."""
    kinds = dict(df.dtypes)
    schema = ", ".join([*[f"{k} {kinds[k]}" for k in keep], "row int", "col int", "value float"])

    def pixels(batch: pa.RecordBatch, begin: int, grids: list[np.ndarray]) -> pa.RecordBatch:
        places = {n: np.divmod(np.arange(n, dtype=np.int32), np.int32(round(n**0.5))) for n in {len(g) for g in grids}}
        at = pa.array(np.repeat(np.arange(begin, begin + len(grids)), [len(g) for g in grids]))
        row, col = (np.concatenate([places[len(g)][k] for g in grids]) for k in (0, 1))
        return pa.RecordBatch.from_arrays([*[batch.column(k).take(at) for k in keep], pa.array(row), pa.array(col), pa.array(np.concatenate(grids))], names=[*keep, "row", "col", "value"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin, grids, size = 0, [], 0
            for raw in batch.column(content):
                grid = np.frombuffer(raw.as_py(), "<f4")
                side = int(round(len(grid) ** 0.5))
                if side * side != len(grid):
                    raise ValueError(f"{len(grid)} values are no square")
                if grids and size + len(grid) > MOST_PIXELS:
                    yield pixels(batch, begin, grids)
                    begin, grids, size = begin + len(grids), [], 0
                grids.append(grid)
                size += len(grid)
            if grids:
                yield pixels(batch, begin, grids)

    return df.select(*keep, content).mapInArrow(work, schema)


def grid_stats(pixels: DataFrame, by: list[str], pin: float, tolerance: float = 1e-6) -> DataFrame:
    """Finite share, range and plateau share of each grid, and a verdict."""
    v = F.col("value")
    finite = ~(F.isnan(v) | (F.abs(v) == float("inf")))
    share = lambda c: F.avg(c.cast("double"))
    known = F.when(finite, v)
    stats = pixels.groupBy(*by).agg(share(finite).alias("finite"), F.min(known).alias("low"), F.max(known).alias("high"), share(F.abs(v - pin) < tolerance).alias("plateau"))
    return stats.withColumn("verdict", F.when(F.col("finite") < 1, "broken").when(F.col("plateau") > 0.99, "flat").otherwise("terrain"))


def crop_icons(descriptors: DataFrame, atlases: DataFrame) -> DataFrame:
    """(id, pixels, verdict) of icon descriptors (id, file, size, x, y) in RGBA atlases (file, width, height, data): the crop,
    or why there is none: no_atlas, out_of_bounds, bad_size, blank."""
    joined = descriptors.join(atlases, "file", "left")

    def work(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            rows = []
            for r in pdf.itertuples(index=False):
                s = int(r.size) if r.size == r.size and r.size is not None else 0
                if r.data is None:
                    rows.append((r.id, None, "no_atlas"))
                elif s <= 0:
                    rows.append((r.id, None, "bad_size"))
                elif (r.x + 1) * s > r.width or (r.y + 1) * s > r.height or r.x < 0 or r.y < 0:
                    rows.append((r.id, None, "out_of_bounds"))
                else:
                    a = np.frombuffer(r.data, np.uint8).reshape(int(r.height), int(r.width), 4)[int(r.y) * s : (int(r.y) + 1) * s, int(r.x) * s : (int(r.x) + 1) * s]
                    rows.append((r.id, a.tobytes(), "ok") if a[..., 3].any() else (r.id, None, "blank"))
            yield pd.DataFrame(rows, columns=["id", "pixels", "verdict"])

    return joined.mapInPandas(work, "id string, pixels binary, verdict string")
