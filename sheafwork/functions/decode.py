"""Cell decoding: type strings, enums, flags, checksums, magic bytes, paths."""

from __future__ import annotations

import zlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

# What the type codes of a sheet's columns mean.
TYPE_LABELS = {
    "0": "id", "1": "text", "2": "bool", "3": "int", "4": "float", "5": "enum", "6": "ref", "8": "list", "9": "enum",
    "10": "flags", "11": "color", "13": "file", "14": "icon", "16": "directory", "17": "datafile",
}
# First bytes (hex) of file formats, and endings of audio and video files.
MAGICS = {"dds": "44445320", "png": "89504E47", "jpeg": "FFD8FF", "hmd": "484D44", "hbson": "4842534F4E00", "tx": "762F3101", "zip": "504B0304", "gzip": "1F8B"}
MEDIA = [".wem", ".bnk", ".wav", ".ogg", ".mp3", ".flac", ".bik", ".bk2", ".usm", ".webm", ".mp4", ".avi", ".ogv", ".mov"]


def type_code(type_str: Column) -> Column:
    return F.split(type_str, ":", 2)[0]


def type_param(type_str: Column) -> Column:
    return F.try_element_at(F.split(type_str, ":", 2), F.lit(2))


def type_label(type_str: Column) -> Column:
    """``ref<item>``, ``enum<Mode>``, ``enum[A,B]`` (only the first case of long ones), ``list``; ``unknown(7)`` for other codes."""
    labels = F.create_map(*[F.lit(x) for kv in TYPE_LABELS.items() for x in kv])
    code, param = type_code(type_str), F.coalesce(type_param(type_str), F.lit(""))
    name = F.coalesce(F.try_element_at(labels, code), F.concat(F.lit("unknown("), code, F.lit(")")))
    cases = F.when(F.length(param) > 12, F.concat(F.substring_index(param, ",", 1), F.lit("…"))).otherwise(param)
    return F.when(code.isin("6", "9"), F.concat(name, F.lit("<"), param, F.lit(">"))).when(code.isin("5", "10"), F.concat(name, F.lit("["), cases, F.lit("]"))).otherwise(name)


def enum_case(cases: Column, value: Column) -> Column:
    """Name of case ``value`` (from 0); null out of range."""
    return F.when(value >= 0, F.try_element_at(cases, (value + 1).cast("int")))


def flag_names(cases: Column, mask: Column) -> Column:
    """Names of the bits that are set, lowest first."""
    bits = F.transform(cases, lambda c, i: F.when(F.getbit(mask.cast("bigint"), i) == 1, c))
    return F.filter(bits, lambda x: x.isNotNull())


@F.pandas_udf(LongType())
def adler32(s: pd.Series) -> pd.Series:
    """Spark has crc32, but no Adler-32."""
    return s.map(zlib.adler32, na_action="ignore").astype("Int64")


def sniff(content: Column) -> Column:
    """Format by the first bytes; json or xml by the first that is no space, else ``u:`` and the first four in hex."""
    head = F.hex(F.substring(content, 1, 16))
    out = F.when(head == "", "empty")
    for name, magic in MAGICS.items():
        out = out.when(head.startswith(magic), name)
    ink = F.regexp_replace(head, "^(?:20|09|0A|0D|0B|0C)+", "")
    return out.when(ink.startswith("7B"), "json").when(ink.startswith("3C"), "xml").otherwise(F.concat(F.lit("u:"), F.lower(F.substring(head, 1, 8))))


def is_media(content: Column) -> Column:
    """Whether the first bytes are those of an audio or video container, a legal MPEG frame header included."""
    head = F.hex(F.substring(content, 1, 12))
    word = F.conv(F.substring(head, 1, 8), 16, 10).try_cast("bigint")
    bits = lambda shift, mask: F.shiftright(word, shift).bitwiseAND(F.lit(mask))
    mpeg = (bits(21, 0x7FF) == 0x7FF) & (bits(19, 3) != 1) & (bits(17, 3) != 0) & ~bits(12, 15).isin(0, 15) & (bits(10, 3) != 3)
    known = F.lit(False)
    for text in ("OggS", "fLaC", "ID3", "BIKe"):
        known = known | head.startswith(text.encode().hex().upper())
    riff = head.startswith(b"RIFF".hex().upper()) & F.substring(head, 17, 8).isin(b"WAVE".hex().upper(), b"AVI ".hex().upper())
    iso = F.substring(head, 9, 8) == b"ftyp".hex().upper()
    return (F.length(head) >= 8) & (known | head.startswith("1A45DFA3") | riff | iso | F.coalesce(mpeg, F.lit(False)))


def media_path(path: Column) -> Column:
    return F.lower(path).rlike("(" + "|".join(MEDIA).replace(".", r"\.") + ")$")


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))


def tile_of(path: Column, classes: dict[str, str]) -> Column:
    """(class, x, y) of a path: classes maps a name to a pattern with two groups, x and y, that may be negative."""
    name, x, y = None, None, None
    for k, pattern in classes.items():
        hit = path.rlike(pattern)
        gx, gy = F.regexp_extract(path, pattern, 1).try_cast("int"), F.regexp_extract(path, pattern, 2).try_cast("int")
        name = F.when(hit, k) if name is None else name.when(hit, k)
        x = F.when(hit, gx) if x is None else x.when(hit, gx)
        y = F.when(hit, gy) if y is None else y.when(hit, gy)
    return F.struct(F.coalesce(name, F.lit("other")).alias("class"), x.alias("x"), y.alias("y"))


def route(path: Column, locales: list[str], live: list[str], pivot: str = "en") -> Column:
    """What a request path comes to: live, redirect (the pivot has no prefix) or 404, and the locale."""
    first = F.split(F.regexp_replace(path, "^/", ""), "/")[0]
    has = first.isin(*locales)
    rest = F.when(has, F.regexp_replace(path, "^/[^/]*", "")).otherwise(path)
    rest = F.when(rest == "", "/").otherwise(rest)
    verdict = F.when(first == pivot, "redirect").when(rest.isin(*live), "live").otherwise("404")
    return F.struct(verdict.alias("verdict"), F.when(has, first).otherwise(pivot).alias("locale"), rest.alias("path"))
