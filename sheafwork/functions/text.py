"""Text: normalisation for search, escapes, path rendering."""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


@F.pandas_udf(StringType())
def _nfkd_without_marks(s: pd.Series) -> pd.Series:
    return s.map(lambda t: "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.category(c).startswith("M")), na_action="ignore")


@F.pandas_udf(StringType())
def unescape_entities(s: pd.Series) -> pd.Series:
    """Character references of raw markup spans."""
    return s.map(html.unescape, na_action="ignore")


def _without_markup(name: Column) -> Column:
    """Tags, macros and spans become spaces, so that words stay apart."""
    for pattern in (r"<[^>]*>", r"\[[^\]]*\]", r"::[A-Za-z0-9_]+::"):
        name = F.regexp_replace(name, pattern, " ")
    return name


def normalize_name(name: Column) -> Column:
    """The form that search compares: without ``::spans::``, tags and ``[MACROS]``, decomposed and without marks,
    lower-case, ł as l, white space collapsed.  Only the decomposition leaves the JVM."""
    c = _without_markup(name)
    c = F.replace(F.lower(_nfkd_without_marks(c)), F.lit("ł"), F.lit("l"))
    return F.trim(F.regexp_replace(c, r"[\s\x{85}\x{a0}\x{2000}-\x{200a}\x{3000}]+", " "))


def normalize_ascii(name: Column) -> Column:
    """normalize_name for ASCII text, all in the JVM."""
    return F.trim(F.regexp_replace(F.lower(_without_markup(name)), r"\s+", " "))


def strip_tags(v: Column) -> Column:
    return F.regexp_replace(v, "<[^>]+>", "")


def escape_html(v: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        v = F.replace(v, F.lit(a), F.lit(b))
    return v


def escape_pooled(v: Column) -> Column:
    """Backslash, newline, return and tab as two characters; unescape_pooled is its inverse."""
    for a, b in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        v = F.replace(v, F.lit(a), F.lit(b))
    return v


def unescape_pooled(v: Column) -> Column:
    v = F.replace(v, F.lit("\\\\"), F.lit("\x00"))
    for a, b in (("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t")):
        v = F.replace(v, F.lit(a), F.lit(b))
    return F.replace(v, F.lit("\x00"), F.lit("\\"))


def generic_path(path: Column) -> Column:
    """``props.a[3].b`` -> ``a[].b``."""
    return F.regexp_replace(F.regexp_replace(path, r"^props\.", ""), r"\[\d+\]", "[]")


def render_path(parts: Column) -> Column:
    """``tag[idx]`` of each (tag, idx), joined by dots."""
    return F.array_join(F.transform(parts, lambda p: F.concat(p["tag"], F.lit("["), p["idx"].cast("string"), F.lit("]"))), ".")


def render_template(parts: Column) -> Column:
    return F.array_join(F.transform(parts, lambda p: F.concat(p["tag"], F.lit("[]"))), ".")


def collapse_lines(parts: Column) -> Column:
    """(list, 0), (line3, 0) -> (list, 3): numbered line wrappers become the index of what they are in."""
    part = lambda t, i: F.struct(t.alias("tag"), i.cast("int").alias("idx"))
    first = F.expr("CAST(array() AS ARRAY<STRUCT<tag: STRING, idx: INT>>)")

    def add(done: Column, p: Column) -> Column:
        n = F.size(done)
        last = F.when(n > 0, F.element_at(done, F.greatest(n, F.lit(1))))
        line = p["tag"].rlike(r"^line\d+$") & (n > 0)
        moved = F.concat(F.slice(done, F.lit(1), F.greatest(n - 1, F.lit(0))), F.array(part(last["tag"], F.regexp_extract(p["tag"], r"(\d+)$", 1).try_cast("int"))))
        return F.when(line, moved).otherwise(F.concat(done, F.array(part(p["tag"], p["idx"]))))

    return F.aggregate(parts, first, add)


def safe_path(v: Column) -> Column:
    """A relative path of harmless characters: no drive, no way up."""
    v = F.regexp_replace(F.replace(v, F.lit("\\"), F.lit("/")), r"[^A-Za-z0-9_./-]", "_")
    return F.regexp_replace(F.regexp_replace(v, r"(^|/)\.+(?=/|$)", "$1_"), "^/+", "")


def human_size(n: Column) -> Column:
    out = F.concat(n.cast("string"), F.lit(" B"))
    for k, unit in enumerate(("KiB", "MiB", "GiB", "TiB"), 1):
        out = F.when(n >= 1024**k, F.concat(F.format_number(n / 1024**k, 1), F.lit(f" {unit}"))).otherwise(out)
    return out


def locator(kind: Column, id_: Column, path: Column, value: Column) -> Column:
    """``<kind>#<id>:<path>='v'``"""
    return F.format_string("%s#%s:%s='%s'", kind, id_, path, value)


def parse_locator(v: Column) -> Column:
    part = lambda k: F.regexp_extract(v, r"^([^#]*)#([^:]*):([^=]*)='(.*)'$", k)
    return F.struct(part(1).alias("kind"), part(2).alias("id"), part(3).alias("path"), part(4).alias("value"))


def direction_cell(status: Column, edges: Column, cardinality: Column) -> Column:
    """The fixed layout of a catalog cell: ``modeled · E=12 · card=many:1``."""
    return F.when(edges > 0, F.format_string("%s · E=%d · card=%s", status, edges, cardinality)).otherwise(status)


def parse_direction_cell(v: Column) -> Column:
    part = lambda k: F.regexp_extract(v, r"^(\w+) · E=(\d+) · card=(\S+)$", k)
    return F.struct(F.when(part(1) == "", v).otherwise(part(1)).alias("status"), F.coalesce(part(2).try_cast("bigint"), F.lit(0)).alias("edges"), F.nullif(part(3), F.lit("")).alias("cardinality"))


def blank_spans(text: Column, pattern: str) -> Column:
    """Text with each match of a pattern (comments, say) replaced by as many spaces, so that offsets in the rest hold."""
    parts = F.regexp_extract_all(text, F.lit(f"(?s){pattern}|.[^/<#]*"), F.lit(0))
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike(f"(?s)^(?:{pattern})$"), F.repeat(F.lit(" "), F.length(p))).otherwise(p)), "")


def token_offsets(text: Column, pattern: str) -> Column:
    """All matches of a pattern, each with its offset (code points from 0), in one pass over the matches."""
    tokens = F.regexp_extract_all(text, F.lit(f"(?s){pattern}"), F.lit(0))
    gaps = F.split(text, f"(?s){pattern}", -1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<token:string,offset:int>>").alias("found"))

    def step(acc: Column, x: Column) -> Column:
        here = acc["at"] + F.length(x["gap"])
        return F.struct((here + F.length(x["token"])).alias("at"), F.array_append(acc["found"], F.struct(x["token"].alias("token"), here.alias("offset"))).alias("found"))

    pairs = F.zip_with(tokens, F.slice(gaps, 1, F.size(tokens)), lambda t, g: F.struct(t.alias("token"), g.alias("gap")))
    return F.aggregate(pairs, start, step)["found"]


def filled(template: Column, **values: Column) -> Column:
    """A template with each {name} replaced by a column."""
    for name, c in values.items():
        template = F.replace(template, F.lit("{" + name + "}"), c.cast("string"))
    return template


def signature_parts(signature: Column) -> Column:
    """(arguments, result) of ``(a,(b)->c)->r``: arguments are cut at commas of the outermost level only.

    A text is read by brackets, commas and what lies between them, and what was read is bound once by a transform over one row: a
    column that is named several times within another is worked out anew each time."""
    once = lambda c, f: F.transform(F.array(c), f)[0]
    step = lambda acc, c: F.struct(
        (acc["depth"] + F.when(c == "(", 1).when(c == ")", -1).otherwise(0)).alias("depth"), (acc["at"] + F.length(c)).alias("at"),
        F.when((c == ")") & (acc["depth"] == 1) & (acc["close"] == 0), acc["at"]).otherwise(acc["close"]).alias("close"),
        F.when((c == ",") & (acc["depth"] == 1) & (acc["close"] == 0), F.array_append(acc["cuts"], acc["at"])).otherwise(acc["cuts"]).alias("cuts"),
    )
    zero = F.struct(F.lit(0).alias("depth"), F.lit(1).alias("at"), F.lit(0).alias("close"), F.array().cast("array<int>").alias("cuts"))
    seen = F.aggregate(F.regexp_extract_all(signature, F.lit(r"[(),]|[^(),]+"), F.lit(0)), zero, step)

    def parts(seen: Column) -> Column:
        edges = F.concat(F.array(F.lit(1)), seen["cuts"], F.array(seen["close"]))
        cut = lambda e: F.transform(F.sequence(F.lit(1), F.size(e) - 1), lambda i: F.substring(signature, F.element_at(e, i) + 1, F.element_at(e, i + 1) - F.element_at(e, i) - 1))
        return F.when(seen["close"] > 0, F.struct(F.array_remove(once(edges, cut), "").alias("arguments"), F.substring(signature, seen["close"] + 3, F.length(signature)).alias("result")))

    return once(seen, parts)


def iso_seconds(at: Column) -> Column:
    """A run report's timestamp to the second, in the session's time zone; derived artifacts have none."""
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")


def selected(module: Column, modules: list[str], prefixes: list[str]) -> Column:
    """Whether a module is listed, or begins with a prefix."""
    picked = module.isin(modules) if modules else F.lit(False)
    for p in prefixes:
        picked = picked | module.startswith(p)
    return picked
