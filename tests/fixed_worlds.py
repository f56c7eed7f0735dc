"""Small fixed worlds whose answers are known; the SQL is the answer.  Queries of the library do the same over the tables."""

from __future__ import annotations

import atexit
import json
import shutil
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafwork.functions.decode import is_media, type_label
from sheafwork.functions.text import collapse_lines, render_path, render_template, safe_path
from sheafwork.operators import flow, graph, locale, relations, sheets, spatial, walk
from sheafwork.sources import archive, binary, markup

QUERIES, ORACLE = {}, {}


def query(sql):
    def put(f):
        QUERIES[f.__name__], ORACLE[f.__name__] = f, sql
        return f

    return put


DICTIONARY = [("item", "id", "0", False, None), ("item", "name", "1", False, "localizable"), ("item", "maker", "6:guild", True, None), ("item", "parts", "8", True, None), ("item@parts", "of", "6:item", False, None), ("item@parts", "place", "6:place", True, None), ("guild", "id", "0", False, None), ("note", "text", "1", False, None), ("place", "id", "0", False, None)]
LINES = [
    ("item", 0, {"id": "I1", "name": "Oar", "maker": "G1", "parts": [{"of": "I2", "place": "P1"}, {"of": "I9"}]}), ("item", 1, {"id": "I2", "name": "Hull", "maker": "G2", "odd": 3}),
    ("guild", 0, {"id": "G1"}), ("note", 0, {"text": "a"}), ("note", 1, {"text": "b"}),
]


def _sheets(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    return spark.createDataFrame(DICTIONARY, "sheet string, name string, type_str string, opt boolean, kind string"), spark.createDataFrame([(s, o, json.dumps(r)) for s, o, r in LINES], "sheet string, ord int, row string")


@query("SELECT * FROM (VALUES ('item', 'guild', 'I1', 'G1', 'maker', 'true'), ('item', 'guild', 'I2', 'G2', 'maker', 'false'), ('item', 'item', 'I1', 'I2', 'of', 'true'), ('item', 'item', 'I1', 'I9', 'of', 'false'), ('item', 'place', 'I1', 'P1', 'place', 'unknown')) t(from_kind, to_kind, from_id, to_id, \"column\", valid)")
def sheet_edges(spark: SparkSession, d: str) -> DataFrame:
    """References of a sheet database, hidden sub-sheets included; place has no lines, so its edge is neither."""
    return sheets.sheet_edges(*_sheets(spark)).select("from_kind", "to_kind", "from_id", "to_id", "column", F.coalesce(F.col("valid").cast("string"), F.lit("unknown")).alias("valid"))


@query("SELECT * FROM (VALUES ('item', 'I1'), ('item', 'I2'), ('guild', 'G1'), ('note', 'note-0000'), ('note', 'note-0001')) t(sheet, id)")
def sheet_ids(spark: SparkSession, d: str) -> DataFrame:
    return sheets.identified(*_sheets(spark)).select("sheet", "id")


@query("SELECT 'item' AS schema, 'odd' AS \"column\", CAST(1 AS BIGINT) AS cells")
def undeclared_keys(spark: SparkSession, d: str) -> DataFrame:
    return sheets.undeclared(sheets.declared_cells(*_sheets(spark)))


@query("""SELECT * FROM (VALUES ('I1', '{"bridge":"export_cdb","sheet":"item","column":"name","row":"I1"}'), ('I2', '{"bridge":"export_cdb","sheet":"item","column":"name","row":"I2"}')) t(id, "textKey")""")
def localizable_cells(spark: SparkSession, d: str) -> DataFrame:
    return sheets.text_keys(sheets.declared_cells(*_sheets(spark))).select("id", "textKey")


@query("""SELECT * FROM (VALUES ('guild', 'id', 'plain', CAST(1 AS BIGINT)), ('item', 'id', 'plain', 2), ('item', 'name', 'plain', 2), ('item', 'parts', 'compound_filled', 3), ('note', 'text', 'plain', 2), ('place', 'id', 'schema_empty', 0)) t(schema, "column", class, cells)""")
def unadmitted_columns(spark: SparkSession, d: str) -> DataFrame:
    """Declared columns that no reference carrier admits."""
    dictionary, lines = _sheets(spark)
    admitted = dictionary.where("type_str LIKE '6:%'").select(F.col("sheet").alias("schema"), F.col("name").alias("column"))
    return sheets.unadmitted(dictionary, sheets.declared_cells(dictionary, lines), admitted).select("schema", "column", "class", "cells")


@query("SELECT * FROM (VALUES ('a[0].b', 'a[].b', '1'), ('a[1].b', 'a[].b', '2'), ('c.d', 'c.d', 'x'), ('e', 'e', 'true')) t(path, norm_path, value)")
def nested_walk(spark: SparkSession, d: str) -> DataFrame:
    df = spark.createDataFrame([("k", '{"a": [{"b": 1}, {"b": 2}], "c": {"d": "x"}, "e": true, "f": null, "g": {}}')], "id string, row string")
    return walk.walk_json(df, ["id"], "row").select("path", "norm_path", "value")


XML = '<cdb version="1"><sheet name="item"><I1><name>Oar <br/>of "it"</name><list><line0><col>x</col></line0><line1><col>y</col></line1></list></I1><I2><name/></I2></sheet></cdb>'


@query("""SELECT * FROM (VALUES ('en', 'item', 'I1', 'name[0]', 'Oar <br/>of "it"'), ('en', 'item', 'I1', 'list[0].line0[0].col[0]', 'x'), ('en', 'item', 'I1', 'list[0].line1[0].col[0]', 'y'), ('en', 'item', 'I2', 'name[0]', '')) t(locale, sheet, "row", path, value)""")
def xml_spans(spark: SparkSession, d: str) -> DataFrame:
    """Leaves of an export with their raw spans, inner markup as written."""
    return markup.read_export(spark.createDataFrame([("en", XML)], "locale string, value string"))


@query("SELECT * FROM (VALUES ('en', 'menu/file/open', 'Open <b>now</b>'), ('en', 'menu/quit', '')) t(locale, key, value)")
def ui_texts(spark: SparkSession, d: str) -> DataFrame:
    xml = '<r><g id="menu"><g id="file"><t id="open">Open <b>now</b></t></g><t id="quit"/></g></r>'
    return markup.read_texts(spark.createDataFrame([("en", xml)], "locale string, value string"))


@query("""SELECT * FROM (VALUES ('item', 'I1', 'en', 'ok'), ('item', 'I1', 'fr', 'missing'), ('item', 'I2', 'en', 'empty'), ('item', 'I2', 'fr', 'ok')) t(kind, id, locale, state)""")
def text_key_resolve(spark: SparkSession, d: str) -> DataFrame:
    leaves = spark.createDataFrame([("en", "item", "I1", "name[0]", "Oar"), ("en", "item", "I2", "name[0]", ""), ("fr", "item", "I2", "name[0]", "Coque")], "locale string, sheet string, row string, path string, value string")
    refs = spark.createDataFrame([("item", "I1", "item", "I1", "name[0]", "name"), ("item", "I2", "item", "I2", "name[0]", "name")], "kind string, id string, sheet string, row string, path string, template string")
    return locale.resolve_text_keys(refs, leaves, ["en", "fr"]).select("kind", "id", "locale", "state")


@query("""SELECT * FROM (VALUES (1, '{"a": [1, -5, 2.5], "s": "x", "t": "x", "n": null}'), (2, '[]'), (3, '"é"')) t(id, value)""")
def notation_decode(spark: SparkSession, d: str) -> DataFrame:
    """Binary object notation as JSON text."""
    blobs = [(1, bytearray(binary.encode_value({"a": [1, -5, 2.5], "s": "x", "t": "x", "n": None}))), (2, bytearray(binary.encode_value([]))), (3, bytearray(binary.encode_value("é")))]
    return binary.by_magic(spark.createDataFrame(blobs, "id int, content binary")).select("id", binary.notation_to_json("content").alias("value"))


@query("""SELECT * FROM (VALUES ('straight', CAST(1 AS BIGINT), CAST(0 AS BIGINT), CAST(1 AS BIGINT), CAST(0 AS BIGINT)), ('if', 3, 3, 2, 0), ('loop', 4, 4, 2, 1), ('switch', 5, 6, 3, 0), ('dead', 2, 0, 0, 0)) t(function, blocks, edges, complexity, loops)""")
def cfg_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Control flow of small functions: straight, one if, one loop, a switch, a tail that nothing reaches."""
    ops = [
        ("straight", 0, [], True), ("straight", 1, [], True), ("straight", 2, [], False),
        ("if", 0, [2], True), ("if", 1, [], True), ("if", 2, [], False),
        ("loop", 0, [], True), ("loop", 1, [3], True), ("loop", 2, [1], False), ("loop", 3, [], False),
        ("switch", 0, [2, 3], True), ("switch", 1, [4], False), ("switch", 2, [4], False), ("switch", 3, [4], True), ("switch", 4, [], False),
        ("dead", 0, [], False), ("dead", 1, [], False),
    ]
    df = spark.createDataFrame(ops, "function string, pc int, targets array<int>, falls boolean")
    return flow.flow_metrics(df).select("function", "blocks", "edges", "complexity", "loops")


@query("""SELECT * FROM (VALUES ('root', 10.0::DOUBLE, 0.0::DOUBLE, 90.0::DOUBLE), ('a', 10.0, 5.0, 90.0), ('b', 8.0, 5.0, 180.0)) t(node, x, y, angle)""")
def frame_propagation(spark: SparkSession, d: str) -> DataFrame:
    """World frames down a reference graph; the scaled edge to c is not followed, and the longer way to b comes later."""
    roots = spark.createDataFrame([("root", 10.0, 0.0, 90.0)], "node string, x double, y double, angle double")
    edges = spark.createDataFrame([("root", "a", 5.0, 0.0, 0.0, 1.0), ("a", "b", 0.0, 2.0, 90.0, 1.0), ("b", "a", 9.0, 9.0, 0.0, 1.0), ("a", "c", 1.0, 1.0, 0.0, 2.0)], "a string, b string, x double, y double, angle double, scale double")
    return graph.propagate_frames(roots, edges).select("node", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), "angle")


@query("""SELECT * FROM (VALUES ('base', 'run', 'base', 0), ('mid', 'run', 'mid', 0), ('mid', 'jump', 'mid', 1), ('leaf', 'run', 'mid', 0), ('leaf', 'jump', 'mid', 1), ('leaf', 'fly', 'leaf', 2)) t(child, name, owner, slot)""")
def inherited_members(spark: SparkSession, d: str) -> DataFrame:
    """Members along the chain of parents; a nearer one overrides in the slot of the first."""
    links = spark.createDataFrame([("mid", "base"), ("leaf", "mid"), ("base", None)], "t string, up string")
    members = spark.createDataFrame([("base", "run", 0), ("mid", "run", 0), ("mid", "jump", 1), ("leaf", "fly", 0)], "t string, name string, ord int")
    return graph.flattened_members(graph.ancestors(links, "t", "up"), members, "t", "name", "ord").select("child", "name", "owner", F.col("slot").cast("int").alias("slot"))


@query("SELECT * FROM (VALUES ('g', 1.0::DOUBLE, 0.0::DOUBLE, 3.0::DOUBLE, 0.25::DOUBLE, 'terrain')) t(grid, finite, low, high, plateau, verdict)")
def raster_proof(spark: SparkSession, d: str) -> DataFrame:
    """A headerless float grid as pixels, and what its values prove."""
    raw = bytearray(np.arange(4, dtype="<f4").tobytes())
    px = binary.float_grid(spark.createDataFrame([("g", raw)], "grid string, content binary"), "content", ["grid"])
    return binary.grid_stats(px, ["grid"], pin=0.0).select("grid", "finite", F.col("low").cast("double").alias("low"), F.col("high").cast("double").alias("high"), "plateau", "verdict")


@query("SELECT * FROM (VALUES ('a', 'ok'), ('b', 'out_of_bounds'), ('c', 'blank'), ('d', 'no_atlas'), ('e', 'bad_size')) t(id, verdict)")
def icon_crops(spark: SparkSession, d: str) -> DataFrame:
    a = np.zeros((4, 4, 4), np.uint8)
    a[:2, :2] = 255
    atlas = spark.createDataFrame([("x", 4, 4, bytearray(a.tobytes()))], "file string, width int, height int, data binary")
    icons = spark.createDataFrame([("a", "x", 2, 0, 0), ("b", "x", 2, 2, 0), ("c", "x", 2, 1, 1), ("d", "y", 2, 0, 0), ("e", "x", 0, 0, 0)], "id string, file string, size int, x int, y int")
    return binary.crop_icons(icons, atlas).select("id", "verdict")


@query("SELECT * FROM (VALUES ('DXT5', CAST(64 AS BIGINT), CAST(32 AS BIGINT), CAST(1 AS BIGINT)), ('RGBA8', 8, 8, 4)) t(format, width, height, mips)")
def texture_headers(spark: SparkSession, d: str) -> DataFrame:
    import struct

    def dds(flags: int, h: int, w: int, mips: int, pf_flags: int, four: bytes, bits: int) -> bytearray:
        return bytearray(b"DDS " + struct.pack("<7I", 124, flags, h, w, 0, 0, mips) + b"\x00" * 44 + struct.pack("<II4sI", 32, pf_flags, four, bits) + b"\x00" * 36)

    df = spark.createDataFrame([(dds(0, 32, 64, 1, 4, b"DXT5", 0),), (dds(0x20000, 8, 8, 4, 0x41, b"\x00" * 4, 32),)], "content binary")
    return df.select(binary.dds_header(F.col("content")).alias("h")).select("h.*")


@query("SELECT * FROM (VALUES ('0', 'id'), ('1', 'text'), ('6:item', 'ref<item>'), ('5:A,B', 'enum[A,B]'), ('10:Alpha,Beta,Gamma', 'flags[Alpha…]'), ('9:Mode', 'enum<Mode>'), ('7', 'unknown(7)'), ('8', 'list')) t(type_str, label)")
def type_labels(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame([(t,) for t in ("0", "1", "6:item", "5:A,B", "10:Alpha,Beta,Gamma", "9:Mode", "7", "8")], "type_str string").select("type_str", type_label(F.col("type_str")).alias("label"))


@query("SELECT * FROM (VALUES (1, 'a[0].list[2]', 'a[].list[]', 'up_/b_c.txt', TRUE), (2, 'x[1]', 'x[]', 'd/e', FALSE)) t(id, path, template, safe, media)")
def path_rendering(spark: SparkSession, d: str) -> DataFrame:
    """Rendered paths and templates, harmless relative paths, and audio told by its frame header."""
    df = spark.createDataFrame([(1, [("a", 0), ("list", 0), ("line2", 0)], "/up*/b?c.txt", bytearray(b"\xff\xfb\x90\x00")), (2, [("x", 1)], "d\\e", bytearray(b"\xff\xfe\x00\x00"))], "id int, parts array<struct<tag: string, idx: int>>, raw string, head binary")
    c = collapse_lines(F.col("parts"))
    return df.select("id", render_path(c).alias("path"), render_template(c).alias("template"), safe_path(F.col("raw")).alias("safe"), is_media(F.col("head")).alias("media"))


@query("SELECT * FROM (VALUES ('l', CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(4 AS BIGINT), CAST(4 AS BIGINT), CAST(2 AS BIGINT))) t(layer, x0, y0, width, height, holes)")
def mosaic_layout(spark: SparkSession, d: str) -> DataFrame:
    tiles = spark.createDataFrame([("l", 0, 0, bytearray(b"\x01" * 4)), ("l", 1, 1, bytearray(b"\x02" * 4))], "layer string, x bigint, y bigint, data binary")
    return spatial.mosaic(tiles, 2)


@query("SELECT * FROM (VALUES ('item', 'guild', CAST(2 AS BIGINT), CAST(2 AS BIGINT), CAST(2 AS BIGINT), '1:1'), ('item', 'item', 2, 1, 2, '1:many'), ('item', 'place', 1, 1, 1, '1:1')) t(from_kind, to_kind, edges, from_ids, to_ids, cardinality)")
def sheet_pair_catalog(spark: SparkSession, d: str) -> DataFrame:
    """The relation catalog of a sheet database's edges."""
    return relations.pair_catalog(sheets.sheet_edges(*_sheets(spark))).select("from_kind", "to_kind", "edges", "from_ids", "to_ids", "cardinality")


ARCHIVED = {"a.txt": b"hello", "d/notes.bin": bytes(300), "d/e/empty": b"", "d/e/big": b"xyz" * 1000}


def _archive(spark: SparkSession) -> str:
    """A new archive in the folder that driver and executors share; where none is set, in a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = tempfile.mkdtemp(prefix="sheafwork-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    uri = f"{folder.rstrip('/')}/{uuid.uuid4().hex}.pak"
    archive.write_pak(uri, ARCHIVED, wide=frozenset({"d/e/big"}))
    where = spark._jvm.org.apache.hadoop.fs.Path(archive.full_uri(uri))
    where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).deleteOnExit(where)
    return uri


@query("SELECT * FROM (VALUES ('a.txt', 0, CAST(5 AS BIGINT), CAST(103547413 AS BIGINT), 'hel'), ('d/notes.bin', 0, 300, 19660801, ''), ('d/e/empty', 0, 0, 1, ''), ('d/e/big', 2, 3000, 421235268, 'xyz')) t(path, flags, size, adler, head)")
def pak_entries(spark: SparkSession, d: str) -> DataFrame:
    """Entries of an archive with the first letters of their payloads, whose checksums the tasks verify as they read."""
    spark.dataSource.register(archive.PakSource)
    entries = spark.read.format("pak").option("payload", "true").option("split", "100").load(_archive(spark))
    head = F.regexp_replace(F.substring("content", 1, 3).cast("string"), "\u0000", "")
    return entries.select("path", "flags", "size", "adler", head.alias("head"))
