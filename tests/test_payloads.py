"""Textures, terrain, written forms, spans and type texts against plain versions of the same."""

from __future__ import annotations

import random
import struct

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tests.test_sources import VALUES

from sheafwork.operators import ordinals
from sheafwork.operators.types import type_display
from sheafwork.plans.payloads import texture_head
from sheafwork.sources import binary, markup, terrain, textures


def scalar_texels(data, width, height, four):
    """RGBA of a block texture, one texel at a time."""
    size = 8 if four == b"DXT1" else 16
    out = np.zeros((height, width, 4), np.uint8)
    for by in range(-(-height // 4)):
        for bx in range(-(-width // 4)):
            at = 128 + (by * -(-width // 4) + bx) * size
            block = data[at : at + size]
            c0, c1, bits = struct.unpack("<HHI", block[-8:])
            rgb = [((c >> 11) * 8 + (c >> 13), (c >> 5 & 63) * 4 + (c >> 9 & 3), (c & 31) * 8 + (c >> 2 & 7)) for c in (c0, c1)]
            if size == 16 or c0 > c1:
                pal = [(*rgb[0], 255), (*rgb[1], 255), (*((2 * a + b) // 3 for a, b in zip(*rgb)), 255), (*((a + 2 * b) // 3 for a, b in zip(*rgb)), 255)]
            else:
                pal = [(*rgb[0], 255), (*rgb[1], 255), (*((a + b) // 2 for a, b in zip(*rgb)), 255), (0, 0, 0, 0)]
            for k in range(16):
                y, x = by * 4 + k // 4, bx * 4 + k % 4
                if y < height and x < width:
                    texel = list(pal[bits >> 2 * k & 3])
                    if size == 16:
                        a0, a1, index = block[0], block[1], int.from_bytes(block[2:8], "little") >> 3 * k & 7
                        more = [((7 - j) * a0 + j * a1) // 7 for j in range(1, 7)] if a0 > a1 else [*(((5 - j) * a0 + j * a1) // 5 for j in range(1, 5)), 0, 255]
                        texel[3] = [a0, a1, *more][index]
                    out[y, x] = texel
    return out


@pytest.mark.parametrize("four, width, height", [(b"DXT1", 8, 8), (b"DXT1", 5, 7), (b"DXT5", 12, 4), (b"DXT5", 1, 1)])
def test_blocks_against_a_scalar_decoder(four, width, height):
    rng = random.Random(width)
    body = rng.randbytes(-(-width // 4) * -(-height // 4) * (8 if four == b"DXT1" else 16))
    data = texture_head(width, height, four) + body
    want = scalar_texels(data, width, height, four)
    assert (textures.decode_texture(data, opaque=False) == want).all()
    want[..., 3] = 255
    assert (textures.decode_texture(data + b"more mips") == want).all()


def test_masks_and_what_is_no_texture(spark):
    bgra = texture_head(2, 1, bits=32, masks=(0xFF0000, 0xFF00, 0xFF, 0xFF000000)) + bytes([1, 2, 3, 4, 5, 6, 7, 8])
    assert textures.decode_texture(bgra, opaque=False).tolist() == [[[3, 2, 1, 4], [7, 6, 5, 8]]]
    five = texture_head(1, 1, bits=24, masks=(0x1F, 0x3E0, 0x7C00, 0)) + struct.pack("<I", 31 | 5 << 5 | 0 << 10)[:3]
    assert textures.decode_texture(five).tolist() == [[[255, 5 * 255 // 31, 0, 255]]]
    bad = [(1, b"nope"), (2, None), (3, texture_head(4, 4, b"DXT3") + bytes(16)), (4, texture_head(0, 4, b"DXT1")), (5, texture_head(4, 4, b"DXT1") + bytes(7)), (6, texture_head(1, 1, bits=16) + bytes(2)), (7, bgra)]
    got = {int(r["path"]): (r["problem"], r["rgba"]) for r in textures.decoded(spark.createDataFrame(bad, "path int, content binary")).collect()}
    assert len(got) == 7 and all((p is None) == (rgba is not None) for p, rgba in got.values()) and [k for k, v in got.items() if v[0] is None] == [7]
    rows = textures.texels(textures.decoded(spark.createDataFrame(bad, "path int, content binary"))).orderBy("col").collect()
    assert [tuple(r)[1:] for r in rows] == [(0, 0, 3, 2, 1, 255), (0, 1, 7, 6, 5, 255)]


def test_terrain_by_role(spark):
    px = lambda *cells: b"".join(bytes(c) for c in cells)
    files = [
        ("/a/0_0_h.bin", struct.pack("<4f", 1, -2, float("nan"), 4)), ("/a/0_0_n.bin", px((1, 2, 3, 1), (4, 5, 6, 0), (7, 8, 9, 9), (0, 0, 0, 0))), ("/a/0_0_i.bin", px((1, 1, 2, 255), (2, 2, 2, 255), (9, 1, 1, 0), (1, 1, 1, 255))),
        ("/a/0_0_w.bin", px((200, 50, 5, 255), (200, 50, 6, 255), (0, 0, 0, 255), (255, 255, 0, 1))), ("/b/1_-2_h.bin", b"12345"), ("/b/3_0_h.bin", b""), ("/b/readme", b"x"),
    ]
    df = spark.createDataFrame(files, "path string, content binary").withColumn("length", F.octet_length("content"))
    tiles = terrain.terrain_stats(df)
    got = {r["path"]: (r["dir"], r["tx"], r["ty"], r["side"], r["stats"], r["problem"]) for r in tiles.collect()}
    assert len(got) == 6
    assert got["/a/0_0_h.bin"] == ("/a", 0, 0, 2, {"low": -2.0, "high": 4.0, "sum": 3.0, "not_finite": 1.0}, None)
    assert got["/a/0_0_n.bin"][4] == {"x_low": 0.0, "x_high": 7.0, "y_low": 0.0, "y_high": 8.0, "z_low": 0.0, "z_high": 9.0, "seam": 2.0, "seam_on_edge": 1.0}
    assert got["/a/0_0_i.bin"][4] == {"layers": 3.0, "alpha_off": 1.0} and got["/a/0_0_w.bin"][4] == {"over": 2.0, "alpha_off": 1.0}
    assert got["/b/1_-2_h.bin"][3] is None and got["/b/1_-2_h.bin"][5] and got["/b/3_0_h.bin"][3] == 0
    scenes = {r["dir"]: tuple(r)[1:] for r in terrain.scene_stats(tiles).collect()}
    assert scenes["/a"] == (4, 0, -2.0, 4.0, 1.0) and scenes["/b"] == (2, 1, None, None, None)
    assert terrain.disagreeing_tiles(tiles, df).count() == 0
    assert [r["path"] for r in terrain.disagreeing_tiles(tiles, df.withColumn("length", F.when(F.col("path") == "/a/0_0_w.bin", 64).otherwise(F.col("length")))).collect()] == ["/a/0_0_w.bin"]


@settings(max_examples=150, deadline=None)
@given(VALUES, st.randoms(use_true_random=False))
def test_any_written_form_comes_back(value, rng):
    """Numbers and counts in wider forms than needed, texts repeated or not: the tape gives the same bytes."""
    seen: dict[str, int] = {}
    numbered = 0

    def text(s):
        nonlocal numbered
        if s in seen and rng.random() < 0.5:
            return struct.pack("<I", seen[s])
        form = 1 if s.isascii() and rng.random() < 0.8 else 2
        if form == 1:
            seen[s], numbered = numbered, numbered + 1
        return struct.pack("<I", form << 30 | len(s.encode())) + s.encode()

    def several(kind, n):
        return bytes((binary.TAGS[f"{kind}_u8"], n)) if n < 256 and rng.random() < 0.6 else bytes([binary.TAGS[f"{kind}_i32"]]) + struct.pack("<i", n)

    def put(v):
        t = binary.TAGS
        if v is None or v is True or v is False:
            return bytes([t[{None: "null", True: "true", False: "false"}[v]]])
        if isinstance(v, int):
            ways = [bytes([t["zero"]])] if v == 0 else []
            ways += [bytes((t["u8"], v))] if 0 <= v < 256 else []
            return rng.choice([*ways, bytes([t["i32"]]) + struct.pack("<i", v)])
        if isinstance(v, float):
            return bytes([t["f64"]]) + struct.pack("<d", v)
        if isinstance(v, str):
            return bytes([t["string"]]) + text(v)
        if isinstance(v, dict):
            return bytes([t["empty_object"]]) if not v and rng.random() < 0.5 else several("object", len(v)) + b"".join(text(k) + put(x) for k, x in v.items())
        return bytes([t["empty_array"]]) if not v and rng.random() < 0.5 else several("array", len(v)) + b"".join(map(put, v))

    data = b"HBSON\x00" + put(value)
    tape = binary.read_forms(data)
    assert binary.write_forms(tape) == data and binary.value_of(tape) == value


def test_odd_bits_and_deep_nesting():
    nan = b"HBSON\x00" + bytes([binary.TAGS["f64"]]) + bytes.fromhex("010000000000f47f")
    assert binary.write_forms(binary.read_forms(nan)) == nan
    deep = b"HBSON\x00" + bytes((binary.TAGS["array_u8"], 1)) * 50_000 + bytes([binary.TAGS["null"]])
    assert binary.write_forms(binary.read_forms(deep)) == deep


def test_spans_read_again(spark, tmp_path):
    one = '<?xml version="1.0"?><!-- <x> --><cdb v="a>b"><sheet name="it&amp;em"><I1 q=\'">\'><name>Zoë <b>x</b></name><name>two</name><list><line0><col>é</col></line0></list><none/></I1><I1><name>again</name></I1></sheet></cdb>'
    for k, text in enumerate((one, '<cdb><sheet name="s"><R><c></c></R></sheet></cdb>')):
        (tmp_path / f"l{k}").mkdir()
        (tmp_path / f"l{k}" / "x.xml").write_text(text)
    index = markup.span_index(spark, str(tmp_path))
    got = {(r["file"].split("/")[-2], r["sheet"], r["row"], r["path"], r["nth"]): r["value"] for r in markup.read_spans(index, 3).collect()}
    assert got == {
        ("l0", "it&em", "I1", "name[0]", 0): "Zoë <b>x</b>", ("l0", "it&em", "I1", "name[1]", 0): "two", ("l0", "it&em", "I1", "list[0].line0[0].col[0]", 0): "é", ("l0", "it&em", "I1", "none[0]", 0): "",
        ("l0", "it&em", "I1", "name[0]", 1): "again", ("l1", "s", "R", "c[0]", 0): "",
    }
    assert index.count() == len(got)
    plain = '<cdb><sheet name="item"><I1><name>a <br/> b</name><list><line0><col>1</col></line0><line1><col/></line1></list></I1></sheet></cdb>'
    spans = [(s, r, p, plain.encode()[a : a + n].decode()) for s, r, p, _, a, n in markup.value_spans(plain.encode())]
    assert spans == list(markup.leaves(plain))


@pytest.mark.parametrize("bad", ["<cdb><sheet>", "<cdb></sheet>", "<cdb><!-- ", '<cdb a="', "</cdb>"])
def test_broken_exports_raise(bad):
    with pytest.raises(ValueError):
        list(markup.value_spans(bad.encode()))


def test_type_texts(spark):
    rows = [(1, "obj", "Ship", None), (2, "null", None, [1]), (3, "fun", None, [2, 1, 4]), (4, "base", "i32", []), (5, "fun", None, [4]), (6, "fun", None, [6, 3, 4]), (7, "fun", None, [8, 4]), (8, "null", None, [7]), (9, "fun", None, [99, 7, 7]), (10, "fun", None, [])]
    got = {r["id"]: r["display"] for r in type_display(spark.createDataFrame(rows, "id int, kind string, name string, parts array<int>")).collect()}
    assert got == {
        1: "Ship", 2: "?Ship", 3: "(?Ship,Ship)->i32", 4: "i32", 5: "()->i32", 6: "(#6,(?Ship,Ship)->i32)->i32", 7: "(?#7)->i32", 8: "?(#8)->i32",
        9: "(?99,(?#7)->i32)->(?#7)->i32", 10: "()->void",
    }


def test_half_and_half(spark):
    df = spark.range(100).withColumn("odd", F.col("id") % 10 == 3)
    got = ordinals.half_and_half(df, "id", F.col("odd"), 9, seed=2).collect()
    assert [r["half"] for r in got].count(1) == 5 and len(got) == 9
    few = ordinals.half_and_half(df, "id", F.col("id") < 2, 9, seed=2).collect()
    assert [r["half"] for r in few].count(1) == 2 and len(few) == 9
