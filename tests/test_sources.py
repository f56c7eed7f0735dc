"""Sources and writers: archives, notation, records, promotion, streams."""

from __future__ import annotations

import json
import struct

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sheafwork.operators.quality import contiguity
from sheafwork.sources import archive, binary, markup, records, writers
from sheafwork.streaming.edges import promote_stream

FILES = {"a.txt": b"hello", "d/é.bin": b"\x00" * 300, "d/e/empty": b"", "d/e/big": b"xyz" * 1000}


def test_archive_source(spark, tmp_path):
    p = str(tmp_path / "x.pak")
    archive.write_pak(p, FILES, wide=frozenset({"d/e/big"}))
    spark.dataSource.register(archive.PakSource)
    got = spark.read.format("pak").option("payload", "true").option("split", "100").load(p)
    assert {r["path"]: bytes(r["content"]) for r in got.collect()} == FILES
    entries = spark.read.format("pak").load(p)
    assert {r["path"] for r in archive.directories(entries).collect()} == {"d", "d/e"}
    assert contiguity(entries, "pos", "size").count() == 0
    assert [r["path"] for r in archive.with_prefix(entries, "d/e").collect()] == ["d/e/big", "d/e/empty"]


@pytest.mark.parametrize("harm", ["magic", "cut", "slack", "sum"])
def test_damaged_archives_raise(spark, tmp_path, harm):
    p = tmp_path / "x.pak"
    archive.write_pak(str(p), FILES)
    raw = bytearray(p.read_bytes())
    if harm == "magic":
        raw[0] = 0
    elif harm == "cut":
        raw[4:8] = struct.pack("<i", struct.unpack("<i", raw[4:8])[0] - 5)
    elif harm == "slack":
        raw[4:8] = struct.pack("<i", struct.unpack("<i", raw[4:8])[0] + 5)
    else:
        raw[-1] ^= 1
    p.write_bytes(bytes(raw))
    spark.dataSource.register(archive.PakSource)
    with pytest.raises(Exception):
        spark.read.format("pak").option("payload", "true").load(str(p)).collect()


VALUES = st.recursive(st.none() | st.booleans() | st.integers(-(2**31), 2**31 - 1) | st.text(max_size=8) | st.floats(allow_nan=False, allow_infinity=False), lambda x: st.lists(x, max_size=5) | st.dictionaries(st.text(max_size=5), x, max_size=5), max_leaves=30)


@settings(max_examples=150, deadline=None)
@given(VALUES)
def test_notation_round_trip(value):
    assert binary.decode_value(binary.encode_value(value)) == value


@pytest.mark.parametrize("raw", [b"nope", b"HBSON\x00", b"HBSON\x00\x63", b"HBSON\x00\x00\x00", b"HBSON\x00\x0a\x05\x00\x00\x00", b"HBSON\x00\x0d\xff\xff\xff\xff"])
def test_notation_refuses(raw):
    with pytest.raises(binary.NotationError):
        binary.decode_value(raw)


def test_markup_refuses_and_counts():
    assert [x[2] for x in markup.leaves("<c><sheet name='s'><E><a>1</a><a>2</a></E></sheet></c>")] == ["a[0]", "a[1]"]
    with pytest.raises(ValueError, match="not closed"):
        list(markup.leaves("<c><sheet name='s'>"))
    with pytest.raises(ValueError, match="closes nothing"):
        list(markup.leaves("<c></d></c>"))
    assert markup.header('<cdb version="3" revision="a&amp;b">') == {"version": "3", "revision": "a&b"}


def test_meta_jsonl_and_inventory(spark, tmp_path):
    (tmp_path / "item.jsonl").write_text('{"_meta": {"rowCount": 2}}\n{"id": 1}\n\nbroken\n{"id": 2}\n')
    meta, rows, faults = records.read_meta_jsonl(spark, str(tmp_path / "item.jsonl"))
    assert [json.loads(r["meta"]) for r in meta.collect()] == [{"rowCount": 2}]
    assert sorted(r["row"] for r in rows.collect()) == ['{"id": 1}', '{"id": 2}'] and faults.first()["line"] == "broken"
    (tmp_path / "inv.tsv").write_bytes(b"a/b\t0\t10\t5\tff\r\n")
    assert tuple(records.read_inventory(spark, str(tmp_path / "inv.tsv"), True).first()) == ("a/b", "0", 10, 5, 255)
    names = spark.createDataFrame([("item__skill.jsonl",), ("item.jsonl",)], "n string").select(records.pair_of_file(F.col("n")).alias("p")).select("p.*")
    assert [tuple(r) for r in names.collect()] == [("item", "skill"), (None, None)]


def test_promotion(spark, tmp_path):
    draft = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "kind string, v int")
    old = spark.createDataFrame([("a", 2), ("a", 1), ("b", 4)], "kind string, v int")
    plan = writers.promotion_plan(draft, old, ["kind"], ["kind", "v"])
    assert {r["kind"]: r["action"] for r in plan.collect()} == {"a": "unchanged", "b": "changed"}
    assert writers.promote(draft, str(tmp_path / "out"), plan, ["kind"]) == 1
    assert [r["v"] for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [3]
    ghost = writers.promotion_plan(draft.where("kind = 'a'"), old, ["kind"], ["kind", "v"])
    with pytest.raises(ValueError, match="ghost"):
        writers.promote(draft, str(tmp_path / "out"), ghost, ["kind"])
    universe = spark.createDataFrame([("a",), ("c",)], "kind string")
    assert {r["kind"]: r["action"] for r in writers.promotion_plan(draft, draft, ["kind"], ["kind", "v"], universe).collect()} == {"a": "unchanged", "b": "stray", "c": "absent"}


def test_stream_promotes_each_key_once(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    spark.createDataFrame([("a", 1), ("b", 2)], "kind string, v int").write.parquet(src)
    run = lambda: promote_stream(spark.readStream.schema("kind string, v int").parquet(src), out, str(tmp_path / "cp"), ["kind"], ["kind", "v"]).awaitTermination()
    run()
    spark.createDataFrame([("b", 5), ("c", 6)], "kind string, v int").write.mode("append").parquet(src)
    run()
    assert sorted((r["kind"], r["v"]) for r in spark.read.parquet(out).collect()) == [("a", 1), ("b", 5), ("c", 6)]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), ("b", 1, None)], "kind string, ord int, v string")
    writers.write_by(df, str(tmp_path / "w"), ["kind"], ["ord"])
    assert spark.read.json(str(tmp_path / "w" / "kind=a")).count() == 2
    assert [r["value"] for r in writers.canonical_json(df, ["v", "ord"]).collect()][2] == '{"ord":1}'
    assert writers.markdown_table(df, ["kind", "ord"]).splitlines()[2] == "| a | 1 | x |"
