"""Operators whose rows the driver's tables can't show: files, deep payloads, outliers."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from sheafwork.functions import formulas
from sheafwork.functions import text as T
from sheafwork.operators import graph, ordinals, quality, relations, search, spatial, walk
from sheafwork.sources import records, writers


def test_nearest_of_outliers_and_lonely_points(spark):
    points = [(1, 0.0, 0.0), (2, 1.0, 0.0), (3, 1e9, 0.0), (4, None, 1.0), (5, float("nan"), 0.0)]
    got = {r["id"]: (r["nearest"], r["distance"]) for r in spatial.nearest_neighbours(spark.createDataFrame(points, "id int, x double, y double"), "id", "x", "y").collect()}
    assert got == {1: (2, 1.0), 2: (1, 1.0), 3: (2, 1e9 - 1), 4: (None, None), 5: (None, None)}
    one = spatial.nearest_neighbours(spark.createDataFrame(points[:1], "id int, x double, y double"), "id", "x", "y").collect()
    assert [tuple(r) for r in one] == [(1, None, None)]
    assert spatial.nearest_neighbours(spark.createDataFrame([], "id int, x double, y double"), "id", "x", "y").count() == 0


def test_walk_scans_once_and_lists_malformed_rows(spark, tmp_path):
    rows = [(1, '{"a": {"b": [1, {"c": null, "d": "x"}], "e": {}}, "f": true}'), (2, "{not json"), (3, None), (4, "7"), (5, "[]"), (6, '{"a": [[1, 2], []]}')]
    spark.createDataFrame(rows, "id int, row string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    cells = walk.walk_json(df, ["id"], "row", 5)
    assert sorted((r["id"], r["path"], r["norm_path"], r["value"]) for r in cells.collect()) == [
        (1, "a.b[0]", "a.b[]", "1"), (1, "a.b[1].d", "a.b[].d", "x"), (1, "f", "f", "true"), (4, "", "", "7"), (6, "a[0][0]", "a[][]", "1"), (6, "a[0][1]", "a[][]", "2")]
    assert cells._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert [tuple(r) for r in walk.malformed(df, ["id"], "row").collect()] == [(2, 9, "{not json")]
    with pytest.raises(Exception, match="deeper"):
        walk.walk_json(df, ["id"], "row", 1).collect()


def test_tokens_outside_comments_keep_their_offsets(spark):
    text = "Item.One // Item.Two\nx /* Item.Three\n*/ Skill.Four <é> Item.One"
    found = T.token_offsets(T.blank_spans(F.col("t"), r"/\*.*?\*/|//[^\n]*"), r"[A-Z][a-z]+\.[A-Z][a-z]+")
    got = spark.createDataFrame([(text,), ("",), (None,)], "t string").select(found.alias("x")).collect()
    assert [(r["token"], r["offset"]) for r in got[0]["x"]] == [("Item.One", 0), ("Skill.Four", text.index("Skill")), ("Item.One", text.rindex("Item"))]
    assert got[1]["x"] == [] and got[2]["x"] is None


def test_many_substrings_as_few(spark):
    rows = spark.createDataFrame([(1, "The Old Tower"), (2, "ab"), (3, ""), (4, "b"), (5, None)], "id int, t string")
    tokens = spark.createDataFrame([("old",), ("tower",), ("AB",), ("b",), ("",), ("owl",)], "token string")
    key = lambda df: sorted((r["id"], r["token"]) for r in df.collect())
    assert key(relations.substring_matches(rows, "t", tokens, "token", 2)) == key(relations.substring_matches(rows, "t", tokens, "token"))


def test_signatures(spark):
    df = spark.createDataFrame([("(a,(b,c)->d)->r",), ("()->void",), ("((x)->y)->(z)->w",), ("no",)], "s string")
    got = [r[0] and (list(r[0]["arguments"]), r[0]["result"]) for r in df.select(T.signature_parts(F.col("s"))).collect()]
    assert got == [(["a", "(b,c)->d"], "->r"[2:]), ([], "void"), (["(x)->y"], "(z)->w"), None]


def test_sheet_database_and_folders(spark, tmp_path):
    doc = {"sheets": [{"name": "item", "columns": [{"name": "id", "typeStr": "0"}, {"name": "n", "typeStr": "3", "opt": True, "kind": "x"}], "lines": [{"id": "a", "n": 1}, {"id": "b", "more": {"k": [1]}}]}, {"name": "none", "columns": [], "lines": []}], "customTypes": [{"name": "E", "cases": [{"name": "A", "args": []}, {"name": "B"}]}]}
    (tmp_path / "db.json").write_text(json.dumps(doc, indent=1))
    dictionary, lines, cases = records.read_sheet_database(spark, str(tmp_path / "db.json"))
    assert [tuple(r) for r in dictionary.orderBy("ord").collect()] == [("item", 0, "id", "0", False, None), ("item", 1, "n", "3", True, "x")]
    assert [(r["sheet"], r["ord"], json.loads(r["row"])) for r in lines.orderBy("ord").collect()] == [("item", 0, {"id": "a", "n": 1}), ("item", 1, {"id": "b", "more": {"k": [1]}})]
    assert [tuple(r) for r in cases.orderBy("ord").collect()] == [("E", 0, "A"), ("E", 1, "B")]
    land = tmp_path / "land"
    land.mkdir()
    for name, size in (("-1_2_h.bin", 4), ("-1_2_n.bin", 6), ("3_0_w.bin", 2), ("readme.txt", 1), ("x.prefab", 3)):
        (land / name).write_bytes(b"x" * size)
    assert records.files_with_suffix(spark, str(land), [".prefab", ".l3d"]).count() == 1
    index = records.terrain_index(records.files_with_suffix(spark, str(land), [".bin"]))
    got = [(r["dir"].rpartition("/")[2], *tuple(r)[1:]) for r in index.collect()]
    assert sorted(map(str, got)) == sorted(map(str, [("land", -1, 2, 4, 6, None, None), ("land", 3, 0, None, None, None, 2)]))


def test_rules_by_hand(spark):
    one = spark.range(1)
    value = lambda c: one.select(c).first()[0]
    lit = F.lit
    assert value(formulas.local_price(lit(10.0), lit(150.0), 100, 2.0)) == 20.0 and value(formulas.local_price(lit(10.0), lit(20.0), 100, 2.0)) == 10.0
    assert value(formulas.local_price(lit(10.0), lit(None).cast("double"), 100, 2.0)) == 12.0
    assert value(formulas.next_level_xp(lit(101), lit(None).cast("double"))) == 120 and value(formulas.next_level_xp(lit(100), lit(1.0))) == 100
    assert [value(formulas.capture_chance(lit(h), 0.1, 0.5, 100, 50)) for h in (0.0, 0.1, 0.2, 0.5, 0.9)] == [100.0, 100.0, 75.0, 50.0, 50.0]
    assert value(formulas.guard_left(lit(70), lit(30), lit(25), lit(False), 80, 50)) == 60 and value(formulas.guard_left(lit(70), lit(30), lit(25), lit(True), 80, 50)) == 10
    assert [value(formulas.weapon_price(lit(3), lit(r))) for r in (0, 1, 2)] == [40, 60, 70]


def test_numbers_across_ranges(spark):
    rows = [(g, i * 7 % 501) for g in ("hot",) for i in range(500)] + [("cold", 3), (None, 2), (None, 1)]
    got = graph.numbered(spark.createDataFrame(rows, "g string, v int").repartition(7), ["g"], ["v"], "n").collect()
    want: dict = {}
    for g, v in sorted(rows, key=lambda r: (r[0] or "", r[1])):
        want[g, v] = sum(h == g for h, _ in want)
    assert {(r["g"], r["v"]): r["n"] for r in got} == want
    assert graph.numbered(spark.createDataFrame([], "g string, v int"), ["g"], ["v"], "n").count() == 0
    ids = ordinals.synthetic_ids(spark.range(12).withColumnRenamed("id", "v"), "k", ["v"], width=1).orderBy("v").collect()
    assert [r["id"] for r in ids] == [f"k-{i}" for i in range(12)]


def test_extents_of_one_long_file(spark):
    extents, at, faults = [], 0, []
    for i in range(400):
        shift = {50: 3, 51: -1, 250: 2}.get(i, 0)
        if shift:
            faults.append(("gap" if shift > 0 else "overlap", shift))
        at += shift
        extents.append(("f", at, 10))
        at += 10
    df = spark.createDataFrame([*extents, ("g", 5, 1)], "file string, pos long, size long").repartition(9)
    got = quality.contiguity(df, "pos", "size", ["file"]).orderBy("pos").collect()
    assert [(r["class"], r["delta"]) for r in got] == faults


def test_stratified_sample_is_that_of_all_rows(spark):
    df = spark.createDataFrame([(i % 3 if i < 90 else 3, i) for i in range(92)], "g int, id int")
    ranked = {r["id"]: (r["g"], r["h"]) for r in df.withColumn("h", ordinals.seeded(F.col("id"), 5)).collect()}
    order = sorted(ranked, key=lambda i: (sum(ranked[j][0] == ranked[i][0] and (ranked[j][1], j) < (ranked[i][1], i) for j in ranked) >= 2, ranked[i][1], i))
    assert {r["id"] for r in ordinals.stratified_sample(df, ["g"], "id", 2, 30, seed=5).collect()} == set(order[:30])


def test_mosaic_rows(spark):
    tiles = spark.createDataFrame([("l", 4, 2, bytearray(b"abcd")), ("l", 5, 3, bytearray(b"wxyz")), ("l", 5, 3, bytearray(b"wxyz"))], "layer string, x bigint, y bigint, data binary")
    rows = {r["row"]: bytes(r["data"]) for r in spatial.mosaic_rows(tiles, 2).collect()}
    assert rows == {0: b"ab\0\0", 1: b"cd\0\0", 2: b"\0\0wx", 3: b"\0\0yz"}
    assert spatial.mosaic(tiles, 2).first()["holes"] == 2


def test_search_of_many_queries(spark, monkeypatch):
    rows = spark.createDataFrame([("k", i, n) for i, n in enumerate(["oar", "long oar", "boar", "oa", "", None, "o"])], "kind string, id int, norm string")
    queries = spark.createDataFrame([("oar",), ("oa",), ("bo",), ("o",)], "q string")
    hits = lambda: sorted((r["q"], r["id"], r["tier"], r["rank"]) for r in search.search_all(rows, queries, ["k"], 3).collect())
    few = hits()
    monkeypatch.setattr(search, "FEW_QUERIES", 2)
    assert hits() == few and ("oar", 2, 3, 3) in few


def test_first_matching_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("\n".join(f"line {i} {'x' if i % 2 else 'y'}" for i in range(10)))
    (tmp_path / "b.txt").write_text("none")
    assert [tuple(r) for r in records.matching_lines(spark, str(tmp_path), "x$").collect()] == [("a.txt", [2, 4, 6])]


def test_owners_by_ranked_names(spark):
    folders = spark.createDataFrame([("a/m.dat",), ("a/m.2.dat",), ("a/k.dat",), ("b/m.dat",), ("top.dat",), ("a/m.dat",), (None,)], "folder string")
    scenes = spark.createDataFrame([("a/m.prefab",), ("a/k_long.prefab",), ("a/k_b.prefab",), ("a/k_a.prefab",), ("top.prefab",), ("b/m.txt",), (None,)], "scene string")
    got = {r["folder"]: (r["owner"], r["evidence"]) for r in relations.scene_owners(folders, scenes, "folder", "scene").collect()}
    assert got == {
        "a/m.dat": ("a/m.prefab", "same-stem"), "a/m.2.dat": ("a/m.prefab", "strip-dot-variant"), "a/k.dat": ("a/k_a.prefab", "prefix-match"),
        "b/m.dat": (None, "unowned"), "top.dat": ("top.prefab", "same-stem"),
    }


def test_wiring_without_families_or_ledger(spark):
    dirs = spark.createDataFrame([("a", "b", "modeled", None), ("b", "a", "missing", "find a carrier")], "from_kind string, to_kind string, status string, unblock string")
    families = spark.createDataFrame([], "family string, from_kind string, to_kind string, edges bigint, mechanisms string")
    classed = relations.family_classes(families, dirs, spark.createDataFrame([], "kind string"))
    ledger = spark.createDataFrame([], "from_kind string, to_kind string, reason string")
    got = {r["from_kind"]: (r["standing"], r["unblock"]) for r in relations.wire_evidence(dirs, classed, ledger).collect()}
    assert got == {"a": ("modeled", None), "b": ("open", "find a carrier")}
    assert relations.evidence_conflicts(dirs, classed, ledger).isEmpty()


def test_geography_of_no_tiles_and_a_given_box(spark):
    none = spark.createDataFrame([], "path string, hash string")
    assert spatial.tile_geography(none, "s", "p").isEmpty()
    one = spark.createDataFrame([("/w/albedo/t_x-1_y0.dds", "p"), ("/w/splat/t_x-1_y0.dds", "s"), ("/w/splat/t_x0_y0.dds", "s"), (None, "s")], "path string, hash string")
    got = sorted(tuple(r) for r in spatial.tile_geography(one, "s", "p", (-1, 0, 0, 0)).collect())
    assert got == [(-1, 0, "sea", True), (0, 0, "hole", False)]


def test_carriers_that_do_not_agree(spark):
    rows = [(-12, -3, 256), (-12, 0, 256), (-13, -3, 256), (-12, -3, 255), (-12, -3, 128), (None, -3, 256), (12, -3, 256)]
    got = [r["broken"] for r in spatial.carrier_transform(spark.createDataFrame(rows, "o int, m int, w int"), "o", "m", "w", 512, 64).collect()]
    assert got == [None, "offset", "offset", "size", "span", "offset", "offset"]


def test_documents_refuse_many_layers(spark):
    with pytest.raises(ValueError, match="more than 2"):
        writers.registry_document(spark.range(3), {"kind": "map"}, ["id"], most=2)
    assert writers.registry_document(spark.range(0), {"kind": "map"}, ["id"]).first()[0] == '{"kind":"map","layers":[]}'
