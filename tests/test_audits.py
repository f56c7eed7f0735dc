"""Extraction, promotion, placement, keyed tables, parity, evidence and shifts: refusals, reruns and edge cases."""

from __future__ import annotations

import hashlib
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheafwork.functions import reports
from sheafwork.operators import placement, quality, spatial
from sheafwork.operators.tables import KeyedTables, with_fallback
from sheafwork.sources import archive, extraction, promotion

FILES = {"a/x.txt": b"hello", "a/y.bin": bytes(range(256)) * 40, "b": b"", "c/bad": b"wrong"}


@pytest.fixture
def archives(spark, tmp_path):
    archive.write_pak(str(tmp_path / "in" / "one.pak"), FILES, harmed=frozenset({"c/bad"}))
    archive.write_pak(str(tmp_path / "in" / "two.pak"), {"a/x.txt": b"other", "d": b"dd", "..": b"up"})
    (tmp_path / "in" / "three.pak").write_bytes(b"no archive")
    return extraction.entries_of(extraction.archives_below(spark, str(tmp_path / "in")))


def report_of(report):
    return {(r["uri"].rpartition("/")[2], r["path"]): (r["action"], r["problem"] is not None) for r in report.collect()}


def test_extraction_is_checked_and_goes_on(spark, tmp_path, archives):
    out = tmp_path / "out"
    first = report_of(extraction.extract(archives.where("path = 'a/x.txt' OR path IS NULL"), str(out)))
    assert first == {("one.pak", "a/x.txt"): ("written", False), ("two.pak", "a/x.txt"): ("refused", True), ("three.pak", None): ("refused", True)}
    (out / "a" / "y.bin").write_bytes(b"half of it")
    stamp = (out / "a" / "x.txt").stat().st_mtime_ns
    report = extraction.extract(archives, str(out))
    got = report_of(report)
    assert got == {
        ("one.pak", "a/x.txt"): ("kept", False), ("one.pak", "a/y.bin"): ("written", False), ("one.pak", "b"): ("written", False), ("one.pak", "c/bad"): ("refused", True),
        ("two.pak", "a/x.txt"): ("refused", True), ("two.pak", "d"): ("written", False), ("two.pak", ".."): ("refused", True), ("three.pak", None): ("refused", True),
    }
    assert (out / "a" / "x.txt").stat().st_mtime_ns == stamp and (out / "a" / "y.bin").read_bytes() == FILES["a/y.bin"]
    assert sorted(p.name for p in out.rglob("*") if p.is_file()) == ["b", "d", "x.txt", "y.bin"]  # no parts, no bad member
    manifest = extraction.manifest_of(report)
    assert {r["path"]: r["sha256"] for r in manifest.collect()} == {p: hashlib.sha256((out / p).read_bytes()).hexdigest() for p in ("a/x.txt", "a/y.bin", "b", "d")}
    again = extraction.extract(archives, str(out))
    assert sorted(map(str, extraction.manifest_of(again).collect())) == sorted(map(str, manifest.collect()))
    assert {r["action"]: r["members"] for r in extraction.summary_of(again).collect()} == {"kept": 4, "refused": 4}
    assert extraction.verify(manifest, str(out)).count() == 0
    (out / "d").unlink()
    (out / "b").write_bytes(b"!")
    (out / "a" / "x.txt").write_bytes(b"HELLO")
    assert {tuple(r) for r in extraction.verify(manifest, str(out)).collect()} == {("d", "missing"), ("b", "size"), ("a/x.txt", "content")}


def tree(path):
    return {str(p.relative_to(path)): p.read_bytes() for p in path.rglob("*.parquet")}


def test_promotion_is_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    root, key, columns = f"file://{tmp_path}/canonical", ["kind"], ["id", "v"]
    rows = [(k, i, i * 2, "b1") for k in ("007", "ab", "x y") for i in range(3)]
    draft = lambda some: spark.createDataFrame(some, "kind string, id int, v int, build string")
    universe = draft(rows).select("kind").distinct()
    actions = lambda plan: {r["kind"]: (r["action"], r["version"]) for r in plan.collect()}
    seen = lambda: sorted(map(str, (tuple(r) for r in promotion.read_version(spark, root, key).select("kind", "id", "v").collect())))
    put = lambda some, build="b1", u=None: promotion.promote_version(draft(some), root, key, columns, "build", build, u)
    assert promotion.read_version(spark, root, key) is None
    assert {a for a, _ in actions(put(rows[3:], u=universe)).values()} == {"absent", "new"} and promotion.current_version(spark, root) == 0
    put(rows)
    assert promotion.current_version(spark, root) == 1 and len(seen()) == 9
    one, before = tree(tmp_path / "canonical" / "data"), seen()
    for refused, why in ((rows[3:], "ghost"), ([*rows[:8], ("x y", 2, 4, "b0")], "drift")):
        plan = actions(put(refused))
        assert why in {a for a, _ in plan.values()} and all(v is None for _, v in plan.values())
    assert "stray" in {a for a, _ in actions(put([*rows, ("zz", 1, 1, "b1")], u=universe)).values()}
    assert tree(tmp_path / "canonical" / "data") == one and seen() == before
    assert "stray" in {a for a, _ in actions(put([*rows, (None, 1, 1, "b1")])).values()}
    changed = [(k, i, v + (k == "ab"), "b2") for k, i, v, _ in rows]
    with monkeypatch.context() as m:  # dies before the pointer: nothing has changed for readers
        m.setattr(promotion, "_point", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            put(changed, "b2")
        assert seen() == before and promotion.current_version(spark, root) == 1
    assert actions(put(changed, "b2")) == {"007": ("unchanged", 1), "ab": ("changed", 2), "x y": ("unchanged", 1)}
    after = tree(tmp_path / "canonical" / "data")
    assert {k: v for k, v in after.items() if "promoted=1" in k} == one and seen() != before
    assert sorted(map(str, (tuple(r) for r in promotion.read_version(spark, root, key, 1).select("kind", "id", "v").collect()))) == before
    assert actions(put(changed, "b2")) == {"007": ("unchanged", 1), "ab": ("unchanged", 2), "x y": ("unchanged", 1)} and promotion.current_version(spark, root) == 2
    with pytest.raises(RuntimeError):
        promotion._point(spark, root, 3, expected=1)
    assert promotion.current_version(spark, root) == 2


def test_every_scene_ends_in_one_state(spark):
    nan = float("nan")
    scenes = spark.createDataFrame([("s1", "r", "poi"), ("s2", "r", "poi"), ("s3", "r", "poi"), ("s4", "r", "poi"), ("s5", None, "poi"), ("s5", None, "poi")], "source string, region string, kind string")
    anchors = spark.createDataFrame([("s1", 1.0, 1.0), ("s2", 99.0, 0.0), ("s4", nan, 0.0), ("gone", 1.0, 1.0)], "source string, x double, y double")
    placements = [("s1", "a", "q", 5.0, 5.0, True), ("s2", "b", "q", 2.0, 2.0, False), ("s2", "a", None, 2.0, 2.0, True), ("s2", "c", None, 1.0, 9.0, None), ("s2", "d", None, nan, 0.0, True), ("s3", "e", None, None, 1.0, True), ("s9", "f", None, 1.0, 1.0, True)]
    df = spark.createDataFrame(placements, "source string, ref string, region string, x double, y double, exact boolean")
    points = placement.place_points(scenes, anchors, df, (0, 0, 10, 10))
    got = sorted((tuple(r) for r in points.collect()), key=str)
    assert got == sorted([
        ("s1", "anchored", "poi", "r", None, 1.0, 1.0, True, 1, None), ("s2", "placed", "poi", "r", "c", 1.0, 9.0, None, 1, None), ("s2", "placed", "poi", "q", "a", 2.0, 2.0, True, 2, None),
        ("s3", "refused", "poi", "r", None, None, None, None, 1, "nowhere"), ("s4", "refused", "poi", "r", None, None, None, None, 1, "nowhere"), ("s5", "unreferenced", "poi", None, None, None, None, None, 1, None),
    ], key=str)
    assert placement.placement_identity(scenes, points).count() == 0
    assert [tuple(r) for r in placement.placement_identity(scenes, points.where("source <> 's5'")).collect()] == [("s5", 0)]
    assert sorted(r["ref"] for r in placement.refused_placements(df, (0, 0, 10, 10)).collect()) == ["d", "e"]
    nodes = spark.createDataFrame([("w", "reference", "a", "x"), ("w", None, None, "y/layers2D/m.png"), ("w", "reference", None, None)], "scene string, type string, source string, path string")
    assert sorted(tuple(r) for r in placement.overlay(nodes).collect()) == [("w", "?", 1, 0, 1), ("w", "reference", 2, 1, 0)]


def test_tables_are_loaded_once_and_not_kept_when_they_fail(spark):
    loads, broken = [], {"fr"}
    raising = F.udf(lambda x: 1 // 0, "int")

    def load(key):
        loads.append(key)
        df = spark.range(10).withColumn("key", F.lit(key))
        return df.withColumn("id", raising("id")) if key in broken else df

    with KeyedTables(load, most=2) as tables:
        threads = [threading.Thread(target=lambda: tables.get("en").count()) for _ in range(4)]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
        assert loads == ["en"] and tables.get("en").storageLevel.useMemory
        with pytest.raises(Exception):
            tables.get("fr")
        assert tables.held() == ["en"]
        broken.clear()
        assert tables.get("fr").count() == 10 and loads == ["en", "fr", "fr"]
        assert with_fallback(tables, {"pt-br": "pt", "en": "en"}, "xx", "en").count() == 10 and loads[-1] == "fr"
        old = tables.get("fr")
        tables.get("en")
        tables.get("de")
        assert tables.held() == ["en", "de"] and not old.storageLevel.useMemory
        kept = tables.get("de")
    assert tables.held() == [] and not kept.storageLevel.useMemory


def test_parity_of_a_right_report(spark):
    matrix = spark.createDataFrame([("a | b", "x", 1, None), ("c\\", "y", 2, "z")], "k string, l string, n int, note string")
    marker = quality.table_digest(matrix, matrix.columns).select(F.concat(F.lit("<!-- digest: "), "digest", F.lit(" -->")).alias("line"))
    head = spark.createDataFrame([(x,) for x in ["# Title", *reports.markdown_head(matrix.columns)]], "line string")
    lines = head.union(reports.markdown_lines(matrix, ["k"])).union(marker)
    assert quality.catalog_parity(matrix, lines, ["k", "l"]).count() == 0
    assert [r["class"] for r in quality.catalog_parity(matrix, lines.where("line NOT LIKE '<!--%'"), ["k", "l"]).collect()] == ["marker"]
    assert quality.catalog_parity(matrix.limit(0), lines, ["k", "l"]).where("class = 'extra'").count() == 4


def test_evidence_that_is_false(spark):
    edges = spark.createDataFrame([("a", "b", "1", "x", "p.q[1]"), ("a", "b", "2", "x", "p.q[1]"), ("a", "b", "3", "x", "p"), ("a", "b", "1", "z", "p.q[0]"), ("a", "c", "1", "x", "p.q[1]"), ("d", "b", "1", "x", "p")], "from_kind string, to_kind string, from_id string, to_id string, path string")
    rows = spark.createDataFrame([("a", "1", '{"p":{"q":["z","x"]}}'), ("a", "2", '{"p":{"q":["x","y"]}}'), ("a", "3", "{}")], "kind string, id string, row string")
    ids = spark.createDataFrame([("b", "x"), ("b", "x")], "kind string, id string")
    proved = quality.rederived(edges, rows, ids)
    assert sorted((r["from_kind"], r["to_kind"], r["from_id"], r["to_id"], r["proof"]) for r in proved.collect()) == [("a", "b", "1", "x", "ok"), ("a", "b", "1", "z", "dangling"), ("a", "b", "2", "x", "other_value"), ("a", "b", "3", "x", "no_cell"), ("a", "c", "1", "x", "dangling"), ("d", "b", "1", "x", "no_row")]
    strata = {(r["from_kind"], r["to_kind"]): tuple(r)[2:] for r in quality.strata_proofs(edges, proved.where("to_kind = 'b'")).collect()}
    assert strata == {("a", "b"): (4, 4, 1), ("a", "c"): (1, 0, 0), ("d", "b"): (1, 1, 0)}


def test_shifts_by_brute_force(spark):
    rng = np.random.default_rng(8)
    a, b = rng.random((9, 14)) < 0.6, rng.random((11, 12)) < 0.4
    cells = lambda m: spark.createDataFrame([(int(r), int(c)) for r, c in zip(*np.nonzero(m))] or [(0, 0)], "row int, col int")
    got = {(r["dx"], r["dy"]): tuple(r)[2:] for r in spatial.iou_by_shift(cells(a), cells(b), 4).collect()}
    there = set(zip(*np.nonzero(b)))
    for dy in range(-4, 5):
        for dx in range(-4, 5):
            tp = sum((r + dy, c + dx) in there for r, c in zip(*np.nonzero(a)))
            assert got[dx, dy] == (tp, a.sum() - tp, b.sum() - tp, tp / (a.sum() + b.sum() - tp))
    none = spatial.iou_by_shift(cells(a).limit(0), cells(b).limit(0), 1).collect()
    assert len(none) == 9 and all(r["iou"] is None for r in none)
    moved = spatial.overlap_by_shift(spatial.runs_of(cells(a)), spatial.runs_of(cells(b)), 40)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in moved and "NestedLoop" not in moved
