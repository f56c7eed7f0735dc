"""Ledgers, required inputs and snapshots on small worlds."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from sheafwork.operators import aggregates, flow, relations, sheets
from sheafwork.sources import records, writers


def test_every_direction_has_one_class(spark):
    pair = "from_kind string, to_kind string"
    dirs = spark.createDataFrame([("a", "b", "modeled"), ("b", "a", "missing"), ("a", "c", "missing"), ("c", "a", "missing"), ("b", "c", "missing"), ("c", "b", "missing"), ("c", "d", "missing")], f"{pair}, status string")
    derived = spark.createDataFrame([("b", "a"), ("b", "a")], pair)
    declared = spark.createDataFrame([("b", "a"), ("a", "c")], pair)
    residual = spark.createDataFrame([("a", "c", "x", 9), ("c", "a", "p[].q", 2), ("c", "a", "z", 5), ("c", "a", "z", 1), ("c", "a", "y", 1), ("c", "a", "w", 1)], f"{pair}, norm_path string, hits int")
    terminal = spark.createDataFrame([("b", "terminal-view", "shows only")], "from_kind string, class string, reason string")
    got = {(r["from_kind"], r["to_kind"]): (r["class"], r["unblock"]) for r in relations.ledger_classes(dirs, derived, declared, residual, terminal).collect()}
    assert got == {
        ("b", "a"): ("derived-evidence", None), ("a", "c"): ("schema-empty", "a column of a names c and is never filled"), ("c", "a"): ("unadjudicated-name-hits", "10 equal names; z×6; p[].q×2; w×1"),
        ("b", "c"): ("terminal-view", "shows only"), ("c", "b"): ("no-carrier", "find a carrier"), ("c", "d"): ("no-carrier", "find a carrier"),
    }


def test_negated_columns_come_first(spark):
    dictionary = spark.createDataFrame([("s", "id", "0"), ("s", "not", "6:t"), ("s", "list", "8"), ("s", "none", "8")], "sheet string, name string, type_str string").withColumns({"opt": F.lit(False), "kind": F.lit(None).cast("string")})
    lines = spark.createDataFrame([("s", 0, json.dumps({"id": "a", "not": "t1", "list": [{"x": 1}]}))], "sheet string, ord int, row string")
    cells = sheets.declared_cells(dictionary, lines)
    negated = spark.createDataFrame([("s", "not"), ("s", "not")], "schema string, column string")
    got = {r["column"]: r["class"] for r in sheets.unadmitted(dictionary, cells, dictionary.select(F.col("sheet").alias("schema"), F.col("name").alias("column")).limit(0), negated).collect()}
    assert got == {"id": "plain", "not": "negated", "list": "compound_filled", "none": "compound_empty"}


def test_ids_by_owner(spark):
    rows = [("b/2", "x/own.v.prefab"), ("b/1", "x/own.v.prefab"), ("a", None), ("c", "other")]
    got = {r["folder"]: r["id"] for r in relations.allocated_ids(spark.createDataFrame(rows, "folder string, owner string"), 2).collect()}
    assert got == {"b/1": "own.v-00", "b/2": "own.v-01", "a": "unowned-00", "c": "other-00"}


def test_missing_inputs_name_their_stage(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    for name in ("gone", "empty"):
        with pytest.raises(FileNotFoundError, match="run harvest first"):
            records.required(spark, f"file://{tmp_path}/{name}", "harvest")
    for name, rows in (("t", [{"k": 1}, {"k": 2}]), ("u", [{"k": 1}]), ("header", [{"table": "t", "rows": 2}, {"table": "u", "rows": 3}])):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.json").write_text("\n".join(map(json.dumps, rows)))
    read, ledger = records.read_snapshot(spark, f"file://{tmp_path}", {"t": "k int", "u": "k int"}, "harvest")
    assert read["t"].count() == 2 and [tuple(r) for r in ledger.collect()] == [("u", 3, 1)]
    with pytest.raises(FileNotFoundError, match="run harvest first"):
        records.read_snapshot(spark, f"file://{tmp_path}", {"missing": "k int"}, "harvest")


def test_families_are_written_by_direction(spark, tmp_path):
    edges = spark.createDataFrame([("a", "b", "f", "2", "x", "path:1"), ("a", "b", "f", "1", "x", "token:2"), ("a", "c", "g", "1", "y", "path:1")], "from_kind string, to_kind string, family string, from_id string, to_id string, method string")
    stats = {(r["from_kind"], r["to_kind"]): tuple(r)[2:] for r in writers.write_families(edges, str(tmp_path / "out")).collect()}
    assert stats == {("a", "b"): ("f", 2, 2, 1, "path+token"), ("a", "c"): ("g", 1, 1, 1, "path")}
    lines = [json.loads(x)["from_id"] for p in sorted((tmp_path / "out" / "edges" / "from_kind=a" / "to_kind=b").glob("*.json")) for x in p.read_text().splitlines()]
    assert lines == ["1", "2"]


def test_dominators_of_a_nested_loop(spark):
    """0 -> 1 -> 2 -> 3 -> 2, 3 -> 1, 1 -> 4, and 5 that nothing reaches."""
    edges = spark.createDataFrame([("f", a, b) for a, b in ((0, 1), (1, 2), (2, 3), (3, 2), (3, 1), (1, 4), (5, 4))], "function string, a int, b int")
    got = {r["block"]: r["by"] for r in flow.dominators(edges, spark.createDataFrame([("f",)], "function string")).collect()}
    assert got == {0: [0], 1: [0, 1], 2: [0, 1, 2], 3: [0, 1, 2, 3], 4: [0, 1, 4]}


def test_places_without_a_name(spark):
    rows = spark.createDataFrame([(0,), (0,), (5,), (None,)], "place int")
    names = spark.createDataFrame([(0, "fire"), (1, "ice")], "place int, id string")
    assert {r["id"]: r["n"] for r in aggregates.counts_by_place(rows, "place", names).collect()} == {"fire": 2, "unknown": 2}
