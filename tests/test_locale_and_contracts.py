from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheafwork.operators import aggregates, contracts, locale, relations, spatial

LOCALES = ["de", "en", "fr"]


@pytest.fixture(scope="module")
def cells(spark):
    leaves = spark.createDataFrame(
        [("en", "item", "I1", "name[0]", "Oar"), ("de", "item", "I1", "name[0]", "Ruder"), ("fr", "item", "I1", "name[0]", "Rame"), ("en", "item", "I2", "name[0]", "Hull"), ("de", "item", "I2", "name[0]", ""), ("en", "item", "I1", "desc[0]", "long")],
        "locale string, sheet string, row string, path string, value string",
    )
    refs = spark.createDataFrame([("item", i, "item", i, f"{t}[0]", t) for i in ("I1", "I2", "I3") for t in ("name", "desc")], "kind string, id string, sheet string, row string, path string, template string")
    return locale.resolve_text_keys(refs, leaves, LOCALES)


def test_states_add_up(cells):
    rows = {r["locale"]: (r["n_ok"], r["n_empty"], r["n_missing"]) for r in locale.cell_counts(cells).collect()}
    assert rows == {"en": (3, 0, 3), "de": (1, 1, 4), "fr": (1, 0, 5)}


def test_availability_and_law(spark, cells):
    av = locale.entity_availability(cells)
    assert {r["id"]: (r["available"], r["named"]) for r in av.collect()} == {"I1": (LOCALES, LOCALES), "I2": (["en"], ["en"]), "I3": ([], [])}
    assert [r["id"] for r in locale.trimodal_breaks(av, LOCALES).collect()] == ["I2"]
    assert locale.trimodal_breaks(av, LOCALES, spark.createDataFrame([("item", "I2")], "kind string, id string")).count() == 0
    body = {(r["locale"], r["id"]): r["body"] for r in locale.overlays(cells).collect()}
    assert body["en", "I1"] == '{"desc[0]":"long","name[0]":"Oar"}' and ("de", "I2") not in body
    fields = {r["id"]: r["fields"] for r in aggregates.field_availability(cells, ["id"], "locale", "template", F.col("state") == "ok").collect()}
    assert fields["I2"]["en"] == '{"desc":false,"name":true}'


def test_structural_and_inline(spark):
    ids = spark.createDataFrame([("perk", "P1"), ("perk", "P2")], "kind string, id string")
    leaves = spark.createDataFrame([("en", "perks", "P1", "title[0]", "Swift"), ("en", "perks", "P9", "title[0]", "x"), ("en", "perks", "P1", "other[0]", "no")], "locale string, sheet string, row string, path string, value string")
    got = locale.structural_cells(ids, leaves, spark.createDataFrame([("perk", "perks")], "kind string, sheet string"), [r"^title\["])
    assert [(r["id"], r["state"]) for r in got.collect()] == [("P1", "ok")]
    patterns = spark.createDataFrame([("perk", "title"), ("perk", "note")], "kind string, template string")
    assert [r["template"] for r in locale.inline_fallback(spark.createDataFrame([("perk", "title")], "kind string, template string"), patterns).collect()] == ["note"]
    inv = locale.with_stamp(spark.createDataFrame([("en", "r1"), ("de", None)], "locale string, revision string"), "42")
    assert {r["locale"]: (r["stamp"], r["stamp_source"]) for r in inv.collect()} == {"en": ("r1", "header"), "de": ("42", "buildid-fallback")}


def test_contracts(spark):
    df = spark.createDataFrame([("item", "I1", 3), ("boat", None, 99)], "kind string, id string, n int")
    fields = [contracts.Field("kind", "string", choices=["item"]), contracts.Field("id", "string", pattern="^I"), contracts.Field("n", "int", low=0, high=50)]
    assert contracts.schema_breaks(df, fields) == [] and contracts.schema_breaks(df.drop("id").withColumn("x", F.lit(1)), fields) == ["id: missing", "x: not declared"]
    assert {(r["kind"], r["field"], r["rule"]) for r in contracts.row_breaks(df, ["kind"], fields).collect()} == {("boat", "kind", "choice"), ("boat", "id", "null"), ("boat", "n", "high")}
    meta = spark.createDataFrame([("a", "7", 1), ("b", "6", 2)], "kind string, build_id string, row_count long")
    rows = spark.createDataFrame([("a",), ("b",), ("c",)], "kind string")
    assert {(r["kind"], r["rule"]) for r in contracts.header_breaks(meta, rows, "7").collect()} == {("b", "build"), ("b", "count"), ("c", "no_header")}


def test_rasters(spark):
    tiles = spark.createDataFrame([("l", x, y, bytearray([10 * (x + 2 * y)] * 4)) for x in range(2) for y in range(2)], "layer string, x bigint, y bigint, data binary")
    small = spatial.downsampled_tiles(tiles, 2).first()
    assert list(small["data"]) == [0, 10, 20, 30]
    cells = spark.createDataFrame([(0, 0, True), (1, 0, True), (2, 0, False)], "x int, y int, land boolean")
    assert {(r["dx"], r["dy"]): r["coast"] for r in spatial.coast_sides(cells, "x", "y", "land").collect()} == {(1, 0): 1, (-1, 0): 1, (0, 1): 2, (0, -1): 2}
    values = spark.createDataFrame([(r, c, float(r == 1 and c == 1)) for r in range(4) for c in range(4)], "row int, col int, value double")
    curve = spatial.registration_curve(values, spark.createDataFrame([(2, 2)], "row int, col int"), 1)
    best = max(curve.collect(), key=lambda r: r["mean"])
    assert (best["dx"], best["dy"]) == (-1, -1)
    px = spark.createDataFrame([(200, 55), (100, 100)], "b int, a int")
    assert spatial.channel_census(px, ["b", "a"], ("b", "a")).first()["pair_breaks"] == 1
    v = spatial.transform_verdict(spark.createDataFrame([(0.9, 0.2)], "iou double, err double"), iou=F.col("iou") > 0.8, err=F.col("err") < 0.1).first()["verdict"]
    assert v == "REFUSED:err"
    assert spatial.lookup_pixels(spark.createDataFrame([(9,)], "p int"), F.col("p"), F.col("p"), values).first()["value"] == -1
    assert np.isclose(spark.createDataFrame([([(0.0, 0.0, 90.0, 1.0), (1.0, 0.0, 0.0, 1.0)],)], "c array<struct<x: double, y: double, angle: double, scale: double>>").select(spatial.frame(F.col("c")).alias("f")).first()["f"]["y"], 1.0)


def test_carriers_and_tokens(spark):
    cells = spark.createDataFrame([("item", "I1", "p[0].s", "p[].s", "S1"), ("item", "I1", "p[1].s", "p[].s", "S1"), ("item", "I2", "p[0].s", "p[].s", "S9"), ("item", "I2", "q", "q", "S1")], "kind string, id string, path string, norm_path string, value string")
    carriers = spark.createDataFrame([("item", "p[].s", "skill", "path:p[].s")], "kind string, norm_path string, target string, method string")
    ids = spark.createDataFrame([("skill", "S1")], "kind string, id string")
    edges, lost = relations.carrier_edges(cells, carriers, ids)
    assert [(r["from_id"], r["to_id"], r["evidence"]) for r in edges.collect()] == [("I1", "S1", "p[0].s,p[1].s")]
    assert [r["value"] for r in lost.collect()] == ["S9"]
    texts = spark.createDataFrame([("s1", "if Skill.S1 then Skill.S2 or Other.X")], "id string, src string")
    got = relations.token_references(texts, "id", "src", r"\w+\.\w+", spark.createDataFrame([("Skill", "skill")], "prefix string, kind string"), ids)
    assert {(r["to_id"], r["valid"]) for r in got.collect()} == {("S1", True), ("S2", False)}
