"""Hot groups, planted faults and edge cases of operators that were mended."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheafwork import session
from sheafwork.operators import graph, ordinals, quality, relations, spatial
from sheafwork.sources import records, writers


def brute_nearest(points):
    p = np.array([q[1:] for q in points], float)
    out = {}
    for k, (i, *_) in enumerate(points):
        d = np.sqrt((p[:, 0] - p[k, 0]) ** 2 + (p[:, 1] - p[k, 1]) ** 2)
        d[k] = np.inf
        out[i] = (min(points[j][0] for j in np.flatnonzero(d == d.min())), d.min())
    return out


@pytest.mark.parametrize("shape", ["uniform", "clusters", "lattice", "line", "pair"])
def test_nearest_neighbours_by_brute_force(spark, shape):
    rng = np.random.default_rng(4)
    if shape == "uniform":
        xy = rng.random((700, 2))
    elif shape == "clusters":  # a dense heap, a wide one, far loners and repeated places
        xy = np.concatenate([rng.normal(0, 1e-9, (400, 2)), rng.normal(50, 3, (200, 2)), [[1e6, 1e6], [-1e6, 3.0]], np.repeat([[7.0, 7.0], [0.0, -0.0]], 20, axis=0)])
    elif shape == "lattice":
        xy = np.array([(a, b) for a in range(23) for b in range(23)], float)
    elif shape == "line":
        xy = np.stack([np.cumsum(rng.random(300) ** 8), np.zeros(300)], axis=1)
    else:
        xy = np.array([[1.0, 2.0], [4.0, 6.0]])
    ids = rng.permutation(len(xy)) * 3
    points = [(int(i), float(a), float(b)) for i, (a, b) in zip(ids, xy)]
    got = {r["id"]: (r["nearest"], r["distance"]) for r in spatial.nearest_neighbours(spark.createDataFrame(points, "id int, x double, y double"), "id", "x", "y").collect()}
    assert got == brute_nearest(points)


def test_nearest_neighbours_in_one_heap(spark):
    """100,000 points of which half are at one place, and the others closer together than a millionth of the whole."""
    points = spark.range(100_000).select("id", F.when(F.col("id") % 2 == 0, 5.0).otherwise(F.rand(1) * 1e-6).alias("x"), F.when(F.col("id") == 1, 1e3).otherwise(F.lit(0.25)).alias("y"))
    got = spatial.nearest_neighbours(points, "id", "x", "y")
    assert got.where("nearest IS NOT NULL").count() == 100_000
    assert got.where("id % 2 = 0 AND distance = 0").count() == 50_000


def test_polygons_of_all_sizes(spark):
    rng = np.random.default_rng(2)
    rings = [("whole", [(-1e6, -1e6), (1e6, -1e6), (1e6, 1e6), (-1e6, 1e6)]), ("tiny", [(0.1, 0.1), (0.2, 0.1), (0.1, 0.2)]), ("short", [(0.0, 0.0), (1.0, 1.0)]), ("void", None)]
    rings += [(f"p{k}", [(float(a), float(b)) for a, b in c + rng.normal(0, 10 ** rng.uniform(-2, 3), (5, 2))]) for k, c in enumerate(rng.normal(0, 50, (40, 2)))]
    rings += [("gap", [(0.0, 0.0), (1.0, None), (1.0, 1.0)]), ("nan", [(0.0, 0.0), (float("nan"), 2.0), (1.0, 1.0)]), ("hole", [(0.0, 0.0), None, (1.0, 1.0), (3.0, 3.0)])]
    points = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(0, 60, (300, 2)))]
    polygons = spark.createDataFrame(rings, "polygon string, ring array<struct<x: double, y: double>>")
    got = {(r["point"], r["polygon"]) for r in spatial.points_in_polygons(spark.createDataFrame(points, "point int, x double, y double"), polygons, 1.0).collect()}
    want = set()
    for i, x, y in points:
        for name, ring in rings:
            if ring and len(ring) >= 3 and all(p and None not in p and np.isfinite(p).all() for p in ring):
                crossed = sum(((a[1] > y) != (b[1] > y)) and x < (b[0] - a[0]) * (y - a[1]) / (b[1] - a[1]) + a[0] for a, b in zip(ring, ring[1:] + ring[:1]))
                want |= {(i, name)} if crossed % 2 else set()
    assert got == want
    assert {r["polygon"]: r["reason"] for r in spatial.broken_rings(polygons).collect()} == {"short": "short", "void": "missing", "gap": "vertex", "nan": "vertex", "hole": "vertex"}


def test_places_of_hot_groups(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 1000).alias("g"), ((F.col("id") * 7919) % 30_011).alias("o"))
    window = sorted(map(str, graph.places(df, ["g"], ["o"], "n", 10**6).collect()))
    assert sorted(map(str, graph.places(df, ["g"], ["o"], "n", 500).collect())) == window
    assert ordinals.occurrence_index(df, ["g"], ["o"]).agg(F.max("idx")).first()[0] == 9999


def test_needles_by_their_rarest_gram(spark):
    rows = spark.createDataFrame([(i, f"the common words and number {i} end" if i % 10 else None) for i in range(2000)] + [(5000, ""), (5001, "XY"), (5002, "x")], "id int, t string")
    needles = [f"number {k} " for k in range(0, 2000, 7)] + ["xy", "x", "", "the common", "none at all", None, "Xy"]
    tokens = spark.createDataFrame([(n, k) for k, n in enumerate(needles)], "token string, k int")
    key = lambda df: sorted((r["id"], r["k"]) for r in df.collect())
    few = key(relations.substring_matches(rows, "t", tokens, "token", 10**4))
    assert key(relations.substring_matches(rows, "t", tokens, "token", 3)) == few
    assert (5001, needles.index("Xy")) in few and not [x for x in few if x[1] == needles.index("")]


def test_owners_of_stems_without_a_dot(spark):
    folders = spark.createDataFrame([("a/x.dat",), ("a/y.dat",), ("a/b.1.dat",), ("a/.v.dat",)], "folder string")
    scenes = spark.createDataFrame([("a/.prefab",), ("a/b.prefab",)], "scene string")
    got = {r["folder"]: (r["owner"], r["evidence"]) for r in relations.scene_owners(folders, scenes, "folder", "scene").collect()}
    assert got == {"a/x.dat": (None, "unowned"), "a/y.dat": (None, "unowned"), "a/b.1.dat": ("a/b.prefab", "strip-dot-variant"), "a/.v.dat": ("a/.prefab", "strip-dot-variant")}


def test_terrain_folders_of_one_name_stay_apart(spark):
    files = spark.createDataFrame([("/w1/t/0_0_h.bin", 10), ("/w2/t/0_0_h.bin", 99), ("/w2/t/00_0_h.bin", 98), ("/w2/t/1_0_n.bin", 5), ("/w2/t/x.bin", 1)], "path string, length bigint")
    got = {(r["dir"], r["tx"], r["ty"]): (r["h"], r["n"]) for r in records.terrain_index(files).collect()}
    assert got == {("/w1/t", 0, 0): (10, None), ("/w2/t", 0, 0): (98, None), ("/w2/t", 1, 0): (None, 5)}
    assert [tuple(r) for r in records.terrain_repeats(files).collect()] == [("/w2/t", 0, 0, "h", 2, True)]


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="checkpoint"):
        session.shared_folder(Session())
    Session.conf = {"spark.checkpoint.dir": "hdfs:///x"}
    assert session.shared_folder(Session()) == "hdfs:///x"


def test_reports_beyond_one_text(spark, tmp_path):
    rows = [(1, "a|b", None), (2, "", "x\\y"), (3, "line\nbreak <br> |", "|"), (4, " | ", "\\|"), (5, "end\\", "z")]
    df = spark.createDataFrame(rows, "k int, v string, w string")
    with pytest.raises(ValueError):
        writers.markdown_table(df, ["k"], most=2)
    writers.write_markdown(df, str(tmp_path / "report"), ["k"])
    lines = spark.read.text(str(tmp_path / "report")).withColumnRenamed("value", "line")
    assert "".join(f.read_text() for f in sorted((tmp_path / "report").glob("part-*"))) == writers.markdown_table(df, ["k"])
    cells = {(r["k"], r["column"]): r["value"] for r in writers.markdown_cells(lines, ["k", "v", "w"], ["k"]).collect()}
    assert cells == {(str(k), c): x or "" for k, v, w in rows for c, x in (("v", v), ("w", w))}


def test_long_chains_and_far_nodes(spark):
    links = spark.range(1, 300).selectExpr("CAST(id AS INT) AS t", "CAST(id - 1 AS INT) AS up")
    assert graph.ancestors(links, "t", "up").agg(F.max("depth")).first()[0] == 299
