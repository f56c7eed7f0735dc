"""Operators on small worlds: golden vectors, planted faults and laws."""

from __future__ import annotations

import hashlib
import re
import unicodedata
import zlib

import pytest
from pyspark.sql import functions as F

from sheafwork.functions.decode import adler32
from sheafwork.functions.text import direction_cell, escape_pooled, normalize_name, parse_direction_cell, unescape_entities, unescape_pooled
from sheafwork.operators import aggregates, graph, ordinals, quality, relations, search, spatial, walk

# Code points whose search form has to be just this.
NORMAL = [
    ("Ёж", "еж"), ("Épée", "epee"), ("Włóczęga", "wloczega"), ("Łódź", "lodz"), ("한국", "\u1112\u1161\u11ab\u1100\u116e\u11a8"), ("ㅎㅏㄴㄱㅜㄱ", "\u1112\u1161\u1102\u1100\u116e\u1100"), ("长剑", "长剑"), ("ＸＹ", "xy"), ("ß Straße", "ß straße"),
    # marks, brackets and white space, in our own words
    ("<i>Anchor</i>", "anchor"), ("<u>Tar</u> and Rope", "tar and rope"), ("Letter to [PORT]", "letter to"), ("[Mate]Oar", "oar"), ("<x>::hook::</x> Oar", "oar"), ("Deck   on\tDeck", "deck on deck"),
]
ROWS = [
    ("ship", "h-1", "Sea Otter"), ("crew", "w-1", "Otter"), ("ship", "h-2", "Otter"), ("port", "p-1", "Otter"), ("ship", "h-3", "Lotterie"), ("ship", "h-4", "Otterfell"), ("ship", "h-5", "Ottos"), ("ship", "h-6", "Ёлка"),
    ("port", "p-2", "Évora"), ("crew", "w-2", "부산"), ("ship", "h-7", "黄金海岸"), ("ship", "h-8", "<u>TarBarrel</u> Lantern"), ("crew", "w-3", "Remount Mount"), ("odd", "o-1", "Otter"),
]
QUERIES = ["otter", "ott", "ЁЛ", "evo", "부산", "海岸", "黄金海岸", "lantern", "barrel", "mount", "", " a ", "金", "nothing"]


def expected_hits(query):
    """The rule, by plain Python over search forms: exact, at a word's begin, anywhere; then length, kind, id."""
    q, kinds = plain_form(query), ["ship", "crew", "port"]
    hits = []
    for kind, id_, name in ROWS:
        n = plain_form(name)
        if len(q) >= 2 and q in n:
            tier = 1 if n == q else 2 if any(n.startswith(q, i) and (i == 0 or n[i - 1] == " ") for i in range(len(n))) else 3
            hits.append((tier, len(n), kinds.index(kind) if kind in kinds else len(kinds), id_))
    return [(id_, tier) for tier, *_, id_ in sorted(hits)]


def plain_form(text):
    text = re.sub(r"<[^>]*>|\[[^\]]*\]|::[A-Za-z0-9_]+::", " ", text)
    return " ".join("".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).lower().replace("ł", "l").split())


def test_search_form(spark):
    df = spark.createDataFrame(NORMAL, "raw string, want string").select("raw", "want", normalize_name(F.col("raw")).alias("got"))
    df = df.withColumn("again", normalize_name(F.col("got")))
    for r in df.collect():
        assert r["got"] == r["want"] == r["again"], r["raw"]
    assert spark.createDataFrame([(None,)], "raw string").select(normalize_name(F.col("raw"))).first()[0] is None


def test_normalize_all_reads_whole_texts(spark, tmp_path):
    from sheafwork.plans.texts import normalize_all

    def brute(text):
        text = re.sub(r"<[^>]*>|\[[^\]]*\]|::[A-Za-z0-9_]+::", " ", text)
        text = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
        return " ".join(text.lower().replace("ł", "l").split())

    texts = ["First Line\n Épée <b>two</b>\n\nŁódź [X] three", "\n\nonly later", "one", "", "a\r\n" + "Straße\n" * 3000]
    spark.createDataFrame([*enumerate(texts), (9, None)], "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r["norm"] for r in normalize_all(spark, str(tmp_path)).collect()}
    assert got == {**{i: brute(t) for i, t in enumerate(texts)}, 9: None}


def test_sizes_and_forms_of_all_rows(spark, tmp_path):
    from sheafwork.plans.texts import human_sizes, normalize_benchmark

    sizes = {1: (0, "0 B"), 2: (1023, "1023 B"), 3: (1536, "1.5 KiB"), 4: (1 << 20, "1.0 MiB"), 5: (5 << 19, "2.5 MiB"), 6: (1 << 30, "1.0 GiB"), 7: (None, None)}
    spark.createDataFrame([(i, n) for i, (n, _) in sizes.items()], "doc_id bigint, n_chars bigint").write.parquet(str(tmp_path / "documents.parquet"))
    assert {r["doc_id"]: r["size"] for r in human_sizes(spark, str(tmp_path)).collect()} == {i: want for i, (_, want) in sizes.items()}
    spark.createDataFrame([*enumerate(raw for raw, _ in NORMAL), (99, None)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {r["item_id"]: r["norm"] for r in normalize_benchmark(spark, str(tmp_path)).collect()}
    assert got == {**dict(enumerate(want for _, want in NORMAL)), 99: None}


@pytest.mark.parametrize("turn", [0, 7])
def test_search_ranking(spark, turn):
    rows = spark.createDataFrame(ROWS[turn:] + ROWS[:turn], "kind string, id string, name string").withColumn("n", normalize_name(F.col("name"))).cache()
    for q in QUERIES:
        assert [(r["id"], r["tier"]) for r in search.search(rows, q, ["ship", "crew", "port"], "n").collect()] == expected_hits(q), q
    assert expected_hits("otter")[:3] == [("h-2", 1), ("w-1", 1), ("p-1", 1)] and expected_hits("mount") == [("w-3", 2)]


def test_index_conflicts_and_strays(spark):
    av = spark.createDataFrame([("item", "I1", ["en", "fr"]), ("skill", "S1", ["en"])], "kind string, id string, named array<string>")
    ov = spark.createDataFrame([("en", "item", "I1", "Oar"), ("en", "skill", "S1", ""), ("de", "item", "I1", "Ruder"), ("en", "item", "I1", "Oar")], "locale string, kind string, id string, name string")
    got = {(r["id"], r["locale"], r["class"]) for r in search.index_conflicts(av, ov).collect()}
    assert got == {("I1", "fr", "flag_without_name"), ("S1", "en", "flag_without_name"), ("I1", "de", "name_without_flag"), ("I1", "en", "duplicate")}
    assert search.strays(ov, ["item"], ["en"]).count() == 2
    assert search.grouped_page(spark.createDataFrame([("b", "1", 1, "x"), ("a", "2", 1, "x"), ("z", "3", 1, "x")], "kind string, id string, tier int, norm string"), ["a", "b"], 2).count() == 2


def test_tri_state_resolution(spark):
    refs = spark.createDataFrame([("a", "b", "1", "x", "c", "hard"), ("a", "b", "2", "q", "c", "hard"), ("a", "empty", "3", "x", "c", "hard")], "from_kind string, to_kind string, from_id string, to_id string, column string, mechanism string")
    ids = spark.createDataFrame([("b", "x"), ("b", "x"), ("b", None)], "kind string, id string")
    got = {r["from_id"]: r["valid"] for r in relations.resolve(refs, ids).collect()}
    assert got == {"1": True, "2": False, "3": None}
    later = relations.revalidate(relations.resolve(refs, ids), spark.createDataFrame([("empty", "x"), ("b", "q")], "kind string, id string"))
    assert {r["from_id"]: r["valid"] for r in later.collect()} == {"1": True, "2": False, "3": True}


def test_planted_faults_flip_their_own_check(spark):
    ok = spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int")
    report = quality.report(quality.check(ok, "rows", F.count("*"), F.lit("2")), quality.empty_check(ok.where("v > 5"), "none"), quality.check(ok, "sum", F.sum("v"), F.lit("4")))
    assert {r["id"]: r["pass"] for r in report.collect()} == {"rows": True, "none": True, "sum": False}
    with pytest.raises(quality.QualityError, match="sum: 3 instead of 4"):
        quality.require(report)
    assert quality.require(report.where("id <> 'sum'")).count() == 2


def test_partition_and_contiguity(spark):
    whole = spark.range(5)
    assert quality.partition_identity([whole.where("id < 2"), whole.where("id >= 2")], whole, ["id"]).count() == 0
    assert {r["id"]: r["parts"] for r in quality.partition_identity([whole.where("id < 3"), whole.where("id BETWEEN 2 AND 3")], whole, ["id"]).collect()} == {2: 2, 4: 0}
    e = spark.createDataFrame([(0, 5), (5, 2), (8, 1), (8, 3)], "pos long, size long")
    assert [(r["class"], r["delta"]) for r in quality.contiguity(e, "pos", "size").orderBy("pos", "size").collect()] == [("gap", 1), ("overlap", -1)]
    c = quality.collisions(spark.createDataFrame([("a/b",), ("a/b",), ("A/b",), ("a",)], "path string"))
    assert {(r["path"], r["class"]) for r in c.collect()} == {("a/b", "duplicate"), ("a/b", "case"), ("A/b", "case"), ("a", "file_and_directory")}


def test_rows_and_affine(spark):
    pts = spark.createDataFrame([(float(x), float(y), 2.0 * x - 3.0 * y + 7.0) for x in range(4) for y in range(3)], "x double, y double, z double")
    r = aggregates.affine_fit(pts, "x", "y", "z").first()
    assert (round(r["a"], 9), round(r["b"], 9), round(r["c"], 9)) == (2, -3, 7)
    line = spark.createDataFrame([(float(x), 2.0 * x, 1.0) for x in range(5)], "x double, y double, z double")
    assert aggregates.affine_fit(line, "x", "y", "z").first()["a"] is None
    m = (2.0, 1.0, 3.0, 0.0, 4.0, -1.0)
    back = spatial.affine(*spatial.affine(F.col("x"), F.col("y"), m), spatial.inverse(m))
    assert all(abs(r["x"] - r["u"]) < 1e-9 and abs(r["y"] - r["v"]) < 1e-9 for r in pts.select("x", "y", back[0].alias("u"), back[1].alias("v")).collect())


def test_walk_depth_and_skips(spark):
    df = spark.createDataFrame([(1, '{"a": {"textKey": {"b": 1}, "c": [[1, 2], {"d": "x"}]}}'), (2, "not json"), (3, None)], "id int, row string")
    cells = walk.walk_json(df, ["id"], "row", 6, skip_below=["textKey"])
    assert {(r["path"], r["value"]) for r in cells.collect()} == {("a.c[0][0]", "1"), ("a.c[0][1]", "2"), ("a.c[1].d", "x")}
    with pytest.raises(Exception, match="deeper"):
        walk.walk_json(df, ["id"], "row", 1).collect()
    assert walk.below_path(cells, "a.c").count() == 3 and walk.at_path(cells, "a.c[].d").count() == 1


def test_graph_limits(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", "y")], "a string, b string")
    nodes = spark.createDataFrame([(n,) for n in "abcxy"], "node string")
    got = graph.distances(nodes, edges, nodes.where("node = 'a'"))
    assert {r["node"]: r["distance"] for r in got.collect()} == {"a": 0, "b": 1, "c": 2}
    with pytest.raises(RuntimeError):
        graph.ancestors(spark.createDataFrame([("a", "b"), ("b", "a")], "t string, up string"), "t", "up")


def test_escapes_and_checksums(spark):
    raw = "a\\n\tb\nc\\"
    r = spark.createDataFrame([(raw, "&lt;b&gt; &amp; &#233;")], "s string, h string").select(unescape_pooled(escape_pooled(F.col("s"))).alias("s"), unescape_entities("h").alias("h"), adler32(F.encode("s", "utf-8")).alias("a")).first()
    assert (r["s"], r["h"], r["a"]) == (raw, "<b> & é", zlib.adler32(raw.encode()))
    cell = spark.createDataFrame([("modeled", 12, "many:1"), ("missing", 0, "-")], "s string, e int, c string").select(parse_direction_cell(direction_cell(F.col("s"), F.col("e"), F.col("c"))).alias("p")).select("p.*")
    assert [tuple(x) for x in cell.collect()] == [("modeled", 12, "many:1"), ("missing", 0, None)]


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(1000).withColumn("g", F.col("id") % 7)
    a = ordinals.stratified_sample(df, ["g"], "id", 2, 30, seed=3).select("id").collect()
    b = ordinals.stratified_sample(df.repartition(13), ["g"], "id", 2, 30, seed=3).select("id").collect()
    assert sorted(a) == sorted(b) and len(a) == 30


def test_empty_tables(spark):
    e = spark.createDataFrame([], "from_kind string, to_kind string, from_id string, to_id string, column string, mechanism string, valid boolean")
    assert relations.pair_catalog(e).count() == 0
    assert spatial.grid_holes(spark.createDataFrame([], "x int, y int"), "x", "y").count() == 0
    assert quality.multiset_diff(e, e).count() == 0


def test_manifest_gathers_no_locale(spark):
    rows = [(None if i % 5 == 0 else "en" if i % 3 else "fr", "doc", str(i * 7919 % 20011)) for i in range(20_000)] + [("en", "doc", "7")] * 3
    out = search.manifest(spark.createDataFrame(rows, "locale string, kind string, id string").repartition(5))
    want = {}
    for g, k, i in rows:
        want.setdefault(g, []).append(f"{k}/{i}")

    def digest(ids):
        hashes = [hashlib.md5(i.encode()).hexdigest() for i in ids]
        return hashlib.sha256(",".join(map(str, [len(ids), *[sum(int(h[a : a + 15], 16) for h in hashes) for a in (0, 15)]])).encode()).hexdigest()

    assert {r["locale"]: (r["rows"], r["ids_digest"]) for r in out.collect()} == {g: (len(v), digest(v)) for g, v in want.items()}
    assert "collect_list" not in out._jdf.queryExecution().toString()
