"""What the third round's findings mended: work that grew faster than its input, and a job made smaller."""

from __future__ import annotations

import hashlib
import random
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafwork.functions import text as T
from sheafwork.operators import flow, graph, relations, search, types
from sheafwork.plans.payloads import texture_head
from sheafwork.sources import archive, binary, extraction, markup, textures


class Caught:
    """Stands for a DataFrame and keeps the function that would run in its tasks."""

    dtypes = [("k", "bigint")]

    def select(self, *_):
        return self

    def mapInArrow(self, work, _schema):  # noqa: N802
        return work


def test_leaves_are_handed_on_in_large_batches(monkeypatch, spark):
    texts = [f'<c><sheet name="s"><I{i}><a>x{i}</a><b/></I{i}></sheet></c>' for i in range(1000)]
    rows = pa.RecordBatch.from_pydict({"locale": ["en"] * 1000, "value": texts})
    work = markup.read_export(Caught())
    assert [b.num_rows for b in work(iter([rows.slice(0, 400), rows.slice(400)]))] == [2000]  # one a text before
    monkeypatch.setattr(markup, "MOST_ROWS", 300)
    out = list(work(iter([rows])))
    assert max(b.num_rows for b in out) == 300 and pa.Table.from_batches(out).column("value").to_pylist()[:3] == ["x0", "", "x1"]


def test_texts_are_handed_on_in_large_batches(spark):
    rows = pa.RecordBatch.from_pydict({"locale": ["en"] * 500, "value": [f'<g id="m"><t id="k{i}">x{i}</t><t id="q{i}"/></g>' for i in range(500)]})
    (out,) = markup.read_texts(Caught())(iter([rows]))
    assert out.num_rows == 1000 and out.to_pylist()[999] == {"locale": "en", "key": "m/q499", "value": ""}


def test_float_grids_are_handed_on_together(monkeypatch):
    grids = [np.arange(n * n, dtype="<f4") + n for n in (2, 1, 3) * 100]
    rows = pa.RecordBatch.from_arrays([pa.array(range(300), pa.int64()), pa.array([g.tobytes() for g in grids], pa.binary())], names=["k", "content"])
    work = binary.float_grid(Caught(), "content", ["k"])
    want = [{"k": k, "row": i // n, "col": i % n, "value": float(v)} for k, g in enumerate(grids) for n in [int(len(g) ** 0.5)] for i, v in enumerate(g)]
    (out,) = work(iter([rows]))  # one a grid before
    assert out.to_pylist() == want
    monkeypatch.setattr(binary, "MOST_PIXELS", 8)
    out = list(work(iter([rows])))
    assert max(b.num_rows for b in out) == 9 and pa.Table.from_batches(out).to_pylist() == want


def test_ordered_manifest_hashes_the_sorted_ids(spark, monkeypatch):
    monkeypatch.setattr(search, "PIECE", 100)
    rows = [(None if i % 5 == 0 else "en" if i % 3 else "fr", "doc", None if i % 97 == 0 else str(i * 7919 % 20011)) for i in range(5000)] + [("en", "doc", "7")] * 3 + [("xx", "doc", None)]
    out = search.ordered_manifest(spark.createDataFrame(rows, "locale string, kind string, id string").repartition(5))
    want = {}
    for locale, k, i in rows:
        want.setdefault(locale, []).append(i and f"{k}/{i}")
    digest = lambda ids: hashlib.sha256("\n".join(ids).encode()).hexdigest() if ids else None
    assert {r["locale"]: (r["rows"], r["ids_sha256"]) for r in out.collect()} == {g: (len(v), digest(sorted(filter(None, v)))) for g, v in want.items()}


def test_textures_are_handed_on_together(monkeypatch, spark):
    files = [texture_head(4, 4, b"DXT1") + bytes([i % 256] * (8 if i % 11 else 7)) for i in range(400)]
    rows = pa.RecordBatch.from_arrays([pa.array([str(i) for i in range(400)]), pa.array(files, pa.binary())], names=["path", "content"])
    work = textures.decoded(Caught())
    (out,) = work(iter([rows]))  # one an image before
    for i, got in enumerate(out.to_pylist()):
        if i % 11:
            assert got == {"path": str(i), "width": 4, "height": 4, "rgba": textures.decode_texture(files[i]).tobytes(), "problem": None}
        else:
            assert got == {"path": str(i), "width": None, "height": None, "rgba": None, "problem": "shorter than its texels"}
    monkeypatch.setattr(textures, "MOST_BYTES", 64 * 10)
    parts = list(work(iter([rows])))
    assert max(sum(len(x or b"") for x in b.column("rgba").to_pylist()) for b in parts) == 640 and pa.Table.from_batches(parts).to_pylist() == out.to_pylist()


def planned(df) -> str:
    """The plan before anything has run: a join that waits for measured sizes is a sort merge join there."""
    return df._jdf.queryExecution().executedPlan().toString()


def test_read_positions_are_broadcast(spark):
    ops = spark.createDataFrame([("A", [1, 2, 3])] * 50 + [("N", [4, 5, 6]), ("X", [7])], "op string, args array<bigint>")
    out = relations.operands_read(ops, ["op"], "op", "args", spark.createDataFrame([("A", [0, 2]), ("N", [1, 9])], "op string, places array<int>"))
    assert "BroadcastHashJoin" in planned(out) and "SortMergeJoin" not in planned(out)
    assert sorted(map(tuple, out.collect())) == [("A", 0, 1)] * 50 + [("A", 2, 3)] * 50 + [("N", 1, 5)]


def test_carriers_are_broadcast(spark):
    cells = spark.createDataFrame([("event", str(i), f"k[{j}]", "k", str(j)) for i in range(40) for j in range(3)] + [("event", "9", "z", "z", "1")], "kind string, id string, path string, norm_path string, value string")
    carriers = spark.createDataFrame([("event", "k", "part", "path:k")], "kind string, norm_path string, target string, method string")
    edges, rest = relations.carrier_edges(cells, carriers, spark.createDataFrame([("part", "0"), ("part", "2")], "kind string, id string"))
    assert "BroadcastHashJoin" in planned(edges)  # two sort merge joins before, the first of them by one key
    assert edges.count() == 80 and rest.count() == 40


def test_tokens_are_added_up_before_they_are_resolved(spark):
    texts = spark.createDataFrame([(i, "Part.1 Part.2 Nation.7 Nope.3 x") for i in range(30)], "id int, script string")
    prefixes = spark.createDataFrame([("Part", "part"), ("Nation", "nation")], "prefix string, kind string")
    out = relations.token_reference_counts(texts, "id", "script", r"[A-Z][a-z]+\.\d+", prefixes, spark.createDataFrame([("part", "1")], "kind string, id string"))
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, [("part", True, 30), ("part", False, 30), ("nation", None, 30)]))
    assert "BroadcastHashJoin" in planned(relations.token_targets(texts, "id", "script", r"[A-Z][a-z]+\.\d+", prefixes))


def test_a_signature_is_read_once(spark):
    df = spark.createDataFrame([("(a,(b,é)->c)->r",), ("()->void",), ("none",), ("",), (None,), ("(a)->(b,c)->d",)], "s string").select(T.signature_parts(F.col("s")).alias("x"))
    got = [r[0] and (list(r[0]["arguments"]), r[0]["result"]) for r in df.collect()]
    assert got == [(["a", "(b,é)->c"], "r"), ([], "void"), None, None, None, (["a"], "(b,c)->d")]
    assert df._jdf.queryExecution().analyzed().toString().count("aggregate(") == 1


def test_small_archives_share_tasks(tmp_path, monkeypatch):
    files = {f"a/{i}.txt": bytes([i]) * (i * 7) for i in range(40)}
    for i in range(30):
        archive.write_pak(str(tmp_path / f"{i}.pak"), {f"{i}/{k}": v for k, v in files.items()})
    members = sorted((f"{i}/{k}", v) for i in range(30) for k, v in files.items())
    for split, most, tasks in ((100, 10, 10), (1 << 20, 10, 1), (2000, 512, None)):
        monkeypatch.setattr(archive, "MOST_TASKS", most)
        reader = archive.PakReader({"path": str(tmp_path), "payload": "true", "split": str(split)})
        parts = reader.partitions()
        assert tasks is None or len(parts) <= 2 * tasks  # thirty or more before, with all members' entries
        assert sorted((r[0], r[5]) for p in parts for r in reader.read(p)) == members


def joins_without_shuffle_hint(monkeypatch, module, name) -> list[str]:
    """The joins of all rounds that module's ``name`` writes that Spark might broadcast."""
    found, write = [], getattr(module, name)

    def watched(df, *args):
        found.extend(x for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join " in x and "strategy=merge" not in x)
        return write(df, *args)

    monkeypatch.setattr(module, name, watched)
    return found


def test_rounds_of_frames_are_not_broadcast(spark, monkeypatch):
    loose = joins_without_shuffle_hint(monkeypatch, graph, "cut_lineage")
    roots = spark.createDataFrame([(1, 0.0, 0.0, 0.0)], "node bigint, x double, y double, angle double")
    edges = spark.createDataFrame([(1, 2, 1.0, 0.0, 90.0, 1.0), (2, 3, 1.0, 0.0, 0.0, 1.0), (3, 4, 1.0, 0.0, 0.0, 2.0)], "a bigint, b bigint, x double, y double, angle double, scale double")
    assert sorted((r["node"], round(r["x"], 6), round(r["y"], 6)) for r in graph.propagate_frames(roots, edges).collect()) == [(1, 0, 0), (2, 1, 0), (3, 1, 1)]
    assert loose == []


def test_rounds_of_types_are_not_broadcast(spark, monkeypatch):
    loose = joins_without_shuffle_hint(monkeypatch, types, "staged")
    rows = [(1, "base", "i32", None), (2, "null", None, [1]), (3, "fun", None, [2, 3, 9]), (4, "fun", None, [2, 1])]
    out = types.type_display(spark.createDataFrame(rows, "id bigint, kind string, name string, parts array<bigint>"))
    assert {r["id"]: r["display"] for r in out.collect()} == {1: "i32", 2: "?i32", 3: "(?i32,#3)->?9", 4: "(?i32)->i32"}
    assert loose == []


def test_first_values_are_not_added_up_by_group(spark):
    rows = [(g, n, None if n == 2 else f"v{n}") for g in (None, "a", "b") for n in (3, 1, 2, 5, 4)] + [("c", 1, "x"), ("d", None, None)]
    out = relations.first_k(spark.createDataFrame(rows, "g string, n int, v string"), ["g"], [F.col("n")], 3, "v")
    assert "Aggregate" not in planned(out) and planned(out).count(" Sort [") == 2  # each aggregate sorted all rows once more
    assert {r["g"]: r["evidence"] for r in out.collect()} == {None: "v1,v3", "a": "v1,v3", "b": "v1,v3", "c": "x", "d": ""}


def test_references_are_added_up_before_they_are_spread_out(spark):
    from tests.conftest import DATA

    from sheafwork.plans import relations as plans

    plan = plans.catalog_of(spark, str(DATA))._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in plan.splitlines() if "Generate explode" in x and "to_id" in x]  # a row a reference before
    assert not [x for x in plan.splitlines() if "Aggregate" in x and "to_id" in x and "collect_set" in x]  # sets of each target before


def test_counted_catalog_is_that_of_the_edges(spark):
    rows = [(1, 2, 5, 5, "u"), (1, 2, 6, None, "v"), (1, None, 5, 7, "1"), (None, 1, 6, 5, "1/1"), (1, None, None, None, "z"), (None, None, 9, 5, None), (12, 3, 5, 9, "u"), (1, 23, 5, 9, "v")]
    df = spark.createDataFrame(rows, "a int, b bigint, x int, y bigint, s string")
    ids = spark.createDataFrame([("k", "5"), ("k", "5"), ("k", "9"), ("m", "u"), ("m", None)], "kind string, id string")
    columns = [("k", "x"), ("k", "y"), ("m", "s"), ("none", "x")]
    for by in (["a", "b"], ["b"], ["a", "s"], ["s"]):
        refs = relations.all_references(df, "f", F.concat_ws("/", *by), columns)
        want = sorted(map(tuple, relations.pair_catalog(relations.resolve(refs, ids)).collect()))
        got = relations.counted_catalog(relations.target_counts(df, "f", columns), relations.source_counts(df, "f", by, columns), ids)
        names = relations.pair_catalog(relations.resolve(refs, ids)).columns
        assert len(want) == 3 and sorted(map(tuple, got.select(*names).collect())) == want == sorted(map(tuple, relations.reference_catalog(refs, ids).select(*names).collect()))
    none = df.where("false")
    assert relations.counted_catalog(relations.target_counts(none, "f", columns), relations.source_counts(none, "f", ["a", "b"], columns), ids).collect() == []


def test_the_ladder_has_no_row_a_reference(spark):
    from tests.conftest import DATA

    from sheafwork.plans import relations as plans

    plan = plans.direction_ladder(spark, str(DATA))._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" in plan and not [x for x in plan.splitlines() if "Generate explode" in x and "to_id" in x]


def test_small_functions_need_no_rounds(spark, monkeypatch):
    draw = random.Random(3)
    ops = [(f, pc, [draw.randrange(0, 8) for _ in range(draw.choice([0, 0, 1, 2]))], draw.random() < 0.7) for f in range(60) for pc in range(draw.randrange(1, 7))]
    df = spark.createDataFrame(ops, "function int, pc int, targets array<int>, falls boolean")
    split = sorted(map(tuple, flow.flow_metrics(df, most=2).collect()))
    monkeypatch.setattr(flow, "dominators", None)  # each function went through it before
    assert split == sorted(map(tuple, flow.flow_metrics(df).collect())) and len(split) == 60
    chain = spark.createDataFrame([(100, pc, [pc + 1] if pc < 61 else [0, 30], False) for pc in range(62)], df.schema)  # and back
    assert list(map(tuple, flow.flow_metrics(chain).collect())) == [(100, 62, 62, 63, 62, 2, 61, 3)]


def test_only_ids_that_tokens_name_are_resolved(spark, monkeypatch):
    met, resolve = [], relations.resolve
    monkeypatch.setattr(relations, "resolve", lambda refs, ids, *kinds: met.append(ids) or resolve(refs, ids, *kinds))
    texts = spark.createDataFrame([(i, "Part.1 Part.2 Nation.7 Nope.3 Other.1 x") for i in range(30)], "id int, script string")
    prefixes = spark.createDataFrame([("Part", "part"), ("Nation", "nation"), ("Other", "other")], "prefix string, kind string")
    ids = spark.createDataFrame([("part", str(i % 500 + 1)) for i in range(1000)] + [("nation", "9"), ("nation", None), ("other", None)], "kind string, id string")
    out = relations.token_reference_counts(texts, "id", "script", r"[A-Z][a-z]+\.\d+", prefixes, ids)
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, [("part", True, 60), ("nation", False, 30), ("other", None, 30)]))
    assert met[0].count() == 4  # parts 1 and 2 twice; 1003 before


def test_members_are_dealt_over_tasks_whatever_their_bytes(spark):
    from tests.conftest import DATA

    from sheafwork.plans import audits
    from sheafwork.session import fresh_folder

    archives = audits.written_archives(spark, str(DATA))[1]
    assert len(archives.inputFiles()) > 4  # each was one file of one task before, as adaptive execution put few bytes together
    report = extraction.extract(extraction.entries_of(archives), fresh_folder(spark, "members"))
    assert len(report.where("action = 'written'").select(F.input_file_name()).distinct().collect()) > 4
    assert extraction.manifest_of(report).count() > 100


def test_references_meet_ids_in_one_aggregate(spark):
    from tests.conftest import DATA

    from sheafwork.plans import relations as plans

    for df in (plans.direction_ladder(spark, str(DATA)), plans.fk_resolve_valid(spark, str(DATA))):
        plan = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
        assert not [x for x in plan if "Join" in x and "_id" in x]  # all targets, as texts, met all ids in a join before
        reads = [x for x in plan if "Relation [" in x and "l_orderkey" in x]
        assert len(reads) <= 5  # three columns and the ids, those with a null apart; columns were read twice, 8 times in all, before
    number = "bit_or(CASE WHEN isnotnull(l_orderkey"
    assert number in plans.sources_of(plans.tables_of(spark, str(DATA)))._jdf.queryExecution().optimizedPlan().toString()  # a row an id before


def test_verdicts_by_kind_are_those_of_the_edges(spark):
    low, high = -(2**63), 2**63 - 1
    rows = [(1, 5, 5, "u", 5), (1, 6, None, "v", 9), (2, 5, 7, "5", None), (None, 6, 5, "", 5), (None, None, None, "z", 7), (-1, -5, low, None, 0), (-1, -5, high, "u", -1)] * 2
    a = spark.createDataFrame(rows, "a int, x int, y bigint, s string, z smallint")
    b = spark.createDataFrame([("p", 5.0, 5), ("q", None, 9), (None, 7.5, None)], "b string, f double, x tinyint")
    k = spark.createDataFrame([(5,), (5,), (low,), (-5,), (None,), (100,)], "id bigint")
    m = spark.createDataFrame([("u",), ("5",), ("5",), ("",), ("5.0",)], "id string")
    empty = spark.createDataFrame([(None,)], "id int")
    known = {"k": (k, "id"), "m": (m, "id"), "e": (empty, "id")}
    declared = [("a", ["a"], "k", "x"), ("a", ["a"], "k", "y"), ("b", ["b"], "k", "x"), ("a", ["a"], "m", "s"), ("a", ["a"], "m", "z"), ("b", ["b"], "m", "f"), ("a", ["a"], "e", "x"), ("b", ["b"], "gone", "f")]
    tables = {"a": a, "b": b}
    refs = [relations.all_references(tables[f], f, F.concat_ws("/", *by), [(to, c)]) for f, by, to, c in declared]
    ids = [df.select(F.lit(kind).alias("kind"), F.col(c).cast("string").alias("id")) for kind, (df, c) in known.items()]
    refs, ids = reduce(DataFrame.unionByName, refs), reduce(DataFrame.unionByName, ids)
    want = relations.pair_catalog(relations.resolve(refs, ids))

    def of(declared, tables):
        verdicts = [relations.target_verdicts(to, [(f, tables[f], c) for f, _, t, c in declared if t == to], known.get(to)) for to in ("k", "m", "e", "gone")]
        sources = [relations.source_counts(tables[f], f, [f], [(to, c) for x, _, to, c in declared if x == f]) for f in tables]
        return reduce(DataFrame.unionByName, verdicts), reduce(DataFrame.unionByName, sources)

    verdicts, sources = of(declared, tables)
    got = relations.verdict_catalog(verdicts, sources)
    assert got.count() == 6 and sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    by_column = relations.resolve(refs, ids).groupBy("from_kind", "to_kind", "column").agg(F.count("*").alias("n"), *[F.count_if(c).alias(f"n{i}") for i, c in enumerate([F.col("valid"), ~F.col("valid"), F.col("valid").isNull()])])
    assert sorted(map(tuple, verdicts.drop("ends").collect())) == sorted(map(tuple, by_column.collect()))
    none = {f: df.where("false") for f, df in tables.items()}
    assert relations.verdict_catalog(*of(declared, none)).collect() == []


def test_ids_are_counted_by_bits(spark):
    draw = random.Random(5)
    ends = [-(2**63), 2**63 - 1, -1, 0, 63, 64, -64, -65, 2**31]
    one = lambda: draw.choice(ends) if draw.random() < 0.3 else draw.randrange(-20, 200)
    names = [f"c{i}" for i in range(7)]
    for width in range(1, 8):
        rows = [(*[one() if draw.random() < 0.97 else None for _ in range(width)], draw.choice([None, 1]), draw.choice([None, 2])) for _ in range(300)]
        rows += rows[:150]
        df = spark.createDataFrame(rows, ", ".join(f"{c} bigint" for c in [*names[:width], "x", "y"]))
        got = relations.source_counts(df, "f", names[:width], [("k", "x"), ("m", "y"), ("k", "y")])
        text = F.concat_ws("/", *names[:width])
        want = df.agg(F.count_distinct(F.when(F.col("x").isNotNull() | F.col("y").isNotNull(), text)), F.count_distinct(F.when(F.col("y").isNotNull(), text))).first()
        assert {r["to_kind"]: r["from_ids"] for r in got.collect()} == {"k": want[0], "m": want[1]}
