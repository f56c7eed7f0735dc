"""Archives, promotions, placements, parity and evidence over the tables, with SQL that says the same."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafwork.functions import reports
from sheafwork.operators import ordinals, placement, quality, spatial
from sheafwork.plans.registry import query
from sheafwork.session import fresh_folder, staged, table, tasks_of
from sheafwork.sources import archive, extraction, promotion

# -- archives --------------------------------------------------------------------------------------------------------------


def written_archives(spark: SparkSession, d: str, harmed: bool = True) -> tuple[str, DataFrame]:
    """(folder, (uri)) of archives of customers, one for each nation and thousand keys: a member for each, and with harmed of every
    nineteenth the stored bytes are not those of the checksum.  Each is written by the task that has its rows."""
    folder = fresh_folder(spark, "archives")

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        uri = f"{folder}/n{pdf.c_nationkey.iloc[0]}-{pdf.part.iloc[0]}.pak"
        files = {f"c/n{n}/{k}.txt": text.encode() for n, k, text in zip(pdf.c_nationkey, pdf.c_custkey, pdf.text)}
        bad = {f"c/n{n}/{k}.txt" for n, k in zip(pdf.c_nationkey, pdf.c_custkey) if harmed and k % 19 == 0}
        archive.write_pak(uri, files, wide=frozenset(x for x in files if x.endswith("7.txt")), harmed=frozenset(bad))
        return pd.DataFrame({"uri": [uri]})

    rows = table(spark, d, "customer").select("c_nationkey", F.expr("c_custkey DIV 1000").alias("part"), "c_custkey", F.concat_ws(" ", "c_name", "c_mktsegment").alias("text"))
    by = ["c_nationkey", "part"]
    return folder, staged(rows.repartition(tasks_of(rows), *by).groupBy(*by).applyInPandas(write, "uri string"), "archive-names")


@query("""WITH t AS (SELECT *, c_name || ' ' || c_mktsegment AS t FROM customer)
SELECT 'c/n' || c_nationkey || '/' || c_custkey || '.txt' AS path, CAST(CASE WHEN c_custkey % 10 = 7 THEN 2 ELSE 0 END AS INT) AS flags, CAST(length(t) AS BIGINT) AS size,
  CAST(sum(length(t)) OVER (PARTITION BY c_nationkey, c_custkey // 1000 ORDER BY c_custkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - length(t) AS BIGINT) AS pos,
  CAST((length(t) + list_sum(list_transform(range(length(t)), lambda i: (length(t) - i) * ascii(t[i + 1])))) % 65521 * 65536 + (1 + list_sum(list_transform(range(length(t)), lambda i: ascii(t[i + 1])))) % 65521 AS BIGINT) AS adler FROM t""")
def entries_of_archives(spark: SparkSession, d: str) -> DataFrame:
    """The indexes of archives, read in tasks: paths, flags, places, sizes and checksums of all members."""
    return extraction.entries_of(written_archives(spark, d)[1]).where("problem IS NULL").select("path", "flags", "size", "pos", "adler")


@query("""SELECT 'c/n' || c_nationkey || '/' || c_custkey || '.txt' AS path, CASE WHEN c_custkey % 19 = 0 THEN 'refused' WHEN c_custkey % 2 = 0 THEN 'kept' ELSE 'written' END AS action,
  CASE WHEN c_custkey % 19 <> 0 THEN sha256(c_name || ' ' || c_mktsegment) END AS sha256, CASE WHEN c_custkey % 19 <> 0 AND c_custkey % 14 = 0 THEN 'content' END AS later FROM customer""")
def extracted_members(spark: SparkSession, d: str) -> DataFrame:
    """An extraction that got half-way and is run again: what is there and right is kept, members that fail their checksum are
    refused; then some files are harmed, and the check against the manifest finds just those."""
    entries = staged(extraction.entries_of(written_archives(spark, d)[1]), "members")
    folder = fresh_folder(spark, "members")
    key = F.regexp_extract("path", r"(\d+)\.txt$", 1).cast("bigint")
    extraction.extract(entries.where(key % 2 == 0), folder)
    report = extraction.extract(entries, folder)
    manifest = extraction.manifest_of(report)
    _harm(manifest.where(key % 14 == 0).select("path"), folder)
    ledger = staged(extraction.verify(manifest, folder), "harmed").select("path", F.col("problem").alias("later"))
    return report.select("path", "action", "sha256").join(ledger, "path", "left")


def _harm(paths: DataFrame, folder: str) -> None:
    """Replaces files by as many other bytes, in tasks.  A file is made anew, as file systems may flush one that is cut and written again."""

    def work(parts):
        import pyarrow.fs as pafs

        fs, below = pafs.FileSystem.from_uri(archive.full_uri(folder))
        for pdf in parts:
            for path in pdf.path:
                size = fs.get_file_info(f"{below}/{path}").size
                fs.delete_file(f"{below}/{path}")
                with fs.open_output_stream(f"{below}/{path}") as f:
                    f.write(b"?" * size)
            yield pdf

    staged(paths.mapInPandas(work, "path string"), "harmed")


# -- promotion -------------------------------------------------------------------------------------------------------------


@query("""WITH k AS (SELECT c_nationkey % 5 AS kind, count(*) AS n, sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS cents FROM customer GROUP BY 1),
a AS (SELECT 1 AS attempt, 'new' AS action, 1 AS version, kind, 0 AS more FROM k UNION ALL SELECT 2, CASE WHEN kind IN (1, 3) THEN 'changed' ELSE 'unchanged' END, CASE WHEN kind IN (1, 3) THEN 2 ELSE 1 END, kind, CASE WHEN kind IN (1, 3) THEN 1 ELSE 0 END FROM k
  UNION ALL SELECT 3, CASE WHEN kind = 2 THEN 'ghost' WHEN kind IN (1, 3) THEN 'unchanged' ELSE 'unchanged' END, NULL, kind, CASE WHEN kind IN (1, 3) THEN 1 ELSE 0 END FROM k
  UNION ALL SELECT 4, CASE WHEN kind = 4 THEN 'drift' ELSE 'unchanged' END, NULL, kind, CASE WHEN kind IN (1, 3) THEN 1 ELSE 0 END FROM k)
SELECT attempt, CAST(a.kind AS BIGINT) AS kind, action, version, n AS "rows", CAST(cents + n * more AS BIGINT) AS cents FROM a JOIN k ON a.kind = k.kind""")
def promotion_versions(spark: SparkSession, d: str) -> DataFrame:
    """Four promotions: all new; two kinds changed; one kind gone (refused); one kind of another build (refused).  After each, what a
    reader sees of every kind."""
    root, key, columns = fresh_folder(spark, "canonical"), ["kind"], ["id", "cents"]
    cents = F.round(F.col("c_acctbal") * 100).cast("bigint")
    base = table(spark, d, "customer").select((F.col("c_nationkey") % 5).cast("bigint").alias("kind"), F.col("c_custkey").alias("id"), cents.alias("cents"), F.lit("b7").alias("build"))
    base = staged(base, "draft")
    changed = base.withColumn("cents", F.when(F.col("kind").isin(1, 3), F.col("cents") + 1).otherwise(F.col("cents")))
    drafts = [base, changed, changed.where("kind <> 2"), changed.withColumn("build", F.when((F.col("kind") == 4) & (F.col("id") % 2 == 0), "b6").otherwise(F.col("build")))]
    out = []
    for k, draft in enumerate(drafts):
        plan = promotion.promote_version(draft, root, key, columns, "build", "b7")
        seen = promotion.read_version(spark, root, key).groupBy("kind").agg(F.count("*").alias("rows"), F.sum("cents").alias("cents"))
        out.append(staged(seen.join(plan, "kind", "left").select(F.lit(k + 1).alias("attempt"), "kind", "action", "version", "rows", "cents"), "promoted"))
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


# -- placement -------------------------------------------------------------------------------------------------------------

_BOX = (0.0, 0.0, 40.0, 40.0)
_WORLD_SQL = """s AS (SELECT p_partkey AS source, 'r' || (p_partkey % 5) AS region, CASE WHEN p_size > 25 THEN 'town' ELSE 'poi' END AS kind FROM part),
a AS (SELECT p_partkey AS source, CAST(p_size AS DOUBLE) AS x, CAST(p_partkey % 50 AS DOUBLE) AS y FROM part WHERE p_partkey % 9 = 0),
ag AS (SELECT * FROM a WHERE x BETWEEN 0 AND 40 AND y BETWEEN 0 AND 40),
l AS (SELECT l_partkey AS source, 'o' || lpad(CAST(l_orderkey AS VARCHAR), 8, '0') AS ref, CASE WHEN l_linenumber = 3 THEN 'r9' END AS region, CASE WHEN l_linenumber = 4 THEN CAST('NaN' AS DOUBLE) ELSE CAST(l_orderkey % 50 AS DOUBLE) END AS x, CAST(l_suppkey % 45 AS DOUBLE) AS y, l_linenumber = 1 AS exact FROM lineitem WHERE l_partkey % 3 <> 0),
j AS (SELECT *, CASE WHEN isnan(x) THEN 'nowhere' WHEN NOT (x BETWEEN 0 AND 40 AND y BETWEEN 0 AND 40) THEN 'outside' END AS reason FROM l),
g AS (SELECT source, x, y, min(ref) AS ref, bool_or(exact) AS exact, min(region) AS region FROM j WHERE reason IS NULL GROUP BY ALL),
bad AS (SELECT source, min(reason) AS reason FROM (SELECT source, reason FROM j WHERE reason IS NOT NULL UNION ALL SELECT source, 'outside' FROM a WHERE source NOT IN (SELECT source FROM ag)) GROUP BY 1),
pts AS (
  SELECT s.source, 'anchored' AS status, kind, s.region, CAST(NULL AS VARCHAR) AS ref, x, y, TRUE AS exact, 1 AS variant, CAST(NULL AS VARCHAR) AS reason FROM s JOIN ag ON ag.source = s.source
  UNION ALL SELECT s.source, 'placed', kind, coalesce(g.region, s.region), ref, x, y, exact, CAST(row_number() OVER (PARTITION BY s.source ORDER BY x, y) AS INT), NULL FROM s JOIN g ON g.source = s.source WHERE s.source NOT IN (SELECT source FROM ag)
  UNION ALL SELECT s.source, CASE WHEN reason IS NULL THEN 'unreferenced' ELSE 'refused' END, kind, s.region, NULL, NULL, NULL, NULL, 1, reason FROM s LEFT JOIN bad ON bad.source = s.source WHERE s.source NOT IN (SELECT source FROM ag) AND s.source NOT IN (SELECT source FROM g))"""


def _world(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    k = F.col("p_partkey")
    part = table(spark, d, "part")
    scenes = part.select(k.alias("source"), F.concat(F.lit("r"), (k % 5).cast("string")).alias("region"), F.when(F.col("p_size") > 25, "town").otherwise("poi").alias("kind"))
    anchors = part.where(k % 9 == 0).select(k.alias("source"), F.col("p_size").cast("double").alias("x"), (k % 50).cast("double").alias("y"))
    n = F.col("l_linenumber")
    x = F.when(n == 4, F.lit(float("nan"))).otherwise((F.col("l_orderkey") % 50).cast("double"))
    ref = F.concat(F.lit("o"), F.lpad(F.col("l_orderkey").cast("string"), 8, "0"))
    placements = table(spark, d, "lineitem").where("l_partkey % 3 <> 0").select(F.col("l_partkey").alias("source"), ref.alias("ref"), F.when(n == 3, "r9").alias("region"), x.alias("x"), (F.col("l_suppkey") % 45).cast("double").alias("y"), (n == 1).alias("exact"))
    return scenes, anchors, placements


@query(f"WITH {_WORLD_SQL} SELECT * FROM pts")
def placed_points(spark: SparkSession, d: str) -> DataFrame:
    """Where each part stands: by itself, by the lines that refer to it, or in the ledger."""
    return placement.place_points(*_world(spark, d), _BOX)


@query(f"""WITH {_WORLD_SQL} SELECT status, count(DISTINCT source) AS sources, count(*) AS points, CAST(0 AS BIGINT) AS broken FROM pts GROUP BY status
UNION ALL SELECT 'scenes', count(DISTINCT source), count(*), 1 FROM (SELECT source FROM s UNION ALL SELECT -1)""")
def placement_states(spark: SparkSession, d: str) -> DataFrame:
    """How many parts are in each state, that the states part them, and that a planted scene in no state is found."""
    scenes, anchors, placements = _world(spark, d)
    points = staged(placement.place_points(scenes, anchors, placements, _BOX), "points")
    states = points.groupBy("status").agg(F.count_distinct("source").alias("sources"), F.count("*").alias("points"))
    whole = placement.placement_identity(scenes, points).agg(F.count("*").alias("broken"))
    planted = scenes.unionByName(scenes.sparkSession.createDataFrame([(-1, "r0", "poi")], scenes.schema))
    broken = placement.placement_identity(planted, points).agg(F.count("*").alias("broken"))
    total = planted.agg(F.lit("scenes").alias("status"), F.count_distinct("source").alias("sources"), F.count("*").alias("points"))
    return states.join(whole).unionByName(total.join(broken))  # one row each


@query(f"WITH {_WORLD_SQL} SELECT source, ref, x, y, reason FROM j WHERE reason IS NOT NULL")
def placement_ledger(spark: SparkSession, d: str) -> DataFrame:
    """Placements to no place of the world."""
    return placement.refused_placements(_world(spark, d)[2], _BOX)


# -- reports and evidence --------------------------------------------------------------------------------------------------

_MATRIX_SQL = "m AS (SELECT r_name || CASE WHEN r_regionkey = 1 THEN ' | x' ELSE '' END AS region, c_mktsegment AS segment, count(*) AS customers, count(DISTINCT n_nationkey) AS nations FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL)"
_DIGEST_SQL = "(SELECT sha256(concat_ws(',', count(*), CAST(coalesce(sum(CAST(('0x' || left(h, 15)) AS BIGINT)), 0) AS HUGEINT), CAST(coalesce(sum(CAST(('0x' || substr(h, 16, 15)) AS BIGINT)), 0) AS HUGEINT))) FROM (SELECT md5(concat_ws('|', region, segment, customers, nations)) AS h FROM {0}))"


@query(f"""WITH {_MATRIX_SQL}, r AS (SELECT region, segment, CASE WHEN segment = 'BUILDING' AND region = 'ASIA' THEN customers + 1 ELSE customers END AS customers, nations FROM m WHERE NOT (segment = 'MACHINERY' AND region = 'EUROPE')),
c AS (SELECT region, segment, unnest(['customers', 'nations']) AS "column", unnest([customers, nations]) AS v FROM m)
SELECT region, segment, "column", CAST(v AS VARCHAR) AS matrix, CASE WHEN segment = 'BUILDING' THEN CAST(v + 1 AS VARCHAR) END AS rendered, CASE WHEN segment = 'BUILDING' THEN 'differs' ELSE 'missing' END AS class FROM c
WHERE segment = 'BUILDING' AND region = 'ASIA' AND "column" = 'customers' OR segment = 'MACHINERY' AND region = 'EUROPE'
UNION ALL SELECT 'NOWHERE', 'NONE', unnest(['customers', 'nations']), NULL, unnest(['0', '0']), 'extra' UNION ALL SELECT NULL, NULL, 'digest', {_DIGEST_SQL.format('m')}, {_DIGEST_SQL.format('r')}, 'marker'""")
def report_parity(spark: SparkSession, d: str) -> DataFrame:
    """A rendered report against its matrix: a number changed, a row lost, a row too many and a stale marker are found, nothing else."""
    places = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    region = F.concat("r_name", F.when(F.col("r_regionkey") == 1, " | x").otherwise(""))
    matrix = staged(table(spark, d, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey")).groupBy(region.alias("region"), F.col("c_mktsegment").alias("segment")).agg(F.count("*").alias("customers"), F.count_distinct("n_nationkey").alias("nations")), "matrix")
    off = (F.col("segment") == "BUILDING") & (F.col("region") == "ASIA")
    stale = matrix.withColumn("customers", F.col("customers") + off.cast("int")).where("NOT (segment = 'MACHINERY' AND region = 'EUROPE')")
    lines = reports.markdown_lines(stale, ["region", "segment"])
    marker = quality.table_digest(stale, stale.columns).select(F.concat(F.lit("<!-- digest: "), "digest", F.lit(" -->")).alias("line"))
    extra = spark.createDataFrame([(x,) for x in [*reports.markdown_head(matrix.columns), "", "| NOWHERE | NONE | 0 | 0 |"]], "line string")
    return quality.catalog_parity(matrix, extra.union(lines).union(marker), ["region", "segment"])


_EVIDENCE_SQL = """e AS (SELECT 'order' AS from_kind, CASE WHEN o_orderkey % 2 = 0 THEN 'customer' ELSE 'status' END AS to_kind, 'O' || o_orderkey AS from_id,
  CASE WHEN o_orderkey % 2 = 0 THEN CASE WHEN o_orderkey % 12 = 0 THEN 'C0' ELSE 'C' || o_custkey END ELSE o_orderstatus END AS to_id, CASE WHEN o_orderkey % 2 = 0 THEN CASE WHEN o_orderkey % 16 = 2 THEN 'a.none' ELSE 'a.who[0]' END ELSE 'b' END AS path FROM orders),
k AS (SELECT *, row_number() OVER (PARTITION BY from_kind, to_kind ORDER BY md5('3:' || from_id), from_id) AS n, md5('3:' || from_id) AS h FROM e),
d AS (SELECT * FROM k ORDER BY CASE WHEN n > 20 THEN 1 ELSE 0 END, h, from_id LIMIT 100),
p AS (SELECT d.*, CASE WHEN o_orderkey % 5 = 0 THEN 'no_row' WHEN path = 'a.none' THEN 'no_cell' WHEN to_kind = 'customer' AND to_id <> 'C' || o_custkey THEN 'other_value' WHEN to_kind = 'status' AND o_orderstatus = 'P' THEN 'dangling' ELSE 'ok' END AS proof FROM d JOIN orders ON from_id = 'O' || o_orderkey)"""


def _evidence(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(edges, sampled edges with their proofs): edges of orders, some of them false, to customers and to states."""
    k, even = F.col("o_orderkey"), F.col("o_orderkey") % 2 == 0
    orders = table(spark, d, "orders").withColumns({"id": F.concat(F.lit("O"), k.cast("string")), "who": F.concat(F.lit("C"), F.col("o_custkey").cast("string"))})
    to = F.when(even, F.when(k % 12 == 0, "C0").otherwise(F.col("who"))).otherwise(F.col("o_orderstatus"))
    path = F.when(even, F.when(k % 16 == 2, "a.none").otherwise("a.who[0]")).otherwise("b")
    edges = orders.select(F.lit("order").alias("from_kind"), F.when(even, "customer").otherwise("status").alias("to_kind"), F.col("id").alias("from_id"), to.alias("to_id"), path.alias("path"))
    row = F.to_json(F.struct(F.struct(F.array("who").alias("who")).alias("a"), F.col("o_orderstatus").alias("b")))
    rows = orders.where(k % 5 != 0).select(F.lit("order").alias("kind"), "id", row.alias("row"))
    ids = table(spark, d, "customer").select(F.lit("customer").alias("kind"), F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("id")).unionByName(spark.createDataFrame([("status", "O"), ("status", "F")], "kind string, id string"))
    drawn = ordinals.stratified_sample(edges, ["from_kind", "to_kind"], "from_id", 20, 100, seed=3)
    return edges, quality.rederived(drawn, rows, ids)


@query(f"WITH {_EVIDENCE_SQL} SELECT from_id, to_kind, proof FROM p")
def evidence_proofs(spark: SparkSession, d: str) -> DataFrame:
    """A stratified draw of edges (a sampling operator), each proved anew from its raw row."""
    return _evidence(spark, d)[1].select("from_id", "to_kind", "proof")


@query(f"WITH {_EVIDENCE_SQL} SELECT e.from_kind, e.to_kind, count(*) AS edges, (SELECT count(*) FROM p WHERE p.to_kind = e.to_kind) AS drawn, (SELECT count(*) FROM p WHERE p.to_kind = e.to_kind AND proof = 'ok') AS ok FROM e GROUP BY ALL")
def evidence_strata(spark: SparkSession, d: str) -> DataFrame:
    """Every direction's edges, how many were drawn and how many proved."""
    return quality.strata_proofs(*_evidence(spark, d))


@query("""WITH f AS (SELECT event_type AS class, count(*) AS n, min(event_id) AS first, max(event_id) AS last FROM events GROUP BY 1), x AS (SELECT class, n + CASE WHEN class = (SELECT min(class) FROM f) THEN 1 ELSE 0 END AS n, first, last FROM f)
SELECT f.class, 'n' AS measure, CAST(f.n AS VARCHAR) AS found, CAST(x.n AS VARCHAR) AS expected FROM f JOIN x ON x.class = f.class WHERE f.n <> x.n UNION ALL SELECT 'no such', unnest(['n', 'first', 'last']), NULL, unnest(['1', '2', '3'])""")
def off_expectation(spark: SparkSession, d: str) -> DataFrame:
    """Classes against their exact expectation, one of them planted wrong and one that is not there."""
    found = staged(table(spark, d, "events").groupBy(F.col("event_type").alias("class")).agg(F.count("*").alias("n"), F.min("event_id").alias("first"), F.max("event_id").alias("last")), "classes")
    least = found.agg(F.min("class").alias("_least"))
    wrong = found.join(least).withColumn("n", F.col("n") + (F.col("class") == F.col("_least")).cast("int")).drop("_least")  # one row
    return quality.off_expectation(found, wrong.unionByName(spark.createDataFrame([("no such", 1, 2, 3)], "class string, n bigint, first bigint, last bigint")), ["class"])


@query("""SELECT 'catalog' AS stage, 'orders' AS fact, count(*) AS found, count(*) + 1 AS wanted, 'catalog needs orders = ' || (count(*) + 1) || ', found ' || count(*) || ': run harvest first' AS message FROM orders
UNION ALL SELECT 'catalog', 'scenes', NULL, 40, 'catalog needs scenes = 40, found nothing: run decode first'""")
def stage_preconditions(spark: SparkSession, d: str) -> DataFrame:
    """What a stage lacks and which stage owns it: a count planted wrong, a fact that is not there, and two that hold."""
    count = lambda t: table(spark, d, t).agg(F.lit(t).alias("fact"), F.count("*").alias("found"))
    facts = staged(count("orders").unionByName(count("nation")).unionByName(count("region")), "facts")
    wanted = facts.select("fact", (F.col("found") + (F.col("fact") == "orders").cast("int")).alias("wanted"), F.lit("catalog").alias("stage"), F.lit("harvest").alias("owner"))
    return quality.preconditions(facts, wanted.unionByName(spark.createDataFrame([("scenes", 40, "catalog", "decode")], "fact string, wanted bigint, stage string, owner string")))


# -- masks and labels ------------------------------------------------------------------------------------------------------

_CELLS_SQL = "c AS (SELECT CAST(floor(c_acctbal / 500) AS BIGINT) AS col, CAST(c_nationkey AS BIGINT) AS row, count(*) AS n FROM customer GROUP BY ALL)"
_SHIFTS_SQL = "d AS (SELECT unnest(range(-3, 4)) AS v), s AS (SELECT x.v AS dx, y.v AS dy FROM d x, d y)"


def _cells(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").groupBy(spatial.floor_cell(F.col("c_acctbal"), 500).alias("col"), F.col("c_nationkey").cast("bigint").alias("row")).agg(F.count("*").alias("n"))


@query(f"""WITH {_CELLS_SQL}, a AS (SELECT row, col FROM c WHERE n % 3 <> 0), b AS (SELECT row, col FROM c WHERE n % 2 = 0), {_SHIFTS_SQL}, z AS (SELECT (SELECT count(*) FROM a) AS na, (SELECT count(*) FROM b) AS nb),
t AS (SELECT dx, dy, count(*) AS tp FROM s, a JOIN b ON b.row = a.row + dy AND b.col = a.col + dx GROUP BY ALL)
SELECT CAST(s.dx AS INT) AS dx, CAST(s.dy AS INT) AS dy, coalesce(tp, 0) AS tp, na - coalesce(tp, 0) AS fp, nb - coalesce(tp, 0) AS fn, round(coalesce(tp, 0) / nullif(na + nb - coalesce(tp, 0), 0), 6) AS iou FROM s CROSS JOIN z LEFT JOIN t ON t.dx = s.dx AND t.dy = s.dy""")
def iou_under_shifts(spark: SparkSession, d: str) -> DataFrame:
    """Agreement of two masks for every shift up to three cells, in one pass over their runs."""
    cells = _cells(spark, d)
    return spatial.iou_by_shift(cells.where("n % 3 <> 0"), cells.where("n % 2 = 0"), 3).withColumn("iou", F.round("iou", 6))


@query(f"""WITH {_CELLS_SQL}, {_SHIFTS_SQL}, l AS (SELECT row, col, n % 4 AS label FROM c), b AS (SELECT DISTINCT CAST(floor(col / 4.0) AS BIGINT) AS bx, CAST(floor(row / 4.0) AS BIGINT) AS by_ FROM c),
k AS (SELECT bx, by_, dx, dy, label, count(*) AS n FROM l, s, b WHERE col + dx >= 4 * bx AND col + dx < 4 * bx + 4 AND row + dy >= 4 * by_ AND row + dy < 4 * by_ + 4 GROUP BY ALL),
m AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY bx, by_, dx, dy ORDER BY n DESC, label) = 1)
SELECT CAST(dx AS INT) AS dx, CAST(dy AS INT) AS dy, count(*) AS blocks, count(*) FILTER (label = (((bx + by_) % 4) + 4) % 4) AS "right", round(count(*) FILTER (label = (((bx + by_) % 4) + 4) % 4) / count(*), 6) AS score FROM m GROUP BY ALL""")
def majority_under_shifts(spark: SparkSession, d: str) -> DataFrame:
    """How many 4 x 4 blocks have the label that they should, for every shift up to three cells."""
    cells = _cells(spark, d)
    at = cells.select(F.floor(F.col("col") / 4).alias("bx"), F.floor(F.col("row") / 4).alias("by")).distinct()
    blocks = at.select(F.concat_ws(",", "bx", "by").alias("block"), (F.col("by") * 4).alias("row0"), (F.col("bx") * 4).alias("col0"), F.lit(4).alias("size"), F.pmod(F.col("bx") + F.col("by"), F.lit(4)).alias("label"))
    return spatial.majority_by_shift(cells.select("row", "col", (F.col("n") % 4).alias("label")), blocks, 3).withColumn("score", F.round("score", 6))


@query(f"""WITH {_CELLS_SQL} SELECT s_suppkey AS point, CAST(s_suppkey % 4 AS BIGINT) AS declared, CAST(c.n % 4 AS BIGINT) AS sampled, CASE WHEN c.n IS NULL THEN 'outside' WHEN c.n % 4 = s_suppkey % 4 THEN 'same' ELSE 'other' END AS verdict
FROM supplier LEFT JOIN c ON c.row = s_nationkey AND c.col = CAST(floor(s_acctbal / 500) AS BIGINT)""")
def label_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Declared labels against those that a raster has there."""
    raster = _cells(spark, d).select("row", "col", (F.col("n") % 4).alias("value"))
    points = table(spark, d, "supplier").select(F.col("s_suppkey").alias("point"), F.col("s_nationkey").cast("bigint").alias("row"), spatial.floor_cell(F.col("s_acctbal"), 500).alias("col"), (F.col("s_suppkey") % 4).cast("bigint").alias("declared"))
    return spatial.label_check(points, raster)


_BOX_SQL = "SELECT {0} AS k, min({1}) AS x0, max({1}) AS x1, min({2}) AS y0, max({2}) AS y1 FROM {3} GROUP BY 1"


@query(f"""WITH a AS ({_BOX_SQL.format('s_nationkey', 's_acctbal', 's_suppkey % 97', 'supplier')}), b AS ({_BOX_SQL.format('c_nationkey', 'c_acctbal', 'c_custkey % 89', 'customer')}),
o AS (SELECT a.k, least(a.x1, b.x1) - greatest(a.x0, b.x0) AS x, CAST(least(a.y1, b.y1) - greatest(a.y0, b.y0) AS DOUBLE) AS y, nullif(least((a.x1 - a.x0) * (a.y1 - a.y0), (b.x1 - b.x0) * (b.y1 - b.y0)), 0) AS v FROM a JOIN b ON a.k = b.k)
SELECT CAST(k AS BIGINT) AS k, round(x, 6) AS x, y, x < 0 OR y < 0 AS apart, round(CASE WHEN x < 0 OR y < 0 THEN 0.0 ELSE x * y / v END, 6) AS share FROM o""")
def boxes_overlap(spark: SparkSession, d: str) -> DataFrame:
    """How far the boxes of suppliers and customers of a nation overlap."""
    box = lambda t, k, x, y: table(spark, d, t).groupBy(F.col(k).cast("bigint").alias("k")).agg(*[f(c).alias(f"{a}{i}") for a, c in (("x", x), ("y", y)) for i, f in ((0, F.min), (1, F.max))])
    out = spatial.boxes_overlap(box("supplier", "s_nationkey", F.col("s_acctbal").cast("double"), (F.col("s_suppkey") % 97).cast("double")), box("customer", "c_nationkey", F.col("c_acctbal").cast("double"), (F.col("c_custkey") % 89).cast("double")), ["k"], ["x", "y"])
    return out.select("k", F.round("x", 6).alias("x"), "y", "apart", F.round("share", 6).alias("share"))
