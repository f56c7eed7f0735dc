"""Evidence families on directions, owners of folders, tile geography, proofs and summaries over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafwork.functions import decode
from sheafwork.functions import text as T
from sheafwork.operators import aggregates, quality, relations, spatial
from sheafwork.plans.registry import query
from sheafwork.session import fresh_folder, table
from sheafwork.sources import records, writers

_WORLD_SQL = """k AS (SELECT 'r' || r_regionkey AS kind FROM region),
cat AS (SELECT 'r' || (c_nationkey % 5) AS f, 'r' || (c_custkey % 2) AS t, count(*) AS edges FROM customer GROUP BY ALL),
dirs AS (SELECT a.kind AS from_kind, b.kind AS to_kind, CASE WHEN edges IS NULL THEN 'missing' WHEN a.kind = 'r3' THEN 'partial' ELSE 'modeled' END AS status, coalesce(edges, 0) AS edges
  FROM k a JOIN k b ON a.kind <> b.kind LEFT JOIN cat ON f = a.kind AND t = b.kind),
fam AS (SELECT c_mktsegment AS family, 'r' || (c_nationkey % 5) AS from_kind, 'r' || (c_custkey % 7) AS to_kind, count(*) AS edges, CASE WHEN c_mktsegment < 'C' THEN 'path' ELSE 'path+token' END AS mechanisms
  FROM customer WHERE c_nationkey % 5 <> 4 GROUP BY ALL),
led AS (SELECT 'r' || (s_nationkey % 5) AS from_kind, 'r' || (s_suppkey % 6) AS to_kind, min('nation ' || s_nationkey) AS reason FROM supplier WHERE s_nationkey % 5 <> s_suppkey % 6 GROUP BY ALL),
cl AS (SELECT f.*, CASE WHEN f.from_kind = f.to_kind AND f.from_kind IN ('r0', 'r1') THEN 'fold-self' WHEN f.from_kind = f.to_kind THEN 'self-chain' WHEN d.status IS NULL THEN 'stray' WHEN d.status = 'missing' THEN 'derived' ELSE 'fold' END AS class
  FROM fam f LEFT JOIN dirs d ON d.from_kind = f.from_kind AND d.to_kind = f.to_kind)"""


def _r(key: Column, name: str) -> Column:
    return F.concat(F.lit("r"), key.cast("string")).alias(name)


def _world(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Directions between regions, families classed, and a ledger, from customers and suppliers."""
    c, pair = table(spark, d, "customer"), ["from_kind", "to_kind"]
    kinds = table(spark, d, "region").select(_r(F.col("r_regionkey"), "kind"))
    edges = c.groupBy(_r(F.col("c_nationkey") % 5, "from_kind"), _r(F.col("c_custkey") % 2, "to_kind")).agg(F.count("*").alias("edges"))
    every = relations.all_directions(kinds)
    at = lambda x, y: F.when(F.col("side") == "ab", F.col(x)).otherwise(F.col(y))
    status = F.when(F.col("edges").isNull(), "missing").when(F.col("from_kind") == "r3", "partial").otherwise("modeled")
    dirs = every.select(at("a", "b").alias("from_kind"), at("b", "a").alias("to_kind")).join(edges, pair, "left")
    dirs = dirs.select(*pair, status.alias("status"), F.coalesce("edges", F.lit(0)).alias("edges"), F.lit(None).cast("string").alias("unblock"))
    mech = F.when(F.col("c_mktsegment") < "C", "path").otherwise("path+token")
    fam = c.where("c_nationkey % 5 <> 4").groupBy(F.col("c_mktsegment").alias("family"), _r(F.col("c_nationkey") % 5, "from_kind"), _r(F.col("c_custkey") % 7, "to_kind"), mech.alias("mechanisms")).agg(F.count("*").alias("edges"))
    led = table(spark, d, "supplier").where("s_nationkey % 5 <> s_suppkey % 6").select(_r(F.col("s_nationkey") % 5, "from_kind"), _r(F.col("s_suppkey") % 6, "to_kind"), F.concat(F.lit("nation "), F.col("s_nationkey").cast("string")).alias("reason"))
    return dirs, relations.family_classes(fam, dirs, kinds.where("kind IN ('r0', 'r1')")), led


@query(f"WITH {_WORLD_SQL} SELECT family, from_kind, to_kind, edges, mechanisms, class FROM cl")
def evidence_families(spark: SparkSession, d: str) -> DataFrame:
    """Families of evidence by what they are to the catalog."""
    return _world(spark, d)[1]


@query(f"""WITH {_WORLD_SQL},
m AS (SELECT from_kind, to_kind, string_agg(DISTINCT m, '+' ORDER BY m) AS mech FROM (SELECT from_kind, to_kind, unnest(string_split(mechanisms, '+')) AS m FROM cl WHERE class = 'derived') GROUP BY ALL),
e AS (SELECT from_kind, to_kind, string_agg(family, ',' ORDER BY family) AS evidence, CAST(sum(edges) AS BIGINT) AS evidence_edges FROM cl WHERE class = 'derived' GROUP BY ALL),
o AS (SELECT from_kind, to_kind, string_agg(family, ',' ORDER BY family) AS folds FROM cl WHERE class = 'fold' GROUP BY ALL),
s AS (SELECT *, CASE WHEN status <> 'missing' THEN 'modeled' WHEN evidence IS NOT NULL THEN 'derived' WHEN reason IS NOT NULL THEN 'ledgered' ELSE 'open' END AS standing
  FROM dirs LEFT JOIN e USING (from_kind, to_kind) LEFT JOIN o USING (from_kind, to_kind) LEFT JOIN m USING (from_kind, to_kind) LEFT JOIN led USING (from_kind, to_kind))
SELECT from_kind, to_kind, status, edges, evidence, coalesce(evidence_edges, 0) AS evidence_edges, folds, reason, standing,
  CASE standing WHEN 'derived' THEN 'wired: ' || evidence || ' · E=' || evidence_edges || ' · mech=' || mech WHEN 'ledgered' THEN 'ledgered: ' || reason END AS unblock FROM s""")
def wired_directions(spark: SparkSession, d: str) -> DataFrame:
    """Directions with the families and the ledger's reasons wired in."""
    return relations.wire_evidence(*_world(spark, d)).withColumn("evidence_edges", F.coalesce("evidence_edges", F.lit(0)))


@query(f"""WITH {_WORLD_SQL} SELECT DISTINCT from_kind, to_kind, 'family_outside' AS rule FROM cl WHERE class = 'stray'
UNION ALL SELECT l.from_kind, l.to_kind, 'ledger_outside' FROM led l LEFT JOIN dirs d USING (from_kind, to_kind) WHERE d.status IS NULL
UNION ALL SELECT l.from_kind, l.to_kind, 'ledger_modeled' FROM led l JOIN dirs d USING (from_kind, to_kind) WHERE d.status <> 'missing'
UNION ALL SELECT l.from_kind, l.to_kind, 'ledger_family' FROM led l WHERE (l.from_kind, l.to_kind) IN (SELECT (from_kind, to_kind) FROM cl)""")
def evidence_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Where modeled, derived and ledgered directions overlap or leave the catalog."""
    return relations.evidence_conflicts(*_world(spark, d))


@query(r"""WITH f AS (SELECT DISTINCT 'n' || c_nationkey AS up, 's' || (c_custkey % 40) || CASE WHEN c_custkey % 3 = 0 THEN '.1' ELSE '' END AS stem FROM customer),
s AS (SELECT DISTINCT 'n' || (p_partkey % 25) AS up, 's' || (p_partkey % 17) || CASE WHEN p_partkey % 4 = 0 THEN '_01' ELSE '' END AS stem FROM part UNION SELECT DISTINCT 'n' || (p_partkey % 25), '' FROM part WHERE p_partkey % 5 = 0),
c AS (SELECT f.up, f.stem, s.stem AS hit, CASE WHEN s.stem = f.stem THEN 1 WHEN contains(f.stem, '.') AND s.stem = string_split(f.stem, '.')[1] THEN 2 WHEN starts_with(s.stem, f.stem) THEN 3 END AS rank FROM f JOIN s ON f.up = s.up),
b AS (SELECT * FROM c WHERE rank IS NOT NULL QUALIFY row_number() OVER (PARTITION BY up, stem ORDER BY rank, length(hit), hit) = 1)
SELECT f.up || '/' || f.stem || '.dat' AS folder, f.up || '/' || hit || '.prefab' AS owner, CASE coalesce(rank, 4) WHEN 1 THEN 'same-stem' WHEN 2 THEN 'strip-dot-variant' WHEN 3 THEN 'prefix-match' ELSE 'unowned' END AS evidence
FROM f LEFT JOIN b ON b.up = f.up AND b.stem = f.stem""")
def scene_owners(spark: SparkSession, d: str) -> DataFrame:
    """Which scene a data folder belongs to, by ranked rules on names."""
    folder = F.format_string("n%d/s%d%s.dat", "c_nationkey", F.col("c_custkey") % 40, F.when(F.col("c_custkey") % 3 == 0, ".1").otherwise(""))
    scene = F.format_string("n%d/s%d%s.prefab", F.col("p_partkey") % 25, F.col("p_partkey") % 17, F.when(F.col("p_partkey") % 4 == 0, "_01").otherwise(""))
    nameless = F.format_string("n%d/.prefab", F.col("p_partkey") % 25)  # belongs to no folder whose stem has no dot
    scenes = table(spark, d, "part").select(F.explode(F.array_compact(F.array(scene, F.when(F.col("p_partkey") % 5 == 0, nameless)))).alias("scene"))
    return relations.scene_owners(table(spark, d, "customer").select(folder.alias("folder")), scenes, "folder", "scene")


@query("""WITH o AS (SELECT l_returnflag AS op, [l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT)] AS args FROM lineitem), r AS (SELECT 'A' AS op, unnest([0, 2]) AS place UNION ALL SELECT 'N', 1 UNION ALL SELECT 'R', unnest([0, 5]))
SELECT o.op, CAST(place AS INT) AS place, count(*) AS n, CAST(sum(args[place + 1]) AS BIGINT) AS total FROM o JOIN r ON o.op = r.op WHERE args[place + 1] IS NOT NULL GROUP BY ALL""")
def operand_reads(spark: SparkSession, d: str) -> DataFrame:
    """What operations read by a table of their read positions, one of them out of range."""
    ops = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("op"), F.array("l_partkey", "l_suppkey", F.col("l_linenumber").cast("bigint")).alias("args"))
    reads = spark.createDataFrame([("A", [0, 2]), ("N", [1]), ("R", [0, 5])], "op string, places array<int>")
    return relations.operands_read(ops, ["op"], "op", "args", reads).groupBy("op", "place").agg(F.count("*").alias("n"), F.sum("register").alias("total"))


@query("""WITH m AS (SELECT doc_id, min('q' || quality) AS surface FROM labels GROUP BY 1) SELECT coalesce(surface, 'deferred') AS surface, count(DISTINCT d.doc_id) AS members FROM documents d LEFT JOIN m ON m.doc_id = d.doc_id WHERE d.doc_id IS NOT NULL GROUP BY 1""")
def surface_census(spark: SparkSession, d: str) -> DataFrame:
    """Every document by its label or as deferred."""
    mapped = table(spark, d, "labels").select("doc_id", F.concat(F.lit("q"), F.col("quality").cast("string")).alias("surface"))
    return relations.surfaces(table(spark, d, "documents"), mapped, "doc_id").groupBy("surface").agg(F.count("doc_id").alias("members"))


@query("""WITH c AS (SELECT CAST(floor(c_acctbal / 500) AS BIGINT) AS x, CAST(c_nationkey AS BIGINT) AS y, min(c_custkey) AS k FROM customer GROUP BY ALL), p AS (SELECT * FROM c WHERE k % 5 <> 0),
g AS (SELECT unnest(range(x0, x1 + 1)) AS x, y0, y1 FROM (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM p)), h AS (SELECT x, unnest(range(y0, y1 + 1)) AS y FROM g)
SELECT x, y, CASE WHEN k % 4 = 0 THEN 'sea' ELSE 'land' END AS ground, k % 11 = 0 AS placeholder FROM p
UNION ALL SELECT h.x, h.y, 'hole', FALSE FROM h LEFT JOIN p ON p.x = h.x AND p.y = h.y WHERE p.k IS NULL""")
def tile_geography(spark: SparkSession, d: str) -> DataFrame:
    """Land, sea, placeholders and holes by the hashes of tiles; a fifth of the cells have no albedo tile."""
    c = table(spark, d, "customer").groupBy(spatial.floor_cell(F.col("c_acctbal"), 500).alias("x"), F.col("c_nationkey").alias("y")).agg(F.min("c_custkey").alias("k"))
    tile = lambda layer, hash_: F.struct(F.format_string(f"/world/{layer}/t_x%d_y%d.dds", "x", "y").alias("path"), hash_.alias("hash"))
    albedo = F.when(F.col("k") % 5 != 0, tile("albedo", F.when(F.col("k") % 11 == 0, "ph").otherwise("a")))
    splat = tile("splat", F.when(F.col("k") % 4 == 0, "sea").otherwise("s"))
    height = tile("height", F.lit("sea"))
    manifest = c.select(F.explode(F.array_compact(F.array(albedo, splat, height))).alias("t")).select("t.*")
    return spatial.tile_geography(manifest, "sea", "ph")


@query("""WITH c AS (SELECT p_partkey, -12 * (1 + p_partkey % 6) AS o, -(p_size % 13) AS m, 64 * (p_partkey % 5 + 1) AS w FROM part),
u AS (SELECT *, CASE WHEN m <> 0 AND o % nullif(m, 0) = 0 THEN o // m END AS unit FROM c), s AS (SELECT *, CASE WHEN unit IS NOT NULL AND w % unit = 0 THEN w // unit END AS span FROM u)
SELECT p_partkey, CAST(coalesce(unit, -1) AS BIGINT) AS unit, CAST(coalesce(span, -1) AS BIGINT) AS span, coalesce(round(CAST(512 AS DOUBLE) / unit, 6), -1) AS scale, CASE WHEN unit IS NULL THEN 'offset' WHEN span IS NULL THEN 'size' WHEN span <> 64 THEN 'span' END AS broken FROM s""")
def carrier_transform(spark: SparkSession, d: str) -> DataFrame:
    """Cell units from two carriers (-1 where none can be told), and which of their relations fails."""
    k = F.col("p_partkey")
    c = table(spark, d, "part").select("p_partkey", (-12 * (1 + k % 6)).alias("o"), (-(F.col("p_size") % 13)).alias("m"), (64 * (k % 5 + 1)).alias("w"))
    return spatial.carrier_transform(c, "o", "m", "w", 512, 64).select("p_partkey", *[F.coalesce(x, F.lit(-1)).alias(x) for x in ("unit", "span")], F.coalesce(F.round("scale", 6), F.lit(-1.0)).alias("scale"), "broken")


@query("""WITH p AS (SELECT vec_id, unnest(range(64)) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
f AS (SELECT vec_id, i // 16 AS r, (i % 8) // 2 AS c, avg(v) AS f, max(CASE WHEN (i // 8) % 2 = 0 AND i % 2 = 0 THEN v END) AS s FROM p GROUP BY ALL),
b AS (SELECT vec_id, f, CASE WHEN vec_id % 50 = 0 AND r = 0 THEN NULL ELSE s END AS s FROM f)
SELECT vec_id, count(s) AS pixels, count(*) - count(s) AS unpaired, round(avg(abs(f - s)), 5) AS error, round(corr(f, s), 4) AS corr FROM b GROUP BY vec_id""")
def pyramid_agreement(spark: SparkSession, d: str) -> DataFrame:
    """Means of 2 x 2 pixels against their first pixels, with a row of some tiles left out."""
    px = table(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("i", "v"))
    px = px.select("vec_id", F.floor(F.col("i") / 8).alias("row"), (F.col("i") % 8).alias("col"), F.col("v").cast("double").alias("value"))
    small = px.where("row % 2 = 0 AND col % 2 = 0 AND NOT (vec_id % 50 = 0 AND row = 0)").select("vec_id", F.floor(F.col("row") / 2).alias("row"), F.floor(F.col("col") / 2).alias("col"), "value")
    return spatial.pyramid_agreement(px, small, 2, ["vec_id"]).select("vec_id", "pixels", "unpaired", F.round("error", 5).alias("error"), F.round("corr", 4).alias("corr"))


@query("""WITH n AS (SELECT user_id, event_id % 8 AS i, event_id % 3 <> 0 AS poly, event_id % 16 AS j FROM events)
SELECT user_id, count(*) FILTER (WHERE i = 0) AS ally, count(*) FILTER (WHERE i = 1) AS foe, count(DISTINCT j) FILTER (WHERE i = 2) AS selectors, count(*) FILTER (WHERE i = 3 AND poly) AS navmesh, count(*) FILTER (WHERE i = 4) AS obstacles,
  count(*) FILTER (WHERE i = 5) AS walls, count(*) FILTER (WHERE i = 6) AS reach_zones, count(*) FILTER (WHERE i = 7) AS colliders, count(*) FILTER (WHERE i < 2) AS markers, count(*) FILTER (WHERE i < 2 AND j < 8) AS squares FROM n GROUP BY user_id""")
def passability_census(spark: SparkSession, d: str) -> DataFrame:
    """Scene nodes by what they say of starts and ways, made of each user's events."""
    i, j = F.col("event_id") % 8, F.col("event_id") % 16
    name = F.get(F.array(*map(F.lit, ("ally", "foe", None, "navmesh", "obstacle", "wall", "ReachZone_1", "collide"))), i.cast("int"))
    ring = lambda *points: F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in points])
    nodes = table(spark, d, "events").select("user_id", F.coalesce(name, F.concat(F.lit("Selector"), j.cast("string"))).alias("name"), F.when(F.col("event_id") % 3 == 0, "node").otherwise("polygon").alias("type"), F.when(j < 8, ring((0, 0), (1, 0), (1, 1))).otherwise(ring((0, 0), (2, 0), (0, 2))).alias("points"))
    return spatial.passability(nodes, "user_id")


@query("""SELECT item_id AS id, CASE WHEN item_id % 2 = 0 THEN string_split(text, ' ')[1] ELSE 'no such words' END AS needle, item_id % 2 = 0 AS found FROM benchmark UNION ALL SELECT -1, 'x', FALSE""")
def known_answers(spark: SparkSession, d: str) -> DataFrame:
    """Known answers against rendered texts; half of them are wrong, and one has no text."""
    b = table(spark, d, "benchmark")
    asked = b.select(F.col("item_id").alias("id"), F.when(F.col("item_id") % 2 == 0, F.split("text", " ")[0]).otherwise("no such words").alias("needle"))
    return quality.known_answers(b, "item_id", "text", asked.unionByName(spark.createDataFrame([(-1, "x")], "id bigint, needle string")))


@query(r"""WITH m AS (SELECT page_id % 3 AS archive, 'p' || page_id || CASE page_id % 4 WHEN 0 THEN '.html' WHEN 1 THEN '.HTM' WHEN 2 THEN '.txt' ELSE '' END AS path, html, page_id FROM pages),
e AS (SELECT *, lower(regexp_extract(path, '\.([A-Za-z0-9]+)$', 1)) AS ext FROM m)
SELECT archive, ext, path, octet_length(encode(html)) AS size, CASE WHEN ext NOT IN ('html', 'htm') THEN 'n/a' WHEN starts_with(html, CASE ext WHEN 'html' THEN '<!DO' ELSE '<htm' END) THEN 'MATCH' ELSE 'MISMATCH' END AS magic,
  CASE WHEN page_id % 2 = 0 AND html IS NOT NULL THEN 'MATCH' ELSE 'MISMATCH' END AS checksum FROM e QUALIFY row_number() OVER (PARTITION BY archive, ext ORDER BY path) = 5""")
def member_proofs(spark: SparkSession, d: str) -> DataFrame:
    """The fifth member of each archive and ending, its first bytes and its sum; sums of odd pages are wrong."""
    p, content = F.col("page_id"), F.col("html").cast("binary")
    ending = F.get(F.array(*map(F.lit, (".html", ".HTM", ".txt", ""))), (p % 4).cast("int"))
    m = table(spark, d, "pages").select((p % 3).alias("archive"), F.concat(F.lit("p"), p.cast("string"), ending).alias("path"), content.alias("content"), (decode.adler32(content) + p % 2).alias("stored"))
    return quality.member_proofs(m, ["archive"], 5, {"html": b"<!DO".hex(), "htm": b"<htm".hex()})


@query("""SELECT event_type, count(*) AS rows, round(sum(value), 4) AS size, epoch_us(max(ts)) / 1e6 - epoch_us(min(ts)) / 1e6 AS seconds, round(sum(value) / nullif((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 0), 8) AS rate FROM events GROUP BY 1""")
def event_throughput(spark: SparkSession, d: str) -> DataFrame:
    """How much each type of event brings a second."""
    t = aggregates.throughput(table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")), ["event_type"], "ts", "value")
    return t.select("event_type", "rows", F.round("size", 4).alias("size"), F.round("seconds", 6).alias("seconds"), F.round("rate", 8).alias("rate"))


@query("""WITH l AS (SELECT c_mktsegment AS name, count(*) AS tiles, min(c_nationkey) AS low, max(c_nationkey) AS high FROM customer GROUP BY 1)
SELECT '{"crs":"world","kind":"map","layers":[' || string_agg('{"name":"' || name || '","tiles":' || tiles || ',"low":' || low || ',"high":' || high || '}', ',' ORDER BY name) || ']}' AS value FROM l""")
def registry_document(spark: SparkSession, d: str) -> DataFrame:
    """A document of layers from their summaries."""
    layers = table(spark, d, "customer").groupBy(F.col("c_mktsegment").alias("name")).agg(F.count("*").alias("tiles"), F.min("c_nationkey").alias("low"), F.max("c_nationkey").alias("high"))
    return writers.registry_document(layers, {"crs": "world", "kind": "map"}, ["name"])


@query("""SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS stamp, event_type = 'view' OR starts_with(event_type, 'si') OR starts_with(event_type, 'c') AS selected, contains(event_type, 'ur') AS needle FROM events""")
def stamps_and_selections(spark: SparkSession, d: str) -> DataFrame:
    """Stamps to the second, and modules by name, prefix and needle."""
    kind = F.col("event_type")
    return table(spark, d, "events").select("event_id", T.iso_seconds(F.col("ts")).alias("stamp"), T.selected(kind, ["view"], ["si", "c"]).alias("selected"), F.contains(kind, F.lit("ur")).alias("needle"))


@query(f"""WITH {_WORLD_SQL}, de AS (SELECT DISTINCT from_kind, to_kind FROM cl WHERE class = 'derived' AND family = 'BUILDING'), sc AS (SELECT DISTINCT 'r' || (p_partkey % 5) AS from_kind, 'r' || (p_size % 5) AS to_kind FROM part WHERE p_size < 3),
rs AS (SELECT 'r' || (s_nationkey % 5) AS from_kind, 'r' || (s_suppkey % 3) AS to_kind, 'p' || (s_suppkey % 4) AS path, count(*) AS hits FROM supplier WHERE s_nationkey % 5 < 2 GROUP BY ALL),
rk AS (SELECT *, row_number() OVER (PARTITION BY from_kind, to_kind ORDER BY hits DESC, path) AS rn FROM rs),
rt AS (SELECT from_kind, to_kind, CAST(sum(hits) AS BIGINT) AS hits, string_agg(path || '×' || hits, '; ' ORDER BY rn) FILTER (rn <= 3) AS paths FROM rk GROUP BY ALL)
SELECT d.from_kind, d.to_kind, CASE WHEN de.from_kind IS NOT NULL THEN 'derived-evidence' WHEN sc.from_kind IS NOT NULL THEN 'schema-empty' WHEN rt.hits IS NOT NULL THEN 'unadjudicated-name-hits' WHEN d.from_kind = 'r4' THEN 'terminal' ELSE 'no-carrier' END AS class,
  CASE WHEN de.from_kind IS NOT NULL THEN NULL WHEN sc.from_kind IS NOT NULL THEN 'a column of ' || d.from_kind || ' names ' || d.to_kind || ' and is never filled' WHEN rt.hits IS NOT NULL THEN rt.hits || ' equal names; ' || paths WHEN d.from_kind = 'r4' THEN 'names nothing' ELSE 'find a carrier' END AS unblock
FROM dirs d LEFT JOIN de USING (from_kind, to_kind) LEFT JOIN sc USING (from_kind, to_kind) LEFT JOIN rt USING (from_kind, to_kind) WHERE d.status = 'missing'""")
def ledger_classes(spark: SparkSession, d: str) -> DataFrame:
    """Why each direction without edges has none, by ordered rules."""
    dirs, classed, _ = _world(spark, d)
    p, s = table(spark, d, "part").where("p_size < 3"), table(spark, d, "supplier").where("s_nationkey % 5 < 2")
    declared = p.select(_r(F.col("p_partkey") % 5, "from_kind"), _r(F.col("p_size") % 5, "to_kind"))
    residual = s.groupBy(_r(F.col("s_nationkey") % 5, "from_kind"), _r(F.col("s_suppkey") % 3, "to_kind"), F.concat(F.lit("p"), (F.col("s_suppkey") % 4).cast("string")).alias("norm_path")).agg(F.count("*").alias("hits"))
    terminal = spark.createDataFrame([("r4", "terminal", "names nothing")], "from_kind string, class string, reason string")
    return relations.ledger_classes(dirs, classed.where("class = 'derived' AND family = 'BUILDING'"), declared, residual, terminal)


@query("""WITH f AS (SELECT DISTINCT 'n' || c_nationkey || '/d' || c_custkey AS folder, CASE WHEN c_custkey % 4 <> 0 THEN 'n' || c_nationkey || '/s' || (c_custkey % 3) || '.v.prefab' END AS owner FROM customer),
k AS (SELECT *, CASE WHEN owner IS NULL THEN 'unowned' ELSE regexp_extract(owner, '/(s[0-9]+\\.v)\\.prefab', 1) END AS stem FROM f)
SELECT folder, stem || '-' || CASE WHEN length(CAST(row_number() OVER w - 1 AS VARCHAR)) < 4 THEN lpad(CAST(row_number() OVER w - 1 AS VARCHAR), 4, '0') ELSE CAST(row_number() OVER w - 1 AS VARCHAR) END AS id FROM k WINDOW w AS (PARTITION BY stem ORDER BY folder)""")
def allocated_ids(spark: SparkSession, d: str) -> DataFrame:
    """Ids of folders from their owners' names, in the order of their paths."""
    k = F.col("c_custkey")
    owner = F.when(k % 4 != 0, F.format_string("n%d/s%d.v.prefab", "c_nationkey", k % 3))
    folders = table(spark, d, "customer").select(F.format_string("n%d/d%d", "c_nationkey", k).alias("folder"), owner.alias("owner")).distinct()
    return relations.allocated_ids(folders).select("folder", "id")


@query("""WITH e AS (SELECT 'r' || (c_nationkey % 5) AS from_kind, 'r' || (c_custkey % 3) AS to_kind, c_mktsegment AS family, 'C' || c_custkey AS from_id, 'N' || c_nationkey AS to_id, CASE WHEN c_custkey % 2 = 0 THEN 'path' ELSE 'token' END AS m FROM customer)
SELECT from_kind, to_kind, family, count(*) AS edges, count(DISTINCT from_id) AS from_ids, count(DISTINCT to_id) AS to_ids, string_agg(DISTINCT m, '+' ORDER BY m) AS methods, (SELECT count(*) FROM e x WHERE x.from_kind = e.from_kind AND x.to_kind = e.to_kind) AS written FROM e GROUP BY ALL""")
def family_files(spark: SparkSession, d: str) -> DataFrame:
    """Evidence written by direction with its families' statistics, and the rows that are read back of each direction."""
    k = F.col("c_custkey")
    id_ = lambda letter, c: F.concat(F.lit(letter), c.cast("string"))
    edges = table(spark, d, "customer").select(_r(F.col("c_nationkey") % 5, "from_kind"), _r(k % 3, "to_kind"), F.col("c_mktsegment").alias("family"), id_("C", k).alias("from_id"), id_("N", F.col("c_nationkey")).alias("to_id"), F.concat(F.when(k % 2 == 0, "path").otherwise("token"), F.lit(":"), k.cast("string")).alias("method"))
    path = fresh_folder(spark, "families")
    stats = writers.write_families(edges, path)
    written = spark.read.schema("from_id string, from_kind string, to_kind string").json(f"{path}/edges").groupBy("from_kind", "to_kind").agg(F.count("from_id").alias("written"))
    return stats.join(written, ["from_kind", "to_kind"])


@query("""SELECT 'orders' AS "table", count(*) + 1 AS wanted, count(*) AS found FROM orders UNION ALL SELECT 'strings', 5, NULL UNION ALL SELECT 'part', NULL, count(*) FROM part""")
def snapshot_counts(spark: SparkSession, d: str) -> DataFrame:
    """A snapshot of five tables written as JSON lines with a header, read back: a count planted wrong, a table that only the header
    has and one that it lacks are in the ledger."""
    path, names = fresh_folder(spark, "snapshot"), ["orders", "customer", "nation", "region", "part"]
    tables = {n: table(spark, d, n).select(F.col(c).cast("bigint").alias("key")) for n, c in zip(names, ("o_orderkey", "c_custkey", "n_nationkey", "r_regionkey", "p_partkey"))}
    counts = None
    for name, df in tables.items():
        df.write.json(f"{path}/{name}")
        one = df.agg(F.lit(name).alias("table"), (F.count("*") + F.lit(int(name == "orders"))).alias("rows"))
        counts = one if counts is None else counts.unionByName(one)
    counts.where("table <> 'part'").unionByName(spark.createDataFrame([("strings", 5)], "table string, rows bigint")).coalesce(1).write.json(f"{path}/header")
    read, ledger = records.read_snapshot(spark, path, dict.fromkeys(names, "key bigint"), "the snapshot")
    return ledger
