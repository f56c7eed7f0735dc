"""Code, frames, icons, rasters, mosaics, documents and dimensions made of the tables, with SQL that says the same."""

from __future__ import annotations

import struct

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafwork.functions import formulas
from sheafwork.functions import text as T
from sheafwork.operators import aggregates, flow, graph, quality, search, spatial, walk
from sheafwork.plans.audits import written_archives
from sheafwork.plans.registry import query
from sheafwork.session import dealt, fresh_folder, table
from sheafwork.sources import archive, binary, records


@query("""WITH RECURSIVE o AS (SELECT l_orderkey AS f, CAST(l_linenumber AS INT) AS pc, min(l_partkey) AS p, min(l_suppkey) AS s FROM lineitem GROUP BY ALL),
x AS (SELECT f, pc, CASE WHEN p % 3 = 0 THEN CAST(s % 7 + 1 AS INT) END AS target, p % 5 <> 0 AS falls FROM o), t AS (SELECT DISTINCT f, target AS pc FROM x WHERE target IS NOT NULL),
l AS (SELECT x.*, coalesce(lag(x.target IS NOT NULL OR NOT falls) OVER (PARTITION BY x.f ORDER BY x.pc), TRUE) OR t.pc IS NOT NULL AS leader FROM x LEFT JOIN t ON t.f = x.f AND t.pc = x.pc),
b AS (SELECT *, sum(CASE WHEN leader THEN 1 ELSE 0 END) OVER (PARTITION BY f ORDER BY pc) - 1 AS block, lead(leader) OVER (PARTITION BY f ORDER BY pc) AS next_leader FROM l),
e AS (SELECT a.f, a.block AS a, t.block AS b FROM b a JOIN b t ON t.f = a.f AND t.pc = a.target UNION SELECT f, block, block + 1 FROM b WHERE next_leader AND falls),
r AS (SELECT DISTINCT f, CAST(0 AS HUGEINT) AS n FROM b UNION SELECT e.f, e.b FROM r JOIN e ON e.f = r.f AND e.a = r.n),
v AS (SELECT f, n AS d, CAST(0 AS HUGEINT) AS n FROM r WHERE n <> 0 UNION SELECT v.f, v.d, e.b FROM v JOIN e ON e.f = v.f AND e.a = v.n WHERE e.b <> v.d),
dom AS (SELECT x.f, x.n AS d, y.n FROM r x JOIN r y ON x.f = y.f LEFT JOIN v ON v.f = x.f AND v.d = x.n AND v.n = y.n WHERE v.f IS NULL),
deep AS (SELECT f, n, count(*) - 1 AS depth FROM dom GROUP BY ALL)
SELECT b.f AS function, count(*) AS ops, CAST(max(block) + 1 AS BIGINT) AS blocks, (SELECT count(*) FROM e WHERE e.f = b.f) AS edges, (SELECT count(*) FROM r WHERE r.f = b.f) AS reachable,
  (SELECT count(*) FROM e JOIN dom ON dom.f = e.f AND dom.d = e.b AND dom.n = e.a WHERE e.f = b.f) AS loops, (SELECT max(depth) FROM deep WHERE deep.f = b.f) AS dominator_depth, CAST((SELECT count(*) FROM e WHERE e.f = b.f) - max(block) + 1 AS BIGINT) AS complexity
FROM b GROUP BY b.f""")
def cfg_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Orders as functions whose lines jump and stop: blocks, edges, reach, loops and dominators of each."""
    lines = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("function"), F.col("l_linenumber").cast("int").alias("pc")).agg(F.min("l_partkey").alias("p"), F.min("l_suppkey").alias("s"))
    targets = F.when(F.col("p") % 3 == 0, F.array((F.col("s") % 7 + 1).cast("int"))).otherwise(F.array().cast("array<int>"))
    return flow.flow_metrics(lines.select("function", "pc", targets.alias("targets"), (F.col("p") % 5 != 0).alias("falls")))


@query("""WITH RECURSIVE e AS (SELECT p_partkey // 2 AS a, p_partkey AS b, CAST(p_size AS DOUBLE) AS x, CAST(p_partkey % 7 AS DOUBLE) AS y, 90.0 * (p_partkey % 4) AS angle FROM part WHERE p_partkey > 1 AND p_partkey % 11 <> 0),
f AS (SELECT CAST(1 AS BIGINT) AS node, CAST(10 AS DOUBLE) AS x, CAST(0 AS DOUBLE) AS y, CAST(90 AS DOUBLE) AS angle
  UNION ALL SELECT e.b, f.x + cos(radians(f.angle)) * e.x - sin(radians(f.angle)) * e.y, f.y + sin(radians(f.angle)) * e.x + cos(radians(f.angle)) * e.y, f.angle + e.angle FROM f JOIN e ON e.a = f.node)
SELECT node, round(x, 3) + 0.0 AS x, round(y, 3) + 0.0 AS y, angle FROM f""")
def frame_propagation(spark: SparkSession, d: str) -> DataFrame:
    """World frames down a tree of parts; every eleventh is scaled, and neither it nor what lies below has a frame."""
    k = F.col("p_partkey").cast("bigint")
    edges = table(spark, d, "part").where("p_partkey > 1").select(F.floor(k / 2).alias("a"), k.alias("b"), F.col("p_size").cast("double").alias("x"), (k % 7).cast("double").alias("y"), (k % 4 * 90.0).alias("angle"), F.when(k % 11 == 0, 2.0).otherwise(1.0).alias("scale"))
    roots = spark.createDataFrame([(1, 10.0, 0.0, 90.0)], "node bigint, x double, y double, angle double")
    return graph.propagate_frames(roots, edges).select("node", (F.round("x", 3) + 0.0).alias("x"), (F.round("y", 3) + 0.0).alias("y"), "angle")


@query("""WITH i AS (SELECT c_custkey AS k, c_custkey % 120 + 1 AS file, c_custkey % 3 AS size, c_custkey % 2 AS x, (c_custkey // 2) % 2 AS y FROM customer),
p AS (SELECT i.*, CASE WHEN size = 1 THEN substr(md5(s_name), 1 + 8 * (2 * y + x), 8) ELSE md5(s_name) END AS px, s_suppkey IS NOT NULL AS there FROM i LEFT JOIN supplier ON s_suppkey = file),
v AS (SELECT *, CASE WHEN NOT there THEN 'no_atlas' WHEN size = 0 THEN 'bad_size' WHEN (x + 1) * size > 2 OR (y + 1) * size > 2 THEN 'out_of_bounds' WHEN substr(px, 7, 2) || substr(px, 15, 2) || substr(px, 23, 2) || substr(px, 31, 2) IN ('00', '00000000') THEN 'blank' ELSE 'ok' END AS verdict FROM p)
SELECT 'C' || k AS id, verdict, CASE WHEN verdict = 'ok' THEN sha256(unhex(px)) END AS pixels FROM v""")
def icon_crops(spark: SparkSession, d: str) -> DataFrame:
    """Icons of customers cut out of atlases of 2 x 2 pixels made of suppliers' digests: the crops, and why there is none."""
    k = F.col("c_custkey")
    name = lambda n: F.concat(F.lit("s"), n.cast("string"))
    atlases = table(spark, d, "supplier").select(name(F.col("s_suppkey")).alias("file"), F.lit(2).alias("width"), F.lit(2).alias("height"), F.unhex(F.md5(F.col("s_name").cast("binary"))).alias("data"))
    icons = table(spark, d, "customer").select(F.concat(F.lit("C"), k.cast("string")).alias("id"), name(k % 120 + 1).alias("file"), (k % 3).cast("int").alias("size"), (k % 2).cast("int").alias("x"), F.expr("CAST(c_custkey DIV 2 % 2 AS INT)").alias("y"))
    return binary.crop_icons(icons, atlases).select("id", "verdict", F.sha2("pixels", 256).alias("pixels"))


_FLOATS = [i * 0.5 - 2 for i in range(16)]


@query("""WITH f AS (SELECT c_custkey AS k, ((c_custkey + j) % 16) * 0.5 - 2 AS v FROM customer, (SELECT unnest(range(4)) AS j))
SELECT k AS grid, CAST(1 AS DOUBLE) AS finite, CAST(min(v) AS DOUBLE) AS low, CAST(max(v) AS DOUBLE) AS high, avg(CASE WHEN abs(v) < 0.000001 THEN 1.0 ELSE 0.0 END) AS plateau, 'terrain' AS verdict FROM f GROUP BY k""")
def raster_proof(spark: SparkSession, d: str) -> DataFrame:
    """Headerless float grids of customers as pixels, and what their values prove."""
    k = F.col("c_custkey")
    bits = F.array(*[F.lit(struct.pack("<f", v).hex()) for v in _FLOATS])
    raw = F.unhex(F.concat(*[F.element_at(bits, ((k + j) % 16 + 1).cast("int")) for j in range(4)]))
    pixels = binary.float_grid(dealt(table(spark, d, "customer").select(k)).select(k.alias("grid"), raw.alias("content")), "content", ["grid"])
    return binary.grid_stats(pixels, ["grid"], pin=0.0).select("grid", "finite", F.col("low").cast("double").alias("low"), F.col("high").cast("double").alias("high"), "plateau", "verdict")


@query("""WITH t AS (SELECT 'n' || (c_nationkey % 3) AS layer, c_custkey % 13 AS x, c_custkey % 17 AS y, max(left(md5(c_name), 8)) AS h FROM customer WHERE c_custkey % 5 < 2 GROUP BY ALL),
f AS (SELECT layer, min(x) AS x0, max(x) AS x1, min(y) AS y0 FROM t GROUP BY 1), r AS (SELECT DISTINCT layer, y, j FROM t, (SELECT unnest([0, 1]) AS j)),
c AS (SELECT r.layer, (r.y - y0) * 2 + j AS row, x, j, r.y FROM (SELECT r.*, f.y0, unnest(range(x0, x1 + 1)) AS x FROM r JOIN f ON f.layer = r.layer) r)
SELECT c.layer, CAST(c.row AS BIGINT) AS row, upper(string_agg(coalesce(substr(h, 1 + 4 * j, 4), '0000'), '' ORDER BY c.x)) AS data FROM c LEFT JOIN t ON t.layer = c.layer AND t.x = c.x AND t.y = c.y GROUP BY ALL""")
def mosaic_layout(spark: SparkSession, d: str) -> DataFrame:
    """Pixel rows of mosaics of 2 x 2 tiles made of customers' digests, holes as zeros."""
    k = F.col("c_custkey")
    tiles = table(spark, d, "customer").where(k % 5 < 2).select(F.concat(F.lit("n"), (F.col("c_nationkey") % 3).cast("string")).alias("layer"), (k % 13).alias("x"), (k % 17).alias("y"), F.unhex(F.left(F.md5(F.col("c_name").cast("binary")), F.lit(8))).alias("data"))
    return spatial.mosaic_rows(tiles, 2).select("layer", F.col("row").cast("bigint").alias("row"), F.hex("data").alias("data"))


@query("""SELECT c_custkey AS id, c_name AS name, c_mktsegment AS seg, CAST(c_nationkey AS BIGINT) AS first, c_acctbal > 0 AS rich, c_custkey % 2 = 0 AS nothing FROM customer""")
def notation_decode(spark: SparkSession, d: str) -> DataFrame:
    """Customers written in object notation, found by their magic and read back as JSON."""
    k = F.col("c_custkey")
    row = F.to_json(F.struct(F.col("c_name").alias("name"), F.struct(F.col("c_mktsegment").alias("é")).alias("seg"), F.array(F.col("c_nationkey").cast("bigint"), k.cast("bigint")).alias("of"), (F.col("c_acctbal") > 0).alias("rich")))
    text = F.concat(F.expr("rtrim('}', j)"), F.when(k % 2 == 0, ',"n":null}').otherwise("}"))
    blobs = table(spark, d, "customer").withColumn("j", row).select(k.alias("id"), binary.json_to_notation(text).alias("content"))
    value = binary.by_magic(blobs).select("id", binary.notation_to_json("content").alias("v"))
    get = lambda path: F.get_json_object("v", path)
    return value.select("id", get("$.name").alias("name"), get("$.seg.é").alias("seg"), get("$.of[0]").cast("bigint").alias("first"), (get("$.rich") == "true").alias("rich"), F.col("v").endswith('"n": null}').alias("nothing"))


@query("""SELECT 'c/n' || c_nationkey || '/' || c_custkey || '.txt' AS path, CAST(CASE WHEN c_custkey % 10 = 7 THEN 2 ELSE 0 END AS INT) AS flags, CAST(length(c_name) + 1 + length(c_mktsegment) AS BIGINT) AS size, c_name || ' ' || c_mktsegment AS content FROM customer""")
def pak_entries(spark: SparkSession, d: str) -> DataFrame:
    """Archives of customers through the data source: every member with its payload, checked as it is read."""
    spark.dataSource.register(archive.PakSource)
    folder, _ = written_archives(spark, d, harmed=False)
    entries = spark.read.format("pak").option("payload", "true").option("split", "4096").load(folder)
    return entries.select("path", "flags", "size", F.col("content").cast("string").alias("content"))


@query("""SELECT 'c/n' || c_nationkey AS folder, count(*) AS members, CAST(sum(length(c_name) + 1 + length(c_mktsegment)) AS BIGINT) AS bytes FROM customer GROUP BY 1""")
def archive_folders(spark: SparkSession, d: str) -> DataFrame:
    """The folders below c/ of archives, with their members and bytes."""
    from sheafwork.sources.extraction import entries_of

    entries = entries_of(written_archives(spark, d, harmed=False)[1])
    folders = archive.directories(entries).where("path LIKE 'c/%'").select(F.col("path").alias("folder"))
    sizes = archive.with_prefix(entries, "c/").select(F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder"), "size")
    return folders.join(sizes, "folder").groupBy("folder").agg(F.count("*").alias("members"), F.sum("size").alias("bytes"))


@query("""SELECT 'customer' AS sheet, 'C' || c_custkey AS id, CAST(c_nationkey AS BIGINT) AS nation, c_custkey % 3 = 0 AS tagged FROM customer
UNION ALL SELECT 'column:' || name, type, opt, kind FROM (VALUES ('id', '0', CAST(0 AS BIGINT), FALSE), ('nation', '6:nation', 1, TRUE)) t(name, type, opt, kind) UNION ALL SELECT DISTINCT 'case:' || c_mktsegment, 'Segment', NULL, NULL FROM customer""")
def sheet_documents(spark: SparkSession, d: str) -> DataFrame:
    """Sheet databases written as JSON documents, one for each nation and thousand keys, and read back: lines, columns and cases."""
    k = F.col("c_custkey")
    line = F.struct(F.concat(F.lit("C"), k.cast("string")).alias("id"), F.col("c_nationkey").cast("bigint").alias("nation"), F.when(k % 3 == 0, F.struct(F.lit(1).alias("x"))).alias("tag"))
    docs = table(spark, d, "customer").groupBy("c_nationkey", F.expr("c_custkey DIV 1000").alias("part")).agg(F.array_join(F.sort_array(F.collect_list(F.to_json(line))), ",").alias("lines"), F.array_join(F.transform(F.sort_array(F.collect_set("c_mktsegment")), lambda s: F.concat(F.lit('{"name":"'), s, F.lit('"}'))), ",").alias("cases"))
    head = '{"sheets":[{"name":"customer","columns":[{"name":"id","typeStr":"0"},{"name":"nation","typeStr":"6:nation","opt":true,"kind":"link"}],"lines":['
    folder = fresh_folder(spark, "sheets")
    docs.select("c_nationkey", "part", F.concat(F.lit(head), "lines", F.lit(']}],"customTypes":[{"name":"Segment","cases":['), "cases", F.lit("]}]}")).alias("value")).write.partitionBy("c_nationkey", "part").text(folder)
    dictionary, lines, cases = records.read_sheet_database(spark, folder)
    none = F.lit(None)
    rows = lines.select("sheet", F.get_json_object("row", "$.id").alias("id"), F.get_json_object("row", "$.nation").cast("bigint").alias("nation"), F.get_json_object("row", "$.tag").isNotNull().alias("tagged"))
    columns = dictionary.select(F.concat(F.lit("column:"), "name").alias("sheet"), F.col("type_str").alias("id"), F.col("opt").cast("bigint").alias("nation"), F.col("kind").isNotNull().alias("tagged")).distinct()
    return rows.unionByName(columns).unionByName(cases.select(F.concat(F.lit("case:"), "name").alias("sheet"), F.col("type").alias("id"), none.cast("bigint").alias("nation"), none.cast("boolean").alias("tagged")).distinct())


@query("""SELECT CASE c_custkey % 3 WHEN 0 THEN 'prefab' WHEN 1 THEN 'l3d' ELSE 'txt' END AS extension, CASE WHEN c_custkey % 3 = 2 THEN 'plain' ELSE left(md5(c_mktsegment), 5) END AS magic, count(*) AS files FROM customer WHERE c_custkey % 3 <> 2 GROUP BY ALL""")
def magic_by_extension(spark: SparkSession, d: str) -> DataFrame:
    """Files of customers found by their endings, and the census of their first bytes; the text files are not opened."""
    k = F.col("c_custkey")
    ending = F.when(k % 3 == 0, "prefab").when(k % 3 == 1, "l3d").otherwise("txt")
    folder = fresh_folder(spark, "files")

    def write(parts):
        import pyarrow.fs as pafs

        fs, below = pafs.FileSystem.from_uri(folder)
        for pdf in parts:
            for n, name, content in zip(pdf.nation, pdf.name, pdf.content):
                fs.create_dir(f"{below}/n{n}", recursive=True)
                with fs.open_output_stream(f"{below}/n{n}/{name}") as f:
                    f.write(content.encode())
            yield pdf[["name"]]

    rows = table(spark, d, "customer").select(F.col("c_nationkey").alias("nation"), F.concat_ws(".", k.cast("string"), ending).alias("name"), F.md5(F.col("c_mktsegment").cast("binary")).alias("content"))
    rows.mapInPandas(write, "name string").write.format("noop").mode("overwrite").save()
    files = records.files_with_suffix(spark, folder, [".prefab", ".l3d"])
    return files.groupBy(F.regexp_extract("path", r"\.([^.]*)$", 1).alias("extension"), F.call_function("substring", "content", F.lit(1), F.lit(5)).cast("string").alias("magic")).agg(F.count("*").alias("files"))


@query("""SELECT p_partkey, 2 AS n, p_brand AS first, '(' || p_type || ')->i32' AS second, 'T' || p_size AS result FROM part WHERE p_partkey % 4 <> 0 UNION ALL SELECT p_partkey, 0, NULL, NULL, 'void' FROM part WHERE p_partkey % 8 = 0 UNION ALL SELECT p_partkey, NULL, NULL, NULL, NULL FROM part WHERE p_partkey % 8 = 4""")
def signature_texts(spark: SparkSession, d: str) -> DataFrame:
    """Signatures with a function among their arguments, without arguments, and texts that are none."""
    k = F.col("p_partkey")
    text = F.when(k % 8 == 4, F.col("p_name")).when(k % 8 == 0, "()->void").otherwise(F.concat(F.lit("("), "p_brand", F.lit(",("), "p_type", F.lit(")->i32)->T"), F.col("p_size").cast("string")))
    parts = dealt(table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")).select("p_partkey", T.signature_parts(text).alias("s"))
    get = lambda n: F.try_element_at("s.arguments", F.lit(n))
    return parts.select("p_partkey", F.when(F.col("s").isNotNull(), F.size("s.arguments")).alias("n"), get(1).alias("first"), get(2).alias("second"), F.col("s.result").alias("result"))


@query("""WITH RECURSIVE p AS (SELECT p_partkey AS id, p_partkey // 2 AS up, CASE WHEN p_partkey % 5 = 0 THEN p_size END AS price FROM part),
c AS (SELECT id, id AS at, 0 AS depth FROM p UNION ALL SELECT c.id, p.up, depth + 1 FROM c JOIN p ON p.id = c.at WHERE p.up > 0),
f AS (SELECT c.id, p.price FROM c JOIN p ON p.id = c.at WHERE p.price IS NOT NULL AND depth > 0 QUALIFY row_number() OVER (PARTITION BY c.id ORDER BY depth) = 1)
SELECT p.id, CAST(coalesce(p.price, f.price) AS DOUBLE) AS price FROM p LEFT JOIN f ON f.id = p.id""")
def item_prices(spark: SparkSession, d: str) -> DataFrame:
    """A part's own price, else the first one up its parents, else none."""
    k = F.col("p_partkey").cast("bigint")
    parts = table(spark, d, "part").select(k.alias("id"), F.when(F.floor(k / 2) > 0, F.floor(k / 2)).alias("up"), F.when(k % 5 == 0, F.col("p_size").cast("double")).alias("own"))
    chain = graph.ancestors(parts, "id", "up").where("depth > 0")
    inherited = graph.first_along_chain(chain, parts.withColumnRenamed("id", "part"), "part", "own").select(F.col("child").alias("id"), F.col("own").alias("above"))
    return parts.join(inherited, "id", "left").select("id", formulas.item_price(F.col("own"), F.col("above")).alias("price"))


@query("""SELECT coalesce(r_name, 'unknown') AS id, count(*) AS n FROM events LEFT JOIN region ON r_regionkey = event_id % 7 GROUP BY 1""")
def attribute_counts(spark: SparkSession, d: str) -> DataFrame:
    """Events counted by the name that their attribute's place has in a list; some places are beyond it."""
    names = table(spark, d, "region").select(F.col("r_regionkey").alias("place"), F.col("r_name").alias("id"))
    return aggregates.counts_by_place(table(spark, d, "events").select((F.col("event_id") % 7).alias("place")), "place", names)


@query("""SELECT CASE WHEN string_split(p_type, ' ')[1] IN ('ECONOMY', 'PROMO', 'STANDARD') THEN lower(string_split(p_type, ' ')[1]) ELSE 'other' END AS family, count(DISTINCT p_type) AS names, count(*) AS "rows" FROM part GROUP BY 1""")
def name_families(spark: SparkSession, d: str) -> DataFrame:
    """Types by the family of their first word; those of no family are ``other``."""
    families = spark.createDataFrame([("ECONOMY", "economy"), ("PROMO", "promo"), ("STANDARD", "standard")], "root string, family string")
    named = aggregates.classified(table(spark, d, "part"), F.substring_index("p_type", " ", 1), families)
    return named.groupBy("family").agg(F.count_distinct("p_type").alias("names"), F.count("*").alias("rows"))


@query("""SELECT source AS kind, lang AS locale, count(*) AS n FROM documents WHERE source NOT IN ('src0', 'src1', 'src2', 'src3', 'src4', 'src5', 'src6', 'src7', 'src8', 'src9') OR lang NOT IN ('en', 'de') GROUP BY ALL""")
def stray_kinds(spark: SparkSession, d: str) -> DataFrame:
    """Documents of kinds and locales that are not managed, enumerated."""
    rows = table(spark, d, "documents").select(F.col("source").alias("kind"), F.col("lang").alias("locale"))
    return search.strays(rows, [f"src{k}" for k in range(10)], ["en", "de"]).groupBy("kind", "locale").agg(F.count("*").alias("n"))


@query("""SELECT r_regionkey AS region, count(DISTINCT c_custkey) AS used, count(DISTINCT CASE WHEN c_nationkey % 2 = 0 THEN c_custkey END) AS bridged, count(DISTINCT CASE WHEN c_nationkey % 2 = 1 THEN c_custkey END) AS beyond FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY 1""")
def bridge_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Of what each region uses: what a bridge has and what it lacks."""
    nation = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").alias("region"))
    used = table(spark, d, "customer").join(nation, "c_nationkey").select("region", "c_custkey", "c_nationkey")
    return aggregates.coverage_by(used, "region", "c_custkey", used.where("c_nationkey % 2 = 0").select("c_custkey"))


@query("""WITH c AS (SELECT CAST(floor(c_acctbal / 500) AS BIGINT) AS col, CAST(c_nationkey AS BIGINT) AS row, count(*) AS n FROM customer GROUP BY ALL)
SELECT CAST(s_nationkey AS BIGINT) AS nation, count(*) AS points, round(min(abs(s_acctbal)), 6) AS low, round(median(abs(s_acctbal)), 6) AS mid, round(max(abs(s_acctbal)), 6) AS high, round(avg(CASE WHEN n % 2 = 0 THEN 1.0 ELSE 0.0 END), 6) AS on_land
FROM supplier LEFT JOIN c ON c.row = s_nationkey AND c.col = CAST(floor(s_acctbal / 500) AS BIGINT) GROUP BY 1""")
def land_shares(spark: SparkSession, d: str) -> DataFrame:
    """How far suppliers of a nation lie, and the share of them whose cell is land; cells that are not there are none."""
    cells = table(spark, d, "customer").groupBy(spatial.floor_cell(F.col("c_acctbal"), 500).alias("col"), F.col("c_nationkey").cast("bigint").alias("row")).agg((F.count("*") % 2 == 0).alias("land"))
    points = table(spark, d, "supplier").select(F.col("s_nationkey").cast("bigint").alias("nation"), F.abs("s_acctbal").cast("double").alias("far"), F.col("s_nationkey").cast("bigint").alias("row"), spatial.floor_cell(F.col("s_acctbal"), 500).alias("col"))
    out = aggregates.group_reach(points.join(cells, ["row", "col"], "left"), "nation", "far", "land")
    return out.select("nation", "points", *[F.round(c, 6).alias(c) for c in ("low", "mid", "high", "on_land")])


@query("""SELECT 'C' || c_custkey AS id, 'unexplained' AS rule FROM customer WHERE c_custkey % 10 = 3 AND c_custkey % 4 <> 0 UNION ALL SELECT 'C' || c_custkey, 'present' FROM customer WHERE c_custkey % 10 <> 3 AND c_custkey % 4 = 0 AND c_custkey % 100 = 8 UNION ALL SELECT 'S' || s_suppkey, 'stray' FROM supplier WHERE s_suppkey % 25 = 0""")
def subset_residue(spark: SparkSession, d: str) -> DataFrame:
    """A part of the customers and the residue that it should lack, with strays, gaps and false residue planted."""
    k = F.col("c_custkey")
    name = lambda letter, c: F.concat(F.lit(letter), c.cast("string")).alias("id")
    whole = table(spark, d, "customer").select(k, name("C", k))
    strays = table(spark, d, "supplier").where("s_suppkey % 25 = 0").select(name("S", F.col("s_suppkey")))
    part = whole.where("c_custkey % 10 <> 3").select("id").unionByName(strays)
    residue = whole.where("c_custkey % 4 = 0 AND (c_custkey % 10 = 3 OR c_custkey % 100 = 8)").select("id")
    return quality.subset_residue(part, whole.select("id"), residue, ["id"])


@query("""SELECT CASE c_custkey % 3 WHEN 0 THEN 'mesh' WHEN 1 THEN 'light' ELSE 'reference' END AS type, 1 AS depth, count(*) AS n FROM customer GROUP BY 1 UNION ALL SELECT 'leaf', 2, count(*) FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT 'scene', 0, count(*) FROM customer""")
def child_types(spark: SparkSession, d: str) -> DataFrame:
    """Nodes of nested scenes by their type and depth, in one walk."""
    k = F.col("c_custkey")
    kind = F.when(k % 3 == 0, "mesh").when(k % 3 == 1, "light").otherwise("reference")
    leaf = F.when(k % 2 == 0, F.array(F.struct(F.lit("leaf").alias("type"))))
    scene = F.to_json(F.struct(F.lit("scene").alias("type"), F.array(F.struct(kind.alias("type"), F.col("c_name").alias("name"), leaf.alias("children"))).alias("children")))
    cells = walk.walk_json(table(spark, d, "customer").select(k, scene.alias("row")), ["c_custkey"], "row", 6)
    nodes = walk.typed_nodes(cells, ["c_custkey"], "type")
    return nodes.select(F.col("node_type").alias("type"), F.regexp_count("node", F.lit("children")).alias("depth")).groupBy("type", "depth").agg(F.count("*").alias("n"))


@query("SELECT c_custkey, CAST(floor(c_acctbal / 500) AS BIGINT) AS floored, CAST(trunc(c_acctbal / 500) AS BIGINT) AS cut FROM customer")
def cell_rules(spark: SparkSession, d: str) -> DataFrame:
    """Cells of balances by both rules; they differ below zero."""
    v = F.col("c_acctbal").cast("double")
    return table(spark, d, "customer").select("c_custkey", spatial.floor_cell(v, 500).alias("floored"), spatial.truncated_cell(v, 500).alias("cut"))
