"""Sheet databases, exports, headers and paths made of the driver's tables, with SQL computed from the same tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafwork.functions import text as T
from sheafwork.functions.decode import is_media, type_label
from sheafwork.operators import graph, locale, relations, sheets, spatial, walk
from sheafwork.plans.registry import query
from sheafwork.session import dealt, table
from sheafwork.sources import binary, markup

DICTIONARY = [
    ("customer", "id", "0", False, None), ("customer", "name", "1", False, "localizable"), ("customer", "nation", "6:nation", True, None), ("customer", "parts", "8", True, None),
    ("customer@parts", "of", "6:customer", False, None), ("customer@parts", "place", "6:place", True, None), ("nation", "id", "0", False, None), ("nation", "region", "6:region", True, None),
    ("note", "text", "1", False, None), ("place", "id", "0", False, None),
]


def _id(letter: str, key: Column) -> Column:
    return F.concat(F.lit(letter), key.cast("string"))


def _sheets(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Customers with a hidden sheet of parts and an undeclared key, the nations below 20, notes without ids; places and regions
    have no lines."""
    k = F.col("c_custkey")
    part = F.struct(_id("C", F.floor(k / 2)).alias("of"), F.when(k % 5 == 0, _id("P", k % 7)).alias("place"))
    customer = F.struct(_id("C", k).alias("id"), F.col("c_name").alias("name"), _id("N", F.col("c_nationkey")).alias("nation"), F.array(part).alias("parts"), F.when(k % 3 == 0, F.col("c_mktsegment")).alias("seg"))
    nation = F.struct(_id("N", F.col("n_nationkey")).alias("id"), _id("R", F.col("n_regionkey")).alias("region"))
    line = lambda df, sheet, ord_, row: df.select(F.lit(sheet).alias("sheet"), F.col(ord_).cast("bigint").alias("ord"), F.to_json(row).alias("row"))
    lines = line(table(spark, d, "customer"), "customer", "c_custkey", customer).unionByName(line(table(spark, d, "nation").where("n_nationkey < 20"), "nation", "n_nationkey", nation))
    notes = line(table(spark, d, "benchmark"), "note", "item_id", F.struct("text"))
    return spark.createDataFrame(DICTIONARY, "sheet string, name string, type_str string, opt boolean, kind string"), lines.unionByName(notes)


_EDGES_SQL = """e AS (SELECT 'customer' AS from_kind, 'nation' AS to_kind, 'C' || c_custkey AS from_id, 'N' || c_nationkey AS to_id, 'nation' AS "column", CASE WHEN c_nationkey < 20 THEN 'true' ELSE 'false' END AS valid FROM customer
UNION ALL SELECT 'customer', 'customer', 'C' || c.c_custkey, 'C' || (c.c_custkey // 2), 'of', CASE WHEN o.c_custkey IS NULL THEN 'false' ELSE 'true' END FROM customer c LEFT JOIN customer o ON o.c_custkey = c.c_custkey // 2
UNION ALL SELECT 'customer', 'place', 'C' || c_custkey, 'P' || (c_custkey % 7), 'place', 'unknown' FROM customer WHERE c_custkey % 5 = 0
UNION ALL SELECT 'nation', 'region', 'N' || n_nationkey, 'R' || n_regionkey, 'region', 'unknown' FROM nation WHERE n_nationkey < 20)"""


@query(f"WITH {_EDGES_SQL} SELECT * FROM e")
def edges_of_sheets(spark: SparkSession, d: str) -> DataFrame:
    """Declared references of a sheet database, hidden sheets included."""
    return sheets.sheet_edges(*_sheets(spark, d)).select("from_kind", "to_kind", "from_id", "to_id", "column", F.coalesce(F.col("valid").cast("string"), F.lit("unknown")).alias("valid"))


@query(f"""WITH {_EDGES_SQL}, p AS (SELECT from_kind, to_kind, count(*) AS edges, count(DISTINCT from_id) AS from_ids, count(DISTINCT to_id) AS to_ids, count(*) FILTER (WHERE valid = 'true') AS valid_true FROM e GROUP BY ALL)
SELECT *, CASE WHEN from_ids = edges AND to_ids = edges THEN '1:1' WHEN from_ids = edges THEN 'many:1' WHEN to_ids = edges THEN '1:many' ELSE 'many:many' END AS cardinality FROM p""")
def pairs_of_sheets(spark: SparkSession, d: str) -> DataFrame:
    return relations.pair_catalog(sheets.sheet_edges(*_sheets(spark, d))).select("from_kind", "to_kind", "edges", "from_ids", "to_ids", "valid_true", "cardinality")


@query("""SELECT 'customer' AS sheet, 'C' || c_custkey AS id FROM customer UNION ALL SELECT 'nation', 'N' || n_nationkey FROM nation WHERE n_nationkey < 20
UNION ALL SELECT 'note', 'note-' || lpad(CAST(row_number() OVER (ORDER BY item_id) - 1 AS VARCHAR), 4, '0') FROM benchmark""")
def ids_of_sheets(spark: SparkSession, d: str) -> DataFrame:
    return sheets.identified(*_sheets(spark, d)).select("sheet", "id")


@query("""SELECT 'customer' AS schema, 'seg' AS "column", count(*) AS cells FROM customer WHERE c_custkey % 3 = 0""")
def undeclared_in_sheets(spark: SparkSession, d: str) -> DataFrame:
    return sheets.undeclared(sheets.declared_cells(*_sheets(spark, d)))


@query("""SELECT 'C' || c_custkey AS id, '{"bridge":"export_cdb","sheet":"customer","column":"name","row":"C' || c_custkey || '"}' AS "textKey" FROM customer""")
def text_keys_of_sheets(spark: SparkSession, d: str) -> DataFrame:
    return sheets.text_keys(sheets.declared_cells(*_sheets(spark, d))).select("id", "textKey")


@query("""WITH c AS (SELECT count(*) AS n, count(*) FILTER (WHERE c_custkey % 5 = 0) AS p FROM customer) SELECT 'customer' AS schema, 'id' AS "column", 'plain' AS class, n AS cells FROM c UNION ALL SELECT 'customer', 'name', 'plain', n FROM c
UNION ALL SELECT 'customer', 'parts', 'compound_filled', n + p FROM c UNION ALL SELECT 'nation', 'id', 'plain', count(*) FROM nation WHERE n_nationkey < 20 UNION ALL SELECT 'note', 'text', 'plain', count(text) FROM benchmark UNION ALL SELECT 'place', 'id', 'schema_empty', 0""")
def unadmitted_in_sheets(spark: SparkSession, d: str) -> DataFrame:
    dictionary, lines = _sheets(spark, d)
    admitted = dictionary.where("type_str LIKE '6:%'").select(F.col("sheet").alias("schema"), F.col("name").alias("column"))
    return sheets.unadmitted(dictionary, sheets.declared_cells(dictionary, lines), admitted).select("schema", "column", "class", "cells")


@query("""SELECT o_orderkey, 'a[0].b' AS path, 'a[].b' AS norm_path, CAST(o_custkey AS VARCHAR) AS value FROM orders UNION ALL SELECT o_orderkey, 'a[1].b', 'a[].b', CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderkey % 2 = 0
UNION ALL SELECT o_orderkey, 'c.d', 'c.d', o_orderstatus FROM orders UNION ALL SELECT o_orderkey, 'e', 'e', CASE WHEN o_orderkey % 3 = 0 THEN 'true' ELSE 'false' END FROM orders""")
def walk_of_orders(spark: SparkSession, d: str) -> DataFrame:
    """Scalars of nested rows with their paths; absent and null are alike."""
    k = F.col("o_orderkey")
    b = lambda v: F.struct(v.cast("bigint").alias("b"))
    row = F.struct(F.array(b(F.col("o_custkey")), b(F.when(k % 2 == 0, k))).alias("a"), F.struct(F.col("o_orderstatus").alias("d")).alias("c"), (k % 3 == 0).alias("e"), F.lit(None).cast("string").alias("f"))
    return walk.walk_json(table(spark, d, "orders").select("o_orderkey", F.to_json(row).alias("row")), ["o_orderkey"], "row", 4).select("o_orderkey", "path", "norm_path", "value")


@query("""SELECT 'l' || (c_custkey % 3) AS locale, 'item' AS sheet, 'I' || c_custkey AS "row", 'name[0]' AS path, c_name || ' <br/>' AS value FROM customer
UNION ALL SELECT 'l' || (c_custkey % 3), 'item', 'I' || c_custkey, 'list[0].line' || (c_custkey % 4) || '[0].col[0]', CAST(c_nationkey AS VARCHAR) FROM customer UNION ALL SELECT 'l' || (c_custkey % 3), 'item', 'I' || c_custkey, 'name[1]', '' FROM customer""")
def leaves_of_exports(spark: SparkSession, d: str) -> DataFrame:
    """Leaves of an export for each customer, repeated tags counted."""
    k = F.col("c_custkey")
    xml = F.format_string('<cdb version="1"><sheet name="item"><I%d><name>%s <br/></name><list><line%d><col>%d</col></line%d></list><name/></I%d></sheet></cdb>', k, "c_name", k % 4, "c_nationkey", k % 4, k)
    return markup.read_export(dealt(table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")).select(_id("l", k % 3).alias("locale"), xml.alias("value")))


@query("""SELECT 'en' AS locale, 'menu/m' || c_custkey || '/open' AS key, 'Open <b>' || c_mktsegment || '</b>' AS value FROM customer UNION ALL SELECT 'en', 'menu/q' || c_custkey, '' FROM customer""")
def texts_of_exports(spark: SparkSession, d: str) -> DataFrame:
    xml = F.format_string('<r><g id="menu"><g id="m%d"><t id="open">Open <b>%s</b></t></g><t id="q%d"/></g></r>', "c_custkey", "c_mktsegment", "c_custkey")
    return markup.read_texts(dealt(table(spark, d, "customer").select("c_custkey", "c_mktsegment")).select(F.lit("en").alias("locale"), xml.alias("value")))


@query("""SELECT 'C' || c_custkey AS id, l AS locale, CASE WHEN c_custkey % 4 = CASE l WHEN 'en' THEN 0 ELSE 1 END THEN 'missing' WHEN c_custkey % 5 = 0 THEN 'empty' ELSE 'ok' END AS state FROM customer, (SELECT unnest(['en', 'fr']) AS l)""")
def states_of_text_keys(spark: SparkSession, d: str) -> DataFrame:
    """Every key in every locale: there, empty or missing."""
    k = F.col("c_custkey")
    c = table(spark, d, "customer").select(_id("C", k).alias("id"), k)
    refs = c.select(F.lit("customer").alias("kind"), "id", F.lit("customer").alias("sheet"), F.col("id").alias("row"), F.lit("name[0]").alias("path"), F.lit("name").alias("template"))
    there = F.array_compact(F.array(F.when(k % 4 != 0, "en"), F.when(k % 4 != 1, "fr")))
    leaves = c.select(F.explode(there).alias("locale"), F.lit("customer").alias("sheet"), F.col("id").alias("row"), F.lit("name[0]").alias("path"), F.when(k % 5 == 0, "").otherwise("x").alias("value"))
    return locale.resolve_text_keys(refs, leaves, ["en", "fr"]).select("id", "locale", "state")


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'DXT5' WHEN 1 THEN 'RGBA8' ELSE 'uncompressed24bit' END AS format, CAST(p_size * 4 AS BIGINT) AS width, p_partkey % 512 + 1 AS height, CASE WHEN p_partkey % 2 = 0 THEN p_partkey % 10 + 1 ELSE 1 END AS mips FROM part WHERE p_partkey % 7 <> 0""")
def headers_of_parts(spark: SparkSession, d: str) -> DataFrame:
    """Texture headers written and read back; every seventh has no magic."""
    k = F.col("p_partkey")

    def le(n: Column) -> Column:
        h = F.lpad(F.hex(n.cast("bigint")), 8, "0")
        return F.concat(*[F.substring(h, 7 - 2 * i, 2) for i in range(4)])

    zero = lambda n: F.lit("00" * n)
    kind = lambda a, b, c: F.when(k % 3 == 0, a).when(k % 3 == 1, b).otherwise(c)
    parts = [F.when(k % 7 == 0, "41424344").otherwise("44445320"), le(F.lit(124)), le(F.when(k % 2 == 0, 0x20000).otherwise(0)), le(k % 512 + 1), le(F.col("p_size") * 4), zero(8), le(k % 10 + 1), zero(44), le(F.lit(32)), le(kind(4, 0x41, 0x40)), F.when(k % 3 == 0, b"DXT5".hex()).otherwise("00000000"), le(kind(0, 32, 24)), zero(36)]
    heads = table(spark, d, "part").select("p_partkey", F.unhex(F.concat(*parts)).alias("content"))
    return heads.select("p_partkey", binary.dds_header(F.col("content")).alias("h")).where("h IS NOT NULL").select("p_partkey", "h.*")


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'ref<' || p_type || '>' WHEN 1 THEN CASE WHEN length(p_brand || ',' || p_type) > 12 THEN 'enum[' || p_brand || '…]' ELSE 'enum[' || p_brand || ',' || p_type || ']' END WHEN 2 THEN 'id' ELSE 'unknown(' || (40 + p_size) || ')' END AS label FROM part""")
def labels_of_types(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey") % 4
    code = F.when(k == 0, F.concat(F.lit("6:"), "p_type")).when(k == 1, F.concat(F.lit("5:"), "p_brand", F.lit(","), "p_type")).when(k == 2, "0").otherwise((F.col("p_size") + 40).cast("string"))
    return table(spark, d, "part").select("p_partkey", type_label(code).alias("label"))


@query("""SELECT p_partkey, 'a[' || (p_partkey % 3) || '].list[' || p_size || ']' AS path, 'a[].list[]' AS template, 'up_/' || replace(replace(p_brand, '#', '_'), ' ', '_') || '/b_' || p_size || '.txt' AS safe, p_partkey % 2 = 0 AS media FROM part""")
def paths_of_parts(spark: SparkSession, d: str) -> DataFrame:
    """Rendered paths, harmless file names, and media told by the frame header."""
    step = lambda tag, idx: F.struct(tag.alias("tag"), idx.cast("int").alias("idx"))
    c = T.collapse_lines(F.array(step(F.lit("a"), F.col("p_partkey") % 3), step(F.lit("list"), F.lit(0)), step(F.concat(F.lit("line"), F.col("p_size").cast("string")), F.lit(0))))
    raw = F.concat(F.lit("/up*\\"), "p_brand", F.lit("/b?"), F.col("p_size").cast("string"), F.lit(".txt"))
    head = F.unhex(F.when(F.col("p_partkey") % 2 == 0, "FFFB9000").otherwise("FFFE0000"))
    return table(spark, d, "part").select("p_partkey", T.render_path(c).alias("path"), T.render_template(c).alias("template"), T.safe_path(raw).alias("safe"), is_media(head).alias("media"))


@query("""WITH t AS (SELECT DISTINCT 'l' || (c_custkey % 3) AS layer, CAST(floor(c_acctbal / 500) AS BIGINT) AS x, CAST(c_nationkey AS BIGINT) AS y FROM customer)
SELECT layer, min(x) AS x0, min(y) AS y0, (max(x) - min(x) + 1) * 2 AS width, (max(y) - min(y) + 1) * 2 AS height, (max(x) - min(x) + 1) * (max(y) - min(y) + 1) - count(*) AS holes FROM t GROUP BY layer""")
def frames_of_layers(spark: SparkSession, d: str) -> DataFrame:
    tiles = table(spark, d, "customer").select(_id("l", F.col("c_custkey") % 3).alias("layer"), spatial.floor_cell(F.col("c_acctbal"), 500).alias("x"), F.col("c_nationkey").cast("bigint").alias("y"))
    return spatial.mosaic(tiles, 2)


@query("""WITH p AS (SELECT vec_id, unnest(embedding) AS v FROM embeddings), s AS (SELECT vec_id, 1.0 AS finite, CAST(min(v) AS DOUBLE) AS low, CAST(max(v) AS DOUBLE) AS high, avg(CASE WHEN abs(CAST(v AS DOUBLE) - 0.0) < 0.05 THEN 1.0 ELSE 0.0 END) AS plateau FROM p GROUP BY vec_id)
SELECT vec_id, finite, round(low, 5) AS low, round(high, 5) AS high, round(plateau, 6) AS plateau, CASE WHEN plateau > 0.99 THEN 'flat' ELSE 'terrain' END AS verdict FROM s""")
def grids_of_embeddings(spark: SparkSession, d: str) -> DataFrame:
    px = table(spark, d, "embeddings").select("vec_id", F.explode("embedding").alias("v")).select("vec_id", F.col("v").cast("double").alias("value"))
    g = binary.grid_stats(px, ["vec_id"], 0.0, 0.05)
    return g.select("vec_id", "finite", F.round("low", 5).alias("low"), F.round("high", 5).alias("high"), F.round("plateau", 6).alias("plateau"), "verdict")


@query("""WITH RECURSIVE t AS (SELECT p_partkey AS child, CASE WHEN p_partkey > 1 THEN p_partkey // 3 END AS parent FROM part), chain(child, ancestor, depth) AS (SELECT child, child, 0 FROM t UNION ALL SELECT c.child, t.parent, c.depth + 1 FROM chain c JOIN t ON t.child = c.ancestor WHERE t.parent IS NOT NULL),
e AS (SELECT c.child, c.ancestor, c.depth, p_brand AS name FROM chain c JOIN part ON p_partkey = c.ancestor), n AS (SELECT child, name, arg_min(ancestor, depth) AS owner, max(depth) AS first FROM e GROUP BY ALL)
SELECT child, name, owner, CAST(row_number() OVER (PARTITION BY child ORDER BY first DESC) - 1 AS INT) AS slot FROM n""")
def members_of_parts(spark: SparkSession, d: str) -> DataFrame:
    """Each part's brand as a member that its descendants inherit or declare again."""
    p = table(spark, d, "part").select("p_partkey", F.when(F.col("p_partkey") > 1, F.expr("p_partkey DIV 3")).alias("up"), F.col("p_brand").alias("name"), F.lit(0).alias("ord"))
    return graph.flattened_members(graph.ancestors(p, "p_partkey", "up"), p, "p_partkey", "name", "ord").select("child", "name", "owner", F.col("slot").cast("int").alias("slot"))


@query("""WITH c AS (SELECT count(*) AS n, count(*) FILTER (WHERE c_custkey % 5 = 0) AS p FROM customer), b AS (SELECT count(*) AS n FROM nation WHERE n_nationkey < 20),
u AS (SELECT 'nation' AS name, count(*) AS n FROM customer WHERE c_nationkey >= 20 HAVING count(*) > 0 UNION ALL SELECT 'customer', count(*) FROM customer x WHERE NOT EXISTS (SELECT 1 FROM customer y WHERE y.c_custkey = x.c_custkey // 2) HAVING count(*) > 0)
SELECT 'negated-polarity' AS class, CAST(1 AS BIGINT) AS entries, p AS cells, 'customer@parts.place' AS detail FROM c UNION ALL SELECT 'compound', 1, n + p, 'customer.parts' FROM c UNION ALL SELECT 'schema-empty', 1, 0, 'place.id'
UNION ALL SELECT 'unresolved', count(*), CAST(coalesce(sum(n), 0) AS BIGINT), coalesce(string_agg(name, ',' ORDER BY name), '') FROM u
UNION ALL SELECT 'no-target', 2, p + b.n, 'place,region' FROM c, b UNION ALL SELECT 'anonymous', 1, (SELECT count(*) FROM benchmark), 'note' UNION ALL SELECT 'residual-names', 0, 0, ''""")
def deferred_ledger(spark: SparkSession, d: str) -> DataFrame:
    """What a sheet database's catalog does not say, in its classes; one typed column says what must not be."""
    dictionary, lines = _sheets(spark, d)
    negated = spark.createDataFrame([("customer@parts", "place")], "schema string, column string")
    admitted = dictionary.where("type_str LIKE '6:%'").select(F.col("sheet").alias("schema"), F.col("name").alias("column")).join(negated, ["schema", "column"], "left_anti")
    columns = sheets.unadmitted(dictionary, sheets.declared_cells(dictionary, lines), admitted, negated)
    edges = sheets.sheet_edges(dictionary, lines).select("to_kind", "valid")
    rows = lines.select(F.col("sheet").alias("kind"), F.get_json_object("row", "$.id").alias("id"))
    return relations.deferred_ledger(columns, edges, rows, spark.createDataFrame([], "target string, hits bigint"))
