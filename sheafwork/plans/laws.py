"""Contracts, availability laws, escapes, lookups and shifts over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafwork.functions import decode
from sheafwork.functions import text as T
from sheafwork.operators import contracts, locale, spatial, walk
from sheafwork.plans.grids import _CELLS_SQL, _cells
from sheafwork.plans.registry import query
from sheafwork.session import table
from sheafwork.sources import records, writers


@query(r"""SELECT item_id, replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#39;') AS escaped, text AS unescaped, text AS stripped, replace(text, chr(10), '\n') AS pooled, text || chr(9) AS unpooled FROM benchmark""")
def escapes(spark: SparkSession, d: str) -> DataFrame:
    """Texts escaped, back again, without tags around them, and as pooled strings."""
    t = F.col("text")
    tabbed = F.concat(t, F.lit("\t"))
    return table(spark, d, "benchmark").select(
        "item_id", T.escape_html(t).alias("escaped"), T.unescape_entities(T.escape_html(t)).alias("unescaped"), T.strip_tags(F.concat(F.lit("<b>"), t, F.lit("</b>"))).alias("stripped"),
        T.escape_pooled(t).alias("pooled"), T.unescape_pooled(T.escape_pooled(tabbed)).alias("unpooled"),
    )


@query("""WITH r AS (SELECT s_nationkey AS y, CAST(floor(s_acctbal / 500) AS BIGINT) AS x, count(*) AS v FROM supplier GROUP BY ALL)
SELECT c_custkey, coalesce(v, -1) AS value FROM customer LEFT JOIN r ON y = c_nationkey AND x = CAST(floor(c_acctbal / 500) AS BIGINT)""")
def raster_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers in each customer's cell, -1 outside the raster."""
    band = lambda c: spatial.floor_cell(F.col(c), 500)
    raster = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("row"), band("s_acctbal").alias("col")).agg(F.count("*").alias("value"))
    return spatial.lookup_pixels(table(spark, d, "customer"), F.col("c_nationkey"), band("c_acctbal"), raster).select("c_custkey", "value")


@query("""SELECT c_custkey, 'gains.nation[0].inf' AS path, 'nation' AS kind_key, CAST(c_nationkey AS VARCHAR) AS value FROM customer
UNION ALL SELECT c_custkey, 'gains.segment[0].inf', 'segment', c_mktsegment FROM customer""")
def key_typed_references(spark: SparkSession, d: str) -> DataFrame:
    """References typed by the key above them; counters beside them and bookkeeping are left out."""
    inf = lambda c: F.array(F.struct(F.col(c).alias("inf")))
    row = F.struct(F.struct(inf("c_nationkey").alias("nation"), inf("c_mktsegment").alias("segment")).alias("gains"), F.struct(F.col("c_custkey").alias("n")).alias("counters"), F.lit("x").alias("_file"))
    cells = walk.drop_bookkeeping(walk.walk_json(table(spark, d, "customer").select("c_custkey", F.to_json(row).alias("row")), ["c_custkey"], "row", 4))
    return walk.parent_key(walk.below_path(cells, "gains"), "gains").select("c_custkey", "path", "kind_key", "value")


@query("""SELECT source AS id, string_agg(DISTINCT lang, ',' ORDER BY lang) AS available FROM documents WHERE n_chars > 2500 AND source <> 'src1' GROUP BY source HAVING count(DISTINCT lang) < 4""")
def trimodal_law(spark: SparkSession, d: str) -> DataFrame:
    """Sources whose long texts are neither in no, all nor excepted languages."""
    av = table(spark, d, "documents").where("n_chars > 2500").groupBy(F.lit("source").alias("kind"), F.col("source").alias("id")).agg(F.sort_array(F.collect_set("lang")).alias("available"))
    off = locale.trimodal_breaks(av, ["de", "en", "es", "fr"], spark.createDataFrame([("source", "src1")], "kind string, id string"))
    return off.select("id", F.array_join("available", ",").alias("available"))


@query("""SELECT p_partkey, 'p_size' AS field, 'high' AS rule FROM part WHERE p_size > 40 UNION ALL SELECT p_partkey, 'p_size', 'low' FROM part WHERE p_size < 5
UNION ALL SELECT p_partkey, 'p_brand', 'choice' FROM part WHERE p_brand NOT IN ('Brand#11', 'Brand#12', 'Brand#13') UNION ALL SELECT p_partkey, 'p_type', 'pattern' FROM part WHERE NOT regexp_matches(p_type, '^[A-M]')""")
def contract_breaks(spark: SparkSession, d: str) -> DataFrame:
    """Parts against a contract that many of them break."""
    fields = [contracts.Field("p_size", "int", low=5, high=40), contracts.Field("p_brand", "string", choices=["Brand#11", "Brand#12", "Brand#13"]), contracts.Field("p_type", "string", pattern="^[A-M]")]
    return contracts.row_breaks(table(spark, d, "part"), ["p_partkey"], fields)


@query("""WITH n AS (SELECT c_mktsegment AS kind, count(*) AS n FROM customer WHERE c_mktsegment <> 'MACHINERY' GROUP BY 1), h AS (SELECT c_mktsegment AS kind, CASE WHEN c_mktsegment = 'BUILDING' THEN '6' ELSE '7' END AS b, count(*) + CASE WHEN c_mktsegment = 'FURNITURE' THEN 1 ELSE 0 END AS c FROM customer WHERE c_mktsegment <> 'HOUSEHOLD' GROUP BY 1)
SELECT kind, 'no_header' AS rule FROM n WHERE kind NOT IN (SELECT kind FROM h) UNION ALL SELECT kind, 'build' FROM h WHERE b <> '7' UNION ALL SELECT h.kind, 'count' FROM h LEFT JOIN n ON n.kind = h.kind WHERE coalesce(n, 0) <> c""")
def header_contract(spark: SparkSession, d: str) -> DataFrame:
    """Headers against rows, each rule broken once."""
    rows = table(spark, d, "customer").select(F.col("c_mktsegment").alias("kind"))
    k = F.col("kind")
    meta = rows.where(k != "HOUSEHOLD").groupBy("kind").agg(F.count("*").alias("n")).select("kind", F.when(k == "BUILDING", "6").otherwise("7").alias("build_id"), (F.col("n") + (k == "FURNITURE").cast("int")).alias("row_count"))
    return contracts.header_breaks(meta, rows.where(k != "MACHINERY"), "7")


@query("""SELECT 'modeled · E=' || count(*) || ' · card=many:1' AS cell, 'modeled' AS status, count(*) AS edges, 'many:1' AS cardinality, o_orderpriority FROM orders GROUP BY o_orderpriority""")
def direction_cells(spark: SparkSession, d: str) -> DataFrame:
    """Catalog cells rendered, and what they parse back to."""
    n = table(spark, d, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    cells = n.select("o_orderpriority", T.direction_cell(F.lit("modeled"), F.col("n"), F.lit("many:1")).alias("cell"))
    return cells.select("o_orderpriority", "cell", T.parse_direction_cell(F.col("cell")).alias("p")).select("o_orderpriority", "cell", "p.*")


@query(f"""WITH {_CELLS_SQL}, m AS (SELECT x, y FROM cells WHERE n > 1), s AS (SELECT unnest(range(-2, 3)) AS d)
SELECT CAST(sx.d AS INT) AS dx, CAST(sy.d AS INT) AS dy, count(*) AS n, round(avg(c.v), 4) AS mean FROM m, s sx, s sy, cells c WHERE c.x = m.x + sx.d AND c.y = m.y + sy.d GROUP BY ALL""")
def registration_curve(spark: SparkSession, d: str) -> DataFrame:
    """Mean balance below the mask of shared cells, moved about."""
    c = _cells(spark, d)
    at = c.select(F.col("y").alias("row"), F.col("x").alias("col"), F.col("v").alias("value"), "n")
    return spatial.registration_curve(at, at.where("n > 1").select("row", "col"), 2).select("dx", "dy", "n", F.round("mean", 4).alias("mean"))


@query(f"""WITH {_CELLS_SQL}, l AS (SELECT x, y FROM cells WHERE v > 2000), s AS (SELECT * FROM (VALUES (1, 0), (-1, 0), (0, 1), (0, -1)) t(dx, dy))
SELECT s.dx, s.dy, count(*) FILTER (WHERE b.x IS NULL) AS coast, round(avg(CASE WHEN b.x IS NULL THEN 1.0 ELSE 0.0 END), 6) AS share FROM l CROSS JOIN s LEFT JOIN l b ON b.x = l.x + s.dx AND b.y = l.y + s.dy GROUP BY ALL""")
def coast_sides(spark: SparkSession, d: str) -> DataFrame:
    """Cells of high balance whose neighbour on a side is low or missing."""
    sides = spatial.coast_sides(_cells(spark, d).withColumn("land", F.col("v") > 2000), "x", "y", "land")
    return sides.select("dx", "dy", "coast", F.round("share", 6).alias("share"))


@query("""SELECT c_custkey, abs(c_acctbal) * c_nationkey AS area, CASE WHEN c_acctbal > 0 AND c_nationkey > 4 THEN 'CONFIRMED' ELSE 'REFUSED:' || CASE WHEN c_acctbal > 0 THEN 'nation' WHEN c_nationkey > 4 THEN 'balance' ELSE 'balance,nation' END END AS verdict FROM customer""")
def transform_gates(spark: SparkSession, d: str) -> DataFrame:
    """Area of a box, and which of two gates refuse it."""
    at = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    x, y = F.col("c_acctbal"), F.col("c_nationkey")
    c = table(spark, d, "customer").withColumn("area", spatial.polygon_area_box(F.array(at(F.lit(0), F.lit(0)), at(x, F.lit(0)), at(x, y))))
    return spatial.transform_verdict(c, balance=x > 0, nation=y > 4).select("c_custkey", "area", "verdict")


@query("""SELECT n_nationkey, CASE WHEN n_regionkey <> 2 THEN 'nation' || n_nationkey END AS from_kind, CASE WHEN n_regionkey <> 2 THEN 'region' || n_regionkey END AS to_kind, n_regionkey = 1 AS media, '{"name":"' || n_name || '","key":' || n_nationkey || '}' AS line FROM nation""")
def file_names(spark: SparkSession, d: str) -> DataFrame:
    """Pair files by their names, media by their endings, and rows as canonical JSON."""
    n = table(spark, d, "nation")
    name = F.format_string("nation%d__region%d.%s", "n_nationkey", "n_regionkey", F.when(F.col("n_regionkey") == 2, "json").otherwise("jsonl"))
    ending = F.when(F.col("n_regionkey") == 1, ".OGG").otherwise(".txt")
    line = writers.canonical_json(n.withColumnsRenamed({"n_name": "name", "n_nationkey": "key"}), ["name", "key"]).select("value", F.get_json_object("value", "$.key").cast("int").alias("_key"))
    names = n.select("n_nationkey", records.pair_of_file(name).alias("p"), decode.media_path(F.concat("n_name", ending)).alias("media")).select("n_nationkey", "p.*", "media")
    return names.join(line, F.col("n_nationkey") == F.col("_key")).select("n_nationkey", "from_kind", "to_kind", "media", F.col("value").alias("line"))
