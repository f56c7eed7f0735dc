"""Quality guarantees over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheafwork.operators import quality as Q
from sheafwork.plans.registry import query
from sheafwork.plans.relations import edges_of
from sheafwork.session import table


@query("""SELECT k, side, count(*) AS keys FROM (
  SELECT p_partkey AS k, 'missing' AS side FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_partkey IS NOT NULL)
  UNION ALL SELECT DISTINCT l_partkey, 'extra' FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)) GROUP BY ALL""")
def universe_diff(spark: SparkSession, d: str) -> DataFrame:
    """Parts that are never ordered, and ordered parts that are not there."""
    u, h = table(spark, d, "part").select(F.col("p_partkey").alias("k")), table(spark, d, "lineitem").select(F.col("l_partkey").alias("k")).where("k IS NOT NULL")
    return Q.universe_diff(u, h, ["k"]).groupBy("k", "side").agg(F.count("*").alias("keys"))


@query("""WITH a AS (SELECT l_returnflag, l_linestatus FROM lineitem), b AS (SELECT CASE WHEN l_quantity > 45 THEN 'X' ELSE l_returnflag END AS l_returnflag, l_linestatus FROM lineitem),
s AS (SELECT *, 1 AS n FROM a UNION ALL SELECT *, -1 FROM b), t AS (SELECT l_returnflag, l_linestatus, sum(n) AS n FROM s GROUP BY ALL HAVING sum(n) <> 0)
SELECT l_returnflag, l_linestatus, CASE WHEN n > 0 THEN 'missing' ELSE 'over' END AS side, CAST(abs(n) AS BIGINT) AS times FROM t""")
def multiset_diff(spark: SparkSession, d: str) -> DataFrame:
    """Two planes as multisets: what one has more often."""
    a = table(spark, d, "lineitem")
    b = a.withColumn("l_returnflag", F.when(F.col("l_quantity") > 45, "X").otherwise(F.col("l_returnflag")))
    return Q.multiset_diff(a.select("l_returnflag", "l_linestatus"), b.select("l_returnflag", "l_linestatus"))


@query("""SELECT class, count(*) AS n FROM (
  SELECT CASE WHEN b.k IS NULL THEN 'left_only' WHEN a.k IS NULL THEN 'right_only' WHEN a.p IS DISTINCT FROM b.p THEN 'p_differs' WHEN a.s IS DISTINCT FROM b.s THEN 's_differs' ELSE 'equal' END AS class
  FROM (SELECT o_orderkey AS k, o_totalprice AS p, o_orderstatus AS s FROM orders) a
  FULL JOIN (SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN -o_orderkey - 1 ELSE o_orderkey END AS k, CASE WHEN o_orderstatus = 'F' AND o_totalprice > 100000 THEN 0 ELSE o_totalprice END AS p, CASE WHEN o_totalprice < 20000 THEN NULL ELSE o_orderstatus END AS s FROM orders) b ON a.k = b.k) GROUP BY class""")
def bijection_check(spark: SparkSession, d: str) -> DataFrame:
    """A table against an altered copy: every class of difference."""
    o = table(spark, d, "orders")
    a = o.select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("p"), F.col("o_orderstatus").alias("s"))
    b = o.select(
        F.when(F.col("o_orderpriority") == "1-URGENT", -F.col("o_orderkey") - 1).otherwise(F.col("o_orderkey")).alias("k"),
        F.when((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100000), 0.0).otherwise(F.col("o_totalprice")).alias("p"), F.when(F.col("o_totalprice") >= 20000, F.col("o_orderstatus")).alias("s"),
    )
    return Q.reconcile(a, b, ["k"], ["p", "s"]).groupBy("class").agg(F.count("*").alias("n"))


@query("""SELECT sha256(text) AS hash, count(*) AS members, min(doc_id) AS first_id FROM documents GROUP BY 1 HAVING count(*) > 1""")
def duplicate_families(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("hash"))
    return Q.duplicate_families(docs, ["hash"], "doc_id")


@query("""SELECT sha256(text) AS hash, count(*) AS occurrences, min(doc_id) AS first_id FROM documents GROUP BY 1""")
def distinct_payload_dedupe(spark: SparkSession, d: str) -> DataFrame:
    return Q.distinct_payloads(table(spark, d, "documents"), F.col("text"), "doc_id")


@query("""SELECT n_orders AS n_whole, n_parts, n_orders = n_parts AS holds, breaks FROM (SELECT (SELECT count(*) FROM orders) AS n_orders,
  (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') + (SELECT count(*) FROM orders WHERE o_orderstatus = 'O') + (SELECT count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')) AS n_parts, CAST(0 AS BIGINT) AS breaks)""")
def partition_identity(spark: SparkSession, d: str) -> DataFrame:
    """Orders by status are disjoint parts of all orders."""
    o = table(spark, d, "orders")
    parts = [o.where("o_orderstatus = 'F'"), o.where("o_orderstatus = 'O'"), o.where("o_orderstatus NOT IN ('F', 'O')")]
    breaks = Q.partition_identity(parts, o, ["o_orderkey"]).agg(F.count("*").alias("breaks"))
    whole = o.agg(F.count("*").alias("n_whole"))
    covered = o.groupBy(F.when(F.col("o_orderstatus").isin("F", "O"), F.col("o_orderstatus")).otherwise("rest")).agg(F.count("*").alias("_n")).agg(F.sum("_n").alias("n_parts"))
    return whole.join(F.broadcast(covered)).join(F.broadcast(breaks)).select("n_whole", "n_parts", (F.col("n_whole") == F.col("n_parts")).alias("holds"), "breaks")


@query("""WITH e AS (SELECT source, doc_id, n_chars, sum(n_chars) OVER (PARTITION BY source ORDER BY doc_id) - n_chars + CASE WHEN lang = 'fr' THEN 1 ELSE 0 END AS pos FROM documents),
l AS (SELECT source, pos, n_chars AS size, lag(pos + n_chars) OVER (PARTITION BY source ORDER BY pos, n_chars) AS prev FROM e)
SELECT source, CAST(pos AS BIGINT) AS pos, size, CASE WHEN prev < pos THEN 'gap' ELSE 'overlap' END AS class, CAST(pos - prev AS BIGINT) AS delta FROM l WHERE prev IS NOT NULL AND prev <> pos""")
def extent_contiguity(spark: SparkSession, d: str) -> DataFrame:
    """Extents laid end to end in each source, with faults planted in French ones."""
    w = Window.partitionBy("source").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, 0)
    e = table(spark, d, "documents").select("source", (F.sum("n_chars").over(w) - F.col("n_chars") + F.when(F.col("lang") == "fr", 1).otherwise(0)).alias("pos"), F.col("n_chars").alias("size"))
    return Q.contiguity(e, "pos", "size", ["source"])


@query("""WITH p AS (SELECT regexp_replace(regexp_replace(url, '^[a-z]+://', ''), '[?#].*$', '') AS path FROM pages),
u AS (SELECT DISTINCT path FROM p),
above AS (SELECT DISTINCT array_to_string(parts[1:n], '/') AS path FROM (SELECT parts, unnest(range(1, len(parts))) AS n FROM (SELECT string_split(path, '/') AS parts FROM u)))
SELECT path, 'duplicate' AS class FROM p GROUP BY path HAVING count(*) > 1
UNION ALL SELECT path, 'case' FROM u WHERE lower(path) IN (SELECT lower(path) FROM u GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT path, 'file_and_directory' FROM u WHERE path IN (SELECT path FROM above)""")
def path_collisions(spark: SparkSession, d: str) -> DataFrame:
    """Page paths that meet when written as files."""
    p = table(spark, d, "pages").select(F.regexp_replace(F.regexp_replace("url", "^[a-z]+://", ""), "[?#].*$", "").alias("path"))
    return Q.collisions(p)


@query("""WITH cells AS (SELECT DISTINCT lang, source FROM documents), n AS (SELECT count(DISTINCT source) AS a FROM documents)
SELECT lang, count(DISTINCT source) AS layers FROM documents GROUP BY lang HAVING count(DISTINCT source) < (SELECT a FROM n)""")
def cell_layers(spark: SparkSession, d: str) -> DataFrame:
    """Languages that some sources lack."""
    return Q.cells_on_all_layers(table(spark, d, "documents").select("lang", "source"), ["lang"], "source")


@query("""WITH e AS (
  SELECT count(*) AS edges, count(*) FILTER (WHERE c_custkey IS NULL) AS dangling FROM orders LEFT JOIN customer ON c_custkey = o_custkey)
SELECT 'orders_dangling' AS id, '0' AS expected, CAST(dangling AS VARCHAR) AS actual, dangling = 0 AS pass FROM e
UNION ALL SELECT 'nations', '25', CAST(count(*) AS VARCHAR), count(*) = 25 FROM nation
UNION ALL SELECT 'regions', '5', CAST(count(*) AS VARCHAR), count(*) = 5 FROM region
UNION ALL SELECT 'documents_n_chars', CAST(count(*) AS VARCHAR), CAST(count(*) FILTER (WHERE length(text) = n_chars) AS VARCHAR), count(*) = count(*) FILTER (WHERE length(text) = n_chars) FROM documents
UNION ALL SELECT 'one_label_a_document', '0', CAST(count(*) AS VARCHAR), count(*) = 0 FROM (SELECT doc_id FROM labels GROUP BY 1 HAVING count(*) > 1)""")
def quality_report(spark: SparkSession, d: str) -> DataFrame:
    """One row a check; each fault flips just its own."""
    orders = edges_of(spark, d).where("from_kind = 'orders'")
    docs = table(spark, d, "documents")
    return Q.report(
        Q.empty_check(orders.where(~F.col("valid")), "orders_dangling"),
        Q.check(table(spark, d, "nation"), "nations", F.count("*"), F.lit("25")), Q.check(table(spark, d, "region"), "regions", F.count("*"), F.lit("5")),
        Q.check(docs, "documents_n_chars", F.count_if(F.length("text") == F.col("n_chars")), F.count("*")),
        Q.empty_check(table(spark, d, "labels").groupBy("doc_id").count().where("count > 1"), "one_label_a_document"),
    ).select("id", "expected", "actual", "pass")


@query("""WITH raw AS (SELECT 'c' AS kind, CAST(c_custkey AS VARCHAR) AS id, 'seg' AS path, c_mktsegment AS value FROM customer),
em AS (SELECT kind, CASE WHEN value = 'BUILDING' THEN id || 'x' ELSE id END AS id, path, CASE WHEN value = 'MACHINERY' THEN 'M' ELSE value END AS value FROM raw)
SELECT class, count(*) AS n FROM (SELECT CASE WHEN e.id IS NULL THEN 'missing' WHEN r.id IS NULL THEN 'invented' WHEN r.value <> e.value THEN 'altered' END AS class FROM raw r FULL JOIN em e ON r.kind = e.kind AND r.id = e.id AND r.path = e.path) WHERE class IS NOT NULL GROUP BY class""")
def cell_fidelity(spark: SparkSession, d: str) -> DataFrame:
    """Raw cells against an emitted plane with planted losses, inventions and changes."""
    raw = table(spark, d, "customer").select(F.lit("c").alias("kind"), F.col("c_custkey").cast("string").alias("id"), F.lit("seg").alias("path"), F.col("c_mktsegment").alias("value"))
    emitted = raw.withColumn("id", F.when(F.col("value") == "BUILDING", F.concat("id", F.lit("x"))).otherwise(F.col("id"))).withColumn("value", F.when(F.col("value") == "MACHINERY", "M").otherwise(F.col("value")))
    return Q.fidelity(raw, emitted).groupBy("class").agg(F.count("*").alias("n"))


@query("""WITH u AS (SELECT DISTINCT p_partkey AS k FROM part WHERE p_partkey % 10 <> 3), h AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_partkey % 7 <> 2)
SELECT k, 'missing' AS side, CAST(1 AS BIGINT) AS keys FROM u WHERE k NOT IN (SELECT k FROM h) UNION ALL SELECT k, 'extra', 1 FROM h WHERE k NOT IN (SELECT k FROM u)""")
def universe_diff_planted(spark: SparkSession, d: str) -> DataFrame:
    """universe_diff with keys taken away on both sides."""
    u, h = table(spark, d, "part").select(F.col("p_partkey").alias("k")).where("k % 10 <> 3"), table(spark, d, "lineitem").select(F.col("l_partkey").alias("k")).where("k % 7 <> 2")
    return Q.universe_diff(u, h, ["k"]).groupBy("k", "side").agg(F.count("*").alias("keys"))


@query("""WITH c AS (SELECT lang, source FROM documents WHERE NOT (lang = 'de' AND source = 'src0')) SELECT lang, count(DISTINCT source) AS layers FROM c GROUP BY lang HAVING count(DISTINCT source) < (SELECT count(DISTINCT source) FROM c)""")
def cell_layers_planted(spark: SparkSession, d: str) -> DataFrame:
    """cell_layers with one language taken from one source."""
    docs = table(spark, d, "documents").select("lang", "source").where("NOT (lang = 'de' AND source = 'src0')")
    return Q.cells_on_all_layers(docs, ["lang"], "source")
