"""Ordinals, samples, prefix sums and top-k over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheafwork.operators import ordinals as O
from sheafwork.plans.registry import query
from sheafwork.session import table


@query("SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS variant FROM events")
def variant_ordinal(spark: SparkSession, d: str) -> DataFrame:
    return O.variant_ordinals(table(spark, d, "events").select("event_id", "user_id", "ts"), ["user_id"], ["ts", "event_id"]).drop("ts")


@query("SELECT n_nationkey, 'nation-' || lpad(CAST(row_number() OVER (ORDER BY n_name) - 1 AS VARCHAR), 4, '0') AS id FROM nation")
def synthetic_ids(spark: SparkSession, d: str) -> DataFrame:
    return O.synthetic_ids(table(spark, d, "nation").select("n_nationkey", "n_name"), "nation", ["n_name"]).drop("n_name")


@query("SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) - 1 AS idx FROM conversations")
def occurrence_index(spark: SparkSession, d: str) -> DataFrame:
    return O.occurrence_index(table(spark, d, "conversations").select("conv_id", "turn", "role"), ["conv_id", "role"], ["turn"])


@query("SELECT o_custkey, o_orderkey, times FROM orders JOIN (SELECT o_custkey, count(*) AS times FROM orders GROUP BY 1 HAVING count(*) > 1) USING (o_custkey)")
def repeated_ids(spark: SparkSession, d: str) -> DataFrame:
    return O.repeated_ids(table(spark, d, "orders").select("o_custkey", "o_orderkey"), ["o_custkey"])


@query("SELECT p_type, p_partkey, p_retailprice, row_number() OVER (PARTITION BY p_type ORDER BY p_retailprice DESC, p_partkey) AS rank FROM part QUALIFY rank <= 5")
def top_k_per_group(spark: SparkSession, d: str) -> DataFrame:
    return O.top_k(table(spark, d, "part").select("p_type", "p_partkey", "p_retailprice"), ["p_type"], [F.desc("p_retailprice"), "p_partkey"], 5)


@query("SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 5")
def largest_entries(spark: SparkSession, d: str) -> DataFrame:
    """A top-5 report."""
    return table(spark, d, "documents").select("doc_id", "n_chars").orderBy(F.desc("n_chars"), "doc_id").limit(5)


@query("(SELECT 'low' AS side, l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice, l_orderkey, l_linenumber LIMIT 10) UNION ALL (SELECT 'high', l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 10)")
def worst_both_ways(spark: SparkSession, d: str) -> DataFrame:
    """The ten lowest and the ten highest."""
    t = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    low = t.orderBy("l_extendedprice", "l_orderkey", "l_linenumber").limit(10).select(F.lit("low").alias("side"), "*")
    return low.unionByName(t.orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber").limit(10).select(F.lit("high").alias("side"), "*"))


@query("SELECT p_partkey, p_brand FROM (SELECT p_partkey, p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS n FROM part) WHERE n % 7 = 0")
def systematic_sample(spark: SparkSession, d: str) -> DataFrame:
    """Every seventh part of each brand (a sampling operator)."""
    return O.every_nth(table(spark, d, "part").select("p_partkey", "p_brand"), ["p_brand"], ["p_partkey"], 7)


@query("SELECT o_orderkey FROM orders ORDER BY md5('7:' || o_orderkey), o_orderkey LIMIT 10")
def seeded_sample(spark: SparkSession, d: str) -> DataFrame:
    """Ten orders by a seeded hash (a sampling operator)."""
    return O.seeded_sample(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", 10, seed=7)


@query("""WITH r AS (SELECT doc_id, source, md5('7:' || doc_id) AS h FROM documents), k AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY h, doc_id) AS n FROM r)
SELECT doc_id, source FROM k ORDER BY CASE WHEN n > 1 THEN 1 ELSE 0 END, h, doc_id LIMIT 36""")
def stratified_sample(spark: SparkSession, d: str) -> DataFrame:
    """One document of each source at least, 36 in all (a sampling operator)."""
    return O.stratified_sample(table(spark, d, "documents").select("doc_id", "source"), ["source"], "doc_id", 1, 36, seed=7)


@query("""WITH r AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 2 END AS half, md5('5:' || o_orderkey) AS h FROM orders), k AS (SELECT *, row_number() OVER (PARTITION BY half ORDER BY h, o_orderkey) AS n FROM r)
SELECT o_orderkey, half FROM k ORDER BY CASE WHEN n > 15 THEN 1 ELSE 0 END, n, half LIMIT 30""")
def audit_halves(spark: SparkSession, d: str) -> DataFrame:
    """Thirty orders, half of them partly shipped, by a seeded hash (a sampling operator)."""
    return O.half_and_half(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", F.col("o_orderstatus") == "P", 30, seed=5).select("o_orderkey", "half")


_GRID_SQL = """days AS (SELECT DISTINCT date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS r FROM events), types AS (SELECT DISTINCT event_type AS c FROM events),
g AS (SELECT r, c, count(e.event_id) AS n FROM days CROSS JOIN types LEFT JOIN events e ON date_diff('day', DATE '1970-01-01', CAST(e.ts AS DATE)) = r AND e.event_type = c GROUP BY r, c)"""


def _grid(spark: SparkSession, d: str) -> DataFrame:
    """A dense grid of counts, day by event type."""
    e = table(spark, d, "events").select(F.datediff(F.to_date("ts"), F.lit("1970-01-01").cast("date")).cast("bigint").alias("r"), F.col("event_type").alias("c"))
    dense = e.groupBy("r").agg(F.lit(1).alias("_")).drop("_").join(F.broadcast(e.select("c").distinct()))  # types are few
    return dense.join(e.groupBy("r", "c").agg(F.count("*").alias("n")), ["r", "c"], "left").select("r", "c", F.coalesce("n", F.lit(0)).alias("n"))


@query(f"""WITH {_GRID_SQL}, a AS (SELECT r, c, n, sum(n) OVER (PARTITION BY r ORDER BY c) AS al FROM g)
SELECT r, c, n, CAST(sum(al) OVER (PARTITION BY c ORDER BY r ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total FROM a""")
def prefix_sum_grid(spark: SparkSession, d: str) -> DataFrame:
    """Summed-area table of the grid."""
    return O.prefix_sums(_grid(spark, d), "r", "c", "n")


@query(f"""WITH {_GRID_SQL}, k AS (SELECT r, n, dense_rank() OVER (ORDER BY c) AS c FROM g), b AS (SELECT min(r) AS r0, max(r) AS r1 FROM k),
rects AS (SELECT 'all' AS rect, r0, 1 AS c0, r1, 99 AS c1 FROM b UNION ALL SELECT 'first_week', r0, 1, r0 + 6, 2 FROM b UNION ALL SELECT 'inner', r0 + 3, 2, r1 - 3, 3 FROM b)
SELECT rect, CAST(sum(n) AS BIGINT) AS "sum" FROM rects JOIN k ON k.r BETWEEN rects.r0 AND rects.r1 AND k.c BETWEEN rects.c0 AND rects.c1 GROUP BY rect""")
def prefix_sum_rect(spark: SparkSession, d: str) -> DataFrame:
    """Sums of rectangles, four lookups each."""
    g = _grid(spark, d)
    types = g.select("c").distinct().withColumn("k", F.row_number().over(Window.orderBy("c")))  # types are few
    g = g.join(F.broadcast(types), "c").select("r", F.col("k").alias("c"), "n")
    sums = O.prefix_sums(g, "r", "c", "n")
    box = g.agg(F.min("r").alias("r0"), F.max("r").alias("r1"), F.max("c").alias("cm"))
    rect = lambda name, r0, c0, r1, c1: F.struct(F.lit(name).alias("rect"), r0.alias("r0"), c0.cast("int").alias("c0"), r1.alias("r1"), c1.cast("int").alias("c1"))
    r0, r1, cm = F.col("r0"), F.col("r1"), F.col("cm")
    rects = box.select(F.explode(F.array(rect("all", r0, F.lit(1), r1, cm), rect("first_week", r0, F.lit(1), F.least(r0 + 6, r1), F.least(F.lit(2), cm)), rect("inner", r0 + 3, F.lit(2), r1 - 3, F.least(F.lit(3), cm)))).alias("x")).select("x.*")
    return O.rectangle_sums(sums, rects, "r", "c")


@query("""WITH h AS (SELECT 'part' AS kind, p_partkey AS id, CASE WHEN p_size < 10 THEN 1 ELSE 2 END AS tier FROM part WHERE p_size < 20 UNION ALL SELECT 'supplier', s_suppkey, 1 FROM supplier),
t AS (SELECT kind, count(*) AS kind_total FROM h GROUP BY kind)
SELECT kind, id, tier, row_number() OVER (ORDER BY CASE kind WHEN 'supplier' THEN 1 ELSE 2 END, tier, id) AS position, kind_total FROM h JOIN t USING (kind) QUALIFY position <= 50""")
def group_budget(spark: SparkSession, d: str) -> DataFrame:
    """A page of 50 rows (the feature) shared by ordered groups, with each group's full total."""
    p = table(spark, d, "part").where("p_size < 20").select(F.lit("part").alias("kind"), F.col("p_partkey").alias("id"), F.when(F.col("p_size") < 10, 1).otherwise(2).alias("tier"))
    h = p.unionByName(table(spark, d, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"), F.lit(1).alias("tier")))
    return O.shared_budget(h, F.when(F.col("kind") == "supplier", 1).otherwise(2), ["tier", "id"], 50)
