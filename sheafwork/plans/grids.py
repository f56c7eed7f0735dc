"""Grids, points and graphs over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafwork.operators import graph as G
from sheafwork.operators import spatial as P
from sheafwork.plans.registry import query
from sheafwork.session import table

_CELLS_SQL = "cells AS (SELECT CAST(floor(c_acctbal / 500) AS BIGINT) AS x, CAST(c_nationkey AS BIGINT) AS y, count(*) AS n, avg(c_acctbal) AS v FROM customer GROUP BY ALL)"


def _cells(spark: SparkSession, d: str) -> DataFrame:
    """Customers by balance band and nation: a sparse grid."""
    return table(spark, d, "customer").groupBy(P.floor_cell(F.col("c_acctbal"), 500).alias("x"), F.col("c_nationkey").cast("bigint").alias("y")).agg(F.count("*").alias("n"), F.avg("c_acctbal").alias("v"))


@query(f"""WITH {_CELLS_SQL}, b AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM cells)
SELECT gx.x, gy.y FROM (SELECT unnest(range(x0, x1 + 1)) AS x FROM b) gx, (SELECT unnest(range(y0, y1 + 1)) AS y FROM b) gy WHERE NOT EXISTS (SELECT 1 FROM cells c WHERE c.x = gx.x AND c.y = gy.y)""")
def grid_holes(spark: SparkSession, d: str) -> DataFrame:
    return P.grid_holes(_cells(spark, d), "x", "y")


@query(f"""WITH {_CELLS_SQL} SELECT count(*) AS pairs, round(avg(abs(a.v - b.v)), 6) AS mean, round(max(abs(a.v - b.v)), 6) AS most, round(quantile_cont(abs(a.v - b.v), 0.95), 6) AS p95 FROM cells a JOIN cells b ON b.x = a.x + 1 AND b.y = a.y""")
def edge_delta_stats(spark: SparkSession, d: str) -> DataFrame:
    """Differences of neighbouring cells: mean, maximum, 95th percentile."""
    e = P.edge_deltas(_cells(spark, d).select("x", "y", "v"), "x", "y", "v", "v")
    return e.agg(F.count("*").alias("pairs"), F.round(F.avg("delta"), 6).alias("mean"), F.round(F.max("delta"), 6).alias("most"), F.round(F.percentile("delta", 0.95), 6).alias("p95"))


@query("""WITH p AS (SELECT vec_id AS row, unnest(embedding) AS v, unnest(range(len(embedding))) AS col FROM embeddings)
SELECT CAST(floor(row / 4) AS BIGINT) AS row, CAST(floor(col / 4) AS BIGINT) AS col, round(avg(v), 5) AS v FROM p GROUP BY 1, 2""")
def box_mean(spark: SparkSession, d: str) -> DataFrame:
    """4 x 4 means of the embeddings taken as a raster."""
    px = table(spark, d, "embeddings").select(F.col("vec_id").alias("row"), F.posexplode("embedding").alias("col", "v"))
    return P.box_means(px, "row", "col", "v", 4).withColumn("v", F.round("v", 5))


@query(f"""WITH {_CELLS_SQL}, b AS (SELECT min(x) AS x0, min(y) AS y0 FROM cells), z AS (SELECT unnest([0, 1, 2, 3]) AS z)
SELECT z, CAST(floor((x - x0) / power(2, 3 - z)) AS BIGINT) AS tx, CAST(floor((y - y0) / power(2, 3 - z)) AS BIGINT) AS ty, count(*) AS tiles FROM cells, b, z GROUP BY ALL""")
def pyramid_levels(spark: SparkSession, d: str) -> DataFrame:
    return P.pyramid(_cells(spark, d), "x", "y").groupBy("z", "tx", "ty").agg(F.count("*").alias("tiles"))


@query("""SELECT c_custkey, round(0.5 * c_acctbal - 0.25 * c_nationkey + 10, 6) AS px, round(0.1 * c_acctbal + 2 * c_nationkey - 3, 6) AS py, CAST(floor((0.5 * c_acctbal - 0.25 * c_nationkey + 10) / 256.0) AS BIGINT) AS tx,
CAST(floor((0.1 * c_acctbal + 2 * c_nationkey - 3) / 256.0) AS BIGINT) AS ty, c_acctbal BETWEEN 0 AND 5000 AND c_nationkey BETWEEN 5 AND 20 AS inside FROM customer""")
def affine_project(spark: SparkSession, d: str) -> DataFrame:
    """Projected points, their tiles, and whether they are in a box."""
    c = table(spark, d, "customer")
    px, py = P.affine(F.col("c_acctbal"), F.col("c_nationkey"), (0.5, -0.25, 10, 0.1, 2, -3))
    return c.select("c_custkey", F.round(px, 6).alias("px"), F.round(py, 6).alias("py"), P.floor_cell(px, 256).alias("tx"), P.floor_cell(py, 256).alias("ty"), P.within(F.col("c_acctbal"), F.col("c_nationkey"), (0, 5, 5000, 20)).alias("inside"))


@query("""WITH p AS (SELECT s_suppkey AS i, s_acctbal AS x, CAST(s_nationkey AS DOUBLE) * 100 AS y FROM supplier),
m AS (SELECT a.i AS id, b.i AS nearest, sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) AS distance FROM p a JOIN p b ON a.i <> b.i)
SELECT id, nearest, round(distance, 6) AS distance FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, nearest) AS rn FROM m) WHERE rn = 1""")
def nearest_neighbour(spark: SparkSession, d: str) -> DataFrame:
    pts = table(spark, d, "supplier").select("s_suppkey", F.col("s_acctbal").alias("x"), (F.col("s_nationkey") * 100.0).alias("y"))
    return P.nearest_neighbours(pts, "s_suppkey", "x", "y").withColumn("distance", F.round("distance", 6))


@query(f"""WITH {_CELLS_SQL}, l AS (SELECT x AS col, y AS row, n % 3 AS label FROM cells), s AS (SELECT unnest(range(-2, 3)) AS d),
j AS (SELECT sx.d AS dx, sy.d AS dy, a.label = b.label AS hit FROM l a, s sx, s sy, l b WHERE b.col = a.col + sx.d AND b.row = a.row + sy.d),
sc AS (SELECT dx, dy, avg(CASE WHEN hit THEN 1.0 ELSE 0.0 END) AS score FROM j GROUP BY ALL)
SELECT CAST(dx AS INT) AS dx, CAST(dy AS INT) AS dy, round(score, 6) AS score FROM sc ORDER BY score DESC, abs(dx) + abs(dy), dx, dy LIMIT 1""")
def argmax_shift(spark: SparkSession, d: str) -> DataFrame:
    """The shift at which labels agree best with themselves: none at all."""
    cells = _cells(spark, d).select(F.col("x").alias("col"), F.col("y").alias("row"), (F.col("n") % 3).alias("label"))
    return P.best_shift(P.shift_scores(cells, cells, 2)).withColumn("score", F.round("score", 6))


@query(f"""WITH RECURSIVE {_CELLS_SQL}, walk(x, y, dist) AS (
  SELECT x, y, 0 FROM cells WHERE y = 0 UNION SELECT c.x, c.y, w.dist + 1 FROM walk w JOIN cells c ON abs(c.x - w.x) + abs(c.y - w.y) = 1 WHERE w.dist < 60)
SELECT x || ',' || y AS node, CAST(min(dist) AS INT) AS distance FROM walk GROUP BY ALL""")
def grid_bfs_distance(spark: SparkSession, d: str) -> DataFrame:
    """Steps over neighbouring cells from the nearest cell of nation 0."""
    c = _cells(spark, d)
    nodes = c.select(F.concat_ws(",", "x", "y").alias("node"))
    return G.distances(nodes, G.grid_edges(c, "x", "y"), c.where("y = 0").select(F.concat_ws(",", "x", "y").alias("node")))


_TREE_SQL = "tree AS (SELECT p_partkey AS child, CASE WHEN p_partkey > 1 THEN p_partkey // 3 END AS parent FROM part)"


def _tree(spark: SparkSession, d: str) -> DataFrame:
    """Parts as a ternary tree."""
    return table(spark, d, "part").select(F.col("p_partkey").alias("child"), F.when(F.col("p_partkey") > 1, F.expr("p_partkey DIV 3")).alias("parent"), "p_retailprice", "p_size")


@query(f"""WITH RECURSIVE {_TREE_SQL}, chain(child, ancestor, depth) AS (SELECT child, child, 0 FROM tree UNION ALL SELECT c.child, t.parent, c.depth + 1 FROM chain c JOIN tree t ON t.child = c.ancestor WHERE t.parent IS NOT NULL),
v AS (SELECT c.child, c.depth, p_size AS own FROM chain c JOIN part ON p_partkey = c.ancestor WHERE p_size >= 40)
SELECT child, arg_min(own, depth) AS size, CAST(min(depth) AS INT) AS found_at FROM v GROUP BY child""")
def parent_chain(spark: SparkSession, d: str) -> DataFrame:
    """The first size of 40 or more from a part upwards."""
    t = _tree(spark, d)
    values = t.select(F.col("child").alias("id"), F.when(F.col("p_size") >= 40, F.col("p_size")).alias("size"))
    return G.first_along_chain(G.ancestors(t, "child", "parent"), values, "id", "size")


@query(f"""WITH {_TREE_SQL} SELECT coalesce(parent, -1) AS parent, string_agg(CAST(child AS VARCHAR), ',' ORDER BY CAST(child AS VARCHAR)) AS children, count(*) AS n FROM tree GROUP BY 1""")
def taxonomy_tree(spark: SparkSession, d: str) -> DataFrame:
    return G.taxonomy(_tree(spark, d), "child", "parent").withColumn("parent", F.coalesce("parent", F.lit(-1)))


@query("""WITH pts AS (SELECT c_custkey AS point, c_acctbal AS x, CAST(c_nationkey AS DOUBLE) AS y FROM customer),
rings AS (SELECT 'triangle' AS polygon, [{'x': 0.0, 'y': 0.0}, {'x': 8000.0, 'y': 0.0}, {'x': 0.0, 'y': 24.0}] AS ring UNION ALL SELECT 'band', [{'x': -500.0, 'y': 3.5}, {'x': 9000.0, 'y': 3.5}, {'x': 9000.0, 'y': 9.5}, {'x': -500.0, 'y': 9.5}]),
e AS (SELECT polygon, ring, unnest(range(1, len(ring) + 1)) AS i FROM rings),
s AS (SELECT polygon, ring[i].x AS x1, ring[i].y AS y1, ring[i % len(ring) + 1].x AS x2, ring[i % len(ring) + 1].y AS y2 FROM e)
SELECT point, polygon FROM pts, s WHERE (y1 > y) <> (y2 > y) AND x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 GROUP BY point, polygon HAVING count(*) % 2 = 1""")
def point_in_polygon(spark: SparkSession, d: str) -> DataFrame:
    pts = table(spark, d, "customer").select(F.col("c_custkey").alias("point"), F.col("c_acctbal").alias("x"), F.col("c_nationkey").cast("double").alias("y"))
    rings = [("triangle", [(0.0, 0.0), (8000.0, 0.0), (0.0, 24.0)]), ("band", [(-500.0, 3.5), (9000.0, 3.5), (9000.0, 9.5), (-500.0, 9.5)])]
    return P.points_in_polygons(pts, spark.createDataFrame(rings, "polygon string, ring array<struct<x: double, y: double>>"), 1000.0)


@query(f"""WITH {_CELLS_SQL} SELECT x - 2 AS row, y - 5 AS col, n AS value FROM cells WHERE x BETWEEN 2 AND 8 AND y BETWEEN 5 AND 14""")
def mask_rectangle(spark: SparkSession, d: str) -> DataFrame:
    raster = _cells(spark, d).select(F.col("x").alias("row"), F.col("y").alias("col"), F.col("n").alias("value"))
    return P.mask_slice(raster, 2, 9, 5, 15)


@query("""WITH a AS (SELECT c_nationkey AS k, min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer WHERE c_custkey % 2 = 0 GROUP BY 1), b AS (SELECT s_nationkey AS k, min(s_acctbal) AS lo, max(s_acctbal) AS hi FROM supplier GROUP BY 1)
SELECT a.k, round(CAST(greatest(least(a.hi, b.hi) - greatest(a.lo, b.lo), 0) AS DOUBLE), 4) AS overlap, least(a.hi, b.hi) - greatest(a.lo, b.lo) < 0 AS apart FROM a JOIN b ON a.k = b.k""")
def range_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Ranges of two planes for the same cell."""
    span = lambda t, k, v: t.groupBy(F.col(k).alias("k")).agg(F.min(v).alias("lo"), F.max(v).alias("hi"))
    a, b = span(table(spark, d, "customer").where("c_custkey % 2 = 0"), "c_nationkey", "c_acctbal"), span(table(spark, d, "supplier"), "s_nationkey", "s_acctbal")
    return P.box_overlap(a, b, ["k"], "lo", "hi").select("k", F.round(F.col("overlap").cast("double"), 4).alias("overlap"), "apart")


@query("""WITH w AS (SELECT unnest([5, 7, 25]) AS width), c AS (SELECT width, p_partkey % width AS x, p_partkey // width AS y, p_size AS v FROM part, w),
n AS (SELECT width, x - 1 AS x, y, v FROM c UNION ALL SELECT width, x, y - 1, v FROM c)
SELECT c.width, count(*) AS pairs, round(avg(abs(c.v - n.v)), 6) AS score FROM c JOIN n ON c.width = n.width AND c.x = n.x AND c.y = n.y GROUP BY 1""")
def layout_smoothness(spark: SparkSession, d: str) -> DataFrame:
    """How smooth part sizes are when laid out in rows of several widths."""
    s = P.layout_sweep(table(spark, d, "part"), "x", "y", "p_size", [5, 7, 25], "p_partkey")
    return s.select("width", "pairs", F.round("score", 6).alias("score"))
