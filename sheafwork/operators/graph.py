"""Graphs: frontier loops, chains of parents, taxonomies.

Loops run on the driver over DataFrames; each round is written with checkpoint(), so that a round's plan does not hold all rounds
before it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheafwork.session import shared_folder

#: Rows of a group that one task may sort; larger groups are numbered in ranges.
MOST_IN_GROUP = 1_000_000


def cut_lineage(df: DataFrame) -> DataFrame:
    """df by checkpoint(), in the folder that driver and executors share."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def in_ranges(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], part: str = "_part") -> DataFrame:
    """df dealt into even ranges of (by, order), each row with its range's number: a group that is too large for one task lies in
    several ranges, one after the other.  Written once, as bounds drawn anew would not be the same."""
    return cut_lineage(df.repartitionByRange(*by, *order).withColumn(part, F.spark_partition_id()))


def numbered(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], out: str) -> DataFrame:
    """0, 1, ... within each group (or over all rows, if by is empty) in two passes: places within a range of in_ranges, and how many
    rows the ranges before have.  No task sorts a whole group."""
    ranged = in_ranges(df, by, order)
    here = ranged.groupBy(*by, "_part").agg(F.count("*").alias("_n"))  # a row for each range and group
    before = F.sum("_n").over(Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = here.select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("_part").alias("_at"), F.coalesce(before, F.lit(0)).alias("_before"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by], F.col("_part") == F.col("_at"))
    place = F.row_number().over(Window.partitionBy(*by, "_part").orderBy(*order)) - 1
    return ranged.join(starts, same).withColumn(out, (F.col("_before") + place).cast("bigint")).drop("_part", "_at", "_before", *[f"_by_{c}" for c in by])


def same_group(by: Sequence[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"{prefix}{c}")) for c in by], F.lit(True))


def split_by_size(df: DataFrame, by: Sequence[str], most: int) -> tuple[DataFrame, DataFrame | None]:
    """(rows of the groups of up to ``most`` rows, rows of larger ones or None if there are none): groups are counted first."""
    if not by:
        return df.limit(0), df
    sizes = df.groupBy(*by).agg(F.count("*").alias("_n")).where(F.col("_n") > most)
    large = cut_lineage(sizes.select(*[F.col(c).alias(f"_of_{c}") for c in by]))
    if large.isEmpty():
        return df, None
    return df.join(large, same_group(by, "_of_"), "left_anti"), df.join(large, same_group(by, "_of_"), "left_semi")


def places(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], out: str, most: int = MOST_IN_GROUP) -> DataFrame:
    """0, 1, ... within each group: a window for the groups that one task can sort, ranges for larger ones."""
    small, large = split_by_size(df, by, most)
    here = small.withColumn(out, (F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1).cast("bigint")) if by else None
    if large is None:
        return here
    there = numbered(large, by, order, out)
    return there if here is None else here.unionByName(there)


def distances(nodes: DataFrame, edges: DataFrame, sources: DataFrame) -> DataFrame:
    """(node, distance) by edges (a, b) in their direction from the nearest source; nodes out of reach are left out.  There are as
    many rounds as the farthest node has steps: each finds new nodes, or is the last."""
    rings = [cut_lineage(sources.join(nodes, "node", "left_semi").select("node", F.lit(0).alias("distance")).distinct())]
    step = edges.select(F.col("a").alias("node"), F.col("b").alias("next"))
    for d in count(1):
        found = reduce(DataFrame.unionByName, rings)
        new = rings[-1].join(step, "node").select(F.col("next").alias("node")).distinct().join(found, "node", "left_anti")
        ring = cut_lineage(new.select("node", F.lit(d).alias("distance")))
        if ring.isEmpty():
            return found
        if len(rings) > 12:  # so that a round's plan stays short
            rings = [cut_lineage(reduce(DataFrame.unionByName, rings))]
        rings.append(ring)


def grid_edges(cells: DataFrame, x: str, y: str) -> DataFrame:
    """(a, b) of cells side by side; a cell's node is the text ``x,y``."""
    at = cells.select(x, y).distinct()
    node = lambda p, q: F.concat_ws(",", p, q)
    moved = at.select(x, y, F.explode(F.array(*[F.struct(F.lit(a).alias("dx"), F.lit(b).alias("dy")) for a, b in ((1, 0), (-1, 0), (0, 1), (0, -1))])).alias("m"))
    moved = moved.select(node(F.col(x), F.col(y)).alias("a"), (F.col(x) + F.col("m.dx")).alias(x), (F.col(y) + F.col("m.dy")).alias(y))
    return moved.join(at, [x, y]).select("a", node(F.col(x), F.col(y)).alias("b"))


def ancestors(links: DataFrame, child: str, parent: str) -> DataFrame:
    """(child, ancestor, depth), a node being its own ancestor at depth 0.  Depth doubles each round, so chains may have any length.
    A cycle raises."""
    one = links.where(F.col(parent).isNotNull()).select(F.col(child).alias("child"), F.col(parent).alias("ancestor"))
    every = one.select("child").union(one.select("ancestor")).union(links.select(child)).distinct()
    out = every.select("child", F.col("child").alias("ancestor"), F.lit(0).alias("depth")).unionByName(one.distinct().withColumn("depth", F.lit(1)))
    reach = 1
    while True:
        out = cut_lineage(out)
        if not out.where("depth > 0 AND child = ancestor").isEmpty():
            raise RuntimeError("a node is among its own ancestors")
        far = out.where(F.col("depth") == reach).select(F.col("child"), F.col("ancestor").alias("_via"))
        more = far.join(out.where("depth > 0").select(F.col("child").alias("_via"), "ancestor", F.col("depth").alias("_d")), "_via").select("child", "ancestor", (F.col("_d") + reach).alias("depth"))
        if more.isEmpty():
            return out
        out = out.unionByName(more).distinct()
        reach *= 2


def first_along_chain(chain: DataFrame, values: DataFrame, id_: str, value: str) -> DataFrame:
    """The first non-null value from a node upwards."""
    v = values.where(F.col(value).isNotNull()).select(F.col(id_).alias("ancestor"), F.col(value).alias("_v"))
    return chain.join(v, "ancestor").groupBy("child").agg(F.min_by("_v", "depth").alias(value), F.min("depth").alias("found_at"))


def flattened_members(chain: DataFrame, members: DataFrame, type_: str, name: str, order: str) -> DataFrame:
    """Members of each type, root's first, then in their own order; a name declared again nearer to the type overrides."""
    m = members.select(F.col(type_).alias("ancestor"), F.col(name).alias("name"), F.col(order).alias("_o"))
    every = chain.join(m, "ancestor")
    nearest = every.withColumn("_rn", F.row_number().over(Window.partitionBy("child", "name").orderBy("depth", "_o")))
    first = every.groupBy("child", "name").agg(F.max(F.struct("depth", -F.col("_o"))).alias("_slot"))
    out = nearest.where("_rn = 1").select("child", "name", F.col("ancestor").alias("owner")).join(first, ["child", "name"])
    place = F.row_number().over(Window.partitionBy("child").orderBy(F.desc("_slot.depth"), F.desc("_slot.col2")))
    return out.select("child", "name", "owner", (place - 1).alias("slot"))


def taxonomy(links: DataFrame, child: str, parent: str) -> DataFrame:
    """Roots and their ordered children: parent (null for the roots), children."""
    return links.groupBy(parent).agg(F.array_join(F.sort_array(F.collect_list(F.col(child).cast("string"))), ",").alias("children"), F.count("*").alias("n"))


def propagate_frames(roots: DataFrame, edges: DataFrame) -> DataFrame:
    """World frame of every node: roots (node, x, y, angle), edges (a, b, x, y, angle, scale) place b within a.

    The first frame of a node is that of the lowest depth, then of the smallest path (the reference goes depth first; a
    total order is the same at every run).  Edges with a scale other than 1 are not followed.  Rounds are joined by shuffles: a round
    that is broadcast goes through the driver, and over all rounds that is every frame."""
    placed = [F.col(c).cast("double").alias(c) for c in ("x", "y", "angle")]
    now = cut_lineage(roots.select("node", *placed, F.col("node").cast("string").alias("path"), F.lit(0).alias("depth")))
    found = now
    e = edges.where("scale = 1").select(F.col("a").alias("node"), F.col("b").alias("_b"), F.col("x").alias("_x"), F.col("y").alias("_y"), F.col("angle").alias("_angle"))
    for d in count(1):  # each round places new nodes, or is the last
        c, s = F.cos(F.radians("angle")), F.sin(F.radians("angle"))
        moved = now.hint("merge").join(e, "node").select(
            F.col("_b").alias("node"),
            (F.col("x") + c * F.col("_x") - s * F.col("_y")).alias("x"),
            (F.col("y") + s * F.col("_x") + c * F.col("_y")).alias("y"),
            (F.col("angle") + F.col("_angle")).alias("angle"),
            F.concat_ws("/", "path", F.col("_b").cast("string")).alias("path"),
        )
        first = F.row_number().over(Window.partitionBy("node").orderBy("path", "x", "y"))
        new = moved.join(found.select("node").hint("merge"), "node", "left_anti").withColumn("_rn", first).where("_rn = 1").drop("_rn")
        now = cut_lineage(new.withColumn("depth", F.lit(d)))
        if now.isEmpty():
            return found
        found = cut_lineage(found.unionByName(now))


def rollup_metrics(metrics: DataFrame, by: Sequence[str]) -> DataFrame:
    """Package and file totals with the largest complexity."""
    return metrics.rollup(*by).agg(F.count("*").alias("functions"), F.sum("ops").alias("ops"), F.sum("blocks").alias("blocks"), F.sum("edges").alias("edges"), F.max("complexity").alias("max_complexity"))
