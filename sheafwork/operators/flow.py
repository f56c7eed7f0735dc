"""Control flow of functions as tables: blocks, edges, reach, dominators and loops, by windows, joins and rounds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheafwork.session import staged


def blocks_of(ops: DataFrame, function: str = "function") -> DataFrame:
    """ops (function, pc, targets ARRAY<INT>, falls) with block (0, 1, ... in the order of pc) and last (of its block).  A block begins at a
    function's first operation, at a jump's target, and behind an operation that jumps or does not fall through."""
    aimed = ops.select(F.col(function).alias("_f"), F.explode("targets").alias("_pc")).distinct().withColumn("_aimed", F.lit(True))
    at = ops.join(aimed, (F.col(function) == F.col("_f")) & (F.col("pc") == F.col("_pc")), "left")
    w = Window.partitionBy(function).orderBy("pc")
    leaves = (F.size(F.coalesce("targets", F.array().cast("array<int>"))) > 0) | ~F.col("falls")
    leader = F.coalesce(F.lag(leaves).over(w), F.lit(True)) | F.col("_aimed").isNotNull()
    at = at.withColumn("_leader", leader)
    block = F.sum(F.col("_leader").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1
    return at.withColumns({"block": block.cast("int"), "last": F.coalesce(F.lead("_leader").over(w), F.lit(True)), "_next": F.lead("pc").over(w).isNotNull()}).drop("_f", "_pc", "_aimed", "_leader")


def edges_of(blocks: DataFrame, function: str = "function") -> DataFrame:
    """(function, a, b): which block may follow which; targets that are no operation lead nowhere."""
    ends = blocks.where("last")
    jumps = ends.select(F.col(function).alias("_f"), F.col("block").alias("a"), F.explode("targets").alias("_pc"))
    jumps = jumps.join(blocks.select(function, "pc", F.col("block").alias("b")), (F.col("_f") == F.col(function)) & (F.col("_pc") == F.col("pc"))).select(function, "a", "b")
    falls = ends.where(F.col("falls") & F.col("_next")).select(function, F.col("block").alias("a"), (F.col("block") + 1).alias("b"))
    return jumps.unionByName(falls).distinct()


def dominators(edges: DataFrame, entries: DataFrame, function: str = "function") -> DataFrame:
    """(function, block, by): every reachable block with the blocks that each way to it goes through, itself included.

    Reach is a frontier's.  Then each round a block's set is itself and what the sets of all blocks before it share; sets only shrink,
    and the rounds end when none does, after as many as the flow is nested deep."""
    rings = [staged(entries.select(function, F.lit(0).alias("block")), "flow-reach")]
    while True:
        found = reduce(DataFrame.unionByName, rings)
        new = rings[-1].withColumnRenamed("block", "a").join(edges, [function, "a"]).select(function, F.col("b").alias("block")).distinct().join(found, [function, "block"], "left_anti")
        new = staged(new, "flow-reach")
        if new.isEmpty():
            break
        rings.append(new)
    reached = staged(reduce(DataFrame.unionByName, rings), "flow-reach")
    inner = staged(edges.join(reached.withColumnRenamed("block", "a"), [function, "a"]), "flow-edges")
    start = F.when(F.col("block") == 0, F.array(F.lit(0)))  # null: all blocks, as nothing is known yet
    now = staged(reached.select(function, "block", start.alias("by")), "flow-dominators")
    while True:
        sets = inner.where("b <> 0").join(now.where("by IS NOT NULL").select(function, F.col("block").alias("a"), "by"), [function, "a"])
        shared = F.aggregate(F.slice("_all", F.lit(2), F.size("_all")), F.col("_all")[0], lambda x, y: F.array_intersect(x, y))
        new = sets.groupBy(function, F.col("b").alias("block")).agg(F.collect_set("by").alias("_all")).select(function, "block", F.array_sort(F.array_union(shared, F.array("block"))).alias("_new"))
        after = staged(now.join(new, [function, "block"], "left").select(function, "block", F.coalesce("_new", "by").alias("by"), (F.col("_new").isNotNull() & ~F.col("_new").eqNullSafe(F.col("by"))).alias("_moved")), "flow-dominators")
        now = after.drop("_moved")
        if after.where("_moved").isEmpty():
            return now


#: Blocks of a function whose sets are bits of one number each; larger functions go by rounds.
MOST_BLOCKS = 62


def metrics_in_a_row(sizes: DataFrame, edges: DataFrame, function: str) -> DataFrame:
    """flow_metrics of functions of up to MOST_BLOCKS blocks, each a row with its edges.  A block's set is a number with a bit for each
    block above it, -1 (all bits) as long as no way to it is known.  After k rounds it is what all ways of up to k edges share; if some
    way leaves a block out, one without repeats does, so as many rounds as there are blocks are enough."""
    ways = edges.groupBy(function).agg(F.collect_list(F.struct("a", "b")).alias("_edges"))
    rows = sizes.where(F.col(function).isNotNull()).join(ways, function, "left")
    rows = rows.withColumn("_edges", F.coalesce("_edges", F.array().cast("array<struct<a:int,b:int>>")))
    rows = rows.withColumn("_before", F.expr("transform(sequence(0, CAST(blocks - 1 AS INT)), i -> transform(filter(_edges, e -> e.b = i), e -> e.a))"))
    once = "transform(_before, (p, i) -> if(i = 0, 1L, aggregate(p, -1L, (x, a) -> x & m[a]) | shiftleft(1L, i)))"
    rows = rows.withColumn("_by", F.expr(f"aggregate(sequence(1, CAST(blocks AS INT)), transform(_before, (p, i) -> if(i = 0, 1L, -1L)), (m, k) -> {once})"))
    return rows.select(
        function, "ops", "blocks", F.size("_edges").cast("bigint").alias("edges"), F.expr("CAST(size(filter(_by, x -> x <> -1)) AS BIGINT)").alias("reachable"),
        F.expr("CAST(size(filter(_edges, e -> _by[e.a] <> -1 AND (_by[e.a] & shiftleft(1L, e.b)) <> 0)) AS BIGINT)").alias("loops"),
        F.expr("CAST(array_max(transform(filter(_by, x -> x <> -1), x -> bit_count(x))) - 1 AS BIGINT)").alias("dominator_depth"),
    )


def metrics_by_rounds(sizes: DataFrame, edges: DataFrame, function: str) -> DataFrame:
    """flow_metrics of functions of any size, from the table of their dominators."""
    over = dominators(edges, sizes, function)
    deep = over.groupBy(function).agg(F.count("*").alias("reachable"), F.max(F.size("by") - 1).cast("bigint").alias("dominator_depth"))
    back = edges.join(over.withColumnRenamed("block", "a"), [function, "a"]).groupBy(function).agg(F.count_if(F.array_contains("by", F.col("b"))).alias("loops"))
    n = edges.groupBy(function).agg(F.count("*").alias("edges"))
    out = sizes.join(n, function, "left").join(deep, function).join(back, function, "left")
    count = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    return out.select(function, "ops", "blocks", count("edges"), "reachable", count("loops"), "dominator_depth")


def flow_metrics(ops: DataFrame, function: str = "function", most: int = MOST_BLOCKS) -> DataFrame:
    """(function, ops, blocks, edges, reachable, loops, dominator_depth, complexity) of each function.  A loop is an edge back to a block
    that dominates its begin; depth counts the dominators above a block.  Functions of up to ``most`` blocks are a row each, larger
    ones go by rounds of joins."""
    blocks = staged(blocks_of(ops, function), "flow-blocks")
    edges = staged(edges_of(blocks, function), "flow-edges")
    sizes = staged(blocks.groupBy(function).agg(F.count("*").alias("ops"), (F.max("block") + 1).cast("bigint").alias("blocks")), "flow-sizes")
    large = sizes.where(F.col("blocks") > most)
    if large.isEmpty():
        out = metrics_in_a_row(sizes, edges, function)
    else:
        small = metrics_in_a_row(sizes.where(F.col("blocks") <= most), edges.join(large.select(function), function, "left_anti"), function)
        out = small.unionByName(metrics_by_rounds(large, edges.join(large.select(function), function, "left_semi"), function))
    return out.withColumn("complexity", (F.col("edges") - F.col("blocks") + 2).cast("bigint")).select(function, "ops", "blocks", "edges", "reachable", "loops", "dominator_depth", "complexity")
