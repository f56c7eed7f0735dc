"""Ordinals, samples, prefix sums and top-k: everything that depends on an order, which is always total and explicit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheafwork.operators.graph import numbered, places


def variant_ordinals(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], out: str = "variant") -> DataFrame:
    """1, 2, ... within each group: which re-declaration of an id, or which placement of a target, a row is."""
    return places(df, by, order, out).withColumn(out, F.col(out) + 1)


def occurrence_index(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], out: str = "idx") -> DataFrame:
    """0, 1, ... of repeated tags below one parent."""
    return places(df, by, order, out)


def synthetic_ids(df: DataFrame, kind: str, order: Sequence[Column | str], by: Sequence[str] = (), width: int = 4, out: str = "id") -> DataFrame:
    """``<kind>-0000``, ... for rows without ids, within each group of ``by`` or over all rows; longer numbers stay whole."""
    n = F.col("_place").cast("string")
    return numbered(df, by, order, "_place").withColumn(out, F.concat(F.lit(f"{kind}-"), F.lpad(n, F.greatest(F.length(n), F.lit(width)), F.lit("0")))).drop("_place")


def repeated_ids(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows whose key occurs more than once, with how often.  An aggregate and a join: adaptive execution can split a hot
    key in the join, which a window could not."""
    many = df.groupBy(*by).agg(F.count("*").alias("times")).where("times > 1")
    return df.join(many, list(by))


def top_k(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], k: int, out: str = "rank") -> DataFrame:
    """The first k rows of each group; planned with a group limit before the shuffle."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("bigint")).where(F.col(out) <= k)


def seeded(key: Column, seed: int) -> Column:
    """A hash of a key that any engine can say: md5 of ``seed:key``."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """n rows in the order of a seeded hash: the same ones whatever the partitions."""
    return df.orderBy(seeded(F.col(key), seed), key).limit(n)


def stratified_sample(df: DataFrame, by: Sequence[str], key: str, each: int, total: int | None = None, seed: int = 0) -> DataFrame:
    """``each`` rows of every stratum, then, up to ``total``, rows of all strata by the seeded hash."""
    h = seeded(F.col(key), seed)
    ranked = df.withColumn("_in", F.row_number().over(Window.partitionBy(*by).orderBy(h, key))).withColumn("_h", h)
    # No stratum gives more than total rows, so that the rank is planned with a group limit below the shuffle.
    ranked = ranked.where(F.col("_in") <= (each if total is None else max(each, total)))
    if total is None:
        return ranked.drop("_in", "_h")
    return ranked.orderBy((F.col("_in") > each).cast("int"), "_h", key).limit(total).drop("_in", "_h")


def half_and_half(df: DataFrame, key: str, first: Column, n: int, seed: int = 0) -> DataFrame:
    """n rows by the seeded hash, half of them (rounded up) of those that ``first`` holds for and the others of the rest; what one side
    lacks the other gives.  Adds half: 1 or 2."""
    half = F.when(F.coalesce(first, F.lit(False)), 1).otherwise(2)
    ranked = df.withColumn("half", half).withColumn("_h", seeded(F.col(key), seed))
    ranked = ranked.withColumn("_in", F.row_number().over(Window.partitionBy("half").orderBy("_h", key))).where(F.col("_in") <= n)  # a group limit
    fair = F.when(F.col("half") == 1, F.lit(-(-n // 2))).otherwise(F.lit(n // 2))
    return ranked.orderBy((F.col("_in") > fair).cast("int"), "_in", "half").limit(n).drop("_h", "_in")


def every_nth(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], step: int) -> DataFrame:
    """Rows 0, step, 2 * step, ... of each group."""
    return numbered(df, by, order, "_n").where(F.col("_n") % step == 0).drop("_n")


def prefix_sums(cells: DataFrame, row: str, col: str, value: str, out: str = "total") -> DataFrame:
    """Summed-area table of a dense grid: out is the sum over all cells up to (row, col).  Two running sums, each with its
    own partitioning (rows, then columns), so no task has the whole grid."""
    along = F.sum(value).over(Window.partitionBy(row).orderBy(col).rowsBetween(Window.unboundedPreceding, 0))
    down = F.sum("_along").over(Window.partitionBy(col).orderBy(row).rowsBetween(Window.unboundedPreceding, 0))
    return cells.withColumn("_along", along).withColumn(out, down).drop("_along")


def rectangle_sums(sums: DataFrame, rects: DataFrame, row: str, col: str, total: str = "total") -> DataFrame:
    """Sum of each rectangle (rect, r0, c0, r1, c1; ends included) by four lookups in a summed-area table."""
    corners = rects.select(
        "rect",
        F.explode(F.array(*[F.struct(r.alias("r"), c.alias("c"), F.lit(s).alias("s")) for r, c, s in ((F.col("r1"), F.col("c1"), 1), (F.col("r0") - 1, F.col("c1"), -1), (F.col("r1"), F.col("c0") - 1, -1), (F.col("r0") - 1, F.col("c0") - 1, 1))])).alias("x"),
    )
    hit = corners.select("rect", "x.*").join(sums.select(F.col(row).alias("r"), F.col(col).alias("c"), F.col(total).alias("_t")), ["r", "c"], "left")
    return hit.groupBy("rect").agg(F.sum(F.coalesce(F.col("_t"), F.lit(0)) * F.col("s")).alias("sum"))


def shared_budget(hits: DataFrame, group_rank: Column, order: Sequence[Column | str], budget: int) -> DataFrame:
    """Rows that a budget shared by ordered groups shows, with each group's full total."""
    totals = hits.groupBy("kind").agg(F.count("*").alias("kind_total"))
    place = F.row_number().over(Window.orderBy(group_rank, *order))
    cut = hits.orderBy(group_rank, *order).limit(budget)  # so the global order is over the budget's rows only
    return cut.withColumn("position", place.cast("bigint")).join(totals, "kind")
