"""Grids, rasters and points: affine maps, holes, neighbours, pyramids, seams, shifts, polygons."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheafwork.session import staged


def affine(x: Column, y: Column, m: Sequence[float]) -> tuple[Column, Column]:
    """(a, b, c, d, e, f): x' = a x + b y + c, y' = d x + e y + f."""
    a, b, c, d, e, f = (F.lit(float(v)) for v in m)
    return a * x + b * y + c, d * x + e * y + f


def inverse(m: Sequence[float]) -> tuple[float, ...]:
    a, b, c, d, e, f = m
    det = a * e - b * d
    if det == 0:
        raise ValueError("the map has no inverse")
    return e / det, -b / det, (b * f - c * e) / det, -d / det, a / det, (c * d - a * f) / det


def floor_cell(v: Column, unit: float) -> Column:
    """Index of the cell a value is in, rounding down for negative values too."""
    return F.floor(v / F.lit(float(unit))).cast("bigint")


def truncated_cell(v: Column, unit: float) -> Column:
    """Index of the cell a value is in, cut towards zero: the cells on both sides of zero are one."""
    return (v / F.lit(float(unit))).cast("bigint")


def within(x: Column, y: Column, box: Sequence[float]) -> Column:
    return x.between(box[0], box[2]) & y.between(box[1], box[3])


def grid_holes(cells: DataFrame, x: str, y: str) -> DataFrame:
    """Cells of the bounding box that are not there.  The box is one row; its columns are exploded, dealt out, and exploded again, so
    that no task builds the whole grid."""
    box = cells.agg(F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1")).where("x0 IS NOT NULL")
    columns = box.select(F.explode(F.sequence("x0", "x1")).alias(x), "y0", "y1").repartition(x)
    grid = columns.select(x, F.explode(F.sequence("y0", "y1")).alias(y))
    return grid.join(cells.select(x, y).distinct(), [x, y], "left_anti")


def edge_deltas(tiles: DataFrame, x: str, y: str, left: str, right: str) -> DataFrame:
    """|right edge - left edge of the next tile| for tiles side by side: an equi self join on x + 1."""
    nxt = tiles.select((F.col(x) - 1).alias(x), y, F.col(left).alias("_next"))
    return tiles.join(nxt, [x, y]).withColumn("delta", F.abs(F.col(right) - F.col("_next"))).drop("_next")


def box_means(pixels: DataFrame, row: str, col: str, value: str, k: int, by: Sequence[str] = ()) -> DataFrame:
    return pixels.groupBy(*by, F.floor(F.col(row) / k).alias(row), F.floor(F.col(col) / k).alias(col)).agg(F.avg(value).alias(value))


def pyramid(tiles: DataFrame, x: str, y: str, zoom: int = 3) -> DataFrame:
    """The tile of each zoom level 0 .. zoom that a full-resolution tile goes into."""
    box = tiles.agg(F.min(x).alias("_x0"), F.min(y).alias("_y0"))
    z = F.explode(F.sequence(F.lit(0), F.lit(zoom))).alias("z")
    return tiles.join(F.broadcast(box)).select("*", z).select(
        x, y, "z", F.floor((F.col(x) - F.col("_x0")) / F.pow(F.lit(2), F.lit(zoom) - F.col("z"))).cast("bigint").alias("tx"), F.floor((F.col(y) - F.col("_y0")) / F.pow(F.lit(2), F.lit(zoom) - F.col("z"))).cast("bigint").alias("ty"),
    )


def lookup_pixels(points: DataFrame, row: Column, col: Column, raster: DataFrame, missing: int = -1) -> DataFrame:
    """value of the raster (row, col, value) below each point, ``missing`` outside."""
    at = points.withColumns({"_r": row, "_c": col})
    return at.join(raster.select(F.col("row").alias("_r"), F.col("col").alias("_c"), "value"), ["_r", "_c"], "left").withColumn("value", F.coalesce("value", F.lit(missing))).drop("_r", "_c")


#: Points of a leaf of a point tree, bits of a coordinate on its lattice and bits that a step down takes.
LEAF, LATTICE, STEP = 64, 48, 2


def cell_at(c: str, step: Column | int) -> Column:
    step = step if isinstance(step, Column) else F.lit(step)
    return F.call_function("shiftright", F.col(c), (F.lit(LATTICE) - step * STEP).cast("int"))


def point_tree(points: DataFrame, n: int, width: float, low: tuple[float, float]) -> tuple[DataFrame, DataFrame]:
    """(nodes, leaves) of n points (i, x, y) at different places in the square from ``low``, ``width`` wide: cells of 4 x 4 of the step
    before, beginning where even points would be LEAF to a cell, and cut again until a cell has LEAF points or the lattice ends.

    nodes (s, cx, cy, n, x0, x1, y0, y1, leaf) are the cells that have points, up to the whole square, with the box of those; leaves
    (i, x, y, ix, iy, s, cx, cy, n) are the points with the cell that was not cut further.  A round counts only points of cut cells."""
    on_lattice = lambda c, at: F.least(F.floor((F.col(c) - at) / width * 2.0**LATTICE).cast("bigint"), F.lit((1 << LATTICE) - 1))
    todo = staged(points.select("i", "x", "y", on_lattice("x", low[0]).alias("ix"), on_lattice("y", low[1]).alias("iy")), "points")
    first = s = max(0, int(math.log(max(1.0, n / LEAF), 4**STEP)))
    box = [f(c).alias(k) for k, f, c in (("x0", F.min, "x0"), ("x1", F.max, "x1"), ("y0", F.min, "y0"), ("y1", F.max, "y1"))]
    nodes, leaves = [], []
    while True:
        at = todo.withColumns({"s": F.lit(s), "cx": cell_at("ix", s), "cy": cell_at("iy", s)})
        boxed = at.withColumns({"x0": F.col("x"), "x1": F.col("x"), "y0": F.col("y"), "y1": F.col("y")})
        cells = boxed.groupBy("s", "cx", "cy").agg(F.count("*").alias("n"), *box)
        nodes.append(staged(cells.withColumn("leaf", (F.col("n") <= LEAF) | F.lit(s * STEP >= LATTICE)), "cells"))
        held = at.join(nodes[-1].select("s", "cx", "cy", "n", "leaf"), ["s", "cx", "cy"])
        leaves.append(held.where("leaf").select("i", "x", "y", "ix", "iy", "s", "cx", "cy", "n"))
        if nodes[-1].where("NOT leaf").isEmpty():
            break
        todo, s = staged(held.where("NOT leaf").select("i", "x", "y", "ix", "iy"), "points"), s + 1
    if first:  # the cells above, from those of the first round
        up = nodes[0].drop("leaf").select(F.explode(F.sequence(F.lit(0), F.lit(first - 1))).alias("u"), "*")
        lift = lambda c: F.call_function("shiftright", F.col(c), ((F.lit(first) - F.col("u")) * STEP).cast("int")).alias(f"_{c}")
        up = up.select("u", lift("cx"), lift("cy"), "n", "x0", "x1", "y0", "y1").groupBy("u", "_cx", "_cy").agg(F.sum("n").alias("n"), *box)
        nodes.append(up.select(F.col("u").alias("s"), F.col("_cx").alias("cx"), F.col("_cy").alias("cy"), "n", "x0", "x1", "y0", "y1", F.lit(False).alias("leaf")))
    return staged(reduce(DataFrame.unionByName, nodes), "nodes"), staged(reduce(DataFrame.unionByName, leaves), "leaves")


def distance(x: Column, y: Column, u: Column, v: Column) -> Column:
    return F.sqrt((x - u) ** 2 + (y - v) ** 2)


def away(low: Column, high: Column, at: Column) -> Column:
    """How far a place lies outside a range."""
    return F.greatest(low - at, at - high, F.lit(0.0))


def nearest_places(points: DataFrame) -> DataFrame:
    """(i, nearest, distance) of points (i, x, y) at different places, two of them at least.

    The points of its leaf, or the box of the smallest cell with others, bound how far a point's nearest can be.  It then looks at the
    cells of about that width around it, and from there down only into cells whose box is within the bound, so in a dense cell it
    meets the few points near it, and few points look into any one cell."""
    low = points.agg(F.count("*").alias("n"), F.min("x").alias("x"), F.min("y").alias("y"), F.greatest(F.max("x") - F.min("x"), F.max("y") - F.min("y")).alias("w")).first()
    width = float(low["w"])
    nodes, leaves = point_tree(points, low["n"], width, (float(low["x"]), float(low["y"])))
    cells = nodes.select(F.col("s").alias("ps"), F.col("cx").alias("px"), F.col("cy").alias("py"), "n", "x0", "x1", "y0", "y1", "leaf")
    mates = leaves.select("s", "cx", "cy", F.col("i").alias("j"), F.col("x").alias("u"), F.col("y").alias("v"))
    d = distance(F.col("x"), F.col("y"), F.col("u"), F.col("v"))
    place = ["i", "x", "y", "ix", "iy", "s"]
    own = leaves.where("n > 1").join(mates, ["s", "cx", "cy"]).where("i <> j").groupBy(*place).agg(F.min(d).alias("reach"))
    alone = leaves.where("n = 1 AND s > 0").select(*place, F.explode(F.sequence(F.lit(0), F.col("s") - 1)).alias("ps"))
    alone = alone.withColumns({"px": cell_at("ix", F.col("ps")), "py": cell_at("iy", F.col("ps"))}).join(cells.where("n > 1").select("ps", "px", "py", "x0", "x1", "y0", "y1"), ["ps", "px", "py"])
    far = alone.groupBy(*place).agg(F.min(distance(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))).alias("reach"))
    # The step whose cells are at least twice as wide as the reach, so that few of them hold the whole circle.
    deepest = F.floor(F.log2(F.lit(width) / (F.greatest(F.col("reach"), F.lit(1e-300)) * 2)) / STEP)
    begun = staged(own.unionByName(far), "reach").withColumn("t", F.greatest(F.least(F.col("s"), deepest), F.lit(0)).cast("int"))
    margin = F.col("reach") / width * 2.0**LATTICE + 2  # and what rounding may take
    corner = lambda c, sign: F.call_function("shiftright", F.least(F.greatest(F.floor(F.col(c) + sign * margin).cast("bigint"), F.lit(0)), F.lit((1 << LATTICE) - 1)), (F.lit(LATTICE) - F.col("t") * STEP).cast("int"))
    begun = begun.select("i", "x", "y", "reach", "t", F.explode(F.sequence(corner("ix", -1), corner("ix", 1))).alias("cx"), corner("iy", -1).alias("y_a"), corner("iy", 1).alias("y_b"))
    begun = begun.select("i", "x", "y", "reach", "t", "cx", F.explode(F.sequence("y_a", "y_b")).alias("cy"))
    # Such a cell is a node, or lies within a larger leaf.
    begun = begun.select("*", F.explode(F.sequence(F.lit(0), F.col("t"))).alias("ps"))
    lift = ((F.col("t") - F.col("ps")) * STEP).cast("int")
    begun = begun.select("i", "x", "y", "reach", "ps", (F.col("ps") == F.col("t")).alias("own"), F.call_function("shiftright", "cx", lift).alias("px"), F.call_function("shiftright", "cy", lift).alias("py"))
    inside = distance(away(F.col("x0"), F.col("x1"), F.col("x")), away(F.col("y0"), F.col("y1"), F.col("y")), F.lit(0.0), F.lit(0.0)) <= F.col("reach")
    hit = staged(begun.join(cells, ["ps", "px", "py"]).where("leaf OR own").where(inside).select("i", "x", "y", "reach", "ps", "px", "py", "leaf").distinct(), "cells-near")
    seen = [hit.where("leaf")]
    below = cells.where("ps > 0").select("*", (F.col("ps") - 1).alias("us"), F.shiftright("px", STEP).alias("ux"), F.shiftright("py", STEP).alias("uy"))
    while True:
        open_ = hit.where("NOT leaf").select("i", "x", "y", "reach", F.col("ps").alias("us"), F.col("px").alias("ux"), F.col("py").alias("uy"))
        if open_.isEmpty():
            break
        hit = staged(open_.join(below, ["us", "ux", "uy"]).where(inside).select("i", "x", "y", "reach", "ps", "px", "py", "leaf"), "cells-near")
        seen.append(hit.where("leaf"))
    asked = reduce(DataFrame.unionByName, seen).select("i", "x", "y", F.col("ps").alias("s"), F.col("px").alias("cx"), F.col("py").alias("cy"))
    met = asked.join(mates, ["s", "cx", "cy"]).where("i <> j").groupBy("i").agg(F.min(F.struct(d.alias("distance"), F.col("j").alias("nearest"))).alias("m"))
    return met.select("i", "m.nearest", "m.distance")


def nearest_neighbours(points: DataFrame, id_: str, x: str, y: str) -> DataFrame:
    """(id, nearest, distance) of each point's nearest other point, the smaller id among equals; nearest is null for a point
    that is alone, and for null or infinite coordinates.

    Points at one place are one point first, so any number of them costs one aggregate; the places meet through a point tree that
    is cut finer where they are dense (nearest_places), with no cross join and no cell of more than LEAF points."""
    given = points.select(F.col(id_).alias("id"), (F.col(x).cast("double") + 0.0).alias("x"), (F.col(y).cast("double") + 0.0).alias("y"))
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    every = given.where(finite("x") & finite("y"))
    at = staged(every.groupBy("x", "y").agg(F.min("id").alias("i"), F.count("*").alias("n")), "places")
    shared = at.where("n > 1").select("x", "y", "i")
    others = every.join(shared, ["x", "y"]).select("id", "i")
    second = others.where("id > i").groupBy("i").agg(F.min("id").alias("second"))
    same = others.join(second, "i").select("id", F.when(F.col("id") == F.col("i"), F.col("second")).otherwise(F.col("i")).alias("nearest"), F.lit(0.0).alias("distance"))
    same = same.unionByName(others.join(second, "i", "left_anti").select("id", F.col("i").alias("nearest"), F.lit(0.0).alias("distance")))
    places_ = at.select("i", "x", "y")
    alone = at.where("n = 1").select("i")
    near = same
    if places_.limit(2).count() == 2:
        near = near.unionByName(nearest_places(places_).join(alone, "i", "left_semi").select(F.col("i").alias("id"), "nearest", "distance"))
        rest = given.where(~(finite("x") & finite("y"))).select("id")
    else:
        rest = given.where(~(finite("x") & finite("y"))).select("id").unionByName(alone.withColumnRenamed("i", "id"))
    return near.unionByName(rest, allowMissingColumns=True)


def shift_scores(cells: DataFrame, mask: DataFrame, reach: int) -> DataFrame:
    """Agreement of labels with a mask moved by each (dx, dy) up to reach: a bounded number of copies, one equi join."""
    span = F.sequence(F.lit(-reach), F.lit(reach))
    moved = cells.select("row", "col", "label", F.explode(span).alias("dx")).select("*", F.explode(span).alias("dy"))
    moved = moved.withColumns({"row": F.col("row") + F.col("dy"), "col": F.col("col") + F.col("dx")})
    return moved.join(mask.select("row", "col", F.col("label").alias("_m")), ["row", "col"]).groupBy("dx", "dy").agg(F.count("*").alias("n"), F.avg((F.col("label") == F.col("_m")).cast("double")).alias("score"))


def runs_of(cells: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(…keys, row, c0, c1): the runs [c0, c1) of cells side by side in each row of cells (…keys, row, col)."""
    at = cells.select(*keys, "row", "col").distinct()
    island = at.withColumn("_k", F.col("col") - F.row_number().over(Window.partitionBy(*keys, "row").orderBy("col")))
    return island.groupBy(*keys, "row", "_k").agg(F.min("col").alias("c0"), (F.max("col") + 1).alias("c1")).drop("_k")


def overlap_by_shift(moved: DataFrame, fixed: DataFrame, reach: int, moved_keys: Sequence[str] = (), fixed_keys: Sequence[str] = ()) -> DataFrame:
    """(…moved_keys, …fixed_keys, dx, dy, n): cells that runs (…, row, c0, c1) share when one side is moved by each (dx, dy) up to
    reach; shifts without any are left out.

    All dx are had at once: over dx the overlap of two runs rises, stays and falls, so it is a sum of four ramps, and ramps of all runs
    add up by where they begin.  Only runs are copied, once for each dy; cells never are."""
    keys = [*moved_keys, *fixed_keys]
    a = moved.select(*moved_keys, "row", F.col("c0").alias("a0"), F.col("c1").alias("a1"), F.explode(F.sequence(F.lit(-reach), F.lit(reach))).alias("dy")).withColumn("row", F.col("row") + F.col("dy"))
    b = fixed.select(*fixed_keys, "row", F.col("c0").alias("b0"), F.col("c1").alias("b1"))
    both = a.join(b, "row").where((F.col("a0") - reach < F.col("b1")) & (F.col("a1") + reach > F.col("b0")))
    ramp = lambda begin, w: F.struct(begin.cast("bigint").alias("d"), F.lit(w).alias("w"))
    ramps = F.array(ramp(F.col("b0") - F.col("a1"), 1), ramp(F.col("b0") - F.col("a0"), -1), ramp(F.col("b1") - F.col("a1"), -1), ramp(F.col("b1") - F.col("a0"), 1))
    each = both.select(*keys, "dy", F.explode(ramps).alias("r")).where(F.col("r.d") <= reach)
    begin = F.greatest(F.col("r.d"), F.lit(-reach))  # a ramp that begins before the first shift is one from there, and a step
    sums = each.groupBy(*keys, "dy", begin.alias("d")).agg(F.sum("r.w").alias("w"), F.sum(F.col("r.w") * (begin - F.col("r.d"))).alias("k"))
    at = sums.select(*keys, "dy", "d", "w", "k", F.explode(F.sequence(F.col("d"), F.lit(reach).cast("bigint"))).alias("dx"))
    out = at.groupBy(*keys, "dx", "dy").agg(F.sum(F.col("w") * (F.col("dx") - F.col("d")) + F.col("k")).cast("bigint").alias("n"))
    return out.where("n > 0").select(*keys, F.col("dx").cast("int").alias("dx"), F.col("dy").cast("int").alias("dy"), "n")


def iou_by_shift(moved: DataFrame, fixed: DataFrame, reach: int) -> DataFrame:
    """(dx, dy, tp, fp, fn, iou) of two masks (row, col) for each shift of the first: cells of both, of the moved one alone, of the
    other alone; iou is null for empty masks."""
    a, b = runs_of(moved), runs_of(fixed)
    area = lambda runs, name: runs.agg(F.coalesce(F.sum(F.col("c1") - F.col("c0")), F.lit(0)).alias(name))
    span = F.explode(F.sequence(F.lit(-reach), F.lit(reach)))
    shifts = area(a, "_a").join(area(b, "_b")).select("_a", "_b", span.alias("dx")).select("*", span.alias("dy"))  # one row of areas
    tp = F.coalesce("n", F.lit(0))
    full = shifts.join(overlap_by_shift(a, b, reach), ["dx", "dy"], "left")
    return full.select("dx", "dy", tp.alias("tp"), (F.col("_a") - tp).alias("fp"), (F.col("_b") - tp).alias("fn"), (tp / F.nullif(F.col("_a") + F.col("_b") - tp, F.lit(0))).alias("iou"))


def majority_by_shift(cells: DataFrame, blocks: DataFrame, reach: int) -> DataFrame:
    """(dx, dy, blocks, right, score): how many blocks (block, row0, col0, size, label) have their own label as the most frequent one
    of the cells (row, col, label) that lie in them when all cells are moved by (dx, dy); of equals the smallest label counts, and
    blocks without cells are not counted."""
    rows = blocks.select("block", F.explode(F.sequence(F.col("row0"), F.col("row0") + F.col("size") - 1)).alias("row"), F.col("col0").alias("c0"), (F.col("col0") + F.col("size")).alias("c1"))
    counts = overlap_by_shift(runs_of(cells.select(F.col("label").alias("_label"), "row", "col"), ["_label"]), rows, reach, ["_label"], ["block"])
    first = counts.groupBy("block", "dx", "dy").agg(F.min(F.struct(-F.col("n"), F.col("_label").alias("label"))).alias("m"))
    judged = first.join(blocks.select("block", F.col("label").alias("_own")), "block")
    return judged.groupBy("dx", "dy").agg(F.count("*").alias("blocks"), F.count_if(F.col("m.label") == F.col("_own")).alias("right")).withColumn("score", F.col("right") / F.col("blocks"))


def label_check(points: DataFrame, raster: DataFrame) -> DataFrame:
    """(point, declared, sampled, verdict) of points (point, row, col, declared) against a raster (row, col, value): ``same``, ``other``, or
    ``outside`` where the raster has no cell."""
    at = points.join(raster.select("row", "col", F.col("value").alias("sampled")), ["row", "col"], "left")
    return at.select("point", "declared", "sampled", F.when(F.col("sampled").isNull(), "outside").when(F.col("sampled").eqNullSafe(F.col("declared")), "same").otherwise("other").alias("verdict"))


def boxes_overlap(a: DataFrame, b: DataFrame, by: Sequence[str], axes: Sequence[str]) -> DataFrame:
    """(…by, one overlap for each axis, apart, share) of boxes (…by, <axis>0, <axis>1) of two tables: negative overlaps are gaps, apart
    says that some axis has one, share is the common volume of the smaller box's (null for a flat box)."""
    left = a.select(*by, *[F.col(f"{x}{k}").alias(f"_a{x}{k}") for x in axes for k in "01"])
    right = b.select(*by, *[F.col(f"{x}{k}").alias(f"_b{x}{k}") for x in axes for k in "01"])
    overlap = {x: F.least(f"_a{x}1", f"_b{x}1") - F.greatest(f"_a{x}0", f"_b{x}0") for x in axes}
    product = lambda parts: reduce(lambda p, q: p * q, parts)
    volume = lambda side: product([F.col(f"_{side}{x}1") - F.col(f"_{side}{x}0") for x in axes])
    apart = reduce(lambda p, q: p | q, [o < 0 for o in overlap.values()])
    share = F.when(apart, 0.0).otherwise(product(list(overlap.values())) / F.nullif(F.least(volume("a"), volume("b")), F.lit(0.0)))
    return left.join(right, list(by)).select(*by, *[o.alias(x) for x, o in overlap.items()], apart.alias("apart"), share.alias("share"))


def best_shift(scores: DataFrame) -> DataFrame:
    """The best score; of equals the smallest shift."""
    return scores.agg(F.max_by(F.struct("dx", "dy"), F.struct("score", -(F.abs("dx") + F.abs("dy")), -F.col("dx"), -F.col("dy"))).alias("s"), F.max("score").alias("score")).select("s.dx", "s.dy", "score")


def plateau(value: Column, pin: float, tolerance: float) -> Column:
    return F.avg((F.abs(value - pin) < tolerance).cast("double"))


def polygon_area_box(ring: Column) -> Column:
    """Area of the bounding box of an array of (x, y) structs."""
    side = lambda f: F.array_max(F.transform(ring, lambda p: p[f])) - F.array_min(F.transform(ring, lambda p: p[f]))
    return side("x") * side("y")


def point_in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Even-odd rule over the edges of a ring (array of (x, y) structs), as an expression."""
    n = F.size(ring)
    edges = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(ring[i]["x"].alias("x1"), ring[i]["y"].alias("y1"), ring[(i + 1) % n]["x"].alias("x2"), ring[(i + 1) % n]["y"].alias("y2")))
    crosses = lambda e: ((e["y1"] > y) != (e["y2"] > y)) & (x < (e["x2"] - e["x1"]) * (y - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)) + e["x1"])
    return F.when(n >= 3, F.size(F.filter(edges, lambda e: F.coalesce(crosses(e), F.lit(False)))) % 2 == 1).otherwise(False)


def broken_rings(polygons: DataFrame) -> DataFrame:
    """The ledger of polygons (polygon, ring) that hold no point because their ring is none: (polygon, reason), reason being
    ``missing``, ``short`` (fewer than three vertices) or ``vertex`` (one without finite coordinates)."""
    number = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    whole = F.forall("ring", lambda p: p.isNotNull() & number(p["x"]) & number(p["y"]))
    reason = F.when(F.col("ring").isNull(), "missing").when(F.size("ring") < 3, "short").when(~F.coalesce(whole, F.lit(False)), "vertex")
    return polygons.select("polygon", reason.alias("reason")).where("reason IS NOT NULL")


def points_in_polygons(points: DataFrame, polygons: DataFrame, cell: float) -> DataFrame:
    """(point, polygon) for each polygon (polygon, ring) a point (point, x, y) is in.

    A polygon is put into cells as wide as its box (``cell`` or that doubled as often as needed), so it lies in four of them at most,
    however large it is; points are put into a cell of each width that polygons have.  Polygons of broken_rings hold nothing."""
    side = lambda f, of: of(F.transform("ring", lambda p: p[f]))
    bad = broken_rings(polygons).select(F.col("polygon").alias("_bad"))
    good = polygons.join(bad, F.col("polygon").eqNullSafe(F.col("_bad")), "left_anti")
    boxed = good.select("polygon", "ring", *[side(f, of).alias(f"{f}{k}") for f in "xy" for k, of in ((0, F.array_min), (1, F.array_max))])
    wide = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    boxed = boxed.withColumn("level", F.greatest(F.ceil(F.log2(F.greatest(wide, F.lit(float(cell))) / float(cell))), F.lit(0)).cast("int"))
    unit = F.lit(float(cell)) * F.pow(F.lit(2.0), F.col("level"))
    lattice = lambda c: F.floor(c / unit)
    spread_ = boxed.select("polygon", "ring", "x0", "x1", "y0", "y1", "level", F.explode(F.sequence(lattice(F.col("x0")), lattice(F.col("x1")))).alias("cx"), lattice(F.col("y0")).alias("_y0"), lattice(F.col("y1")).alias("_y1"))
    spread_ = spread_.select("polygon", "ring", "x0", "x1", "y0", "y1", "level", "cx", F.explode(F.sequence("_y0", "_y1")).alias("cy"))
    levels = boxed.select("level").distinct()  # at most about a thousand, as coordinates are doubles
    at = points.join(F.broadcast(levels)).withColumns({"cx": lattice(F.col("x")), "cy": lattice(F.col("y"))})
    near = at.join(spread_, ["level", "cx", "cy"]).where(F.col("x").between(F.col("x0"), F.col("x1")) & F.col("y").between(F.col("y0"), F.col("y1")))
    return near.where(point_in_ring(F.col("x"), F.col("y"), F.col("ring"))).select("point", "polygon").distinct()


def frame(chain: Column) -> Column:
    """(x, y, angle in degrees) of a chain of (x, y, angle, scale) transforms, outermost first, applied one inside another."""
    start = F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"), F.lit(0.0).alias("angle"), F.lit(1.0).alias("scale"))

    def inside(f: Column, t: Column) -> Column:
        c, s = F.cos(F.radians(f["angle"])), F.sin(F.radians(f["angle"]))
        return F.struct((f["x"] + f["scale"] * (c * t["x"] - s * t["y"])).alias("x"), (f["y"] + f["scale"] * (s * t["x"] + c * t["y"])).alias("y"), (f["angle"] + t["angle"]).alias("angle"), (f["scale"] * t["scale"]).alias("scale"))

    return F.aggregate(chain, start, inside)


def mosaic(tiles: DataFrame, size: int, by: str = "layer") -> DataFrame:
    """(layer, x0, y0, width, height, holes): the frame of each layer's tiles (layer, x, y, ...), in pixels but for its corner."""
    at = tiles.groupBy(by, "x", "y").agg(F.lit(1).alias("_one"))
    box = at.groupBy(by).agg(F.min("x").alias("x0"), F.min("y").alias("y0"), (F.max("x") - F.min("x") + 1).alias("_w"), (F.max("y") - F.min("y") + 1).alias("_h"), F.count("*").alias("_n"))
    return box.select(by, "x0", "y0", (F.col("_w") * size).alias("width"), (F.col("_h") * size).alias("height"), (F.col("_w") * F.col("_h") - F.col("_n")).alias("holes"))


def mosaic_rows(tiles: DataFrame, size: int, by: str = "layer") -> DataFrame:
    """(layer, row, data): the pixel rows of the raster that each layer's tiles (layer, x, y, data: size * size bytes) make over
    their frame, zero where no tile is.  A row of pixels is the largest group; a row of tiles that lacks all of them has no rows.
    Of tiles at one place, that with the largest data is shown."""
    one = tiles.groupBy(by, "x", "y").agg(F.max("data").alias("data"))
    lines = one.select(by, "x", "y", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda k: F.substring("data", k * size + 1, size))).alias("_k", "_part"))
    frame_of = mosaic(tiles, size, by).select(F.col(by).alias("_by"), "x0", "y0", "width")
    placed = lines.join(frame_of, F.col(by).eqNullSafe(F.col("_by"))).select(by, ((F.col("y") - F.col("y0")) * size + F.col("_k")).alias("row"), (F.col("x") - F.col("x0")).alias("_x"), "_part", (F.col("width") / size).cast("int").alias("_tiles"))
    row = placed.groupBy(by, "row").agg(F.map_from_entries(F.collect_list(F.struct("_x", "_part"))).alias("_parts"), F.first("_tiles").alias("_tiles"))
    pieces = F.transform(F.sequence(F.lit(0), F.col("_tiles") - 1), lambda i: F.hex(F.coalesce(F.try_element_at("_parts", i.cast("bigint")), F.lit(bytes(size)))))
    return row.select(by, "row", F.unhex(F.array_join(pieces, "")).alias("data"))


def square_side(n_bytes: Column, width: int) -> Column:
    """Side of the square grid of width-byte cells that fills n_bytes, null if none does."""
    side = F.floor(F.sqrt(n_bytes / width)).cast("bigint")
    return F.when(side * side * width == n_bytes, side)



def downsampled_tiles(tiles: DataFrame, size: int, by: str = "layer") -> DataFrame:
    """Tiles of one zoom level less: each 2 x 2 group of (layer, x, y, data: size * size bytes) as one tile of the same size by
    2 x 2 means; missing tiles count as zero.  A group has at most four tiles, so it is bounded."""

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        big = np.zeros((2 * size, 2 * size), np.uint16)
        for x, y, data in zip(pdf.x, pdf.y, pdf.data):
            r, c = int(y) % 2 * size, int(x) % 2 * size
            big[r : r + size, c : c + size] = np.frombuffer(data, np.uint8).reshape(size, size)
        small = big.reshape(size, 2, size, 2).sum(axis=(1, 3)) // 4
        return pd.DataFrame({by: [pdf[by].iloc[0]], "x": [int(pdf.x.iloc[0]) // 2], "y": [int(pdf.y.iloc[0]) // 2], "data": [small.astype(np.uint8).tobytes()]})

    keyed = tiles.withColumns({"_tx": F.floor(F.col("x") / 2), "_ty": F.floor(F.col("y") / 2)})
    return keyed.groupBy(by, "_tx", "_ty").applyInPandas(merge, f"{by} string, x bigint, y bigint, data binary")


def coast_sides(cells: DataFrame, x: str, y: str, land: str) -> DataFrame:
    """For each side (dx, dy), land cells whose neighbour on that side is water or missing, and their share of all land."""
    at = cells.where(F.col(land)).select(x, y)
    step = F.explode(F.array(*[F.struct(F.lit(a).alias("dx"), F.lit(b).alias("dy")) for a, b in ((1, 0), (-1, 0), (0, 1), (0, -1))]))
    moved = at.select(x, y, step.alias("s")).select("s.dx", "s.dy", (F.col(x) + F.col("s.dx")).alias(x), (F.col(y) + F.col("s.dy")).alias(y))
    there = at.withColumn("_land", F.lit(True))
    return moved.join(there, [x, y], "left").groupBy("dx", "dy").agg(F.count_if(F.col("_land").isNull()).alias("coast"), F.avg(F.col("_land").isNull().cast("double")).alias("share"))


def channel_census(pixels: DataFrame, channels: Sequence[str], pair: tuple[str, str], total: int = 255) -> DataFrame:
    """How many different values each channel has, its range, and how many pixels break ``a + b = total`` for a pair."""
    out = [F.count_distinct(c).alias(f"{c}_values") for c in channels] + [F.min(c).alias(f"{c}_low") for c in channels] + [F.max(c).alias(f"{c}_high") for c in channels]
    return pixels.agg(*out, F.count_if(F.col(pair[0]) + F.col(pair[1]) != total).alias("pair_breaks"), F.count("*").alias("pixels"))


def registration_curve(values: DataFrame, mask: DataFrame, reach: int) -> DataFrame:
    """Mean of values (row, col, value) below a mask (row, col) moved by each (dx, dy) up to reach."""
    span = F.sequence(F.lit(-reach), F.lit(reach))
    moved = mask.select("row", "col", F.explode(span).alias("dx")).select("*", F.explode(span).alias("dy"))
    moved = moved.withColumns({"row": F.col("row") + F.col("dy"), "col": F.col("col") + F.col("dx")})
    return moved.join(values, ["row", "col"]).groupBy("dx", "dy").agg(F.count("*").alias("n"), F.avg("value").alias("mean"))


def transform_verdict(df: DataFrame, **gates: Column) -> DataFrame:
    """CONFIRMED if all gates hold, else the gates that don't."""
    failed = F.array_join(F.filter(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(k)) for k, c in gates.items()]), lambda x: x.isNotNull()), ",")
    return df.withColumn("verdict", F.when(failed == "", "CONFIRMED").otherwise(F.concat(F.lit("REFUSED:"), failed)))


def mask_slice(raster: DataFrame, row0: int, row1: int, col0: int, col1: int) -> DataFrame:
    """The rectangle [row0, row1) x [col0, col1) of a raster (row, col, value), from its own corner; cells out of the raster
    are missing rows, so a mean or a join sees them as null.  The bounds reach the scan."""
    inside = F.col("row").between(row0, row1 - 1) & F.col("col").between(col0, col1 - 1)
    return raster.where(inside).select((F.col("row") - row0).alias("row"), (F.col("col") - col0).alias("col"), "value")


def box_overlap(a: DataFrame, b: DataFrame, by: Sequence[str], low: str, high: str) -> DataFrame:
    """Overlap of the ranges (low, high) that two tables give for the same keys: (…by, overlap, apart)."""
    both = a.select(*by, F.col(low).alias("_a0"), F.col(high).alias("_a1")).join(b.select(*by, F.col(low).alias("_b0"), F.col(high).alias("_b1")), list(by))
    overlap = F.least("_a1", "_b1") - F.greatest("_a0", "_b0")
    return both.select(*by, F.greatest(overlap, F.lit(0)).alias("overlap"), (overlap < 0).alias("apart"))


def smoothness(cells: DataFrame, x: str, y: str, value: str) -> DataFrame:
    """Mean |difference| to the right and upper neighbour, by two equi joins in one: the smaller, the smoother a layout."""
    near = cells.select((F.col(x) - 1).alias(x), y, F.col(value).alias("_v")).unionByName(cells.select(x, (F.col(y) - 1).alias(y), F.col(value).alias("_v")))
    return cells.join(near, [x, y]).agg(F.count("*").alias("pairs"), F.avg(F.abs(F.col(value) - F.col("_v"))).alias("score"))


def layout_sweep(cells: DataFrame, x: str, y: str, value: str, widths: Sequence[int], place: str) -> DataFrame:
    """smoothness of cells laid out by their running place in rows of each width: (width, pairs, score)."""
    laid = cells.select(F.col(place).alias("_p"), F.col(value).alias("_value"), F.explode(F.array(*map(F.lit, widths))).alias("width"))
    laid = laid.select("width", (F.col("_p") % F.col("width")).alias(x), F.floor(F.col("_p") / F.col("width")).alias(y), "_value")
    near = laid.select("width", (F.col(x) - 1).alias(x), y, F.col("_value").alias("_v")).unionByName(laid.select("width", x, (F.col(y) - 1).alias(y), F.col("_value").alias("_v")))
    return laid.join(near, ["width", x, y]).groupBy("width").agg(F.count("*").alias("pairs"), F.avg(F.abs(F.col("_value") - F.col("_v"))).alias("score"))


def tile_geography(manifest: DataFrame, sea: str, placeholder: str, box: tuple[int, int, int, int] | None = None) -> DataFrame:
    """(x, y, ground, placeholder) from a manifest (path, hash) of albedo and splat tiles: ``hole`` where the box (x0, y0, x1, y1, by
    default that of the albedo tiles) has no albedo tile, ``sea`` where the splat tile has the hash sea, else ``land``;
    placeholder tells albedo tiles of that hash.  One pass over the manifest, and equi joins on cells."""
    part = lambda k: F.regexp_extract("path", r"/(albedo|splat)/[a-z]+_x(-?\d+)_y(\d+)", k)
    at = manifest.where(part(1) != "").select(part(1).alias("layer"), part(2).cast("bigint").alias("x"), part(3).cast("bigint").alias("y"), "hash")
    albedo, splat = F.col("layer") == "albedo", F.col("layer") == "splat"
    cells = at.groupBy("x", "y").agg(F.bool_or(albedo).alias("_present"), F.bool_or(splat & (F.col("hash") == sea)).alias("_sea"), F.bool_or(albedo & (F.col("hash") == placeholder)).alias("placeholder"))
    present = cells.where("_present").select("x", "y", F.when(F.col("_sea"), "sea").otherwise("land").alias("ground"), "placeholder")
    corners = present if box is None else present.sparkSession.createDataFrame([(box[0], box[1]), (box[2], box[3])], "x bigint, y bigint")
    holes = corners.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")).where("x0 IS NOT NULL")
    columns = holes.select(F.explode(F.sequence("x0", "x1")).alias("x"), "y0", "y1").repartition("x")
    grid = columns.select("x", F.explode(F.sequence("y0", "y1")).alias("y")).join(present.select("x", "y"), ["x", "y"], "left_anti")
    return present.unionByName(grid.select("x", "y", F.lit("hole").alias("ground"), F.lit(False).alias("placeholder")))


def carrier_transform(carriers: DataFrame, offset: str, min_tile: str, world_size: str, tile_px: float, cells: int) -> DataFrame:
    """Adds what a world's carriers say of its lattice: unit (world units a cell, offset / min_tile), span (cells of the mask), scale
    (pixels a world unit) and broken: null, or the first rule that fails (``offset``: no whole unit, ``size``: the world is no
    whole number of units, ``span``: of another number than cells).  Null where no unit can be told."""
    whole = F.when((F.col(min_tile) != 0) & (F.try_mod(F.col(offset), F.col(min_tile)) == 0), F.floor(F.col(offset) / F.nullif(F.col(min_tile), F.lit(0))))
    unit = F.when(whole > 0, whole)
    out = carriers.withColumn("unit", unit)
    rest = F.when(F.col("unit").isNotNull(), F.try_mod(F.col(world_size), F.col("unit")))
    span = F.when(rest == 0, F.floor(F.col(world_size) / F.col("unit")))
    broken = F.when(F.col("unit").isNull(), "offset").when(F.col("span").isNull(), "size").when(F.col("span") != cells, "span")
    return out.withColumns({"span": span, "scale": F.lit(float(tile_px)) / F.col("unit")}).withColumn("broken", broken)


def pyramid_agreement(full: DataFrame, small: DataFrame, k: int, by: Sequence[str]) -> DataFrame:
    """How well tiles of a pyramid level (…by, row, col, value) agree with the k x k means of the full tiles of the same key: pixels
    that both have, unpaired ones, mean |difference| and correlation (null for flat tiles)."""
    down = box_means(full, "row", "col", "value", k, by).withColumnRenamed("value", "_f")
    both = down.join(small.select(*by, "row", "col", F.col("value").alias("_s")), [*by, "row", "col"], "full_outer")
    paired = F.col("_f").isNotNull() & F.col("_s").isNotNull()
    on = lambda c: F.when(paired, F.col(c))
    flat = (F.min(on("_f")) == F.max(on("_f"))) | (F.min(on("_s")) == F.max(on("_s")))
    return both.groupBy(*by).agg(F.count_if(paired).alias("pixels"), F.count_if(~paired).alias("unpaired"), F.avg(F.abs(on("_f") - on("_s"))).alias("error"), F.when(~flat, F.corr(on("_f"), on("_s"))).alias("corr"))


def passability(nodes: DataFrame, scene: str) -> DataFrame:
    """Census of scene nodes (scene, type, name, points: array of (x, y) structs) that tell where units start and may go; name
    classes are fixed values.  squares counts unit markers whose box is one unit of area."""
    name, low, polygon = F.col("name"), F.lower(F.coalesce("name", F.lit(""))), F.col("type") == "polygon"
    unit = name.isin("ally", "foe")
    marker = unit & (F.size("points") >= 3)
    return nodes.groupBy(scene).agg(
        F.count_if(name == "ally").alias("ally"), F.count_if(name == "foe").alias("foe"), F.count_distinct(F.when(low.startswith("selector"), name)).alias("selectors"),
        F.count_if((name == "navmesh") & polygon).alias("navmesh"), F.count_if(name == "obstacle").alias("obstacles"), F.count_if(name == "wall").alias("walls"),
        F.count_if(low.startswith("reachzone")).alias("reach_zones"), F.count_if(name == "collide").alias("colliders"), F.count_if(marker).alias("markers"),
        F.count_if(marker & (F.abs(polygon_area_box(F.col("points")) - 1) < 1e-6)).alias("squares"),
    )
