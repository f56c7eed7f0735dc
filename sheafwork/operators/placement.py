"""Points of interest: where each scene stands in the world, and a ledger of those that stand nowhere.

Every scene ends in exactly one state: ``anchored`` (it says its own place), ``placed`` (references put it somewhere), ``refused``
(references do, but to no place of the world) or ``unreferenced``.  placement_identity proves that."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafwork.operators.graph import places

POINT = ["source", "status", "kind", "region", "ref", "x", "y", "exact", "variant", "reason"]


def why_refused(box: Sequence[float]):
    """Null for a place in the box (x0, y0, x1, y1), else ``nowhere`` for none or ``outside``."""
    number = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    inside = F.col("x").between(box[0], box[2]) & F.col("y").between(box[1], box[3])
    return F.when(~(number("x") & number("y")), "nowhere").when(~inside, "outside")


def place_points(scenes: DataFrame, anchors: DataFrame, placements: DataFrame, box: Sequence[float]) -> DataFrame:
    """(source, status, kind, region, ref, x, y, exact, variant, reason) of scenes (source, region, kind): one row for each scene, but for
    placed ones one for each different place of placements (source, ref, region, x, y, exact), numbered 1, 2, ... by x and y.

    Equal placements are one, with the smallest ref; exact if any of them is.  An anchor (source, x, y) counts before references.  Of a
    scene with good and bad placements the good ones count; see refused_placements for the others.  A placement's region, where it
    has one, counts before the scene's."""
    scenes = scenes.select("source", "region", "kind").dropDuplicates(["source"])
    anchored = anchors.groupBy("source").agg(F.min(F.struct("x", "y")).alias("at")).select("source", "at.x", "at.y", why_refused_at(box).alias("_off"))
    own = scenes.join(anchored.where("_off IS NULL").select("source", "x", "y"), "source")
    rest = scenes.join(anchored.where("_off IS NULL").select("source"), "source", "left_anti")
    judged = placements.withColumn("reason", why_refused(box))
    good = judged.where("reason IS NULL").groupBy("source", "x", "y").agg(F.min("ref").alias("ref"), F.bool_or("exact").alias("exact"), F.min(F.col("region")).alias("_region"))
    placed = places(rest.join(good, "source"), ["source"], ["x", "y"], "variant").withColumn("variant", (F.col("variant") + 1).cast("int"))
    nowhere = rest.join(good.select("source").distinct(), "source", "left_anti")
    bad = judged.where("reason IS NOT NULL").unionByName(anchored.where("_off IS NOT NULL").select("source", F.col("_off").alias("reason")), allowMissingColumns=True).groupBy("source").agg(F.min("reason").alias("reason"))
    left = nowhere.join(bad, "source", "left")
    one = F.lit(1)
    parts = [
        own.select("source", F.lit("anchored").alias("status"), "kind", "region", "x", "y", F.lit(True).alias("exact"), one.alias("variant")),
        placed.select("source", F.lit("placed").alias("status"), "kind", F.coalesce("_region", "region").alias("region"), "ref", "x", "y", "exact", "variant"),
        left.select("source", F.when(F.col("reason").isNull(), "unreferenced").otherwise("refused").alias("status"), "kind", "region", one.alias("variant"), "reason"),
    ]
    out = parts[1].unionByName(parts[0], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    return out.select(*POINT)


def why_refused_at(box: Sequence[float]):
    return F.when(F.col("at.x").isNull() | F.col("at.y").isNull() | F.isnan("at.x") | F.isnan("at.y"), "nowhere").when(~(F.col("at.x").between(box[0], box[2]) & F.col("at.y").between(box[1], box[3])), "outside")


def refused_placements(placements: DataFrame, box: Sequence[float]) -> DataFrame:
    """The negative ledger: (source, ref, x, y, reason) of placements to no place of the world."""
    return placements.withColumn("reason", why_refused(box)).where("reason IS NOT NULL").select("source", "ref", "x", "y", "reason")


def placement_identity(scenes: DataFrame, points: DataFrame) -> DataFrame:
    """(source, states): scenes that are in no state or in several, and points of no scene; empty if the states part the scenes."""
    states = points.groupBy("source").agg(F.count_distinct("status").alias("states"))
    both = scenes.select("source").distinct().withColumn("_scene", F.lit(True)).join(states, "source", "full_outer")
    return both.where(F.col("_scene").isNull() | F.col("states").isNull() | (F.col("states") != 1)).select("source", F.coalesce("states", F.lit(0)).alias("states"))


def overlay(nodes: DataFrame) -> DataFrame:
    """(scene, type, nodes, references, masks) of scene nodes (scene, type, source, path): the census that stands beside the points, with
    how many of a type refer to another scene and how many lie in a mask folder."""
    return nodes.groupBy("scene", F.coalesce("type", F.lit("?")).alias("type")).agg(F.count("*").alias("nodes"), F.count_if(F.col("source").isNotNull()).alias("references"), F.count_if(F.contains("path", F.lit("/layers2D/"))).alias("masks"))
