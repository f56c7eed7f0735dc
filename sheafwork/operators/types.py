"""Types that refer to types, shown as text."""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafwork.session import staged


def shown(kind: Column, name: Column, parts: Column) -> Column:
    """The text of a type of whose parts the texts are known: ``(a,b)->c`` for a function of arguments and a result, ``?a`` for one that
    may be null, else its name."""
    arguments = F.array_join(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0))), ",")
    return F.when(kind == "fun", F.concat(F.lit("("), arguments, F.lit(")->"), F.element_at(parts, -1))).when(kind == "null", F.concat(F.lit("?"), parts[0])).otherwise(name)


def type_display(types: DataFrame) -> DataFrame:
    """(id, display) of types (id, kind, name, parts: array of ids; of a function, its arguments and last its result).

    Types are shown from those without parts upwards, each once however many refer to it, in as many rounds as they are nested.
    What remains goes round in cycles or refers to such types: those are opened from the top, and a type below itself is ``#id``.  A
    part that no type has is ``?id``.  A text is as long as its type, so shared parts within cycles repeat in it.  Rounds are joined by
    shuffles: one that is broadcast goes through the driver, and over all rounds that is every text, some of them several times."""
    types = staged(types.select("id", "kind", "name", F.when(F.col("kind").isin("fun", "null"), F.coalesce("parts", F.expr("slice(array(id), 1, 0)"))).otherwise(F.expr("slice(array(id), 1, 0)")).alias("parts")), "types")
    uses = staged(types.select("id", F.posexplode("parts").alias("place", "part")), "type-uses")
    named = types.where(F.size("parts") == 0).select("id", shown(F.col("kind"), F.coalesce("name", F.lit("")), F.array(F.lit("void"))).alias("display"))
    absent = uses.join(types.select(F.col("id").alias("part")).hint("merge"), "part", "left_anti").select(F.col("part").alias("id")).distinct().select("id", F.concat(F.lit("?"), F.col("id").cast("string")).alias("display"))
    known = [staged(named.unionByName(absent), "type-texts")]
    todo = types.where(F.size("parts") > 0)
    for _ in count():
        every = reduce(DataFrame.unionByName, known)
        told = uses.join(todo.select("id").hint("merge"), "id", "left_semi").join(every.select(F.col("id").alias("part"), "display").hint("merge"), "part")
        whole = told.groupBy("id").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "display"))), lambda x: x["display"]).alias("texts"))
        new = todo.join(whole.hint("merge"), "id").where(F.size("texts") == F.size("parts")).select("id", shown(F.col("kind"), F.col("name"), F.col("texts")).alias("display"))
        new = staged(new, "type-texts")
        if new.isEmpty():
            break
        known.append(new)
        if len(known) > 12:
            known = [staged(reduce(DataFrame.unionByName, known), "type-texts")]
        todo = staged(todo.join(new.select("id").hint("merge"), "id", "left_anti"), "types")
    every = staged(reduce(DataFrame.unionByName, known), "type-texts")
    if not todo.isEmpty():
        every = every.unionByName(opened(todo, uses, every))
    return every.join(types.select("id").hint("merge"), "id", "left_semi")


def opened(types: DataFrame, uses: DataFrame, known: DataFrame) -> DataFrame:
    """(id, display) of types that reach a cycle, from the top down with the way so far, then folded from the deepest level up."""
    top = types.select(F.col("id").alias("root"), F.expr("slice(array(0), 1, 0)").alias("key"), F.array("id").alias("way"), "id", "kind", "name")
    levels = [staged(top, "type-level")]
    texts = known.select(F.col("id").alias("_id"), F.col("display").alias("_known"))
    open_ = types.select(F.col("id").alias("_open"), F.col("kind").alias("_kind"), F.col("name").alias("_name"))
    while True:
        up = levels[-1].where("kind IS NOT NULL").select("root", F.col("key").alias("_key"), F.col("way").alias("_way"), "id")
        below = up.join(uses.hint("merge"), "id").join(open_.hint("merge"), F.col("part") == F.col("_open"), "left").join(texts.hint("merge"), F.col("part") == F.col("_id"), "left")
        again = F.array_contains("_way", F.col("part"))
        below = below.select("root", F.array_append("_key", F.col("place")).alias("key"), F.array_append("_way", F.col("part")).alias("way"), F.col("part").alias("id"),
                             F.when(~again, F.col("_kind")).alias("kind"), F.when(again, F.concat(F.lit("#"), F.col("part").cast("string"))).otherwise(F.coalesce("_known", "_name")).alias("name"))
        below = staged(below, "type-level")
        if below.isEmpty():
            break
        levels.append(below)
    done = None
    for level in reversed(levels):
        leaf = level.where("kind IS NULL").select("root", "key", F.col("name").alias("display"))
        if done is not None:
            above = done.select("root", F.slice("key", F.lit(1), F.size("key") - 1).alias("key"), F.element_at("key", -1).alias("place"), "display")
            parts = above.groupBy("root", "key").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "display"))), lambda x: x["display"]).alias("texts"))
            leaf = leaf.unionByName(level.where("kind IS NOT NULL").join(parts.hint("merge"), ["root", "key"]).select("root", "key", shown(F.col("kind"), F.col("name"), F.col("texts")).alias("display")))
        done = staged(leaf, "type-folded")
    return done.select(F.col("root").alias("id"), "display")
