"""Nested payloads in long form: one row a cell, (…key, path, norm_path, key, value, type).

A payload is JSON text, read as VARIANT once.  Containers are exploded level by level while scalars pass through, so a table is
scanned once whatever the depth, and undeclared keys come along; how many levels there are is a parameter, and deeper payloads
raise instead of losing cells.  Text that is no JSON gives no cells: :func:`malformed` lists it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafwork.functions.text import generic_path


def walk_json(df: DataFrame, keys: Sequence[str], payload: str, depth: int = 8, skip_below: Sequence[str] = ()) -> DataFrame:
    """All scalars of a JSON column, nulls left out.  skip_below: keys whose subtrees are not entered."""
    now = df.select(*keys, F.try_parse_json(F.col(payload)).alias("_v"), F.lit("").alias("path"), F.lit(None).cast("string").alias("key"), F.lit(0).alias("_depth")).where("_v IS NOT NULL")
    for _ in range(depth + 1):
        now = _level(now, keys, skip_below)
    kind = F.expr("schema_of_variant(_v)")
    cells = now.where(kind != "VOID")
    too_deep = F.raise_error(F.concat(F.lit("payload deeper than walk_json goes, below "), F.col("path"))).cast("string")
    value = F.when(F.col("_depth") > depth, too_deep).otherwise(F.expr("try_variant_get(_v, '$', 'string')"))
    return cells.where(~(kind.startswith("OBJECT") | kind.startswith("ARRAY")) | (F.col("_depth") > depth)).select(*keys, "path", generic_path(F.col("path")).alias("norm_path"), "key", value.alias("value"), kind.alias("type"))


def _level(now: DataFrame, keys: Sequence[str], skip_below: Sequence[str]) -> DataFrame:
    """Containers replaced by their children; scalars stay."""
    kept = now.columns
    opened = now.withColumn("_in_list", F.expr("schema_of_variant(_v) LIKE 'ARRAY%'")).withColumn("_open", F.expr("CASE WHEN schema_of_variant(_v) LIKE 'OBJECT%' OR schema_of_variant(_v) LIKE 'ARRAY%' THEN _v END"))
    cols = ", ".join(f"t.`{c}` AS `_t{i}`" for i, c in enumerate(kept))
    below = now.sparkSession.sql(f"SELECT {cols}, t._in_list, t._open IS NOT NULL AS _opened, e.pos AS _pos, e.key AS _key, e.value AS _child FROM {{level}} t, LATERAL variant_explode_outer(t._open) e", level=opened)
    old = {c: F.col(f"_t{i}") for i, c in enumerate(kept)}
    new = F.col("_opened")
    if skip_below:
        below = below.where(~new | F.col("_key").isNull() | ~F.col("_key").isin(*skip_below))
    step = F.when(F.col("_in_list"), F.concat(F.lit("["), F.col("_pos").cast("string"), F.lit("]"))).otherwise(F.concat(F.when(old["path"] == "", "").otherwise("."), F.col("_key")))
    key = F.when(F.col("_in_list"), F.regexp_extract(old["path"], r"([^.\[\]]+)(\[\d+\])*$", 1)).otherwise(F.col("_key"))
    return below.where(~new | F.col("_child").isNotNull()).select(
        *[old[k].alias(k) for k in keys], F.when(new, F.col("_child")).otherwise(old["_v"]).alias("_v"), F.when(new, F.concat(old["path"], step)).otherwise(old["path"]).alias("path"),
        F.when(new, key).otherwise(old["key"]).alias("key"), (old["_depth"] + new.cast("int")).alias("_depth"),
    )


def malformed(df: DataFrame, keys: Sequence[str], payload: str) -> DataFrame:
    """The ledger of payloads that are no JSON: (…keys, length, head)."""
    c = F.col(payload)
    return df.where(c.isNotNull() & F.try_parse_json(c).isNull()).select(*keys, F.length(c).alias("length"), F.left(c, F.lit(80)).alias("head"))


def at_path(cells: DataFrame, norm_path: str) -> DataFrame:
    """Cells at a generic path like ``a.b[].c``."""
    return cells.where(F.col("norm_path") == norm_path)


def below_path(cells: DataFrame, prefix: str) -> DataFrame:
    """Cells of a subtree."""
    p = F.col("norm_path")
    return cells.where((p == prefix) | p.startswith(f"{prefix}.") | p.startswith(f"{prefix}[]"))


def parent_key(cells: DataFrame, above: str) -> DataFrame:
    """Adds kind_key: the key right below ``above`` on a cell's path, which types the reference in it."""
    pattern = "(?:^|\\.)" + above.replace("[]", r"\[\d+\]") + r"\.([^.\[]+)"
    return cells.withColumn("kind_key", F.nullif(F.regexp_extract("path", pattern, 1), F.lit("")))


def typed_nodes(cells: DataFrame, keys: Sequence[str], type_key: str = "$cdbtype") -> DataFrame:
    """Objects that name their type: (…keys, node path, type)."""
    t = cells.where(F.col("key") == type_key)
    return t.select(*keys, F.regexp_replace("path", r"\.?" + type_key.replace("$", r"\$") + "$", "").alias("node"), F.col("value").alias("node_type"))


def drop_bookkeeping(cells: DataFrame, prefix: str = "_") -> DataFrame:
    return cells.where(~F.coalesce(F.col("norm_path"), F.lit("")).startswith(prefix))
