"""Sheet databases: dictionary, ids, schema-driven cells, localizable references, edges.

dictionary (sheet, name, type_str, opt, kind), lines (sheet, ord, row JSON text).  A list column ``c`` of sheet ``s`` has its
own dictionary under ``s@c``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafwork.functions.decode import type_code, type_param
from sheafwork.operators.ordinals import synthetic_ids
from sheafwork.operators.relations import EDGE, resolve
from sheafwork.operators.walk import walk_json


def identified(dictionary: DataFrame, lines: DataFrame) -> DataFrame:
    """Lines with their id: the column of code 0, or ``<sheet>-NNNN`` where the sheet has none."""
    keys = dictionary.where(type_code(F.col("type_str")) == "0").groupBy("sheet").agg(F.min("name").alias("_id_col"))
    at = lines.join(keys, "sheet", "left")
    own = at.where("_id_col IS NOT NULL").withColumn("id", F.expr("get_json_object(row, concat('$.', _id_col))"))
    made = synthetic_ids(at.where("_id_col IS NULL"), "", ["ord"], by=["sheet"]).withColumn("id", F.concat("sheet", "id"))
    return own.unionByName(made).drop("_id_col")


def declared_cells(dictionary: DataFrame, lines: DataFrame, depth: int = 6) -> DataFrame:
    """Cells of all lines (sheet, id, path, norm_path, value) with the dictionary entry of their column: schema, name, code,
    param, kind.  Undeclared keys stay, with code null."""
    cells = walk_json(identified(dictionary, lines).select("sheet", "id", "row"), ["sheet", "id"], "row", depth)
    bare = F.regexp_replace("norm_path", r"\[\]", "")
    above = F.regexp_replace(bare, r"\.?[^.]*$", "")
    schema = F.when(above == "", F.col("sheet")).otherwise(F.concat(F.col("sheet"), F.lit("@"), F.regexp_replace(above, r"\.", "@")))
    d = dictionary.select(F.col("sheet").alias("schema"), F.col("name").alias("column"), type_code(F.col("type_str")).alias("code"), type_param(F.col("type_str")).alias("param"), F.col("kind").alias("column_kind"))
    return cells.withColumns({"schema": schema, "column": F.regexp_replace(bare, r"^.*\.", "")}).join(d, ["schema", "column"], "left")


def undeclared(cells: DataFrame) -> DataFrame:
    """How often each undeclared key occurs."""
    return cells.where("code IS NULL").groupBy("schema", "column").agg(F.count("*").alias("cells"))


def text_keys(cells: DataFrame, bridge: str = "export_cdb") -> DataFrame:
    """Localizable cells as references into the text export."""
    sub = F.when(F.contains("schema", F.lit("@")), F.substring_index("schema", "@", -1))
    ref = F.struct(F.lit(bridge).alias("bridge"), F.col("sheet"), F.col("column"), F.col("id").alias("row"), sub.alias("subSheet"))
    return cells.where("code = '1' AND column_kind = 'localizable'").withColumn("textKey", F.to_json(ref))


def sheet_edges(dictionary: DataFrame, lines: DataFrame, kind_of: DataFrame | None = None, depth: int = 6) -> DataFrame:
    """Edges of all reference cells with their verdict.  kind_of (sheet, kind) names sheets whose kind differs."""
    cells = declared_cells(dictionary, lines, depth).where("code = '6'")
    ids = identified(dictionary, lines).select(F.col("sheet").alias("kind"), "id")
    refs = cells.select(F.col("sheet").alias("from_kind"), F.substring_index("param", "@", 1).alias("to_kind"), F.col("id").alias("from_id"), F.col("value").alias("to_id"), "column", F.lit("hard").alias("mechanism"))
    out = resolve(refs, ids).select(*EDGE)
    if kind_of is None:
        return out
    for side in ("from_kind", "to_kind"):
        names = kind_of.select(F.col("sheet").alias(side), F.col("kind").alias("_kind"))
        out = out.join(names, side, "left").withColumn(side, F.coalesce("_kind", side)).drop("_kind")
    return out.select(*EDGE)


def unadmitted(dictionary: DataFrame, cells: DataFrame, admitted: DataFrame, negated: DataFrame | None = None) -> DataFrame:
    """Columns that no carrier admits, by class: negated (listed in negated (schema, column): its references say what must not be, and
    are no relations), schema_empty (never filled), compound_empty and compound_filled (a list or custom column) or plain."""
    filled = cells.groupBy("schema", "column").agg(F.count("*").alias("_n"))
    below = cells.select(F.explode(F.transform(F.sequence(F.lit(1), F.size(F.split("schema", "@"))), lambda n: F.array_join(F.slice(F.split("schema", "@"), F.lit(1), n), "@"))).alias("_s")).groupBy("_s").agg(F.count("*").alias("_below"))
    d = dictionary.select(F.col("sheet").alias("schema"), F.col("name").alias("column"), type_code(F.col("type_str")).alias("code"))
    d = d.join(admitted.select("schema", "column").distinct(), ["schema", "column"], "left_anti").join(filled, ["schema", "column"], "left")
    d = d.withColumn("_s", F.concat_ws("@", "schema", "column")).join(below, "_s", "left").drop("_s")
    compound = F.col("code").isin("8", "9", "17")
    n = F.coalesce(F.col("_n"), F.lit(0)) + F.coalesce(F.col("_below"), F.lit(0))
    says_not = F.lit(False)
    if negated is not None:
        d = d.join(negated.select("schema", "column", F.lit(True).alias("_not")).distinct(), ["schema", "column"], "left")
        says_not = F.col("_not").isNotNull()
    return d.select("schema", "column", "code", n.alias("cells"), F.when(says_not, "negated").when(n == 0, F.when(compound, "compound_empty").otherwise("schema_empty")).when(compound, "compound_filled").otherwise("plain").alias("class"))
