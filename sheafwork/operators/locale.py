"""Locales: text keys resolved into exports, availability, fillers, coverage and overlays.

leaves (locale, sheet, row, path, value): the cells of text exports.  refs (kind, id, sheet, row, path, template): text keys
of datasets, path with indices, template without."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafwork.operators.aggregates import state_counts


def resolve_text_keys(refs: DataFrame, leaves: DataFrame, locales: Sequence[str]) -> DataFrame:
    """State of every key in every locale: ok (text), empty, missing."""
    every = refs.select("*", F.explode(F.array(*map(F.lit, locales))).alias("locale"))
    hit = leaves.select("locale", "sheet", "row", "path", F.col("value").alias("text"), F.lit(True).alias("_there")).dropDuplicates(["locale", "sheet", "row", "path"])
    out = every.join(hit, ["locale", "sheet", "row", "path"], "left")
    return out.withColumn("state", F.when(F.col("_there").isNull(), "missing").when(F.coalesce("text", F.lit("")) == "", "empty").otherwise("ok")).drop("_there")


def cell_counts(cells: DataFrame) -> DataFrame:
    """ok, empty and missing cells of each kind and locale; they add up to the number of keys."""
    return state_counts(cells, ["kind", "locale"], "state", ["ok", "empty", "missing"])


def structural_cells(ids: DataFrame, leaves: DataFrame, sheet_of: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """Cells of kinds that have no text keys: ids (kind, id) joined with export rows of the kind's sheet, for leaves whose
    path matches a pattern."""
    hit = F.lit(False)
    for p in patterns:
        hit = hit | F.col("path").rlike(p)
    named = ids.join(sheet_of, "kind").select("kind", "id", "sheet", F.col("id").alias("row"))
    return named.join(leaves.where(hit), ["sheet", "row"]).select("kind", "id", "locale", "path", F.col("value").alias("text"), F.when(F.coalesce("value", F.lit("")) == "", "empty").otherwise("ok").alias("state"))


def inline_fallback(cells: DataFrame, patterns: DataFrame) -> DataFrame:
    """Inline cells (kind, id, template, …) of templates that no text key covers."""
    return patterns.join(cells.select("kind", "template").distinct(), ["kind", "template"], "left_anti")


def entity_availability(cells: DataFrame, name_template: str = "name") -> DataFrame:
    """(kind, id, available, named): locales with any text, and with a name."""
    ok = F.col("state") == "ok"
    return cells.groupBy("kind", "id").agg(F.sort_array(F.collect_set(F.when(ok, F.col("locale")))).alias("available"), F.sort_array(F.collect_set(F.when(ok & (F.col("template") == name_template), F.col("locale")))).alias("named"))


def overlays(cells: DataFrame) -> DataFrame:
    """(locale, kind, id, body): texts of an entity as a JSON object by path, keys in order."""
    pairs = F.sort_array(F.collect_list(F.struct("path", "text")))
    return cells.where("state = 'ok'").groupBy("locale", "kind", "id").agg(F.to_json(F.map_from_entries(pairs)).alias("body"))


def trimodal_breaks(availability: DataFrame, locales: Sequence[str], exceptions: DataFrame | None = None) -> DataFrame:
    """Entities whose locales are neither none, all, nor a listed exception (kind, id)."""
    whole = F.array(*map(F.lit, sorted(locales)))
    off = availability.where((F.size("available") > 0) & (F.size(F.array_except(whole, F.col("available"))) > 0))
    return off if exceptions is None else off.join(exceptions, ["kind", "id"], "left_anti")


def with_stamp(inventory: DataFrame, build_id: str) -> DataFrame:
    """Revision of each locale's file; the build id stands in where the header has none."""
    return inventory.withColumns({"stamp": F.coalesce("revision", F.lit(build_id)), "stamp_source": F.when(F.col("revision").isNull(), "buildid-fallback").otherwise("header")})
