"""Censuses, histograms, availability and agreement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def totals_with_grand(df: DataFrame, by: str, label: str = "TOTAL", **sums: Column) -> DataFrame:
    """Subtotals of each group and the grand total in one pass."""
    out = df.rollup(by).agg(F.grouping(by).alias("_g"), *[c.alias(k) for k, c in sums.items()])
    return out.withColumn(by, F.when(F.col("_g") == 1, F.lit(label)).otherwise(F.col(by))).drop("_g")


def unreconciled(totals: DataFrame, by: str, measures: Sequence[str], label: str = "TOTAL") -> DataFrame:
    """Measures whose subtotals don't add up to the grand total."""
    return totals.agg(*[(F.sum(F.when(F.col(by) != label, F.col(m))) - F.sum(F.when(F.col(by) == label, F.col(m)))).alias(m) for m in measures]).where(" OR ".join(f"{m} <> 0" for m in measures))


def histogram(df: DataFrame, *by: str, weight: Column | None = None) -> DataFrame:
    """Count (and bytes) of each value with its share of the whole, most first."""
    n = df.groupBy(*by).agg(F.count("*").alias("n"), *([F.sum(weight).alias("weight")] if weight is not None else []))
    whole = n.agg(F.sum("weight" if weight is not None else "n").alias("_all"))
    return n.join(F.broadcast(whole)).withColumn("share", F.col("weight" if weight is not None else "n") / F.col("_all")).drop("_all").orderBy(F.desc("n"), *by)


def state_counts(df: DataFrame, by: Sequence[str], state: str, states: Sequence[str]) -> DataFrame:
    """Columns n_<state> for each of the declared states: a pivot whose columns are known, so no extra pass."""
    return df.groupBy(*by).agg(*[F.count_if(F.col(state) == s).alias(f"n_{s.lower()}") for s in states])


def availability(cells: DataFrame, entity: Sequence[str], locale: str, named: Column) -> DataFrame:
    """For each entity: where it is available, where it is named (sorted), both as arrays."""
    return cells.groupBy(*entity).agg(F.sort_array(F.collect_set(locale)).alias("available"), F.sort_array(F.collect_set(F.when(named, F.col(locale)))).alias("named"))


def field_availability(cells: DataFrame, entity: Sequence[str], locale: str, template: str, present: Column) -> DataFrame:
    """fields: locale -> template -> whether the cell has text."""
    one = cells.groupBy(*entity, locale, template).agg(F.bool_or(present).alias("_p"))
    inner = one.groupBy(*entity, locale).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(template, "_p")))).alias("_m"))
    return inner.groupBy(*entity).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col(locale), F.to_json("_m").alias("_j"))))).alias("fields"))


def fillers(cells: DataFrame, entity: Sequence[str], locale: str, of: int) -> DataFrame:
    """Entities that some but not all locales have."""
    n = F.count_distinct(locale)
    return cells.groupBy(*entity).agg(n.alias("locales"), F.array_join(F.sort_array(F.collect_set(locale)), ",").alias("where")).where((F.col("locales") > 0) & (F.col("locales") < of))


def coverage(keys: DataFrame, key: str, locale: str, pivot: str, filled: Column) -> DataFrame:
    """Each locale against the pivot: keys, filled ones, those the pivot has and it lacks, and the other way round."""
    own = keys.groupBy(key, locale).agg(F.bool_or(filled).alias("_f"))
    base = own.where(F.col(locale) == pivot).select(F.col(key).alias("_k"))
    size = base.agg(F.count("*").alias("_all"))
    hit = own.join(base, F.col(key) == F.col("_k"), "left")
    out = hit.groupBy(locale).agg(F.count("*").alias("keys"), F.count_if("_f").alias("filled"), F.count_if(F.col("_k").isNotNull()).alias("_in"), F.count_if(F.col("_k").isNull()).alias("extra"))
    return out.join(F.broadcast(size)).select(locale, "keys", "filled", (F.col("_all") - F.col("_in")).alias("missing"), "extra")


def confusion(df: DataFrame, truth: Column, guess: Column) -> DataFrame:
    """tp, fp, fn, tn, iou and accuracy."""
    tp, fp, fn, tn = F.count_if(truth & guess), F.count_if(~truth & guess), F.count_if(truth & ~guess), F.count_if(~truth & ~guess)
    return df.agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn")).select("tp", "fp", "fn", "tn", F.try_divide("tp", F.col("tp") + F.col("fp") + F.col("fn")).alias("iou"), F.try_divide(F.col("tp") + F.col("tn"), F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("accuracy"))


def agreement(df: DataFrame, by: str, agrees: Column, gate: float, label: str = "ALL") -> DataFrame:
    """Share that agrees for each group and over all, against a gate."""
    out = df.rollup(by).agg(F.grouping(by).alias("_g"), F.count("*").alias("n"), F.avg(agrees.cast("double")).alias("rate"))
    return out.select(F.when(F.col("_g") == 1, F.lit(label)).otherwise(F.col(by)).alias(by), "n", "rate", (F.col("rate") >= gate).alias("pass"))


def majority(df: DataFrame, by: Sequence[str], label: str) -> DataFrame:
    """The most frequent label of each group; the smallest of equally frequent ones."""
    n = df.groupBy(*by, label).agg(F.count("*").alias("_n"))
    return n.groupBy(*by).agg(F.min_by(label, F.struct(-F.col("_n"), F.col(label))).alias("majority"), F.max("_n").alias("votes"))


def slope_through_origin(x: Column, y: Column) -> Column:
    return F.sum(x * y) / F.sum(x * x)


def affine_fit(points: DataFrame, x: str, y: str, z: str) -> DataFrame:
    """Least-squares a, b, c of z = a x + b y + c: sums in one pass, the 3 x 3 normal equations by Cramer's rule.
    Null where the points lie on one line."""
    s = points.where(F.col(x).isNotNull() & F.col(y).isNotNull() & F.col(z).isNotNull()).agg(
        F.count("*").cast("double").alias("n"), F.avg(x).alias("mx"), F.avg(y).alias("my"), F.avg(z).alias("mz"),
        F.covar_pop(x, x).alias("xx"), F.covar_pop(y, y).alias("yy"), F.covar_pop(x, y).alias("xy"), F.covar_pop(x, z).alias("xz"), F.covar_pop(y, z).alias("yz"),
    )
    c = {k: F.col(k) for k in ("n", "mx", "my", "mz", "xx", "yy", "xy", "xz", "yz")}
    det = c["xx"] * c["yy"] - c["xy"] * c["xy"]
    a = F.when(F.abs(det) > 1e-12 * (c["xx"] * c["yy"] + F.lit(1e-300)), (c["xz"] * c["yy"] - c["yz"] * c["xy"]) / det)
    b = F.when(F.abs(det) > 1e-12 * (c["xx"] * c["yy"] + F.lit(1e-300)), (c["yz"] * c["xx"] - c["xz"] * c["xy"]) / det)
    return s.withColumns({"a": a, "b": b}).withColumn("c", c["mz"] - F.col("a") * c["mx"] - F.col("b") * c["my"]).select("n", "a", "b", "c")


def sheet_census(dictionary: DataFrame, lines: DataFrame, cells: DataFrame) -> DataFrame:
    """Rows, columns, grid and populated cells of each sheet, and which sheets refer to it.

    dictionary (sheet, name, code, param), lines (sheet, ord), cells (sheet, ord, name, value)."""
    rows = lines.groupBy("sheet").agg(F.count("*").alias("rows"))
    cols = dictionary.groupBy("sheet").agg(F.count("*").alias("cols"))
    full = cells.where("value IS NOT NULL").groupBy("sheet").agg(F.count("*").alias("populated"))
    refs = dictionary.where("code = '6'").groupBy(F.substring_index("param", "@", 1).alias("sheet")).agg(F.array_join(F.sort_array(F.collect_set("sheet")), ",").alias("referenced_by"))
    out = cols.join(rows, "sheet", "full_outer").join(full, "sheet", "left").join(refs, "sheet", "left")
    z = lambda c: F.coalesce(c, F.lit(0))
    return out.select("sheet", z("rows").alias("rows"), z("cols").alias("cols"), (z("rows") * z("cols")).alias("grid"), z("populated").alias("populated"), F.coalesce("referenced_by", F.lit("")).alias("referenced_by"))


def throughput(df: DataFrame, by: Sequence[str], at: str, size: str) -> DataFrame:
    """Rows, summed size, seconds from the first to the last row and size a second (null where these are one moment)."""
    seconds = (F.unix_micros(F.max(at)) - F.unix_micros(F.min(at))) / 1e6
    out = df.groupBy(*by).agg(F.count("*").alias("rows"), F.sum(size).alias("size"), seconds.alias("seconds"))
    return out.withColumn("rate", F.col("size") / F.nullif(F.col("seconds"), F.lit(0.0)))


def counts_by_place(rows: DataFrame, place: str, names: DataFrame, unknown: str = "unknown") -> DataFrame:
    """(id, n): rows counted by the name (place, id) of their place; places without one count as unknown.  Rows are added up before
    they are joined."""
    sums = rows.groupBy(place).agg(F.count("*").alias("_n"))
    known = names.select(F.col("place").alias("_place"), "id")
    return sums.join(known, F.col(place) == F.col("_place"), "left").groupBy(F.coalesce("id", F.lit(unknown)).alias("id")).agg(F.sum("_n").alias("n"))


def classified(rows: DataFrame, root: Column, families: DataFrame, other: str = "other") -> DataFrame:
    """rows with the family (root, family) of their root, else ``other``."""
    at = rows.withColumn("_root", root).join(families.select(F.col("root").alias("_of"), "family"), F.col("_root") == F.col("_of"), "left")
    return at.withColumn("family", F.coalesce("family", F.lit(other))).drop("_root", "_of")


def coverage_by(used: DataFrame, by: str, key: str, bridge: DataFrame) -> DataFrame:
    """(by, used, bridged, beyond): how many different keys each group uses, and how many of them a bridge (key) has and lacks."""
    have = bridge.select(F.col(key).alias("_key")).distinct()
    at = used.select(by, key).distinct().join(have, F.col(key) == F.col("_key"), "left")
    return at.groupBy(by).agg(F.count("*").alias("used"), F.count("_key").alias("bridged"), F.count_if(F.col("_key").isNull()).alias("beyond"))


def group_reach(points: DataFrame, by: str, distance: str, land: str) -> DataFrame:
    """(by, points, low, mid, high, on_land) of points with a distance: its range and median, and the share of all points of the group
    that are known to be on land."""
    on = F.avg(F.coalesce(F.col(land), F.lit(False)).cast("double"))
    return points.groupBy(by).agg(F.count("*").alias("points"), F.min(distance).alias("low"), F.median(distance).alias("mid"), F.max(distance).alias("high"), on.alias("on_land"))
