"""Writers: datasets by kind, pair files, overlays, reports, and promotion of drafts that changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafwork.functions.reports import markdown_cells, markdown_head, markdown_lines  # noqa: F401  cells are read by those who write
from sheafwork.operators.quality import universe_diff


def write_by(df: DataFrame, path: str, by: Sequence[str], order: Sequence[str], fmt: str = "json", **options: str) -> None:
    """One folder for each value of ``by``, rows in order within each file.  Rows are dealt by the key, and adaptive execution
    splits keys that are too large for one file."""
    df.hint("rebalance", *by).sortWithinPartitions(*by, *order).write.mode("overwrite").partitionBy(*by).format(fmt).options(**options).save(path)


def write_dataset(rows: DataFrame, meta: DataFrame, path: str, order: str = "ord") -> None:
    """Rows by kind, and the headers beside them as a table of their own, so that row files hold rows only."""
    write_by(rows, f"{path}/rows", ["kind"], [order])
    meta.coalesce(1).write.mode("overwrite").json(f"{path}/meta")


def canonical_json(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One line of compact JSON a row with the keys in the order given; nulls left out."""
    return df.select(F.to_json(F.struct(*columns)).alias("value"))


def digest(df: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """A digest of each key's rows that doesn't depend on their order: counts, and sums over two row hashes."""
    h = [F.xxhash64(F.lit(s), *columns).cast("decimal(38,0)") for s in (1, 2)]
    return df.groupBy(*key).agg(F.count("*").alias("rows"), F.sha2(F.concat_ws(",", F.count("*").cast("string"), F.sum(h[0]).cast("string"), F.sum(h[1]).cast("string")), 256).alias("digest"))


def promotion_plan(draft: DataFrame, canonical: DataFrame, key: Sequence[str], columns: Sequence[str], universe: DataFrame | None = None) -> DataFrame:
    """What promoting a draft would do to each key: new, changed, unchanged, ghost (only canonical) and, against a universe,
    absent (in neither) or stray (no member of it)."""
    d, c = digest(draft, key, columns).select(*key, F.col("digest").alias("_d")), digest(canonical, key, columns).select(*key, F.col("digest").alias("_c"))
    both = d.join(c, list(key), "full_outer")
    action = F.when(F.col("_c").isNull(), "new").when(F.col("_d").isNull(), "ghost").when(F.col("_d") == F.col("_c"), "unchanged").otherwise("changed")
    out = both.select(*key, action.alias("action"))
    if universe is not None:
        off = universe_diff(universe, draft, key).select(*key, F.when(F.col("side") == "missing", "absent").otherwise("stray").alias("_off"))
        out = out.join(off, list(key), "full_outer").select(*key, F.coalesce("_off", "action").alias("action"))
    return out


def promote(draft: DataFrame, canonical_path: str, plan: DataFrame, key: Sequence[str]) -> int:
    """Writes the keys that are new or changed, each in its own partition, and leaves the others' files alone; returns how
    many.  Refuses plans with ghosts, strays or absent keys."""
    actions = {r["action"]: r["n"] for r in plan.groupBy("action").agg(F.count("*").alias("n")).collect()}
    bad = {a: n for a, n in actions.items() if a in ("ghost", "stray", "absent")}
    if bad:
        raise ValueError(f"not promoted: {bad}")
    todo = plan.where("action IN ('new', 'changed')").select(*key)
    n = actions.get("new", 0) + actions.get("changed", 0)
    if n:
        draft.join(todo, list(key), "left_semi").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*key).parquet(canonical_path)
    return n


def markdown_table(df: DataFrame, order: Sequence[str], most: int = 5000) -> str:
    """A report's table as one text.  A text on the driver is for summaries: more than ``most`` rows are refused, and markdown_lines
    or write_markdown take them."""
    rows = markdown_lines(df, order).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows: write_markdown takes any number")
    return "\n".join([*markdown_head(df.columns), *[r[0] for r in rows]]) + "\n"


def write_markdown(df: DataFrame, path: str, order: Sequence[str]) -> None:
    """The table of markdown_table as text files below path, in the order of their names; the first has the head."""
    head = df.sparkSession.createDataFrame([(line,) for line in markdown_head(df.columns)], "line string").coalesce(1)
    head.union(markdown_lines(df, order)).write.mode("overwrite").text(path)


def registry_document(layers: DataFrame, header: dict[str, str], order: Sequence[str], most: int = 5000) -> DataFrame:
    """One row (value): a JSON document of a header and the summaries of its layers, keys in the order given, layers in that of
    ``order``.  The document is one value, so it is for summaries: more than ``most`` layers are refused, and canonical_json writes
    them as a line each."""
    if layers.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} layers: canonical_json takes any number")
    rows = F.sort_array(F.collect_list(F.struct(F.struct(*order).alias("o"), F.struct(*layers.columns).alias("row"))))
    return layers.agg(F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in header.items()], F.transform(rows, lambda r: r["row"]).alias("layers"))).alias("value"))


def write_families(edges: DataFrame, path: str, order: Sequence[str] = ("from_id", "to_id")) -> DataFrame:
    """Writes evidence (from_kind, to_kind, family, from_id, to_id, method, ...) by direction, in order within each file, and returns the
    families' statistics (from_kind, to_kind, family, edges, from_ids, to_ids, methods), which are written beside as ``statistics``."""
    write_by(edges, f"{path}/edges", ["from_kind", "to_kind"], list(order))
    stats = edges.groupBy("from_kind", "to_kind", "family").agg(F.count("*").alias("edges"), F.count_distinct("from_id").alias("from_ids"), F.count_distinct("to_id").alias("to_ids"), F.array_join(F.sort_array(F.collect_set(F.substring_index("method", ":", 1))), "+").alias("methods"))
    stats.write.mode("overwrite").parquet(f"{path}/statistics")
    return edges.sparkSession.read.parquet(f"{path}/statistics")
