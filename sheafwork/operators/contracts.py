"""Contracts of published tables: declared columns, patterns, ranges and closed sets, as rows that break them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Field:
    name: str
    kind: str  # Spark's short type name
    required: bool = True
    pattern: str | None = None
    choices: Sequence[str] | None = None
    low: float | None = None
    high: float | None = None


def schema_breaks(df: DataFrame, fields: Sequence[Field], closed: bool = True) -> list[str]:
    """Columns that are missing, of another type, or not declared."""
    have, want = dict(df.dtypes), {f.name: f for f in fields}
    out = [f"{f.name}: missing" for f in fields if f.name not in have and f.required]
    out += [f"{n}: {have[n]} instead of {f.kind}" for n, f in want.items() if n in have and have[n] != f.kind]
    return out + [f"{n}: not declared" for n in have if closed and n not in want]


def _rules(f: Field) -> list[tuple[str, Column]]:
    c = F.col(f.name)
    rules = [("null", c.isNull())] if f.required else []
    if f.pattern is not None:
        rules.append(("pattern", ~c.rlike(f.pattern)))
    if f.choices is not None:
        rules.append(("choice", ~c.isin(*f.choices)))
    if f.low is not None:
        rules.append(("low", c < f.low))
    if f.high is not None:
        rules.append(("high", c > f.high))
    return rules


def row_breaks(df: DataFrame, key: Sequence[str], fields: Sequence[Field]) -> DataFrame:
    """(…key, field, rule) for every rule that a row breaks; one pass over df."""
    have = set(df.columns)
    cells = [F.when(F.coalesce(bad, F.lit(False)), F.struct(F.lit(f.name).alias("field"), F.lit(rule).alias("rule"))) for f in fields if f.name in have for rule, bad in _rules(f)]
    if not cells:
        return df.limit(0).select(*key, F.lit("").alias("field"), F.lit("").alias("rule"))
    found = F.filter(F.array(*cells), lambda x: x.isNotNull())
    return df.select(*key, F.explode(found).alias("x")).select(*key, "x.field", "x.rule")


def header_breaks(meta: DataFrame, rows: DataFrame, build_id: str) -> DataFrame:
    """Headers (kind, build_id, row_count) against rows (kind, …): another build, another count, a kind without header."""
    n = rows.groupBy("kind").agg(F.count("*").alias("_n"))
    j = meta.join(n, "kind", "full_outer")
    kinds = [("no_header", F.col("build_id").isNull()), ("build", F.col("build_id") != build_id), ("count", F.coalesce("_n", F.lit(0)) != F.col("row_count"))]
    return reduce(DataFrame.unionByName, [j.where(F.coalesce(bad, F.lit(False))).select("kind", F.lit(name).alias("rule")) for name, bad in kinds])
