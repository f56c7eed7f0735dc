"""Tables as Markdown lines, and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How a cell's characters are written in a Markdown table, in the order of replacing.
ESCAPES = [("\\", "\\\\"), ("|", "\\|"), ("<br>", "\\<br>"), ("\n", "<br>")]


def replaced(c: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    for old, new in pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def markdown_lines(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """(line) of a table in Markdown: the rows in order over all tasks, for tables of any size; null is an empty cell."""
    cells = [replaced(F.coalesce(F.col(c).cast("string"), F.lit("")), ESCAPES) for c in df.columns]
    return df.orderBy(*order).select(F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"))


def markdown_head(columns: Sequence[str]) -> list[str]:
    return [f"| {' | '.join(columns)} |", f"|{'---|' * len(columns)}"]


def markdown_cells(lines: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """(…keys, column, value) of a table's lines (line) read back; heads, rules and lines of other widths are left out, and an empty
    cell is ''."""
    back = [("\\\\", "\x01"), ("\\|", "|"), ("\\<br>", "\x02"), ("<br>", "\n"), ("\x02", "<br>"), ("\x01", "\\")]
    cells = F.split(F.regexp_replace("line", r"^\| | \|$", ""), r" \| ", -1)  # a bar of a cell has a backslash before it
    own = F.col("line").rlike(r"^\| .*\|$") & (F.col("line") != markdown_head(columns)[0])
    rows = lines.where(own).select(F.transform(cells, lambda c: replaced(c, back)).alias("c")).where(F.size("c") == len(columns))
    named = rows.select(*[F.col("c")[k].alias(c) for k, c in enumerate(columns)])
    rest = [c for c in columns if c not in keys]
    return named.select(*keys, F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in rest])).alias("x")).select(*keys, "x.*")
