"""Data-quality guarantees as queries: each gives the rows that break it, so that an empty result means it holds."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheafwork.functions.decode import adler32, extension
from sheafwork.functions.reports import markdown_cells
from sheafwork.operators.graph import in_ranges


def multiset_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that one side has more often, with how much more: side ``missing`` (right lacks) or ``over`` (right has more).

    One aggregate over both sides with signed counts, so equal rows meet once and map-side sums keep copies cheap."""
    cols = left.columns
    signed = left.select(*cols, F.lit(1).alias("_n")).unionByName(right.select(*cols, F.lit(-1).alias("_n")))
    off = signed.groupBy(*cols).agg(F.sum("_n").alias("_n")).where("_n <> 0")
    return off.select(*cols, F.when(F.col("_n") > 0, "missing").otherwise("over").alias("side"), F.abs("_n").alias("times"))


def universe_diff(universe: DataFrame, have: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys of the universe that are missing, and keys beyond it that are extra."""
    u, h = universe.select(*on).distinct(), have.select(*on).distinct()
    return u.join(h, list(on), "left_anti").withColumn("side", F.lit("missing")).unionByName(h.join(u, list(on), "left_anti").withColumn("side", F.lit("extra")))


def reconcile(left: DataFrame, right: DataFrame, on: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Bijection of two tables on a key: class ``left_only``, ``right_only``, ``equal`` or the first column that differs.
    Values are compared null-safe."""
    a = left.select(*on, *[F.col(v).alias(f"_l_{v}") for v in values], F.lit(True).alias("_l"))
    b = right.select(*on, *[F.col(v).alias(f"_r_{v}") for v in values], F.lit(True).alias("_r"))
    both = a.join(b, list(on), "full_outer")
    kind = F.when(F.col("_r").isNull(), "left_only").when(F.col("_l").isNull(), "right_only")
    for v in values:
        kind = kind.when(~F.col(f"_l_{v}").eqNullSafe(F.col(f"_r_{v}")), f"{v}_differs")
    return both.select(*on, kind.otherwise("equal").alias("class"))


def duplicate_families(df: DataFrame, by: Sequence[str], id_: str) -> DataFrame:
    """Groups of equal keys with more than one member, their size and smallest member."""
    return df.groupBy(*by).agg(F.count("*").alias("members"), F.min(id_).alias("first_id")).where("members > 1")


def distinct_payloads(df: DataFrame, payload: Column, id_: str) -> DataFrame:
    """One row a payload: its hash, how often it occurs and the first id; payloads themselves are not shuffled."""
    return df.select(F.sha2(payload, 256).alias("hash"), id_).groupBy("hash").agg(F.count("*").alias("occurrences"), F.min(id_).alias("first_id"))


def partition_identity(parts: Sequence[DataFrame], whole: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys that are not in just one of the parts; empty if the parts are disjoint and cover the whole."""
    tagged = None
    for p in parts:
        one = p.select(*on).distinct().withColumn("_n", F.lit(1))
        tagged = one if tagged is None else tagged.unionByName(one)
    counted = tagged.groupBy(*on).agg(F.sum("_n").alias("parts"))
    return whole.select(*on).distinct().join(counted, list(on), "full_outer").select(*on, F.coalesce("parts", F.lit(0)).alias("parts")).where("parts <> 1")


def cells_on_all_layers(df: DataFrame, cell: Sequence[str], layer: str) -> DataFrame:
    """Cells that some layers lack."""
    n = df.select(F.count_distinct(layer).alias("_all"))
    return df.groupBy(*cell).agg(F.count_distinct(layer).alias("layers")).join(F.broadcast(n)).where("layers < _all").drop("_all")


def contiguity(extents: DataFrame, pos: str, size: str, by: Sequence[str] = ()) -> DataFrame:
    """Extents that don't begin where the one before ends: ``gap`` or ``overlap`` and by how much.

    Extents are compared within even ranges, and the first of a range with the last of the range before, so a group (say, a file)
    may have any number of them."""
    end = F.col(pos) + F.col(size)
    ranged = in_ranges(extents.select(*by, pos, size), by, [pos, size])
    w = Window.partitionBy(*by, "_part").orderBy(pos, size)
    last = ranged.groupBy(*by, "_part").agg(F.max_by(end, F.struct(pos, size)).alias("_last"))  # a row for each range and group
    before = F.lag("_last").over(Window.partitionBy(*by).orderBy("_part"))
    starts = last.select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("_part").alias("_at"), before.alias("_before"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by], F.col("_part") == F.col("_at"))
    first = F.row_number().over(w) == 1
    ends = ranged.join(starts, same).withColumn("_end", F.when(first, F.col("_before")).otherwise(F.lag(end).over(w))).where("_end IS NOT NULL")
    off = (F.col(pos) - F.col("_end")).alias("delta")
    return ends.where(F.col("_end") != F.col(pos)).select(*by, pos, size, F.when(F.col("_end") < F.col(pos), "gap").otherwise("overlap").alias("class"), off)


def collisions(paths: DataFrame, path: str = "path") -> DataFrame:
    """Paths that meet: repeated, equal but for case, or a file where another path needs a directory."""
    p = paths.select(F.col(path).alias("path"))
    repeated = p.groupBy("path").count().where("count > 1").select("path", F.lit("duplicate").alias("class"))
    folded = p.distinct().groupBy(F.lower("path").alias("_low")).agg(F.collect_set("path").alias("_all")).where(F.size("_all") > 1)
    by_case = folded.select(F.explode("_all").alias("path"), F.lit("case").alias("class"))
    parts = F.split("path", "/")
    above = p.where(F.size(parts) > 1).select(F.explode(F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))).alias("path")).distinct()
    return repeated.unionByName(by_case).unionByName(p.distinct().join(above, "path", "left_semi").withColumn("class", F.lit("file_and_directory")))


def fidelity(raw: DataFrame, emitted: DataFrame) -> DataFrame:
    """Cells (kind, id, path, value) that were lost, altered or invented between two planes."""
    key = ["kind", "id", "path"]
    out = reconcile(raw.where("value IS NOT NULL"), emitted.where("value IS NOT NULL"), key, ["value"]).where("class <> 'equal'")
    return out.withColumn("class", F.when(F.col("class") == "left_only", "missing").when(F.col("class") == "right_only", "invented").otherwise("altered"))


def check(df: DataFrame, id_: str, actual: Column, expected: Column) -> DataFrame:
    """One row (id, expected, actual, pass) from an aggregate over df."""
    return df.agg(actual.cast("string").alias("actual"), expected.cast("string").alias("expected")).select(F.lit(id_).alias("id"), "expected", "actual", F.col("actual").eqNullSafe(F.col("expected")).alias("pass"))


def empty_check(df: DataFrame, id_: str) -> DataFrame:
    """Passes if df has no rows."""
    return check(df, id_, F.count("*"), F.lit("0"))


def report(*checks: DataFrame) -> DataFrame:
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


class QualityError(AssertionError):
    pass


def require(checks: DataFrame) -> DataFrame:
    """The report itself if all its checks pass, else an error that names those that don't."""
    failed = checks.where(~F.col("pass")).limit(20).collect()
    if failed:
        raise QualityError("; ".join(f"{r['id']}: {r['actual']} instead of {r['expected']}" for r in failed))
    return checks


def known_answers(texts: DataFrame, id_: str, text: str, answers: DataFrame) -> DataFrame:
    """(id, needle, found): whether each known answer (id, needle) stands in the text of its id; false too where there is no text.
    Of texts that share an id, any will do."""
    both = answers.select(F.col("id").alias("_id"), "needle").distinct().join(texts.select(F.col(id_).alias("_of"), F.col(text).alias("_text")), F.col("_id") == F.col("_of"), "left")
    return both.groupBy(F.col("_id").alias("id"), "needle").agg(F.coalesce(F.bool_or(F.contains("_text", "needle")), F.lit(False)).alias("found"))


def member_proofs(members: DataFrame, by: Sequence[str], nth: int, magics: dict[str, str]) -> DataFrame:
    """(…by, ext, path, size, magic, checksum) of the nth path of each archive and ending, by path: content against the bytes its
    ending asks for (hex; n/a for endings without any) and against the stored Adler-32 (path, content, stored).  Only the chosen
    paths' contents are read for the sums: the choice is made on paths, under a group limit."""
    paths = members.select(*by, extension(F.col("path")).alias("ext"), "path").distinct()
    rank = F.row_number().over(Window.partitionBy(*by, "ext").orderBy("path"))
    chosen = paths.withColumn("_n", rank).where(F.col("_n") <= nth).where(F.col("_n") == nth).drop("_n")
    got = chosen.join(members.select(*by, "path", "content", "stored"), [*by, "path"])
    head, want = F.hex(F.substring("content", 1, 16)), F.lit(None).cast("string")
    for ext, magic in magics.items():
        want = F.when(F.col("ext") == ext, magic.upper()).otherwise(want)
    verdict = lambda ok: F.when(ok, "MATCH").otherwise("MISMATCH")
    return got.select(*by, "ext", "path", F.length("content").cast("bigint").alias("size"), F.when(want.isNull(), "n/a").otherwise(verdict(head.startswith(want))).alias("magic"), verdict(F.coalesce(adler32(F.col("content")) == F.col("stored"), F.lit(False))).alias("checksum"))


def table_digest(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row (rows, digest) of a table's cells as text, whatever the order of its rows; any engine with MD5 can say it."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    hash_ = F.md5(text.cast("binary"))
    part = lambda at: F.coalesce(F.sum(F.conv(F.substring(hash_, at, 15), 16, 10).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))
    sums = df.agg(F.count("*").alias("rows"), part(1).alias("_a"), part(16).alias("_b"))
    return sums.select("rows", F.sha2(F.concat_ws(",", "rows", "_a", "_b").cast("binary"), 256).alias("digest"))


def catalog_parity(matrix: DataFrame, lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(…keys, column, matrix, rendered, class) of the cells in which a report's lines (line) are not as the matrix: ``differs``,
    ``missing`` from the report or ``extra`` in it; and one row without keys, class ``marker``, if the line ``<!-- digest: … -->``
    doesn't have the matrix's digest.  Empty if the report was made of this matrix."""
    columns = matrix.columns
    rest = [c for c in columns if c not in keys]
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    own = matrix.select(*[text(k).alias(k) for k in keys], F.explode(F.array(*[F.struct(F.lit(c).alias("column"), text(c).alias("matrix")) for c in rest])).alias("x")).select(*keys, "x.*")
    shown = markdown_cells(lines, columns, keys).withColumnRenamed("value", "rendered")
    both = own.join(shown, [*keys, "column"], "full_outer")
    kind = F.when(F.col("rendered").isNull(), "missing").when(F.col("matrix").isNull(), "extra").when(F.col("matrix") != F.col("rendered"), "differs")
    cells = both.withColumn("class", kind).where("class IS NOT NULL").select(*keys, "column", "matrix", "rendered", "class")
    marker = lines.select(F.regexp_extract("line", r"^<!-- digest: ([0-9a-f]{64}) -->$", 1).alias("m")).where("m <> ''").agg(F.max("m").alias("rendered"))
    stale = table_digest(matrix, columns).select(F.col("digest").alias("matrix")).join(marker).where(~F.col("matrix").eqNullSafe(F.col("rendered")))  # a row each
    return cells.unionByName(stale.select(F.lit("digest").alias("column"), "matrix", "rendered", F.lit("marker").alias("class")), allowMissingColumns=True)


def rederived(edges: DataFrame, rows: DataFrame, ids: DataFrame) -> DataFrame:
    """edges (from_kind, to_kind, from_id, to_id, path) with proof: what a second way to each edge's evidence says.  The cell at the
    edge's path is read anew from the raw row (kind, id, row as JSON) and held against the target: ``ok``, ``no_row``, ``no_cell``,
    ``other_value``, or ``dangling`` where no id of the target kind is meant."""
    raw = rows.select(F.col("kind").alias("from_kind"), F.col("id").alias("from_id"), F.col("row").alias("_row"))
    known = ids.select(F.col("kind").alias("to_kind"), F.col("id").cast("string").alias("to_id"), F.lit(True).alias("_known")).distinct()
    at = edges.join(raw, ["from_kind", "from_id"], "left").join(known, ["to_kind", "to_id"], "left")
    value = F.call_function("get_json_object", F.col("_row"), F.concat(F.lit("$."), F.col("path")))
    proof = F.when(F.col("_row").isNull(), "no_row").when(value.isNull(), "no_cell").when(value != F.col("to_id"), "other_value").when(F.col("_known").isNull(), "dangling").otherwise("ok")
    return at.select(*edges.columns, proof.alias("proof"))


def strata_proofs(edges: DataFrame, proved: DataFrame) -> DataFrame:
    """(from_kind, to_kind, edges, drawn, ok) of every direction: a direction that gave no sample shows as 0 drawn."""
    by = ["from_kind", "to_kind"]
    drawn = proved.groupBy(*by).agg(F.count("*").alias("drawn"), F.count_if(F.col("proof") == "ok").alias("ok"))
    out = edges.groupBy(*by).agg(F.count("*").alias("edges")).join(drawn, by, "left")
    return out.select(*by, "edges", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("drawn", "ok")])


def off_expectation(found: DataFrame, expected: DataFrame, by: Sequence[str]) -> DataFrame:
    """(…by, measure, found, expected) of the measures in which classes are not exactly as expected; a class that one side lacks has
    null there."""
    measures = [c for c in expected.columns if c not in by]
    tall = lambda df, name: df.select(*by, F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("string").alias(name)) for m in measures])).alias("x")).select(*by, "x.*")
    both = tall(found, "found").withColumn("_f", F.lit(True)).join(tall(expected, "expected").withColumn("_e", F.lit(True)), [*by, "measure"], "full_outer")
    return both.where(F.col("_f").isNull() | F.col("_e").isNull() | ~F.col("found").eqNullSafe(F.col("expected"))).select(*by, "measure", "found", "expected")


def preconditions(facts: DataFrame, expected: DataFrame) -> DataFrame:
    """(stage, fact, found, wanted, message) of the facts (fact, found) that a stage needs and doesn't have, by expected (fact, wanted,
    stage, owner): the message names the stage that has to run first."""
    at = expected.join(facts, "fact", "left").where(~F.col("found").eqNullSafe(F.col("wanted")))
    said = F.format_string("%s needs %s = %s, found %s: run %s first", "stage", "fact", F.col("wanted").cast("string"), F.coalesce(F.col("found").cast("string"), F.lit("nothing")), "owner")
    return at.select("stage", "fact", "found", "wanted", said.alias("message"))


def subset_residue(part: DataFrame, whole: DataFrame, residue: DataFrame, on: Sequence[str]) -> DataFrame:
    """(…on, rule) of the keys that break ``part is within whole, and what it lacks is just the residue``: ``stray`` (in part, not in
    whole), ``unexplained`` (lacking, but not in the residue) and ``present`` (in the residue, but not lacking)."""
    keyed = lambda df, name: df.select(*on).distinct().withColumn(name, F.lit(True))
    every = keyed(whole, "_w").join(keyed(part, "_p"), list(on), "full_outer").join(keyed(residue, "_r"), list(on), "full_outer")
    w, p, r = (F.coalesce(c, F.lit(False)) for c in ("_w", "_p", "_r"))
    rule = F.when(p & ~w, "stray").when(w & ~p & ~r, "unexplained").when(r & (p | ~w), "present")
    return every.withColumn("rule", rule).where("rule IS NOT NULL").select(*on, "rule")
