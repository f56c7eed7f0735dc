"""Operator 13, repair of conversations: fault flags from windows, and a fold over a conversation's sorted turns that carries the
cheapest edits for each of four states.

Rows are damaged first, by a hash of conversation and turn, as a planted test of the repair: dropped, emptied, without marks that
end a sentence, repeated, or with the role user.  A conversation's rows go by turn (nulls first), then role and text as UTF-8.  A
row's first fault counts: blank, duplicate, truncated.  The repair then chooses for each row to keep, rerole or delete it, and where
to insert turns without text, so that the roles are an optional system turn and then user and assistant in turn.  aggregate() folds
the rows: its state is the cheapest (cost, audit) of having nothing yet, a system turn, a user turn or an assistant turn last, and a
step is least() over the edits that lead there.  Audits of equal cost compare as text.  An edit is two characters of the audit: its
initial, and that of the role it leads to, which the initials before it decide; so the order of audits is that of their initials,
and the repaired text can be read off.

A conversation of up to MOST_ROWS rows and MOST_BYTES of text is one row of Spark.  A larger one is cut into even ranges of its
order; each range is folded from each of the four states, and the four by four results are folded in turn: cheapest ways through
consecutive ranges add up.  Its repaired text is hashed as a stream of the ranges' texts, one range in memory at a time.

Defined cases: null ids and turns are written as one space where the damage is drawn, null roles and texts are one space; a null
conv_id is a conversation of its own; rows alike in all columns are rows of their own, the later ones duplicates; an empty role fits
no place, and a row that has one is reroled or deleted; texts of any length go whole; a turn range beyond bigint gives null gaps;
a conversation all of whose rows are dropped has zeros, an empty audit and the hash of the empty text; an empty table gives no rows;
columns other than conv_id, turn, role and text are dropped, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheafwork.llm.shared import staged, table

KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 3, 4, 3, 3
#: A cost that no real repair has: of states that can't be reached, and of edits that aren't allowed.
NEVER = 1 << 40
#: Rows and bytes of text of a conversation that one row may hold, and of a range of larger ones.
MOST_ROWS, MOST_BYTES = 4096, 32 << 20
SPACES = " \t\n\x0b\x0c\r"
STATES = ["e", "s", "u", "a"]  # nothing yet; the last turn is the system's, a user's, an assistant's
LEGAL = ["su", "ua", "au"]
EMPTY_HASH = hashlib.sha256(b"").hexdigest()


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): copies is 0 for dropped rows, 2 for repeated ones."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate(spaced("text"), ".!?", "")).otherwise(spaced("text"))
    role = F.when(F.col("_kind") == 4, "user").otherwise(spaced("role"))
    copies = F.when(F.col("_kind") == 0, 0).when(F.col("_kind") == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", "role", "text").withColumn("_kind", kind).select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copies"))


def with_faults(rows: DataFrame, first: Column) -> DataFrame:
    """rows with ini (the role's initial), must (go), blank, duplicate, truncated; first: no equal row is before it."""
    end = F.right(F.rtrim(F.col("text"), F.lit(SPACES)), F.lit(1))
    blank = end == ""
    out = rows.withColumns({"ini": F.left("role", F.lit(1)), "blank": blank, "duplicate": ~blank & ~first})
    return out.withColumns({"truncated": ~F.col("blank") & ~F.col("duplicate") & ~end.isin(".", "!", "?"), "must": F.col("blank") | F.col("duplicate")})


# -- the fold --------------------------------------------------------------------------------------------------------------


def way(cost: Column | int, audit: Column | str) -> Column:
    return F.struct(F.lit(cost).cast("bigint").alias("cost") if isinstance(cost, int) else cost.alias("cost"), (F.lit(audit) if isinstance(audit, str) else audit).alias("audit"))


def then(before: Column, cost: Column | int, edit: str) -> Column:
    return way(before["cost"] + cost, F.concat(before["audit"], F.lit(edit)))


def begun(state: str) -> Column:
    return F.struct(*[way(0 if s == state else NEVER, "").alias(s) for s in STATES])


def bound(value: Column, f) -> Column:
    """f(value), with value computed once."""
    return F.transform(F.array(value), f)[0]


def step(ways: Column, row: Column) -> Column:
    """The cheapest ways after one row: a turn may be inserted before it, then it is kept, reroled or deleted."""
    late = F.when(row["truncated"], UNFINISHED).otherwise(0).cast("bigint") + F.when(row["must"], NEVER).otherwise(0)
    kept = lambda initial: late + F.when(row["ini"] == initial, KEEP).otherwise(NEVER)
    user = F.least(ways["u"], *[then(ways[s], INSERT, "Iu") for s in ("e", "s", "a")])
    opened = F.struct(ways["e"].alias("e"), ways["s"].alias("s"), user.alias("u"), F.least(ways["a"], then(ways["u"], INSERT, "Ia")).alias("a"))

    def edited(w: Column) -> Column:
        from_ = F.least(w["e"], w["s"], w["a"])
        gone = lambda s: then(w[s], DELETE, "D-")
        return F.struct(
            gone("e").alias("e"),
            F.least(gone("s"), then(w["e"], kept("s"), "Ks")).alias("s"),
            F.least(gone("u"), then(from_, kept("u"), "Ku"), then(from_, late + REROLE, "Ru")).alias("u"),
            F.least(gone("a"), then(w["u"], kept("a"), "Ka"), then(w["u"], late + REROLE, "Ra")).alias("a"),
        )

    again = row["copies"] - 1  # equal rows behind it, which all go
    out = bound(opened, edited)
    more = lambda w: F.struct(*[way(w[s]["cost"] + again * DELETE, F.concat(w[s]["audit"], F.repeat(F.lit("d-"), again.cast("int")))).alias(s) for s in STATES])
    return F.when(again > 0, bound(out, more)).otherwise(out)


def ended(ways: Column) -> Column:
    return F.least(ways["e"], ways["a"], then(ways["u"], INSERT, "Ia"), then(ways["s"], 2 * INSERT, "IuIa"))


def initials(audit: Column) -> Column:
    return F.upper(F.regexp_replace(audit, "(.).", "$1"))


def repaired(turns: Column, audit: Column) -> Column:
    """The lines role:text that the edits leave of the turns, joined; empty if there are none."""
    edits = F.regexp_extract_all(F.replace(audit, F.lit("d-"), F.lit("")), F.lit("(?:I[ua])*[DKR].|(?:I[ua])+$"), F.lit(0))
    insert = lambda e: F.when(e.startswith("IuIa"), F.array(F.lit("user:"), F.lit("assistant:"))).when(e.startswith("Iu"), F.array(F.lit("user:"))).when(e.startswith("Ia"), F.array(F.lit("assistant:"))).otherwise(F.array().cast("array<string>"))
    line = lambda e, t: F.when(e.endswith("Ru"), F.concat(F.lit("user:"), t["text"])).when(e.endswith("Ra"), F.concat(F.lit("assistant:"), t["text"])).when(F.substring(e, -2, 1) == "K", F.concat(t["role"], F.lit(":"), t["text"]))
    lines = F.zip_with(turns, edits, lambda t, e: F.array_append(insert(e), line(e, t)))
    return F.array_join(F.flatten(lines), "\n")


def turns_list(rows: Column | None = None) -> Column:
    fields = F.struct("pos", "ini", "must", "truncated", "copies", "role", "text")
    return F.sort_array(F.collect_list(fields if rows is None else F.when(rows, fields)))


def gaps(least: Column, most: Column, distinct: Column) -> Column:
    wide = lambda c: c.cast("decimal(38,0)")
    return F.coalesce((wide(most) - wide(least) + 1 - wide(distinct)).try_cast("bigint"), F.when(least.isNull(), F.lit(0).cast("bigint")))


ORDER = [F.asc_nulls_first, F.asc, F.asc]


def in_order() -> list[Column]:
    return [f(c) for f, c in zip(ORDER, ("turn", "role", "text"))]


def is_illegal(before: Column) -> Column:
    return before.isNotNull() & ~F.concat(before, "ini").isin(LEGAL)


def small_conversations(rows: DataFrame) -> DataFrame:
    """Conversations that each fit one row; rows as of damaged()."""
    there = F.col("copies") > 0
    dealt = rows.repartition("conv_id").withColumn("there", there)
    every = dealt.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.greatest("copies", F.lit(1))))).drop("_copy").withColumn("copies", F.lit(1))
    nth = F.row_number().over(Window.partitionBy("conv_id", "there", "role", "text").orderBy(F.asc_nulls_first("turn")))
    own = Window.partitionBy("conv_id", "there").orderBy(*in_order())
    flagged = with_faults(every.withColumn("nth", nth), F.col("nth") == 1).withColumns({"pos": F.row_number().over(own), "before": F.lag("ini").over(own)})
    count = lambda c: F.sum(F.when(F.col("there") & c, 1).otherwise(0)).cast("bigint")
    turn = F.when(F.col("there"), F.col("turn"))
    grouped = flagged.groupBy("conv_id").agg(
        F.min(turn).alias("least"), F.max(turn).alias("most"), F.size(F.collect_set(turn)).alias("distinct"), count(F.col("blank")).alias("blank"), count(F.col("duplicate")).alias("duplicate"),
        count(F.col("truncated")).alias("truncated"), count(is_illegal(F.col("before"))).alias("illegal"), turns_list(F.col("there")).alias("turns"),
    )
    best = grouped.withColumn("best", F.aggregate("turns", begun("e"), step, ended))
    return best.select(
        "conv_id", gaps(F.col("least"), F.col("most"), F.col("distinct")).alias("gaps"), "blank", "duplicate", "truncated", "illegal", F.col("best.cost").alias("cost"),
        initials(F.col("best.audit")).alias("audit"), F.sha2(repaired(F.col("turns"), F.col("best.audit")).cast("binary"), 256).alias("repaired_sha256"),
    )


# -- conversations larger than a row ---------------------------------------------------------------------------------------


def same_conv(a: str, b: str = "conv_id") -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def composed(ways: Column, part: Column) -> Column:
    """ways with the ways through one more range: part has part.through[state][state]."""
    ends = []
    for to in STATES:
        tries = [F.struct(F.least(ways[s]["cost"] + part["through"][s][to]["cost"], F.lit(NEVER)).alias("cost"), F.concat(ways[s]["audit"], part["through"][s][to]["audit"]).alias("audit"),
                          F.array_append(ways[s]["parts"], F.struct(part["chunk"].alias("chunk"), part["through"][s][to]["audit"].alias("audit"))).alias("parts")) for s in STATES]
        ends.append(F.least(*tries).alias(to))
    return F.struct(*ends)


def streamed_hashes(pieces: DataFrame) -> DataFrame:
    """(conv, repaired_sha256) of pieces (conv, chunk, piece) of texts: the non-empty ones in order, joined by line feeds.  A
    conversation's pieces pass through one task, one batch at a time; a hash of a text can't be made in another order."""
    kind = pieces.schema["conv"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, seen, digest, some = None, False, hashlib.sha256(), False

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([at], pieces_type), pa.array([digest.hexdigest()])], names=["conv", "repaired_sha256"])

        for batch in batches:
            pieces_type = batch.column(0).type
            for conv, piece in zip(batch.column(0).to_pylist(), batch.column(2)):
                if seen and conv != at:
                    yield row()
                    digest, some = hashlib.sha256(), False
                at, seen = conv, True
                if data := piece.as_py().encode("utf-8", "surrogatepass"):
                    digest.update(b"\n" + data if some else data)
                    some = True
        if seen:
            yield row()

    return pieces.repartition("conv").sortWithinPartitions("conv", F.asc_nulls_last("chunk")).mapInArrow(work, f"conv {kind}, repaired_sha256 string")


def large_conversations(rows: DataFrame, n_rows: int, n_bytes: int) -> DataFrame:
    """Conversations of any size, in ranges; without those that have no rows after the damage.  n_rows, n_bytes: of all."""
    same = rows.where("copies > 0").groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    n = 1 + max(n_rows // MOST_ROWS, n_bytes // MOST_BYTES)
    ranged = staged(same.repartitionByRange(n, F.asc_nulls_first("conv_id"), *in_order()).withColumn("chunk", F.spark_partition_id()), "conversation-ranges")
    firsts = ranged.groupBy("conv_id", "role", "text").agg(F.min(F.struct(F.col("turn").isNotNull().alias("some"), "turn")).alias("_f"))
    firsts = firsts.select(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("text").alias("_x"), F.col("_f.turn").alias("_t"), F.lit(True).alias("is_first"))
    held = ranged.join(firsts, same_conv("conv_id", "_c") & F.col("turn").eqNullSafe(F.col("_t")) & (F.col("role") == F.col("_r")) & (F.col("text") == F.col("_x")), "left")
    own = Window.partitionBy("conv_id", "chunk").orderBy(*in_order())
    flagged = with_faults(held, F.col("is_first").isNotNull()).withColumns({"pos": F.row_number().over(own), "before": F.lag("ini").over(own)})
    again = F.col("copies") - 1
    count = lambda c, w: F.sum(F.when(c, w).otherwise(0)).cast("bigint")
    through = F.struct(*[F.aggregate("turns", begun(s), step, lambda w: F.struct(*[way(F.least(w[t]["cost"], F.lit(NEVER)), w[t]["audit"]).alias(t) for t in STATES])).alias(s) for s in STATES])
    chunks = flagged.groupBy("conv_id", "chunk").agg(
        count(F.col("blank"), F.col("copies")).alias("blank"), (count(F.col("duplicate"), F.col("copies")) + count(~F.col("blank") & ~F.col("duplicate"), again)).alias("duplicate"), count(F.col("truncated"), F.lit(1)).alias("truncated"),
        (count(is_illegal(F.col("before")), F.lit(1)) + F.sum(again)).alias("illegal"), F.min_by("ini", "pos").alias("head"), F.max_by("ini", "pos").alias("tail"), F.min("turn").alias("least"), F.max("turn").alias("most"), turns_list().alias("turns"),
    )
    chunks = staged(chunks.withColumn("through", through), "conversation-parts")
    joint = F.lag("tail").over(Window.partitionBy("conv_id").orderBy("chunk"))  # one row for each range
    apart = (F.col("joint").isNotNull() & ~F.concat("joint", "head").isin(LEGAL)).cast("bigint")
    total = chunks.drop("turns").withColumn("joint", joint).groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")], (F.sum("illegal") + F.sum(apart)).cast("bigint").alias("illegal"), F.min("least").alias("least"), F.max("most").alias("most"),
        F.sort_array(F.collect_list(F.struct("chunk", "through"))).alias("all"),
    )
    none = F.array().cast("array<struct<chunk:int,audit:string>>")
    start = F.struct(*[F.struct(F.lit(0 if s == "e" else NEVER).cast("bigint").alias("cost"), F.lit("").alias("audit"), none.alias("parts")).alias(s) for s in STATES])

    def last(w: Column) -> Column:
        end = lambda s, cost, edit: F.struct((w[s]["cost"] + cost).alias("cost"), F.concat(w[s]["audit"], F.lit(edit)).alias("audit"), F.array_append(w[s]["parts"], F.struct(F.lit(None).cast("int").alias("chunk"), F.lit(edit).alias("audit"))).alias("parts"))
        return F.least(end("e", 0, ""), end("a", 0, ""), end("u", INSERT, "Ia"), end("s", 2 * INSERT, "IuIa"))

    best = staged(total.withColumn("best", F.aggregate("all", start, composed, last)).drop("all"), "conversation-best")
    parts = best.select(F.col("conv_id").alias("conv"), F.explode("best.parts").alias("p")).select("conv", F.col("p.chunk").alias("at"), "p.audit")
    pieces = parts.join(chunks.select("conv_id", "chunk", "turns"), same_conv("conv", "conv_id") & (F.col("at") == F.col("chunk")), "left")
    none = F.array().cast(chunks.schema["turns"].dataType)
    tail = F.array_join(F.transform(F.regexp_extract_all("audit", F.lit("I([ua])"), F.lit(1)), lambda i: F.when(i == "u", "user:").otherwise("assistant:")), "\n")
    piece = F.when(F.col("at").isNull(), tail).otherwise(repaired(F.coalesce("turns", none), F.col("audit")))
    hashes = streamed_hashes(pieces.select("conv", F.col("at").alias("chunk"), piece.alias("piece")))
    turns = ranged.where("turn IS NOT NULL").select("conv_id", "turn").distinct().groupBy("conv_id").agg(F.count("*").alias("distinct")).withColumnRenamed("conv_id", "_of")
    out = best.join(hashes, same_conv("conv", "conv_id")).join(turns, same_conv("_of", "conv_id"), "left")
    return out.select("conv_id", gaps(F.col("least"), F.col("most"), F.coalesce("distinct", F.lit(0))).alias("gaps"), "blank", "duplicate", "truncated", "illegal", F.col("best.cost").alias("cost"), initials(F.col("best.audit")).alias("audit"), "repaired_sha256")


def repaired_conversations(conversations: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conv_id of conversations."""
    conversations = conversations.select("conv_id", "turn", "role", "text")
    sizes = conversations.groupBy("conv_id").agg(F.count("*").alias("rows"), F.sum(F.coalesce(F.octet_length("text"), F.lit(1)).cast("bigint")).alias("bytes"))
    large = staged(sizes.where((F.col("rows") > MOST_ROWS) | (F.col("bytes") > MOST_BYTES)).withColumnRenamed("conv_id", "_large"), "conversation-sizes")
    all_large = large.agg(F.count("*"), F.sum("rows"), F.sum("bytes")).first()
    rows = damaged(conversations)
    if not all_large[0]:
        return small_conversations(rows)
    ids = large.select("_large")
    small = small_conversations(rows.join(ids, same_conv("conv_id", "_large"), "left_anti"))
    found = large_conversations(rows.join(ids, same_conv("conv_id", "_large"), "left_semi"), int(all_large[1]), int(all_large[2]))
    zero = F.lit(0).cast("bigint")
    numbers = [F.coalesce(c, zero).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    every = ids.join(found, same_conv("conv_id", "_large"), "left").select(
        F.col("_large").alias("conv_id"),
        F.when(F.col("cost").isNull(), zero).otherwise(F.col("gaps")).alias("gaps"),
        *numbers,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(EMPTY_HASH)).alias("repaired_sha256"),
    )
    return small.unionByName(every)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired_conversations(table(spark, sf_dir, "conversations"))


ORACLE = r"""
WITH RECURSIVE tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, i)) AS t),
src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ascii(x) AS BIGINT)) AS bytes
  FROM conversations),
kinds AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(bytes, lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295), 4294967295) % 20 AS kind FROM src, tab),
hurt AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM kinds WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth, left(role, 1) AS ini,
    right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS fin
  FROM hurt),
flagged AS (
  SELECT *, fin = '' AS blank, fin <> '' AND nth > 1 AS duplicate, fin <> '' AND nth = 1 AND fin NOT IN ('.', '!', '?') AS truncated,
    lag(ini) OVER (PARTITION BY conv_id ORDER BY pos) AS prior
  FROM placed),
costs AS (
  SELECT conv_id, pos, CASE WHEN truncated THEN 3 ELSE 0 END + CASE WHEN blank OR duplicate THEN 1000000000 ELSE 0 END AS late, ini FROM flagged),
-- A way is its cost in 12 digits and its audit, so that the least text is the least cost and then the least audit.
ways AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS pos, '000000000000' AS e, '001000000000' AS s, '001000000000' AS u, '001000000000' AS a
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, pos, plus(e, 4, 'D'), least(plus(s, 4, 'D'), plus(e, late + k(ini, 's'), 'K')),
    least(plus(iu, 4, 'D'), plus(least(e, s, ia), late + k(ini, 'u'), 'K'), plus(least(e, s, ia), late + 3, 'R')),
    least(plus(ia, 4, 'D'), plus(iu, late + k(ini, 'a'), 'K'), plus(iu, late + 3, 'R'))
  FROM (SELECT w.conv_id, c.pos, e, s, late, ini, least(u, plus(e, 3, 'I'), plus(s, 3, 'I'), plus(a, 3, 'I')) AS iu, least(a, plus(u, 3, 'I')) AS ia
        FROM ways w JOIN costs c ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND c.pos = w.pos + 1)),
ends AS (
  SELECT conv_id, pos, least(e, a, plus(u, 3, 'I'), plus(s, 6, 'II')) AS best FROM ways
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY pos DESC) = 1),
letters AS (SELECT conv_id, best, unnest(range(13, length(best) + 1)) AS i FROM ends),
edits AS (
  SELECT conv_id, i, best[i] AS edit, count(*) FILTER (best[i] <> 'I') OVER before AS pos, count(*) FILTER (best[i] <> 'D') OVER before AS place
  FROM letters WINDOW before AS (PARTITION BY conv_id ORDER BY i)),
outs AS (
  SELECT e.conv_id, i, edit, place, f.role, f.text, ini = 's' AND edit = 'K' AND place = 1 AS sys
  FROM edits e LEFT JOIN flagged f ON e.conv_id IS NOT DISTINCT FROM f.conv_id AND e.pos = f.pos AND e.edit <> 'I' WHERE edit <> 'D'),
lines AS (
  SELECT conv_id, i, CASE edit WHEN 'K' THEN role WHEN 'R' THEN r WHEN 'I' THEN r END || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END AS line
  FROM (SELECT *, CASE WHEN (place - CASE WHEN bool_or(coalesce(sys, false)) OVER (PARTITION BY conv_id) THEN 1 ELSE 0 END) % 2 = 1 THEN 'user' ELSE 'assistant' END AS r FROM outs)),
texts AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY i) AS t FROM lines GROUP BY conv_id),
counts AS (
  SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
    count(*) FILTER (truncated) AS truncated, count(*) FILTER (prior IS NOT NULL AND prior || ini NOT IN ('su', 'ua', 'au')) AS illegal
  FROM flagged GROUP BY conv_id)
SELECT d.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(left(best, 12) AS BIGINT) AS cost, substr(best, 13) AS audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM ends d LEFT JOIN counts c ON d.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN texts x ON d.conv_id IS NOT DISTINCT FROM x.conv_id
"""


def _written_out(sql: str) -> str:
    """plus(way, cost, edits) and k(initial, wanted) of the text above as plain SQL."""
    import re

    sql = re.sub(r"k\(ini, ('\w')\)", r"CASE WHEN ini = \1 THEN 0 ELSE 1000000000 END", sql)
    return re.sub(r"plus\((least\([^()]*\)|\w+), ([^(),]+?), ('\w+')\)", r"(lpad(CAST(CAST(left(\1, 12) AS BIGINT) + \2 AS VARCHAR), 12, '0') || substr(\1, 13) || \3)", sql)


ORACLE = _written_out(ORACLE)
