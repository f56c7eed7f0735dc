"""Operator 12, audit of how far sources diverge: for every (lang, source) the terms that set it apart from its language, by an
upper-bound search, and its distance from every other source of the language, from postings.

A language keeps the terms that at least MIN_DOCS of its documents hold.  A group gives a kept term with n occurrences the
probability p = 1 + floor(UNIT * (n + 2) / (N + 2 V)), the language gives it q alike, and they diverge by
f = floor((p - q)**2 / (p + q)), all in whole numbers.

``term``: p depends on n alone, so the terms of a group fall into buckets of equal count.  Each bucket carries the least and the most
that the language gives to its terms; f falls as q rises, so these bound f for the whole bucket from above and below.  The TOP-th
of the lower bounds is a first threshold.  Buckets are then evaluated in the order of their upper bounds, more of them each round,
for all groups at once, and the TOP-th best value found raises the threshold; a group is done when the bounds of all that it has not
seen are strictly below.  Ties therefore are all seen.

``pair``: most terms occur in few sources, so f is summed over all kept terms as if no term occurred in either source (one product),
corrected by the buckets of either source against the other's probability of nothing (bucket by group), and corrected once more for
the terms that both hold, which a join of the postings by term finds.  That sums in each task before anything is shuffled; every
ordered pair of sources is asked for, so a language of S sources has S * (S - 1) rows.

Texts are cut and counted in tasks that hold up to HELD terms; very long texts are cut in strips.

Defined cases: null text, lang and source count as empty strings; a language without kept terms has value 0 for its pairs and no
terms; a source alone in its language has no pairs; repeated rows are documents of their own; values that tie rank by the item's
UTF-8; an empty table gives no rows; columns other than text, lang and source are dropped, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheafwork.llm.shared import few, spread, staged, table

MIN_DOCS, TOP, UNIT = 10, 10, 1_000_000_000
#: Terms that a task holds before it hands them on; bytes of a text that are cut at a time.
HELD, STRIP = 400_000, 1 << 20
#: Terms of a group that the first round evaluates, and how much more each further round does.
FIRST, FASTER = 64, 16
#: Languages, and groups, that are broadcast (counted first); more are joined by a shuffle.
FEW = 50_000
#: Bytes of terms as they are, A-Z as a-z, and the others as spaces.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
BETWEEN = re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]")
KEY = ["lang", "source"]


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in strips."""
    at = 0
    while at < len(text):
        cut = BETWEEN.search(text, at + STRIP)
        end = cut.start() if cut else len(text)
        yield text[at:end].translate(LETTERS).split()
        at = end


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term and the documents that hold it, added up."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple, tuple[Counter, Counter]] = {}
        held = 0

        def all_of() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, with_) in counts.items():
                terms = list(n)
                for i in range(0, len(terms), 1 << 16):
                    some = terms[i : i + (1 << 16)]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([lang] * len(some), pa.string()), pa.array([source] * len(some), pa.string()), pa.array(some, pa.binary()).cast(pa.string()),
                        pa.array([n[t] for t in some], pa.int64()), pa.array([with_[t] for t in some], pa.int64()),
                    ], names=["lang", "source", "term", "n", "docs"])
            counts.clear()

        for batch in batches:
            for text, lang, source in zip(batch.column("text").cast(pa.binary()), batch.column("lang").to_pylist(), batch.column("source").to_pylist()):
                n, with_ = counts.setdefault((lang, source), (Counter(), Counter()))
                before, own = len(n), set()
                for words in terms_of(text.as_py()):
                    n.update(words)
                    own.update(words)
                with_.update(own)
                held += len(n) - before
                if held >= HELD:
                    yield from all_of()
                    held = 0
        yield from all_of()

    parts = docs.mapInArrow(work, "lang string, source string, term string, n bigint, docs bigint")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def div(a: Column, b: Column) -> Column:
    """Whole quotient of numbers that are not negative."""
    return F.call_function("div", a, b)


def probability(n: Column, total: Column, terms: Column) -> Column:
    wide = lambda c, digits: c.cast(f"decimal({digits},0)")
    part = wide(n + 2, 20) * F.lit(UNIT).cast("decimal(10,0)")
    return F.when(terms > 0, 1 + div(part, wide(total, 20) + wide(terms, 19) * 2))


def divergence(p: Column, q: Column) -> Column:
    return div((p - q) * (p - q), p + q)


def best_terms(postings: DataFrame, buckets: DataFrame, top: int = TOP) -> DataFrame:
    """(lang, source, item, value): the ``top`` terms of each group that has p > q, by value descending and term.

    postings: (lang, source, term, n, q); buckets: (lang, source, n, terms, p, least_q, most_q)."""
    upper = F.when(F.col("p") > F.col("least_q"), divergence(F.col("p"), F.col("least_q")))
    lower = F.when(F.col("p") > F.col("most_q"), divergence(F.col("p"), F.col("most_q")))
    bounded = buckets.withColumns({"upper": upper, "lower": lower}).where("upper IS NOT NULL")
    down = Window.partitionBy(*KEY).orderBy(F.desc("upper"), "n")
    by_lower = Window.partitionBy(*KEY).orderBy(F.desc_nulls_last("lower"), "n")
    bounded = bounded.withColumns({"before": F.coalesce(F.sum("terms").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "sure": F.sum("terms").over(by_lower.rowsBetween(Window.unboundedPreceding, 0))})
    order = staged(bounded.select(*KEY, "n", "terms", "p", "upper", "before", "lower", "sure"), "divergence-buckets")
    bar = order.where(F.col("sure") >= top).groupBy(*KEY).agg(F.max("lower").alias("bar")).where("bar IS NOT NULL")
    found, from_, to = None, 0, FIRST
    while True:
        waiting = order.where(F.col("before") >= from_).join(bar, KEY, "left").where("bar IS NULL OR upper >= bar")
        now = staged(waiting.select(*KEY, "n", "p", "before"), "divergence-round")
        if now.isEmpty():
            break
        asked = now.where(F.col("before") < to)
        seen = asked.join(postings, [*KEY, "n"]).where(F.col("p") > F.col("q")).select(*KEY, F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value"))
        every = seen if found is None else found.select(*KEY, "item", "value").unionByName(seen)
        place = F.row_number().over(Window.partitionBy(*KEY).orderBy(F.desc("value"), "item"))
        found = staged(every.withColumn("place", place).where(F.col("place") <= top), "divergence-best")
        bar = found.where(F.col("place") == top).select(*KEY, F.col("value").alias("bar")).unionByName(bar).groupBy(*KEY).agg(F.max("bar").alias("bar"))
        from_, to = to, to * FASTER
    if found is None:
        return order.select(*KEY, F.lit("").alias("item"), F.col("upper").alias("value")).limit(0)
    return found.select(*KEY, "item", "value")


def pair_sums(postings: DataFrame, buckets: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value) of all sources a < b of a language.

    postings: (lang, source, term, p, z); buckets: (lang, source, terms, p); groups: (lang, source, kept, z), z being p of nothing."""
    a, b = groups.select("lang", F.col("source").alias("a"), "kept", F.col("z").alias("za")), groups.select("lang", F.col("source").alias("b"), F.col("z").alias("zb"))
    none = divergence(F.col("za"), F.col("zb"))
    base = a.join(b, "lang").where("a < b").select("lang", "a", "b", F.coalesce(F.col("kept") * none, F.lit(0)).alias("v"))
    one = buckets.join(a.drop("kept").withColumnRenamed("a", "source"), KEY).join(b, "lang").where("source <> b")
    one = one.select("lang", F.least("source", "b").alias("a"), F.greatest("source", "b").alias("b"), (F.col("terms") * (divergence(F.col("p"), F.col("zb")) - none)).alias("v"))
    left = postings.select("lang", "term", F.col("source").alias("a"), F.col("p").alias("pa"), F.col("z").alias("za"))
    right = postings.select("lang", "term", F.col("source").alias("b"), F.col("p").alias("pb"), F.col("z").alias("zb"))
    both = left.join(right, ["lang", "term"]).where("a < b")
    more = divergence(F.col("pa"), F.col("pb")) - divergence(F.col("pa"), F.col("zb")) - divergence(F.col("za"), F.col("pb")) + none
    both = both.groupBy("lang", "a", "b").agg(F.sum(more).alias("v"))
    return base.unionByName(one).unionByName(both).groupBy("lang", "a", "b").agg(F.sum("v").alias("value"))


def audit(docs: DataFrame, top: int = TOP, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, source, part, item, value, rank) of the documents (text, lang, source)."""
    docs = spread(docs).select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", *KEY)])
    counts = staged(term_counts(docs), "divergence-counts")
    kept = staged(counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total")).where(F.col("docs") >= min_docs).select("lang", "term", "total"), "divergence-kept")
    langs = few(staged(kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("total").alias("lang_n")), "divergence-langs"), FEW)
    held = staged(counts.join(kept, ["lang", "term"]).select(*KEY, "term", "n", "total"), "divergence-postings")
    sizes = held.groupBy(*KEY).agg(F.sum("n").alias("size"))
    groups = docs.select(*KEY).distinct().join(langs, "lang", "left").join(sizes, KEY, "left").withColumns({"kept": F.coalesce("kept", F.lit(0)), "lang_n": F.coalesce("lang_n", F.lit(0)), "size": F.coalesce("size", F.lit(0))})
    groups = staged(groups.withColumn("z", probability(F.lit(0).cast("bigint"), F.col("size"), F.col("kept"))), "divergence-groups")
    of_lang = lambda total: probability(total, F.col("lang_n"), F.col("kept"))
    named = few(groups, FEW)
    buckets = held.groupBy(*KEY, "n").agg(F.count("*").alias("terms"), F.min("total").alias("least"), F.max("total").alias("most")).join(named, KEY)
    buckets = staged(buckets.select(*KEY, "n", "terms", probability(F.col("n"), F.col("size"), F.col("kept")).alias("p"), of_lang(F.col("least")).alias("least_q"), of_lang(F.col("most")).alias("most_q")), "divergence-bounds")
    given = held.join(langs, "lang").select(*KEY, "term", "n", of_lang(F.col("total")).alias("q"))
    terms = best_terms(given, buckets, top)
    listed = held.join(named, KEY).select(*KEY, "term", probability(F.col("n"), F.col("size"), F.col("kept")).alias("p"), "z")
    sums = pair_sums(listed, buckets.select(*KEY, "terms", "p"), groups.select(*KEY, "kept", "z"))
    pairs = sums.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("x"), "value")
    parts = [pairs.select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value"), terms.select(*KEY, F.lit("term").alias("part"), "item", "value")]
    rank = F.row_number().over(Window.partitionBy(*KEY, "part").orderBy(F.desc("value"), "item"))
    return parts[0].unionByName(parts[1]).select(*KEY, "part", "item", F.col("value").cast("bigint").alias("value")).withColumn("rank", rank)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


ORACLE = rf"""
WITH docs AS (SELECT row_number() OVER () AS id, coalesce(text, '') AS t, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
cut AS (SELECT id, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM docs),
terms AS (SELECT id, lang, source, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term, count(*) AS n FROM cut GROUP BY ALL),
kept AS (SELECT lang, term, CAST(sum(n) AS HUGEINT) AS total FROM terms GROUP BY ALL HAVING count(*) >= {MIN_DOCS}),
grp AS (SELECT DISTINCT lang, source FROM docs),
have AS (SELECT lang, source, term, CAST(sum(n) AS HUGEINT) AS n FROM terms SEMI JOIN kept USING (lang, term) GROUP BY ALL),
dense AS (
  SELECT g.lang, g.source, k.term, total, coalesce(h.n, 0) AS n FROM grp g JOIN kept k ON g.lang = k.lang
  LEFT JOIN have h ON h.lang = g.lang AND h.source = g.source AND h.term = k.term),
sized AS (SELECT *, sum(n) OVER g AS size, count(*) OVER g AS v, sum(total) OVER g AS lang_n FROM dense WINDOW g AS (PARTITION BY lang, source)),
probs AS (
  SELECT lang, source, term, n, CAST(1 + ({UNIT} * CAST(n + 2 AS HUGEINT)) // CAST(size + 2 * v AS HUGEINT) AS HUGEINT) AS p,
    CAST(1 + ({UNIT} * CAST(total + 2 AS HUGEINT)) // CAST(lang_n + 2 * v AS HUGEINT) AS HUGEINT) AS q FROM sized),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM probs a JOIN probs b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
every AS (
  SELECT * FROM pairs
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM probs WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r FROM every)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INT) AS rank FROM ranked WHERE part = 'pair' OR r <= {TOP}
"""
