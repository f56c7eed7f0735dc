"""Operator 10, benchmark decontamination by template canonicalisation, in DataFrame functions only.

Numbers, units after a number, and names (words with a capital and small letters, within a sentence) become the typed
placeholders ``0``, ``2`` and ``1``; everything else is lower-cased words.  Windows of WINDOW canonical words are hashed and
joined with those of the benchmark.  A document holds an item if SHARE or more of the item's distinct windows occur in it,
the first also with its first word as a name.  Placeholders hide values, so for items that have any, the values behind
matched windows are compared: each value of the item has to stand for one value of the document, and the other way round,
for CONSISTENT of the item's values.  That catches questions whose numbers and names were exchanged, and lets texts go that
only share a pattern.  Values are compared over all matched windows of the document first.  Where these contradict each
other (two items of one template, an item beside its altered copy, a run of numbers), each occurrence is judged alone: the
matched windows at one distance between the places in document and item, or at distances less than WINDOW apart, so that
a word put in or left out does not tear it.  An occurrence has SHARE of the item's windows; one whose words are all
placeholders tells nothing but its values, so CONSISTENT of these have to be equal.

What belongs to the benchmark's windows is broadcast if there are at most BROADCAST_WINDOWS of them (their number is counted first);
beyond that, both sides are shuffled by the window's hash.

Letters of scripts without spaces (UNSPACED) are words of their own.  An item of fewer than WINDOW words has one window of
its own length, of its words as they are but lower-cased: so short a template would fit any text.  It has no slots.

Each text is judged by itself: rows are told apart by doc_id and text, so texts that share an id, or have none, are never pooled.
A doc_id has one row for an item, that of its text with the most matched windows (then the highest consistency).

Defined cases: null and empty texts hold nothing, and so does an item without a word; rows alike in doc_id and text count as one, as
do repeated items; all texts with a null doc_id are judged alike, slots included, and reported under null; very long texts are cut
into windows whole; an empty table gives no rows; columns other than doc_id, text and item_id are dropped, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheafwork.llm.shared import spread, staged, table

WINDOW, SHARE, CONSISTENT = 5, 0.8, 0.8
BROADCAST_WINDOWS = 1_000_000
#: Templates that share a window beyond which it finds no documents but is only looked for in those that others found.
HOT = 64
# Units that make a placeholder after a number.
UNITS = "kg|g|mg|lb|lbs|oz|km|m|cm|mm|mi|ft|in|l|ml|s|ms|min|h|hours?|minutes?|seconds?|days?|weeks?|months?|years?|miles?|meters?|metres?|kilometers?|kilometres?|grams?|kilograms?|pounds?|dollars?|euros?|cents?|percent|usd|eur"
NUMBER, NAME, UNIT = "0", "1", "2"
#: Scripts that put no spaces between words, and a wider range that is quicker to look for.
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"
MAY_BE_UNSPACED = r"[\x{E00}-\x{109F}\x{1780}-\x{17FF}\x{2E80}-\x{FFDC}\x{16FE0}-\x{16FFF}\x{1AFF0}-\x{1B16F}\x{1F200}\x{20000}-\x{3FFFF}]"


def joined_numbers(text: Column) -> Column:
    """'1,000.5' -> '10005': the marks within a number go, so that it is one word."""
    return F.when(text.rlike("[0-9][.,:/-][0-9]"), F.regexp_replace(text, "(?<=[0-9])[.,:/-](?=[0-9])", "")).otherwise(text)


def spaced(text: Column) -> Column:
    """Spaces around each letter of an unspaced script."""
    return F.when(text.rlike(MAY_BE_UNSPACED), F.regexp_replace(text, f"({UNSPACED})", " $1 ")).otherwise(text)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[^\p{L}\p{N}]+"), "")


def canonical(text: Column) -> Column:
    """Text with placeholders, one for each word that is replaced; text has gone through joined_numbers."""
    numbered = F.regexp_replace(text, r"(?<![\p{L}\p{N}])\p{L}*\p{N}[\p{L}\p{N}]*", NUMBER)
    numbered = F.regexp_replace(numbered, rf"(?i)(?<=\b{NUMBER} )(?:{UNITS})(?![\p{{L}}\p{{N}}])", UNIT)
    marked = F.when(text.rlike(r"\p{N}"), numbered).otherwise(text)
    return F.lower(F.regexp_replace(marked, r"(?<=[\p{L}\p{N},;] )\p{Lu}\p{Ll}\p{L}*", NAME))


def shifted(words: Column, names: list[str]) -> Column:
    """An array of structs: words[i], words[i + 1], ... under the names."""
    n = F.greatest(F.size(words) - len(names) + 1, F.lit(0))
    parts = [F.slice(words, k + 1, n).alias(name) for k, name in enumerate(names)]
    return F.arrays_zip(*parts)


def windows(df: DataFrame, key: str, text: str, values: bool = False) -> DataFrame:
    """(key, at, hash) of every window; with values also canon and own, arrays of its canonical and original words."""
    clean = df.where(F.col(text).isNotNull()).select(key, spaced(joined_numbers(F.col(text))).alias("_t"))
    cut = clean.select(key, words_of(canonical(F.col("_t"))).alias("_w"), *([words_of(F.col("_t")).alias("_v")] if values else []))
    names = [f"_{k}" for k in range(WINDOW)]
    cut = cut.where(F.size("_w") >= WINDOW)
    out = cut.select(key, *(["_v"] if values else []), F.posexplode(shifted(F.col("_w"), names)).alias("at", "_x"))
    words = [F.col("_x").getField(n) for n in names]
    extra = [F.array(*words).alias("canon"), F.slice("_v", F.col("at") + 1, WINDOW).alias("own")] if values else []
    return out.select(key, "at", F.xxhash64(*words).alias("hash"), *extra)


def n_canonical(text: str) -> Column:
    return F.when(F.col(text).isNotNull(), F.size(words_of(canonical(spaced(joined_numbers(F.col(text))))))).otherwise(0)


def short_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """leaks() of items of fewer than WINDOW words: their words have to stand side by side in the document."""
    own = lambda text: words_of(F.lower(spaced(joined_numbers(F.col(text)))))
    short = items.where(n_canonical("item_text").between(1, WINDOW - 1)).select("item_id", own("item_text").alias("_w")).distinct()
    short = short.select("item_id", F.size("_w").alias("n"), F.xxhash64("_w").alias("hash"))
    sizes = sorted(r["n"] for r in short.select("n").distinct().collect())
    words = docs.where("text IS NOT NULL").select("doc_id", own("text").alias("_w"))

    def runs(n: int) -> Column:
        hashes = F.array_distinct(F.transform(F.sequence(F.lit(1), F.size("_w") - n + 1), lambda i: F.xxhash64(F.slice("_w", i, n))))
        return F.when(F.size("_w") >= n, F.transform(hashes, lambda h: F.struct(F.lit(n).alias("n"), h.alias("hash")))).otherwise(F.array())

    met = words.select("doc_id", F.explode(F.concat(*map(runs, sizes))).alias("x")).select("doc_id", "x.n", "x.hash")
    few = short.limit(BROADCAST_WINDOWS + 1).count() <= BROADCAST_WINDOWS
    met = met.join(F.broadcast(short) if few else short, ["n", "hash"]).select("doc_id", "item_id").distinct()
    one = F.lit(1).cast("bigint")
    return met.select("doc_id", "item_id", one.alias("matched"), one.alias("windows"), F.lit(1.0).alias("share"), F.lit(0).cast("bigint").alias("slots"), F.lit(None).cast("double").alias("consistency"))


def item_windows(items: DataFrame) -> DataFrame:
    """(item_id, place, hash): the windows of items, equal ones at the first place they have.  The first window has a second
    hash, with a name for its first word: within another sentence, that word's capital makes it one."""
    every = windows(items, "item_id", "item_text", values=True)
    first = every.groupBy("item_id", "hash").agg(F.min("at").alias("place"))
    begin = every.where((F.col("at") == 0) & ~F.col("canon")[0].isin(NUMBER, NAME, UNIT))
    second = begin.select("item_id", "at", "hash", F.xxhash64(F.lit(NAME), *[F.col("canon")[k] for k in range(1, WINDOW)]).alias("named"))
    second = second.join(first, ["item_id", "hash"]).select("item_id", "place", F.col("named").alias("hash"))
    return first.select("item_id", "place", "hash").unionByName(second).distinct()


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, matched, windows, share, slots, consistency) of each document and item it holds.  slots counts the
    item's values behind placeholders; consistency is null without any."""
    # The row's key: its id, and two hashes of id and text.  Its fields may be null, the key itself is not, so it joins null ids too.
    row = F.struct(F.col("doc_id").alias("id"), F.xxhash64("doc_id", "text").alias("a"), F.xxhash64(F.lit(1), "doc_id", "text").alias("b"))
    docs = spread(docs.select("doc_id", "text").where("text IS NOT NULL")).select(row.alias("doc_id"), "text")
    items = benchmark.select("item_id", F.col("text").alias("item_text"))
    found = long_leaks(docs, items).withColumn("_long", F.lit(True))
    if not items.where(n_canonical("item_text").between(1, WINDOW - 1)).isEmpty():
        found = found.unionByName(short_leaks(docs, items).withColumn("_long", F.lit(False)))
    # An item_id with a long and a short text has one row for a document: that of the long one.
    rest = ["matched", "consistency", "windows", "share", "slots"]
    best = found.groupBy(F.col("doc_id.id").alias("doc_id"), "item_id").agg(F.max(F.struct("_long", *rest)).alias("x"))
    return best.select("doc_id", "item_id", *[f"x.{c}" for c in ("matched", "windows", "share", "slots", "consistency")])


def if_few(df: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """broadcast() for tables with a row or less for each of df's, if these are few."""
    return F.broadcast if df.limit(BROADCAST_WINDOWS + 1).count() <= BROADCAST_WINDOWS else lambda d: d


def asked_windows(theirs: DataFrame, sizes: DataFrame) -> DataFrame:
    """(template, place, hash) of the windows that documents are searched for first: all but those that more than HOT templates
    share, and in any case so many of a template's places, the least shared ones, that no document with SHARE lacks them all."""
    shared = theirs.groupBy("hash").agg(F.count_distinct("template").alias("others"))
    places = theirs.join(shared, "hash").groupBy("template", "place").agg(F.max("others").alias("others")).join(sizes, "template")
    rank = F.row_number().over(Window.partitionBy("template").orderBy("others", "place"))
    asked = places.withColumn("rank", rank).where((F.col("others") <= HOT) | (F.col("rank") <= F.col("windows") - F.ceil(F.lit(SHARE) * F.col("windows")) + 1))
    return theirs.join(asked.select("template", "place"), ["template", "place"]).select("template", "place", "hash")


def long_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """leaks() of items of WINDOW words or more.  Items with equal windows are one template until their values are compared."""
    every = item_windows(items)
    shape = F.md5(F.to_json(F.sort_array(F.collect_list(F.struct("place", "hash")))).cast("binary"))
    members = staged(every.groupBy("item_id").agg(shape.alias("template")), "templates")
    theirs = staged(every.join(members, "item_id").select("template", "place", "hash").distinct(), "template-windows")
    small = if_few(theirs)
    sizes = theirs.groupBy("template").agg(F.count_distinct("place").alias("windows"))
    asked = staged(asked_windows(theirs, sizes), "template-asked")
    sizes = sizes.join(asked.groupBy("template").agg(F.count_distinct("place").alias("asked")), "template").select("template", "windows", (F.col("windows") - F.col("asked")).alias("open"))
    met = windows(docs, "doc_id", "text").join(small(asked), "hash").select("doc_id", "template", "place").distinct()
    maybe = met.groupBy("doc_id", "template").agg(F.count("*").alias("matched")).join(small(sizes), "template")
    maybe = staged(maybe.where(F.col("matched") + F.col("open") >= F.lit(SHARE) * F.col("windows")), "leak-candidates")
    found = maybe.where("open = 0").select("doc_id", "template", "matched", "windows")
    some = maybe.where("open > 0")
    if not some.isEmpty():  # of these pairs only: the template's other windows, each looked for in the document
        ids = some.select(F.col("doc_id").alias("_id")).distinct()
        held = windows(docs.join(ids, F.col("doc_id") == F.col("_id"), "left_semi"), "doc_id", "text").select(F.col("doc_id").alias("_id"), F.col("hash").alias("_hash")).distinct()
        others = theirs.join(asked.select("template", "place").distinct(), ["template", "place"], "left_anti")
        more = some.join(small(others), "template").join(held, (F.col("doc_id") == F.col("_id")) & (F.col("hash") == F.col("_hash")), "left_semi")
        every = some.select("doc_id", "template", "windows", "matched").unionByName(more.select("doc_id", "template", "windows", "place").distinct().select("doc_id", "template", "windows", F.lit(1).cast("bigint").alias("matched")))
        found = found.unionByName(every.groupBy("doc_id", "template", "windows").agg(F.sum("matched").alias("matched")).where(F.col("matched") >= F.lit(SHARE) * F.col("windows")).select("doc_id", "template", "matched", "windows"))
    found = staged(found.join(small(members), "template").select("doc_id", "item_id", "matched", "windows"), "leaks-found")
    blank = F.array(*map(F.lit, (NUMBER, NAME, UNIT)))
    own = windows(items, "item_id", "item_text", values=True).select("item_id", "hash", F.col("canon"), F.col("own").alias("item_own")).where(F.arrays_overlap("canon", blank))
    told = found.select("doc_id", "item_id", "matched", "windows", F.round(F.col("matched") / F.col("windows"), 6).alias("share"))
    if own.isEmpty():
        return told.withColumns({"slots": F.lit(0).cast("bigint"), "consistency": F.lit(None).cast("double")})
    small = if_few(own)
    slotted = own.select("item_id").distinct()
    ask = found.join(small(slotted), "item_id", "left_semi").select("doc_id", "item_id")
    ours = windows(docs.join(ask.select("doc_id").distinct(), "doc_id", "left_semi"), "doc_id", "text", values=True).select("doc_id", "hash", F.col("own").alias("doc_own"))
    both = ours.join(small(own), "hash").join(ask, ["doc_id", "item_id"], "left_semi")
    fair = consistency(both, ["doc_id", "item_id"])
    judged = staged(told.join(fair, ["doc_id", "item_id"], "left"), "leaks")
    passed = judged.where("consistency IS NULL OR consistency >= " + str(CONSISTENT))
    torn = judged.where("consistency < " + str(CONSISTENT))
    if not torn.isEmpty():
        alone = occurrences(docs, items, torn.select("doc_id", "item_id"), small)
        passed = passed.unionByName(torn.drop("slots", "consistency").join(alone, ["doc_id", "item_id"]))
    return passed.select("doc_id", "item_id", "matched", "windows", "share", F.coalesce("slots", F.lit(0)).cast("bigint").alias("slots"), F.round("consistency", 6).alias("consistency"))


def consistency(both: DataFrame, by: list[str]) -> DataFrame:
    """(by, slots, consistency, equal) from matched windows with canon, item_own and doc_own; equal is the share of pairs of
    values that are the same value."""
    zipped = F.explode(F.arrays_zip("canon", "item_own", "doc_own")).alias("x")
    pairs = both.select(*by, zipped).where(F.col("x.canon").isin(NUMBER, NAME, UNIT))
    pairs = pairs.select(*by, F.col("x.canon").alias("kind"), F.lower("x.item_own").alias("a"), F.lower("x.doc_own").alias("b")).distinct()
    of_a = pairs.groupBy(*by, "kind", "a").agg(F.count("*").alias("bs"), F.min("b").alias("b"))
    of_b = pairs.groupBy(*by, "kind", "b").agg(F.count("*").alias("as_"))
    true = ((F.col("bs") == 1) & (F.col("as_") == 1)).cast("double")
    return of_a.join(of_b, [*by, "kind", "b"]).groupBy(*by).agg(F.count("*").alias("slots"), F.avg(true).alias("consistency"), F.avg((F.col("a") == F.col("b")).cast("double")).alias("equal"))


def occurrences(docs: DataFrame, items: DataFrame, ask: DataFrame, small: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(doc_id, item_id, slots, consistency) of the best occurrence that passes, for those pairs of ask that have one."""
    key = ["doc_id", "item_id"]
    asked = items.where("item_text IS NOT NULL").distinct().join(small(ask.select("item_id").distinct()), "item_id", "left_semi")
    asked = asked.withColumn("copy", F.xxhash64("item_text"))
    theirs = windows(asked.withColumn("it", F.struct("item_id", "copy")), "it", "item_text", values=True)
    theirs = theirs.select("it.item_id", "it.copy", F.col("at").alias("place"), "hash", "canon", F.col("own").alias("item_own"))
    sizes = theirs.groupBy("item_id", "copy").agg(F.count("*").alias("size"))
    named = theirs.where((F.col("place") == 0) & ~F.col("canon")[0].isin(NUMBER, NAME, UNIT))
    named = named.withColumn("hash", F.xxhash64(F.lit(NAME), *[F.col("canon")[k] for k in range(1, WINDOW)]))
    texts = docs.join(ask.select("doc_id").distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    ours = windows(texts, "doc_id", "text", values=True).select("doc_id", "at", "hash", F.col("own").alias("doc_own"))
    both = ours.join(small(theirs.unionByName(named)), "hash").join(ask, key, "left_semi").withColumn("off", F.col("at") - F.col("place"))
    one = [*key, "copy"]
    # Occurrences at one distance, and runs of distances less than WINDOW apart; of a place's windows in a run all count.
    before = F.lag("off").over(Window.partitionBy(*one).orderBy("off"))
    far = (F.col("off") - F.coalesce(before, F.col("off")) >= WINDOW).cast("int")
    run = both.withColumn("_far", far).withColumn("run", F.sum("_far").over(Window.partitionBy(*one).orderBy("off").rangeBetween(Window.unboundedPreceding, 0))).drop("_far")
    tried = run.withColumn("way", F.explode(F.array(F.struct(F.lit(False).alias("runs"), F.col("off").cast("bigint").alias("k")), F.struct(F.lit(True).alias("runs"), F.col("run").cast("bigint").alias("k")))))
    by = [*one, "way"]
    literal = F.exists("canon", lambda w: ~w.isin(NUMBER, NAME, UNIT))
    full = tried.groupBy(*by).agg(F.count_distinct("place").alias("places"), F.max(literal).alias("literal")).join(small(sizes), ["item_id", "copy"])
    full = full.where(F.col("places") >= F.lit(SHARE) * F.col("size")).select(*by, "literal")
    found = consistency(tried.join(full.drop("literal"), by, "left_semi"), by).join(full, by)
    found = found.where((F.col("consistency") >= CONSISTENT) & (F.col("literal") | (F.col("equal") >= CONSISTENT)))
    best = F.max(F.struct("consistency", "slots")).alias("x")
    return found.groupBy(*key).agg(best).select(*key, "x.slots", "x.consistency")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_UNITS = UNITS.replace("?:", "")
ORACLE = rf"""
WITH rows AS (SELECT doc_id, text, row_number() OVER () AS row_id FROM (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL)),
texts AS (
  SELECT 'd' AS side, row_id AS id, text FROM rows
  UNION ALL SELECT 'b', item_id, text FROM benchmark WHERE text IS NOT NULL),
joined AS (
  SELECT side, id, regexp_replace(regexp_replace(text, '([0-9])[.,:/-]([0-9])', '\1\2', 'g'), '([0-9])[.,:/-]([0-9])', '\1\2', 'g') AS t
  FROM texts),
numbered AS (
  SELECT side, id, t, regexp_replace(
    regexp_replace(t, '(^|[^\p{{L}}\p{{N}}])\p{{L}}*\p{{N}}[\p{{L}}\p{{N}}]*', '\10', 'g'),
    '(?i)((?:^|[^\p{{L}}\p{{N}}])0 )(?:{_UNITS})($|[^\p{{L}}\p{{N}}])', '\12\2', 'g') AS n
  FROM joined),
named AS (
  SELECT side, id, t, regexp_replace(regexp_replace(n, '([\p{{L}}\p{{N}},;] )\p{{Lu}}\p{{Ll}}\p{{L}}*', '\11', 'g'),
    '([\p{{L}}\p{{N}},;] )\p{{Lu}}\p{{Ll}}\p{{L}}*', '\11', 'g') AS c
  FROM numbered),
words AS (
  SELECT side, id,
    list_filter(regexp_split_to_array(lower(c), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w,
    list_filter(regexp_split_to_array(t, '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS v
  FROM named),
wins AS (
  SELECT side, id, w, v, unnest(range(1, len(w) - {WINDOW} + 2)) AS i FROM words WHERE len(w) >= {WINDOW}),
win AS (SELECT side, id, i, array_to_string(w[i:i + {WINDOW} - 1], ' ') AS h, w[i:i + {WINDOW} - 1] AS cw, v[i:i + {WINDOW} - 1] AS vw FROM wins),
places AS (SELECT id AS item_id, h, min(i) AS place FROM win WHERE side = 'b' GROUP BY id, h),
theirs AS (
  SELECT item_id, place, h FROM places
  UNION SELECT p.item_id, p.place, '1 ' || array_to_string(w.cw[2:], ' ') FROM win w JOIN places p ON w.id = p.item_id AND w.h = p.h
  WHERE w.side = 'b' AND w.i = 1 AND w.cw[1] NOT IN ('0', '1', '2')),
sizes AS (SELECT item_id, count(DISTINCT place) AS windows FROM theirs GROUP BY item_id),
met AS (
  SELECT d.id AS doc_id, b.item_id, count(DISTINCT b.place) AS matched FROM win d JOIN theirs b ON d.h = b.h WHERE d.side = 'd' GROUP BY d.id, b.item_id),
found AS (SELECT doc_id, item_id, matched, windows FROM met JOIN sizes USING (item_id) WHERE matched >= {SHARE} * windows),
cells AS (
  SELECT f.doc_id, f.item_id, unnest(d.cw) AS kind, lower(unnest(b.vw)) AS a, lower(unnest(d.vw)) AS b
  FROM found f JOIN win d ON d.side = 'd' AND d.id = f.doc_id JOIN win b ON b.side = 'b' AND b.id = f.item_id AND b.h = d.h),
pairs AS (SELECT DISTINCT doc_id, item_id, kind, a, b FROM cells WHERE kind IN ('0', '1', '2')),
judged AS (
  SELECT doc_id, item_id, kind, a, count(*) AS bs, min(b) AS b FROM pairs GROUP BY ALL),
back AS (SELECT doc_id, item_id, kind, b, count(*) AS as_ FROM pairs GROUP BY ALL),
fair AS (
  SELECT j.doc_id, j.item_id, count(*) AS slots, avg(CASE WHEN bs = 1 AND as_ = 1 THEN 1.0 ELSE 0.0 END) AS consistency
  FROM judged j JOIN back k ON j.doc_id = k.doc_id AND j.item_id = k.item_id AND j.kind = k.kind AND j.b = k.b GROUP BY j.doc_id, j.item_id)
SELECT t.doc_id, f.item_id, CAST(matched AS BIGINT) AS matched, CAST(windows AS BIGINT) AS windows, round(matched / windows, 6) AS share,
  CAST(coalesce(slots, 0) AS BIGINT) AS slots, round(CAST(consistency AS DOUBLE), 6) AS consistency
FROM found f JOIN rows t ON f.doc_id = t.row_id LEFT JOIN fair r ON f.doc_id = r.doc_id AND f.item_id = r.item_id
WHERE consistency IS NULL OR consistency >= {CONSISTENT}
QUALIFY row_number() OVER (PARTITION BY t.doc_id, f.item_id ORDER BY matched DESC, consistency DESC NULLS LAST) = 1
"""
