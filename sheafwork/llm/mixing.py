"""Operator 5, mixing sources to target weights by subset-sum budget fitting.

A source's target is its share of all words by weight, no more than CAP times its own words; what a capped source leaves
is shared again by weight among the others until none is above its cap.  A source with target T and S words is taken
floor(T / S) times whole; the rest of the budget, R < S, is fitted by counts of documents of each exact length:

* every length gives the same share R / S of its documents, rounded down;
* the longest lengths that still fit give more, as long as more than WINDOW words are missing;
* what is missing then is met by bounded-knapsack dynamic programming over the documents left, to the word if any
  choice of them does, else to the nearest sum below.

Only (source, length, count) rows enter the fit, one task for each source, bounded by the number of different lengths.
Which documents of a length are taken goes by a seeded hash, so reruns agree; the ranking is dealt out over slices of the
hash, so that a length that very many documents share is no task of its own.

Defined cases: a null text has size 0 and is never taken; null is a source of its own, the last; a table without words
takes nothing; ties of the hash go by doc_id, and rows alike in both are interchangeable; null ids count like others.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheafwork.llm.shared import n_words, shared_dir, staged, table
from sheafwork.operators.graph import numbered

WEIGHTS, CAP, SEED = (1.0, 2.0, 3.0), 3, 42
#: Budget that the dynamic programme covers, and documents of a length that one ranking task gets, about.
WINDOW, SLICE = 1 << 17, 4096


def fit_counts(lengths: np.ndarray, counts: np.ndarray, budget: int, window: int = WINDOW) -> np.ndarray:
    """How many documents of each length to take so that their words sum up to the budget, or nearly."""
    lengths, counts = np.asarray(lengths, np.int64), np.asarray(counts, np.int64)
    total = int((lengths * counts).sum())
    take = np.zeros(len(lengths), np.int64)
    if total == 0 or budget <= 0:
        return take
    if budget >= total:
        return np.where(lengths > 0, counts, 0)
    take = np.array([int(c) * budget // total for c in counts.tolist()], np.int64)
    take[lengths == 0] = 0
    missing = budget - int((take * lengths).sum())
    order = np.argsort(-lengths, kind="stable")
    for i in order.tolist():  # the longest first, until the rest is in reach of the programme
        if missing <= window or lengths[i] == 0:
            break
        more = min(int(counts[i] - take[i]), max(0, missing - window // 2) // int(lengths[i]))
        take[i] += more
        missing -= more * int(lengths[i])
    while missing > window:
        fitting = [i for i in order.tolist() if 0 < lengths[i] <= missing and take[i] < counts[i]]
        if not fitting:
            return take
        take[fitting[0]] += 1
        missing -= int(lengths[fitting[0]])
    return take + knapsack(lengths, counts - take, missing)


def knapsack(lengths: np.ndarray, left: np.ndarray, budget: int) -> np.ndarray:
    """The choice of at most left[i] documents of each length with the largest sum up to the budget.

    reach[s] says whether s can be met; came[s] the length and number of the packet that met it first.  Counts are split
    into packets of 1, 2, 4, ... documents, so every number up to left[i] can be put together."""
    out = np.zeros(len(lengths), np.int64)
    reach = np.zeros(budget + 1, bool)
    reach[0] = True
    came = np.full(budget + 1, -1, np.int64)
    packets: list[tuple[int, int]] = []
    for i in np.argsort(lengths, kind="stable").tolist():
        size, n, part = int(lengths[i]), int(min(left[i], budget // max(1, int(lengths[i])))), 1
        while size and n > 0 and not reach[budget]:
            part = min(part, n)
            step = part * size
            new = np.flatnonzero(reach[: budget + 1 - step] & ~reach[step:]) + step if step <= budget else np.zeros(0, np.int64)
            reach[new] = True
            came[new] = len(packets)
            packets.append((i, part))
            n -= part
            part *= 2
    at = int(np.flatnonzero(reach)[-1])
    while at:
        i, part = packets[came[at]]
        out[i] += part
        at -= part * int(lengths[i])
    return out


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, words, target) from (source, words), one row a source.

    Capped sources are found in rounds; a round is one aggregate over the sources, and each but the last finds one at
    least that is above its cap."""
    shared_dir(sources.sparkSession)  # where checkpoints go too
    ranked = numbered(sources, [], [F.col("source").asc_nulls_last()], "rank")  # in ranges, as every host may be a source
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod("rank", F.lit(len(weights))).cast("int") + 1)
    weighed = staged(ranked.select("source", "words", weight.alias("weight")), "mix-sources")
    total = weighed.agg(F.sum("words")).first()[0] or 0
    level = 0.0  # words for each unit of weight; sources whose cap is below level * weight are capped
    while True:
        full = F.col("words") * cap < F.col("weight") * level
        capped, free = weighed.agg(F.sum(F.when(full, F.col("words") * cap)), F.sum(F.when(~full, F.col("weight")))).first()
        new = (total - (capped or 0)) / free if free else level
        if new <= level:
            break
        level = new
    return weighed.select("source", "words", F.least(F.col("weight") * level, (F.col("words") * cap).cast("double")).alias("target"))


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: int = CAP, seed: int = SEED, drawn_by: Column | None = None) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of docs (doc_id of any type, text, source); documents of a length are drawn by
    the hash of drawn_by, or of doc_id."""
    draw = F.pmod(F.xxhash64((F.col("doc_id") if drawn_by is None else drawn_by).cast("string"), F.lit(seed)), F.lit(1 << 40))
    sized = staged(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), draw.alias("draw")), "mix-sizes")
    counts = staged(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-counts")
    shares = staged(targets(counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("words")), weights, cap), "mix-targets")

    def fit(data: pd.DataFrame) -> pd.DataFrame:
        target, words = float(data["target"].iloc[0]), int(data["words"].iloc[0])
        times = min(cap, int(target // words)) if words else 0
        extra = fit_counts(data["size"].to_numpy(), data["n"].to_numpy(), int(round(target - times * words)) if times < cap else 0)
        return pd.DataFrame({"source": data["source"], "size": data["size"], "n": data["n"], "words": data["words"], "target": data["target"], "times": times, "extra": extra})

    joined = counts.alias("c").join(shares.alias("t"), same(F.col("c.source"), F.col("t.source"))).select("c.source", "size", "n", "words", "target")
    fitted = joined.groupBy("source").applyInPandas(fit, "source string, size bigint, n bigint, words bigint, target double, times bigint, extra bigint")
    fitted = staged(fitted.withColumn("slices", F.ceil(F.col("n") / SLICE)), "mix-fit")

    dealt = staged(
        sized.alias("d").join(fitted.alias("f"), same(F.col("d.source"), F.col("f.source")) & (F.col("d.size") == F.col("f.size")))
        .select("d.doc_id", "d.source", "d.size", "words", "target", "times", "extra", "draw", F.floor(F.col("draw") * F.col("slices") / F.lit(1 << 40)).alias("slice")),
        "mix-dealt",
    )
    # how many documents of a length are in the slices before: only for lengths that are cut into slices and taken in part
    part = dealt.where("extra > 0").groupBy("source", "size", "slice").agg(F.count("*").alias("here"), F.first("extra").alias("extra"))
    before = part.withColumn("before", F.sum("here").over(Window.partitionBy("source", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)))
    edge = before.select("source", "size", "slice", F.greatest(F.lit(0), F.col("extra") - F.coalesce("before", F.lit(0))).alias("open"))
    ranked = dealt.alias("d").join(edge.alias("e"), same(F.col("d.source"), F.col("e.source")) & (F.col("d.size") == F.col("e.size")) & (F.col("d.slice") == F.col("e.slice")), "left").select("d.*", F.coalesce("open", F.lit(0)).alias("open"))
    place = F.row_number().over(Window.partitionBy("source", "size", "slice").orderBy("draw", "doc_id"))
    chosen = ranked.withColumn("place", place)
    taken = F.col("size") * (F.col("times") + (F.col("place") <= F.col("open")).cast("bigint"))
    return chosen.select("doc_id", F.col("size").cast("bigint").alias("size"), F.col("words").cast("bigint").alias("source_size"), "target", taken.cast("bigint").alias("taken"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))
