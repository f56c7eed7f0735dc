"""Operator 3, language identification: a linear-chain conditional random field over the words of a text.

Features of a word are hashed: its affixes (first and last four bytes), its byte trigrams (with the spaces around it)
and the word itself (the lexicon).  Label transitions are learned.  Forward-backward gives each word's label
probabilities in its context, so a text that switches languages is labelled word by word; a text's language is the label
with the highest mean probability over the words that have letters, and that mean is its score.

Training takes a bounded, hash-chosen sample of labelled texts (MOST_PER_LANG of each language), cuts runs of words from
them and splices runs of different languages into sequences of SEQUENCE words, so that transitions are seen.

Very long texts are labelled whole, some of them at a time.

Defined cases: null texts and texts without a letter get ``und`` and score 0; rows with null lang teach nothing; if
nothing can be learned, every text with a letter gets ``und``; rows with a null id are never held out; repeated rows get
equal results; columns other than those named are dropped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafwork.llm.shared import fold, spread, table
from sheafwork.llm.word_arrays import AFFIX_BITS, TRIGRAM_BITS, WORD_BITS, Words, chunks, words_of

UNKNOWN = "und"
#: Bounds of the training sample: labelled texts of each language, and how many languages may have so many.  Beyond that each
#: language has fewer texts (one at least) and each label fewer buckets, so sample and model stay as large.
MOST_PER_LANG, MOST_LANGS, SAMPLE_CHARS = 300, 200, 4000
SEQUENCE, BATCH, STEPS = 48, 64, 260


@dataclass
class Crf:
    labels: list[str]
    trigram: np.ndarray  # labels x buckets, like the next three
    prefix: np.ndarray
    suffix: np.ndarray
    whole: np.ndarray
    start: np.ndarray
    step: np.ndarray  # from label x to label
    fold: int = 0  # the buckets of a feature are 2**fold to one

    def buckets(self, w: Words) -> Words:
        """w with its features in this model's buckets; 0 stays no feature."""
        part = lambda codes: (codes + ((1 << self.fold) - 1)) >> self.fold
        return Words(w.doc, w.start, part(w.trigram), part(w.prefix), part(w.suffix), part(w.whole), w.letters) if self.fold else w

    def emissions(self, w: Words) -> np.ndarray:
        """words x labels"""
        w = self.buckets(w)
        out = np.empty((len(w), len(self.labels)), np.float32)
        codes = w.trigram[w.start[0] :] if len(w) else w.trigram
        for k in range(len(self.labels)):
            out[:, k] = np.add.reduceat(self.trigram[k][codes], w.start - w.start[0])
            out[:, k] += self.prefix[k][w.prefix] + self.suffix[k][w.suffix] + self.whole[k][w.whole]
        out[~w.letters] = 0
        return out


def forward_backward(e: np.ndarray, start: np.ndarray, step: np.ndarray, live: np.ndarray | None = None) -> np.ndarray:
    """Label probabilities of words: e and the result are length x sequences x labels.  live[t]: how many of the
    sequences, sorted by falling length, have a word t."""
    n, b, k = e.shape
    p = np.exp(e - e.max(axis=2, keepdims=True))
    move = np.exp(step)
    alpha = np.zeros_like(p)
    now = p[0] * np.exp(start)
    alpha[0] = now / now.sum(axis=1, keepdims=True)
    for t in range(1, n):
        m = b if live is None else live[t]
        now = (alpha[t - 1, :m] @ move) * p[t, :m]
        alpha[t, :m] = now / now.sum(axis=1, keepdims=True)
    beta = np.ones((b, k), p.dtype)
    for t in range(n - 2, -1, -1):
        m = b if live is None else live[t + 1]
        now = (beta[:m] * p[t + 1, :m]) @ move.T
        beta[:m] = now / now.sum(axis=1, keepdims=True)
        alpha[t] *= beta
        if m < b:
            beta[m:] = 1
    alpha /= np.maximum(alpha.sum(axis=2, keepdims=True), 1e-30)
    return alpha


def pair_expectation(e: np.ndarray, start: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities, and the expected count of each transition over all sequences."""
    n, b, k = e.shape
    p = np.exp(e - e.max(axis=2, keepdims=True))
    move = np.exp(step)
    alpha, beta = np.zeros_like(p), np.ones_like(p)
    now = p[0] * np.exp(start)
    alpha[0] = now / now.sum(axis=1, keepdims=True)
    for t in range(1, n):
        now = (alpha[t - 1] @ move) * p[t]
        alpha[t] = now / now.sum(axis=1, keepdims=True)
    for t in range(n - 2, -1, -1):
        now = (beta[t + 1] * p[t + 1]) @ move.T
        beta[t] = now / now.sum(axis=1, keepdims=True)
    after = beta[1:] * p[1:]
    total = ((alpha[:-1] @ move) * after).sum(axis=2, keepdims=True)
    pairs = move * ((alpha[:-1] / total).reshape(-1, k).T @ after.reshape(-1, k))
    post = alpha * beta
    return post / post.sum(axis=2, keepdims=True), pairs


def train(texts: list[str], langs: list[str], seed: int = 0) -> Crf | None:
    """AdaGrad ascent of the conditional likelihood of spliced sequences."""
    labels = sorted(set(langs))
    k = len(labels)
    w = words_of(texts)
    if not k or not len(w):
        return None
    number = {x: i for i, x in enumerate(labels)}
    gold_of = np.array([number[x] for x in langs])
    rng = np.random.default_rng(seed)
    first = np.searchsorted(w.doc, np.arange(len(texts)))
    count = np.searchsorted(w.doc, np.arange(len(texts)), side="right") - first
    by_label = [np.flatnonzero((gold_of == i) & (count > 0)) for i in range(k)]
    present = [i for i in range(k) if len(by_label[i])]
    fold_ = min(AFFIX_BITS - 4, max(0, math.ceil(math.log2(k / MOST_LANGS))))
    bits = {"trigram": TRIGRAM_BITS, "prefix": AFFIX_BITS, "suffix": AFFIX_BITS, "whole": WORD_BITS}
    shapes = {name: (1 << b - fold_) + (fold_ > 0) for name, b in bits.items()}
    crf = Crf(labels, *[np.zeros((k, n), np.float32) for n in shapes.values()], np.zeros(k, np.float32), np.zeros((k, k), np.float32), fold_)
    seen = {name: np.full((k, n), 1e-3, np.float32) for name, n in shapes.items()}
    seen_start, seen_step = np.full(k, 1e-3), np.full((k, k), 1e-3)
    reach = np.diff(np.append(w.start, len(w.trigram)))
    for _ in range(STEPS):
        picks, golds = [], []
        for _ in range(BATCH):
            run: list[np.ndarray] = []
            gold: list[int] = []
            while len(gold) < SEQUENCE:
                label = present[rng.integers(len(present))]
                doc = by_label[label][rng.integers(len(by_label[label]))]
                size = min(int(rng.integers(8, SEQUENCE + 1)), int(count[doc]), SEQUENCE - len(gold))
                at = first[doc] + rng.integers(0, count[doc] - size + 1)
                run.append(np.arange(at, at + size))
                gold += [label] * size
            picks.append(np.concatenate(run))
            golds.append(gold)
        idx, gold_ = np.array(picks).T.ravel(), np.array(golds).T  # word t of all sequences, then word t + 1
        sizes = reach[idx]
        spans = np.repeat(w.start[idx] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        sub = Words(w.doc[idx], np.cumsum(sizes) - sizes, w.trigram[spans], w.prefix[idx], w.suffix[idx], w.whole[idx], w.letters[idx])
        e = crf.emissions(sub).reshape(SEQUENCE, BATCH, k)
        post, pairs = pair_expectation(e, crf.start, crf.step)
        want = np.eye(k, dtype=np.float32)[gold_]
        grad = (want - post).reshape(-1, k)
        grad[~sub.letters] = 0
        sub = crf.buckets(sub)
        for name, codes, weights in (("trigram", sub.trigram, np.repeat(grad, sizes, axis=0)), ("prefix", sub.prefix, grad), ("suffix", sub.suffix, grad), ("whole", sub.whole, grad)):
            x, s = getattr(crf, name), seen[name]
            for j in range(k):
                g = np.bincount(codes, weights=weights[:, j], minlength=x.shape[1]).astype(np.float32) / BATCH
                s[j] += g * g
                x[j] += 0.1 * g / np.sqrt(s[j])
            x *= 0.9995
            x[:, 0] = 0
        true_pairs = np.zeros((k, k))
        np.add.at(true_pairs, (gold_[:-1].ravel(), gold_[1:].ravel()), 1)
        g = (true_pairs - pairs) / BATCH
        seen_step += g * g
        crf.step += (0.1 * g / np.sqrt(seen_step)).astype(np.float32)
        g = (want[0] - post[0]).sum(axis=0) / BATCH
        seen_start += g * g
        crf.start += (0.1 * g / np.sqrt(seen_start)).astype(np.float32)
    return crf


def label_texts(crf: Crf, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(label number, score, certainty) of each text; label -1 where no word has a letter."""
    k = len(crf.labels)
    label, score, certainty = np.full(len(texts), -1), np.zeros(len(texts)), np.zeros(len(texts))
    for begin, part in chunks(texts, 1 << 19):
        w = words_of(part)
        if not len(w):
            continue
        e = crf.emissions(w)
        first = np.searchsorted(w.doc, np.arange(len(part)))
        count = np.searchsorted(w.doc, np.arange(len(part)), side="right") - first
        order = np.argsort(-count, kind="stable")
        order = order[count[order] > 0]
        at = 0
        while at < len(order):  # texts of like length together, longest first
            group = order[at : at + max(1, 200_000 * MOST_LANGS // max(k, MOST_LANGS) // int(count[order[at]]))]
            at += len(group)
            sizes = count[group]
            n = int(sizes[0])
            t = np.arange(n)
            live = (sizes[None, :] > t[:, None]).sum(axis=1)
            block = np.zeros((n, len(group), k), np.float32)
            cells = np.concatenate([np.arange(f, f + c) for f, c in zip(first[group], sizes)])
            rows, cols = np.concatenate([np.arange(c) for c in sizes]), np.repeat(np.arange(len(group)), sizes)
            block[rows, cols] = e[cells]
            post = forward_backward(block, crf.start, crf.step, live)[rows, cols] * w.letters[cells][:, None]
            total = np.stack([np.bincount(cols, weights=post[:, j], minlength=len(group)) for j in range(k)], axis=1)
            lettered = np.bincount(cols, weights=w.letters[cells], minlength=len(group))
            best = total.argmax(axis=1)
            label[begin + group] = np.where(lettered > 0, best, -1)
            score[begin + group] = np.where(lettered > 0, total[np.arange(len(group)), best] / np.maximum(lettered, 1), 0)
            certainty[begin + group] = np.bincount(cols, weights=post.max(axis=1), minlength=len(group)) / np.maximum(lettered, 1)
    return label, score, certainty


def fit(docs: DataFrame, lang: str = "lang") -> Crf | None:
    """Learns from docs (text, lang, doc_id): at most MOST_PER_LANG texts of each language, fewer if there are more than
    MOST_LANGS of them, but of each language one at least; of a longer text a piece of SAMPLE_CHARS code points from a place that its
    hash says.  So the driver gets at most MOST_PER_LANG * MOST_LANGS pieces."""
    spare = F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0)) + 1
    piece = F.call_function("substring", F.col("text"), (F.pmod(F.xxhash64("text"), spare) + 1).cast("int"), F.lit(SAMPLE_CHARS)).alias("text")
    known = docs.where(F.col(lang).isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", F.col(lang).alias("lang"))
    counts = known.groupBy("lang").count().collect()
    if not counts:
        return None
    most = min(MOST_PER_LANG, max(1, MOST_PER_LANG * MOST_LANGS // len(counts)))
    shares = docs.sparkSession.createDataFrame([(r["lang"], min(1.0, most / r["count"])) for r in counts], "lang string, _share double")
    chance = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.col("text"), F.lit(3)), F.lit(1 << 40)) / float(1 << 40)
    drawn = known.join(F.broadcast(shares), "lang").where(chance < F.col("_share"))
    sample = [(r["text"], r["lang"]) for r in drawn.select("doc_id", piece, "lang").distinct().orderBy("doc_id", "text", "lang").collect()]
    missed = sorted({r["lang"] for r in counts} - {x for _, x in sample})
    if missed:
        of_missed = known.join(F.broadcast(docs.sparkSession.createDataFrame([(x,) for x in missed], "lang string")), "lang")
        one = of_missed.groupBy("lang").agg(F.min(F.struct(chance.alias("c"), piece)).alias("x"))
        sample += sorted((r["text"], r["lang"]) for r in one.select("x.text", "lang").collect())
    return train([t for t, _ in sample], [x for _, x in sample])


def identify(docs: DataFrame, crf: Crf | None) -> DataFrame:
    """(doc_id, lang_pred, score, certainty) of docs (doc_id of any type, text).  certainty is the mean over words with letters of the
    largest label probability, whatever the label: it is high for a text that switches languages, each word of which is clear."""
    model = docs.sparkSession.sparkContext.broadcast(crf)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            if model.value is None:
                label, score, certainty, names = np.full(len(texts), -1), np.zeros(len(texts)), np.zeros(len(texts)), []
            else:
                names = model.value.labels
                label, score, certainty = label_texts(model.value, texts)
            told = [names[k] if k >= 0 and any(map(str.isalpha, t)) else None for k, t in zip(label.tolist(), texts)]
            bounded = lambda v: pa.array([float(min(1, max(0, s))) if x is not None else 0.0 for x, s in zip(told, v)], pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([UNKNOWN if x is None else x for x in told], pa.string()), bounded(score), bounded(certainty)],
                names=["doc_id", "lang_pred", "score", "certainty"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {kind}, lang_pred string, score double, certainty double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("doc_id", F.col("doc_id").cast("bigint"))
    crf = fit(docs.where(fold(F.col("doc_id"), 4) != 2))
    return identify(spread(docs), crf).select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")
