"""Operator 6, toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word's input joins a hashed word vector and the mean of its hashed byte-trigram and prefix vectors (the character
input).  Both
directions run over windows of WINDOW words that overlap by half; attention pools a window's states, and a linear layer
gives its logit.  All windows of a text are scored; the text's score is a logistic function of the largest logit, fitted
on the training sample.

Labels mark texts, not windows, so training alternates: the window of a toxic text that scores highest stands for it,
beside random and hardest windows of other texts.  The first choice goes by words whose share of toxic texts is highest.
The sample is about MOST different labelled texts at most, chosen by hash, and of very long ones a piece.  Texts of any length are
scored whole, some at a time.

Defined cases: null and empty texts are one window without words, whose logit is the bias; without two classes among the
training labels every score is the share of toxic labels (0.5 without labels); rows with a null id are never held out and
have no label; repeated rows get equal results, and repeated labels of one id count as toxic if any is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafwork.llm.shared import fold, hash_sample, spread, table
from sheafwork.llm.word_arrays import hashed, words_of

#: Bound of the training sample (labelled texts).
MOST = 4000
#: Code points of a training text; of a longer one a piece from a place that its hash says is taken.
SAMPLE_CHARS = 20_000
WINDOW, STRIDE, HIDDEN, WORD_DIM, CHAR_DIM = 16, 8, 8, 12, 8
WORD_BITS, CHAR_BITS = 15, 15
ROUNDS, STEPS, BATCH = 3, 220, 96


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Net:
    """word, char: embeddings.  w (inputs x 6H), u (2 x H x 3H), b (6H): update, reset and candidate gates of the forward,
    then of the backward direction.  a (2H): attention.  v (2H), c: the logit."""

    p: dict[str, np.ndarray]
    slope: float = 1.0
    shift: float = 0.0
    prior: float | None = None

    @staticmethod
    def fresh(seed: int) -> Net:
        r, h, d = np.random.default_rng(seed), HIDDEN, WORD_DIM + CHAR_DIM
        f = lambda *s, k=0.3: (r.standard_normal(s) * k).astype(np.float32)
        word, char = f(1 << WORD_BITS, WORD_DIM, k=0.1), f(1 << CHAR_BITS, CHAR_DIM, k=0.1)
        return Net({"word": word, "char": char, "w": f(d, 6 * h), "u": f(2, h, 3 * h), "b": np.zeros(6 * h, np.float32), "a": f(2 * h, k=0.1), "v": f(2 * h), "c": np.zeros(1, np.float32)})


@dataclass
class Vocabulary:
    """Distinct words: their word bucket and the buckets of their characters (flat, with offsets)."""

    word: np.ndarray
    flat: np.ndarray
    offset: np.ndarray

    @staticmethod
    def of(words: list[str]) -> Vocabulary:
        """Characters go in as trigrams and as the word's first 4 to 8 bytes."""
        w = words_of(words)  # words hold no white space, so each is one word
        if not len(w):
            return Vocabulary(np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(1, np.int64))
        codes = w.trigram[w.start[0] :]
        ink = np.flatnonzero(codes)
        owner = [np.repeat(np.arange(len(w)), np.add.reduceat(codes > 0, w.start - w.start[0]))]
        flat = [hashed(codes[ink], CHAR_BITS)]
        size = np.bincount(owner[0], minlength=len(w))
        head = np.zeros(len(w), np.uint32)
        for k in range(8):
            with np.errstate(over="ignore"):
                head = np.where(size > k, head * np.uint32(1_000_003) + codes[np.minimum(w.start - w.start[0] + k, len(codes) - 1)].astype(np.uint32), head)
            if k >= 3:
                long = np.flatnonzero(size > k)
                owner.append(long)
                flat.append(hashed(head[long], CHAR_BITS))
        own = np.concatenate(owner)
        order = np.argsort(own, kind="stable")
        return Vocabulary(hashed(w.whole, WORD_BITS), np.concatenate(flat)[order], np.concatenate([[0], np.cumsum(np.bincount(own, minlength=len(w)))]).astype(np.int64))

    def inputs(self, net: Net) -> np.ndarray:
        """words x (WORD_DIM + CHAR_DIM); the last row stands for 'no word' and is zero."""
        n = len(self.word)
        out = np.zeros((n + 1, WORD_DIM + CHAR_DIM), np.float32)
        if n:
            out[:n, :WORD_DIM] = net.p["word"][self.word]
            out[:n, WORD_DIM:] = np.add.reduceat(net.p["char"][self.flat], self.offset[:-1], axis=0) / np.maximum(np.diff(self.offset), 1)[:, None]
        return out


def run(net: Net, x: np.ndarray, idx: np.ndarray, keep: bool = False) -> tuple[np.ndarray, dict]:
    """Logits of windows.  x: gate inputs of the vocabulary, (words + 1) x 6H; idx: windows x WINDOW of rows of x, the
    last row for 'no word'."""
    h, n, t_all = HIDDEN, len(idx), idx.shape[1]
    mask = idx < len(x) - 1
    states = np.zeros((t_all, n, 2 * h), np.float32)
    kept: dict = {"gates": {}}
    for d in (0, 1):
        part = np.ascontiguousarray(x[:, 3 * h * d : 3 * h * (d + 1)])
        u = net.p["u"][d]
        s = np.zeros((n, h), np.float32)
        for t in range(t_all) if d == 0 else range(t_all - 1, -1, -1):
            g = part[idx[:, t]]
            zr = g[:, : 2 * h] + s @ u[:, : 2 * h]
            np.negative(zr, out=zr)
            np.exp(zr, out=zr)
            zr += 1
            np.reciprocal(zr, out=zr)
            z, r = zr[:, :h], zr[:, h:]
            c = np.tanh(g[:, 2 * h :] + (r * s) @ u[:, 2 * h :])
            if keep:
                kept["gates"][d, t] = (s, z, r, c)
            s = s + z * (c - s)
            s *= mask[:, t, None]
            states[t, :, h * d : h * (d + 1)] = s
    e = np.exp(np.clip(states @ net.p["a"], -20, 20)) * mask.T
    total = np.maximum(e.sum(axis=0), 1e-9)
    weight = e / total
    pooled = np.einsum("tn,tnk->nk", weight, states)
    kept |= {"states": states, "weight": weight, "pooled": pooled, "mask": mask}
    return pooled @ net.p["v"] + net.p["c"][0], kept


def gradients(net: Net, voc: Vocabulary, rows: np.ndarray, y: np.ndarray) -> tuple[dict[str, np.ndarray], float]:
    """Of the mean cross entropy over windows (rows of the vocabulary, len(voc.word) for none)."""
    p, h, n = net.p, HIDDEN, len(rows)
    x = voc.inputs(net)
    gate = x @ p["w"] + p["b"]
    gate[-1] = 0
    logit, k = run(net, gate, rows, keep=True)
    q = sigmoid(logit)
    loss = float(-(y * np.log(q + 1e-9) + (1 - y) * np.log(1 - q + 1e-9)).mean())
    d_logit = ((q - y) / n).astype(np.float32)
    g = {name: np.zeros_like(a) for name, a in p.items()}
    g["c"][0] = d_logit.sum()
    g["v"] = k["pooled"].T @ d_logit
    d_pool = d_logit[:, None] * p["v"]
    d_states = k["weight"][:, :, None] * d_pool
    along = np.einsum("nk,tnk->tn", d_pool, k["states"])
    d_att = k["weight"] * (along - (k["weight"] * along).sum(axis=0))
    g["a"] = np.einsum("tn,tnk->k", d_att, k["states"])
    d_states = d_states + d_att[:, :, None] * p["a"]
    d_gate = np.zeros_like(gate)
    t_all = rows.shape[1]
    for d in (0, 1):
        u = p["u"][d]
        carry = np.zeros((n, h), np.float32)
        for t in range(t_all - 1, -1, -1) if d == 0 else range(t_all):
            s, z, r, c = k["gates"][d, t]
            ds = (d_states[t, :, h * d : h * (d + 1)] + carry) * k["mask"][:, t, None]
            dc = ds * z * (1 - c * c)
            drs = dc @ u[:, 2 * h :].T
            dzr = np.concatenate([ds * (c - s) * z * (1 - z), drs * s * r * (1 - r)], axis=1)
            carry = ds * (1 - z) + drs * r + dzr @ u[:, : 2 * h].T
            g["u"][d][:, : 2 * h] += s.T @ dzr
            g["u"][d][:, 2 * h :] += (r * s).T @ dc
            np.add.at(d_gate[:, 3 * h * d : 3 * h * (d + 1)], rows[:, t], np.concatenate([dzr, dc], axis=1))
    d_gate[-1] = 0
    g["w"] = x.T @ d_gate
    g["b"] = d_gate.sum(axis=0)
    dx = d_gate @ p["w"].T
    np.add.at(g["word"], voc.word, dx[:-1, :WORD_DIM])
    size = np.diff(voc.offset)
    np.add.at(g["char"], voc.flat, np.repeat(dx[:-1, WORD_DIM:] / np.maximum(size, 1)[:, None], size, axis=0))
    return g, loss


def index_words(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct lower-case words, the number of each word of all texts, and the word counts of the texts."""
    cut = [t.lower().encode("utf-8", "surrogatepass").split() for t in texts]
    seen: dict[bytes, int] = {}
    flat = np.array([seen.setdefault(w, len(seen)) for ws in cut for w in ws], np.int32)
    return [w.decode("utf-8", "surrogatepass") for w in seen], flat, np.array([len(ws) for ws in cut], np.int64)


def windows_of(flat: np.ndarray, sizes: np.ndarray, none: int) -> tuple[np.ndarray, np.ndarray]:
    """(windows x WINDOW rows, the text of each window): starts every STRIDE words until a window reaches the end."""
    n = np.maximum(1, -(-(sizes - WINDOW) // STRIDE) + 1)
    doc = np.repeat(np.arange(len(sizes)), n)
    begin = (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * STRIDE
    at = begin[:, None] + np.arange(WINDOW)
    first = np.cumsum(sizes) - sizes
    rows = np.full(at.shape, none, np.int32)
    ok = at < sizes[doc][:, None]
    rows[ok] = flat[(at + first[doc][:, None])[ok]]
    return rows, doc


def window_logits(net: Net, gate: np.ndarray, rows: np.ndarray, step: int = 4096) -> np.ndarray:
    return np.concatenate([run(net, gate, rows[i : i + step])[0] for i in range(0, len(rows), step)]) if len(rows) else np.zeros(0, np.float32)


def gates_of(net: Net, voc: Vocabulary) -> np.ndarray:
    gate = voc.inputs(net) @ net.p["w"] + net.p["b"]
    gate[-1] = 0
    return gate


def train(texts: list[str], toxic: np.ndarray, seed: int = 0) -> Net:
    rng = np.random.default_rng(seed)
    net = Net.fresh(seed)
    y = np.asarray(toxic).astype(np.float32)
    if len(y) == 0 or y.min() == y.max():
        net.prior = 0.5 if len(y) == 0 else float(y.mean())
        return net
    words, flat, sizes = index_words(texts)
    voc = Vocabulary.of(words)
    rows, doc = windows_of(flat, sizes, len(words))
    # words by the log-odds of their share of toxic and other texts: the first choice of windows
    pairs = np.unique(np.repeat(np.arange(len(sizes)), sizes).astype(np.int64) * max(1, len(words)) + flat)
    in_toxic = np.bincount(pairs % max(1, len(words)), weights=y[pairs // max(1, len(words))], minlength=len(words))
    in_all = np.bincount(pairs % max(1, len(words)), minlength=len(words))
    odds = np.log((in_toxic + 0.5) / (y.sum() + 1)) - np.log((in_all - in_toxic + 0.5) / ((1 - y).sum() + 1))
    odds = np.append(np.where(in_all >= 5, odds, 0), -9)
    guess = odds[rows].max(axis=1)
    moments = {k: (np.zeros_like(a), np.zeros_like(a)) for k, a in net.p.items()}
    order = np.arange(len(doc))
    clean = np.flatnonzero(y[doc] == 0)
    step = 0
    for turn in range(ROUNDS):
        best = np.lexsort((order, -guess, doc))
        best = best[np.unique(doc[best], return_index=True)[1]]  # the highest window of every text
        pos, hard = best[y == 1], best[y == 0]
        for _ in range(STEPS):
            pick = np.concatenate([rng.choice(pos, BATCH // 2), rng.choice(hard, BATCH // 4), rng.choice(clean, BATCH // 4)])
            own, sub = np.unique(rows[pick], return_inverse=True)
            own = own[own < len(words)]
            small = Vocabulary(voc.word[own], np.concatenate([voc.flat[voc.offset[i] : voc.offset[i + 1]] for i in own]) if len(own) else voc.flat[:0], np.concatenate([[0], np.cumsum(voc.offset[own + 1] - voc.offset[own])]).astype(np.int64))
            g, _loss = gradients(net, small, sub.reshape(len(pick), WINDOW), y[doc[pick]])
            step += 1
            for k, a in net.p.items():
                m, s = moments[k]
                m += 0.1 * (g[k] - m)
                s += 0.01 * (g[k] * g[k] - s)
                a -= 0.02 * 0.6**turn * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-6)
        guess = window_logits(net, gates_of(net, voc), rows)
    top = np.full(len(y), -np.inf)
    np.maximum.at(top, doc, guess)
    z = (top - top.mean()) / (top.std() + 1e-9)
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton steps of a logistic regression on the largest logit
        q = sigmoid(a * z + b)
        w = q * (1 - q) + 1e-4
        hess = np.array([[(w * z * z).sum() + 1e-2, (w * z).sum()], [(w * z).sum(), w.sum()]])
        da, db = np.linalg.solve(hess, [((y - q) * z).sum() - 1e-2 * a, (y - q).sum()])
        a, b = a + da, b + db
    net.slope, net.shift = float(a / (top.std() + 1e-9)), float(b - a * top.mean() / (top.std() + 1e-9))
    return net


def score_texts(net: Net, texts: list[str], most: int = 1 << 21) -> np.ndarray:
    if net.prior is not None:
        return np.full(len(texts), net.prior)
    out = np.zeros(len(texts))
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= most):
            size += len(texts[end])
            end += 1
        words, flat, sizes = index_words(texts[at:end])
        rows, doc = windows_of(flat, sizes, len(words))
        logit = window_logits(net, gates_of(net, Vocabulary.of(words)), rows)
        top = np.maximum.reduceat(logit, np.searchsorted(doc, np.arange(end - at)))
        out[at:end] = sigmoid(net.slope * top + net.shift)
        at = end
    return out


def fit(docs: DataFrame, labels: DataFrame, toxic: str = "toxic") -> Net:
    """Learns from docs (doc_id, text) whose ids labels (doc_id, toxic) marks 0 or 1."""
    marks = labels.where(F.col("doc_id").isNotNull() & F.col(toxic).isNotNull()).groupBy("doc_id").agg(F.max(toxic).alias("y"))
    sample = hash_sample(marks, F.col("doc_id"), MOST, seed=5)  # at most about MOST rows, so they can be broadcast
    text = F.coalesce("text", F.lit(""))
    spare = F.greatest(F.length(text) - SAMPLE_CHARS, F.lit(0)) + 1
    piece = F.call_function("substring", text, (F.pmod(F.xxhash64(text), spare) + 1).cast("int"), F.lit(SAMPLE_CHARS))
    found = docs.select("doc_id", piece.alias("text")).join(F.broadcast(sample), "doc_id").distinct()
    found = hash_sample(found, F.concat(F.col("doc_id").cast("string"), F.lit(":"), "text"), MOST, seed=6).orderBy("doc_id", "text").collect()
    return train([r["text"] for r in found], np.array([r["y"] > 0 for r in found]))


def score(docs: DataFrame, net: Net) -> DataFrame:
    model = docs.sparkSession.sparkContext.broadcast(net)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = score_texts(model.value, [t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(work, "doc_id bigint, score double, predicted int")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    net = fit(docs, labels.where(fold(F.col("doc_id"), 5) != 0))
    return score(spread(docs), net).select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")
