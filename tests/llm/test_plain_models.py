"""Whole results of the two trained operators against models that are run word by word, from the fitted numbers alone."""

from __future__ import annotations

import math
import re

import numpy as np
from tests.conftest import DATA

from sheafwork.llm import language_id, toxicity
from sheafwork.llm.shared import fold, table
from sheafwork.llm.word_arrays import AFFIX_BITS, TRIGRAM_BITS, WORD_BITS

M32, M64 = (1 << 32) - 1, (1 << 64) - 1


def bucket(x, bits):
    return max(1, ((x & M32) * 2654435761 & M32) >> (32 - bits))


def word_features(word, before=b" ", after=b" "):
    """(trigrams, prefix, suffix, whole, has a letter) of a lower-case word and the white space on both sides."""
    p = before + word + after
    tri = [bucket(p[i - 1] << 16 | p[i] << 8 | p[i + 1], TRIGRAM_BITS) for i in range(1, len(p) - 1)]
    affix = lambda some: bucket(sum(c << 8 * k for k, c in enumerate(some)), AFFIX_BITS)
    whole, power = 0, 1
    for k, c in enumerate(word):
        if k % 64 == 0:
            power = 1
        power = power * 0x9E3779B1 & M64
        whole = whole + c * power & M64
    letter = any(65 <= c <= 90 or 97 <= c <= 122 or c >= 128 for c in word)
    return tri, affix(word[:4]), affix(word[::-1][:4]), bucket((whole >> 20 ^ whole) & M32, WORD_BITS), letter


def words_in(text):
    return re.findall(rb"[^\x20\x09-\x0d]+", text.lower().encode())


def plain_language(crf, text, known):
    data = b" " + text.lower().encode() + b" "
    k, words = len(crf.labels), [(m[0], data[m.start() - 1 : m.start()], data[m.end() : m.end() + 1]) for m in re.finditer(rb"[^\x20\x09-\x0d]+", data)]
    if not any(word_features(*w)[4] for w in words):
        return "und", 0.0
    scores = []
    for w in words:
        if w not in known:
            tri, pre, suf, whole, letter = word_features(*w)
            known[w] = [float(sum(crf.trigram[j][t] for t in tri) + crf.prefix[j][pre] + crf.suffix[j][suf] + crf.whole[j][whole]) if letter else 0.0 for j in range(k)]
        scores.append(known[w])
    move = [[math.exp(float(crf.step[i][j])) for j in range(k)] for i in range(k)]
    local = [[math.exp(x - max(s)) for x in s] for s in scores]
    norm = lambda v: [x / sum(v) for x in v]
    ahead = [norm([local[0][j] * math.exp(float(crf.start[j])) for j in range(k)])]
    for t in range(1, len(words)):
        ahead.append(norm([sum(ahead[-1][i] * move[i][j] for i in range(k)) * local[t][j] for j in range(k)]))
    back, total, lettered = [1.0] * k, [0.0] * k, 0
    for t in range(len(words) - 1, -1, -1):
        here = norm([ahead[t][j] * back[j] for j in range(k)])
        if word_features(*words[t])[4]:
            lettered += 1
            total = [a + b for a, b in zip(total, here)]
        back = norm([sum(move[i][j] * local[t][j] * back[j] for j in range(k)) for i in range(k)])
    best = max(range(k), key=lambda j: total[j])
    return crf.labels[best], total[best] / lettered


def test_language_query_by_a_plain_field(spark):
    docs = table(spark, str(DATA), "documents")
    crf = language_id.fit(docs.where(fold(docs["doc_id"], 4) != 2))
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.query(spark, str(DATA)).collect()}
    known = {}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        label, score = plain_language(crf, text or "", known)
        assert abs(got[i][1] - score) < 1e-4 and (got[i][0] == label or score < 0.51), i


def gate(x):
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def plain_input(net, word, known):
    """What a word gives to the gates of both directions."""
    if word not in known:
        tri, _, _, whole, _ = word_features(word)
        chars, head = [bucket(t, toxicity.CHAR_BITS) for t in tri], 0
        for k, t in enumerate(tri[:8]):
            head = head * 1_000_003 + t & M32
            if k >= 3:
                chars.append(bucket(head, toxicity.CHAR_BITS))
        x = np.concatenate([net.p["word"][bucket(whole, toxicity.WORD_BITS)], np.mean([net.p["char"][c] for c in chars], axis=0)]).astype(float)
        known[word] = x @ net.p["w"].astype(float) + net.p["b"]
    return known[word]


def plain_window(net, words, known):
    h = toxicity.HIDDEN
    if not words:
        return float(net.p["c"][0])
    states = np.zeros((len(words), 2 * h))
    for d in (0, 1):
        u, s = net.p["u"][d].astype(float), np.zeros(h)
        for t in range(len(words)) if d == 0 else range(len(words) - 1, -1, -1):
            g = plain_input(net, words[t], known)[3 * h * d : 3 * h * (d + 1)]
            z = np.array([gate(v) for v in g[:h] + s @ u[:, :h]])
            r = np.array([gate(v) for v in g[h : 2 * h] + s @ u[:, h : 2 * h]])
            c = np.tanh(g[2 * h :] + (r * s) @ u[:, 2 * h :])
            s = (1 - z) * s + z * c
            states[t, h * d : h * (d + 1)] = s
    weight = np.exp(np.clip(states @ net.p["a"].astype(float), -20, 20))
    return float(weight @ states / weight.sum() @ net.p["v"].astype(float) + net.p["c"][0])


def test_toxicity_query_by_a_plain_network(spark):
    docs, labels = table(spark, str(DATA), "documents"), table(spark, str(DATA), "labels")
    net = toxicity.fit(docs, labels.where(fold(labels["doc_id"], 5) != 0))
    assert net.prior is None
    texts = {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}
    got = {r["doc_id"]: (r["score"], r["predicted"]) for r in toxicity.query(spark, str(DATA)).collect()}
    known = {}
    assert got.keys() == texts.keys()
    for i in sorted(texts)[::4]:
        words = words_in(texts[i])
        starts = range(0, max(1, len(words) - toxicity.WINDOW + toxicity.STRIDE), toxicity.STRIDE)
        top = max(plain_window(net, words[at : at + toxicity.WINDOW], known) for at in starts)
        score = gate(net.slope * top + net.shift)
        assert abs(got[i][0] - score) < 1e-3 and got[i][1] == (got[i][0] >= 0.5), i
