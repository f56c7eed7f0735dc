"""Each operator against brute force, round trips or held-out accuracy, and on the edge cases of conftest."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tests.conftest import DATA
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sheafwork.llm import catalog, decontaminate, kneser_ney, language_id, merkle, mixing, simhash, simple8b, token_ids, toxicity, url_filter, warc
from sheafwork.llm.shared import ASCII_LOWER, byte_words, fold, in_ranges
from tests.llm.conftest import LONG, TEXTS


def fold_of(i, n):
    return zlib.crc32(str(i).encode()) % n


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_matches_sql(name, spark, duck, same_rows):
    same_rows(catalog.QUERIES[name](spark, str(DATA)).toPandas(), duck.execute(catalog.ORACLE[name]).df())


# -- 1 -------------------------------------------------------------------------------------------------------------------


def test_url_rules_by_brute_force(spark):
    rules = [url_filter.Rule("net", "/", "block"), url_filter.Rule("a.net", "/x", "allow"), url_filter.Rule("a.net", "/x/y/", "block"), url_filter.Rule("", "/z", "block"), url_filter.Rule("a.net", "/x", "block")]
    hosts, paths = ["net", "a.net", "b.a.net", "ba.net", "org", ""], ["", "/", "/x", "/xy/y/", "/x/y", "/x/y/z", "/z1", "/q"]
    urls = [f"http://{h}{p}{tail}" for h in hosts for p in paths for tail in ("", "?u=://net/", "#f")] + [None, "", "no scheme", "HTTP://A.NET/x", "a://b://c/d"]
    got = url_filter.judge_urls(spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id int, url string, host string"), rules).collect()
    assert len(got) == len(urls)
    for r in got:
        rest = urls[r["page_id"]].split("://", 1)[1] if urls[r["page_id"]] and "://" in urls[r["page_id"]] else ""
        cut = min([k for k in (rest.find(c) for c in "/?#") if k >= 0], default=len(rest))
        host, path = rest[:cut].translate(ASCII_LOWER), rest[cut:].split("?")[0].split("#")[0]
        fits = [x for x in rules if (host == x.host or host.endswith("." + x.host) or not x.host) and path.startswith(x.path)]
        best = max(fits, key=lambda x: (len(x.host.split(".")) if x.host else 0, len(x.path), x.verdict == "block"), default=None)
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, best and best.text, best.verdict if best else "allow")
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id int, url string, _won string, rule string")
    joined = url_filter.judge_by_join(pages, spark.createDataFrame([(x.host, x.path, x.verdict) for x in rules], "host string, path string, verdict string"), "url", "allow")
    assert sorted(map(str, joined.select("page_id", "host", "path", "rule", "verdict", "_won").collect())) == sorted(map(str, url_filter.judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict", "_won").collect()))
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0


def test_very_deep_url_rules(spark):
    deep = "/a" * 3000 + "/"
    rules = [url_filter.Rule("x.org", deep, "block"), url_filter.Rule("org", "/a/", "allow"), url_filter.Rule("org", "/a/", "block")]
    pages = spark.createDataFrame([(1, "http://w.x.org" + deep + "q"), (2, "http://x.org/a/a"), (3, "http://x.org/"), (4, None)], "page_id int, url string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.judge_urls(pages, rules).collect()}
    assert got == {1: ("x.org" + deep, "block"), 2: ("org/a/", "block"), 3: (None, "allow"), 4: (None, "allow")}


# -- 2 -------------------------------------------------------------------------------------------------------------------


def test_merkle_against_brute_force(spark, docs, no_docs):
    order = sorted(((i, t or "") for i, t, *_ in TEXTS), key=lambda x: (x[0] is None, -(x[0] or 0), x[1]))
    want = []
    for (i, t), (_, following) in zip(order, order[1:] + order[:1]):
        half = len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        prints = [merkle.build_tree(x).fingerprint() for x in (t, edited, following)]
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), prints[0], prints[1], merkle.likeness(*prints[:2]), merkle.likeness(prints[0], prints[2])))
    got = [tuple(r) for r in merkle.fingerprints(docs).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert merkle.fingerprints(no_docs).count() == 0
    one = merkle.fingerprints(docs.where("doc_id = 6")).first()
    assert one["near_next"] == 1.0


def test_merkle_tree_the_other_way_round():
    """Nested lists of leaves first, then their hashes from the top down."""
    h = lambda *parts: hashlib.blake2b(b"".join(parts), digest_size=16).digest()
    for text in [t for _, t, *_ in TEXTS if t] + ["a. b! c?\n\nd | e | f\n" * 30, "\n\n", "one two three four five six seven eight nine ten."]:
        lines = [[h(m.group().encode()) for m in merkle.LEAF.finditer(x)] or [h(b"")] for x in text.split("\n")]
        cut = [i + 1 for i, x in enumerate(text.split("\n")) if not x.strip() or h(*lines[i])[0] % 8 == 0]
        parts = [lines[a:b] for a, b in zip([0, *cut], [*cut, len(lines)]) if a < b]
        root = h(*[h(*[h(*p) for p in s]) for s in parts])
        assert "".join(m.group() for m in merkle.LEAF.finditer(text.replace("\n", ""))) == text.replace("\n", "")
        assert merkle.build_tree(text).fingerprint() == root.hex() + ":" + "/".join(".".join("".join(x.hex()[:6] for x in p) for p in s) for s in parts)


@pytest.mark.parametrize("descending", [False, True])
def test_ranges_are_even_and_in_order(spark, descending):
    rows = [(None if k % 3 == 0 else 7 if k % 3 == 1 else k, None if k % 50 == 0 else f"text {k * 7919 % 1000}") for k in range(3000)]
    got = in_ranges(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4), 16, descending).collect()
    key = lambda x: (x["doc_id"] is None, -(x["doc_id"] or 0), x["text"] or "") if descending else (x["doc_id"] is not None, x["doc_id"] or 0, x["text"] or "")
    assert [x["bucket"] for x in sorted(got, key=key)] == sorted(x["bucket"] for x in got) and len(got) == 3000
    sizes = Counter(x["bucket"] for x in got)
    assert set(sizes) == set(range(16)) and max(sizes.values()) < 3 * 3000 / 16


def test_merkle_likeness_and_diff():
    text = "\n".join(f"Paragraph {i} says this and that. It has another sentence {i * 7}." for i in range(40))
    half = merkle.edit(text, "Something else entirely. " * 200)
    near = merkle.likeness(merkle.build_tree(text).fingerprint(), merkle.build_tree(half).fingerprint())
    far = merkle.likeness(merkle.build_tree(text).fingerprint(), merkle.build_tree("Nothing in common here.").fingerprint())
    assert 0.35 < near < 0.65 and far == 0
    changed = text.replace("Paragraph 17 says", "Paragraph 17 shouts")
    print_ = lambda t: merkle.build_tree(t).fingerprint()
    found = merkle.diff(print_(text), print_(changed))
    assert [side for side, *_ in found] == ["a", "b"] and found[0][1:] == found[1][1:] and merkle.diff(print_(text), print_(text)) == []
    moved = "\n".join([*text.split("\n")[1:], text.split("\n")[0]])
    assert len(merkle.diff(print_(text), print_(moved))) in range(2, 20) and len(merkle.diff(print_(text), print_(""))) == 40
    assert merkle.build_tree("a\n").root != merkle.build_tree("a").root and merkle.build_tree("").root == merkle.build_tree(None).root


# -- 3 -------------------------------------------------------------------------------------------------------------------


def test_language_id(spark, docs, no_docs):
    found = language_id.query(spark, str(DATA)).join(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (found.lang == found.lang_pred).mean() > 0.95 and found.score.between(0, 1).all()
    crf = language_id.fit(docs)
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in language_id.identify(docs, crf).collect()]
    assert len(got) == len(TEXTS) and {g[1] for g in got if g[0] in (3, 4, 5, 8)} == {"und"}
    assert language_id.fit(no_docs) is None and language_id.identify(no_docs, crf).count() == 0
    assert {r["lang_pred"] for r in language_id.identify(docs, None).collect()} == {"und"}


def test_forward_backward_by_enumeration():
    rng = np.random.default_rng(1)
    e, start, step = rng.normal(size=(4, 2, 3)).astype(np.float32), rng.normal(size=3).astype(np.float32), rng.normal(size=(3, 3)).astype(np.float32)
    got = language_id.forward_backward(e, start, step, np.array([2, 2, 2, 1]))
    for b, n in ((0, 4), (1, 3)):
        want = np.zeros((n, 3))
        for ys in np.ndindex(*[3] * n):
            w = math.exp(start[ys[0]] + sum(e[t, b, y] for t, y in enumerate(ys)) + sum(step[x, y] for x, y in zip(ys, ys[1:])))
            for t, y in enumerate(ys):
                want[t, y] += w
        assert np.allclose(got[:n, b], want / want.sum(axis=1, keepdims=True), atol=1e-4)


def test_code_switched_words():
    en, fr = "the cat and the dog were here with that thing".split(), "le chat est sur une table dans la maison avec".split()
    rng = np.random.default_rng(0)
    texts = [" ".join(rng.choice(en, 30)) for _ in range(30)] + [" ".join(rng.choice(fr, 30)) for _ in range(30)]
    crf = language_id.train(texts, ["en"] * 30 + ["fr"] * 30)
    w = language_id.words_of([" ".join(en + fr)])
    post = language_id.forward_backward(crf.emissions(w)[:, None, :], crf.start, crf.step)[:, 0].argmax(axis=1)
    assert post.tolist() == [0] * 10 + [1] * 10 and crf.step[0, 0] > crf.step[0, 1]


def test_more_languages_than_the_bound(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MOST_LANGS", 2)
    monkeypatch.setattr(language_id, "MOST_PER_LANG", 4)
    stems = ["bak", "dro", "fli", "gum", "pez", "wyx"]
    rows = [(10 * k + i, " ".join(f"{s}{e}" for e in "aeiou"[i % 5 :] * 8), s) for k, s in enumerate(stems) for i in range(10 - k)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    crf = language_id.fit(d)
    assert crf.labels == stems and crf.fold == 2
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(d, crf).collect()}
    assert got == {i: s for i, _, s in rows}


def test_pair_expectation_by_enumeration():
    rng = np.random.default_rng(2)
    e, start, step = rng.normal(size=(3, 2, 3)), rng.normal(size=3), rng.normal(size=(3, 3))
    want = np.zeros((3, 3))
    for b in range(2):
        ways = {ys: math.exp(start[ys[0]] + sum(e[t, b, y] for t, y in enumerate(ys)) + sum(step[x, y] for x, y in zip(ys, ys[1:]))) for ys in np.ndindex(3, 3, 3)}
        for ys, w in ways.items():
            for x, y in zip(ys, ys[1:]):
                want[x, y] += w / sum(ways.values())
    assert np.allclose(language_id.pair_expectation(e, start, step)[1], want)


# -- 4 -------------------------------------------------------------------------------------------------------------------


def brute_kneser_ney(train, texts, order):
    words = lambda t: [*byte_words(t), None]
    grams = {k: Counter() for k in range(1, order + 1)}
    pad = lambda t: ["<s>"] * (order - 1) + words(t)
    raw = Counter(w for t in train for w in words(t))
    for t in train:
        p = pad(t)
        for i in range(order - 1, len(p)):
            grams[order][tuple(p[i - order + 1 : i + 1])] += 1
    for k in range(order - 1, 0, -1):
        for g in grams[k + 1]:
            grams[k][g[1:]] += 1
    disc = {k: kneser_ney.discounts([sum(c == i for c in grams[k].values()) for i in (1, 2, 3, 4)]) for k in grams}
    d = lambda k, c: 0 if c == 0 else disc[k][min(c, 3) - 1]
    followers = {k: defaultdict(list) for k in grams}
    for k in grams:
        for g, c in grams[k].items():
            followers[k][g[:-1]].append(c)

    def p(k, g):
        own = followers[k].get(g[:-1])
        lower = 1 / (len(raw) + 1) if k == 1 else p(k - 1, g[1:])
        if not own:
            return lower
        c = grams[k].get(g, 0)
        return (max(c - d(k, c), 0) + sum(d(k, x) for x in own) * lower) / sum(own)

    n = sum(raw.values())
    out = []
    for t in texts:
        q = pad(t)
        out.append((len(words(t)), sum(raw[w] > 0 for w in words(t)), sum(math.log10((raw[w] + 0.5) / (n + 0.5 * (len(raw) + 1))) for w in words(t)), sum(math.log10(p(order, tuple(q[i - order + 1 : i + 1]))) for i in range(order - 1, len(q)))))
    return n, out


@pytest.mark.parametrize("order", [2, 3])
def test_kneser_ney_by_brute_force(spark, docs, order):
    train = [t for i, t, *_ in TEXTS if i is None or fold_of(i, 5) != 1]
    n, want = brute_kneser_ney(train, [t for _, t, *_ in TEXTS], order)
    model = kneser_ney.count(docs.where(fold(F.col("doc_id"), 5) != 1), order)
    got = [(r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in kneser_ney.score(docs, model).collect()]
    assert model.tokens == n
    assert np.allclose(sorted(got), sorted(want), rtol=1e-7)


def test_kneser_ney_sums_to_one(spark):
    """Over all words and the unknown one, the probabilities of any context add up to 1."""
    train = spark.createDataFrame([("a b a c",), ("a b b",), ("c a b",), ("d",)], "text string")
    model = kneser_ney.count(train)
    tokens = kneser_ney.hashes_of(["a b c d zzz"])[0]
    for context in tokens[:5]:
        total = 0.0
        for w in tokens:
            _, p = kneser_ney.score_tokens(model, np.array([context, w], np.uint64), np.array([2]))
            total += p[1]
        assert abs(total - 1) < 1e-9


@pytest.mark.parametrize("files", [7, 10_000])
def test_kneser_ney_in_many_buckets(spark, monkeypatch, files):
    """One word stands before all others, and there are more buckets than n-grams: same scores, spread over the files."""
    texts = [" ".join(f"the w{k % 400}" for k in range(i, 3 * i + 5)) for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    n, want = brute_kneser_ney(texts, texts, 2)
    monkeypatch.setattr(kneser_ney, "BUCKET_TOKENS", n // 10_000)
    monkeypatch.setattr(kneser_ney, "MOST_FILES", min(files, 25))
    monkeypatch.setattr(kneser_ney, "CHUNK_CHARS", 100_000)
    model = kneser_ney.count(docs)
    assert model.layout.buckets >= 10_000 and model.layout.files == min(files, 25) and model.tokens == n
    got = [(r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in kneser_ney.score(docs, model).collect()]
    assert np.allclose(sorted(got), sorted(want), rtol=1e-7)
    rows = [sum(where[2] for where in kneser_ney.TableFile(path).directory.values()) for path in model.files[2].values()]
    assert max(rows) < 2.5 * sum(rows) / model.layout.files


def test_kneser_ney_arrays_round_trip():
    rng = np.random.default_rng(1)
    counts = np.concatenate([rng.integers(1, 400, 500), [2**32 + 5, 2**40]]).astype(np.int64)
    keys = np.unique(rng.integers(0, 2**63, 502).astype(np.uint64) * np.uint64(2))
    for cols in ([keys], [np.sort(keys % np.uint64(5)), keys], [np.repeat(keys[:1], 502), np.repeat(keys[:2], 251), keys], []):
        words, (back,) = kneser_ney.unpacked(kneser_ney.packed(cols, [counts]), len(cols), 1)
        assert all((a == b).all() for a, b in zip(words, cols, strict=True)) and (back == counts).all()
    for some in (keys, keys[:1], np.array([0, 1, 2**64 - 1], np.uint64)):
        assert (kneser_ney.unpacked_keys(kneser_ney.packed_keys(some)) == some).all()
    tokens = rng.integers(0, 2**63, 1000).astype(np.uint64)[rng.integers(0, 1000, 5000)]
    chunk = kneser_ney.Chunk([1, None, -5], np.array([True, False, True]), np.array([1, 4998, 1]), *np.unique(tokens, return_inverse=True))
    again = kneser_ney.Chunk.from_bytes(chunk.to_bytes())
    assert again.ids == chunk.ids and (again.tokens == tokens).all() and (again.sizes == chunk.sizes).all() and (again.learn == chunk.learn).all()


def test_kneser_ney_edges(spark, docs, no_docs):
    model = kneser_ney.count(no_docs)
    got = kneser_ney.score(docs, model).collect()
    assert len(got) == len(TEXTS) and {r["score"] for r in got} == {0.0}
    held = kneser_ney.query(spark, str(DATA)).where("held_out").toPandas()
    assert (held.score > held.base_score).mean() > 0.7


# -- 5 -------------------------------------------------------------------------------------------------------------------


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(0, 40), st.integers(1, 4), min_size=1, max_size=6), st.integers(0, 300), st.sampled_from([8, 64, 1 << 17]))
def test_fit_counts_by_brute_force(bag, budget, window):
    lengths, counts = np.array(list(bag)), np.array(list(bag.values()))
    take = mixing.fit_counts(lengths, counts, budget, window)
    total = int((take * lengths).sum())
    assert (take >= 0).all() and (take <= counts).all() and total <= budget
    if window > budget:  # all in reach of the programme once lengths have their share
        sums = {0}
        share = np.array([int(c) * budget // max(1, int((lengths * counts).sum())) for c in counts]) if budget < (lengths * counts).sum() else counts
        for n, c, s in zip(lengths, counts, share):
            sums = {x + n * k for x in sums for k in range(int(s), int(c) + 1)} if n else sums
        assert total == max(x for x in sums if x <= budget)


def test_mix_takes_what_was_fitted(spark):
    """Of each source and length, as many documents as the fit says, and which ones by the seeded hash alone."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = mixing.mix(docs.repartition(5)).join(docs.select("doc_id", "source"), "doc_id").toPandas()
    draw = docs.select("doc_id", F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(mixing.SEED)), F.lit(1 << 40)).alias("draw")).toPandas().set_index("doc_id")["draw"]
    for _, own in got.groupby("source", dropna=False):
        words, target = own["size"].sum(), own["target"].iloc[0]
        times = int(target // words)
        assert times < 3 or target == 3 * words
        sizes = own.groupby("size").size()
        extra = dict(zip(sizes.index, mixing.fit_counts(sizes.index.to_numpy(), sizes.to_numpy(), int(round(target - times * words)))))
        for size, some in own.groupby("size"):
            more = some[some["taken"] > times * size]
            assert len(more) == (extra[size] if size else 0) and set(some["taken"]) <= {times * size, (times + 1) * size}
            first = sorted(some["doc_id"], key=lambda d: (draw[d], d))[: len(more)]
            assert sorted(more["doc_id"]) == sorted(first)


def test_mix(spark, docs, no_docs):
    got = mixing.query(spark, str(DATA)).join(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "source"), "doc_id").toPandas()
    by = got.groupby("source").agg(size=("size", "sum"), whole=("source_size", "first"), target=("target", "first"), taken=("taken", "sum"))
    assert (by["size"] == by.whole).all() and abs(by.target.sum() - got["size"].sum()) < 1e-6
    assert ((by.taken - by.target).abs() <= 0.02 * by.target + 1).all() and (got.taken <= 3 * got["size"]).all() and (by.target <= 3 * by.whole + 1e-6).all()
    a, b = (sorted(map(str, mixing.mix(d).collect())) for d in (docs, docs.repartition(5)))
    assert a == b and len(a) == len(TEXTS)
    assert mixing.mix(no_docs).count() == 0 and mixing.mix(docs.where("text IS NULL")).first()["taken"] == 0


def test_targets_by_brute_force(spark):
    words = {"a": 10, "b": 1000, "c": 20, "d": 500, None: 7}
    total, left = sum(words.values()), list(sorted(words, key=lambda x: (x is None, x or "")))
    weight = {s: (1.0, 2.0, 3.0)[i % 3] for i, s in enumerate(left)}
    want: dict = {}
    while left:
        unit = (total - sum(want.values())) / sum(weight[s] for s in left)
        over = [s for s in left if weight[s] * unit > 3 * words[s]]
        want |= {s: 3.0 * words[s] for s in over} if over else {s: weight[s] * unit for s in left}
        left = [s for s in left if s in over and False or s not in want]
    got = {r["source"]: r["target"] for r in mixing.targets(spark.createDataFrame(list(words.items()), "source string, words bigint")).collect()}
    assert got == pytest.approx(want) and sum(got.values()) == pytest.approx(total)


# -- 6 -------------------------------------------------------------------------------------------------------------------


def test_gradients_by_differences():
    net = toxicity.Net.fresh(0)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    voc = toxicity.Vocabulary.of(["good", "bad", "words"])
    rows = np.array([[0, 1, 2, 3], [2, 2, 3, 3]], np.int32)
    y = np.array([1.0, 0.0])
    g, _ = toxicity.gradients(net, voc, rows, y)
    rng = np.random.default_rng(0)
    for name in ("w", "u", "b", "a", "v", "c", "word", "char"):
        spots = np.argwhere(np.abs(g[name]) > 1e-6)
        for spot in spots[rng.permutation(len(spots))[:4]]:
            spot = tuple(spot)
            keep = net.p[name][spot]
            losses = []
            for eps in (1e-2, -1e-2):
                net.p[name][spot] = keep + eps
                losses.append(toxicity.gradients(net, voc, rows, y)[1])
            net.p[name][spot] = keep
            assert abs((losses[0] - losses[1]) / 2e-2 - g[name][spot]) < 2e-3 + 0.05 * abs(g[name][spot]), name


def test_toxicity(spark, docs, no_docs):
    rng = np.random.default_rng(0)
    texts = [" ".join(rng.choice([f"w{k}" for k in range(300)], 80)) for _ in range(300)]
    y = np.arange(300) % 4 == 0
    texts = [t.replace(" ", " vile ", 1) if b else t for t, b in zip(texts, y)]
    net = toxicity.train(texts[:220], y[:220])
    s = toxicity.score_texts(net, texts[220:])
    assert ((s >= 0.5) == y[220:]).mean() > 0.95
    late = " ".join(["w1"] * 5000 + ["vile"] + ["w2"] * 5000)
    assert toxicity.score_texts(net, [late])[0] > 0.5 > toxicity.score_texts(net, [""])[0]
    got = toxicity.score(docs, net).collect()
    assert len(got) == len(TEXTS) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert toxicity.score(no_docs, net).count() == 0
    empty = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert toxicity.score_texts(toxicity.fit(docs, empty), ["x"])[0] == 0.5


def test_windows_overlap_and_cover():
    sizes = np.array([0, 1, 16, 17, 40])
    rows, doc = toxicity.windows_of(np.arange(sizes.sum()), sizes, 999)
    first = np.cumsum(sizes) - sizes
    for i, n in enumerate(sizes):
        own = rows[doc == i]
        assert set(own[own < 999].tolist()) == set(range(first[i], first[i] + n)) and len(own) >= 1
        assert len(own) == max(1, -(-(n - 16) // 8) + 1)


# -- 7 -------------------------------------------------------------------------------------------------------------------


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 70_000), st.integers(0, 2**64 - 1)), max_size=400), st.sampled_from([1, 7, 64, 1024]))
def test_simple8b_round_trip(values, block):
    words, counts = simple8b.encode(np.array(values, np.uint64), block)
    at, out = 0, []
    for i, c in zip(range(0, len(values), block), counts.tolist()):
        out += simple8b.decode(words[at : at + c], min(block, len(values) - i)).tolist()
        at += c
    assert out == values and at == len(words)


@pytest.mark.parametrize("most", [1 << 23, 3])
def test_token_files(spark, docs, no_docs, monkeypatch, most):
    monkeypatch.setattr(token_ids, "FILE_IDS", most)
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    want, start = [], 0
    for i, t in sorted(((i, t or "") for i, t, *_ in TEXTS), key=lambda x: (x[0] is not None, x[0] or 0, x[1])):
        ids = [*tok.encode(t, add_special_tokens=False).ids, 0]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = [tuple(r) for r in token_ids.encode_documents(docs).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert token_ids.encode_documents(no_docs).count() == 0


def test_pieces_encode_as_whole_texts():
    import public_tokenizers

    p = token_ids.PieceTokenizer(str(public_tokenizers.path("byte_bpe_50k.json")))
    assert p.by_piece
    for t in ["a \n b", "x\t \ny", "  lead", "trail  ", "\n", "a<|endoftext|> b", "it's don't　x", "a\x1cb \x1d c", "\nabc", " x\ny", "a  ́b 12ab' 's\n's a\n12", "Ä ß, »x« — …", "REWH!! ST!!", "a***\nb&&& c", "\u00a0x", "'tis 'll"]:
        assert p.encode(t).tolist() == p.whole(t), t


def test_pieces_of_random_texts():
    """Awkward code points in any order: white space of all kinds, marks, apostrophes, digits, combining and unassigned ones."""
    import public_tokenizers

    p = token_ids.PieceTokenizer(str(public_tokenizers.path("byte_bpe_50k.json")))
    rng = np.random.default_rng(3)
    some = [*" \n\t\r\x0b\x0c\x1c\x1f\x85\xa0\u1680\u2003\u2028\u202f\u3000", *"'sStTrRvVmMlLdD", *".,;:!?*&%$#|()+-=/_<>\"`~^", *"aZßéΩж中あ가", *"019²½Ⅷ٣", "\u0301", "\u200d", "\ufeff", "\U0001f600", "\u0378", "<|endoftext|>", "'re", "'ll"]
    for _ in range(20_000):
        t = "".join(some[k] for k in rng.integers(0, len(some), rng.integers(1, 14)))
        assert p.encode(t).tolist() == p.whole(t), t


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("ab \n\t\u2009\u3000\u0085é\u1680\x1f"), min_size=1, max_size=6))
def test_irregular_white_space(text):
    assert token_ids.irregular(text) == bool(token_ids.IRREGULAR.search(text))


def test_files_of_many_empty_documents(spark, monkeypatch):
    """Files are closed by documents too, and rows are handed on in parts."""
    monkeypatch.setattr(token_ids, "FILE_DOCS", 1000)
    monkeypatch.setattr(token_ids, "READ_ROWS", 300)
    docs = spark.range(5000).selectExpr("id AS doc_id", "IF(id % 2 = 0, NULL, '') AS text", "1 AS bucket")
    manifest = token_ids.write_token_files(docs, str(public_tokenizers.path("byte_bpe_50k.json")), token_ids.fresh_path(spark, "ids-test"))
    assert manifest.agg(F.max("docs")).first()[0] <= 1000
    got = sorted(map(tuple, token_ids.read_token_files(manifest).collect()))
    assert got == [(i, i, 1, zlib.crc32(bytes(4))) for i in range(5000)]


def test_ranges_of_texts_that_begin_alike(spark):
    """Rows without an id whose first code points are a licence are spread by what comes after it."""
    head = "Permission is hereby granted, free of charge, " * 8
    docs = spark.range(8000).selectExpr("CAST(IF(id < 100, id, NULL) AS BIGINT) AS doc_id", f"CONCAT('{head}', SHA2(CAST(id AS STRING), 256)) AS text")
    placed = in_ranges(docs, 8)
    sizes = [r["count"] for r in placed.groupBy("bucket").count().collect()]
    assert len(sizes) >= 7 and max(sizes) < 3000
    rows = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["text"], r["bucket"]) for r in placed.collect())
    assert [r[-1] for r in rows] == sorted(r[-1] for r in rows)


def test_random_access_by_block(tmp_path):
    docs = [(5, np.arange(3000) % 700), (6, np.array([0])), (None, np.array([1 << 40, 3]))]
    (tmp_path / "x").write_bytes(b"".join(token_ids.pack_file(docs)))
    f = token_ids.TokenFile(f"file://{tmp_path}/x")
    every = np.concatenate([x for _, x in docs])
    assert f.ids(1020, 1030).tolist() == every[1020:1030].tolist() and f.decoded(2, 3).tolist() == every[2048:3003].tolist()
    assert [(i, x.tolist()) for i, x in f.documents()] == [(i, x.tolist()) for i, x in docs]


# -- 8 -------------------------------------------------------------------------------------------------------------------


def test_warc(spark):
    pages = [(1, "http://b.org/x", "same"), (2, "http://a.org/x y", "same"), (5, None, "same"), (3, "http://a.org/x y", None), (4, "", ""), (6, "nohost", "é" * 50_000), (None, "http://c.org", "same"), (7, "http://a.org/x y", "own"), (7, "http://a.org/x y", "own")]
    df = spark.createDataFrame([(*p, 1) for p in pages], "page_id bigint, url string, html string, key int").repartition(3)
    best = {}
    for i, _, h in pages:
        best[h or ""] = max(best.get(h or "", -1), -1 if i is None else i)
    want = []
    for i, _, h in pages:
        raw = (h or "").encode()
        revisit = i != best[h or ""]
        want.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", best[h or ""] if revisit else None))
    got = warc.archive_pages(df).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert {r["record_type"] for r in warc.archive_pages(df, min_bytes=10**6).collect()} == {"response"}
    assert warc.archive_pages(df.limit(0)).count() == 0


def test_records_are_handed_on_by_their_bytes(spark, monkeypatch):
    monkeypatch.setattr(warc, "HELD", 1000)
    pages = spark.range(40).selectExpr("id AS page_id", "CONCAT('http://a.org/', id) AS url", "SHA2(CAST(id AS STRING), 512) AS html")
    assert warc.archive_pages(pages).count() == 40


def test_index_lookup(spark):
    folder = warc.fresh_path(spark, "warc-test")
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h"), F.col("id") % 50, F.lit(".org/"), "id").alias("url"), F.col("id").cast("string").alias("html"))
    index = warc.write_index(warc.write_archives(pages, folder), f"{folder}/index")
    asked = spark.createDataFrame([(7, "http://h7.org/7"), (2999, "http://H49.org/2999"), (5, "http://h5.org/6"), (9999, "http://zz/")], "page_id bigint, url string")
    assert sorted((r["page_id"], bytes(r["payload"])) for r in warc.fetch(asked, index, folder).collect()) == [(7, b"7"), (2999, b"2999")]
    assert warc.url_key("http://www.Example.com:80/a?b") == "com,example,www:80)/a?b" and warc.order_of(-5) < warc.order_of(3) < warc.order_of(10)


# -- 9 -------------------------------------------------------------------------------------------------------------------


def test_covering_guarantee():
    masks = simhash.masks()
    assert len(masks) == 15 and all(24 <= m.bit_count() <= 40 for m in masks)
    for bits in [*combinations(range(0, 64, 3), 3), *combinations(range(20), 2)]:
        x = sum(1 << b for b in bits)
        assert any(not x & m for m in masks)


def brute_components(prints):
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 3:
            parent[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("block", [4096, 16])
def test_links_by_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = np.random.default_rng(3)
    base = [int(x) for x in rng.integers(0, 1 << 63, 40)]
    prints = set(base)
    for b in base[:10]:
        chain = b
        for _ in range(30):
            for k in rng.integers(0, 64, rng.integers(1, 4)):
                chain ^= 1 << int(k)
            prints.add(chain)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >= 1 << 63 else p for p in prints]
    links = simhash.edges(spark.createDataFrame([(p,) for p in signed], "fp bigint"))
    got = {r["node"]: r["root"] for r in simhash.components(links).collect()}
    roots = brute_components(prints)
    want = defaultdict(set)
    for p, r in zip(signed, roots):
        want[r].add(p)
    found = defaultdict(set)
    for p in signed:
        found[got.get(p, p)].add(p)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, found.values()))
    assert links.count() < 30 * len(prints)


def test_second_covering_guarantee():
    for kept in simhash.masks():
        left = [i for i in range(64) if not kept >> i & 1]
        again = simhash.masks(3, left)
        assert len(again) == 15 and all(m & kept == 0 for m in again)
        for bits in combinations(left[::2], 3):
            assert any(not sum(1 << b for b in bits) & m for m in again)


def test_forest_where_all_pairs_are_links():
    """40,000 comparisons a strip and 9 million links: memory is that of a strip."""
    import tracemalloc

    flips = [0, *[1 << k for k in range(60)], *[1 << j | 1 << k for j, k in combinations(range(60), 2)]]
    some = np.array(sorted(flips)[:1500], np.int64)
    tracemalloc.start()
    links = simhash.forest(some, None, 64)
    assert tracemalloc.get_traced_memory()[1] < 120 << 20
    assert len(links) == len(some) - 1


def test_a_large_group_of_near_copies(spark):
    """43,745 fingerprints within three bits of one: one component, by buckets that are dealt anew."""
    base = 0x5A5A_0F0F_3C3C_1234
    every = {base, *[base ^ sum(1 << b for b in bits) for n in (1, 2, 3) for bits in combinations(range(64), n)]}
    frame = spark.createDataFrame([(simhash.signed(x),) for x in every], "fp bigint")
    links = simhash.staged(simhash.edges(frame), "test-links")
    assert links.count() < 40 * len(every)
    roots = simhash.components(links)
    assert roots.count() == len(every) - 1 and roots.select("root").distinct().count() == 1


def test_strips_of_long_texts():
    long = "é lorem Ipsum\n dolor  " * 200_000
    words = byte_words(long)
    h = np.array([xxhash.xxh64_intdigest(b" ".join(x), 42) for x in zip(words, words[1:], words[2:])], np.uint64)
    want = sum(1 << b for b in range(64) if 2 * int(((h >> np.uint64(b)) & np.uint64(1)).sum()) > len(h))
    assert simhash.simhash(long) == want
    assert simhash.simhash("a b", 3) == xxhash.xxh64_intdigest(b"a b", 42) and simhash.simhash("a b c d", 2) != 0 and simhash.simhash("x", 1) == xxhash.xxh64_intdigest(b"x", 42)


def test_simhash_query(spark, docs, no_docs):
    def brute(text):
        words = byte_words(text)
        if not words:
            return 0
        sh = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
        h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(TEXTS)
    fps = [(i, brute(t)) for i, t, *_ in TEXTS]
    root = brute_components([f for _, f in fps])
    least = {}
    for (i, _), r in zip(fps, root):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    want = [(i, f"{f:016x}", least.get(r)) for (i, f), r in zip(fps, root)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.simhash(LONG) == brute(LONG)


# -- 10 ------------------------------------------------------------------------------------------------------------------


def test_reparameterised_questions(spark, docs, no_docs):
    item = "Yesterday John bought 12 apples and 30 pears at 5 dollars each, then Mary gave John another 12 apples for free."
    bench = spark.createDataFrame([(1, item), (2, "short one"), (3, None), (1, item)], "item_id bigint, text string")
    same = item.replace("John", "Peter").replace("12", "7").replace("Mary", "Anna")
    torn = item.replace("12 apples and", "7 apples and").replace("gave John", "gave Paul").replace("bought", "bought")
    texts = [(1, f"Some text before. {item} And after."), (2, f"Intro words here. {same} More."), (3, f"Intro words here. {torn} More."), (4, item[:40]), (5, None), (6, ""), (None, item), (1, "again " + item)]
    d = spark.createDataFrame([(*t, 0) for t in texts], "doc_id bigint, text string, hash int")
    got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.leaks(d, bench).collect()}
    assert {k for k in got} == {(1, 1), (2, 1), (None, 1)}
    assert got[2, 1]["consistency"] == 1.0 and got[2, 1]["slots"] >= 5
    assert decontaminate.leaks(no_docs, bench).count() == 0 and decontaminate.leaks(docs, bench.limit(0)).count() == 0


def test_texts_without_an_id_or_of_one_id_are_judged_alone(spark):
    """Values exchanged against each other are no leak under any id, and texts of one id are not put together."""
    item = "Yesterday John bought 12 apples and 30 pears at 5 dollars each, then Mary gave John another 12 apples and 30 more pears for free."
    torn = "Yesterday John bought 7 apples and 8 pears at 9 dollars each, then Mary gave Paul another 3 apples and 4 more pears for free."
    same = torn.replace("Paul", "John").replace("another 3 apples and 4", "another 7 apples and 8")
    long = "the keeper of the old lighthouse counts every passing ship before the morning fog comes in from the sea"
    words = long.split()
    halves = [(4, " ".join(words[:10]) + " then something else"), (4, "something else then " + " ".join(words[8:]))]
    bench = spark.createDataFrame([(1, item), (2, long)], "item_id bigint, text string")
    texts = [(1, f"Intro words. {torn} End."), (None, f"Intro words. {torn} End."), (None, f"Other words. {same} End."), (3, f"Intro words. {torn} End."), (3, f"Some words. {same} End."), *halves, (None, halves[0][1]), (None, halves[1][1]), (5, long), (5, long)]
    got = sorted((str(r["doc_id"]), r["item_id"]) for r in decontaminate.leaks(spark.createDataFrame(texts, "doc_id bigint, text string"), bench).collect())
    assert got == [("3", 1), ("5", 2), ("None", 1)]


def test_decontamination_plan_is_native(spark):
    leaks = catalog.QUERIES["op10_decontamination"](spark, str(DATA))
    plan = leaks._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_occurrences_are_judged_alone(spark):
    ask = "Yesterday the farmer sold {} apples and {} pears at the old market before he walked home with {} coins."
    first, second = ask.format(3, 8, 20), ask.format(5, 9, 31)
    run = "Continue this series of numbers 2 3 5 7 11 13 17 19 23 29 with the next one that fits."
    digits = "4 8 15 16 23 42 108 7"
    bench = spark.createDataFrame([(1, first), (2, second), (3, run), (4, digits)], "item_id bigint, text string")
    torn = "Yesterday the farmer sold 3 apples and 3 pears at the old market before he walked home with 3 coins."
    texts = [
        (1, f"{first} Some words between them. {second}"), (2, f"{first} Some words between them. {ask.format(70, 80, 90)}"), (3, f"Before it. {run} After it."), (4, f"A table row {digits} ends here."),
        (5, "A table row 1 2 3 4 5 6 7 9 ends here."), (6, f"{torn} Some words between them. {torn}"), (7, f"{first.replace('old market', 'old town market')} Some words between them. {second}"), (None, f"{first} {second}"),
    ]
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(spark.createDataFrame(texts, "doc_id bigint, text string"), bench).collect()}
    both = {(d, i) for d in (1, 2, 7) for i in (1, 2)}  # one template: a text with other values holds both items
    assert got >= both | {(3, 3), (4, 4)} and not [k for k in got if k[0] in (5, 6)]


def test_short_and_unspaced_items(spark):
    chinese = "小明昨天买了三个苹果然后回家"
    bench = spark.createDataFrame([(1, "The Blue Whale"), (2, "Paris."), (3, chinese), (4, "!?"), (5, "長剣"), (6, "the blue Whale swims away"), (7, "ประเทศไทย"), (8, "Whale 1,5")], "item_id bigint, text string")
    texts = [(1, "It was the blue whale, again."), (2, "He lives in PARIS now"), (3, f"他说：{chinese}。"), (4, "小明回家。然后昨天"), (5, "blue the whale Parisian"), (6, "巨獣長剣だ"), (7, "whale"), (8, None), (9, ""), (None, "in Paris"), (10, "ใน ประเทศไทย นี้"), (11, "a whale 1,5"), (12, "a whale 1,6")]
    got = sorted((str(r["doc_id"]), r["item_id"]) for r in decontaminate.leaks(spark.createDataFrame(texts, "doc_id bigint, text string"), bench).collect())
    assert got == sorted([("1", 1), ("2", 2), ("3", 3), ("6", 5), ("None", 2), ("10", 7), ("11", 8)])


@pytest.mark.parametrize("hot", [64, 2, 0])
def test_windows_that_many_items_share(spark, monkeypatch, hot):
    """Many items of one template, and templates that begin alike: only what a document holds is found, values compared."""
    monkeypatch.setattr(decontaminate, "HOT", hot)
    same = [(k, f"A train leaves at {k} and comes back at {k + 500}, how many miles did it go in all") for k in range(10, 60)]
    alike = [(1000 + k, f"please answer the next question with one word only: is the {'very ' * (k % 7)}old tower of town number{k} higher than the church beside it or is it not") for k in range(40)]
    word = lambda k: "".join(chr(97 + int(c)) for c in str(k))
    alike = [(i, t.replace(f"number{i - 1000}", word(i - 1000))) for i, t in alike]
    texts = [(1, same[5][1]), (2, alike[3][1]), (3, "please answer the next question with one word only"), (4, " ".join(["some filler goes here"] * 30_000) + " " + alike[20][1]), (5, None), (None, alike[7][1])]
    bench = spark.createDataFrame(same + alike, "item_id bigint, text string")
    rows = decontaminate.leaks(spark.createDataFrame(texts, "doc_id bigint, text string"), bench).collect()
    got = {(r["doc_id"], r["item_id"]) for r in rows}
    assert len(rows) == len(got) and {(r["doc_id"], r["item_id"]): r["matched"] / r["windows"] for r in rows}[1, 15] == 1
    assert {(1, 15), (2, 1003), (4, 1020), (None, 1007)} <= got and not [x for x in got if x[0] in (3, 5)]
    plain = lambda t: re.findall(r"\w+", re.sub(r"\d+", "0", t.lower()))
    runs = lambda t: {tuple(w[i : i + 5]) for w in [plain(t)] for i in range(len(w) - 4)}
    for d, i in got:  # each has the share it needs, counted the plain way (a name at the begin aside)
        text, item = dict(texts)[d], dict(same + alike)[i]
        assert len(runs(text) & runs(item)) >= 0.8 * len(runs(item)) - 1
