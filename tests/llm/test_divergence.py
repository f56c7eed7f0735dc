"""The divergence audit against brute force."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sheafwork.llm import divergence
from sheafwork.llm.shared import ASCII_LOWER

KIND = "doc_id bigint, text string, lang string, source string, n bigint, term string"


def brute(rows, top=10, min_docs=10):
    docs = [(t or "", g or "", s or "") for _, t, g, s in rows]
    cut = [([w.translate(ASCII_LOWER) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t)], g, s) for t, g, s in docs]
    out = []
    for lang in {g for _, g, _ in cut}:
        with_, total, by = Counter(), Counter(), defaultdict(Counter)
        for words, g, s in cut:
            if g == lang:
                with_.update(set(words))
                total.update(words)
                by[s].update(words)
        kept = [t for t in with_ if with_[t] >= min_docs]
        prob = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c[k] for k in kept) + 2 * len(kept)) for t in kept}
        q, p = prob(total), {s: prob(c) for s, c in by.items()}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in by:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in by if o != s]
            terms = [(t, f(p[s][t], q[t])) for t in kept if by[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, v, i + 1) for i, (item, v) in enumerate(ranked)]
    return sorted(map(str, out))


def world():
    rng = np.random.default_rng(11)
    words = [f"{a}{b}" for a in "abcdefgh" for b in "xyzÄéШ"] + ["The", "ЯБ", "it's", "naïve x", "A1b"]
    rows = []
    for i in range(400):
        lang, source = [("en", "a"), ("en", "b"), ("en", "c"), ("fr", "a"), ("fr", None), (None, "z")][rng.choice(6, p=[0.4, 0.2, 0.1, 0.1, 0.15, 0.05])]
        p = rng.dirichlet(np.ones(len(words)) * 0.5) if i % 3 == 0 else None
        rows.append((i, " ".join(rng.choice(words, rng.integers(1, 40), p=p)) + "!", lang, source))
    rows += [(1, None, "en", "empty"), (2, "only two words", "xx", "a"), (3, "", "xx", "b"), (None, "the the THE", "en", "a"), (None, "the the THE", "en", "a"), (5, "alone", "yy", "a")]
    return rows


@pytest.mark.parametrize("first, strip, top", [(64, 1 << 20, 10), (1, 8, 3)])
def test_audit_by_brute_force(spark, monkeypatch, first, strip, top):
    monkeypatch.setattr(divergence, "FIRST", first)
    monkeypatch.setattr(divergence, "FASTER", 2)
    monkeypatch.setattr(divergence, "STRIP", strip)
    monkeypatch.setattr(divergence, "HELD", 30)
    rows = world()
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], KIND).repartition(3)
    got = divergence.audit(docs, top=top).collect()
    assert sorted(map(str, map(tuple, got))) == brute(rows, top)
    assert divergence.audit(docs.limit(0)).count() == 0


def test_sql_says_the_same(spark):
    rows = world()
    con = duckdb.connect()
    import pandas as pd

    frame = pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source"])
    con.register("documents", frame)
    assert sorted(map(str, con.execute(divergence.ORACLE).fetchall())) == brute(rows)


def test_no_language_keeps_a_term(spark):
    docs = spark.createDataFrame([(1, "some words", "en", "a", 1, ""), (2, "other words", "en", "b", 1, ""), (3, None, None, None, 1, "")], KIND)
    assert sorted(map(tuple, divergence.audit(docs).collect())) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_whole_numbers_beyond_a_bigint(spark):
    n = [0, 1, 10**10, 10**15, 10**17]
    got = spark.createDataFrame([(x,) for x in n], "n bigint").select(divergence.probability(F.col("n"), F.lit(10**18), F.lit(10**9).cast("bigint")).alias("p")).collect()
    assert [r["p"] for r in got] == [1 + 10**9 * (x + 2) // (10**18 + 2 * 10**9) for x in n]


def test_search_stops_early(spark, monkeypatch):
    """Terms of buckets whose bound is below the worst of the best are not asked for."""
    monkeypatch.setattr(divergence, "FIRST", 1)
    postings = spark.range(2000).selectExpr("'en' AS lang", "'a' AS source", "CONCAT('t', id) AS term", "id + 1 AS n", "CAST(10 AS BIGINT) AS q")
    buckets = postings.selectExpr("lang", "source", "n", "CAST(1 AS BIGINT) AS terms", "n * 100 AS p", "q AS least_q", "q AS most_q")
    rounds = []
    real = divergence.staged
    monkeypatch.setattr(divergence, "staged", lambda df, tag: rounds.append((tag, real(df, tag))) or rounds[-1][1])
    got = divergence.best_terms(postings, buckets).orderBy(F.desc("value")).collect()
    assert [r["item"] for r in got] == [f"t{k}" for k in range(1999, 1989, -1)]
    assert max(df.count() for tag, df in rounds if tag == "divergence-round") == 10
