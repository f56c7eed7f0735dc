"""Every stage of the pipeline on edge cases, and all of them in a row against a second way."""

from __future__ import annotations

import random

import corpus_pipeline as P
from tests.conftest import DATA

from sheafwork.llm import decontaminate, language_id, mixing, simhash
from tests.llm.conftest import TEXTS


def test_stages_on_edge_cases(spark, docs, no_docs):
    for name, stage in P.STAGES:
        out = stage(spark, docs, str(DATA))
        if name != "token_ids":
            assert out.columns == P.COLUMNS, name
        assert out.count() > 0 and stage(spark, no_docs, str(DATA)).count() == 0, name


def test_near_dedup_keeps_one(spark, docs):
    kept = [r["doc_id"] for r in P.keep_one_of_each_group(spark, docs, str(DATA)).collect()]
    assert sorted(k for k in kept if k is not None) == sorted({r["component_id"] for r in simhash.near_duplicates(docs).collect()} - {None})
    assert kept.count(None) == sum(i is None for i, *_ in TEXTS) and 1 in kept and 2 not in kept


def test_run(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for name, stage in P.STAGES[:-1]:
        after = P.staged(stage(spark, docs, str(DATA)), "test")
        before, now = {r["doc_id"] for r in docs.collect()}, [r["doc_id"] for r in after.collect()]
        assert set(now) <= before
        if name == "language_id":
            gone = {r["doc_id"] for r in language_id.identify(docs, language_id.fit(docs)).where("lang_pred = 'und' OR score < 0.4").collect()}
        elif name == "near_dedup":
            gone = {r["doc_id"] for r in simhash.near_duplicates(docs).where("doc_id <> component_id").collect()}
        elif name == "decontamination":
            gone = {r["doc_id"] for r in decontaminate.leaks(docs, spark.read.parquet(f"{DATA}/benchmark.parquet")).collect()}
        else:
            times = {r["doc_id"]: r["taken"] // r["size"] if r["size"] else 0 for r in mixing.mix(docs).collect()}
            assert {d: now.count(d) for d in before} == times
            continue
        assert set(now) == before - gone and len(now) == len(set(now))
        docs = after
    assert P.run(spark, str(DATA)).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_switching_texts_and_unlabelled_tables_stay(spark):
    words = {"en": "the cat and dog were here with that thing", "fr": "le chat est sur une table dans la maison", "de": "der Hund und die Katze sind nicht hier", "es": "los perros del pueblo comen pan por las noches"}
    rows = [(4 * i + k, f"{t} {t}", g, "a", 0) for i in range(30) for k, (g, t) in enumerate(words.items())]
    rows.append((1000, " ".join(f"{t} {t}" for t in words.values()), "en", "a", 0))
    d = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert P.keep_known_languages(spark, d, "").where("doc_id = 1000").count() == 1
    assert P.keep_known_languages(spark, d.withColumn("lang", P.F.lit(None).cast("string")), "").count() == len(rows)


def test_rows_that_share_an_id_are_told_apart(spark):
    """Of one id, and of none, every different text goes through each stage by itself, whatever the partitions."""
    words = {"en": "the cat and dog were here with that thing on a long way home".split(), "fr": "le chat est sur une table dans la maison avec mon ami".split()}
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices(t, k=60)), g, "a", 0) for i in range(40) for g, t in words.items()]
    item = spark.read.parquet(f"{DATA}/benchmark.parquet").where("text IS NOT NULL").first()["text"]
    good, bad = " ".join(rng.choices(words["en"], k=60)), "!!! 12 34 ..."
    rows += [(1000, good, "en", "a", 1), (1000, bad, "en", "a", 2), (1000, item, "en", "a", 3), (None, bad, "en", "b", 4), (None, "a quite different text about the dog and the house in that street", "en", "b", 5), (None, item, "en", "b", 6)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    seen = []
    for n in (1, 7):
        docs = spark.createDataFrame(rows, schema).repartition(n)
        for name, stage in P.STAGES[:3]:
            docs = P.staged(stage(spark, docs, str(DATA)), "test")
            kept = {(r["doc_id"], r["text"]) for r in docs.collect()}
            assert (1000, bad) not in kept and (None, bad) not in kept and (1000, good) in kept and (None, rows[-2][1]) in kept, name
        assert (1000, item) not in kept and (None, item) not in kept
        seen.append(sorted(map(str, docs.collect())))
    assert seen[0] == seen[1]


def test_repeated_rows_share_out_what_the_mix_takes(spark):
    rows = [(1, "a b c", "en", "x", 1)] * 3 + [(1, "d e", "en", "x", 2), (2, "f g h i", "en", "y", 3), (None, "j k", "en", "y", 4), (3, None, "en", "y", 5), (1, "a b c", "en", "y", 6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = P.mix_sources(spark, docs, "").collect()
    again = sorted(str((r["doc_id"], r["text"], r["source"])) for r in P.mix_sources(spark, docs.repartition(3), "").collect())
    assert sorted(str((r["doc_id"], r["text"], r["source"])) for r in got) == again
    size = lambda some: sum(len((r["text"] or "").split()) for r in some)
    shares = {r["source_size"]: r["target"] for r in mixing.mix(docs).collect()}
    for source, longest in (("x", 3), ("y", 4)):
        assert abs(size([r for r in got if r["source"] == source]) - shares[{"x": 11, "y": 9}[source]]) <= longest
    assert not [r for r in got if not r["text"]]
