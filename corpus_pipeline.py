"""A corpus from raw documents to token ids: each stage calls one operator of sheafwork.llm.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs.  All stages but the last return the columns of ``documents``.

Stages tell rows apart by (doc_id, hash of the text), not by doc_id alone: of rows that share an id, or have none, each text
is judged and kept or dropped by itself.

Defined cases: of rows alike in doc_id and text the near-duplicate stage keeps one, that with the smallest (source, lang,
n_chars), nulls first; an empty table passes through; columns beyond those of documents are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheafwork.llm import decontaminate, language_id, mixing, simhash, token_ids
from sheafwork.llm.shared import fresh_path, staged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A text whose words' best labels have a lower mean probability than this is no text of any languages.
MIN_LANGUAGE_SCORE = 0.4


def keyed(docs: DataFrame) -> DataFrame:
    """The columns of documents, and _key: a row's id and text.  Rows with a null id come last in its order."""
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.md5(F.coalesce("text", F.lit("\0")).cast("binary")).alias("text"))
    return docs.select(*COLUMNS).withColumn("_key", key)


def by_key(docs: DataFrame) -> DataFrame:
    """docs with the key in the place of the id, for an operator."""
    return docs.select(F.col("_key").alias("doc_id"), "text", "lang", "source")


def same_key(a: str, b: str) -> Column:
    return (F.col(f"{a}.text") == F.col(f"{b}.text")) & F.col(f"{a}.id").eqNullSafe(F.col(f"{b}.id"))


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """keyed docs but for those whose key is among gone (doc_id)."""
    return docs.join(gone.select(F.col("doc_id").alias("_gone")).distinct(), same_key("_key", "_gone"), "left_anti")


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter, and those whose words fit no language well enough; a text may switch languages.  Where no
    row has a lang there is nothing to judge by, and all are kept."""
    crf = language_id.fit(docs)
    if crf is None:
        return docs.select(*COLUMNS)
    docs = keyed(docs)
    found = language_id.identify(by_key(docs), crf)
    known = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("certainty") >= MIN_LANGUAGE_SCORE)
    return without(docs, found.where(~known)).select(*COLUMNS)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group of near-duplicates."""
    docs = keyed(docs)
    found = staged(simhash.near_duplicates(by_key(docs)), "pipeline-groups")
    kept = without(docs, found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))))
    repeated = found.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("_gone"))
    if repeated.isEmpty():
        return kept.select(*COLUMNS)
    least = F.min(F.struct("source", "lang", "n_chars", "doc_id", "text")).alias("x")
    one = kept.join(repeated, same_key("_key", "_gone"), "left_semi").groupBy("_key").agg(least).select(*[F.col(f"x.{c}") for c in COLUMNS])
    return without(kept, repeated.withColumnRenamed("_gone", "doc_id")).select(*COLUMNS).unionByName(one)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold an item of the benchmark."""
    docs = keyed(docs)
    leaks = decontaminate.leaks(by_key(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return without(docs, leaks).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats each document as often as the mix takes it; those that it doesn't take go.  Rows alike in id, text and source
    share out what the mix takes of them, the first ones one more."""
    docs = keyed(docs).withColumn("_source", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    one = F.struct("_key", "_source")
    drawn_by = F.coalesce(F.col("doc_id._key.id").cast("string"), F.col("doc_id._key.text"))
    taken = mixing.mix(docs.select(one.alias("doc_id"), "text", "source"), drawn_by=drawn_by).where("taken > 0")
    times = taken.groupBy("doc_id").agg(F.sum(F.expr("CAST(taken DIV size AS INT)")).alias("times"), F.max(F.expr("CAST(taken DIV size AS INT)")).alias("most")).select("doc_id.*", "times", "most")
    times = times.select(F.col("_key").alias("_took"), F.col("_source").alias("_from"), "times", "most")
    found = docs.join(times, same_key("_key", "_took") & (F.col("_source") == F.col("_from")))
    uneven = times.where("times > most")  # of repeated rows only
    if uneven.isEmpty():
        dealt = found
    else:
        some = uneven.select(F.col("_took").alias("_odd"), F.col("_from").alias("_odd_from"))
        odd = same_key("_key", "_odd") & (F.col("_source") == F.col("_odd_from"))
        place = F.row_number().over(Window.partitionBy("_key", "_source").orderBy("lang", "n_chars"))
        n = F.count("*").over(Window.partitionBy("_key", "_source"))
        share = F.floor(F.col("times") / F.col("_n")) + (F.col("_place") <= F.col("times") % F.col("_n")).cast("int")
        apart = found.join(some, odd, "left_semi").withColumns({"_place": place, "_n": n}).withColumn("times", share.cast("int")).drop("_place", "_n").where("times > 0")
        dealt = found.join(some, odd, "left_anti").unionByName(apart)
    return dealt.select(*COLUMNS, F.explode(F.sequence(F.lit(1), "times"))).select(*COLUMNS)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token files and returns what is read from them."""
    return token_ids.encode_documents(docs)


STAGES = [
    ("language_id", keep_known_languages),
    ("near_dedup", keep_one_of_each_group),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
    ("token_ids", write_token_ids),
]

#: Language ID, SimHash components, mixing and tokenizers can't be put in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = fresh_path(spark, f"pipeline-{name}")
        out.write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs
