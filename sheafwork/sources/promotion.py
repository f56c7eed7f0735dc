"""Promotion of drafts as versions: readers see one whole version or the next, never half of one.

Below a root lie ``data/promoted=<n>/<key>`` (the rows of keys that version n changed), ``manifest/<n>`` (which version each key's rows are
of) and ``CURRENT``, a small file with the number that counts.  A promotion checks everything first, writes a new version and its
manifest, and then replaces CURRENT by one rename; if it dies before that, nothing has changed, and what it wrote is never read.
Files of unchanged keys are not touched."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafwork.session import staged
from sheafwork.sources.writers import promotion_plan

FOLDER = "promoted"  # of a version's rows, data/promoted=<n>
REFUSED = ("drift", "ghost", "absent", "stray")


def _file_system(spark: SparkSession, path: str):
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, where, spark._jsparkSession.sessionState().newHadoopConf()


def current_version(spark: SparkSession, root: str) -> int:
    """The version that counts, 0 before the first."""
    jvm, where, conf = _file_system(spark, f"{root}/CURRENT")
    fs = where.getFileSystem(conf)
    if not fs.exists(where):
        return 0
    stream = fs.open(where)
    try:
        return int(stream.readLine())
    finally:
        stream.close()


def _point(spark: SparkSession, root: str, version: int, expected: int) -> None:
    """Makes a version the current one by a rename, unless another promotion did so meanwhile."""
    jvm, target, conf = _file_system(spark, f"{root}/CURRENT")
    part = jvm.org.apache.hadoop.fs.Path(f"{root}/CURRENT.{uuid.uuid4().hex}")
    fs = target.getFileSystem(conf)
    out = fs.create(part, True)
    out.writeBytes(f"{version}\n")
    out.close()
    if current_version(spark, root) != expected:
        fs.delete(part, False)
        raise RuntimeError(f"version {expected} is no longer the current one")
    over = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    over[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").valueOf("OVERWRITE")
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(part, target, over)


def same_key(key: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key])


def read_version(spark: SparkSession, root: str, key: Sequence[str], version: int | None = None) -> DataFrame | None:
    """The rows of a version (the current one), or None before the first.  Versions' folders are pruned by the manifest, which also
    has the keys' own types."""
    n = current_version(spark, root) if version is None else version
    if not n:
        return None
    manifest = spark.read.parquet(f"{root}/manifest/{n}").select(*[F.col(c).alias(f"_{c}") for c in key], F.col("version").alias("_version"))
    name = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")  # or the key '007' would be read as 7
    try:
        rows = spark.read.option("basePath", f"{root}/data").parquet(f"{root}/data")
    finally:
        spark.conf.set(name, before)
    same = F.col(FOLDER) == F.col("_version").cast("string")
    for c in key:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}").cast("string"))
    order = [c for c in rows.columns if c not in (*key, FOLDER)]
    return rows.join(manifest, same).select(*[F.col(f"_{c}").alias(c) for c in key], *order)


def checked_plan(draft: DataFrame, canonical: DataFrame | None, key: Sequence[str], columns: Sequence[str], build: str, build_id: str, universe: DataFrame | None = None) -> DataFrame:
    """(…key, action): new, changed or unchanged, or what refuses the draft: ``drift`` for a key with rows of another build than
    build_id, ``ghost`` for one that only the current version has, ``absent`` and ``stray`` against a universe; a null key is stray.  The build is no part
    of what makes a key changed."""
    there = draft.limit(0) if canonical is None else canonical
    plan = promotion_plan(draft, there, key, columns, universe)
    drifted = draft.where(~F.col(build).eqNullSafe(F.lit(build_id))).select(*[F.col(c).alias(f"_{c}") for c in key]).distinct().withColumn("_drift", F.lit(True))
    nameless = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in key])
    return plan.join(drifted, same_key(key), "left").select(*key, F.when(nameless, "stray").when(F.col("_drift"), "drift").otherwise(F.col("action")).alias("action"))


def promote_version(draft: DataFrame, root: str, key: Sequence[str], columns: Sequence[str], build: str, build_id: str, universe: DataFrame | None = None) -> DataFrame:
    """Promotes a draft whole or not at all; returns its plan with the version that each key is of afterwards (null if refused).

    Keys name datasets, of which there are few; their rows may be any number."""
    spark = draft.sparkSession
    before = current_version(spark, root)
    plan = staged(checked_plan(draft, read_version(spark, root, key), key, columns, build, build_id, universe), "promotion")
    if not plan.where(F.col("action").isin(*REFUSED)).isEmpty():
        return plan.withColumn("version", F.lit(None).cast("int"))
    todo = plan.where("action IN ('new', 'changed')").select(*[F.col(c).alias(f"_{c}") for c in key])
    if todo.isEmpty():
        return plan.join(spark.read.parquet(f"{root}/manifest/{before}"), list(key)) if before else plan.withColumn("version", F.lit(None).cast("int"))
    after = before + 1
    draft.join(todo, same_key(key), "left_semi").write.mode("overwrite").partitionBy(*key).parquet(f"{root}/data/{FOLDER}={after}")
    if before:
        old = spark.read.parquet(f"{root}/manifest/{before}").select(*key, F.col("version").alias("_old"))
        manifest = plan.join(old, list(key), "left").select(*key, F.when(F.col("action") == "unchanged", F.col("_old")).otherwise(F.lit(after)).alias("version"))
    else:
        manifest = plan.select(*key, F.lit(after).alias("version"))
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest/{after}")
    _point(spark, root, after, before)
    return plan.join(spark.read.parquet(f"{root}/manifest/{after}"), list(key))
