"""Ranked name search and its published index.

Tiers: 1 the whole name, 2 from a word's edge, 3 anywhere.  Hits are ordered by tier, length of the normalised name, kind
and id.  Names are normalised once when the index is made, not at every query."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheafwork.functions.text import normalize_name
from sheafwork.operators.ordinals import shared_budget
from sheafwork.operators.quality import reconcile
from sheafwork.operators.relations import containing

LEAST_QUERY = 2
#: Queries that search_all broadcasts at most.
FEW_QUERIES = 64
#: Characters of ids in a piece of ordered_manifest.
PIECE = 1 << 16


def tier(name: Column, query: Column) -> Column:
    """name and query are normalised; null for no hit."""
    edge = F.startswith(name, query) | F.contains(name, F.concat(F.lit(" "), query))
    return F.when(F.length(query) < LEAST_QUERY, None).when(name == query, 1).when(edge, 2).when(F.contains(name, query), 3)


def rank_hits(hits: DataFrame, kinds: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    place = F.array_position(F.array(*map(F.lit, kinds)), F.col("kind"))
    order = [F.col("tier"), F.length("norm"), F.when(place == 0, len(kinds) + 1).otherwise(place), F.col("id")]
    if by:
        return hits.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("bigint"))
    return hits.orderBy(*order)


def search(rows: DataFrame, query: str, kinds: Sequence[str], normalized: str | None = None) -> DataFrame:
    """Hits of one query in rows (kind, id, name), ranked.  normalized names a column that has the names' form already."""
    spark = rows.sparkSession
    form = spark.createDataFrame([(query,)], "q string").select(normalize_name(F.col("q"))).first()[0] or ""
    named = rows.withColumn("norm", F.col(normalized) if normalized else normalize_name(F.col("name")))
    return rank_hits(named.withColumn("tier", tier(F.col("norm"), F.lit(form))).where("tier IS NOT NULL"), kinds)


def search_all(rows: DataFrame, queries: DataFrame, kinds: Sequence[str], k: int) -> DataFrame:
    """The first k hits of every query (q, normalised) in rows (kind, id, norm).  Up to FEW_QUERIES queries are broadcast and each
    row is read once; more are joined by the rarest gram of each (see relations.containing)."""
    met = containing(rows, F.col("norm"), queries.where(F.length("q") >= LEAST_QUERY), F.col("q"), FEW_QUERIES)
    hits = met.withColumn("tier", tier(F.col("norm"), F.col("q"))).where("tier IS NOT NULL")
    return rank_hits(hits, kinds, ["q"]).where(F.col("rank") <= k)


def grouped_page(hits: DataFrame, kinds: Sequence[str], budget: int = 50) -> DataFrame:
    """What a page of ``budget`` rows shows: kinds in their order, unknown ones last, each with its full total."""
    place = F.array_position(F.array(*map(F.lit, kinds)), F.col("kind"))
    return shared_budget(hits, F.when(place == 0, len(kinds) + 1).otherwise(place), ["tier", F.length("norm"), "id"], budget)


def href(kind: Column, id_: Column, locale: Column, pivot: str = "en") -> Column:
    path = F.concat(F.lit("/"), kind, F.lit("/"), id_)
    return F.when(locale == pivot, path).otherwise(F.concat(F.lit("/"), locale, path))


def index_rows(availability: DataFrame, overlays: DataFrame, kinds: Sequence[str], pivot: str = "en") -> DataFrame:
    """(locale, kind, id, name, href) of the published index: named locales of availability (kind, id, named ARRAY) joined
    with overlays (locale, kind, id, name)."""
    cells = availability.where(F.col("kind").isin(*kinds)).select("kind", "id", F.explode("named").alias("locale"))
    return cells.join(overlays, ["locale", "kind", "id"]).select("locale", "kind", "id", "name", href(F.col("kind"), F.col("id"), F.col("locale"), pivot).alias("href"))


def index_conflicts(availability: DataFrame, overlays: DataFrame) -> DataFrame:
    """Flags without a name, names without a flag, and pairs that occur twice; empty if both sides agree."""
    flags = availability.select("kind", "id", F.explode("named").alias("locale"))
    names = overlays.where("name IS NOT NULL AND name <> ''").select("kind", "id", "locale")
    off = reconcile(flags.distinct(), names.distinct(), ["kind", "id", "locale"], []).where("class <> 'equal'")
    off = off.withColumn("class", F.when(F.col("class") == "left_only", "flag_without_name").otherwise("name_without_flag"))
    twice = names.groupBy("kind", "id", "locale").count().where("count > 1").select("kind", "id", "locale", F.lit("duplicate").alias("class"))
    return off.unionByName(twice)


def strays(rows: DataFrame, kinds: Sequence[str], locales: Sequence[str]) -> DataFrame:
    """Rows of unknown kinds or locales: they are refused, not filtered away."""
    return rows.where(~F.col("kind").isin(*kinds) | ~F.col("locale").isin(*locales))


def manifest(index: DataFrame) -> DataFrame:
    """Rows of each locale and a digest of its ids: equal digests mean equal sorted id lists.

    The digest is of the count and of two sums over hashes of the ids, so ids are added up in every task, in whatever order, and no
    task reads a locale's list."""
    hash_ = F.md5(F.concat_ws("/", "kind", "id").cast("binary"))
    part = lambda at: F.sum(F.conv(F.substring(hash_, at, 15), 16, 10).cast("decimal(38,0)"))
    sums = index.groupBy("locale").agg(F.count("*").alias("rows"), part(1).alias("_a"), part(16).alias("_b"))
    return sums.select("locale", "rows", F.sha2(F.concat_ws(",", "rows", "_a", "_b").cast("binary"), 256).alias("ids_digest"))


def ordered_manifest(index: DataFrame) -> DataFrame:
    """Rows of each locale and the SHA-256 of its ids (kind/id) in order, one a line; ids that are null are rows only.

    Ids are sorted in ranges over all tasks and packed into pieces of about PIECE characters; one task for each locale then streams
    its pieces, in order, through the hash.  No row or task holds a locale's ids, though one hash has to read them in turn."""
    kind = index.schema["locale"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, piece, size, rows, now, locales = TaskContext.get().partitionId(), 0, [], 0, 0, None, None

        def full() -> pa.RecordBatch:
            data = "\n".join(piece).encode() if piece else None
            return pa.RecordBatch.from_arrays([pa.array([now], locales), pa.array([part], pa.int32()), pa.array([seq], pa.int64()), pa.array([rows], pa.int64()), pa.array([data], pa.binary())], names=["locale", "part", "seq", "n", "data"])

        for batch in batches:
            locales = batch.column("locale").type
            for locale, id_ in zip(batch.column("locale").to_pylist(), batch.column("id").to_pylist()):
                if rows and (locale != now or size >= PIECE):
                    yield full()
                    seq, piece, size, rows = seq + 1, [], 0, 0
                now, rows = locale, rows + 1
                if id_ is not None:
                    piece.append(id_)
                    size += len(id_)
        if rows:
            yield full()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, sha, locales = None, 0, None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], locales), pa.array([rows], pa.int64()), pa.array([sha and sha.hexdigest()], pa.string())], names=["locale", "rows", "ids_sha256"])

        for batch in batches:
            locales = batch.column("locale").type
            for locale, n, data in zip(batch.column("locale").to_pylist(), batch.column("n").to_pylist(), batch.column("data").to_pylist()):
                if rows and locale != now:
                    yield done()
                    rows, sha = 0, None
                now, rows = locale, rows + n
                if data is not None:
                    if sha is None:
                        sha = hashlib.sha256(data)
                    else:
                        sha.update(b"\n" + data)
        if rows:
            yield done()

    ids = index.select("locale", F.concat("kind", F.lit("/"), "id").alias("id")).repartitionByRange("locale", "id").sortWithinPartitions("locale", "id")
    pieces = ids.mapInArrow(pack, f"locale {kind}, part int, seq bigint, n bigint, data binary")
    return pieces.repartition("locale").sortWithinPartitions("locale", "part", "seq").mapInArrow(digest, f"locale {kind}, rows bigint, ids_sha256 string")
