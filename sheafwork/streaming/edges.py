"""Datasets that arrive over time: each batch of rows is promoted once, by key and digest.

The reference has no stream; its reruns are incremental.  This is the same rule as a Structured Streaming sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from sheafwork.sources.writers import promote, promotion_plan


def promote_stream(drafts: DataFrame, canonical_path: str, checkpoint: str, key: Sequence[str], columns: Sequence[str]) -> StreamingQuery:
    """Starts a query that writes the keys of each batch that are new or changed.  A batch that is run again after a failure
    finds its keys unchanged and writes nothing."""

    def batch(df: DataFrame, epoch: int) -> None:
        spark = df.sparkSession
        try:
            there = spark.read.parquet(canonical_path).select(*df.columns)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            there = df.limit(0)
        there = there.join(df.select(*key).distinct(), list(key), "left_semi")
        promote(df, canonical_path, promotion_plan(df, there, key, columns), key)

    return drafts.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
