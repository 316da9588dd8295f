"""Incremental counts: an extension for corpora that grow.

Counts are sums and the contexts of a word are the lines of the smallest digests, so both merge in any order; a batch that
is given twice is known by its number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import counts as C
from ..sources.cache import exists


def merge_counts(parts: list[DataFrame]) -> DataFrame:
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows.groupBy("tok").agg(F.sum("count").alias("count"))


def merge_contexts(parts: list[DataFrame], size: int) -> DataFrame:
    """The size first of all parts (tok, k, digest, line)."""
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    order = Window.partitionBy("tok").orderBy("digest", "line")
    return rows.drop("k").withColumn("k", F.row_number().over(order)).filter(F.col("k") <= size).select("tok", "k", "digest", "line")


def read_state(spark: SparkSession, root: str, batches: int, name: str = "counts") -> DataFrame:
    """All batches so far, merged."""
    parts = [spark.read.parquet(f"{root}/{name}/{b}") for b in range(batches) if exists(spark, f"{root}/{name}/{b}")]
    return merge_counts(parts)


def start(lines: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Count a stream of lines (line): every batch is written under its number, so a repeated batch replaces itself."""

    def one(batch: DataFrame, k: int) -> None:
        C.unigrams(batch).write.mode("overwrite").parquet(f"{root}/counts/{k}")

    return lines.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
