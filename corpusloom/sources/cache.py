"""Intermediate tables kept under a digest of what made them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to the end; asks the path's own file system, so any store will do."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def cached(spark: SparkSession, root: str, name: str, key: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table root/name/key, built and written as Parquet where it isn't there."""
    path = f"{root}/{name}/{key}"
    if not exists(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def stamp(table: DataFrame) -> str:
    """An order-free digest of a table's rows, for the keys of what depends on it."""
    row = F.xxhash64(*(F.col(c).cast("string") for c in table.columns)).cast("decimal(38,0)")
    n, s = table.agg(F.count("*"), F.sum(row)).first()
    return f"{n}-{s}"
