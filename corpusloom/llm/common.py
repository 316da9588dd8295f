"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A-Z to a-z; other letters keep their case.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: What a Python worker keeps from task to task, by operator.
KEPT: dict[str, object] = {}
#: Spark's setting for the bytes of a batch that goes to a Python worker, and its value here.
BATCH_BYTES, BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"
#: Bytes of a group's rows from which memory is given back after it; smaller groups leave that to the next large one.
LARGE = 1 << 20
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's; other systems go without


def release(keep: str = "") -> None:
    """Give back to the system what is free, and drop what other operators than keep kept.

    A Python worker serves tasks of many stages, and the allocators hold what one of them needed at its peak; so executors would come to hold the sum of the peaks.
    """
    for name in KEPT.keys() - {keep}:
        del KEPT[name]
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def by_batches(f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], keep: str = "") -> Callable:
    """f for mapInArrow; memory is given back before and after each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release(keep)
        yield from f(batches)
        release(keep)

    return run


def bound_batches(spark: SparkSession) -> None:
    """Let batches for Python workers hold about BATCH bytes, at least a row; a bound that the session has is left.

    Spark bounds them by rows first, and ten thousand whole texts are tens of megabytes, held by the JVM and by the worker.
    """
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, BATCH)


def arrow_map(df: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema, keep: str = "") -> DataFrame:
    """df.mapInArrow of f, in bounded batches."""
    bound_batches(df.sparkSession)
    return df.mapInArrow(by_batches(f, keep), schema)


def by_group(f: Callable[[pa.Table], pa.Table]) -> Callable:
    """f for applyInArrow of a group; memory is given back after large ones."""

    def run(rows: pa.Table) -> pa.Table:
        out = f(rows)
        if rows.nbytes >= LARGE:
            release()
        return out

    return run


def by_groups(f: Callable[[pa.Table, pa.Table], pa.Table]) -> Callable:
    """f for applyInArrow of two groups; memory is given back after large ones."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = f(left, right)
        if left.nbytes + right.nbytes >= LARGE:
            release()
        return out

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, or the one set on the context; a missing one is an error, for executors would not see a local folder."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found and spark.sparkContext.master.startswith("local"):
        found = tempfile.mkdtemp(prefix="corpusloom-")  # one machine, as in tests
        spark.sparkContext.setCheckpointDir(found)
    if not found:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return found


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage of df with files in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def ascii_lower(text):
    """Column with A-Z lower-cased and nothing else: lower() where all is ASCII, translate() elsewhere."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def unused(name: str, columns: list[str]) -> str:
    """name, or a longer one that none of columns has in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts together."""
    return docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
