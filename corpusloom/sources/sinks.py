"""Writers of the list, its review files and reports."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

COLUMNS = ("rank", "lemma", "is_mwe", "pos", "raw_freq", "freq_per_million")


def _one_file(rows: DataFrame, *order) -> DataFrame:
    """rows of a published file, which is at most as long as the list, sorted in one partition."""
    return rows.coalesce(1).sortWithinPartitions(*order)


def entry_rows(entries: DataFrame) -> DataFrame:
    return entries.select("rank", "lemma", F.col("is_mwe").cast("int").cast("string").alias("is_mwe"), "pos", "raw_freq", F.format_string("%.3f", "freq_per_million").alias("freq_per_million"))


def write_bands(entries: DataFrame, bands: list[tuple[int, int]], path: str) -> None:
    """A TSV and a CSV folder for each band of ranks."""
    for low, high in bands:
        rows = _one_file(entry_rows(entries.filter(F.col("rank").between(low, high))), "rank")
        for sep, kind in (("\t", "tsv"), (",", "csv")):
            rows.write.mode("overwrite").option("sep", sep).option("header", True).csv(f"{path}/band_{low:05d}_{high:05d}.{kind}")


def card_lines(entries: DataFrame, header: dict[str, str], full: bool = False, fixed: tuple[str, ...] = ()) -> DataFrame:
    """(k, value): lines of a flash-card file, directives first; full adds empty fields to fill in."""
    spark = entries.sparkSession
    head = spark.createDataFrame([(k - len(header), f"#{a}:{b}") for k, (a, b) in enumerate(header.items())], "k long, value string")
    cells = [F.col("lemma"), F.col("pos"), F.col("rank").cast("string"), *([F.lit("")] * 3 if full else []), T.tag_string(F.col("rank"), F.col("pos"), F.col("is_mwe"), fixed)]
    return head.union(entries.select(F.col("rank").cast("long"), F.concat_ws("\t", *(T.squeeze(c) for c in cells))))


def write_lines(lines: DataFrame, path: str) -> None:
    _one_file(lines, "k").select("value").write.mode("overwrite").text(path)


def dropped_lines(log: DataFrame, min_count: int = 0) -> DataFrame:
    """(k, value): dropped lemmas by reason, each reason under a comment line."""
    rows = log.filter(F.col("count") >= min_count)
    heads = rows.groupBy("reason").agg(F.count("*").alias("n")).select("reason", F.lit(0).alias("o"), F.lit(0).cast("long").alias("c"), F.lit("").alias("lemma"), F.concat(F.lit("# "), "reason", F.lit(": "), F.col("n").cast("string")).alias("value"))
    body = rows.select("reason", F.lit(1).alias("o"), (-F.col("count")).alias("c"), "lemma", F.concat_ws("\t", F.col("count").cast("string"), "lemma").alias("value"))
    return heads.union(body).select(F.struct("reason", "o", "c", "lemma").alias("k"), "value")


def write_table(rows: DataFrame, path: str, *order: str, sep: str = "\t") -> None:
    """A small review table as one sorted file with a header; cells without line breaks."""
    cells = [T.squeeze(F.col(c)).alias(c) if t == "string" else F.col(c) for c, t in rows.dtypes]
    _one_file(rows.select(*cells), *(order or rows.columns[:1])).write.mode("overwrite").option("sep", sep).option("header", True).csv(path)


def stats_json(stats: dict) -> str:
    return json.dumps(stats, ensure_ascii=False, indent=2, sort_keys=True)


def markdown(title: str, sections: list[tuple[str, DataFrame]], limit: int = 200) -> str:
    """A report: each section a table of at most limit rows, which is all that reaches the driver."""
    out = [f"# {title}", ""]
    for name, rows in sections:
        found = rows.limit(limit).collect()
        out += [f"## {name}", "", "| " + " | ".join(rows.columns) + " |", "|" + " --- |" * len(rows.columns)]
        out += ["| " + " | ".join(str(v).replace("|", "\\|") for v in r) + " |" for r in found] + [""]
    return "\n".join(out)
