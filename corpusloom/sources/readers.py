"""Scans: lines, delimited tables with fixed schemas, and dictionaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Column types of the tables that people edit, by name.
SCHEMAS = {
    "glue": "glued string, stem string, clitic string, hyphenated_count long, glued_count long, ratio double",
    "overrides": "tok string, lemma string",
    "gold": "rank long, surface string, count long, first_lemma string, category string, note string, human_lemma string, verdict string",
    "gender": "feminine string, masculine string, fem_count long, masc_count long, first_decision string, reason string, human_decision string",
    "review": "lemma string, count long, cap_ratio double, cap_ratio_before double, filter_drops string, decision string, note string",
    "entries": "rank long, lemma string, is_mwe string, pos string, raw_freq long, freq_per_million double",
    "gloss_overrides": "lemma string, pos string, gloss string, example_pt string, example_en string, source string, note string",
}


def read_lines(spark: SparkSession, path: str, sample: int | None = None, partitions: int | None = None) -> DataFrame:
    """(line_id, line) of text files, compressed or not; bad bytes become U+FFFD. line_id ascends with the lines of a file split.

    A gzip file is read by one task, so partitions deals its lines out before the work begins. sample takes the first lines of a single file.
    """
    lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("line_id"), F.make_valid_utf8("value").alias("line"))
    if sample is not None:
        lines = lines.orderBy("line_id").limit(sample)
    return lines.repartition(partitions) if partitions else lines


def read_table(spark: SparkSession, path: str, schema: str, sep: str = "\t", header: bool = True, comment: str | None = None) -> DataFrame:
    """A delimited file under a fixed schema (a name of SCHEMAS or a DDL string); comment starts lines to skip."""
    reader = spark.read.schema(SCHEMAS.get(schema, schema)).option("sep", sep).option("header", header).option("mode", "FAILFAST").option("enforceSchema", True)
    if sep == "\t":
        reader = reader.option("quote", "")
    if comment:
        reader = reader.option("comment", comment)
    return reader.csv(path)


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """(tok): the distinct lower-cased words of a file with one a line."""
    return spark.read.text(path).select(F.lower(F.trim("value")).alias("tok")).filter("tok != ''").distinct()


def assert_matched(overrides: DataFrame, rows: DataFrame, keys: list[str]) -> None:
    """Fail on overrides whose keys no row has."""
    if lost := overrides.join(rows.select(*keys).distinct(), keys, "left_anti").limit(5).collect():
        raise ValueError(f"overrides without a row: {[tuple(r[k] for k in keys) for r in lost]}")
