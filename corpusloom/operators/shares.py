"""Votes and the exact division of counts by them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def apportion(rows: DataFrame, group: list[str], key: str, total: str = "total", votes: str = "votes") -> DataFrame:
    """rows with share: each group's whole total divided by votes, largest remainders first and ties to the smaller key; shares of 0 go.

    rows has one row a group and key, each with the group's total.
    """
    own = Window.partitionBy(*group)
    part = F.col(total) * F.col(votes).cast("double") / F.sum(votes).over(own)
    rows = rows.withColumn("_part", part).withColumn("_base", F.floor("_part").cast("long")).withColumn("_rest", F.col("_part") - F.col("_base"))
    rows = rows.withColumn("_left", F.col(total) - F.sum("_base").over(own)).withColumn("_k", F.row_number().over(own.orderBy(F.desc("_rest"), key)))
    return rows.withColumn("share", F.col("_base") + (F.col("_k") <= F.col("_left")).cast("long")).filter("share > 0").drop("_part", "_base", "_rest", "_left", "_k")


def majority(rows: DataFrame, group: list[str], key: str, votes: str = "votes") -> DataFrame:
    """The key with most votes of each group, on ties the smallest."""
    return rows.groupBy(*group).agg(F.min_by(key, F.struct(-F.col(votes), key)).alias(key))


def filtered_majority(rows: DataFrame, group: list[str], key: str, keep: str, votes: str = "votes") -> DataFrame:
    """majority over the rows that keep holds for, or over all of a group in which it holds for none."""
    own = Window.partitionBy(*group)
    return majority(rows.withColumn("_any", F.max(keep).over(own)).filter(F.col(keep) | ~F.col("_any")).groupBy(*group, key).agg(F.sum(votes).alias(votes)), group, key, votes)


def backend_vote(rows: DataFrame, priority: dict[str, int]) -> DataFrame:
    """(tok, lemma) from rows (tok, lemma, backend): most backends, then the best priority, then the smaller lemma."""
    rank = F.coalesce(F.create_map(*(F.lit(x) for kv in priority.items() for x in kv))[F.col("backend")], F.lit(len(priority)))
    own = rows.groupBy("tok", "lemma").agg(F.count("*").alias("n"), F.min(rank).alias("p"))
    return own.groupBy("tok").agg(F.min_by("lemma", F.struct(-F.col("n"), "p", "lemma")).alias("lemma"))


def redistribute(rows: DataFrame, group: str, key: str, undecided: str, votes: str = "votes") -> DataFrame:
    """Votes for undecided shared out in the ratio of the group's other keys (kept where there are none)."""
    own = Window.partitionBy(group)
    spare = F.sum(F.when(F.col(key) == undecided, F.col(votes)).otherwise(0)).over(own)
    known = F.sum(F.when(F.col(key) != undecided, F.col(votes)).otherwise(0)).over(own)
    rows = rows.withColumn("_spare", spare).withColumn("_known", known)
    return rows.filter((F.col(key) != undecided) | (F.col("_known") == 0)).withColumn(votes, F.when(F.col("_known") == 0, F.col(votes).cast("double")).otherwise(F.col(votes) + F.col("_spare") * F.col(votes).cast("double") / F.col("_known"))).drop("_spare", "_known")


def joint_votes(tags: DataFrame) -> DataFrame:
    """(tok, lemma, upos, votes) of tags (tok, lemma, upos)."""
    return tags.groupBy("tok", "lemma", "upos").agg(F.count("*").alias("votes"))


def lemma_votes(joint: DataFrame) -> DataFrame:
    return joint.groupBy("tok", "lemma").agg(F.sum("votes").alias("votes"))


def pos_rows(shares: DataFrame, min_share: float = 0.25, min_votes: int = 3) -> DataFrame:
    """(lemma, pos, raw_freq): shares (lemma, pos, weight, votes) with weak secondary readings joined to the main one."""
    own = Window.partitionBy("lemma")
    main = F.row_number().over(own.orderBy(F.desc("weight"), "pos")) == 1
    strong = (F.col("weight") >= min_share * F.sum("weight").over(own)) & (F.col("votes") >= min_votes)
    rows = shares.withColumn("_main", main).withColumn("_strong", strong | main).withColumn("_first", F.min_by("pos", F.struct(-F.col("weight"), "pos")).over(own))
    return rows.groupBy("lemma", F.when(F.col("_strong"), F.col("pos")).otherwise(F.col("_first")).alias("pos")).agg(F.sum("weight").alias("raw_freq"))
