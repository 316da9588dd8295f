"""Checks, comparisons and scores of published lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def pair_key(a: str, b: str) -> Column:
    return F.concat_ws("\x1f", F.least(a, b), F.greatest(a, b))


def suspect_diacritics(entries: DataFrame) -> DataFrame:
    """Entries that differ from the commonest entry of their unaccented spelling by accents alone."""
    own = Window.partitionBy(T.strip_diacritics(F.col("lemma")))
    rows = entries.withColumn("other", F.min_by("lemma", "rank").over(own)).withColumn("other_rank", F.min("rank").over(own)).filter("lemma != other")
    return rows.select(F.lit("diacritic").alias("kind"), F.col("lemma").alias("entry"), F.col("rank").alias("entry_rank"), "other", "other_rank")


def suspect_inflections(entries: DataFrame, gender: bool = False) -> DataFrame:
    """Entries that are a regular plural (or gender form) of another entry."""
    forms = F.concat(T.plural_forms(F.col("lemma")), T.gender_forms(F.col("lemma"))) if gender else T.plural_forms(F.col("lemma"))
    made = entries.select(F.explode(forms).alias("entry"), F.col("lemma").alias("other"), F.col("rank").alias("other_rank")).filter("entry != other")
    return made.join(entries.select(F.col("lemma").alias("entry"), F.col("rank").alias("entry_rank")), "entry").select(F.lit("inflected").alias("kind"), "entry", "entry_rank", "other", "other_rank").distinct()


def suspect_lemmas(entries: DataFrame, lemmas: DataFrame) -> DataFrame:
    """Entries whose own lemma (tok, lemma) is another entry."""
    rows = entries.select(F.col("lemma").alias("entry"), F.col("rank").alias("entry_rank")).join(lemmas.select(F.col("tok").alias("entry"), F.col("lemma").alias("other")), "entry").filter("entry != other")
    return rows.join(entries.select(F.col("lemma").alias("other"), F.col("rank").alias("other_rank")), "other").select(F.lit("relemmatize").alias("kind"), "entry", "entry_rank", "other", "other_rank")


def suspects(parts: list[DataFrame], whitelist: DataFrame | None = None) -> DataFrame:
    """All suspects, a pair once a kind, without whitelisted pairs (a, b) in either order."""
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    rows = rows.withColumn("_pair", pair_key("entry", "other"))
    if whitelist is not None:
        rows = rows.join(whitelist.select(pair_key("a", "b").alias("_pair")).distinct(), "_pair", "left_anti")
    first = Window.partitionBy("kind", "_pair").orderBy("entry_rank", "entry")
    return rows.withColumn("_k", F.row_number().over(first)).filter("_k = 1").drop("_k", "_pair")


def enforce(found: DataFrame) -> None:
    """Fail if there are suspects; called after all outputs are written."""
    if rows := found.orderBy("entry_rank", "kind", "entry").limit(5).collect():
        raise ValueError("suspect entries: " + ", ".join(f"{r.entry}/{r.other}" for r in rows))


def compare(old: DataFrame, new: DataFrame) -> DataFrame:
    """(lemma, o_rank, r_rank, state): both lists (lemma, rank) side by side."""
    rows = old.select("lemma", F.col("rank").alias("o_rank")).join(new.select("lemma", F.col("rank").alias("r_rank")), "lemma", "full_outer")
    return rows.withColumn("state", F.when(F.col("o_rank").isNull(), "new").when(F.col("r_rank").isNull(), "lost").otherwise("shared"))


def comparison_scores(both: DataFrame) -> DataFrame:
    """One row: shared, lost, new, jaccard and the correlation of ranks of the shared."""
    return both.agg(
        F.count_if(F.col("state") == "shared").alias("shared"), F.count_if(F.col("state") == "lost").alias("lost"), F.count_if(F.col("state") == "new").alias("new"),
        (F.count_if(F.col("state") == "shared") / F.nullif(F.count("*"), F.lit(0))).alias("jaccard"), F.round(F.corr(F.col("o_rank").cast("double"), F.col("r_rank").cast("double")), 6).alias("rho"),
    )


def largest_moves(both: DataFrame, n: int = 40) -> DataFrame:
    rows = both.filter("state = 'shared'").withColumn("delta", F.col("r_rank") - F.col("o_rank"))
    return rows.orderBy(F.desc(F.abs("delta")), "lemma").limit(n).select("lemma", "o_rank", "r_rank", "delta")


def gold_scores(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """Accuracy over all, by band and by category of gold (tok, answers, band, category); a word without prediction is its own lemma."""
    rows = gold.join(predicted, "tok", "left").withColumn("ok", F.array_contains("answers", F.coalesce("lemma", "tok")).cast("int"))
    sets = rows.groupingSets([[], ["band"], ["category"]], "band", "category")
    return sets.agg(F.count("*").alias("n"), F.sum("ok").cast("long").alias("right"), F.round(F.avg("ok"), 6).alias("accuracy"))


def gold_answers(first: Column, human: Column, verdict: Column) -> Column:
    """Accepted lemmas: the human answer over the first; alternatives split at |; null for a dropped row."""
    best = F.coalesce(F.nullif(F.trim(human), F.lit("")), F.trim(first))
    return F.when(F.coalesce(F.trim(verdict), F.lit("")) != "drop", F.transform(F.split(best, r"\|"), lambda x: F.trim(x)))


def confusion(rows: DataFrame, by: str, truth: str, guess: str, unsure: str) -> DataFrame:
    """Tallies by value and over all: n, decided, correct, abstained."""
    decided = F.col(guess) != unsure
    return rows.rollup(by).agg(F.count("*").alias("n"), F.count_if(decided).alias("decided"), F.count_if(decided & (F.col(guess) == F.col(truth))).alias("correct"), F.count_if(~decided).alias("abstained"))


def merged_review(previous: DataFrame, fresh: DataFrame, key: str, human: list[str]) -> DataFrame:
    """fresh rows with the human columns of previous ones; state tells kept, new and lost rows (only in previous)."""
    old = previous.select(key, *(F.col(c).alias(f"_{c}") for c in human), F.lit(True).alias("_old"))
    rows = fresh.withColumn("_new", F.lit(True)).join(old, key, "full_outer")
    state = F.when(F.col("_old").isNull(), "new").when(F.col("_new").isNull(), "lost").otherwise("kept")
    return rows.select(*(c for c in fresh.columns if c not in human), *(F.col(f"_{c}").alias(c) for c in human), state.alias("state"))


def whitelist_pairs(found: DataFrame, known: DataFrame) -> DataFrame:
    """(a, b, verdict) of suspects: both words known is a pair to keep, one alone a typo."""
    rows = found.select(F.least("entry", "other").alias("a"), F.greatest("entry", "other").alias("b")).distinct()
    for side in ("a", "b"):
        rows = rows.join(known.select(F.col("tok").alias(side), F.lit(True).alias(f"_{side}")).distinct(), side, "left")
    return rows.select("a", "b", F.when(F.col("_a") & F.col("_b"), "keep").when(F.col("_a").isNull() & F.col("_b").isNull(), "unknown").otherwise("typo").alias("verdict"))


def fingerprint_deltas(old: DataFrame, new: DataFrame) -> DataFrame:
    """(measure, old, new, delta, percent) of two rows of totals."""
    names = ("lines", "tokens", "types")
    both = old.select(*(F.col(n).alias(f"o_{n}") for n in names)).crossJoin(new.select(*(F.col(n).alias(f"n_{n}") for n in names)))
    rows = both.select(F.explode(F.array(*(F.struct(F.lit(n).alias("measure"), F.col(f"o_{n}").cast("double").alias("old"), F.col(f"n_{n}").cast("double").alias("new")) for n in names), F.struct(F.lit("tokens_per_line").alias("measure"), (F.col("o_tokens") / F.col("o_lines")).alias("old"), (F.col("n_tokens") / F.col("n_lines")).alias("new")))).alias("r")).select("r.*")
    return rows.withColumn("delta", F.round(F.col("new") - F.col("old"), 6)).withColumn("percent", F.round((F.col("new") - F.col("old")) * 100 / F.nullif(F.col("old"), F.lit(0.0)), 6))
