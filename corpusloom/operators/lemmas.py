"""From surfaces to headwords: gates, tiers, overrides, conventions, closure and folds."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def dictionary_gate(primary: DataFrame, fallback: DataFrame, known: DataFrame) -> DataFrame:
    """(tok, lemma): the primary lemma, or where that is neither the word itself nor known (tok), the fallback's."""
    words = known.select(F.col("tok").alias("lemma"), F.lit(True).alias("_known")).distinct()
    rows = primary.join(words, "lemma", "left").join(fallback.select("tok", F.col("lemma").alias("_other")), "tok", "left")
    return rows.select("tok", F.when((F.col("lemma") != F.col("tok")) & F.col("_known").isNull(), F.coalesce("_other", "tok")).otherwise(F.col("lemma")).alias("lemma"))


def tiered(counts: DataFrame, primary: DataFrame, fallback: DataFrame, threshold: int) -> DataFrame:
    """(tok, lemma): the primary lemma of words counted threshold times or more, the fallback's of others, else the word."""
    rows = counts.join(primary.withColumnRenamed("lemma", "_a"), "tok", "left").join(fallback.withColumnRenamed("lemma", "_b"), "tok", "left")
    return rows.select("tok", F.when(F.col("count") >= threshold, F.coalesce("_a", "tok")).otherwise(F.coalesce("_b", "tok")).alias("lemma"))


def overridden(lemmas: DataFrame, overrides: DataFrame, known: DataFrame) -> DataFrame:
    """(tok, lemma): overrides (tok, lemma) win; another lemma that is not known (tok) goes back to the word."""
    words = known.select(F.col("tok").alias("lemma"), F.lit(True).alias("_known")).distinct()
    rows = lemmas.join(overrides.select("tok", F.col("lemma").alias("_set")), "tok", "left").join(words, "lemma", "left")
    return rows.select("tok", F.coalesce("_set", F.when((F.col("lemma") == F.col("tok")) | F.col("_known"), F.col("lemma")), "tok").alias("lemma"))


def lemma_counts(counts: DataFrame, lemmas: DataFrame, shares: DataFrame | None = None) -> DataFrame:
    """(lemma, count): counts summed by lemma (a word without one is its own); shares (tok, lemma, share) replace whole words' counts."""
    whole = counts if shares is None else counts.join(shares.select("tok").distinct(), "tok", "left_anti")
    rows = whole.join(lemmas, "tok", "left").select(F.coalesce("lemma", "tok").alias("lemma"), "count")
    if shares is not None:
        rows = rows.union(shares.select("lemma", F.col("share").alias("count")))
    return rows.groupBy("lemma").agg(F.sum("count").alias("count"))


def conventions(lemmas: DataFrame, known: DataFrame, contractions: list[str] = (), pronouns: list[str] = (), allomorphs: dict[str, str] | None = None, comparatives: dict[str, str] | None = None, fold: dict[str, str] | None = None, keep: dict[str, str] | None = None, exceptions: list[str] = (), relemmatized: DataFrame | None = None) -> DataFrame:
    """(tok, lemma, rule, new_lemma) of lemmas (tok, lemma): headword rules, the first that fits wins, in this order: pronouns, clitic
    forms, comparatives and contractions are named headwords, diminutives stay apart; a spelling reform of an unknown
    lemma goes on to the gender rules: exceptions stay, listed pairs fold into the masculine, listed others stay feminine.

    known (tok) is the dictionary; relemmatized (tok, lemma) leads reformed plurals to their singular.
    """
    maps = lambda m: F.create_map(*(F.lit(x) for kv in m.items() for x in kv)) if m else None
    look = lambda m, c: maps(m)[c] if m else F.lit(None).cast("string")
    tok, lemma = F.col("tok"), F.col("lemma")
    # only lemmas that have candidates are joined with the dictionary
    cand = lemmas.select("lemma").distinct().select("lemma", F.posexplode(T.reform_candidates(lemma)).alias("_k", "_cand"))
    words = known.select("tok").distinct()
    cand = cand.join(words.withColumnRenamed("tok", "lemma"), "lemma", "left_anti").join(words.withColumnRenamed("tok", "_cand"), "_cand", "left_semi")
    reform = cand.groupBy("lemma").agg(F.min_by("_cand", "_k").alias("_reform"))
    if relemmatized is not None:
        again = relemmatized.join(words.withColumnRenamed("tok", "lemma"), "lemma", "left_semi").select(F.col("tok").alias("_reform"), F.col("lemma").alias("_again"))
        reform = reform.join(again, "_reform", "left").select("lemma", F.when(F.col("_reform").endswith("s"), F.coalesce("_again", "_reform")).otherwise(F.col("_reform")).alias("_reform"))
    rows = lemmas.join(reform, "lemma", "left").withColumn("_lemma2", F.coalesce("_reform", "lemma"))
    sg = T.singular(tok)
    first = (
        F.when(tok.isin(*pronouns), F.struct(F.lit("1_pronouns").alias("rule"), tok.alias("to")))
        .when(look(allomorphs, tok).isNotNull(), F.struct(F.lit("1_clitic_allomorphs").alias("rule"), look(allomorphs, tok).alias("to")))
        .when(look(comparatives, tok).isNotNull(), F.struct(F.lit("4_comparatives").alias("rule"), look(comparatives, tok).alias("to")))
        .when(tok.isin(*contractions), F.struct(F.lit("1_contractions").alias("rule"), tok.alias("to")))
        .when(T.diminutive_of(tok, lemma).isNotNull(), F.struct(F.lit("3_diminutives").alias("rule"), T.diminutive_of(tok, lemma).alias("to")))
        .when(sg.isin(*exceptions), F.struct(F.lit("2_gender_exception").alias("rule"), sg.alias("to")))
        .when(look(fold, F.col("_lemma2")).isNotNull(), F.struct(F.lit("2_gender").alias("rule"), look(fold, F.col("_lemma2")).alias("to")))
        .when(F.col("_lemma2") == look(keep, sg), F.struct(F.lit("2_gender_exception").alias("rule"), sg.alias("to")))
        .when(F.col("_lemma2") != lemma, F.struct(F.lit("5_spelling_reform").alias("rule"), F.col("_lemma2").alias("to")))
    )
    rows = rows.withColumn("_r", first).withColumn("new_lemma", F.coalesce("_r.to", "_lemma2"))
    return rows.select("tok", "lemma", F.when(F.col("new_lemma") != lemma, F.col("_r.rule")).alias("rule"), "new_lemma")


def settled(df: DataFrame) -> DataFrame:
    """df with its lineage cut in the shared checkpoint folder; without one it is an error on a cluster, and a temporary folder on one machine."""
    spark = df.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.getCheckpointDir() is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="corpusloom-"))
    return df.checkpoint()


def closure(redirects: DataFrame) -> DataFrame:
    """(src, dst, final) of redirects (src, dst), a function: where each chain ends; on a cycle, at the smallest word of the whole path walked.

    Pointer doubling: a round joins the relation with itself, so each doubles the steps that are followed. Rounds end when no pointer moves or, as those on cycles
    always do, when as many steps as there are redirects have been followed. Lineage is cut in the shared folder.
    """
    redirects = settled(redirects.filter("src != dst"))
    n, steps = redirects.count(), 1
    # at: where steps lead; least: the smallest word met on the way
    step = redirects.select("src", F.col("dst").alias("at"), F.least("src", "dst").alias("least"))
    while steps <= n:
        ahead = step.select(F.col("src").alias("at"), F.col("at").alias("_at"), F.col("least").alias("_least"))
        step = step.join(ahead, "at", "left").select("src", F.coalesce("_at", "at").alias("at"), F.least("least", F.coalesce("_least", "least")).alias("least"), F.col("_at").isNotNull().alias("moved")).checkpoint()
        if step.filter("moved").isEmpty():
            break
        steps *= 2
    # an end that redirects further lies on a cycle
    ends = step.join(redirects.select(F.col("src").alias("at"), F.lit(True).alias("_more")), "at", "left")
    final = ends.select("src", F.when(F.col("_more"), F.col("least")).otherwise(F.col("at")).alias("final"))
    return redirects.join(final, "src").select("src", "dst", "final")


def diacritic_folds(counts: DataFrame, known: DataFrame | None = None, ratio: float = 10) -> DataFrame:
    """(from_lemma, into_lemma, from_count, into_count, kind): a lemma folds into the commonest one of its unaccented spelling: if it has
    no accents and that one is ratio times as common, or (accent) if it has and is not known (tok); -ã against -a stays. The head never folds."""
    own = Window.partitionBy("_bare")
    rows = counts.withColumn("_bare", T.strip_diacritics(F.col("lemma")))
    rows = rows.withColumn("_head", F.min_by("lemma", F.struct(-F.col("count"), "lemma")).over(own)).withColumn("_most", F.max("count").over(own)).filter("lemma != _head")
    if known is not None:
        rows = rows.join(known.select(F.col("tok").alias("lemma"), F.lit(True).alias("_known")).distinct(), "lemma", "left")
    else:
        rows = rows.withColumn("_known", F.lit(True))
    plain = (F.col("lemma") == F.col("_bare")) & (F.col("_most") >= ratio * F.col("count"))
    accent = (F.col("lemma") != F.col("_bare")) & F.col("_known").isNull() & ~(F.col("lemma").endswith("ã") & F.col("_head").endswith("a"))
    return rows.withColumn("kind", F.when(plain, "unaccented").when(accent, "accent")).filter("kind is not null").select(F.col("lemma").alias("from_lemma"), F.col("_head").alias("into_lemma"), F.col("count").alias("from_count"), F.col("_most").alias("into_count"), "kind")


def folded(counts: DataFrame, folds: DataFrame) -> DataFrame:
    rows = counts.join(folds.select(F.col("from_lemma").alias("lemma"), "into_lemma"), "lemma", "left")
    return rows.groupBy(F.coalesce("into_lemma", "lemma").alias("lemma")).agg(F.sum("count").alias("count"))


def plural_folds(counts: DataFrame, known: DataFrame, exempt: tuple[str, ...] = (), max_ratio: float = 5, min_count: int = 1000) -> DataFrame:
    """(plural, singular): the first candidate singular among the lemmas that is known or common, of a plural not too much commoner."""
    plurals = counts.filter(~F.col("lemma").isin(*exempt)) if exempt else counts
    cand = plurals.select(F.col("lemma").alias("plural"), F.col("count").alias("_n"), F.posexplode(T.singular_candidates(F.col("lemma"))).alias("_k", "singular"))
    words = known.select(F.col("tok").alias("singular"), F.lit(True).alias("_known")).distinct()
    rows = cand.join(counts.select(F.col("lemma").alias("singular"), F.col("count").alias("_m")), "singular").join(words, "singular", "left")
    fits = rows.filter((F.col("_known") | (F.col("_m") >= min_count)) & (F.col("_n") <= max_ratio * F.col("_m")))
    return fits.groupBy("plural").agg(F.min_by("singular", "_k").alias("singular"))
