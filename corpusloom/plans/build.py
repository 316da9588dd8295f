"""The list build: from lines to ranked entries, with a log of every decision."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import counts as C
from ..operators import filters as FL
from ..operators import lemmas as L
from ..operators import quality as Q
from ..operators import shares as S
from ..sources.config import Config


@dataclass
class Inputs:
    """Tables a build reads: lines (line), the dictionary (tok), lemmas by type (tok, lemma), and where known: context lemmas (tok, lemma),
    tags (tok, lemma, upos), overrides (tok, lemma), decisions (lemma, decision), glue (glued, stem, clitic)."""

    lines: DataFrame
    known: DataFrame
    type_lemmas: DataFrame
    context_lemmas: DataFrame | None = None
    tags: DataFrame | None = None
    overrides: DataFrame | None = None
    decisions: DataFrame | None = None
    glue: DataFrame | None = None


@dataclass
class Build:
    """What a build makes."""

    counts: DataFrame
    totals: DataFrame
    lemmas: DataFrame
    lemma_counts: DataFrame
    redirects: DataFrame
    folds: DataFrame
    dropped: DataFrame
    pos: DataFrame
    mwes: DataFrame
    entries: DataFrame
    suspects: DataFrame


def token_counts(inputs: Inputs, cfg: Config) -> DataFrame:
    """Word counts with clusters split. Clusters are split by distinct word, not by occurrence."""
    raw = inputs.lines.select(F.explode(T.tokens(T.clean("line"))).alias("tok")).groupBy("tok").agg(F.count("*").alias("count"))
    if not cfg["tokenizer"]["split_clusters"]:
        return raw
    clustered = F.col("tok").contains("-")
    parts = raw.filter(clustered).select("tok", "count", T.split_cluster(F.col("tok")).alias("parts"))
    if cfg["tokenizer"]["restore_stems"]:
        cand = parts.filter("size(parts) > 1").select("tok", F.posexplode(T.stem_candidates(F.col("parts")[0], F.col("parts")[1])).alias("k", "cand"))
        stems = cand.join(inputs.known.select(F.col("tok").alias("cand")).distinct(), "cand", "left_semi").groupBy("tok").agg(F.min_by("cand", "k").alias("stem"))
        parts = parts.join(stems, "tok", "left").withColumn("parts", F.when(F.col("stem").isNotNull(), F.concat(F.array("stem"), F.slice("parts", 2, F.size("parts")))).otherwise(F.col("parts")))
    plain = raw.filter(~clustered)
    if inputs.glue is not None and cfg["tokenizer"]["repair_glue"]:
        plain = plain.join(inputs.glue.select(F.col("glued").alias("tok"), "stem", "clitic"), "tok", "left").select(F.explode(F.when(F.col("stem").isNotNull(), F.array("stem", "clitic")).otherwise(F.array("tok"))).alias("tok"), "count")
    split = parts.select(F.explode("parts").alias("tok"), "count").filter("tok != ''")
    return plain.select("tok", "count").union(split).groupBy("tok").agg(F.sum("count").alias("count"))


def build(inputs: Inputs, cfg: Config) -> Build:
    counts = L.settled(token_counts(inputs, cfg))
    totals = C.totals(inputs.lines, counts)
    primary = inputs.context_lemmas if inputs.context_lemmas is not None else inputs.type_lemmas
    lemmas = L.tiered(counts, L.dictionary_gate(primary, inputs.type_lemmas, inputs.known), inputs.type_lemmas, cfg["lemmatizer"]["primary_tier"])
    if inputs.overrides is not None:
        lemmas = L.overridden(lemmas, inputs.overrides, inputs.known)
    if cfg.stage == 2:
        lemmas = L.conventions(lemmas, inputs.known, relemmatized=inputs.type_lemmas).select("tok", F.col("new_lemma").alias("lemma"))
    lemmas = L.settled(lemmas)
    shares = None
    if inputs.tags is not None and cfg.fix("split_ambiguous"):
        votes = S.lemma_votes(S.joint_votes(inputs.tags)).join(counts.select("tok", F.col("count").alias("total")), "tok")
        shares = S.apportion(votes, ["tok"], "lemma").select("tok", "lemma", "share")
    by_lemma = L.settled(L.lemma_counts(counts, lemmas, shares))
    redirects = by_lemma.select(F.col("lemma").alias("src"), F.col("lemma").alias("dst"), F.col("lemma").alias("final")).limit(0)
    if cfg.fix("lemma_closure"):
        own = by_lemma.select("lemma")
        step = own.join(lemmas.select(F.col("tok").alias("lemma"), F.col("lemma").alias("dst")), "lemma").filter("lemma != dst").join(own.withColumnRenamed("lemma", "dst"), "dst", "left_semi").select(F.col("lemma").alias("src"), "dst")
        if cfg.fix("plural_folding"):
            plural = L.plural_folds(by_lemma, inputs.known, (), cfg["fixes"]["plural_ratio"], cfg["fixes"]["plural_min_count"]).select(F.col("plural").alias("src"), F.col("singular").alias("dst"))
            step = step.union(plural.join(step.select("src"), "src", "left_anti"))
        redirects = L.closure(step)
        by_lemma = by_lemma.join(redirects.select(F.col("src").alias("lemma"), "final"), "lemma", "left").groupBy(F.coalesce("final", "lemma").alias("lemma")).agg(F.sum("count").alias("count"))
    by_lemma = L.settled(by_lemma)
    folds = L.diacritic_folds(by_lemma, inputs.known if cfg.fix("accent_folding") else None, cfg["fixes"]["fold_ratio"])
    if cfg.fix("diacritic_folding"):
        by_lemma = L.folded(by_lemma, folds)
    filters = cfg["filters"]
    listed = sorted(set(filters["exclusions"]) - set(filters["removals"]))
    rows = by_lemma.join(C.casing(inputs.lines).select(F.col("tok").alias("lemma"), "cap_ratio"), "lemma", "left").join(inputs.known.select(F.col("tok").alias("lemma"), F.lit(True).alias("known")).distinct(), "lemma", "left")
    rows = rows.join(inputs.decisions, "lemma", "left") if inputs.decisions is not None else rows.withColumn("decision", F.lit(None).cast("string"))
    rows = rows.select("lemma", "count", F.coalesce("cap_ratio", F.lit(0.0)).alias("cap_ratio"), F.coalesce("known", F.lit(False)).alias("known"), F.col("lemma").isin(*listed).alias("excluded") if listed else F.lit(False).alias("excluded"), F.lit(False).alias("foreign"), "decision")
    judged = L.settled(FL.cascade(rows, tuple(filters["interjections"]), filters["cap_ratio"]))
    kept, dropped = judged.filter("reason is null").select("lemma", "count"), judged.filter("reason is not null").select("lemma", "count", "cap_ratio", "reason")
    if inputs.tags is not None:
        readings = inputs.tags.groupBy("lemma", F.lower("upos").alias("pos")).agg(F.count("*").alias("votes"))
        weights = S.apportion(readings.join(kept.withColumnRenamed("count", "total"), "lemma"), ["lemma"], "pos").withColumnRenamed("share", "weight")
        tagged = S.pos_rows(weights.select("lemma", "pos", "weight", "votes"))
        pos = tagged.union(kept.join(tagged.select("lemma").distinct(), "lemma", "left_anti").select("lemma", F.lit("unk"), "count"))
    else:
        pos = FL.rule_pos(kept.withColumnRenamed("count", "raw_freq"), {}, ("ar", "er", "ir"), {"ção": "noun", "dade": "noun", "oso": "adj"}).select("lemma", "pos", "raw_freq")
    m = cfg["mwe"]
    pairs = C.bigrams(inputs.lines, C.vocabulary(counts, m["min_word"]))
    mwes = C.retained(C.collocations(pairs, counts, m["denominator"]), inputs.known if cfg.fix("mwe_check") else None, m["min_g2"], m["min_share"])
    every = pos.select("lemma", F.lit(False).alias("is_mwe"), "pos", F.col("raw_freq").alias("count")).unionByName(mwes.select(F.col("mwe").alias("lemma"), F.lit(True).alias("is_mwe"), F.lit("mwe").alias("pos"), F.col("raw_freq").alias("count")))
    top = C.per_million(C.ranked(every, cfg["output"]["limit"], ("lemma", "pos")), totals)
    entries = top.select("rank", "lemma", "is_mwe", "pos", F.col("count").alias("raw_freq"), "freq_per_million")
    entries = L.settled(entries)
    words = entries.filter("not is_mwe").groupBy("lemma").agg(F.min("rank").alias("rank"))
    suspects = Q.suspects([Q.suspect_diacritics(words), Q.suspect_inflections(words), Q.suspect_lemmas(words, lemmas)])
    return Build(counts, totals, lemmas, by_lemma, redirects, folds, dropped, pos, mwes, entries, suspects)
