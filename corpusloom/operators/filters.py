"""Which lemmas are published, and under which part of speech."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def excluded(counts: DataFrame, words: list[str], removals: list[str] = (), unaccented: bool = True) -> DataFrame:
    """counts without the listed words (less removals), their unaccented spellings too."""
    spark = counts.sparkSession
    listed = spark.createDataFrame([(w,) for w in words if w not in set(removals)], "lemma string")
    if unaccented:
        listed = listed.union(listed.select(T.strip_diacritics(F.col("lemma"))))
    return counts.join(F.broadcast(listed.distinct()), "lemma", "left_anti")


def fragment(word: Column, known: Column, interjections: tuple[str, ...], max_length: int = 2) -> Column:
    return (F.length(word) <= max_length) & ~known & ~word.isin(*interjections)


def english_plural(word: str, known: str = "known", stem1: str = "stem1_en", stem2: str = "stem2_en", own: str = "last_en") -> Column:
    """An unknown word in s whose last part, and its stem, are English; the flags are joined before."""
    w = F.col(word)
    return w.endswith("s") & (F.length(w) >= 4) & ~F.col(known) & F.col(own) & (F.col(stem1) | F.col(stem2))


def proper_noun(cap_ratio: Column, known: Column, count: Column, threshold: float = 0.85, require_unknown: bool = False, min_count: int = 1) -> Column:
    return (cap_ratio >= threshold) & (count >= min_count) & ((~known) if require_unknown else F.lit(True))


def cascade(rows: DataFrame, interjections: tuple[str, ...], threshold: float = 0.85) -> DataFrame:
    """rows (lemma, count, cap_ratio, known, excluded, foreign, decision) with reason, null for what is kept.

    In order: exclusion list, fragments, foreign plurals; then an interjection or a decision keep is kept and a decision drop goes; then proper nouns go.
    """
    lemma, known = F.col("lemma"), F.col("known")
    reason = (
        F.when(F.col("excluded"), "exclusion")
        .when(fragment(lemma, known, interjections), "fragment")
        .when(F.col("foreign"), "foreign")
        .when(lemma.isin(*interjections) | F.col("decision").eqNullSafe("keep"), F.lit(None))
        .when(F.col("decision").eqNullSafe("drop"), "reviewed")
        .when(proper_noun(F.col("cap_ratio"), known, F.col("count"), threshold), "proper_noun")
    )
    return rows.withColumn("reason", reason)


def rule_pos(words: DataFrame, closed: dict[str, str], verb_endings: tuple[str, ...], suffixes: dict[str, str], adverb: str = "mente", min_verb: int = 4, fallback: str = "unk") -> DataFrame:
    """words (lemma, ...) with pos: closed classes, then the adverb ending, verb endings of long words, the longest listed suffix."""
    w = F.col("lemma")
    pos = F.when(w.isin(*closed), F.create_map(*(F.lit(x) for kv in closed.items() for x in kv))[w]) if closed else F.when(F.lit(False), "")
    pos = pos.when(w.endswith(adverb), "adv")
    if verb_endings:
        any_verb = F.lit(False)
        for e in verb_endings:
            any_verb = any_verb | w.endswith(e)
        pos = pos.when((F.length(w) >= min_verb) & any_verb, "verb")
    for s in sorted(suffixes, key=lambda s: (-len(s), s)):
        pos = pos.when(w.endswith(s), suffixes[s])
    return words.withColumn("pos", F.when(w.contains(" "), "mwe").otherwise(pos.otherwise(fallback)))


def suffix_rules(tagged: DataFrame, lengths: tuple[int, ...] = (4, 3, 2), min_support: int = 8, min_share: float = 0.65) -> DataFrame:
    """(suffix, pos, support, share) learnt from tagged (lemma, pos): suffixes whose commonest part of speech is common enough and not unk."""
    rows = tagged.select("pos", F.explode(F.array_compact(F.array(*(F.when(F.length("lemma") > n, F.right("lemma", F.lit(n))) for n in lengths)))).alias("suffix"))
    each = rows.groupBy("suffix", "pos").agg(F.count("*").alias("n"))
    best = each.groupBy("suffix").agg(F.min_by("pos", F.struct(-F.col("n"), "pos")).alias("pos"), F.max("n").alias("most"), F.sum("n").alias("support"))
    return best.withColumn("share", F.col("most") / F.col("support")).filter((F.col("support") >= min_support) & (F.col("share") >= min_share) & (F.col("pos") != "unk")).select("suffix", "pos", "support", "share")


def glue_candidates(counts: DataFrame, known: DataFrame, casing: DataFrame, min_hyphenated: int = 100, min_glued: int = 20, min_ratio: float = 2.0, max_cap: float = 0.5, min_evidence: int = 10) -> DataFrame:
    """(glued, stem, clitic, hyphenated_count, glued_count, ratio): clusters also written without their hyphen."""
    tail = F.substring_index("tok", "-", -1)
    hyphen = counts.filter(F.col("tok").contains("-") & tail.isin(*T.CLITICS) & (F.col("count") >= min_hyphenated)).select(F.regexp_replace("tok", "-", "").alias("glued"), F.regexp_extract("tok", "^(.*)-[^-]*$", 1).alias("stem"), tail.alias("clitic"), F.col("count").alias("hyphenated_count"))
    rows = hyphen.join(counts.select(F.col("tok").alias("glued"), F.col("count").alias("glued_count")), "glued").filter(F.col("glued_count") >= min_glued)
    rows = rows.withColumn("ratio", F.col("hyphenated_count") / F.col("glued_count")).filter(F.col("ratio") >= min_ratio).join(known.select(F.col("tok").alias("glued")), "glued", "left_anti")
    caps = casing.filter((F.col("noninitial_count") >= min_evidence) & (F.col("cap_ratio") >= max_cap)).select(F.col("tok").alias("glued"))
    return rows.join(caps, "glued", "left_anti")


def next_word_class(form: str = "form", nxt: str = "next") -> Column:
    """ser, ir or ? for a shared past form, from the word after it."""
    w = F.col(nxt)
    return (
        F.when(w.isNull() | (w == ""), "?")
        .when(w.isin("embora", "buscar", "para", "até", "lá", "ali", "aí", "ter", "ver"), "ir")
        .when(F.regexp_like(w, F.lit("(ar|er|ir)$")) & (F.length(w) > 3), "ir")
        .when(F.regexp_like(w, F.lit("(ado|ada|ados|adas|ido|ida|idos|idas)$")) | w.isin("um", "uma", "o", "muito", "tão", "por", "isso", "quem", "que"), "ser")
        .otherwise("?")
    )
