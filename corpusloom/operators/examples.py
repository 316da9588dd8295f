"""Example sentences, samples, replies and gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def tier(line: str = "line", low: int = 4, high: int = 15) -> Column:
    """How good a line is: 1 of fitting length and clean, 2 clean, 3 any."""
    n = F.size(T.tokens(F.col(line)))
    plain = ~T.all_caps(F.col(line)) & ~T.edge_ellipsis(F.col(line))
    return F.when(n.between(low, high) & plain, 1).when(plain, 2).otherwise(3)


def name_shares(lines: DataFrame, known: DataFrame, key: list[str]) -> DataFrame:
    """(key, line, name_share): capitalised unknown words after the first, over all words of the line."""
    words = lines.select(*key, "line", F.posexplode_outer(F.array_remove(F.split(F.trim("line"), r"\s+"), "")).alias("_p", "_w"))
    bare = F.regexp_replace("_w", r"""^[«»"'()\[\]¿?!.,:;–—…-]+|[«»"'()\[\]¿?!.,:;–—…-]+$""", "")
    rows = words.withColumn("_bare", bare).join(known.select(F.col("tok").alias("_low"), F.lit(True).alias("_known")).distinct(), F.lower("_bare") == F.col("_low"), "left")
    name = (F.col("_p") > 0) & F.regexp_like("_bare", F.lit(r"^\p{Lu}")) & F.col("_known").isNull()
    return rows.groupBy(*key, "line").agg((F.count_if(name) / F.greatest(F.count("_w"), F.lit(1))).alias("name_share"))


def choose(candidates: DataFrame, key: str, n: int = 20) -> DataFrame:
    """Up to n lines a key from its best tier, the shortest first, a line once."""
    rows = candidates.select(key, "line").distinct().withColumn("tier", tier())
    rows = rows.withColumn("_best", F.min("tier").over(Window.partitionBy(key))).filter("tier = _best")
    order = Window.partitionBy(key).orderBy(F.size(T.tokens(F.col("line"))), F.length("line"), "line")
    return rows.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= n).select(key, "tier", "k", "line")


def contains_phrase(line: str, phrase: Column) -> Column:
    """Whether the words of phrase stand side by side in the line."""
    return F.concat(F.lit(" "), F.array_join(T.tokens(F.lower(line)), " "), F.lit(" ")).contains(F.concat(F.lit(" "), phrase, F.lit(" ")))


def rescue(missing: DataFrame, lines: DataFrame, n: int = 5) -> DataFrame:
    """(entry, k, line) for entries (entry, of one word or more) without example, from all lines: by their first word, then the whole."""
    first = F.element_at(F.split("entry", " "), 1)
    toks = lines.select("line", F.explode(F.array_distinct(T.tokens(F.lower("line")))).alias("_w"))
    rows = toks.join(missing.select("entry", first.alias("_w")), "_w").filter(contains_phrase("line", F.col("entry")))
    order = Window.partitionBy("entry").orderBy(T.digest("entry", "line"), "line")
    return rows.select("entry", "line").distinct().withColumn("k", F.row_number().over(order)).filter(F.col("k") <= n).select("entry", "k", "line")


def strata_sample(rows: DataFrame, stratum: str, key: str, quotas: dict, default: int = 0) -> DataFrame:
    """As many rows of each stratum as its quota, those with the smallest digests."""
    quota = F.coalesce(F.create_map(*(F.lit(x) for kv in quotas.items() for x in kv))[F.col(stratum)], F.lit(default)) if quotas else F.lit(default)
    order = Window.partitionBy(stratum).orderBy(T.digest(F.col(stratum).cast("string"), F.col(key).cast("string")), key)
    return rows.withColumn("_k", F.row_number().over(order)).filter(F.col("_k") <= quota).drop("_k")


def even_spread(ranked: DataFrame, whole: int, bands: int, per_band: int, last: int) -> DataFrame:
    """All ranks up to whole and per_band rows of each of bands equal bands up to last."""
    width = -(-(last - whole) // bands)
    band = F.when(F.col("rank") <= whole, 0).otherwise(F.floor((F.col("rank") - whole - 1) / width) + 1)
    order = Window.partitionBy("band").orderBy(T.digest(F.col("rank").cast("string")), "rank")
    rows = ranked.filter(F.col("rank") <= last).withColumn("band", band.cast("long")).withColumn("_k", F.row_number().over(order))
    return rows.filter((F.col("band") == 0) | (F.col("_k") <= per_band)).drop("_k")


REPLY = "struct<gloss:string, example_pt:string, example_en:string, flags:array<string>>"


def parse_replies(replies: DataFrame) -> DataFrame:
    """replies (text, stop) with the fields of their JSON and problem: refused, truncated, bad_json or null."""
    r = F.from_json("text", REPLY)
    rows = replies.withColumn("_r", r)
    problem = F.when(F.col("stop") == "refusal", "refused").when(F.col("stop") == "max_tokens", "truncated").when(F.col("_r.gloss").isNull(), "bad_json")
    return rows.select("*", F.col("_r.gloss").alias("gloss"), F.col("_r.example_pt").alias("example_pt"), F.col("_r.example_en").alias("example_en"), F.coalesce("_r.flags", F.array().cast("array<string>")).alias("flags"), problem.alias("problem")).drop("_r")


def repair(rows: DataFrame, offered: DataFrame, key: str) -> DataFrame:
    """rows with example_pt set to the offered line (key, line) that is the same once tidied, or emptied with repaired = dropped."""
    lines = offered.select(key, F.col("line").alias("_line"), T.squeeze(T.tidy(F.col("line"))).alias("_tidy")).groupBy(key, "_tidy").agg(F.min("_line").alias("_line"))
    out = rows.withColumn("_tidy", T.squeeze(T.tidy(F.col("example_pt")))).join(lines, [key, "_tidy"], "left")
    state = F.when(F.coalesce("example_pt", F.lit("")) == "", "none").when(F.col("_line").isNull(), "dropped").when(F.col("_line") != F.col("example_pt"), "anchored").otherwise("same")
    return out.withColumn("repaired", state).withColumn("example_pt", F.coalesce("_line", F.lit(""))).drop("_line", "_tidy")


def overridden(rows: DataFrame, overrides: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """rows with the fields of overrides that are not empty."""
    other = overrides.select(*keys, *(F.col(f).alias(f"_{f}") for f in fields))
    out = rows.join(other, keys, "left")
    return out.select(*(F.coalesce(F.nullif(F.trim(f"_{c}"), F.lit("")), F.col(c)).alias(c) if c in fields else F.col(c) for c in rows.columns))


def unmatched(overrides: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Overrides without a row: an error for the caller."""
    return overrides.join(rows.select(*keys).distinct(), keys, "left_anti")


# Gates that fail a build wherever they are hit.
FATAL = ("coverage", "verbatim", "translated", "known_flags", "unique", "contains_entry")


def gates(published: DataFrame, glosses: DataFrame, offered: DataFrame, flags: tuple[str, ...]) -> DataFrame:
    """(gate, lemma, pos, detail): hits of the gates over glosses (lemma, pos, gloss, example_pt, example_en, flags)."""
    key = ["lemma", "pos"]
    hit = lambda df, gate, detail: df.select(F.lit(gate).alias("gate"), *key, detail.cast("string").alias("detail"))
    example = F.coalesce("example_pt", F.lit("")) != ""
    empty = F.lit("")
    parts = [
        hit(published.join(glosses.select(*key).distinct(), key, "left_anti"), "coverage", empty),
        hit(glosses.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1"), "unique", F.col("n")),
        hit(glosses.filter(example).join(offered.select("lemma", F.col("line").alias("example_pt")).distinct(), ["lemma", "example_pt"], "left_anti"), "verbatim", F.col("example_pt")),
        hit(glosses.filter(example & (F.coalesce("example_en", empty) == "")), "translated", F.col("example_pt")),
        hit(glosses.filter(example & ~contains_phrase("example_pt", F.col("lemma"))), "contains_entry", F.col("example_pt")),
        hit(glosses.select(*key, F.explode("flags").alias("f")).filter(~F.col("f").isin(*flags)), "known_flags", F.col("f")),
        hit(glosses.filter(F.coalesce("gloss", empty) == ""), "missing_gloss", empty),
        hit(glosses.filter(~example), "missing_example", empty),
        hit(glosses.filter(F.size(F.split("gloss", ";")) > 3), "many_senses", F.col("gloss")),
        hit(glosses.filter(F.size(F.split("gloss", r"\s+")) > 8), "long_gloss", F.col("gloss")),
        hit(glosses.filter(F.lower("gloss") == F.col("lemma")), "same_as_entry", F.col("gloss")),
        hit(glosses.filter(F.regexp_like("gloss", F.lit(r"[.!?]$"))), "ends_in_mark", F.col("gloss")),
        hit(glosses.filter(F.regexp_like("gloss", F.lit(r"^\p{Lu}"))), "capital", F.col("gloss")),
        hit(glosses.filter(example & T.all_caps(F.col("example_pt"))), "all_caps", F.col("example_pt")),
        hit(glosses.filter(example & T.edge_ellipsis(F.col("example_pt"))), "ellipsis", F.col("example_pt")),
        hit(glosses.filter(example & (F.size(T.tokens(F.col("example_pt"))) > 15)), "long_example", F.col("example_pt")),
        hit(glosses.filter(example & (F.size(T.tokens(F.col("example_pt"))) < 4)), "short_example", F.col("example_pt")),
        hit(glosses.filter(example & (F.col("example_pt") == F.col("example_en"))), "untranslated", F.col("example_pt")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def failed(found: DataFrame, n_published: int, max_missing: float = 0.05) -> list[str]:
    """Names of the gates that fail: a hit of a fatal one, a missing gloss, or too many missing examples."""
    n = {r["gate"]: r["count"] for r in found.groupBy("gate").count().collect()}
    return sorted([g for g in (*FATAL, "missing_gloss") if n.get(g)] + (["missing_example"] if n.get("missing_example", 0) > max_missing * n_published else []))


def usage_cost(replies: DataFrame, prices: dict[str, float]) -> DataFrame:
    """One row: sums of token columns and their cost at prices a million tokens."""
    sums = replies.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in prices))
    cost = F.lit(0.0)
    for c, p in prices.items():
        cost = cost + F.col(c) * (p / 1e6)
    return sums.withColumn("cost", F.round(cost, 6))


def decks(entries: DataFrame, ranges: DataFrame) -> DataFrame:
    """entries (rank, ...) with the deck whose range (deck, low, high) has their rank."""
    return entries.join(F.broadcast(ranges), F.col("rank").between(F.col("low"), F.col("high")), "left").drop("low", "high")
