"""Counts over lines: words, casing, adjacent pairs, collocations and example contexts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def lines_of(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, *keep, line_no, line): the lines of documents, counted from 0."""
    return docs.select("doc_id", *keep, F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def unigrams(lines: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, tok, count) over lower-cased lines; summed in every task before the shuffle."""
    return lines.select(*by, F.explode(T.tokens(F.lower("line"))).alias("tok")).groupBy(*by, "tok").agg(F.count("*").alias("count"))


def totals(lines: DataFrame, counts: DataFrame) -> DataFrame:
    """One row: lines, tokens, types."""
    return lines.agg(F.count("*").alias("lines")).crossJoin(counts.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("tokens"), F.count("*").alias("types")))


def casing(lines: DataFrame) -> DataFrame:
    """(tok, cap_count, noninitial_count, cap_ratio): capitals among the tokens that don't begin their line."""
    toks = lines.select(F.posexplode(T.tokens("line")).alias("p", "raw")).filter("p > 0")
    out = toks.groupBy(F.lower("raw").alias("tok")).agg(F.count_if(F.regexp_like("raw", F.lit(r"^\p{Lu}"))).alias("cap_count"), F.count("*").alias("noninitial_count"))
    return out.withColumn("cap_ratio", F.coalesce(F.col("cap_count") / F.nullif(F.col("noninitial_count"), F.lit(0)), F.lit(0.0)))


def vocabulary(counts: DataFrame, floor: int) -> DataFrame:
    return counts.filter(F.col("count") >= floor)


def bigrams(lines: DataFrame, vocab: DataFrame | None = None) -> DataFrame:
    """(left, right, count) of neighbours within a line; with vocab (tok), both must be in it and others part their neighbours."""
    toks = lines.select(T.tokens(F.lower("line")).alias("t")).withColumn("n", F.greatest(F.size("t") - 1, F.lit(0)))
    rows = toks.select(F.inline(F.arrays_zip(F.slice("t", 1, F.col("n")), F.slice("t", 2, F.col("n")))).alias("left", "right"))
    out = rows.groupBy("left", "right").agg(F.count("*").alias("count"))
    if vocab is not None:
        for side in ("left", "right"):
            out = out.join(vocab.select(F.col("tok").alias(side)), side, "left_semi")
    return out.select("left", "right", "count")


def sides(lines: DataFrame) -> DataFrame:
    """(tok, count, n_left, n_right): unigrams with the pairs that begin and that end with the word."""
    # Of a slice, as Spark would look for empty arrays before it explodes a column, and so make the tokens twice.
    toks = lines.select(T.tokens(F.lower("line")).alias("t")).withColumn("n", F.size("t")).select("n", F.posexplode(F.slice("t", 1, F.col("n"))).alias("p", "tok")).filter("tok is not null")
    out = toks.groupBy("tok").agg(F.count("*").alias("count"), F.count_if(F.col("p") < F.col("n") - 1).alias("n_left"), F.count_if(F.col("p") > 0).alias("n_right"))
    # Always true, as is the filter above. They name all columns, so that every use of them reads one shuffle, not one of its own columns each.
    return out.filter(F.col("n_left") + F.col("n_right") <= 2 * F.col("count"))


def _all_pairs(words: DataFrame) -> DataFrame:
    """One row: n, the pairs of all lines, of sides."""
    return F.broadcast(words.agg(F.sum("n_left").alias("n")))


def _of_words(pairs: DataFrame, words: DataFrame, *columns: str) -> DataFrame:
    """pairs with columns of both words: count as c_left and c_right, n_left and n_right of the word on that side. Pairs are not sorted for it."""
    for side in ("left", "right"):
        named = {"c": F.col("count").alias(f"c_{side}"), "n": F.col(f"n_{side}")} if "n" in columns else {"c": F.col("count").alias(f"c_{side}")}
        pairs = pairs.join(words.select(F.col("tok").alias(side), *(named[c] for c in columns)).hint("shuffle_hash"), side, "left")
    return pairs


def marginals(pairs: DataFrame, words: DataFrame | None = None) -> DataFrame:
    """Pairs with n_left, n_right (pairs that begin or end so) and n (all), summed over pairs, or taken from words (sides of the lines) if pairs are all of the lines' or some of them."""
    if words is not None:
        return _of_words(pairs, words, "n").crossJoin(_all_pairs(words))
    left = pairs.groupBy("left").agg(F.sum("count").alias("n_left"))
    right = pairs.groupBy("right").agg(F.sum("count").alias("n_right"))
    return pairs.join(left, "left").join(right, "right").crossJoin(F.broadcast(pairs.agg(F.sum("count").alias("n"))))


def dunning(k11: str = "count", left: str = "n_left", right: str = "n_right", n: str = "n") -> Column:
    """Log-likelihood of a 2 x 2 table given by its corner and margins; 0 if a cell is negative."""
    a, r, c, t = (F.col(x).cast("double") for x in (k11, left, right, n))
    b, d = r - a, c - a
    e = t - r - d
    term = lambda o, x, y: F.when(o > 0, o * F.ln(o * t / (x * y))).otherwise(0.0)
    g = 2 * (term(a, r, c) + term(b, r, t - c) + term(d, t - r, c) + term(e, t - r, t - c))
    return F.when((a < 0) | (b < 0) | (d < 0) | (e < 0), 0.0).otherwise(g)


def _share(rows: DataFrame, denominator: str) -> DataFrame:
    for side in ("left", "right"):
        rows = rows.withColumn(f"c_{side}", F.coalesce(f"c_{side}", F.lit(1)))
    base = {"max": F.greatest("c_left", "c_right"), "min": F.least("c_left", "c_right"), "left": F.col("c_left"), "right": F.col("c_right")}[denominator]
    return rows.withColumn("share", F.col("count") / base)


def shares(pairs: DataFrame, counts: DataFrame, denominator: str = "max") -> DataFrame:
    """Pairs with share (of the max, min, left or right word's count; a word without count has 1)."""
    return _share(_of_words(pairs, counts, "c"), denominator)


def collocations(pairs: DataFrame, counts: DataFrame, denominator: str = "max") -> DataFrame:
    """Pairs with g2 and share."""
    return shares(marginals(pairs), counts, denominator).withColumn("g2", dunning())


def strong_collocations(pairs: DataFrame, words: DataFrame, min_g2: float, min_share: float) -> DataFrame:
    """collocations of pairs of whole lines, with words (sides of the lines); of pairs below both limits only some.

    Words of a pair of a lines with a share of min_share (of the max) are in at most a / min_share pairs each. So if a is below min_share^2 n, the pair is
    commoner than by chance, its g2 falls with either word's pairs, and it is at most that of words in no other pair, below 2 a (ln(n / a) + 1). Pairs whose
    count alone keeps them from min_g2 so don't meet their words at all.
    """
    a, n = F.col("count").cast("double"), F.col("n").cast("double")
    near = (a >= 0.99 * min_share * min_share * n) | (2 * a * (F.ln(n / a) + 1) >= 0.999 * min_g2)
    return _share(_of_words(pairs.crossJoin(_all_pairs(words)).filter(near), words, "c", "n"), "max").withColumn("g2", dunning())


def retained(scored: DataFrame, known: DataFrame | None = None, min_g2: float = 2500, min_share: float = 0.05) -> DataFrame:
    """Multi-word expressions: pairs strong enough whose words are both known (tok)."""
    out = scored.filter((F.col("g2") >= min_g2) & (F.col("share") >= min_share))
    if known is not None:
        for side in ("left", "right"):
            out = out.join(known.select(F.col("tok").alias(side)), side, "left_semi")
    return out.select(F.concat_ws(" ", "left", "right").alias("mwe"), "left", "right", F.col("count").alias("raw_freq"), "g2", "share")


# So many words of more than the least size are broadcast at most.
BROADCAST_WORDS = 200_000


def contexts(lines: DataFrame, words: DataFrame | int) -> DataFrame:
    """(tok, k, digest, line): for each tok of words (tok, size), or of all words if words is a size, the lines with the smallest digests, a line once a word.

    A word goes with its digest and a hash of its line. Every task keeps no more of a word than its size before any are shuffled: words of more than the
    least size and the others are limited apart, or all by the largest size where the former are too many to broadcast. Lines meet the hashes that are
    left; the digest is made again then, so lines that share a hash are told apart.
    """
    toks = lines.select("line", F.explode(F.array_distinct(T.tokens(F.lower("line")))).alias("tok"))
    order = Window.partitionBy("tok").orderBy("digest", "at")

    def first(rows: DataFrame, n: int) -> DataFrame:
        found = rows.select("tok", F.unhex(T.digest("tok", "line")).alias("digest"), F.xxhash64("line").alias("at"))
        found = found.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= n)
        return found if isinstance(words, int) else found.join(words, "tok").filter("k <= size").select("tok", "digest", "at", "k")

    sizes = {words: 0} if isinstance(words, int) else dict(words.filter("size > 0").groupBy("size").count().collect())
    least, most = min(sizes, default=0), max(sizes, default=0)
    if least < most and sum(n for size, n in sizes.items() if size > least) <= BROADCAST_WORDS:
        larger = F.broadcast(words.filter(F.col("size") > least).select("tok"))
        kept = first(toks.join(larger, "tok", "left_semi"), most).union(first(toks.join(larger, "tok", "left_anti"), least))
    else:
        kept = first(toks, most)
    texts = lines.filter("line != ''").groupBy(F.xxhash64("line").alias("at")).agg(F.collect_set("line").alias("same")).select("at", F.explode("same").alias("line"))
    return kept.join(texts, "at").filter(F.col("digest") == F.unhex(T.digest("tok", "line"))).select("tok", "k", F.lower(F.hex("digest")).alias("digest"), "line")


def per_million(counts: DataFrame, total: DataFrame) -> DataFrame:
    """counts with freq_per_million of total (one row, tokens)."""
    return counts.crossJoin(F.broadcast(total.select("tokens"))).withColumn("freq_per_million", F.round(F.col("count") * 1e6 / F.col("tokens"), 3)).drop("tokens")


def ranked(counts: DataFrame, limit: int, keys: tuple[str, ...] = ("tok",)) -> DataFrame:
    """The first limit rows by count and keys, with their rank. Ranks are given to these rows alone, so no task sorts everything."""
    order = [F.desc("count"), *keys]
    return counts.orderBy(*order).limit(limit).withColumn("rank", F.row_number().over(Window.orderBy(*order)))
