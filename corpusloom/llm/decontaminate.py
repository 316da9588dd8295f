"""Benchmark decontamination by winnowing, in DataFrame operations only."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, table, unused

#: Words a window, words a fingerprinted k-gram, and items that make a document contaminated.
WINDOW, GRAM, ITEMS = 8, 4, 2
#: Rows and bytes of benchmark windows up to which they are broadcast; beyond, the joins shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 32 << 20
#: What lies between words: ASCII other than digits and letters.
GAP, GAP_LOWER = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text) -> Column:
    """Words of a text, A-Z lower-cased; null for a null text."""
    return F.array_remove(F.split(ascii_lower(text), GAP_LOWER), "")


def _whole_grams(m: int) -> Column:
    """The fingerprints of windows of m words, which are grams themselves, by the words' hashes h."""
    mark = lambda i: F.struct(F.lit(m).alias("size"), i.alias("at"), F.xxhash64(*(F.get(F.col("h"), i + j) for j in range(m)), F.lit(-m)).alias("fp"))
    return F.when(F.size("h") >= m, F.transform(F.sequence(F.lit(0), F.size("h") - m), mark))


def selected(rows: DataFrame, sizes: list[int]) -> DataFrame:
    """rows with words w exploded to their fingerprints (size, at, fp): the hash of a k-gram that begins at word at.

    For windows of WINDOW words, a GRAM-gram is kept if its hash is the smallest of some window it is in (all of equals are), so a run of windows with the same smallest gram
    has one fingerprint and windows of equal words have equal ones. Windows of fewer words are grams themselves.
    """
    rows = rows.withColumn("h", F.transform("w", lambda x: F.xxhash64(x)))
    parts = []
    if WINDOW in sizes:
        hashes = F.transform(F.sequence(F.lit(0), F.size("h") - GRAM), lambda i: F.xxhash64(*(F.get(F.col("h"), i + j) for j in range(GRAM))))
        # no filter here: Spark would push it, and all that the array is made of, below the projections and make it twice
        rows = rows.withColumn("grams", F.when(F.size("w") >= WINDOW, hashes))
        n = WINDOW - GRAM + 1
        least = F.transform(F.sequence(F.lit(0), F.size("grams") - n), lambda i: F.least(*(F.get(F.col("grams"), i + j) for j in range(n))))
        rows = rows.withColumn("least", F.when(F.col("grams").isNotNull(), least))
        chosen = F.filter(F.sequence(F.lit(0), F.size("grams") - 1), lambda i: F.get(F.col("grams"), i) == F.greatest(*(F.get(F.col("least"), i - j) for j in range(n))))
        parts.append(F.when(F.col("grams").isNotNull(), F.transform(chosen, lambda i: F.struct(F.lit(WINDOW).alias("size"), i.alias("at"), F.get(F.col("grams"), i).alias("fp")))))
    parts += [_whole_grams(m) for m in sizes if m < WINDOW]
    none = F.array().cast("array<struct<size:int,at:int,fp:bigint>>")
    found = F.concat(*(F.coalesce(x, none) for x in parts)) if len(parts) > 1 else parts[0]
    drop = [c for c in ("h", "grams", "least") if c in rows.columns]
    # the outer form: for the other one Spark infers a filter and makes the array for it again
    return rows.withColumn("found", found).drop(*drop).select(*[c for c in rows.columns if c not in drop], F.inline_outer("found"))


def _around() -> tuple[Column, Column, Column]:
    """Words before a fingerprint (the nearest first), its own, and those after it, as far as a window that holds it can reach."""
    reach, at = WINDOW - GRAM, F.col("at")
    k = F.when(F.col("size") == WINDOW, GRAM).otherwise(F.col("size"))
    whole = F.col("size") == WINDOW
    none = F.array().cast("array<string>")
    before = F.when(whole, F.reverse(F.slice("w", F.greatest(at - reach, F.lit(0)) + 1, F.least(at, F.lit(reach))))).otherwise(none)
    return before, F.slice("w", at + 1, k), F.when(whole, F.slice("w", at + 1 + k, reach)).otherwise(none)


def item_fingerprints(benchmark: DataFrame) -> DataFrame:
    """(size, fp, before, gram, after, items): the distinct fingerprints of all items in their surroundings, each with the items that have it."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("w")).filter("item is not null and size(w) > 0").distinct()
    items = items.withColumn("m", F.least(F.size("w"), F.lit(WINDOW)))
    found = selected(items, list(range(1, WINDOW + 1))).filter("size = m")
    before, gram, after = _around()
    return found.select("item", "size", "fp", before.alias("before"), gram.alias("gram"), after.alias("after")).groupBy("size", "fp", "before", "gram", "after").agg(F.collect_set("item").alias("items"))


def _common(a: str, b: str) -> Column:
    """How many of the first words of two arrays are equal, at most what a window can reach."""
    out = F.lit(0)
    for j in range(WINDOW - GRAM - 1, -1, -1):
        out = F.when(F.get(F.col(a), F.lit(j)) == F.get(F.col(b), F.lit(j)), out + 1).otherwise(0)
    return out


def extended(met: DataFrame, key: list[str]) -> DataFrame:
    """key, at, size and items of the fingerprints of docs (w, at) that meet those of items: hits extended to both sides while words are equal, if they reach a window."""
    b, g, a = _around()
    met = met.withColumn("b", b).withColumn("g", g).withColumn("a", a).filter("g = gram").withColumn("l", _common("b", "before")).withColumn("r", _common("a", "after"))
    return met.filter(F.col("l") + F.size("gram") + F.col("r") >= F.col("size")).select(*key, (F.col("at") - F.col("l")).alias("at"), (F.col("l") + F.size("gram") + F.col("r")).alias("size"), "items")


def hits(docs: DataFrame, benchmark: DataFrame, key: list[str], broadcast_rows: int = BROADCAST_ROWS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """key, spans (sorted distinct structs at, size: runs of hit windows) and items (sorted item ids as strings) of the docs that have hits.

    Fingerprints of documents meet those of the benchmark; from there a hit is extended to the left and right as long as words are equal.
    """
    own = item_fingerprints(benchmark)
    weight = F.sum(16 * F.size("items") + F.length(F.array_join(F.concat("before", "gram", "after"), " ")) + 80)
    sizes = own.groupBy("size").agg(F.count("*").alias("n"), weight.alias("b")).collect()
    rows = docs.select(*key, words(F.col("text")).alias("w"))
    if not sizes:
        return docs.select(*key, F.array(F.struct(F.lit(0).alias("at"), F.lit(0).alias("size"))).alias("spans"), F.array(F.lit("")).alias("items")).limit(0)
    some = sorted(r["size"] for r in sizes)
    if sum(r.n for r in sizes) <= broadcast_rows and sum(r.b for r in sizes) <= broadcast_bytes:
        found = extended(selected(rows, some).join(F.broadcast(own), ["size", "fp"]), key)
    else:
        met = selected(rows, some).select(*key, "size", "at", "fp").join(own.select("size", "fp").distinct(), ["size", "fp"], "left_semi")
        met = met.groupBy(*key).agg(F.collect_set(F.struct("size", "at", "fp")).alias("starts")).withColumnsRenamed({k: f"_{k}_met" for k in key})
        same = reduce(operator.and_, (F.col(k).eqNullSafe(F.col(f"_{k}_met")) for k in key))
        near = rows.join(met, same).select(*key, "w", F.inline("starts"))
        before, gram, after = _around()
        # the words a window can reach go on, not the document's
        near = near.select(*key, "size", "fp", F.col("at").alias("place"), F.size(before).alias("at"), F.concat(F.reverse(before), gram, after).alias("w"))
        found = extended(near.join(own, ["size", "fp"]).withColumn("shift", F.col("place") - F.col("at")), [*key, "shift"])
        found = found.withColumn("at", F.col("at") + F.col("shift")).drop("shift")
    return found.groupBy(*key).agg(F.sort_array(F.collect_set(F.struct("at", "size"))).alias("spans"), F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))


def covered(spans: str = "spans") -> Column:
    """Words covered by sorted spans."""
    step = lambda acc, s: F.struct((acc["n"] + F.greatest(F.lit(0), s["at"] + s["size"] - F.greatest(acc["end"], s["at"]))).cast("long").alias("n"), F.greatest(acc["end"], s["at"] + s["size"]).alias("end"))
    return F.aggregate(spans, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")), step, lambda acc: acc["n"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, **bounds) -> DataFrame:
    """For every row of docs (doc_id, text): doc_id, n_words, n_hit, n_items, items, spans, contaminated.

    A null or wordless text has no words and no hits; null item texts are no items, equal rows of the benchmark count once, an empty benchmark hits
    nothing and an empty docs gives no rows. Rows are told apart by doc_id and text, so repeated rows each get the same result. Other
    columns are ignored.
    """
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    found = hits(rows.filter("text is not null"), benchmark, ["doc_id", "text_hash"], **bounds).withColumnsRenamed({"doc_id": "hit_id", "text_hash": "hit_hash"})
    n = F.coalesce(F.size(F.array_remove(F.split("text", GAP), "")), F.lit(0))
    all_rows = rows.select("doc_id", "text_hash", F.when(F.col("text").isNull(), 0).otherwise(n).cast("long").alias("n_words"))
    out = all_rows.join(found, F.expr("doc_id <=> hit_id and text_hash = hit_hash"), "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return out.select("doc_id", "text_hash", "n_words", F.coalesce(covered(), F.lit(0).cast("long")).alias("n_hit"), F.size(items).cast("long").alias("n_items"), items.alias("items"), "spans", (F.size(items) >= ITEMS).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, **bounds) -> DataFrame:
    """docs, all columns as they are, without the rows that have a window of WINDOW words of a benchmark item, a whole item of
    GRAM words or more, or ITEMS items of any length.

    All items are searched for, but one shorter item alone leaves a row: one of a single common word would take most rows with it.
    """
    key = [unused("_doc", docs.columns), unused("_hash", docs.columns)]
    rows = docs.select(F.col("doc_id").alias(key[0]), F.xxhash64("text").alias(key[1]), "text").filter("text is not null")
    found = hits(rows, benchmark, key, **bounds)
    gone = found.filter(F.exists("spans", lambda s: s["size"] >= GRAM) | (F.size("items") >= ITEMS)).select(*key)
    return docs.join(gone, (F.col("doc_id").eqNullSafe(F.col(key[0]))) & (F.xxhash64("text") == F.col(key[1])), "left_anti")


def op1_decontaminate(spark, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


#: Fixed values of the contract as DuckDB reads them.
SQL = r"""
with words as (
  select doc_id as id, false as item, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from documents
  union all
  select item_id, true, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') from benchmark
), sizes as (
  select distinct least(8, len(w)) as m from words where item and len(w) > 0
), spots as (
  select id, item, w, m, unnest(range(0, len(w) - m + 1)) as pos from words, sizes where len(w) >= m and (not item or m = least(8, len(w)))
), windows as (
  select id, item, m, pos, array_to_string(w[pos + 1 : pos + m], ' ') as win from spots
), met as (
  select d.id as doc_id, d.pos, d.m, i.id as item_id from windows d join windows i on d.win = i.win and d.m = i.m where not d.item and i.item
), hit as (
  select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(pos, pos + m)) as p from met) group by doc_id
), items as (
  select doc_id, count(distinct item_id) as n_items, sha256(string_agg(distinct item_id::varchar, ',' order by item_id::varchar)) as s from met group by doc_id
)
select d.id as doc_id, coalesce(len(d.w), 0)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  coalesce(s, sha256('')) as items_sha256, coalesce(n_items, 0) >= 2 as contaminated
from words d left join hit on hit.doc_id = d.id left join items on items.doc_id = d.id where not d.item
"""
