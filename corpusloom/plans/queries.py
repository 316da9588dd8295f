"""Queries over the test tables, each with its DuckDB SQL.

Stand-ins, the same on both sides: the dictionary is the vocabulary of benchmark, a document's language stands for the
reading of its words, even and odd doc_ids for an older and a newer corpus.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import counts as C
from ..operators import examples as E
from ..operators import filters as FL
from ..operators import lemmas as L
from ..operators import quality as Q
from ..operators import shares as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = f"with {BASE}\n{sql}" if "lines" in sql or "toks" in sql or "uni" in sql or "dict" in sql else sql
        return f

    return add


WORD_SQL = r"\p{L}+(?:[-''’]\p{L}+)*"
BASE = rf"""lines as materialized (select doc_id, lang, unnest(range(len(l))) as line_no, unnest(l) as line from (select doc_id, lang, string_split(text, chr(10)) as l from documents)),
toks as materialized (select doc_id, lang, line_no, unnest(range(1, len(t) + 1)) as p, unnest(t) as tok from (select doc_id, lang, line_no, regexp_extract_all(lower(line), '{WORD_SQL}') as t from lines)),
uni as materialized (select tok, count(*) as n from toks group by tok),
dict as materialized (select distinct unnest(regexp_extract_all(lower(text), '{WORD_SQL}')) as tok from benchmark),
bi as materialized (select a.tok as l, b.tok as r, count(*) as n from toks a join toks b on a.doc_id = b.doc_id and a.line_no = b.line_no and b.p = a.p + 1 group by all)"""


def docs(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet")


def lines(spark: SparkSession, d: str) -> DataFrame:
    return C.lines_of(docs(spark, d), ("lang",))


def uni(spark: SparkSession, d: str) -> DataFrame:
    return C.unigrams(lines(spark, d))


def known(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/benchmark.parquet").select(F.explode(T.tokens(F.lower("text"))).alias("tok")).distinct()


def votes(spark: SparkSession, d: str) -> DataFrame:
    """(tok, lang, votes): how often a word is read in each language."""
    return C.unigrams(lines(spark, d), ("lang",)).withColumnRenamed("count", "votes")


# -- counts -------------------------------------------------------------------------------------------------------------


@query("select tok, n as count from uni")
def unigram_counts(spark, d):
    return uni(spark, d)


@query("select (select count(*) from lines) as lines, (select sum(n)::bigint from uni) as tokens, (select count(*) from uni) as types")
def fingerprint(spark, d):
    return C.totals(lines(spark, d), uni(spark, d))


@query("select tok, n as count, rank, round(n * 1e6 / (select sum(n) from uni), 3) as freq_per_million from (select *, row_number() over (order by n desc, tok) as rank from uni) where rank <= 1000")
def top_tokens_ranked(spark, d):
    counts = uni(spark, d)
    top = C.ranked(counts, 1000).withColumn("rank", F.col("rank").cast("long"))
    return C.per_million(top, C.totals(lines(spark, d), counts))


@query("select band, count(*) as words, sum(n)::bigint as tokens from (select n, case when n * 1e6 / (select sum(n) from uni) >= 1000 then 'a' when n * 1e6 / (select sum(n) from uni) >= 100 then 'b' when n * 1e6 / (select sum(n) from uni) >= 10 then 'c' else 'd' end as band from uni) group by band")
def per_million_bands(spark, d):
    counts = uni(spark, d)
    f = F.col("count") * 1e6 / F.col("tokens")
    band = F.when(f >= 1000, "a").when(f >= 100, "b").when(f >= 10, "c").otherwise("d")
    return counts.crossJoin(F.broadcast(counts.agg(F.sum("count").alias("tokens")))).groupBy(band.alias("band")).agg(F.count("*").alias("words"), F.sum("count").alias("tokens"))


@query("select tok, rank, lpad((((rank - 1) // 500) * 500 + 1)::varchar, 4, '0') || '-' || lpad((((rank - 1) // 500) * 500 + 500)::varchar, 4, '0') as band, 'word band::' || lpad((((rank - 1) // 500) * 500 + 1)::varchar, 4, '0') || '-' || lpad((((rank - 1) // 500) * 500 + 500)::varchar, 4, '0') || ' pos::unk' as tags from (select tok, row_number() over (order by n desc, tok) as rank from uni) where rank <= 3000")
def band_tags(spark, d):
    top = C.ranked(uni(spark, d), 3000)
    return top.select("tok", F.col("rank").cast("long").alias("rank"), T.band_label(F.col("rank")).alias("band"), T.tag_string(F.col("rank"), F.lit("unk"), F.lit(False), ("word",)).alias("tags"))


@query("select tok, rank from (select tok, row_number() over (order by n desc, tok) as rank from uni) where rank <= 5000 and (rank - 1) % (4999 // 60) = 0")
def qc_stride_sample(spark, d):
    return C.ranked(uni(spark, d), 5000).filter((F.col("rank") - 1) % (4999 // 60) == 0).select("tok", F.col("rank").cast("long").alias("rank"))


@query(rf"select doc_id, line_no, unnest(regexp_extract_all(c, '{WORD_SQL}')) as tok from (select doc_id, line_no, lower(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(line, '<[^>]{{1,40}}>', ' ', 'g'), '\{{[^}}]{{1,40}}\}}', ' ', 'g'), '\[[^\]]{{1,60}}\]', ' ', 'g'), '\([^)]{{1,60}}\)', ' ', 'g'), '[♪♫♩ᴖ]', ' ', 'g'), '^\s*-+\s*', ' ', 'g')) as c from lines)")
def artifact_strip_tokens(spark, d):
    return lines(spark, d).select("doc_id", F.col("line_no").cast("long").alias("line_no"), F.explode(T.tokens(T.clean("line"))).alias("tok"))


@query("select doc_id, line_no, translate(line, '’ʼ', '''''') as line from lines where contains(line, '’') or contains(line, '''')")
def apostrophe_fold(spark, d):
    return lines(spark, d).filter(F.col("line").contains("’") | F.col("line").contains("'")).select("doc_id", F.col("line_no").cast("long").alias("line_no"), T.fold_apostrophes("line").alias("line"))


@query(rf"select tok, regexp_extract(tok, '{T.CLUSTER}', 1) as stem, regexp_extract(tok, '{T.CLUSTER}', 2) as clitics, regexp_extract(tok, '{T.CLUSTER}', 3) as infix from uni where contains(tok, '-')")
def enclitic_groups(spark, d):
    w = F.col("tok")
    return uni(spark, d).filter(w.contains("-")).select("tok", *(F.regexp_extract(w, T.CLUSTER, k).alias(n) for k, n in ((1, "stem"), (2, "clitics"), (3, "infix"))))


@query(rf"select tok, count(*) as n, count(*) filter (starts) as n_starts from (select doc_id, line_no, unnest(w) as tok, unnest(range(len(w))) = 0 or regexp_matches(unnest(g), '{T.SENTENCE_END}') as starts from (select doc_id, line_no, regexp_extract_all(lower(line), '([^\p{{L}}]*)({WORD_SQL})', 1) as g, regexp_extract_all(lower(line), '([^\p{{L}}]*)({WORD_SQL})', 2) as w from lines)) group by tok")
def sentence_start_flags(spark, d):
    rows = lines(spark, d).select(F.explode(T.tokens_with_starts(F.lower("line"))).alias("t"))
    return rows.groupBy(F.col("t.tok").alias("tok")).agg(F.count("*").alias("n"), F.count_if("t.starts").alias("n_starts"))


@query(rf"select lower(raw) as tok, count(*) filter (regexp_matches(raw, '^\p{{Lu}}')) as cap_count, count(*) as noninitial_count, count(*) filter (regexp_matches(raw, '^\p{{Lu}}')) / count(*) as cap_ratio from (select unnest(t) as raw, unnest(range(len(t))) as p from (select regexp_extract_all(line, '{WORD_SQL}') as t from lines)) where p > 0 group by 1")
def token_cap_ratio(spark, d):
    return C.casing(lines(spark, d))


@query("select l as left, r as right, n as count from bi, lines where false union all select l, r, n from bi")
def bigram_counts(spark, d):
    return C.bigrams(lines(spark, d))


@query("select l as left, r as right, n as count, sum(n) over (partition by l)::bigint as n_left, sum(n) over (partition by r)::bigint as n_right, sum(n) over ()::bigint as n from bi where (select count(*) from lines) > 0")
def bigram_marginals(spark, d):
    ls = lines(spark, d)
    return C.marginals(C.bigrams(ls), C.sides(ls))


@query("select l as left, r as right, n as count from bi where l in (select tok from uni where n >= 20) and r in (select tok from uni where n >= 20)")
def vocab_bigrams(spark, d):
    ls = lines(spark, d)
    return C.bigrams(ls, C.vocabulary(C.unigrams(ls), 20))


G2 = """m as (select l, r, n::double as a, sum(n) over (partition by l)::double as rr, sum(n) over (partition by r)::double as cc, sum(n) over ()::double as t from bi),
c as (select *, rr - a as b, cc - a as dd, t - rr - (cc - a) as e from m),
g as (select l, r, a::bigint as n, case when a < 0 or b < 0 or dd < 0 or e < 0 then 0 else 2 * (case when a > 0 then a * ln(a * t / (rr * cc)) else 0 end + case when b > 0 then b * ln(b * t / (rr * (t - cc))) else 0 end + case when dd > 0 then dd * ln(dd * t / ((t - rr) * cc)) else 0 end + case when e > 0 then e * ln(e * t / ((t - rr) * (t - cc))) else 0 end) end as g2 from c)"""


def dunning_g2(spark, d):
    ls = lines(spark, d)
    rows = C.marginals(C.bigrams(ls).filter("count >= 3"), C.sides(ls))
    return rows.select("left", "right", F.round(C.dunning(), 4).alias("g2"))


QUERIES["dunning_g2"] = dunning_g2
SQL["dunning_g2"] = f"with {BASE}, {G2} select l as left, r as right, round(g2, 4) as g2 from g where n >= 3"

for _kind, _expr in (("min", "least(a.n, b.n)"), ("max", "greatest(a.n, b.n)"), ("left", "a.n"), ("right", "b.n")):

    def _share(spark, d, kind=_kind):
        ls = lines(spark, d)
        return C.shares(C.bigrams(ls).filter("count >= 2"), C.unigrams(ls), kind).select("left", "right", F.round("share", 9).alias("share"))

    QUERIES[f"collocation_share_{_kind}"] = _share
    SQL[f"collocation_share_{_kind}"] = f"with {BASE} select l as left, r as right, round(bi.n / {_expr}, 9) as share from bi join uni a on a.tok = l join uni b on b.tok = r where bi.n >= 2"


def mwe_retained(spark, d):
    ls = lines(spark, d)
    kept = C.retained(C.strong_collocations(C.bigrams(ls), C.sides(ls), 60, 0.05), None, 60, 0.05)
    return kept.select("mwe", "raw_freq", F.round("g2", 4).alias("g2"), F.round("share", 9).alias("share"))


QUERIES["mwe_retained"] = mwe_retained
SQL["mwe_retained"] = f"with {BASE}, {G2} select l || ' ' || r as mwe, g.n as raw_freq, round(g2, 4) as g2, round(g.n / greatest(a.n, b.n), 9) as share from g join uni a on a.tok = l join uni b on b.tok = r where g2 >= 60 and g.n / greatest(a.n, b.n) >= 0.05"


@query("select tok, k, digest, line from (select tok, line, digest, row_number() over (partition by tok order by digest, line) as k from (select distinct tok, doc_id, line_no, line, md5(tok || chr(31) || line) as digest from toks join lines using (doc_id, line_no))) where k <= 5")
def context_bottom_k(spark, d):
    return C.contexts(lines(spark, d), 5).withColumn("k", F.col("k").cast("long"))


@query("select tok, k, digest, line from (select tok, line, digest, row_number() over (partition by tok order by digest, line) as k from (select distinct tok, doc_id, line_no, line, md5(tok || chr(31) || line) as digest from toks join lines using (doc_id, line_no))) join uni using (tok) where k <= case when n >= 500 then 50 else 5 end and n >= 20")
def context_two_tier_k(spark, d):
    ls = lines(spark, d)
    words = C.vocabulary(C.unigrams(ls), 20).select("tok", F.when(F.col("count") >= 500, 50).otherwise(5).alias("size"))
    return C.contexts(ls, words).withColumn("k", F.col("k").cast("long"))


@query("select tok, n as count from uni where n >= 100")
def vocab_floor(spark, d):
    return C.vocabulary(uni(spark, d), 100)


@query("select tok, n as count, n >= 1000 as big from uni order by n desc, tok limit 2000")
def top_types_limit(spark, d):
    return uni(spark, d).orderBy(F.desc("count"), "tok").limit(2000).withColumn("big", F.col("count") >= 1000)


@query("select doc_id, line_no, line from lines order by doc_id, line_no limit 1000")
def prefix_lines(spark, d):
    """The first lines of the corpus in the order of documents; the prefix is the feature."""
    return lines(spark, d).orderBy("doc_id", "line_no").limit(1000).select("doc_id", F.col("line_no").cast("long").alias("line_no"), "line")


# -- dictionary, lemmas and votes ---------------------------------------------------------------------------------------


@query("select tok, n as count from uni semi join dict using (tok)")
def dictionary_semi(spark, d):
    return uni(spark, d).join(known(spark, d), "tok", "left_semi")


@query("select tok, n as count from uni anti join dict using (tok)")
def dictionary_anti(spark, d):
    return uni(spark, d).join(known(spark, d), "tok", "left_anti")


def primary(counts: DataFrame) -> DataFrame:
    """A stand-in lemmatizer: words in ed, es and s lose their ending."""
    w = F.col("tok")
    return counts.select("tok", F.regexp_replace(w, "(ed|es|s)$", "").alias("lemma")).withColumn("lemma", F.when(F.col("lemma") == "", w).otherwise(F.col("lemma")))


def fallback(counts: DataFrame) -> DataFrame:
    w = F.col("tok")
    return counts.select("tok", F.when(F.length(w) > 4, F.regexp_replace(w, "s$", "")).otherwise(w).alias("lemma"))


P = "pri as (select tok, case when regexp_replace(tok, '(ed|es|s)$', '') = '' then tok else regexp_replace(tok, '(ed|es|s)$', '') end as lemma from uni), fal as (select tok, case when length(tok) > 4 then regexp_replace(tok, 's$', '') else tok end as lemma from uni)"


def dictionary_gate(spark, d):
    c = uni(spark, d)
    return L.dictionary_gate(primary(c), fallback(c), known(spark, d))


def tiered_lemma(spark, d):
    c = uni(spark, d)
    return L.tiered(c, primary(c), fallback(c), 144)


def override_join(spark, d):
    c = uni(spark, d)
    over = c.filter("count >= 1000").select("tok", F.concat(F.lit("x"), "tok").alias("lemma"))
    return L.overridden(primary(c), over, known(spark, d))


def lemma_aggregate(spark, d):
    c = uni(spark, d)
    return L.lemma_counts(c, primary(c))


for _f, _sql in (
    (dictionary_gate, "select p.tok, case when p.lemma <> p.tok and dict.tok is null then f.lemma else p.lemma end as lemma from pri p join fal f using (tok) left join dict on dict.tok = p.lemma"),
    (tiered_lemma, "select tok, case when n >= 144 then pri.lemma else fal.lemma end as lemma from uni join pri using (tok) join fal using (tok)"),
    (override_join, "select uni.tok, case when n >= 1000 then 'x' || uni.tok when pri.lemma = uni.tok or dict.tok is not null then pri.lemma else uni.tok end as lemma from uni join pri using (tok) left join dict on dict.tok = pri.lemma"),
    (lemma_aggregate, "select lemma, sum(n)::bigint as count from uni join pri using (tok) group by lemma"),
):
    QUERIES[_f.__name__], SQL[_f.__name__] = _f, f"with {BASE}, {P} {_sql}"


@query("select tok, lang from (select tok, lang, row_number() over (partition by tok order by count(*) desc, lang) as k from toks group by tok, lang) where k = 1")
def majority_vote(spark, d):
    return S.majority(votes(spark, d), ["tok"], "lang")


@query("select tok, lang from (select tok, lang, row_number() over (partition by tok order by votes desc, lang) as k from (select tok, lang, count(*) as votes, max((lang <> 'en')::int) over (partition by tok) as anyk from toks group by tok, lang) where lang <> 'en' or anyk = 0) where k = 1")
def filtered_majority_fallback(spark, d):
    return S.filtered_majority(votes(spark, d).withColumn("keep", F.col("lang") != "en"), ["tok"], "lang", "keep")


def backend_vote_tiebreak(spark, d):
    c = uni(spark, d)
    rows = primary(c).withColumn("backend", F.lit("a")).union(fallback(c).withColumn("backend", F.lit("b"))).union(c.select("tok", F.col("tok").alias("lemma"), F.lit("c").alias("backend")))
    return S.backend_vote(rows, {"b": 0, "a": 1, "c": 2})


QUERIES["backend_vote_tiebreak"] = backend_vote_tiebreak
SQL["backend_vote_tiebreak"] = f"with {BASE}, {P}, v as (select tok, lemma, 1 as pr from pri union all select tok, lemma, 0 from fal union all select tok, tok, 2 from uni) select tok, lemma from (select tok, lemma, row_number() over (partition by tok order by count(*) desc, min(pr), lemma) as k from v group by tok, lemma) where k = 1"

SHARES = "v as (select tok, lang, count(*) as votes from toks group by tok, lang), w as (select tok, lang, votes, 1001 as total from v), x as (select *, total * votes::double / sum(votes) over (partition by tok) as part from w), y as (select *, floor(part)::bigint as base, part - floor(part) as rest from x), z as (select *, total - sum(base) over (partition by tok) as lft, row_number() over (partition by tok order by rest desc, lang) as k from y), sh as (select tok, lang, (base + (k <= lft)::int)::bigint as share from z where base + (k <= lft)::int > 0)"


def largest_remainder(spark, d):
    return S.apportion(votes(spark, d).withColumn("total", F.lit(1001).cast("long")), ["tok"], "lang").select("tok", "lang", "share")


QUERIES["largest_remainder"], SQL["largest_remainder"] = largest_remainder, f"with {BASE}, {SHARES} select * from sh"


@query("select tok, lang as lemma, count(*)::bigint as votes from toks group by tok, lang")
def joint_to_lemma_votes(spark, d):
    tags = lines(spark, d).select(F.explode(T.tokens(F.lower("line"))).alias("tok"), F.col("lang").alias("lemma"), (F.col("doc_id") % 3).cast("string").alias("upos"))
    return S.lemma_votes(S.joint_votes(tags))


@query("select lemma, pos, sum(w)::bigint as raw_freq from (select tok as lemma, case when lang = first or (w >= 0.25 * sum(w) over (partition by tok) and w >= 3) then lang else first end as pos, w from (select tok, lang, n as w, first_value(lang) over (partition by tok order by n desc, lang) as first from (select tok, lang, count(*) as n from toks group by tok, lang))) group by lemma, pos")
def pos_share_rows(spark, d):
    return S.pos_rows(votes(spark, d).select(F.col("tok").alias("lemma"), F.col("lang").alias("pos"), F.col("votes").alias("weight"), "votes"))


@query("select tok, lang, round(votes + spare * votes / known, 6) as votes from (select tok, lang, n::double as votes, coalesce(sum(n) filter (lang = 'en') over (partition by tok), 0)::double as spare, coalesce(sum(n) filter (lang <> 'en') over (partition by tok), 0)::double as known from (select tok, lang, count(*) as n from toks group by tok, lang)) where lang <> 'en' and known > 0 union all select tok, lang, n::double from (select tok, lang, count(*) as n, count(*) over (partition by tok) as langs from toks group by tok, lang) where lang = 'en' and langs = 1")
def abstention_redistribution(spark, d):
    return S.redistribute(votes(spark, d), "tok", "lang", "en").select("tok", "lang", F.round("votes", 6).alias("votes"))


FOLD = "cnt as (select tok as lemma, n from uni), b as (select lemma, n, strip_accents(lemma) as bare from cnt), h as (select *, first_value(lemma) over (partition by bare order by n desc, lemma) as head, max(n) over (partition by bare) as most from b), folds as (select h.lemma as from_lemma, head as into_lemma, n as from_count, most as into_count, case when h.lemma = bare and most >= 10 * n then 'unaccented' when h.lemma <> bare and dict.tok is null and not (h.lemma like '%ã' and head like '%a') then 'accent' end as kind from h left join dict on dict.tok = h.lemma where h.lemma <> head)"


def _lemma_counts(spark, d):
    return uni(spark, d).withColumnRenamed("tok", "lemma")


def diacritic_fold_log(spark, d):
    return L.diacritic_folds(_lemma_counts(spark, d), known(spark, d))


def diacritic_fold(spark, d):
    c = _lemma_counts(spark, d)
    return L.folded(c, L.diacritic_folds(c, known(spark, d)))


QUERIES["diacritic_fold_log"], SQL["diacritic_fold_log"] = diacritic_fold_log, f"with {BASE}, {FOLD} select * from folds where kind is not null"
QUERIES["diacritic_fold"], SQL["diacritic_fold"] = diacritic_fold, f"with {BASE}, {FOLD} select coalesce(into_lemma, lemma) as lemma, sum(n)::bigint as count from cnt left join (select * from folds where kind is not null) f on f.from_lemma = cnt.lemma group by 1"


@query("select bare, count(*) as n, string_agg(tok, ',' order by tok) as words from (select tok, strip_accents(tok) as bare from uni) group by bare having count(*) > 1")
def diacritic_groups(spark, d):
    rows = uni(spark, d).groupBy(T.strip_diacritics(F.col("tok")).alias("bare")).agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_list("tok")), ",").alias("words"))
    return rows.filter("n > 1")


def plural_fold(spark, d):
    return L.plural_folds(_lemma_counts(spark, d), known(spark, d), (), 5, 20)


QUERIES["plural_fold"] = plural_fold
SQL["plural_fold"] = f"""with {BASE}, cand as (
  select tok as plural, n, unnest([1, 2, 3, 4, 5, 6]) as k, unnest([
    case when right(tok, 3) in ('ões', 'ães', 'ãos') then left(tok, length(tok) - 3) || 'ão' end,
    case when right(tok, 4) = 'eses' then left(tok, length(tok) - 4) || 'ês' end,
    case when right(tok, 2) = 'es' then left(tok, length(tok) - 2) end,
    case when right(tok, 2) = 'is' then left(tok, length(tok) - 2) || 'l' end,
    case when right(tok, 2) = 'ns' then left(tok, length(tok) - 2) || 'm' end,
    left(tok, length(tok) - 1)]) as s from uni where tok like '%s' and length(tok) >= 3),
ok as (select c.* from cand c where s is not null and case when right(s, 2) = 'ão' then plural in (left(s, length(s) - 2) || 'ões', left(s, length(s) - 2) || 'ães', left(s, length(s) - 2) || 'ãos')
  when right(s, 2) = 'ês' then plural = left(s, length(s) - 2) || 'eses' when right(s, 1) in ('r', 'z', 's') then plural = s || 'es'
  when right(s, 1) = 'l' then plural = left(s, length(s) - 1) || 'is' when right(s, 1) = 'm' then plural = left(s, length(s) - 1) || 'ns' else plural = s || 's' end)
select plural, s as singular from (select plural, s, row_number() over (partition by plural order by k) as j from ok join uni u on u.tok = s left join dict on dict.tok = s where (dict.tok is not null or u.n >= 20) and ok.n <= 5 * u.n) where j = 1"""


def lemma_closure(spark, d):
    c = uni(spark, d)
    p = primary(c).filter("lemma != tok").join(c.select(F.col("tok").alias("lemma")), "lemma", "left_semi")
    return L.closure(p.select(F.col("tok").alias("src"), F.col("lemma").alias("dst")))


QUERIES["lemma_closure"] = lemma_closure
SQL["lemma_closure"] = f"with recursive {BASE}, {P}, red as (select tok as src, lemma as dst from pri where lemma <> tok and lemma in (select tok from uni)), walk as (select src, dst as node, 1 as step from red union all select w.src, r.dst, step + 1 from walk w join red r on r.src = w.node where step < 32) select src, red.dst, node as final from (select src, node, row_number() over (partition by src order by step desc) as k from walk) join red using (src) where k = 1"


_places = ", ".join(f"list_transform(list_filter(range(1, len(tok) + 1), lambda i: substr(tok, i, 2) = '{a}'), lambda i: substr(tok, 1, i - 1) || '{b}' || substr(tok, i + 2))" for a, b in T.REFORM[:4])
_full = "tok"
for _a, _b in T.REFORM:
    _full = f"replace({_full}, '{_a}', '{_b}')"
_accents = ", ".join(f"replace(tok, '{a}', '{b}')" for a, b in T.REFORM[4:])


@query(f"select tok, candidate, candidate in (from dict) as known from (select distinct tok, unnest(flatten([[{_full}, {_accents}], {_places}])) as candidate from uni) where candidate <> tok")
def spelling_reform_words(spark, d):
    """Every candidate spelling of every word, and whether the dictionary has it."""
    rows = uni(spark, d).select("tok", F.explode(T.reform_candidates(F.col("tok"))).alias("candidate"))
    own = known(spark, d).select(F.col("tok").alias("candidate"), F.lit(True).alias("known"))
    return rows.join(own, "candidate", "left").select("tok", "candidate", F.coalesce("known", F.lit(False)).alias("known"))


@query(rf"select tok, regexp_extract(tok, '{T.DIMINUTIVE}', 1) as base, case when tok like '%s' and length(tok) > 3 then left(tok, length(tok) - 1) else tok end as headword from uni where regexp_matches(tok, '{T.DIMINUTIVE}')")
def diminutive_rule(spark, d):
    w = F.col("tok")
    return uni(spark, d).filter(F.regexp_like(w, F.lit(T.DIMINUTIVE))).select("tok", F.regexp_extract(w, T.DIMINUTIVE, 1).alias("base"), T.singular(w).alias("headword"))


def convention_summary(spark, d):
    c = uni(spark, d)
    rows = L.conventions(primary(c), known(spark, d), contractions=["des", "les"], pronouns=["is", "es"], comparatives={"as": "a", "was": "be"}, fold={"ha": "ho", "ea": "eo"})
    return rows.filter("rule is not null").join(c, "tok").groupBy("rule").agg(F.count("*").alias("surfaces"), F.sum("count").alias("tokens"))


QUERIES["convention_summary"] = convention_summary

# -- filters and parts of speech ------------------------------------------------------------------------------------------


@query("select tok as lemma, n as count from uni where tok not in ('the', 'et', 'und', 'de', 'els', 'nte')")
def exclusion_anti(spark, d):
    return FL.excluded(_lemma_counts(spark, d), ["the", "et", "und", "de", "sur", "éls", "nte"], ["sur"])


@query("select tok, n as count from uni anti join dict using (tok) where length(tok) <= 2 and tok not in ('oh', 'ah')")
def short_fragment(spark, d):
    rows = uni(spark, d).join(known(spark, d).withColumn("known", F.lit(True)), "tok", "left")
    return rows.filter(FL.fragment(F.col("tok"), F.coalesce("known", F.lit(False)), ("oh", "ah"))).select("tok", "count")


def english_plural(spark, d):
    c, k = uni(spark, d), known(spark, d)
    w = F.col("tok")
    rows = c.withColumn("s1", F.left(w, F.length(w) - 1)).withColumn("s2", F.left(w, F.length(w) - 2))
    for name, key in (("stem1_en", "s1"), ("stem2_en", "s2")):
        rows = rows.join(k.select(F.col("tok").alias(key), F.lit(True).alias(name)), key, "left").withColumn(name, F.coalesce(name, F.lit(False)))
    rows = rows.join(k.select("tok", F.lit(True).alias("known")), "tok", "left").withColumn("known", F.coalesce("known", F.lit(False))).withColumn("last_en", F.lit(True))
    return rows.filter(FL.english_plural("tok")).select("tok", "count")


QUERIES["english_plural"] = english_plural
SQL["english_plural"] = f"with {BASE} select tok, n as count from uni where tok like '%s' and length(tok) >= 4 and tok not in (from dict) and (left(tok, length(tok) - 1) in (from dict) or left(tok, length(tok) - 2) in (from dict))"

CAP = rf"cap as (select lower(raw) as tok, count(*) filter (regexp_matches(raw, '^\p{{Lu}}')) / count(*) as cap_ratio from (select unnest(t) as raw, unnest(range(len(t))) as p from (select regexp_extract_all(line, '{WORD_SQL}') as t from lines)) where p > 0 group by 1)"


def _candidates(spark, d):
    ls = lines(spark, d)
    rows = C.unigrams(ls).join(C.casing(ls).select("tok", "cap_ratio"), "tok", "left").join(known(spark, d).withColumn("known", F.lit(True)), "tok", "left")
    w = F.col("tok")
    return rows.select(w.alias("lemma"), "count", F.coalesce("cap_ratio", F.lit(0.0)).alias("cap_ratio"), F.coalesce("known", F.lit(False)).alias("known"), w.isin("the", "und").alias("excluded"), (w.endswith("ings") & F.col("known").isNull()).alias("foreign"), F.when(w.startswith("er"), "keep").when(w.startswith("st"), "drop").alias("decision"))


CASCADE = f"{CAP}, cand as (select uni.tok as lemma, n, coalesce(cap_ratio, 0) as cap_ratio, dict.tok is not null as known from uni left join cap using (tok) left join dict on dict.tok = uni.tok), cas as (select *, case when lemma in ('the', 'und') then 'exclusion' when length(lemma) <= 2 and not known and lemma not in ('oh', 'ah') then 'fragment' when lemma like '%ings' and not known then 'foreign' when lemma in ('oh', 'ah') or lemma like 'er%' then null when lemma like 'st%' then 'reviewed' when cap_ratio >= 0.85 then 'proper_noun' end as reason from cand)"


def proper_noun_filter(spark, d):
    return _candidates(spark, d).filter(FL.proper_noun(F.col("cap_ratio"), F.col("known"), F.col("count"), 0.9, True, 2)).select("lemma", "count", F.round("cap_ratio", 9).alias("cap_ratio"))


def filter_cascade(spark, d):
    return FL.cascade(_candidates(spark, d), ("oh", "ah")).filter("reason is null").select("lemma", "count")


def drop_log(spark, d):
    return FL.cascade(_candidates(spark, d), ("oh", "ah")).filter("reason is not null").groupBy("reason").agg(F.count("*").alias("lemmas"), F.sum("count").alias("tokens"))


for _f, _sql in (
    (proper_noun_filter, "select lemma, n as count, round(cap_ratio, 9) as cap_ratio from cand where cap_ratio >= 0.9 and not known and n >= 2"),
    (filter_cascade, "select lemma, n as count from cas where reason is null"),
    (drop_log, "select reason, count(*) as lemmas, sum(n)::bigint as tokens from cas where reason is not null group by reason"),
):
    QUERIES[_f.__name__], SQL[_f.__name__] = _f, f"with {BASE}, {CASCADE} {_sql}"

POS = "case when tok in ('the', 'de', 'la') then 'det' when tok like '%ment' then 'adv' when length(tok) >= 4 and (tok like '%er' or tok like '%ed') then 'verb' when tok like '%tion' then 'noun' when tok like '%able' then 'adj' when tok like '%ly' then 'adv' else 'unk' end"


def _tagged(spark, d):
    return FL.rule_pos(_lemma_counts(spark, d), {"the": "det", "de": "det", "la": "det"}, ("er", "ed"), {"tion": "noun", "able": "adj", "ly": "adv"}, "ment")


@query(f"select tok as lemma, n as count, {POS} as pos from uni")
def rule_pos_tag(spark, d):
    return _tagged(spark, d)


@query(f"select suffix, pos, support, round(most / support, 9) as share from (select suffix, first(pos order by n desc, pos) as pos, max(n) as most, sum(n)::bigint as support from (select suffix, pos, count(*) as n from (select {POS} as pos, unnest([case when length(tok) > 4 then right(tok, 4) end, case when length(tok) > 3 then right(tok, 3) end, case when length(tok) > 2 then right(tok, 2) end]) as suffix from uni) where suffix is not null group by all) group by suffix) where support >= 8 and most / support >= 0.65 and pos <> 'unk'")
def suffix_rule_fit(spark, d):
    return FL.suffix_rules(_tagged(spark, d)).withColumn("share", F.round("share", 9))


# -- comparison and quality -------------------------------------------------------------------------------------------------


def _halves(spark, d, n=3000):
    ls = lines(spark, d)
    return [C.ranked(C.unigrams(ls.filter(F.col("doc_id") % 2 == k)), n).select(F.col("tok").alias("lemma"), F.col("rank").cast("long").alias("rank")) for k in (0, 1)]


HALVES = "half as (select doc_id % 2 as side, tok, count(*) as n from toks group by 1, 2), rk as (select side, tok as lemma, row_number() over (partition by side order by n desc, tok) as rank from half), o as (select lemma, rank from rk where side = 0 and rank <= 3000), r as (select lemma, rank from rk where side = 1 and rank <= 3000), bth as (select coalesce(o.lemma, r.lemma) as lemma, o.rank as o_rank, r.rank as r_rank, case when o.rank is null then 'new' when r.rank is null then 'lost' else 'shared' end as state from o full join r on o.lemma = r.lemma)"


def list_compare_full_outer(spark, d):
    return Q.compare(*_halves(spark, d))


def comparison_scores(spark, d):
    return Q.comparison_scores(Q.compare(*_halves(spark, d)))


def largest_moves(spark, d):
    return Q.largest_moves(Q.compare(*_halves(spark, d)))


def set_intersect(spark, d):
    a, b = _halves(spark, d)
    return a.select("lemma").intersect(b.select("lemma"))


def set_except(spark, d):
    a, b = _halves(spark, d)
    return a.select("lemma").exceptAll(b.select("lemma"))


for _f, _sql in (
    (list_compare_full_outer, "select * from bth"),
    (comparison_scores, "select count(*) filter (state = 'shared') as shared, count(*) filter (state = 'lost') as lost, count(*) filter (state = 'new') as new, count(*) filter (state = 'shared') / count(*) as jaccard, round(corr(o_rank, r_rank), 6) as rho from bth"),
    (largest_moves, "select lemma, o_rank, r_rank, r_rank - o_rank as delta from bth where state = 'shared' order by abs(r_rank - o_rank) desc, lemma limit 40"),
    (set_intersect, "select lemma from o intersect select lemma from r"),
    (set_except, "select lemma from o except all select lemma from r"),
):
    QUERIES[_f.__name__], SQL[_f.__name__] = _f, f"with {BASE}, {HALVES} {_sql}"


def union_rank(spark, d):
    ls = lines(spark, d)
    words = C.unigrams(ls).select(F.col("tok").alias("lemma"), "count", F.lit(False).alias("is_mwe"))
    pairs = C.bigrams(ls).select(F.concat_ws(" ", "left", "right").alias("lemma"), "count", F.lit(True).alias("is_mwe"))
    return C.ranked(words.unionByName(pairs), 2000, ("lemma",)).withColumn("rank", F.col("rank").cast("long"))


QUERIES["union_rank"] = union_rank
SQL["union_rank"] = f"with {BASE} select lemma, count, is_mwe, row_number() over (order by count desc, lemma) as rank from (select tok as lemma, n as count, false as is_mwe from uni union all select l || ' ' || r, n, true from bi) order by count desc, lemma limit 2000"


def _entries(spark, d, n=5000):
    return C.ranked(uni(spark, d), n).select(F.col("tok").alias("lemma"), F.col("rank").cast("long").alias("rank"))


ENT = "ent as (select lemma, rank from (select tok as lemma, row_number() over (order by n desc, tok) as rank from uni) where rank <= 5000)"
DIA = "dia as (select 'diacritic' as kind, lemma as entry, rank as entry_rank, other, other_rank from (select *, first_value(lemma) over (partition by strip_accents(lemma) order by rank) as other, min(rank) over (partition by strip_accents(lemma)) as other_rank from ent) where lemma <> other)"
PLU = "plu as (select distinct 'inflected' as kind, e.lemma as entry, e.rank as entry_rank, s.lemma as other, s.rank as other_rank from (select lemma, rank, unnest(case when right(lemma, 2) = 'ão' then [left(lemma, length(lemma) - 2) || 'ões', left(lemma, length(lemma) - 2) || 'ães', left(lemma, length(lemma) - 2) || 'ãos'] when right(lemma, 2) = 'ês' then [left(lemma, length(lemma) - 2) || 'eses'] when right(lemma, 1) in ('r', 'z', 's') then [lemma || 'es'] when right(lemma, 1) = 'l' then [left(lemma, length(lemma) - 1) || 'is'] when right(lemma, 1) = 'm' then [left(lemma, length(lemma) - 1) || 'ns'] else [lemma || 's'] end) as form from ent) s join ent e on e.lemma = s.form where e.lemma <> s.lemma)"


def suspects_diacritic(spark, d):
    return Q.suspect_diacritics(_entries(spark, d))


def suspects_inflected(spark, d):
    return Q.suspect_inflections(_entries(spark, d))


def suspects_dedup(spark, d):
    e = _entries(spark, d)
    white = e.filter("rank % 7 = 0").select(F.concat("lemma", F.lit("s")).alias("a"), F.col("lemma").alias("b"))
    return Q.suspects([Q.suspect_diacritics(e), Q.suspect_inflections(e)], white)


def whitelist_pairs(spark, d):
    return Q.whitelist_pairs(Q.suspect_inflections(_entries(spark, d)), known(spark, d))


for _f, _sql in (
    (suspects_diacritic, "select * from dia"),
    (suspects_inflected, "select * from plu"),
    (suspects_dedup, "select kind, entry, entry_rank, other, other_rank from (select *, row_number() over (partition by kind, least(entry, other), greatest(entry, other) order by entry_rank, entry) as k from (select * from dia union all select * from plu)) where k = 1 and (least(entry, other), greatest(entry, other)) not in (select (lemma, lemma || 's') from ent where rank % 7 = 0)"),
    (whitelist_pairs, "select a, b, case when x.tok is not null and y.tok is not null then 'keep' when x.tok is null and y.tok is null then 'unknown' else 'typo' end as verdict from (select distinct least(entry, other) as a, greatest(entry, other) as b from plu) left join dict x on x.tok = a left join dict y on y.tok = b"),
):
    QUERIES[_f.__name__], SQL[_f.__name__] = _f, f"with {BASE}, {ENT}, {DIA}, {PLU} {_sql}"


def gold_accuracy_grouping_sets(spark, d):
    labels = spark.read.parquet(f"{d}/labels.parquet")
    gold = labels.select(F.col("doc_id").cast("string").alias("tok"), F.array(F.col("quality").cast("string")).alias("answers"), F.floor(F.col("doc_id") / 100).cast("long").alias("band"), F.col("toxic").cast("string").alias("category"))
    predicted = docs(spark, d).select(F.col("doc_id").cast("string").alias("tok"), F.when(F.length("text") > 1000, "1").otherwise("0").alias("lemma"))
    return Q.gold_scores(gold, predicted)


QUERIES["gold_accuracy_grouping_sets"] = gold_accuracy_grouping_sets
SQL["gold_accuracy_grouping_sets"] = "select band, category, count(*) as n, sum(ok)::bigint as right, round(avg(ok), 6) as accuracy from (select doc_id // 100 as band, toxic::varchar as category, (quality = (length(text) > 1000)::int)::int as ok from labels join documents using (doc_id)) group by grouping sets ((), (band), (category))"


def confusion_rollup(spark, d):
    rows = docs(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").select("lang", F.col("quality").cast("string").alias("truth"), F.when(F.length("text") > 2000, "1").when(F.length("text") < 500, "0").otherwise("?").alias("guess"))
    return Q.confusion(rows, "lang", "truth", "guess", "?")


QUERIES["confusion_rollup"] = confusion_rollup
SQL["confusion_rollup"] = "select lang, count(*) as n, count(*) filter (g <> '?') as decided, count(*) filter (g = q) as correct, count(*) filter (g = '?') as abstained from (select lang, quality::varchar as q, case when length(text) > 2000 then '1' when length(text) < 500 then '0' else '?' end as g from documents join labels using (doc_id)) group by rollup (lang)"


@query("select a.line_no, a.n as old, b.n as new from (select line_no, count(*) as n from lines where doc_id % 2 = 0 group by 1) a full join (select line_no, count(*) as n from lines where doc_id % 2 = 1 group by 1) b using (line_no) where false union all select 0, (select count(*) from lines where doc_id % 2 = 0), (select count(*) from lines where doc_id % 2 = 1)")
def line_fingerprint(spark, d):
    ls = lines(spark, d)
    return ls.agg(F.lit(0).cast("long").alias("line_no"), F.count_if(F.col("doc_id") % 2 == 0).alias("old"), F.count_if(F.col("doc_id") % 2 == 1).alias("new"))


def fingerprint_deltas(spark, d):
    ls = lines(spark, d)
    old, new = (C.totals(x, C.unigrams(x)) for x in (ls.filter("doc_id % 2 = 0"), ls.filter("doc_id % 2 = 1")))
    return Q.fingerprint_deltas(old, new).withColumn("old", F.round("old", 6)).withColumn("new", F.round("new", 6))


QUERIES["fingerprint_deltas"] = fingerprint_deltas
SQL["fingerprint_deltas"] = f"with {BASE}, f as (select s, (select count(*) from lines where doc_id % 2 = s)::double as lines, (select count(*) from toks where doc_id % 2 = s)::double as tokens, (select count(distinct tok) from toks where doc_id % 2 = s)::double as types from (values (0), (1)) v(s)), u as (select unnest(['lines', 'tokens', 'types', 'tokens_per_line']) as measure, unnest([a.lines, a.tokens, a.types, a.tokens / a.lines]) as o, unnest([b.lines, b.tokens, b.types, b.tokens / b.lines]) as n from f a, f b where a.s = 0 and b.s = 1) select measure, round(o, 6) as old, round(n, 6) as new, round(n - o, 6) as delta, round((n - o) * 100 / o, 6) as percent from u"


def review_merge(spark, d):
    a, b = _halves(spark, d, 1000)
    return Q.merged_review(a.select("lemma", F.concat(F.lit("seen "), F.col("rank").cast("string")).alias("decision")), b, "lemma", ["decision"])


QUERIES["review_merge"] = review_merge
SQL["review_merge"] = f"with {BASE}, {HALVES} select coalesce(n.lemma, p.lemma) as lemma, n.rank, case when p.lemma is not null then 'seen ' || p.rank::varchar end as decision, case when p.lemma is null then 'new' when n.lemma is null then 'lost' else 'kept' end as state from (select * from r where rank <= 1000) n full join (select * from o where rank <= 1000) p on n.lemma = p.lemma"


# -- examples, replies and gates ----------------------------------------------------------------------------------------------

TIER = rf"tr as (select doc_id, line_no, line, len(regexp_extract_all(line, '{WORD_SQL}')) as nw, length(regexp_replace(line, '[^\p{{L}}]', '', 'g')) as nl, length(regexp_replace(line, '[^\p{{Lu}}]', '', 'g')) as nu from lines), tq as (select *, coalesce(nu > 0.6 * nullif(nl, 0), false) as caps, regexp_matches(trim(line), '^(\.\.\.|…)|(\.\.\.|…|[-–—])$') as edge from tr), ti as (select *, case when nw between 4 and 15 and not caps and not edge then 1 when not caps and not edge then 2 else 3 end as tier from tq)"


def all_caps_lines(spark, d):
    return lines(spark, d).filter(T.all_caps(F.col("line"))).select("doc_id", F.col("line_no").cast("long").alias("line_no"))


def example_tiers(spark, d):
    return lines(spark, d).groupBy(E.tier().cast("long").alias("tier")).agg(F.count("*").alias("n"))


def example_shortest_k(spark, d):
    rows = lines(spark, d).select(F.col("doc_id").alias("key"), "line")
    return E.choose(rows, "key", 3).select("key", F.col("tier").cast("long").alias("tier"), F.col("k").cast("long").alias("k"), "line")


for _f, _sql in (
    (all_caps_lines, "select doc_id, line_no from ti where caps"),
    (example_tiers, "select tier::bigint as tier, count(*) as n from ti group by tier"),
    (example_shortest_k, "select key, tier::bigint as tier, k, line from (select doc_id as key, tier, line, row_number() over (partition by doc_id order by nw, length(line), line) as k from (select distinct doc_id, tier, line, nw, min(tier) over (partition by doc_id) as best from ti) where tier = best) where k <= 3"),
):
    QUERIES[_f.__name__], SQL[_f.__name__] = _f, f"with {BASE}, {TIER} {_sql}"


@query(rf"select doc_id, line_no from lines where contains(' ' || array_to_string(regexp_extract_all(lower(line), '{WORD_SQL}'), ' ') || ' ', ' of the ')")
def phrase_contains(spark, d):
    return lines(spark, d).filter(E.contains_phrase("line", F.lit("of the"))).select("doc_id", F.col("line_no").cast("long").alias("line_no"))


@query("select doc_id, lang, source from (select *, row_number() over (partition by lang order by md5(lang || chr(31) || doc_id::varchar), doc_id) as k from documents) where k <= case lang when 'en' then 10 when 'fr' then 20 when 'de' then 20 else 5 end")
def stratified_sample(spark, d):
    return E.strata_sample(docs(spark, d), "lang", "doc_id", {"en": 10, "fr": 20, "de": 20}, 5).select("doc_id", "lang", "source")


@query("select tok, rank, band from (select tok, rank, band, row_number() over (partition by band order by md5(rank::varchar), rank) as k from (select tok, rank, case when rank <= 500 then 0 else (rank - 501) // 225 + 1 end as band from (select tok, row_number() over (order by n desc, tok) as rank from uni) where rank <= 5000)) where band = 0 or k <= 10")
def even_spread_sample(spark, d):
    return E.even_spread(C.ranked(uni(spark, d), 5000).select("tok", F.col("rank").cast("long").alias("rank")), 500, 20, 10, 5000)


@query("select tok, doc_id, line_no from (select tok, doc_id, line_no, row_number() over (partition by tok order by md5(tok || chr(31) || doc_id::varchar || chr(31) || line_no::varchar), doc_id, line_no) as k from (select distinct tok, doc_id, line_no from toks where tok in ('the', 'de', 'der', 'el'))) where k <= 100")
def hash_reservoir(spark, d):
    rows = lines(spark, d).select("doc_id", F.col("line_no").cast("long").alias("line_no"), F.explode(F.array_distinct(T.tokens(F.lower("line")))).alias("tok")).filter(F.col("tok").isin("the", "de", "der", "el"))
    order = Window.partitionBy("tok").orderBy(T.digest("tok", F.col("doc_id").cast("string"), F.col("line_no").cast("string")), "doc_id", "line_no")
    return rows.withColumn("k", F.row_number().over(order)).filter("k <= 100").select("tok", "doc_id", "line_no")


def glue_candidates(spark, d):
    ls = lines(spark, d)
    c = C.unigrams(ls)
    pairs = C.bigrams(ls).select(F.concat_ws("-", "left", "right").alias("tok"), "count").filter(F.substring_index("tok", "-", -1).isin(*T.CLITICS))
    return FL.glue_candidates(c.unionByName(pairs), known(spark, d), C.casing(ls), 5, 2, 0.5).withColumn("ratio", F.round("ratio", 6))


QUERIES["glue_candidates"] = glue_candidates

CONV = "conv as (select conv_id, turn, role, text from conversations)"


@query("select conv_id, turn from conversations where conv_id not in (select doc_id from labels where doc_id is not null)")
def coverage_anti(spark, d):
    return spark.read.parquet(f"{d}/conversations.parquet").join(spark.read.parquet(f"{d}/labels.parquet").select(F.col("doc_id").alias("conv_id")), "conv_id", "left_anti").select("conv_id", "turn")


@query("select role, count(*) as n, count(*) filter (length(text) = 0) as empty, count(*) filter (length(text) > 500) as long, count(*) filter (contains(text, '?')) as asks from conversations group by role")
def gate_counts(spark, d):
    t = F.col("text")
    return spark.read.parquet(f"{d}/conversations.parquet").groupBy("role").agg(F.count("*").alias("n"), F.count_if(F.length(t) == 0).alias("empty"), F.count_if(F.length(t) > 500).alias("long"), F.count_if(t.contains("?")).alias("asks"))


@query("select flag, count(*) as n from (select unnest([case when length(text) > 500 then 'long' end, case when contains(text, '?') then 'asks' end, case when turn = 0 then 'first' end]) as flag from conversations) where flag is not null group by flag")
def flag_histogram(spark, d):
    t = F.col("text")
    flags = F.array_compact(F.array(F.when(F.length(t) > 500, "long"), F.when(t.contains("?"), "asks"), F.when(F.col("turn") == 0, "first")))
    return spark.read.parquet(f"{d}/conversations.parquet").select(F.explode(flags).alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))


@query("select event_type, count(*) as n, count(json_extract(props, '$.k')) as with_k from events where props is not null and json_valid(props) group by event_type")
def reply_json_parse(spark, d):
    rows = spark.read.parquet(f"{d}/events.parquet").filter("props is not null")
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), F.count(F.get_json_object("props", "$.k")).alias("with_k"))


@query(r"select doc_id, line_no, trim(regexp_replace(line, '[\s\x{00A0}]+', ' ', 'g')) as line from lines")
def squeezed_lines(spark, d):
    return lines(spark, d).select("doc_id", F.col("line_no").cast("long").alias("line_no"), T.squeeze("line").alias("line"))


def tidy_lines(spark, d):
    return lines(spark, d).select("doc_id", F.col("line_no").cast("long").alias("line_no"), T.tidy(F.col("line")).alias("line"))


QUERIES["tidy_lines"] = tidy_lines
_tidied = "trim(line)"
for _layer in T.LAYERS * 3:
    _tidied = f"regexp_replace({_tidied}, '{_layer}', '\\1')"
SQL["tidy_lines"] = f"with {BASE} select doc_id, line_no, {_tidied} as line from lines"


@query("select sum(length(text))::bigint as input_tokens, sum(turn)::bigint as output_tokens, round(sum(length(text)) * 3 / 1e6 + sum(turn) * 15 / 1e6, 6) as cost from conversations")
def usage_cost(spark, d):
    rows = spark.read.parquet(f"{d}/conversations.parquet").select(F.length("text").cast("long").alias("input_tokens"), F.col("turn").cast("long").alias("output_tokens"))
    return E.usage_cost(rows, {"input_tokens": 3.0, "output_tokens": 15.0})


def deck_range_join(spark, d):
    ranges = spark.createDataFrame([("a", 1, 500), ("b", 501, 2000), ("c", 2001, 5000)], "deck string, low long, high long")
    return E.decks(_entries(spark, d), ranges)


QUERIES["deck_range_join"] = deck_range_join
SQL["deck_range_join"] = f"with {BASE}, {ENT} select lemma, rank, deck from ent left join (values ('a', 1, 500), ('b', 501, 2000), ('c', 2001, 5000)) v(deck, low, high) on rank between low and high"


@query("select tok as lemma, lang as pos, count(*) as n, round(count(*) / sum(count(*)) over (partition by tok), 6) as pos_share from toks group by tok, lang")
def pos_share_window(spark, d):
    v = votes(spark, d)
    return v.select(F.col("tok").alias("lemma"), F.col("lang").alias("pos"), F.col("votes").alias("n"), F.round(F.col("votes") / F.sum("votes").over(Window.partitionBy("tok")), 6).alias("pos_share"))


@query("select nxt as next, case when nxt in ('embora', 'buscar', 'para', 'até', 'lá', 'ali', 'aí', 'ter', 'ver') then 'ir' when regexp_matches(nxt, '(ar|er|ir)$') and length(nxt) > 3 then 'ir' when regexp_matches(nxt, '(ado|ada|ados|adas|ido|ida|idos|idas)$') or nxt in ('um', 'uma', 'o', 'muito', 'tão', 'por', 'isso', 'quem', 'que') then 'ser' else '?' end as guess, n from (select r as nxt, sum(n)::bigint as n from bi where l = 'the' group by r), (select 1 from lines limit 1)")
def next_word_rule(spark, d):
    rows = C.bigrams(lines(spark, d)).filter("left = 'the'").groupBy(F.col("right").alias("next")).agg(F.sum("count").alias("n"))
    return rows.select("next", FL.next_word_class().alias("guess"), "n")


@query("select c_custkey as key, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue, count(distinct o_orderkey) as orders from customer join orders on o_custkey = c_custkey join lineitem on l_orderkey = o_orderkey group by c_custkey")
def star_join_revenue(spark, d):
    t = lambda n: spark.read.parquet(f"{d}/{n}.parquet")
    rows = t("customer").join(t("orders"), F.col("o_custkey") == F.col("c_custkey")).join(t("lineitem"), F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.groupBy(F.col("c_custkey").alias("key")).agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count_distinct("o_orderkey").alias("orders"))
