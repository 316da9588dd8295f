"""Operators on small frames."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.operators import backends as B
from corpusloom.operators import counts as C
from corpusloom.operators import examples as E
from corpusloom.operators import filters as FL
from corpusloom.operators import lemmas as L
from corpusloom.operators import quality as Q
from corpusloom.operators import readings as R
from corpusloom.operators import shares as S


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_counts(spark):
    lines = spark.createDataFrame([("A casa a",), ("a Casa",), ("",)], "line string")
    assert rows(C.unigrams(lines)) == [("a", 3), ("casa", 2)]
    assert rows(C.totals(lines, C.unigrams(lines))) == [(3, 5, 2)]
    assert rows(C.bigrams(lines)) == [("a", "casa", 2), ("casa", "a", 1)]
    assert rows(C.casing(lines)) == [("a", 0, 1, 0.0), ("casa", 1, 2, 0.5)]
    assert [r.rank for r in C.ranked(C.unigrams(lines), 1).collect()] == [1]


def test_vocabulary_parts_neighbours(spark):
    lines = spark.createDataFrame([("um raro dois um dois",)], "line string")
    vocab = spark.createDataFrame([("um",), ("dois",)], "tok string")
    assert rows(C.bigrams(lines, vocab)) == [("dois", "um", 1), ("um", "dois", 1)]


def test_contexts_are_prefixes(spark):
    lines = spark.createDataFrame([(f"casa número {'x' * i}",) for i in range(1, 60)] + [("casa casa",)] * 2, "line string")
    pick = lambda k: [r.line for r in C.contexts(lines, spark.createDataFrame([("casa", k)], "tok string, size int")).orderBy("k").collect()]
    assert pick(50)[:5] == pick(5) and len(pick(50)) == 50


def test_g2(spark):
    df = spark.createDataFrame([(10, 10, 10, 100), (1, 10, 10, 100), (20, 10, 30, 100)], "count long, n_left long, n_right long, n long")
    a, b, c = (r[0] for r in df.coalesce(1).select(C.dunning()).collect())
    assert a > 60 and abs(b) < 1e-9 and c == 0


def test_apportion(spark):
    df = spark.createDataFrame([("g", k, 1, 1001) for k in "abc"] + [("h", "x", 3, 1000), ("h", "y", 2, 1000), ("i", "z", 0, 5), ("i", "w", 1, 5)], "g string, k string, votes long, total long")
    assert rows(S.apportion(df, ["g"], "k").select("g", "k", "share")) == [("g", "a", 334), ("g", "b", 334), ("g", "c", 333), ("h", "x", 600), ("h", "y", 400), ("i", "w", 5)]


def test_votes(spark):
    df = spark.createDataFrame([("t", "b", 2, True), ("t", "a", 2, True), ("u", "c", 1, False), ("u", "d", 5, False), ("v", "x", 9, False), ("v", "y", 1, True)], "tok string, lemma string, votes long, keep boolean")
    assert rows(S.majority(df, ["tok"], "lemma")) == [("t", "a"), ("u", "d"), ("v", "x")]
    assert rows(S.filtered_majority(df, ["tok"], "lemma", "keep")) == [("t", "a"), ("u", "d"), ("v", "y")]
    v = spark.createDataFrame([("f", "ser", 3.0), ("f", "ir", 1.0), ("f", "?", 4.0), ("g", "?", 2.0)], "form string, k string, votes double")
    assert rows(S.redistribute(v, "form", "k", "?")) == [("f", "ir", 2.0), ("f", "ser", 6.0), ("g", "?", 2.0)]
    p = spark.createDataFrame([("a", "noun", 80, 10), ("a", "verb", 15, 9), ("a", "adj", 30, 1), ("b", "adv", 1, 1)], "lemma string, pos string, weight long, votes long")
    assert rows(S.pos_rows(p)) == [("a", "noun", 125), ("b", "adv", 1)]


def test_lemmas(spark):
    t = lambda r: spark.createDataFrame(r, "tok string, lemma string")
    known = spark.createDataFrame([("falar",), ("ação",), ("coisa",)], "tok string")
    assert rows(L.dictionary_gate(t([("falo", "falar"), ("xis", "xiar"), ("y", "y")]), t([("xis", "x")]), known)) == [("falo", "falar"), ("xis", "x"), ("y", "y")]
    assert rows(L.overridden(t([("a", "zz"), ("b", "falar"), ("c", "qq")]), t([("c", "set")]), known)) == [("a", "a"), ("b", "falar"), ("c", "set")]
    conv = L.conventions(t([("me", "eu"), ("lo", "ele"), ("maiores", "grande"), ("da", "de"), ("coisinha", "coisa"), ("acções", "acção"), ("menina", "menina"), ("ferida", "ferir"), ("musica", "musico"), ("falo", "falar")]), known, ["da"], ["me"], {"lo": "o"}, {"maiores": "maior"}, {"menina": "menino"}, {"musica": "musico"}, ["ferida"])
    assert {r.tok: (r.rule, r.new_lemma) for r in conv.collect()} == {"me": ("1_pronouns", "me"), "lo": ("1_clitic_allomorphs", "o"), "maiores": ("4_comparatives", "maior"), "da": ("1_contractions", "da"), "coisinha": ("3_diminutives", "coisinha"), "acções": ("5_spelling_reform", "ação"), "menina": ("2_gender", "menino"), "ferida": ("2_gender_exception", "ferida"), "musica": ("2_gender_exception", "musica"), "falo": (None, "falar")}


def test_closure(spark):
    pairs = [("a", "b"), ("b", "c"), ("x", "y"), ("y", "z"), ("z", "x"), ("w", "z"), ("0", "y"), ("s", "s")]
    got = {r.src: r.final for r in L.closure(spark.createDataFrame(pairs, "src string, dst string")).collect()}
    assert got == {"a": "c", "b": "c", "x": "x", "y": "x", "z": "x", "w": "w", "0": "0"}


def test_folds(spark):
    c = spark.createDataFrame([("nao", 5), ("não", 100), ("näo", 3), ("irmã", 50), ("irma", 200), ("por", 90), ("pôr", 80)], "lemma string, count long")
    known = spark.createDataFrame([("pôr",), ("por",), ("não",)], "tok string")
    folds = L.diacritic_folds(c, known)
    assert {(r.from_lemma, r.into_lemma, r.kind) for r in folds.collect()} == {("nao", "não", "unaccented"), ("näo", "não", "accent")}
    assert dict(L.folded(c, folds).collect())["não"] == 108
    p = spark.createDataFrame([("casas", 10), ("casa", 50), ("reis", 30), ("rel", 1), ("rei", 40), ("deus", 999), ("deu", 3)], "lemma string, count long")
    assert rows(L.plural_folds(p, spark.createDataFrame([("casa",), ("rei",), ("deu",)], "tok string"))) == [("casas", "casa"), ("reis", "rei")]


def test_cascade(spark):
    data = [("você", 9, 0.0, True, True, False, "keep"), ("xq", 9, 0.0, False, False, False, "keep"), ("oh", 9, 1.0, False, False, False, None), ("chips", 9, 0.0, False, False, True, None), ("pires", 9, 1.0, True, False, False, "keep"), ("mary", 9, 0.1, True, False, False, "drop"), ("john", 9, 1.0, True, False, False, None), ("casa", 9, 0.0, True, False, False, None)]
    got = FL.cascade(spark.createDataFrame(data, "lemma string, count long, cap_ratio double, known boolean, excluded boolean, foreign boolean, decision string"), ("oh",))
    assert {r.lemma: r.reason for r in got.collect()} == {"você": "exclusion", "xq": "fragment", "oh": None, "chips": "foreign", "pires": None, "mary": "reviewed", "john": "proper_noun", "casa": None}


def test_quality(spark):
    e = spark.createDataFrame([("não", 1), ("nao", 2), ("casa", 3), ("casas", 4), ("falo", 5), ("falar", 6)], "lemma string, rank long")
    found = Q.suspects([Q.suspect_diacritics(e), Q.suspect_inflections(e), Q.suspect_lemmas(e, spark.createDataFrame([("falo", "falar")], "tok string, lemma string"))])
    assert {(r.kind, r.entry, r.other) for r in found.collect()} == {("diacritic", "nao", "não"), ("inflected", "casas", "casa"), ("relemmatize", "falo", "falar")}
    white = spark.createDataFrame([("casas", "casa")], "a string, b string")
    assert Q.suspects([Q.suspect_inflections(e)], white).count() == 0
    with pytest.raises(ValueError):
        Q.enforce(found)
    Q.enforce(found.limit(0))
    both = Q.compare(e.filter("rank < 5"), e.filter("rank > 2").withColumn("rank", F.col("rank") + 1))
    assert rows(Q.comparison_scores(both)) == [(2, 2, 2, 2 / 6, 1.0)]
    merged = Q.merged_review(spark.createDataFrame([("a", "yes"), ("b", "no")], "k string, human string"), spark.createDataFrame([("b", 1), ("c", 2)], "k string, n long"), "k", ["human"])
    assert rows(merged) == [("a", None, "yes", "lost"), ("b", 1, "no", "kept"), ("c", 2, None, "new")]


def test_gold(spark):
    g = spark.createDataFrame([("a", " ", "x|y", "ok"), ("b", "human", "x", ""), ("c", "z", "x", "drop")], "tok string, human string, first string, verdict string")
    assert [r[0] for r in g.coalesce(1).select(Q.gold_answers(F.col("first"), F.col("human"), F.col("verdict"))).collect()] == [["x", "y"], ["human"], None]


def test_examples(spark):
    lines = spark.createDataFrame([("k", "UM DOIS TRÊS QUATRO"), ("k", "um dois três quatro"), ("k", "um dois três quatro cinco"), ("j", "só...")], "key string, line string")
    assert rows(E.choose(lines, "key", 1)) == [("j", 3, 1, "só..."), ("k", 1, 1, "um dois três quatro")]
    r = E.rescue(spark.createDataFrame([("dois três",), ("nada",)], "entry string"), lines.select("line"))
    assert {x.entry for x in r.collect()} == {"dois três"}
    replies = spark.createDataFrame([('{"gloss": "g", "example_pt": "- Olá tu", "example_en": "hi", "flags": ["a"]}', "end"), ("x", "end"), ("{}", "refusal"), ("{", "max_tokens")], "text string, stop string")
    assert [x.problem for x in E.parse_replies(replies.coalesce(1)).collect()] == [None, "bad_json", "refused", "truncated"]
    fixed = E.repair(spark.createDataFrame([("a", "Olá tu"), ("b", "made up"), ("c", "")], "key string, example_pt string"), spark.createDataFrame([("a", "- Olá tu"), ("b", "other")], "key string, line string"), "key")
    assert {x.key: (x.example_pt, x.repaired) for x in fixed.collect()} == {"a": ("- Olá tu", "anchored"), "b": ("", "dropped"), "c": ("", "none")}


def test_gates(spark):
    pub = spark.createDataFrame([("casa", "noun"), ("ver", "verb")], "lemma string, pos string")
    g = spark.createDataFrame([("casa", "noun", "house", "a casa é grande aqui", "the house is big", ["ok"]), ("casa", "noun", "House.", "inventada", "", ["odd"])], "lemma string, pos string, gloss string, example_pt string, example_en string, flags array<string>")
    found = E.gates(pub, g, spark.createDataFrame([("casa", "a casa é grande aqui")], "lemma string, line string"), ("ok",))
    assert {"coverage", "unique", "verbatim", "translated", "contains_entry", "known_flags", "capital", "ends_in_mark"} <= {r.gate for r in found.collect()}
    assert E.failed(found, 2) == sorted(E.FATAL)


def test_glue(spark):
    counts = spark.createDataFrame([("conheço-a", 200), ("conheçoa", 40), ("guarda-chuva", 500), ("roda-o", 300), ("rodao", 30), ("mata-o", 400), ("matao", 50)], "tok string, count long")
    casing = spark.createDataFrame([("matao", 40, 40, 1.0)], "tok string, cap_count long, noninitial_count long, cap_ratio double")
    got = FL.glue_candidates(counts, spark.createDataFrame([("rodao",)], "tok string"), casing)
    assert [(r.glued, r.stem, r.clitic) for r in got.collect()] == [("conheçoa", "conheço", "a")]


def test_readings(spark):
    tags = spark.createDataFrame([("larga", "largar", "VERB"), ("larga", "largo", "VERB"), ("larga", "largo", "ADJ"), ("mar", "mar", "NOUN"), ("são", "ser", "AUX"), ("vi", "mar", "VERB"), ("ter", "ter", "NOUN")], "tok string, lemma string, upos string")
    closed = spark.createDataFrame([("ser",)], "lemma string")
    keep = {(r.tok, r.lemma, r.upos): r.keep for r in R.consistent(tags, closed).collect()}
    assert keep == {("larga", "largar", "VERB"): True, ("larga", "largo", "VERB"): False, ("larga", "largo", "ADJ"): True, ("mar", "mar", "NOUN"): True, ("são", "ser", "AUX"): False, ("vi", "mar", "VERB"): False, ("ter", "ter", "NOUN"): True}
    assert {r.tok: r.keep for r in R.consistent(tags, closed, veto=False).collect()}["são"]
    assert {r.p for r in spark.createDataFrame([("SCONJ", "para"), ("SCONJ", "que"), ("X", "x")], "upos string, lemma string").select(R.pos_of().alias("p")).collect()} == {"prep", "conj", "unk"}
    pos = R.decided_pos(spark.createDataFrame([("no", "noun", 2), ("no", "prep", 3), ("a", "det", 1)], "lemma string, pos string, raw_freq long"), spark.createDataFrame([("no", "contr")], "lemma string, pos string"))
    assert rows(pos) == [("a", "det", 1), ("no", "contr", 5)]


def test_name_readings(spark):
    joint = spark.createDataFrame([("são", "ser", "AUX", 45), ("são", "são", "PROPN", 5), ("dado", "dado", "NOUN", 49), ("dado", "dado", "PROPN", 1), ("nova", "nova", "PROPN", 20), ("nova", "novo", "ADJ", 20)], "tok string, lemma string, upos string, votes long")
    casing = spark.createDataFrame([("são", 20, 1000), ("dado", 5, 100), ("nova", 90, 100)], "tok string, cap_count long, noninitial_count long")
    assert rows(R.name_cap_ratios(joint, casing)) == [("são", 0.2)]


def test_past_forms(spark):
    cases = [("Foi embora.", "foi", "ir"), ("Foi-se ontem", "foi", "ir"), ("Lá foi ele", "foi", "ir"), ("Quem foi?", "foi", "ser"), ("Fui à minha casa", "fui", "ir"), ("Foi a minha ideia", "foi", "ser"), ("Fomos a Lisboa", "fomos", "ir"), ("Foram comidos", "foram", "ser"), ("Fui comprar pão", "fui", "ir"), ("Foi isso", "foi", "ser"), ("Foi ontem", "foi", "?"), ("Nada", "foi", "?")]
    df = spark.createDataFrame([(*c, c[0].split()[-2:][0] in ("comprar",) or "comprar" in c[0], "adv") for c in cases], "s string, f string, want string, next_known boolean, next_pos string")
    assert [(r.s, r.got) for r in df.coalesce(1).select("s", R.past_form_class("s", "f").alias("got")).collect()] == [(c[0], c[2]) for c in cases]
    assert df.filter("f = 'fui'").select(R.next_word("s", "f").alias("w")).collect()[1].w == "comprar"
    assert R.may_apply({"accuracy": 0.96, "rule_digest": R.rule_digest(1)}, R.rule_digest(1)) and not R.may_apply({"accuracy": 0.96, "rule_digest": "x"}, R.rule_digest(1))


def test_backends(spark):
    words = spark.createDataFrame([("falo",), ("xis",)], "tok string")
    lines = spark.createDataFrame([("falo", "eu falo"), ("falo", "falo eu"), ("xis", "um xis")], "tok string, line string")
    known = spark.createDataFrame([("falar",)], "tok string")
    model = B.ModelSource(lambda: lambda pairs: ["falar" if w == "falo" else "xiar" for w, _ in pairs])
    table = B.TableSource(spark.createDataFrame([("xis", "x")], "tok string, lemma string"))
    assert rows(model(words, lines)) == [("falo", "falar"), ("xis", "xiar")]
    assert rows(B.GatedSource(model, table, known)(words, lines)) == [("falo", "falar"), ("xis", "x")]
    assert rows(B.VoteSource({"a": model, "b": table, "c": table})(words, lines)) == [("falo", "falo"), ("xis", "x")]


def test_names_and_escapes(spark):
    lines = spark.createDataFrame([(1, "Vi o John e a Mary."), (2, "Casa"), (3, "")], "k long, line string")
    known = spark.createDataFrame([("mary",)], "tok string")
    assert rows(E.name_shares(lines, known, ["k"]).select("k", "name_share")) == [(1, 1 / 6), (2, 0.0), (3, 0.0)]
    got = spark.createDataFrame([("a\\u00e3o \\u00zz x",), ("plain",)], "t string").coalesce(1).select(T.decode_escapes(F.col("t"))).collect()
    assert [r[0] for r in got] == ["aão \\u00zz x", "plain"]


def test_closure_of_long_chains_and_cycles(spark):
    chain = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(70)]
    cycle = [("c1", "c2"), ("c2", "c3"), ("c3", "c1"), ("x", "c2")]
    got = {r.src: r.final for r in L.closure(spark.createDataFrame(chain + cycle, "src string, dst string")).collect()}
    assert all(got[a] == "n070" for a, _ in chain) and {got[a] for a, _ in cycle} == {"c1"}
    assert L.closure(spark.createDataFrame([], "src string, dst string")).count() == 0


def test_contexts_shuffle_no_line_with_its_words(spark):
    """A line goes to its words by a hash: as a copy for each of its words, long lines filled the disk."""
    lines = spark.createDataFrame([(" ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 + k % 3)}" for i in range(200)),) for k in range(12)] + [("wa wa",)] * 3 + [("",), (None,)], "line string")
    words = spark.createDataFrame([("wab", 2), ("wac", 1), ("wa", 4), ("none", 3)], "tok string, size int")
    both = [C.contexts(lines, words), C.contexts(lines, words.withColumn("size", F.lit(4)))]
    for found in both:
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert not [x for x in plan.splitlines() if " Sort [tok" in x and "line#" in x]
    every = sorted((t, m, x.line) for x in lines.collect() if x.line for t in set(x.line.split()) for m in [hashlib.md5(f"{t}\x1f{x.line}".encode()).hexdigest()])
    sized = {"wab": 2, "wac": 1, "wa": 4}
    for found, size in zip(both, (sized, dict.fromkeys(sized, 4))):
        assert rows(found.select("tok", "digest", "line", "k")) == sorted(((t, m, line, k) for w in size for k, (t, m, line) in enumerate([e for e in every if e[0] == w][: size[w]], 1)), key=str)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pairs_make_tokens_once(spark):
    """Tokens were made for a filter and again for the pairs."""
    lines = spark.createDataFrame([("A casa a",), ("a",), ("",), ("a Casa",)], "line string")
    for df in (C.bigrams(lines), C.sides(lines)):
        assert plan_of(df).count("regexp_extract_all") == 1
    assert rows(C.bigrams(lines)) == [("a", "casa", 2), ("casa", "a", 1)]
    assert rows(C.sides(lines)) == [("a", 4, 2, 1), ("casa", 2, 1, 2)]


def test_margins_come_from_words(spark):
    """Sums over pairs shuffled all pairs twice more and made them again for each sum."""
    lines = spark.createDataFrame([("a b a b c",), ("b a",), ("c",), ("",), (None,), ("d d d",)], "line string")
    pairs, words = C.bigrams(lines), C.sides(lines)
    found = C.marginals(pairs, words)
    assert plan_of(found).count("inline(") == 1
    columns = ["left", "right", "count", "n_left", "n_right", "n"]
    assert rows(found.select(*columns)) == rows(C.marginals(pairs).select(*columns))
    few = C.marginals(pairs.filter("count >= 2"), words)
    assert rows(few.select(*columns)) == rows(found.filter("count >= 2").select(*columns))


@pytest.mark.parametrize("kind", ["min", "max", "left", "right"])
def test_shares_need_no_margins(spark, kind):
    lines = spark.createDataFrame([("a b a b c",), ("b a",), ("c",)], "line string")
    pairs, counts = C.bigrams(lines), C.unigrams(lines).filter("tok != 'c'")
    found = C.shares(pairs, counts, kind)
    assert plan_of(found).count("inline(") == 1
    assert rows(found.select("left", "right", "share")) == rows(C.collocations(pairs, counts, kind).select("left", "right", "share"))


def test_strong_collocations_are_all(spark):
    """Pairs that their count alone keeps from the limits are left out before the joins, and no others."""
    rng = random.Random(3)
    text = [" ".join(rng.choice("ab cd ef gh ij kl mn op qr st uv wx yz".split()) + rng.choice(["", "", "x", "y"]) for _ in range(rng.randrange(12))) for _ in range(900)]
    text += [f"once{chr(97 + i)} only{chr(97 + i)}" for i in range(5)] + [f"twice{chr(97 + i)} it{chr(97 + i)}" for i in range(5)] * 3
    lines = spark.createDataFrame([(x,) for x in text], "line string")
    pairs, words = C.bigrams(lines), C.sides(lines)
    every = C.collocations(pairs, words)
    for g2, share in ((1, 0.01), (20, 0.02), (23, 0.001), (30, 0.05), (60, 0.3), (5000, 0.05)):
        some = C.strong_collocations(pairs, words, g2, share)
        want = rows(C.retained(every, None, g2, share).select("mwe", "raw_freq", F.round("g2", 6), "share"))
        assert rows(C.retained(some, None, g2, share).select("mwe", "raw_freq", F.round("g2", 6), "share")) == want
    assert C.strong_collocations(pairs, words, 30, 0.05).count() < pairs.count()
