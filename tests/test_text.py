"""Column functions on literal rows."""

import unicodedata

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text as T


def run(spark, column, *values):
    rows = spark.createDataFrame([(v,) if not isinstance(v, tuple) else v for v in values], ", ".join(f"c{k} string" for k in range(len(values[0]) if isinstance(values[0], tuple) else 1)))
    return [r[0] for r in rows.coalesce(1).select(column).collect()]


def test_clean_and_tokens(spark):
    lines = ["<i>Olá</i>, Mundo!", "{\\an8}- Sim [MÚSICA] (baixo) ♪ não", "d’água guarda-chuva 123", ""]
    assert run(spark, T.tokens(T.clean(F.col("c0"))), *lines) == [["olá", "mundo"], ["sim", "não"], ["d'água", "guarda-chuva"], []]


def test_sentence_starts(spark):
    got = run(spark, T.tokens_with_starts(F.col("c0")), "um dois. três - quatro cinco-seis — sete")
    assert [(t.tok, t.starts) for t in got[0]] == [("um", True), ("dois", False), ("três", True), ("quatro", True), ("cinco-seis", False), ("sete", True)]


@pytest.mark.parametrize(("word", "parts"), [("da-me", ["da", "me"]), ("diz-lhe", ["diz", "lhe"]), ("dar-lhe-ia", ["daria", "lhe"]), ("fá-lo-ia", ["faria", "lo"]), ("guarda-chuva", ["guarda-chuva"]), ("conheço-a", ["conheço", "a"]), ("diz-me-a", ["diza", "me"]), ("casa", ["casa"]), ("dá-se-lhe", ["dá", "se", "lhe"])])
def test_clusters(spark, word, parts):
    assert run(spark, T.split_cluster(F.col("c0")), word) == [parts]


def test_stems(spark):
    got = run(spark, T.stem_candidates(F.col("c0"), F.col("c1")), ("fazê", "lo"), ("vamo", "nos"), ("da", "me"))
    assert got == [["fazêr", "fazer", "fazês", "fazes", "fazez", "fazêz"], ["vamos"], []]


def test_diacritics(spark):
    words = ["não", "difícil", "ação", "Ünïcode", "plain"]
    plain = lambda w: "".join(c for c in unicodedata.normalize("NFD", w) if not unicodedata.combining(c))
    assert run(spark, T.strip_diacritics(F.col("c0")), *words) == [plain(w) for w in words]


def test_inflections(spark):
    w = F.col("c0")
    assert run(spark, T.plural_forms(w), "mão", "inglês", "flor", "anel", "bem", "casa") == [["mões", "mães", "mãos"], ["ingleses"], ["flores"], ["aneis"], ["bens"], ["casas"]]
    assert [c[:1] for c in run(spark, T.singular_candidates(w), "ações", "ingleses", "flores", "bens", "casas", "os")] == [["ação"], ["inglês"], ["flor"], ["bem"], ["casa"], []]
    assert run(spark, T.gender_forms(w), "menino", "autor", "inglês", "coração") == [["menina"], ["autora"], ["inglesa"], []]
    assert run(spark, T.masculine_candidate(w), "inglesa", "autora", "menina", "sol") == ["inglês", "autor", "menino", None]
    assert run(spark, T.adjective_form(w), "educadas", "morta", "feliz") == ["educado", "morto", "feliz"]
    assert run(spark, T.participle_like(w, ("morto",)), "falado", "morta", "ada", "dá-lo") == [True, True, False, False]


def test_reform(spark):
    assert run(spark, T.reform_candidates(F.col("c0")), "acção", "idéia", "pêlo", "casa", "óptico", "acto facto") == [["ação"], ["ideia"], ["pelo"], [], ["ótico"], ["ato fato", "ato facto", "acto fato"]]


def test_diminutives(spark):
    got = run(spark, T.diminutive_of(F.col("c0"), F.col("c1")), ("coisinhas", "coisa"), ("caminho", "caminho"), ("tinha", "ter"), ("cafezinho", "café"))
    assert got == ["coisinha", None, None, "cafezinho"]


def test_display(spark):
    w = F.col("c0")
    assert run(spark, T.tidy(w), "- Olá", '"Sim."', "- - Não", "—", '- "A" e "B"') == ["Olá", "Sim.", "- - Não", "—", '"A" e "B"']
    assert run(spark, T.all_caps(w), "OLÁ Tu", "Olá", "123") == [True, False, False]
    assert run(spark, T.edge_ellipsis(w), "... sim", "sim…", "sim -", "sim.") == [True, True, True, False]
    assert run(spark, T.squeeze(w), " a  b\n c ") == ["a b c"]
    assert run(spark, T.band_label(F.col("c0").cast("int")), "1", "500", "501") == ["0001-0500", "0001-0500", "0501-1000"]
