"""Text normalisation, tokens and word forms as Spark columns."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Artifact patterns of subtitle lines, in the order they are applied.
ARTIFACTS = (r"<[^>]{1,40}>", r"\{[^}]{1,40}\}", r"\[[^\]]{1,60}\]", r"\([^)]{1,60}\)", r"[♪♫♩ᴖ]", r"^\s*-+\s*")
# Word, sentence end between words, clitics, infixes of the split future.
WORD = r"\p{L}+(?:[-'’]\p{L}+)*"
SENTENCE_END = r"[.!?…]|(^|\s)-|-(\s|$)|[–—]"
CLITICS = ("lhes", "lhe", "nos", "vos", "los", "las", "lo", "la", "me", "te", "se", "os", "as", "o", "a", "no", "na", "nas")
INFIXES = ("ia", "iam", "ias", "iamos", "a", "ao", "as", "emos", "ei")
# Vowels whose accent an l-form clitic puts on a stem.
ACCENTED, PLAIN = "áéêíóô", "aeeioo"


def _longest_first(words) -> str:
    return "|".join(sorted(words, key=lambda w: (-len(w), w)))


CLUSTER = rf"^(.+?)((?:-(?:{_longest_first(CLITICS)}))+)(-(?:{_longest_first(set(INFIXES) - set(CLITICS))}))?$"


def strip_artifacts(line) -> Column:
    """Each artifact pattern replaced with a blank."""
    out = F.col(line) if isinstance(line, str) else line
    for p in ARTIFACTS:
        out = F.regexp_replace(out, p, " ")
    return out


def fold_apostrophes(line) -> Column:
    return F.translate(line, "’ʼ", "''")


def clean(line, lower: bool = True) -> Column:
    """Artifacts stripped, apostrophes folded, lower case."""
    out = fold_apostrophes(strip_artifacts(line))
    return F.lower(out) if lower else out


def tokens(line) -> Column:
    """Words of a cleaned line in order."""
    return F.regexp_extract_all(line, F.lit(WORD), 0)


def tokens_with_starts(line) -> Column:
    """Words of a cleaned line as structs tok, starts: first on the line, or after the end of a sentence."""
    gap = rf"([^\p{{L}}]*)({WORD})"
    gaps, words = F.regexp_extract_all(line, F.lit(gap), 1), F.regexp_extract_all(line, F.lit(gap), 2)
    return F.zip_with(F.transform(gaps, lambda g, i: (i == 0) | g.rlike(SENTENCE_END)), words, lambda s, w: F.struct(w.alias("tok"), s.alias("starts")))


def split_cluster(word) -> Column:
    """Parts of a hyphenated verb and clitic cluster; a word that is none stays whole.

    dar-lhe-ia becomes daria, lhe: with clitics and an infix the verb is put together again.
    """
    stem, run, infix = (F.regexp_extract(word, CLUSTER, k) for k in (1, 2, 3))
    parts = F.split(F.substr(run, F.lit(2)), "-")
    last = F.element_at(parts, -1)
    infixes = F.array(*(F.lit(x) for x in INFIXES))
    inner = F.concat(parts, F.when(infix != "", F.array(F.substr(infix, F.lit(2)))).otherwise(F.array().cast("array<string>")))
    tail = F.element_at(inner, -1)
    bare = F.when(F.right(stem, F.lit(1)).isin(*ACCENTED), F.concat(F.left(stem, F.length(stem) - 1), F.translate(F.right(stem, F.lit(1)), ACCENTED, PLAIN), F.lit("r"))).otherwise(stem)
    rejoined = F.concat(F.array(F.concat(bare, tail)), F.slice(inner, 1, F.size(inner) - 1))
    joins = (F.size(inner) > 1) & F.array_contains(infixes, tail)
    del last
    return F.when(F.regexp_like(word, F.lit(CLUSTER)), F.when(joins, rejoined).otherwise(F.concat(F.array(stem), inner))).otherwise(F.array(word))


def stem_candidates(stem, clitic) -> Column:
    """Spellings of the verb that a clitic changed, in the order they are tried."""
    base = F.concat(F.left(stem, F.length(stem) - 1), F.translate(F.right(stem, F.lit(1)), ACCENTED, PLAIN))
    l_form = F.array(*(F.concat(s, F.lit(e)) for s, e in ((stem, "r"), (base, "r"), (stem, "s"), (base, "s"), (base, "z"), (stem, "z"))))
    return F.when(clitic.isin("lo", "la", "los", "las"), l_form).when((clitic == "nos") & stem.endswith("mo"), F.array(F.concat(stem, F.lit("s")))).otherwise(F.array().cast("array<string>"))


def _folded() -> tuple[str, str]:
    """Latin letters with marks and what they are without, by canonical decomposition."""
    pairs = []
    for c in map(chr, [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]):
        d = "".join(x for x in unicodedata.normalize("NFD", c) if not unicodedata.combining(x))
        if d != c and len(d) == 1:
            pairs.append((c, d))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


MARKED, UNMARKED = _folded()


def strip_diacritics(word) -> Column:
    return F.translate(word, MARKED, UNMARKED)


# What is taken off a display line, layer by layer: a dialogue dash, and quotes around the whole.
LAYERS = (r"^[-–—]\s*([^-–—\s])", r'^"\s*([^"]*[^"\s])\s*"$', r"^“\s*([^“”]*[^“”\s])\s*”$", r"^«\s*([^«»]*[^«»\s])\s*»$")


def tidy(line, rounds: int = 3) -> Column:
    """A display line without a leading dialogue dash and without quotes around the whole, a few layers deep; never empty."""
    out = F.trim(line)
    for _ in range(rounds):
        for layer in LAYERS:
            out = F.regexp_replace(out, layer, "$1")
    return out


def decode_escapes(text) -> Column:
    """Each \\uXXXX of the basic plane as its character; anything else stays."""
    parts = F.split(text, r"\\u")
    shown = lambda p: F.concat(F.decode(F.unhex(F.left(p, F.lit(4))), "UTF-16BE"), F.substring(p, F.lit(5), F.length(p)))
    rest = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: F.when(F.regexp_like(p, F.lit("^[0-9a-fA-F]{4}")), shown(p)).otherwise(F.concat(F.lit("\\u"), p)))
    return F.concat(F.get(parts, F.lit(0)), F.array_join(rest, ""))


def squeeze(cell) -> Column:
    return F.trim(F.regexp_replace(cell, r"(?U)\s+", " "))


def all_caps(line) -> Column:
    """Over 60 % of the letters are capitals."""
    letters = F.length(F.regexp_replace(line, r"[^\p{L}]", ""))
    return F.coalesce(F.length(F.regexp_replace(line, r"[^\p{Lu}]", "")) > 0.6 * F.nullif(letters, F.lit(0)), F.lit(False))


def edge_ellipsis(line) -> Column:
    """Begins or ends in dots, or ends in a dash."""
    return F.regexp_like(F.trim(line), F.lit(r"^(\.\.\.|…)|(\.\.\.|…|[-–—])$"))


def singular(word) -> Column:
    return F.when(word.endswith("s") & (F.length(word) > 3), F.left(word, F.length(word) - 1)).otherwise(word)


def adjective_form(word) -> Column:
    s = singular(word)
    return F.when(s.endswith("a"), F.concat(F.left(s, F.length(s) - 1), F.lit("o"))).otherwise(s)


def participle_like(word, irregular: tuple[str, ...] = ()) -> Column:
    regular = F.regexp_like(word, F.lit("(ad|id|íd)(o|a|os|as)$"))
    listed = singular(word).isin(*irregular) | adjective_form(word).isin(*irregular) if irregular else F.lit(False)
    return (F.length(word) >= 4) & ~word.contains("-") & (regular | listed)


def _but(word, n: int) -> Column:
    return F.left(word, F.length(word) - n)


def plural_forms(word) -> Column:
    """Regular plurals of a lemma."""
    w = word
    return (
        F.when(w.endswith("ão"), F.array(*(F.concat(_but(w, 2), F.lit(e)) for e in ("ões", "ães", "ãos"))))
        .when(w.endswith("ês"), F.array(F.concat(_but(w, 2), F.lit("eses"))))
        .when(w.endswith("r") | w.endswith("z") | w.endswith("s"), F.array(F.concat(w, F.lit("es"))))
        .when(w.endswith("l"), F.array(F.concat(_but(w, 1), F.lit("is"))))
        .when(w.endswith("m"), F.array(F.concat(_but(w, 1), F.lit("ns"))))
        .otherwise(F.array(F.concat(w, F.lit("s"))))
    )


def singular_candidates(word) -> Column:
    """What a plural may be the plural of, in order; those whose own plurals lack the word are left out."""
    w, no = word, F.lit(None).cast("string")
    every = F.array(
        F.when(w.endswith("ões") | w.endswith("ães") | w.endswith("ãos"), F.concat(_but(w, 3), F.lit("ão"))).otherwise(no),
        F.when(w.endswith("eses"), F.concat(_but(w, 4), F.lit("ês"))).otherwise(no),
        F.when(w.endswith("es"), _but(w, 2)).otherwise(no),
        F.when(w.endswith("is"), F.concat(_but(w, 2), F.lit("l"))).otherwise(no),
        F.when(w.endswith("ns"), F.concat(_but(w, 2), F.lit("m"))).otherwise(no),
        _but(w, 1),
    )
    fits = F.filter(F.array_compact(every), lambda c: F.array_contains(plural_forms(c), w))
    return F.when(w.endswith("s") & (F.length(w) >= 3), fits).otherwise(F.array().cast("array<string>"))


def gender_forms(word) -> Column:
    w, no = word, F.lit(None).cast("string")
    return F.array_compact(F.array(
        F.when(w.endswith("o") & ~w.endswith("ão"), F.concat(_but(w, 1), F.lit("a"))).otherwise(no),
        F.when(w.endswith("or"), F.concat(w, F.lit("a"))).otherwise(no),
        F.when(w.endswith("ês"), F.concat(_but(w, 2), F.lit("esa"))).otherwise(no),
    ))


def masculine_candidate(word) -> Column:
    w = word
    return F.when(w.endswith("esa"), F.concat(_but(w, 3), F.lit("ês"))).when(w.endswith("ora"), _but(w, 1)).when(w.endswith("a"), F.concat(_but(w, 1), F.lit("o")))


# The diminutive ending; spellings that a reform changed.
DIMINUTIVE = "^(.+?)(z?inh)([oa])s?$"
REFORM = (("cç", "ç"), ("pç", "ç"), ("ct", "t"), ("pt", "t"), ("éi", "ei"), ("ói", "oi"), ("ôo", "oo"), ("êe", "ee"))
DIFFERENTIAL = {"pêra": "pera", "pêras": "peras", "pólo": "polo", "pólos": "polos", "pêlo": "pelo", "pêlos": "pelos", "pára": "para"}


def diminutive_of(surface, lemma) -> Column:
    """The diminutive's own headword where the lemma is only its base, else null."""
    base, bare = strip_diacritics(F.regexp_extract(surface, DIMINUTIVE, 1)), strip_diacritics(lemma)
    hit = F.regexp_like(surface, F.lit(DIMINUTIVE)) & (F.length(base) >= 3) & bare.isin(base, F.concat(base, F.lit("o")), F.concat(base, F.lit("a")), F.concat(base, F.lit("e")))
    return F.when(hit, singular(surface))


def _at_each(word, old: str, new: str) -> Column:
    """word with old replaced at each of its places in turn."""
    at = F.filter(F.sequence(F.lit(1), F.greatest(F.length(word), F.lit(1))), lambda i: F.substring(word, i, F.lit(2)) == old)
    return F.transform(at, lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.lit(new), F.substring(word, i + 2, F.length(word))))


def reform_candidates(word) -> Column:
    """Newer spellings of an older one: all changes at once, then each accent, then each consonant at each place."""
    full = word
    for a, b in REFORM:
        full = F.replace(full, F.lit(a), F.lit(b))
    accents = [F.replace(word, F.lit(a), F.lit(b)) for a, b in REFORM[4:]]
    places = [_at_each(word, a, b) for a, b in REFORM[:4]]
    rules = F.filter(F.array_distinct(F.concat(F.array(full, *accents), *places)), lambda c: c != word)
    known = F.create_map(*(F.lit(x) for kv in DIFFERENTIAL.items() for x in kv))
    return F.when(known[word].isNotNull(), F.array(known[word])).otherwise(rules)


def band_label(rank, width: int = 500) -> Column:
    """0001-0500 and so on."""
    low = F.floor((rank - 1) / width) * width + 1
    return F.concat_ws("-", F.lpad(low.cast("string"), 4, "0"), F.lpad((low + width - 1).cast("string"), 4, "0"))


def tag_string(rank, pos, is_mwe, fixed: tuple[str, ...] = ()) -> Column:
    return F.concat_ws(" ", *(F.lit(t) for t in fixed), F.concat(F.lit("band::"), band_label(rank)), F.concat(F.lit("pos::"), pos), F.when(is_mwe, F.lit("mwe")))


def safe_key(text) -> Column:
    """A file name for a key: odd characters replaced, a digest against clashes."""
    return F.concat(F.regexp_replace(text, r"[^\p{L}\p{N}_-]", "_"), F.lit("-"), F.left(F.sha2(text, 256), F.lit(16)))


def digest(*parts) -> Column:
    """Order key of deterministic samples."""
    return F.md5(F.concat_ws("\x1f", *parts))
