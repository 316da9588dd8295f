"""Sources of lemmas: tables, tags, or a model that runs where the data is."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import lemmas as L
from . import shares as S


class LemmaSource(Protocol):
    """Lemmas (tok, lemma) of words (tok), given their contexts (tok, line)."""

    def __call__(self, words: DataFrame, contexts: DataFrame) -> DataFrame: ...


class TableSource:
    """Lemmas from a table (tok, lemma); a word without one is its own."""

    def __init__(self, table: DataFrame):
        self.table = table

    def __call__(self, words: DataFrame, contexts: DataFrame) -> DataFrame:
        return words.select("tok").join(self.table, "tok", "left").select("tok", F.coalesce("lemma", "tok").alias("lemma"))


class TagSource:
    """The majority of tags (tok, lemma, keep), with inconsistent ones left out where others remain."""

    def __init__(self, tags: DataFrame):
        self.tags = tags

    def __call__(self, words: DataFrame, contexts: DataFrame) -> DataFrame:
        votes = self.tags.groupBy("tok", "lemma", "keep").agg(F.count("*").alias("votes"))
        return TableSource(S.filtered_majority(votes, ["tok"], "lemma", "keep"))(words, contexts)


class ModelSource:
    """A model over contexts: make() is called once in each task and gives a function from (tok, line) pairs to lemmas."""

    def __init__(self, make: Callable[[], Callable[[list[tuple[str, str]]], list[str]]]):
        self.make = make

    def __call__(self, words: DataFrame, contexts: DataFrame) -> DataFrame:
        make = self.make

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            model = make()
            for b in batches:
                yield pd.DataFrame({"tok": b["tok"], "lemma": model(list(zip(b["tok"], b["line"], strict=True)))})

        tags = contexts.select("tok", "line").mapInPandas(run, "tok string, lemma string").withColumn("keep", F.lit(True))
        return TagSource(tags)(words, contexts)


class GatedSource:
    """The first source's lemma where it is the word or in the dictionary (tok), else the second's."""

    def __init__(self, first: LemmaSource, second: LemmaSource, known: DataFrame):
        self.first, self.second, self.known = first, second, known

    def __call__(self, words: DataFrame, contexts: DataFrame) -> DataFrame:
        return L.dictionary_gate(self.first(words, contexts), self.second(words, contexts), self.known)


class VoteSource:
    """The lemma that most sources give, ties by their order."""

    def __init__(self, sources: dict[str, LemmaSource]):
        self.sources = sources

    def __call__(self, words: DataFrame, contexts: DataFrame) -> DataFrame:
        parts = [s(words, contexts).withColumn("backend", F.lit(name)) for name, s in self.sources.items()]
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.unionByName(p)
        return S.backend_vote(rows, {name: k for k, name in enumerate(self.sources)})
