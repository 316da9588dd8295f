"""Queries against DuckDB, the build, sources, sinks, configuration and streaming."""

import gzip

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from corpusloom.operators import counts as C
from corpusloom.plans import queries as Q
from corpusloom.plans.build import Inputs, build
from corpusloom.sources import cache, config, readers, sinks
from corpusloom.streaming import incremental

DATA = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def plain(rows, columns):
    show = lambda v: None if v is None or v is pd.NA or v != v else f"{float(v):.6g}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted(map(str, ([show(r[c]) for c in columns] for r in rows)))


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_query(spark, duck, name):
    got = Q.QUERIES[name](spark, DATA)
    want = duck.sql(Q.SQL[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    assert plain((r.asDict() for r in got.collect()), columns) == plain(want.to_dict("records"), columns)


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - set(Q.SQL)))
def test_query_without_sql(spark, name):
    Q.QUERIES[name](spark, DATA).collect()


def test_entry(spark):
    assert entry.entry(spark).count() == 1000 and set(Q.QUERIES) <= set(entry.queries())
    assert (entry.llm is not None) == any(k.startswith("op") for k in entry.queries())


def test_build(spark, tmp_path):
    text = ["A casa é grande.", "as casas são grandes", "Vi o John ontem.", "o John disse-lhe que não", "nao sei, não sei", "não não não não não não não não não"] * 30
    t = lambda r: spark.createDataFrame(r, "tok string, lemma string")
    lines = spark.createDataFrame([(x,) for x in text], "line string")
    known = spark.createDataFrame([(w,) for w in "a casa casas é grande grandes as são vi o ontem disse lhe que não sei ver ser saber dizer".split()], "tok string")
    lemmas = t([("casas", "casa"), ("grandes", "grande"), ("vi", "ver"), ("sei", "saber"), ("disse", "dizer"), ("são", "ser"), ("é", "ser")])
    cfg = config.Config().with_overrides({"mwe.min_word": 10, "mwe.min_g2": 50.0, "output.path": str(tmp_path)})
    made = build(Inputs(lines, known, lemmas), cfg)
    got = {r.lemma: r.raw_freq for r in made.entries.collect()}
    assert got["casa"] == 60 and got["ser"] == 60 and got["não"] == 360 and got["dizer"] == 30 and "lhe" in got
    assert "john" not in got and {(r.lemma, r.reason) for r in made.dropped.collect()} >= {("john", "proper_noun")}
    assert [(r.kind, r.entry, r.other) for r in made.suspects.collect()] == [("inflected", "as", "a")] and made.totals.first().lines == len(text)
    sinks.write_bands(made.entries, [(1, 5), (6, 10)], str(tmp_path / "out"))
    assert readers.read_table(spark, str(tmp_path / "out/band_00001_00005.tsv"), "entries").count() == 5
    sinks.write_lines(sinks.card_lines(made.entries, {"separator": "tab", "html": "false"}), str(tmp_path / "cards"))
    assert spark.read.text(str(tmp_path / "cards")).first().value == "#separator:tab"
    sinks.write_lines(sinks.dropped_lines(made.dropped), str(tmp_path / "dropped"))
    assert spark.read.text(str(tmp_path / "dropped")).first().value.startswith("# ")
    assert "| rank |" in sinks.markdown("List", [("Entries", made.entries)])


def test_sources(spark, tmp_path):
    with gzip.open(tmp_path / "lines.gz", "wb") as f:
        f.write("um\r\ndois \xff\n".encode("latin-1") + b"tr\xc3\xaas\n")
    assert [r.line for r in readers.read_lines(spark, str(tmp_path / "lines.gz")).orderBy("line_id").collect()] == ["um", "dois �", "três"]
    assert readers.read_lines(spark, str(tmp_path / "lines.gz"), sample=2, partitions=3).count() == 2
    (tmp_path / "over.tsv").write_text("# note\na\tb\n")
    over = readers.read_table(spark, str(tmp_path / "over.tsv"), "overrides", header=False, comment="#")
    assert [tuple(r) for r in over.collect()] == [("a", "b")]
    with pytest.raises(ValueError):
        readers.assert_matched(over, over.limit(0), ["tok"])
    calls = []
    make = lambda: calls.append(1) or over
    for _ in range(2):
        assert cache.cached(spark, str(tmp_path / "cache"), "t", cache.stamp(over), make).count() == 1
    assert len(calls) == 1


def test_config(tmp_path):
    cfg = config.Config()
    assert cfg.with_overrides({"mwe.min_g2": 5}).values["mwe"]["min_g2"] == 5 and cfg.digest("mwe") != cfg.with_overrides({"mwe.min_g2": 5}).digest("mwe")
    for bad in ({"mwe.nope": 1}, {"none.x": 1}):
        with pytest.raises(KeyError):
            cfg.with_overrides(bad)
    with pytest.raises(ValueError):
        cfg.with_overrides({"output.bands": [[1, 10], [12, 20]]})
    assert not config.Config(stage=1).fix("lemma_closure") and config.coerce("1") == 1 and config.coerce("x") == "x"
    (tmp_path / "c.json").write_text('{"mwe": {"min_g2": 7}}')
    assert config.load(str(tmp_path / "c.json"))["mwe"] == cfg["mwe"] | {"min_g2": 7}


def test_streaming(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k, text in enumerate(("a b a", "b c")):
        (tmp_path / "in" / f"{k}.txt").write_text(text + "\n")
        stream = spark.readStream.text(str(tmp_path / "in")).withColumnRenamed("value", "line")
        incremental.start(stream, str(tmp_path / "state"), str(tmp_path / "check")).awaitTermination()
    assert dict(incremental.read_state(spark, str(tmp_path / "state"), 2).collect()) == {"a": 2, "b": 2, "c": 1}
    lines = spark.createDataFrame([(f"casa {'x' * i}",) for i in range(1, 30)], "line string")
    words = spark.createDataFrame([("casa", 4)], "tok string, size int")
    parts = [C.contexts(lines.filter(f"length(line) % 2 = {k}"), words) for k in (0, 1)]
    assert sorted(incremental.merge_contexts(parts, 4).collect()) == sorted(C.contexts(lines, words).collect())
