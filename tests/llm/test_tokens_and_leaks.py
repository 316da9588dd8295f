"""BPE against the tokenizers library, decontamination against brute force, the pipeline and the entry point."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from corpusloom.llm import bpe, common, decontaminate

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = "aAbTthe'sS''llve  \n\t\x0b\x1c\x1f\x85\xa0éÉßΣσςİıǅ²½٣日本ｱé​😀!!..12<|endoftext|>"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_encoder(library):
    random.seed(1)
    enc = bpe.Encoder(bpe.Vocabulary(PATH), cache_words=300)
    texts = ["".join(random.choices(ODD, k=random.randint(0, 40))) for _ in range(2000)] + ["a<|endoftext|>B <|startoftext|>", " ", "aaaaaaaaaaaaaaaa", "ΑΣ ΟΔΟΣ", "x" * 500]
    for text in texts:
        words = [w for p in bpe.pieces(text, 50) for w in enc.words(p)]
        enc.learn(set(words))
        packed = b"".join(enc.ids[w] for w in words)
        ids = np.frombuffer(packed, "<u4").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids, text
        assert enc.shown(packed).decode() == library.decode(ids, skip_special_tokens=False)


def test_ranks_ascend():
    """A merge's parts are made before it, so active ranks can be applied in ascending order."""
    v, made = bpe.Vocabulary(PATH), {}
    for r, (m, a, b) in enumerate(zip(v.made, v.left, v.right, strict=True)):
        assert made.get(a, -1) < r and made.get(b, -1) < r
        made.setdefault(m, r)


def test_encode_rows(spark, library, monkeypatch):
    rows = [(1, "Hello, World!"), (2, None), (3, ""), (4, " \n"), (1, "Hello, World!"), (5, "long wörds " * 60_000), (6, "<|endoftext|>"), (None, "x")]
    got = bpe.encode(spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, n_tokens int"), bpe.Vocabulary(PATH), with_ids=True).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for doc, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        shown = library.decode(ids, skip_special_tokens=False)
        r = by[doc]
        assert (r.n_tokens, r.ids, r.decoded) == (len(ids), ids, shown)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest() and r.decoded_sha256 == hashlib.sha256(shown.encode()).hexdigest()
    assert bpe.encode(spark.createDataFrame([], "doc_id long, text string"), bpe.Vocabulary(PATH)).count() == 0


def brute(docs, items):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    windows = {}
    for i, t in items:
        w = split(t)
        m = min(8, len(w))
        for k in range(len(w) - m + 1 if m and i is not None else 0):
            windows.setdefault(tuple(w[k : k + m]), set()).add(str(i))
    out = []
    for d, t in docs:
        w, hit, found = split(t), set(), set()
        for m in {len(x) for x in windows}:
            for k in range(len(w) - m + 1):
                if x := windows.get(tuple(w[k : k + m])):
                    hit |= set(range(k, k + m))
                    found |= x
        out.append((d, len(w), len(hit), len(found), ",".join(sorted(found)), len(found) >= 2))
    return sorted(out, key=str)


@pytest.mark.parametrize("bounds", [{}, {"broadcast_rows": 0}])
def test_leaks(spark, bounds):
    random.seed(2)
    words = [random.choice(["ab", "CD", "é", "É", "x1", "yy", "K"]) + str(random.randint(0, 3)) for _ in range(40)]
    text = lambda n: " ".join(random.choices(words, k=n))
    items = [(k, text(random.choice([3, 8, 12, 30]))) for k in range(12)] + [(20, None), (21, ""), (22, "lone"), (23, "ab cd"), (None, text(9)), (24, "ab cd")]
    items += [items[3]]
    docs = [(i, text(random.randint(0, 30)) + random.choice([" ", "\n", " -- "]) + random.choice(items[:12])[1] + "; " + text(random.randint(0, 9))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "lone"), (103, "AB,cd!"), (5, docs[5][1]), (None, items[2][1]), (104, "word " * 20_000 + items[3][1])]
    got = decontaminate.decontaminate(spark.createDataFrame([(*r, "q") for r in docs], "doc_id long, text string, items string"), spark.createDataFrame(items, "item_id long, text string"), **bounds)
    rows = [(r.doc_id, r.n_words, r.n_hit, r.n_items, ",".join(r["items"]), r.contaminated) for r in got.collect()]
    assert sorted(rows, key=str) == brute(docs, items)


def test_no_leaks(spark):
    docs, none = spark.createDataFrame([(1, "a b c d e f g h i")], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminate(docs, none).first().n_items == 0
    assert decontaminate.decontaminate(docs.limit(0), spark.createDataFrame([(1, "a b")], "item_id long, text string")).count() == 0
    items = spark.createDataFrame([(1, "a"), (2, "b c d e f g h i")], "item_id long, text string")
    more = spark.createDataFrame([(1, "a x"), (2, "A b c d, e f g h i j"), (3, None)], "doc_id long, text string")
    assert sorted(r.doc_id for r in decontaminate.clean(more, items).collect()) == [1, 3]


def test_winnowing(spark):
    """About a third of the windows have a fingerprint of their own, and every window holds one; leaks survive changed words around them."""
    text = " ".join(f"w{i % 400}" for i in range(3000))
    rows = spark.createDataFrame([(1, text)], "doc_id long, text string").select("doc_id", decontaminate.words("text").alias("w"))
    at = sorted(r["at"] for r in decontaminate.selected(rows, [8]).select("at").collect())
    assert 0.25 < len(at) / 2993 < 0.45 and max(b - a for a, b in zip(at, at[1:], strict=False)) <= 5
    item = " ".join(f"q{i}" for i in range(40))
    docs = [(k, f"x y {' '.join(item.split()[k : k + 9])} z") for k in range(30)] + [(99, " ".join(["q1 q2 q3 q4"] * 6))]
    for bounds in ({}, {"broadcast_rows": 0}):
        got = {r.doc_id: r.n_hit for r in decontaminate.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string"), **bounds).collect()}
        assert got == {k: 9 for k in range(30)} | {99: 0}


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h", 1, "p", 3), (2, "x", 2, "q", 4)], "doc_id long, text string, _doc int, _hash string, at int")
    got = decontaminate.clean(docs, spark.createDataFrame([(1, "A b c d e f g h")], "item_id long, text string"))
    assert got.columns == docs.columns and [tuple(r) for r in got.collect()] == [(2, "x", 2, "q", 4)]


def test_clean_searches_for_short_items(spark):
    items = spark.createDataFrame([(1, "Who wrote Os Lusiadas?"), (2, "the"), (3, "red deer"), (4, "one two three four five six seven eight nine")], "item_id long, text string")
    docs = [(1, "the cat"), (2, "Asked: who wrote os Lusiadas"), (3, "the red deer"), (4, "red deer"), (5, "wrote os lusiadas"), (6, "two three four five six seven eight nine"), (7, "one two three four five six seven")]
    got = decontaminate.clean(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()
    assert sorted(r.doc_id for r in got) == [1, 4, 5, 7]
    shuffled = decontaminate.clean(spark.createDataFrame(docs, "doc_id long, text string"), items, broadcast_rows=0).collect()
    assert sorted(r.doc_id for r in shuffled) == [1, 4, 5, 7]


def test_pipeline(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        if k < 4:
            assert out.columns == columns
            docs = spark.createDataFrame(out.collect(), out.schema)
            assert 0 < docs.count() <= n
            n = docs.count()
    assert out.count() == n and corpus_pipeline.ORACLE_SQL is None
    assert corpus_pipeline.run(spark, sf_dir).count() == n


def test_pipeline_of_odd_rows(spark, tmp_path):
    """Nulls in every column, repeated rows, clashing columns, very long texts and an empty table."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    long = "Ein sehr langer Text mit vielen Wörtern und noch einem Satz. " * 4000
    odd = [(None, "A text of its own without an id, which nobody else has written in this way.", None, None, None), (None, None, None, None, None), (7_000_001, None, "en", "x", 0), (7_000_002, "", "en", None, 0), (7_000_003, long, "de", "x", len(long)), (7_000_004, "1234 !!", None, "x", 7)]
    odd += [(7_000_005, "Twice the same row with some plain words in it.", "en", "x", 47)] * 2
    schema = docs.schema
    more = docs.limit(150).union(spark.createDataFrame([tuple(r) for r in odd], schema))
    for name in ("_chunk", "_doc", "lang_pred", "fp", "row"):
        more = more.withColumn(name, more["n_chars"])
    spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    more.write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = [r.doc_id for r in got]
    assert ids.count(None) == 1 and 7_000_003 in ids and not {7_000_001, 7_000_002, 7_000_004} & set(ids)
    assert len(got) > 60
    more.limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    spark.read.parquet(str(tmp_path / "benchmark.parquet")).write.parquet(str(tmp_path / "none" / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


def test_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert {re.match(r"op\d+_", k)[0] for k in names if k.startswith("op")} == {f"op{k}_" for k in range(1, 11)} and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)


def test_workers_keep_only_what_the_running_operator_kept():
    common.KEPT.update(bpe=1, other=2)
    assert list(common.by_batches(iter, "bpe")([3, 4])) == [3, 4] and common.KEPT == {"bpe": 1}
    common.release()
    assert not common.KEPT


def test_batches_for_workers_are_bounded_by_bytes(spark):
    had = spark.conf.get(common.BATCH_BYTES, None)
    try:
        spark.conf.set(common.BATCH_BYTES, "32k")  # a bound of the session's own stays
        rows = spark.range(0, 200, 1, 1).selectExpr("id as doc_id", "repeat('word ', 1000) as text")
        sizes = [r.n for r in common.arrow_map(rows, lambda batches: (pa.record_batch({"n": [b.num_rows]}) for b in batches), "n long").collect()]
        assert sum(sizes) == 200 and max(sizes) < 20
        assert spark.conf.get(common.BATCH_BYTES) == "32k"
    finally:
        spark.conf.set(common.BATCH_BYTES, had or common.BATCH)
