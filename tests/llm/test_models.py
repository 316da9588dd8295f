"""Language ID, quality rules and licences: gradients, held-out accuracy, edge cases."""

import random
import re
import zlib

import numpy as np

from corpusloom.llm import langid, licences, quality

DATA = "/root/testdata/sf0.01"
EDGES = [(9001, None), (9002, ""), (9003, " \n12 !?"), (9004, "!" * 50), (9005, "word " * 50_000), (9006, "日本語"), (9006, "日本語")]


def test_gradients():
    net = langid.Network(["a", "b", "c"], hidden=4)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    codes, label = np.random.default_rng(1).integers(90, 100, (5, 6)), np.array([0, 1, 2, 1, 0])

    def loss():
        p = net.positions(codes)
        return -np.log(p[:, np.arange(5), label]).mean()

    for k, g in net.gradients(codes, label).items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old = net.w[k][at]
        net.w[k][at] = old + 1e-4
        up = loss()
        net.w[k][at] = old - 1e-4
        down = loss()
        net.w[k][at] = old
        assert abs((up - down) / 2e-4 - g[at]) < 2e-3 * max(1e-2, abs(g[at])), k


def test_language(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    net = langid.train(docs)
    got = langid.op4_langid(spark, DATA).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.95 and len(got) == docs.count()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    edges = spark.createDataFrame([(*r, "x") for r in EDGES], "doc_id long, text string, score string")
    out = {r.doc_id: r for r in langid.identify(edges, net).collect()}
    assert all(out[i].lang_pred == "und" and out[i].score == 0 for i in (9001, 9002, 9003, 9004))
    assert out[9005].lang_pred in net.labels and 0 <= out[9005].score <= 1 and out[9006].lang_pred in net.labels
    assert sorted(r.doc_id for r in langid.accept(edges, net).collect()) == [9005, 9006, 9006]
    none = langid.train(docs.limit(0))
    assert {r.lang_pred for r in langid.identify(edges, none).collect()} == {"und"} and langid.identify(edges.limit(0), net).count() == 0


def test_parts_of_long_texts(monkeypatch):
    """Long texts are read in parts: the same labels and nearly the same scores."""
    net = langid.Network(["a", "b"])
    text = " ".join("".join(random.Random(i).choices("abcé", k=5)) for i in range(2000))
    whole = langid.Scorer(net).score([text, "x", None, text])
    monkeypatch.setattr(langid, "PIECE", 3000)
    parts = langid.Scorer(net).score([text, "x", None, text])
    assert [p[0] for p in parts] == [w[0] for w in whole] and np.allclose([p[1] for p in parts], [w[1] for w in whole], atol=2e-2)


def test_sums_agree_with_positions():
    net, rng = langid.Network(["a", "b", "c"], hidden=5), np.random.default_rng(2)
    codes, size = rng.integers(60, 200, (7, 20)).astype(np.uint8), np.array([20, 20, 13, 1, 8, 20, 5])
    padded = np.where(np.arange(20) < size[:, None], codes, 0)
    got = net.sums(np.ascontiguousarray(padded.T), size)
    for k, n in enumerate(size):
        p, c = net.positions(codes[k : k + 1, :n])[:, 0], langid.COUNTS[codes[k, :n]]
        assert np.allclose(got[k], np.r_[p[c].sum(axis=0), c.sum()], atol=1e-4)


def test_cuts_are_between_characters():
    texts = [("aé日😀" * 50).encode(), b"", b"x", "日".encode() * 100, b"y" * 300]
    raw, size = np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts])
    start, n, of = langid.cuts(raw, np.cumsum(size) - size, np.cumsum(size), 40)
    parts = [[], [], [], [], []]
    for s, m, k in zip(start, n, of, strict=True):
        assert 0 < m <= 40
        parts[k].append(raw[s : s + m].tobytes().decode().encode())
    assert [b"".join(p) for p in parts] == texts


def test_texts_without_blanks_and_of_two_languages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    net = langid.train(docs)
    rows = docs.filter("lang in ('en', 'de') and n_chars > 400").orderBy("doc_id").limit(40).collect()
    joined = [(r.lang, r.text.replace(" ", "")) for r in rows]
    got = langid.Scorer(net).score([t for _, t in joined])
    assert np.mean([p[0] == x for p, (x, _) in zip(got, joined, strict=True)]) > 0.8
    one = {x: next(r.text for r in rows if r.lang == x)[:400] for x in ("en", "de")}
    mixed, pure = langid.Scorer(net).score([one["en"] + " " + one["de"], one["en"]])
    assert mixed[0] in ("en", "de") and mixed[1] < pure[1]


def test_statistics_in_parts(monkeypatch):
    text = "One two, THREE!\nfour é 12\n\nOne two " * 50
    whole = quality.statistics(text)
    monkeypatch.setattr(quality, "PIECE", 7)
    assert np.allclose(quality.statistics(text), whole)
    assert len(quality.statistics(None)) == len(quality.STATISTICS) and quality.statistics("") == quality.statistics(None)


def test_quality(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.op2_quality(spark, DATA).join(labels.select("doc_id", "quality"), "doc_id", "left").toPandas()
    assert len(got) == docs.count() and got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.3)).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    held = got[got.held_out & got.quality.notna()]
    assert (held.predicted == held.quality).mean() > 0.93
    model = quality.fit(docs, labels)
    edges = spark.createDataFrame([(*r, 1.0) for r in EDGES], "doc_id long, text string, predicted double")
    assert quality.score(edges, model).count() == len(EDGES) and quality.score(edges.limit(0), model).count() == 0
    same = quality.fit(docs, labels.filter("quality = 1"))
    assert same.rules == [] and 0.5 < quality.score(edges, same).first().score < 1
    assert quality.fit(docs, labels.limit(0)).rules == []


def test_rules_and_columns_agree(spark):
    rng = np.random.default_rng(3)
    x = rng.random((400, len(quality.STATISTICS)))
    y = ((x[:, 0] > 0.5) & (x[:, 2] <= 0.7)).astype(float)
    rules = quality.grow(x, y, trees=5)
    at, w = quality.lasso(quality.holds(rules, x), y)
    model = quality.RuleModel([f"s{k}" for k in range(x.shape[1])], rules, at, w.tolist())
    rows = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"s{k} double" for k in range(x.shape[1])))
    got = [r[0] for r in rows.select(model.score()).collect()]
    assert np.allclose(got, 1 / (1 + np.exp(-(at + quality.holds(rules, x) @ w))), atol=1e-6) and ((np.array(got) > 0.5) == y).mean() > 0.95


def test_licences(spark):
    lines = {"gpl": "This work is licensed under the GNU General", "all-rights-reserved": "All rights reserved.", "cc-by-nc": "Licensed under CC BY-NC", "mit": "Released under the MIT License", "apache": "Licensed under the Apache"}
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = {r.doc_id: r for r in licences.op7_licences(spark, DATA).collect()}
    want = {r.doc_id: ",".join(sorted(k for k, t in lines.items() if any(x.startswith(t) for x in r.text.split("\n")))) for r in docs.collect()}
    assert {k: r.licences for k, r in got.items()} == want and any(want.values())
    model = licences.fit(docs)
    cases = {1: ("Licensed under the Mozilla Public License, version 2.0.", "mpl"), 2: ("Some words. Released under the BSD License.", "bsd"), 3: ("He had a licence to drive on the public road.", "unknown"), 4: (None, "unknown"), 5: ("", "unknown"), 6: ("plain " * 20_000, "unknown"), 7: ("All rights reserved.\nReleased under the MIT License.\n" * 2, None), 8: ("The GNU herd released the general.", "unknown")}
    rows = [(k, t, "z") for k, (t, _) in cases.items()] + [(5, "", "z"), (None, "Released under the MIT License.", "z")]
    out = {r.doc_id: r for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string, licence string"), model).collect()}
    assert {k: out[k].licence for k, (_, w) in cases.items() if w} == {k: w for k, (_, w) in cases.items() if w}
    assert out[7].licences == "all-rights-reserved,mit" and out[7].n_paragraphs == 4 and len(out) == len(cases) + 1 and out[None].licence == "mit"
    assert licences.scan(docs.limit(0), model).count() == 0 and licences.fit(docs.limit(0)).classes[-1] == "unknown"


def test_licence_passages(spark):
    """Wrapped notices, several families in a line, rows that share a doc_id, and sentences that are no notice."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = licences.fit(docs)
    mit = "Permission is hereby granted, free of charge, to any person obtaining\na copy of this software and associated documentation files,\nto deal in the Software without restriction"
    prose = docs.orderBy("doc_id").first().text
    cases = {1: (mit, "mit"), 2: ("All rights reserved. Released under the MIT License.", "all-rights-reserved,mit"), 3: ("Intro\n\n" + mit + "\n\nReleased under the BSD License.", "bsd,mit"), 4: ("Released under\n\nthe MIT License.", ""), 5: ("This program is free software: you can redistribute it\nand/or modify it under the terms of the GNU General Public\nLicense as published by the Free Software Foundation", "gpl"), 6: ("long words " * 30_000 + "\n\nReleased under the MIT License.", "mit"), 7: ("All of his rights were reserved for the public.\nThe software licence of the driver was granted.", "")}
    rows = [(k, t) for k, (t, _) in cases.items()] + [(8, "Released under"), (8, "the MIT License."), (None, mit), (9, None), (9, "\n\n \n")]
    out = [(r.doc_id, r.licences) for r in licences.scan(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, row int"), model).collect()]
    assert sorted(out, key=str) == sorted([(k, w) for k, (_, w) in cases.items()] + [(8, ""), (8, ""), (None, "mit"), (9, ""), (9, "")], key=str), prose[:10]


def test_unseen_wordings(spark):
    model = licences.fit(spark.read.parquet(f"{DATA}/documents.parquet"))
    found = ["This library is released under the terms of the MIT License.", "Code in this folder is licensed under the Apache License, Version 2.0.", "You may use it under the Mozilla Public License, version 2.0.", "Text is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "All images licensed under CC BY-NC 4.0.", "The tool is licensed under the GNU Lesser General Public License, version 2.1."]
    others = ["The general reserved all rooms of the public house.", "She had a licence and a version of the story.", "The foundation published the terms of the agreement in 2004.", "Free of charge to any person who works there.", "Subject to change without notice.", "The commons were granted to the university by the king."]
    out = {r.doc_id: r.licence for r in licences.scan(spark.createDataFrame(list(enumerate(found + others)), "doc_id long, text string"), model).collect()}
    assert [out[k] for k in range(6)] == ["mit", "apache", "mpl", "cc-by-sa", "cc-by-nc", "lgpl"] and {out[k] for k in range(6, 12)} == {"unknown"}


def test_no_python_runs_on_executors(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    plan = licences.scan(docs, licences.fit(docs))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|MapInArrow", plan)
