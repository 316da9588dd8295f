"""Suffix-array and substring dedup against brute force."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from corpusloom.llm import substrings, suffix

DOCS = "doc_id long, text string"


def digest(b):
    return hashlib.sha256(b).hexdigest()


def brute_bytes(rows):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - 49) if i is not None else ():
            first[b[k : k + 50]] = min(i, first.get(b[k : k + 50], i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 49) if i is not None else ():
            if first[b[k : k + 50]] < i:
                gone[k : k + 50] = True
        out.append((i, len(b), int(gone.sum()), int((np.diff(np.r_[0, gone.view(np.int8)]) == 1).sum()), digest(np.frombuffer(b, np.uint8)[~gone].tobytes())))
    return sorted(out, key=str)


def brute_words(rows):
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - 19) if i is not None else ():
            x = tuple(w[k : k + 20])
            first[x] = min((i, k), first.get(x, (i, k)))
    out = []
    for i, w in split:
        gone = np.zeros(len(w), bool)
        for k in range(len(w) - 19) if i is not None else ():
            if first[tuple(w[k : k + 20])] < (i, k):
                gone[k : k + 20] = True
        out.append((i, len(w), int(gone.sum()), digest(b" ".join(x for x, g in zip(w, gone, strict=True) if not g))))
    return sorted(out, key=str)


def byte_rows():
    random.seed(3)
    base = "".join(random.choice("abcdé ") for _ in range(400))
    rows = []
    for i in range(200):
        s = "".join(random.choice("ab") for _ in range(random.randint(0, 80)))
        if random.random() < 0.7:
            x = random.randint(0, 330)
            s += base[x : x + random.randint(40, 120)]
        s += "x" * random.randint(0, 150) * (random.random() < 0.3) + "".join(random.choice("abc") for _ in range(random.randint(0, 60)))
        rows.append((i, s))
    return [*rows, (300, None), (301, ""), (302, rows[5][1]), (303, rows[5][1]), (5, rows[5][1]), (304, "short"), (305, "short"), (306, base), (306, base + "zz"), (None, base)]


def word_rows():
    random.seed(5)
    words = [f"w{i}é" for i in range(30)]
    base = random.choices(words, k=300)
    rows = []
    for i in range(150):
        w = random.choices(words, k=random.randint(0, 40))
        for _ in range(random.randint(0, 3)):
            x = random.randint(0, 260)
            w += base[x : x + random.randint(10, 50)] + random.choices(words, k=random.randint(0, 15))
        rows.append((i, " ".join(w + ["rep"] * random.randint(0, 50) * (random.random() < 0.2)) + random.choice(["", "\n", "\x0b "])))
    return [*rows, (300, None), (301, ""), (302, rows[5][1]), (303, rows[5][1]), (5, rows[5][1]), (None, " ".join(base)), (400, " ".join(base + base)), (400, " ".join(base))]


@pytest.mark.parametrize("sizes", [{}, {"hot": 1}, {"chunk_bytes": 1000, "bucket_bytes": 3000}, {"chunk_bytes": 1000, "bucket_bytes": 3000, "hot": 2}, {"chunk_bytes": 300, "bucket_bytes": 9000, "hot": 9}])
def test_bytes(spark, sizes):
    rows = byte_rows()
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], DOCS + ", chunk long, _x string")
    got = sorted((tuple(r) for r in suffix.spans(docs, **sizes).drop("text_hash", "spans").collect()), key=str)
    assert got == brute_bytes(rows)


def test_no_bytes(spark):
    assert suffix.spans(spark.createDataFrame([], DOCS)).count() == 0
    assert substrings.repeats(spark.createDataFrame([], DOCS)).count() == 0


def test_colliding_hashes(monkeypatch):
    """With a useless hash the order and the classes come from the codes themselves."""
    rng = np.random.default_rng(1)
    rows = rng.integers(1, 3, (200, 12)).astype(np.uint16)
    monkeypatch.setattr(suffix, "prefix_hashes", lambda r: np.zeros((len(r), r.shape[1] + 1), np.uint64))
    s = suffix.SuffixSort(rows, np.repeat([0, 1], 100))
    for part in (s.order[:100], s.order[100:]):
        assert [tuple(r) for r in rows[part]] == sorted(tuple(r) for r in rows[part])
    assert [len(set(s.classes(d)[:100].tolist())) for d in (0, 3, 12)] == [len({tuple(r[:d]) for r in rows[:100]}) for d in (0, 3, 12)]


def test_contexts_whose_hashes_collide(monkeypatch):
    rng = np.random.default_rng(2)
    raw = rng.integers(97, 99, (60, suffix.WIDE)).astype(np.uint8)
    raw[30:] = raw[:30]
    full = np.full(60, suffix.LEFT, np.uint8), np.full(60, suffix.SPAN, np.uint8)
    doc = np.arange(60)
    want = suffix.resolve(raw, *full, doc)
    monkeypatch.setattr(suffix, "mix_bytes", lambda r: np.zeros(len(r), np.uint64))
    assert (suffix.resolve(raw, *full, doc) == want).all() and (want[30:] == (1 << suffix.LEFT + 1) - 1).all()


def test_text_left(spark):
    assert suffix.kept_text("aéb".encode(), np.array([0, 1, 0, 0], bool)) == "aéb"
    assert suffix.kept_text("aéb".encode(), np.array([0, 1, 1, 0], bool)) == "ab"
    long = "".join(random.Random(1).choices("abcdefgh ", k=200))
    docs = spark.createDataFrame([(1, "start " + long, "k", 206), (2, long + " own tail", "l", 209), (3, long, "m", 200), (4, None, "n", None), (5, "", "o", 0)], "doc_id long, text string, source string, n_chars long")
    got = {r.doc_id: r for r in suffix.remove(docs).collect()}
    assert set(got) == {1, 2, 4, 5} and got[1].text == "start " + long and got[2].text == " own tail" and got[2].n_chars == 9 and got[2].source == "l" and got[4].text is None


@pytest.mark.parametrize("sizes", [{}, {"chunk_bytes": 3000, "bucket_bytes": 5000}, {"chunk_bytes": 500, "bucket_bytes": 500}, {"chunk_bytes": 200, "bucket_bytes": 9000}, {"chunk_bytes": 200, "bucket_bytes": 9000, "hot": 0}, {"chunk_bytes": 200, "bucket_bytes": 3000, "hot": 4}])
def test_words(spark, sizes):
    rows = word_rows()
    docs = spark.createDataFrame([(*r, 1) for r in rows], DOCS + ", bucket long")
    got = sorted((tuple(r) for r in substrings.repeats(docs, **sizes).drop("removed").collect()), key=str)
    assert got == brute_words(rows)


def test_automaton():
    a = substrings.SuffixAutomaton()
    a.add([b"a", b"b", b"a", b"b", b"c"])
    a.add([b"b", b"c", b"a"])
    assert a.matches([b"a", b"b", b"c", b"a", b"x", b"b", b"c", b"a"]) == [1, 2, 3, 3, 0, 1, 2, 3]
    rng = random.Random(4)
    for _ in range(50):
        rows = [[rng.choice([b"x", b"y", b"z"]) for _ in range(rng.randint(0, 30))] for _ in range(5)]
        a, have = substrings.SuffixAutomaton(), set()
        for row in rows:
            probe = rng.choices([b"x", b"y", b"z"], k=40)
            longest = [max((n for n in range(e + 1) if tuple(probe[e + 1 - n : e + 1]) in have or not n), default=0) for e in range(40)]
            assert [min(m, e + 1) for e, m in enumerate(a.matches(probe))] == [max([n for n in range(1, e + 2) if tuple(probe[e + 1 - n : e + 1]) in have], default=0) for e in range(40)], longest
            a.add(row)
            have |= {tuple(row[s:e]) for s in range(len(row)) for e in range(s + 1, len(row) + 1)}


def test_automata_decide(spark, monkeypatch):
    """Matching statistics alone tell what goes: where an automaton finds nothing, no word is removed."""
    rows = [r for r in word_rows() if r[0] is not None]
    w = substrings.Words(pa.table({"_chunk": [0] * len(rows), "doc_id": [r[0] for r in rows], "text": [r[1] for r in rows]}), "_chunk")
    k = [i for i in range(len(w.lo)) if i % 3 == 0]
    segs = [w.text(w.lo[i], w.hi[i] + substrings.SPAN).split(b" ") for i in k]
    found, _ = substrings._shards(segs, w.doc[k], w.place[k], w.hash[k], np.zeros(len(k), bool))
    assert any(map(any, found))
    monkeypatch.setattr(substrings, "SHARD_WORDS", 50)  # many automata, the same result
    again, _ = substrings._shards(segs, w.doc[k], w.place[k], w.hash[k], np.zeros(len(k), bool))
    assert found == again
    monkeypatch.setattr(substrings.SuffixAutomaton, "matches", lambda self, words: [0] * len(words))
    none, _ = substrings._shards(segs, w.doc[k], w.place[k], w.hash[k], np.zeros(len(k), bool))
    assert not any(map(any, none))


def test_very_long_words_and_texts(spark):
    rows = [(1, "x" * 200_000 + " " + " ".join(f"v{i}" for i in range(30_000))), (2, " ".join(f"v{i}" for i in range(100, 29_000)) + " " + "x" * 200_000), (3, "y" * 300_000)]
    docs = spark.createDataFrame(rows, DOCS)
    assert sorted((tuple(r) for r in substrings.repeats(docs).drop("removed").collect()), key=str) == brute_words(rows)
    assert sorted((tuple(r) for r in suffix.spans(docs).drop("text_hash", "spans").collect()), key=str) == brute_bytes(rows)


def test_clashing_columns(spark):
    long = "".join(random.Random(1).choices("abcdefgh ", k=200))
    docs = spark.createDataFrame([(1, long, 5, "a"), (2, long + "tail", 6, "b"), (None, long, 7, "c")], "doc_id long, text string, _chunk int, _CHUNK_ string")
    assert sorted(map(tuple, suffix.remove(docs).collect()), key=str) == sorted([(1, long, 5, "a"), (2, "tail", 6, "b"), (None, long, 7, "c")], key=str)


def test_chunk_contexts_whose_hashes_collide(monkeypatch):
    rng = random.Random(9)
    base = "".join(rng.choices("ab", k=300))
    docs = pa.table({"c": [0] * 6, "doc_id": list(range(6)), "text": [base[k * 7 : k * 7 + 150] for k in range(6)]})
    none = pa.table({"kind": pa.array([], pa.int32()), "chunk": [], "bucket": [], "data": [], "more": []})

    def contexts():
        c = suffix.Chunk(docs, none, "c")
        monkeypatch.setattr(suffix, "codes", lambda *x: np.ones(len(c.entries.hash), np.uint8))
        c.contexts(1)
        return c, [c.ctx[i].tobytes() + c.inside[i].tobytes() for i in c.of]

    c, want = contexts()
    monkeypatch.setattr(suffix, "mix", lambda x: np.zeros(len(x), np.uint64))
    d, got = contexts()
    assert got == want and len(c.ctx) == len(d.ctx) > 1


def test_word_hashes():
    raw = b" aa b " + b"c" * 300_000 + b" aa " + b"d " * 100_000
    buf = np.frombuffer(raw, np.uint8)
    inside = np.r_[False, ~substrings.SPACE[buf], False]
    turn = np.flatnonzero(inside[1:] != inside[:-1])
    h = substrings.word_hashes(buf, turn[::2], turn[1::2])
    assert h[0] == h[3] and len(set(h[:4].tolist())) == 3 and len(set(h[4:].tolist())) == 1 and h[4] != h[1]


def test_common_anchors_cost_two_contexts(monkeypatch):
    """An anchor in very many chunks sends its context twice, not once a window."""
    text = "".join(random.Random(3).choices("abcdefgh ", k=4000))
    docs, none = pa.table({"c": [0], "doc_id": [1], "text": [text]}), pa.table({"kind": pa.array([], pa.int32()), "chunk": [], "bucket": [], "data": [], "more": []})
    c = suffix.Chunk(docs, none, "c")
    monkeypatch.setattr(suffix, "codes", lambda *x: np.full(len(c.entries.hash), 2, np.uint8))
    c.contexts(5)
    assert len(c.entries.at) < len(c.ctx) <= 2 * len(c.entries.at)
    found = np.zeros(len(text), np.int64)  # by window, the sides that find it
    for at, mask in zip(c.at, (suffix.possible(c.inside[:, : suffix.LEFT].sum(axis=1), c.inside[:, suffix.LEFT :].sum(axis=1)) & suffix.sides(c.side))[c.of], strict=True):
        found[at - np.flatnonzero(mask >> np.arange(suffix.LEFT + 1, dtype=np.uint32) & 1)] += 1
    assert (found[: len(text) - suffix.SPAN + 1] > 0).all() and not found[len(text) - suffix.SPAN + 1 :].any()


@pytest.mark.parametrize("sizes", [{"hot": 0, "crowd": 0}, {"hot": 0, "crowd": 3}, {"hot": 2, "crowd": 1}])
def test_bytes_of_crowded_anchors(spark, sizes):
    """Very common anchors whose longer grams have many contexts, met part by part and window by window."""
    rows = byte_rows()
    docs = spark.createDataFrame(rows, DOCS)
    got = sorted((tuple(r) for r in suffix.spans(docs, chunk_bytes=300, bucket_bytes=3000, **sizes).drop("text_hash", "spans").collect()), key=str)
    assert got == brute_bytes(rows)
