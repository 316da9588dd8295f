"""SimHash, embeddings, components and shards against brute force."""

import random
import zlib
from collections import Counter
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash

import corpus_pipeline
from corpusloom.llm import buckets, components, embeddings, near_copies, sharding, simhash

DOCS = "doc_id long, text string"


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_of(nodes, linked):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            m = min(label[a], label[b])
            changed |= label[a] != m or label[b] != m
            label[a] = label[b] = m
    return label


def test_fingerprints_and_groups(spark):
    random.seed(1)
    words = [f"w{i}" for i in range(60)]
    base = [random.choice(words) for _ in range(150)]
    rows = [(i, " ".join(base[:k] + [random.choice(words)] + base[k + 1 :])) for i, k in enumerate(random.choices(range(150), k=60))]
    rows += [(100 + i, " ".join(random.choices(words, k=random.randint(0, 80)))) for i in range(60)]
    rows += [(200, None), (201, ""), (202, " \t\n"), (203, "One two"), (204, "oNE TWO"), (205, "É"), (206, "é"), (7, rows[7][1]), (300, rows[3][1])]
    got = {r.doc_id: (r.fp & (1 << 64) - 1, r.component_id) for r in simhash.near_duplicates(spark.createDataFrame([(*r, "x") for r in rows], DOCS + ", component_id string")).collect()}
    want = {i: brute_fingerprint(t) for i, t in rows}
    ids = sorted(want)
    linked = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if (want[a] ^ want[b]).bit_count() <= 3]
    label = components_of(ids, linked)
    assert got == {i: (want[i], label[i]) for i in ids}
    assert simhash.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def test_rows_without_id(spark):
    """They link nothing, whether they share a class with others or form one of their own."""
    rows = [(None, "alone here with words"), (None, None), (3, "one two three four"), (None, "one two three four"), (4, "One two three four"), (None, "alone here with words")]
    got = sorted(((r.doc_id or 0, r.component_id or 0) for r in simhash.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()))
    assert got == [(0, 0)] * 4 + [(3, 3), (4, 3)]
    assert sorted(r.text or "" for r in simhash.keep_first(spark.createDataFrame(rows, DOCS)).collect()) == ["", "alone here with words", "alone here with words", "one two three four", "one two three four"]
    vec = [(None, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (2, [2.0, 4.0], 1), (None, [9.0, -1.0], 1), (2, [-1.0, 5.0], 1), (5, [-1.0, 5.0], 1)]
    got = sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in embeddings.near_vectors(spark.createDataFrame(vec, "vec_id long, embedding array<double>, label int")).collect())
    assert got == [(0, 0, 0, True), (0, 0, 0, True), (1, 1, 1, True), (2, 1, 1, False), (2, 1, 2, True), (5, 1, 2, False)]
    assert embeddings.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_very_long_text_and_clashing_columns(spark):
    long = "word " * 200_000
    rows = [(1, long, 7, "a"), (2, long + "x", 8, "b"), (None, long, 9, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp long, component_id string")
    assert {r.doc_id: r.fp for r in simhash.near_duplicates(docs.filter("doc_id is not null")).collect()} == {i: (lambda v: v - (1 << 64) if v >> 63 else v)(brute_fingerprint(t)) for i, t, *_ in rows[:2]}
    kept = near_copies.keep_first(docs)
    assert kept.columns == docs.columns and sorted((r.doc_id or 0, r.component_id) for r in kept.collect()) == [(0, "c"), (1, "a")] + [(2, "b")] * (kept.count() == 3)


def test_recall_by_band_of_cosine(spark):
    """Planted pairs of 0.93 to 0.99: at least 0.95 of each band is found, and nothing below the threshold."""
    rng, rows, want = np.random.default_rng(6), [], {}
    unit = lambda x: x / np.linalg.norm(x)
    for k, c in enumerate(np.repeat([0.925, 0.932, 0.945, 0.96, 0.985], 200)):
        a = unit(rng.standard_normal(64))
        o = rng.standard_normal(64)
        b = c * a + np.sqrt(1 - c * c) * unit(o - (o @ a) * a)
        rows += [(2 * k, a.tolist(), k % 3), (2 * k + 1, b.tolist(), k % 3)]
        want[2 * k] = c
    got = {r.vec_id: r.n_links for r in embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    for c in sorted(set(want.values())):
        share = np.mean([got[i] for i, x in want.items() if x == c])
        assert share == 0 if c < 0.93 else share >= 0.95, (c, share)


def test_trie_join_of_many_chunks(spark, monkeypatch):
    rng = np.random.default_rng(2)
    centre = rng.integers(0, 1 << 63)
    fps = {int(centre) ^ sum(1 << int(b) for b in rng.choice(20, rng.integers(0, 6), replace=False)) for _ in range(3000)} | {int(x) for x in rng.integers(0, 1 << 63, 500)}
    fp = np.array(sorted(fps), np.uint64)
    x, y = simhash.trie_join(fp, [0], [len(fp)])
    label = np.arange(len(fp))
    for i in range(len(fp)):
        near = np.flatnonzero(np.bitwise_count(fp ^ fp[i]) <= 3)
        m = label[near].min()
        for v in set(label[near].tolist()):
            label[label == v] = m
    own = np.arange(len(fp))
    own[x] = y
    assert (own == label).all()
    half = len(fp) // 2
    parts = [simhash.trie_join(fp, [0, half], [half, len(fp)]), simhash.trie_join(fp, [0], [half], [half], [len(fp)])]
    a, b = simhash.forest(len(fp), np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
    own = np.arange(len(fp))
    own[a] = b
    assert (own == label).all()


def test_within_keeps_what_other_chunks_need(spark):
    rng = np.random.default_rng(3)
    fps = sorted({int(x) for x in (rng.integers(0, 1 << 12, 6000) << 30)})
    rows = spark.createDataFrame([(f, k) for k, f in enumerate(fps)], "fp long, node long")
    old = simhash.CHUNK
    got = components.connected_components(simhash.near_links(rows))
    label = dict(got.collect())
    assert old == simhash.CHUNK and {label.get(k, k) for k in range(len(fps))} == {0}


def test_components(spark):
    edges = [(i + 1, i) for i in range(50)] + [(100, 101), (101, 102), (102, 100), (200, 200), (None, 5)]
    got = dict(components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {i: 0 for i in range(51)} | {i: 100 for i in (100, 101, 102)}
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_embeddings(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((30, 16))
    x = np.concatenate([base, base + 0.12 * rng.standard_normal(base.shape), base[:10]])
    rows = [(i, [float(v) for v in np.float32(r)], int(i % 3 == 0)) for i, r in enumerate(x)]
    rows += [(900, None, 1), (901, [], 1), (902, [0.0] * 16, 1), (903, [1.0, None] * 8, 1), (904, [float("nan")] * 16, 1), (905, rows[0][1], None), (906, [1.0], 0), (907, [2.0], 0), (908, [float("inf")] * 16, 1)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    fine = [r for r in rows if r[2] is not None and r[1] and None not in r[1] and all(map(np.isfinite, r[1])) and any(r[1])]
    cos = lambda a, b: len(a) == len(b) and np.dot(a, b) / np.sqrt(np.dot(a, a) * np.dot(b, b)) >= 0.93
    linked = [(a[0], b[0]) for k, a in enumerate(fine) for b in fine[k + 1 :] if a[2] == b[2] and cos(np.array(a[1]), np.array(b[1]))]
    label = components_of([r[0] for r in rows], linked)
    found = sum(got[r[0]][0] for r in rows)
    assert found <= 2 * len(linked) and found >= 0.9 * 2 * len(linked) and linked
    for i in (900, 901, 902, 903, 904, 905, 908):
        assert got[i] == (0, i, True)
    assert got[906][0] == 1 and got[907][1] == 906 and not got[907][2]
    assert all(got[i][1] >= label[i] for i in label)


def test_blocks_of_a_large_bucket(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = np.float32(rng.standard_normal(8) + 0.02 * rng.standard_normal((2500, 8)))
    got = embeddings.near_vectors(spark.createDataFrame([(i, r.tolist(), 1) for i, r in enumerate(x)], "vec_id long, embedding array<float>, label int")).toPandas()
    assert (got.n_links == 2499).all() and (got.component_id == 0).all()


def test_shards(spark):
    rows = [(i, f"text {i % 97 if i % 3 else 0}") for i in range(1000)] + [(1000, None), (1001, ""), (1002, "é"), (5, "text 5")]
    got = sharding.assign(spark.createDataFrame([(*r, "q") for r in rows], DOCS + ", shard string")).toPandas()
    sizes = got.shard.value_counts()
    assert len(got) == len(rows) and len(sizes) == 40 and sizes.max() - sizes.min() <= 1
    assert all(sorted(g) == list(range(len(g))) for _, g in got.groupby("shard").slot)
    text = dict(rows)
    assert all(c == zlib.crc32((text[i] or "").encode()) and s == len((text[i] or "").encode()) + 16 for i, c, s in zip(got.doc_id, got.text_crc32, got["size"], strict=True) if i != 5)
    spread = got.assign(t=got.doc_id.map(text)).groupby("t").shard.agg(["nunique", "count"])
    # all rows are linked and shards are tiny, so there is little room to move
    assert spread["nunique"].sum() < 0.8 * spread["count"].clip(upper=40).sum()
    assert sharding.assign(spark.createDataFrame([], DOCS)).count() == 0


def test_labels_move_under_quotas(spark):
    schema = "g long, o int, b int, s int, n long"
    members = spark.createDataFrame([(1, 0, 0, 0, 10), (1, 1, 0, 1, 4), (2, 1, 0, 1, 3), (2, 2, 0, 2, 2)], schema)
    history = []
    assert sorted(sharding.propagate(members, 3, 100, history=history).collect()) == [(1, 0, 0, 0), (1, 1, 0, 0), (2, 1, 0, 1), (2, 2, 0, 1)]
    assert history[0] == 46 and history[-1] == 0
    full = []
    assert sorted(sharding.propagate(members, 3, 10, history=full).collect())[:2] == [(1, 0, 0, 0), (1, 1, 0, 1)]  # shard 0 is full


def edges_cut(got, text):
    spread = got.assign(t=got.doc_id.map(text)).groupby(["t", "shard"]).size()
    whole = spread.groupby("t").sum()
    return int((whole * (whole - 1) // 2).sum() - (spread * (spread - 1) // 2).sum())


def test_more_rounds_cut_fewer_edges(spark):
    """Groups of 3 to 8 and one of a third of all rows: cut edges fall from round to round and levelling keeps nearly all that is won."""
    rng, rows = random.Random(8), []
    while len(rows) < 1600:
        rows += [f"group {len(rows)}"] * rng.randint(3, 8) + ["alone %d" % len(rows)] * (rng.random() < 0.9)
    rows += ["hot"] * 800
    rng.shuffle(rows)
    text = dict(enumerate(rows))
    docs, cut, history = spark.createDataFrame(list(text.items()), DOCS), {}, []
    for rounds in (0, 1, sharding.ROUNDS):
        got = sharding.assign(docs, rounds=rounds, history=history if rounds > 1 else None).toPandas()
        sizes = got.shard.value_counts()
        assert len(sizes) == 40 and sizes.max() - sizes.min() <= 1 and all(sorted(g) == list(range(len(g))) for _, g in got.groupby("shard").slot)
        cut[rounds] = edges_cut(got, text)
    assert cut[0] > cut[1] > cut[sharding.ROUNDS]
    assert all(a > b for a, b in zip(history, history[1:], strict=False)) and len(history) > 2
    small = edges_cut(got[got.doc_id.map(text) != "hot"], text)
    assert small <= 0.4 * sum(n * (n - 1) // 2 for n in got.doc_id.map(text).value_counts() if n < 800)
    # a third of the rows, in all 40 shards at first, fills 14 at best
    assert got[got.doc_id.map(text) == "hot"].shard.nunique() <= 30


def test_levelled():
    rng = random.Random(3)
    for _ in range(50):
        count = [rng.randint(0, 9) for _ in range(rng.randint(1, 8))]
        first, target, over, gaps = sharding._levelled(count)
        seen, extra = [], 0
        for s, n in enumerate(count):
            seen += [(s, r) for r in range(min(n, target[s]))]
            for r in range(target[s], n):
                j = over[s] + r - target[s]
                assert j == extra
                extra += 1
                at = [g for g in gaps if g[0] <= j][-1]
                seen.append((at[1], at[2] + j - at[0]))
        assert sorted(seen) == [(s, r) for s in range(len(count)) for r in range(target[s])] and max(target) - min(target) <= 1


def test_shards_of_odd_rows(spark):
    rows = [(None, "a"), (None, None), (1, "x" * 500_000), (1, "x" * 500_000), (2, None), (3, "a")]
    got = sharding.assign(spark.createDataFrame([(*r, 4) for r in rows], DOCS + ", s int"), shards=3).toPandas()
    assert len(got) == 6 and got.shard.value_counts().tolist() == [2, 2, 2] and sorted(got["size"]) == [16, 16, 17, 17, 500_016, 500_016]
    assert got[got["size"] == 500_016].shard.nunique() == 1


def five_word_sets(rows):
    words = {i: t.lower().split() for i, t in rows}
    return {i: {" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, w in words.items()}


def test_pipeline_stage_finds_near_copies(spark):
    """Pairs of Jaccard 0.8 over five words differ in more than op10's three bits; those below it stay."""
    rng = random.Random(11)
    words, rows = [f"w{i}" for i in range(2000)], []
    for n in (12, 60, 250, 400):
        for _ in range(30):
            base = rng.choices(words, k=n)
            for changes in (0, 1, 2, n // 60, n // 20):
                text = list(base)
                for at in rng.sample(range(n), changes):
                    text[at] = rng.choice(words)
                rows.append((len(rows), " ".join(text)))
    hub = rng.choices(words, k=90)
    rows += [(len(rows) + k, " ".join(["new%d" % k, *hub])) for k in range(150)]
    sets, near = five_word_sets(rows), []
    for a in sets:
        near += [(a, b) for b in range(a + 1, len(rows)) if (n := len(sets[a] & sets[b])) and n >= 0.8 * (len(sets[a]) + len(sets[b]) - n)]
    label = components_of(sets, near)
    want = {i for i in sets if label[i] == i}
    docs = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id for r in corpus_pipeline.near_copies(spark, docs, "").collect()}
    assert got >= want and len(got - want) <= 0.01 * (len(rows) - len(want))
    assert {r.doc_id for r in simhash.keep_first(docs).collect()} - want  # op10's setting leaves some of them

    odd = [(None, "a b"), (1, None), (2, " "), (3, "A b"), (4, "a B"), (5, "x"), (5, "a b c d e f g"), (6, "a b c d e f g"), (None, None)]
    assert sorted((r.doc_id or 0, r.text or "") for r in corpus_pipeline.near_copies(spark, spark.createDataFrame(odd, DOCS), "").collect()) == sorted([(0, "a b"), (1, ""), (3, "A b"), (5, "x"), (5, "a b c d e f g"), (0, "")])
    assert corpus_pipeline.near_copies(spark, spark.createDataFrame([], DOCS), "").count() == 0


def test_near_copies_of_many_chunks():
    """Chunks of one group, joined with one another, give the components of the whole group."""
    rng = random.Random(12)
    base = rng.choices([f"w{i}" for i in range(500)], k=200)
    texts = [" ".join(base[:k] + ["x%d" % k] + base[k + 1 :]) for k in range(0, 200, 4)] + [" ".join(rng.choices(base, k=200)) for _ in range(10)]
    sets = [near_copies.shingles(t) for t in texts]
    rows = [near_copies.sketch(s).tobytes() + s.tobytes() for s in sets]
    g = np.zeros(60, np.int64)
    for join, data in ((near_copies.same_sets, rows), (partial(buckets.near_bits, near_copies.FEW), [r[:16] for r in rows])):
        links = list(zip(*(x.tolist() for x in join(g, data, [0], [60])[:2]), strict=True))
        assert components_of(range(60), links) == {i: 0 if i < 50 else i for i in range(60)}
        parts = []
        for s, e in ((0, 20), (20, 60)):
            parts += list(zip(*((x + s).tolist() for x in join(g, data[s:e], [0], [e - s])[:2]), strict=True))
        parts += list(zip(*(x.tolist() for x in join(g, data, [0], [20], [20], [60])[:2]), strict=True))
        assert components_of(range(60), parts) == {i: 0 if i < 50 else i for i in range(60)}


def test_near_copies_meet_by_their_simhashes():
    """The bits of SimHashes alone key the buckets, and nearly all pairs of Jaccard 0.8 share one; tables grow wider with the rows."""
    rng, pairs = random.Random(14), []
    for _ in range(300):
        base = [f"w{rng.randrange(10**6)}" for _ in range(400)]
        other = [*base[:357], *(f"w{rng.randrange(10**6)}" for _ in range(43))]
        a, b = near_copies.shingles(" ".join(base)), near_copies.shingles(" ".join(other))
        assert 0.8 <= near_copies.jaccard(a, b) < 0.82
        pairs.append((near_copies.sketch(a).tobytes(), near_copies.sketch(b).tobytes()))
    for n in (1000, 300_000):
        places = near_copies.tables(n)
        assert all(len(set(p)) == places.shape[1] for p in places.tolist())
        batch = pa.RecordBatch.from_arrays([pa.array(range(600)), pa.array([s for p in pairs for s in p], pa.binary())], names=["id", "data"])
        found = [(g, i // 2) for out in near_copies._deal(places, 0, iter([batch])) for g, i in zip(out["g"].to_pylist(), out["id"].to_pylist(), strict=True)]
        met = {pair for (_, pair), m in Counter(found).items() if m == 2}
        assert len(found) == 600 * len(places) and len(met) >= 297
    assert near_copies.tables(1000).shape[1] < near_copies.tables(300_000).shape[1]


def test_near_copies_link_groups_once():
    """Rows of groups that are linked already give no link among themselves, and one between two groups."""
    rng = np.random.default_rng(15)
    bits = rng.integers(0, 1 << 63, near_copies.WORDS).astype(np.int64)
    rows = [np.r_[bits ^ (np.int64(1) << np.int64(k % 60)), np.int64(7 if k < 40 else 9)].tobytes() for k in range(60)]
    for label, n in ((rows[:40], 0), (rows, 1)):
        u, v, _ = near_copies.near_others(near_copies.BUDGET, np.zeros(len(label), np.int64), label, [0], [len(label)])
        assert len(u) == len(v) == n
