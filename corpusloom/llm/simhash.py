"""SimHash near-dedup: fingerprints, a binary trie self-join and connected components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_digest

from .buckets import block_pairs, forest
from .common import arrow_map, checkpoint, table
from .components import connected_components

#: Words a shingle, seed of its hash, and differing bits that still link.
WIDTH, SEED, BUDGET = 3, 42, 3
#: Bit widths of the blocks a fingerprint is cut into. BUDGET differing bits touch at most 3 of the 5 blocks, so linked
#: fingerprints agree in 2 whole blocks: each pair of blocks is the root of a forest of tries.
BLOCKS = (13, 13, 13, 13, 12)
#: Fingerprints of one trie, shingles hashed at once, and node pairs traversed at once.
CHUNK, SHINGLES, FRONTIER = 4096, 1 << 14, 1 << 19


def simhash(text: str | None, width: int = WIDTH, seed: int = SEED) -> int:
    """64-bit SimHash of a text's word shingles, A-Z lower-cased; a text with fewer words than width has one shingle of
    all of them, a text without words has the fingerprint 0."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    if len(words) < width:
        words = [b" ".join(words)]
        width = 1
    n = len(words) - width + 1
    ones = np.zeros(64, np.int64)
    for at in range(0, n, SHINGLES):
        part = words[at : min(n, at + SHINGLES) + width - 1]
        shingles = map(b" ".join, zip(*(part[k : len(part) - width + 1 + k] for k in range(width)), strict=True))
        hashes = np.frombuffer(b"".join(map(xxh64_digest, shingles, repeat(seed))), np.uint8).reshape(-1, 8)
        ones += np.unpackbits(hashes, axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """(doc_id, fp): the SimHash of every row's whole text as a signed long. A null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([simhash(t.as_py(), width, seed) for t in b.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(fp)], names=["doc_id", "fp"])

    return arrow_map(docs.select("doc_id", "text"), run, "doc_id long, fp long")


def trie_join(fp: np.ndarray, lo, hi, lo2=None, hi2=None, budget: int = BUDGET) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (indexes into fp) of all pairs within budget differing bits.

    fp: unsigned fingerprints, ascending and distinct within each range. Each [lo, hi) is the root of a binary trie: a trie node is the range of fingerprints with a
    common prefix, its children are the parts before and after the first one with the next bit set. Pairs of nodes (of a root with itself, or
    of [lo, hi) with [lo2, hi2)) are traversed together, adding up the bits in which they differ, and dropped beyond
    the budget. Of the pairs found only a spanning forest is kept, so the result is never larger than the input.
    """
    n, ones = len(fp), {}
    a0, a1 = np.asarray(lo, np.int64), np.asarray(hi, np.int64)
    b0, b1 = (a0, a1) if lo2 is None else (np.asarray(lo2, np.int64), np.asarray(hi2, np.int64))
    stack = [(63, a0, a1, b0, b1, np.zeros(len(a0), np.int8))]
    found, held = [], 0
    node, root = np.empty(0, np.int64), np.empty(0, np.int64)

    def settle():
        nonlocal node, root, held
        node, root = forest(n, np.concatenate([node, *(x for x, _ in found)]), np.concatenate([root, *(y for _, y in found)]))
        found.clear()
        held = 0

    while stack:
        bit, a0, a1, b0, b1, d = stack.pop()
        if len(a0) > FRONTIER:
            half = len(a0) // 2
            stack += [(bit, *(x[:half] for x in (a0, a1, b0, b1, d))), (bit, *(x[half:] for x in (a0, a1, b0, b1, d)))]
            continue
        same = (a0 == b0) & (a1 == b1)
        live = (a1 > a0) & (b1 > b0) & (d <= budget) & ~(same & (a1 - a0 == 1))
        leaf = live & (a1 - a0 == 1) & (b1 - b0 == 1)
        if leaf.any():
            x, y = a0[leaf], b0[leaf]
            near = np.bitwise_count(fp[x] ^ fp[y]) <= budget
            found.append((x[near], y[near]))
            held += int(near.sum())
            if held > 1 << 20:
                settle()
        live &= ~leaf
        if not live.any():
            continue
        a0, a1, b0, b1, d, same = (x[live] for x in (a0, a1, b0, b1, d, same))
        if bit not in ones:
            ones[bit] = np.concatenate([[0], np.cumsum((fp >> np.uint64(bit)) & np.uint64(1))]).astype(np.int64)
        c = ones[bit]
        am, bm = a1 - (c[a1] - c[a0]), b1 - (c[b1] - c[b0])
        other = ~same
        stack.append((bit - 1, *(np.concatenate(x) for x in ((a0, am, a0, am[other]), (am, a1, am, a1[other]), (b0, bm, bm, b0[other]), (bm, b1, b1, bm[other]), (d, d, d + 1, d[other] + 1)))))
    settle()
    return node, root


def _links(ids, x, y) -> list:
    n = len(x)
    null, none = pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())
    return [pa.array(ids[x]), pa.array(ids[y]), null, null, null, null, null, none, none]


OUT = "u long, v long, g long, part long, seq long, low long, mask long, fps binary, ids binary"
NAMES = [x.split()[0] for x in OUT.split(", ")]


def _within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Self-joins of the tries of one sorted partition (g, fp, id): links; and the chunks that other chunks of g may link with."""
    from pyspark import TaskContext

    part, seq, first = TaskContext.get().partitionId(), 0, True
    held: list[np.ndarray] = [np.empty((0, 3), np.int64)]
    count, again = 0, -1  # again: the g whose earlier rows are gone

    def done(rows: np.ndarray, last: bool):
        nonlocal seq, first, again
        if not len(rows):
            return
        g, fp, ids = rows[:, 0], np.ascontiguousarray(rows[:, 1]).view(np.uint64) ^ np.uint64(1 << 63), np.ascontiguousarray(rows[:, 2])
        start = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
        size = np.diff(np.r_[start, len(g)])
        lo = np.concatenate([np.arange(s, s + n, CHUNK) for s, n in zip(start[size > CHUNK], size[size > CHUNK], strict=True)] + [start[size <= CHUNK]])
        lo.sort()
        hi = np.r_[lo[1:], len(g)]
        x, y = trie_join(fp, lo[hi - lo > 1], hi[hi - lo > 1])
        yield pa.RecordBatch.from_arrays(_links(ids, x, y), names=NAMES)
        split = np.isin(g[lo], g[start[size > CHUNK]]) | (first & (g[lo] == g[0])) | (last & (g[lo] == g[-1])) | (g[lo] == again)
        if split.any():
            out = []
            for s, e in zip(lo[split], hi[split], strict=True):
                diff = int(fp[s] ^ fp[e - 1]).bit_length()
                mask = ((1 << 64) - 1) ^ ((1 << diff) - 1)
                signed = lambda v: v - (1 << 64) if v >> 63 else v
                out.append([None, None, int(g[s]), part, seq, signed(int(fp[s])), signed(mask), fp[s:e].tobytes(), ids[s:e].tobytes()])
                seq += 1
            types = [pa.int64()] * 7 + [pa.binary()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=NAMES)
        first, again = False, int(g[-1])

    for b in batches:
        held.append(np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns], axis=1).astype(np.int64))
        count += len(b)
        if count >= 1 << 16:
            rows = np.concatenate(held)
            cut = int(np.searchsorted(rows[:, 0], rows[-1, 0])) or len(rows) // CHUNK * CHUNK
            yield from done(rows[:cut], rows[0, 0] == rows[-1, 0])
            held, count = [rows[cut:]], len(rows) - cut
    yield from done(np.concatenate(held), True)


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joins of the tries of two chunks (fps, ids, fps2, ids2)."""
    for b in batches:
        for row in b.to_pylist():
            fps, ids = (np.concatenate([np.frombuffer(row[k], t), np.frombuffer(row[k + "2"], t)]) for k, t in (("fps", np.uint64), ("ids", np.int64)))
            n = len(row["fps"]) // 8
            x, y = trie_join(fps, [0], [n], [n], [len(fps)])
            yield pa.RecordBatch.from_arrays([pa.array(ids[x]), pa.array(ids[y])], names=["u", "v"])


def near_links(classes: DataFrame, budget: int = BUDGET) -> DataFrame:
    """(u, v): links that connect all rows of classes (fp, node), distinct in fp, whose fingerprints differ in at most budget (3) bits.

    Each fingerprint goes to a trie for each pair of blocks. Tries are laid out by range of (trie, fingerprint), so one
    that holds a large part of the rows spreads over many tasks as chunks of at most CHUNK rows; chunks of one trie are
    joined in pairs, except where their common prefixes already differ in more bits than the budget.
    """
    at, fields = 0, []
    for w in BLOCKS:
        fields.append(F.shiftrightunsigned("fp", 64 - at - w).bitwiseAND(F.lit((1 << w) - 1)))
        at += w
    keys = [(fields[i] + fields[j] * (1 << 13) + F.lit(k << 26)) for k, (i, j) in enumerate(combinations(range(len(BLOCKS)), 2))]
    # the sign is turned so that signed order is the order of the unsigned values
    rows = classes.select(F.explode(F.array(*keys)).alias("g"), F.col("fp").bitwiseXOR(F.lit(-(1 << 63))).alias("fp"), F.col("node").alias("id"))
    found = checkpoint(arrow_map(rows.repartitionByRange("g", "fp").sortWithinPartitions("g", "fp"), _within, OUT))
    pairs = block_pairs(found.filter("g is not null").select(*NAMES[2:]), f"bit_count((low ^ low2) & (mask & mask2)) <= {budget}", ("low", "mask"))
    return found.filter("u is not null").select("u", "v").union(arrow_map(pairs.select("fps", "ids", "fps2", "ids2"), _across, "u long, v long"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) for every row of docs (doc_id, text).

    component_id is the smallest doc_id reachable over links. Rows that share a doc_id are one document, and equal
    fingerprints are one class before anything is paired, so copies cost one row of an aggregate each. Null and empty
    texts have the fingerprint 0. A row without doc_id links nothing and has no component_id. An empty table gives no rows; other columns are ignored.
    """
    fps = checkpoint(fingerprints(docs))
    known = fps.filter("doc_id is not null")
    classes = checkpoint(known.groupBy("fp").agg(F.min("doc_id").alias("node")))
    # a doc_id in several rows links its classes too
    same = known.groupBy("doc_id").agg(F.min("fp").alias("a"), F.max("fp").alias("b"), F.count("*").alias("n")).filter("n > 1 and a != b").select("doc_id")
    again = known.join(same, "doc_id", "left_semi").join(classes, "fp").select(F.col("doc_id").alias("u"), F.col("node").alias("v"))
    comp = connected_components(near_links(classes).union(again))
    named = classes.join(comp, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return known.join(named, "fp").select("doc_id", "fp", "component_id").union(fps.filter("doc_id is null").select("doc_id", "fp", F.lit(None).cast("long")))


def keep_first(docs: DataFrame) -> DataFrame:
    """docs without the documents that are near copies of one with a smaller doc_id; rows without doc_id stay."""
    gone = near_duplicates(docs).filter("doc_id != component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def op10_simhash(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
