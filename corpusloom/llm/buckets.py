"""Rows that share a bucket, met block by block.

A bucket of any size spreads over tasks: rows are laid out by range of (bucket, id), blocks are joined within themselves where they lie, and the
blocks of one bucket are joined in pairs, each pair a row of its own. Only spanning links and sums come back, so a bucket of m rows
gives a result of m rows, never of its pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_map, checkpoint

#: Rows and bytes of one block, and rows and bytes held at once.
BLOCK, BLOCK_BYTES, HELD, HELD_BYTES = 4096, 8 << 20, 1 << 16, 32 << 20
#: Of the bucket of each row, the rows' data, and ranges of rows (or two ranges to join): links (x, y, w) between rows; x = y carries a sum w alone.
Join = Callable[..., tuple[np.ndarray, np.ndarray, np.ndarray]]
OUT = "g long, u long, v long, w long, part long, seq long, ids binary, data array<binary>"
LINKS = "g long, u long, v long, w long"
LONG, BLOBS = pa.int64(), pa.list_(pa.binary())


def binaries(rows: np.ndarray) -> pa.Array:
    """A binary value for each row of rows [n, width] of bytes."""
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(rows.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def forest(n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node of its component) among n nodes for links a-b; nodes that are the smallest are left out."""
    label = np.arange(n)
    while len(a):
        x, y = label[a], label[b]
        if not (keep := x != y).any():
            break
        a, b, x, y = a[keep], b[keep], x[keep], y[keep]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(nxt := label[label], label):
            label = nxt
    node = np.flatnonzero(label != np.arange(n))
    return node, label[node]


def differ(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y).sum(axis=-1, dtype=np.int64)


def near_bits(few: int, g: np.ndarray, data: list[bytes], lo, hi, lo2=None, hi2=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spanning links of the pairs of each range (or of [lo, hi) with [lo2, hi2)) whose bits, all equally many words, differ in at most few."""
    n, x = len(data), np.frombuffer(b"".join(data), np.uint64).reshape(len(data), -1)
    node, root, found, held = np.empty(0, np.int64), np.empty(0, np.int64), [], 0
    if lo2 is None:
        end = np.zeros(n, np.int64)
        for s, e in zip(lo, hi, strict=True):
            end[s:e] = e
        steps = range(1, n)
    else:
        steps = range(lo[0], hi[0])
    at = np.arange(n)
    for d in steps:
        if lo2 is None:
            at = at[at + d < end[at]]
            if not len(at):
                break
            near = at[differ(x[at], x[at + d]) <= few]
            found.append((near, near + d))
        else:
            near = lo2[0] + np.flatnonzero(differ(x[lo2[0] : hi2[0]], x[d]) <= few)
            found.append((near, np.full(len(near), d)))
        held += len(near)
        if held > 1 << 20:
            node, root = forest(n, np.concatenate([node, *(a for a, _ in found)]), np.concatenate([root, *(b for _, b in found)]))
            found, held = [], 0
    u, v = forest(n, np.concatenate([node, *(a for a, _ in found)]), np.concatenate([root, *(b for _, b in found)]))
    return u, v, np.zeros(len(u), np.int64)


def _links(g: np.ndarray, ids: np.ndarray, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> list[pa.Array]:
    return [pa.array(np.asarray(c, np.int64)) for c in (g[x], ids[x], ids[y], w)]


def _within(join: Join, block: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links inside the blocks of one partition (g, id, data) sorted by g, and the blocks that others of their bucket may link with."""
    from pyspark import TaskContext

    names = [c.split()[0] for c in OUT.split(", ")]
    part, seq, first, again = TaskContext.get().partitionId(), 0, True, None  # again: the g whose earlier rows are gone

    def done(g: np.ndarray, ids: np.ndarray, data: list[bytes], last: bool) -> Iterator[pa.RecordBatch]:
        nonlocal seq, first, again
        if not len(g):
            return
        start = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
        of = np.repeat(np.arange(len(start)), np.diff(np.r_[start, len(g)]))
        size = np.cumsum([len(d) for d in data])
        full = (size - np.r_[0, size][start][of]) // BLOCK_BYTES
        at = (np.arange(len(g)) - start[of]) // block
        lo = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (full[1:] != full[:-1]) | (at[1:] != at[:-1])])
        hi = np.r_[lo[1:], len(g)]
        many = np.bincount(of[lo])[of[lo]] > 1
        x, y, w = join(g, data, lo[hi - lo > 1], hi[hi - lo > 1])
        if len(x):
            yield pa.RecordBatch.from_arrays([*_links(g, ids, x, y, w), *(pa.nulls(len(x), t) for t in (LONG, LONG, pa.binary(), BLOBS))], names=names)
        split = many | (first & (g[lo] == g[0])) | (last & (g[lo] == g[-1]))
        if again is not None:
            split |= g[lo] == again
        for s, e in zip(lo[split], hi[split], strict=True):
            row, types = [int(g[s]), None, None, None, part, seq, ids[s:e].tobytes(), data[s:e]], [*[LONG] * 6, pa.binary(), BLOBS]
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(row, types, strict=True)], names=names)
            seq += 1
        first, again = False, int(g[-1])

    g, ids, data, held = np.empty(0, np.int64), np.empty(0, np.int64), [], 0
    for b in batches:
        # a batch may hold many long rows
        for k in range(0, len(b), BLOCK):
            c = b.slice(k, BLOCK)
            g, ids = (np.concatenate([old, c.column(i).to_numpy(zero_copy_only=False)]) for i, old in ((0, g), (1, ids)))
            new = c.column(2).to_pylist()
            data += new
            held += sum(map(len, new))
            if len(g) >= HELD or held >= HELD_BYTES:
                cut = int(np.searchsorted(g, g[-1])) or len(g)
                yield from done(g[:cut], ids[:cut], data[:cut], g[0] == g[-1])
                g, ids, data = g[cut:], ids[cut:], data[cut:]
                held = sum(map(len, data))
    yield from done(g, ids, data, True)


def _across(join: Join, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between two blocks (g, ids, data, ids2, data2)."""
    for b in batches:
        for k in range(len(b)):
            (row,) = b.slice(k, 1).to_pylist()
            ids, n = np.frombuffer(row["ids"] + row["ids2"], np.int64), len(row["data"])
            g = np.full(len(ids), row["g"])
            x, y, w = join(g, row["data"] + row["data2"], [0], [n], [n], [len(ids)])
            yield pa.RecordBatch.from_arrays(_links(g, ids, x, y, w), names=["g", "u", "v", "w"])


def block_pairs(blocks: DataFrame, also: str = "true", extra: tuple[str, ...] = ()) -> DataFrame:
    """Pairs of blocks (part, seq, ...) of one g: their keys meet first, and the blocks are fetched for each pair. also: a condition on extra columns."""
    keys = blocks.select("g", "part", "seq", *extra)
    pairs = keys.join(keys.withColumnsRenamed({c: f"{c}2" for c in ("part", "seq", *extra)}), "g").filter("(part < part2 or part = part2 and seq < seq2)").filter(also).select("g", "part", "seq", "part2", "seq2")
    body = blocks.drop("g", *extra)
    other = body.withColumnsRenamed({c: f"{c}2" for c in body.columns})
    return pairs.join(body, ["part", "seq"]).join(other, ["part2", "seq2"])


def links(rows: DataFrame, join: Join, block: int = BLOCK) -> DataFrame:
    """(g, u, v, w): what join finds between rows (g, id, data) of one g, none of them null."""
    found = checkpoint(arrow_map(rows.select("g", "id", "data").repartitionByRange("g", "id").sortWithinPartitions("g", "id"), partial(_within, join, block), OUT))
    pairs = block_pairs(found.filter("part is not null").select("g", "part", "seq", "ids", "data")).select("g", "ids", "data", "ids2", "data2")
    return found.filter("u is not null").select("g", "u", "v", "w").union(arrow_map(pairs, partial(_across, join), LINKS))
