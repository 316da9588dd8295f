"""Anchors of long repeats: minimizer k-grams found in chunks of documents and counted by bucket.

A sequence of symbols (bytes or words) that is repeated over at least `span` symbols contains, in every window of span symbols, the window's
smallest k-gram hash. Such k-grams, the anchors, are chosen by content alone, so both copies choose the same ones.
Documents are dealt to chunks by doc_id; a chunk sends each bucket its distinct anchor hashes packed into one row, and
gets back as many codes. As the entries are ordered by hash, codes need no key. Chunks and buckets grow in number with the input and stay
the same in size; where a chunk has few anchors for each of very many buckets, rows are simply short.

An anchor that all chunks have is an entry a chunk. So chunks are dealt to parts: the entries of a bucket are first met part by part, where equal ones
become one, and then as a whole; neither meeting has more than about the square root of the chunks. What hot anchors send to their bucket goes the same way.
"""

from __future__ import annotations

from functools import partial
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, by_group, by_groups, text_bytes, unused

#: Name of the column that tells a document's chunk, unless the documents have one of that name.
CHUNK = "_chunk"
#: Chunks of a part, at least.
FAN = 16
#: Bytes of text a chunk and a bucket stand for, on average; symbols hashed at once.
CHUNK_BYTES, BUCKET_BYTES, BLOCK = 2 << 20, 4 << 20, 1 << 16
MIX1, MIX2, BASE = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer."""
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


def power(n: int) -> np.uint64:
    return np.uint64(pow(BASE, n, 1 << 64))


def gram_hashes(sym: np.ndarray, k: int) -> np.ndarray:
    """Polynomial hashes of all windows of k symbols, put together from windows of powers of two."""
    cur, n = sym.astype(np.uint64) + np.uint64(1), 1
    out, have = None, 0
    while True:
        if k & n:
            if out is None:
                out, have = cur, n
            else:
                m = len(cur) - have
                out, have = out[:m] * power(n) + cur[have : have + m], have + n
        if n * 2 > k:
            return mix(out)
        cur, n = cur[: len(cur) - n] * power(n) + cur[n:], n * 2


def sliding(x: np.ndarray, w: int, f) -> np.ndarray:
    """f (minimum or maximum) of every w neighbours."""
    n = 1
    while n * 2 <= w:
        x, n = f(x[: len(x) - n], x[n:]), n * 2
    return f(x[: len(x) - (w - n)], x[w - n :]) if w > n else x


def anchors(sym: np.ndarray, start: np.ndarray, span: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of the sequences that begin at start (ascending, the last is len(sym))."""
    w, at, val = span - k + 1, [], []
    room = np.ones(len(sym), bool)  # windows that lie within a sequence
    for s, e in zip(start[:-1].tolist(), start[1:].tolist(), strict=True):
        room[max(s, e - span + 1) : e] = False
    for a in range(0, len(sym), BLOCK):
        # windows that start in [a, a + BLOCK) choose among grams in [a, a + BLOCK + w - 1)
        part = sym[a : a + BLOCK + span - 1]
        if len(part) < span:
            break
        g = gram_hashes(part, k)
        low = np.where(room[a : a + len(g) - w + 1], sliding(g, w, np.minimum), np.uint64(0))
        most = sliding(np.concatenate([np.zeros(w - 1, np.uint64), low, np.zeros(w - 1, np.uint64)]), w, np.maximum)
        p = np.flatnonzero((most == g) & (g > 0))
        at.append(p + a)
        val.append(g[p])
    if not at:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at, val = np.concatenate(at), np.concatenate(val)
    if len(at):
        at, first = np.unique(at, return_index=True)
        val = val[first]
    return at, val


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


class Plan:
    """Numbers of chunks and buckets for an input."""

    def __init__(self, docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES):
        bound_batches(docs.sparkSession)
        total = text_bytes(docs)
        self.chunks, self.buckets = max(1, -(-total // chunk_bytes)), max(1, -(-total // bucket_bytes))
        self.fan = max(FAN, isqrt(self.chunks))
        self.parts = max(1, -(-self.chunks // self.fan))
        self.name = unused(CHUNK, docs.columns)

    def part(self, chunk: int) -> int:
        return chunk % self.parts

    def chunk(self) -> Column:
        """The chunk of a doc_id; rows of one doc_id share it."""
        return F.pmod(F.xxhash64("doc_id"), F.lit(self.chunks)).cast("long")

    def chunked(self, docs: DataFrame) -> DataFrame:
        """docs with their chunk as the first column, dealt by it."""
        return docs.select(self.chunk().alias(self.name), "*").repartition(self.name)


#: Rows that go between chunks and buckets: data is packed arrays whose meaning depends on kind.
PACKED = "kind int, chunk long, bucket long, data binary, more binary"
PACKED_TYPES = pa.schema([("kind", pa.int32()), ("chunk", pa.int64()), ("bucket", pa.int64()), ("data", pa.binary()), ("more", pa.binary())])


def packed(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 5, PACKED_TYPES.types, strict=True)], schema=PACKED_TYPES)


class Entries:
    """The distinct anchors of a chunk in order of their hashes: hash, whether it repeats in the chunk, and each anchor's entry."""

    def __init__(self, at: np.ndarray, h: np.ndarray, owner: np.ndarray):
        """owner: what a repeat must differ in to count (documents), by anchor."""
        self.at = at
        self.hash, first, self.entry = np.unique(h, return_index=True, return_inverse=True)
        other = owner != owner[first][self.entry]
        self.multi = np.bincount(self.entry, weights=other, minlength=len(self.hash)) > 0

    def ask(self, chunk: int, plan: Plan) -> list[tuple]:
        """Rows for the buckets, of the kind of the chunk's part: six bytes an entry, the lowest bit tells a repeat within the chunk."""
        b = bucket_of(self.hash, plan.buckets).astype(np.int64)
        cut = np.flatnonzero(np.r_[True, b[1:] != b[:-1], True]) if len(b) else [0]
        six = ((self.hash << np.uint64(1)) | self.multi.astype(np.uint64)).view(np.uint8).reshape(-1, 8)[:, :6]
        return [(plan.part(chunk), chunk, int(b[s]), six[s:e].tobytes(), None) for s, e in zip(cut[:-1], cut[1:], strict=True)]


def _six(data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Keys and flags of packed entries of six bytes."""
    raw = np.frombuffer(b"".join(data), np.uint8).reshape(-1, 6)
    h = np.zeros((len(raw), 8), np.uint8)
    h[:, :6] = raw
    h = h.view(np.uint64).ravel()
    return h >> np.uint64(1), (h & np.uint64(1)).astype(np.int64)


def _merged(table: pa.Table) -> pa.Table:
    """The entries of a part's chunks in one bucket: each once, with its flag and in how many chunks it is."""
    key, multi = _six(table["data"].to_pylist())
    own, of = np.unique(key, return_inverse=True)
    n, some = np.bincount(of, minlength=len(own)), np.bincount(of, weights=multi, minlength=len(own)) > 0
    six = ((own << np.uint64(1)) | some.astype(np.uint64)).view(np.uint8).reshape(-1, 8)[:, :6]
    return packed([(table["kind"][0].as_py(), 0, table["bucket"][0].as_py(), six.tobytes(), n.astype(np.int32).tobytes())])


def _counted(table: pa.Table, hot: int) -> pa.Table:
    """Codes for the entries of each part of a bucket: 0 found nowhere else, 1 repeated, 2 in more than hot chunks."""
    rows = table.to_pylist()
    key, multi = _six([r["data"] for r in rows])
    n = np.concatenate([np.frombuffer(r["more"], np.int32) for r in rows])
    own, of = np.unique(key, return_inverse=True)
    size, some = np.bincount(of, weights=n, minlength=len(own)), np.bincount(of, weights=multi, minlength=len(own)) > 0
    code, out, at = np.where(size > hot, 2, np.where((size > 1) | some, 1, 0)).astype(np.uint8)[of], [], 0
    for r in rows:
        m = len(r["data"]) // 6
        out.append((r["kind"], 0, r["bucket"], code[at : at + m].tobytes(), None))
        at += m
    return packed(out)


def _told(asks: pa.Table, codes_: pa.Table) -> pa.Table:
    """The codes of a part's entries (of kind 2) for each of its chunks."""
    rows, out = asks.to_pylist(), []
    if not rows:
        return packed([])
    code = np.frombuffer(codes_["data"][0].as_py(), np.uint8)
    of, at = np.unique(_six([r["data"] for r in rows])[0], return_inverse=True)[1], 0
    for r in rows:
        m = len(r["data"]) // 6
        c = code[of[at : at + m]]
        out.append((2, r["chunk"], r["bucket"], np.packbits(c > 0).tobytes(), np.packbits(c > 1).tobytes() if (c > 1).any() else None))
        at += m
    return packed(out)


def counts(asks: DataFrame, hot: int) -> DataFrame:
    """Codes for the entries that chunks asked about, for the chunks."""
    top = asks.groupBy("bucket", "kind").applyInArrow(by_group(_merged), PACKED).groupBy("bucket").applyInArrow(by_group(partial(_counted, hot=hot)), PACKED)
    return asks.groupBy("bucket", "kind").cogroup(top.groupBy("bucket", "kind")).applyInArrow(by_groups(_told), PACKED)


def codes(entries: Entries, replies: list[dict], buckets: int) -> np.ndarray:
    """The code of every entry from a chunk's replies (kind 2)."""
    out = np.zeros(len(entries.hash), np.uint8)
    b = bucket_of(entries.hash, buckets).astype(np.int64)
    for r in replies:
        s, e = np.searchsorted(b, r["bucket"]), np.searchsorted(b, r["bucket"], "right")
        out[s:e] = np.unpackbits(np.frombuffer(r["data"], np.uint8), count=e - s)
        if r["more"]:
            out[s:e] += np.unpackbits(np.frombuffer(r["more"], np.uint8), count=e - s)
    return out
