"""Suffix-array dedup: passages that an earlier document has are removed, found by hash-compared suffix sorts."""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import PACKED, Entries, Plan, anchors, bucket_of, codes, counts, mix, packed, power
from .common import by_group, by_groups, table

#: Bytes of a removed string, of the anchors, and what a context has before and after an anchor's start.
SPAN, GRAM = 50, 20
LEFT, WIDE = SPAN - GRAM, 2 * SPAN - GRAM
#: Chunks with an anchor beyond which its contexts are dealt by HALF bytes more before or after it, different contexts of such a longer gram beyond which
#: its windows are dealt out one by one, and contexts sorted at once.
HOT, CROWD, SLICE = 1024, 100_000, 20_000
#: A window has HALF bytes before the anchor (EARLY) or at least as many after it (LATE): the windows that a context dealt by either finds.
HALF = LEFT // 2
EARLY, LATE = np.uint32((1 << LEFT + 1) - (1 << HALF)), np.uint32((1 << HALF) - 1)
OUT = "doc_id long, text_hash string, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans binary"


def prefix_hashes(rows: np.ndarray) -> np.ndarray:
    """Polynomial hashes [n, width + 1] of all prefixes of rows [n, width]."""
    out = np.zeros((len(rows), rows.shape[1] + 1), np.uint64)
    base = power(1)
    for j in range(rows.shape[1]):
        out[:, j + 1] = out[:, j] * base + rows[:, j]
    return out


class SuffixSort:
    """Order of suffixes within segments: rows [n, width] of codes (0 beyond a text's end), segment ids by row, ascending.

    Two suffixes are compared by the length of their common extension, a binary search over their prefix hashes, and
    the codes after it. Runs are merged bottom-up, all segments at once: an element's new place is its place in its run plus its rank in the neighbouring
    run. The outcome is verified on the codes themselves: neighbours must be in order, and their common extensions are counted again; a segment in which hashes collided is sorted
    by its codes.
    """

    def __init__(self, rows: np.ndarray, segment: np.ndarray):
        self.rows, self.hash, self.width = rows, prefix_hashes(rows), rows.shape[1]
        n = len(rows)
        self.order = np.arange(n)
        first = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]]) if n else np.zeros(0, np.int64)
        size = np.diff(np.r_[first, n])
        begin, length = np.repeat(first, size), np.repeat(size, size)
        run = 1
        while n and run < size.max():
            self._merge(np.flatnonzero(length > run), begin, length, run)
            run *= 2
        self._verify(segment, begin)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common extensions of the rows a and b."""
        lo, hi = np.zeros(len(a), np.int64), np.full(len(a), self.width)
        for _ in range(int(self.width).bit_length()):
            mid = (lo + hi + 1) >> 1
            same = self.hash[a, mid] == self.hash[b, mid]
            lo, hi = np.where(same, mid, lo), np.where(same, hi, np.maximum(mid - 1, lo))
        return lo

    def less(self, a: np.ndarray, b: np.ndarray, ties: np.ndarray) -> np.ndarray:
        """Whether row a stands before row b; equal rows do where ties."""
        l = self.common(a, b)
        end = l == self.width
        l = np.minimum(l, self.width - 1)
        return np.where(end, ties, self.rows[a, l] < self.rows[b, l])

    def _merge(self, at: np.ndarray, begin: np.ndarray, length: np.ndarray, run: int) -> None:
        rel = at - begin[at]
        own, end = rel // run, length[at]
        second = (own & 1) == 1
        lo = np.where(second, own - 1, own + 1) * run
        hi = np.minimum(lo + run, end)
        keep = lo < end
        at, rel, own, second, lo, hi = (x[keep] for x in (at, rel, own, second, lo, hi))
        base, x, start = begin[at], self.order[at], lo.copy()
        while (open_ := np.flatnonzero(lo < hi)).size:
            mid = (lo[open_] + hi[open_]) >> 1
            before = self.less(self.order[base[open_] + mid], x[open_], second[open_])
            lo[open_], hi[open_] = np.where(before, mid + 1, lo[open_]), np.where(before, hi[open_], mid)
        self.order[base + (own & ~1) * run + (rel - own * run) + (lo - start)] = x

    def _verify(self, segment: np.ndarray, begin: np.ndarray) -> None:
        n = len(self.order)
        self.lcp = np.zeros(n, np.int64)
        if n < 2:
            return
        a, b = self.rows[self.order[:-1]], self.rows[self.order[1:]]
        differ = a != b
        l = np.where(differ.any(axis=1), differ.argmax(axis=1), self.width)
        at = np.minimum(l, self.width - 1)
        i = np.arange(n - 1)
        inside = segment[1:] == segment[:-1]
        bad = inside & (l < self.width) & (a[i, at] > b[i, at])
        if bad.any():
            for s in np.unique(begin[1:][bad]):
                own = np.flatnonzero(begin == s)
                self.order[own] = own[np.lexsort(self.rows[own].T[::-1])]
            self._verify(segment, begin)
            return
        self.lcp[1:] = np.where(inside, l, -1)
        self.lcp[0] = -1

    def classes(self, depth: int) -> np.ndarray:
        """Ids by row: rows of a segment that agree in their first depth codes share one."""
        out = np.empty(len(self.order), np.int64)
        out[self.order] = np.cumsum(self.lcp < depth)
        return out


def first_owners(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """By row, the smallest doc among the rows with its key; doc is ascending."""
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.r_[True, np.diff(key[order]) != 0])
    out = np.empty(len(key), np.int64)
    out[order] = np.repeat(doc[order][first], np.diff(np.r_[first, len(key)]))
    return out


def coded(raw: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Codes of contexts: byte + 1 within the text, which has left bytes before the anchor and right after, 0 beyond."""
    col = np.arange(WIDE, dtype=np.int16) - LEFT
    inside = (col >= -left.astype(np.int16)[:, None]) & (col < right[:, None])
    return np.where(inside, raw.astype(np.uint16) + np.uint16(1), np.uint16(0))


def distinct(raw: np.ndarray, left: np.ndarray, right: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of equal contexts the one of the smallest doc: its index, ascending by hash; and by row, the place in these."""
    key = mix(mix_bytes(raw) + left.astype(np.uint64) * power(3) + right.astype(np.uint64) * power(5))
    order = np.lexsort((doc, key))
    new = np.r_[True, key[order][1:] != key[order][:-1]] if len(order) else np.zeros(0, bool)
    first, place = order[new], np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    if all((raw[at : at + SLICE] == raw[first[place[at : at + SLICE]]]).all() for at in range(0, len(raw), SLICE)) and (left == left[first[place]]).all() and (right == right[first[place]]).all():
        return first, place
    # hashes collided: by the bytes themselves
    every = np.concatenate([raw, left[:, None], right[:, None]], axis=1)
    order = np.argsort(doc, kind="stable")
    _, at, place_ = np.unique(every[order], axis=0, return_index=True, return_inverse=True)
    place[order] = place_.ravel()
    return order[at], place


def resolve(raw: np.ndarray, left: np.ndarray, right: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Bit j of a context's mask: its window that begins j bytes before the anchor also occurs in a context of a smaller doc.

    raw [n, WIDE] bytes with the anchor at LEFT, of which left before and right after it are there. Equal contexts are compared once: what
    the first of them has, the later ones have as a whole. The suffixes at the anchors of the others are sorted forwards, and what is
    before them backwards; a window of j bytes before and SPAN - j after is the same in two contexts if they agree to these depths in both orders.
    """
    first, place = distinct(raw, left, right, doc)
    own = np.zeros(len(first), np.uint32)
    gram = mix_bytes(raw[first, LEFT : LEFT + GRAM])
    order = np.lexsort((doc[first], gram))
    segment = np.cumsum(np.r_[True, np.diff(gram[order]) != 0])[: len(order)]
    cut = np.r_[np.searchsorted(segment, np.arange(1, segment[-1] + 1)), len(order)] if len(order) else [0]
    # groups of one have nothing to share
    alone = np.diff(cut) == 1
    order = order[~alone[segment - 1]] if len(order) else order
    segment = np.unique(gram[order], return_inverse=True)[1] + 1
    cut = np.r_[np.searchsorted(segment, np.arange(1, segment[-1] + 1)), len(order)] if len(order) else [0]
    at = 0
    while at < len(cut) - 1:  # whole groups, about SLICE contexts at a time
        to = max(at + 1, int(np.searchsorted(cut, cut[at] + SLICE, "right")) - 1)
        k = order[cut[at] : cut[to]]
        i = first[k]
        own[k] = _resolve(coded(raw[i], left[i], right[i]), doc[i], segment[cut[at] : cut[to]] - at - 1)
        at = to
    return np.where(doc > doc[first][place], possible(left, right), own[place])


def possible(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Mask of the windows that contexts have."""
    j = np.arange(LEFT + 1)
    return (((j <= left[:, None]) & (SPAN - j <= right[:, None])) << j).sum(axis=1).astype(np.uint32)


def _resolve(ctx: np.ndarray, doc: np.ndarray, segment: np.ndarray) -> np.ndarray:
    left, right = (ctx[:, :LEFT] > 0).sum(axis=1), (ctx[:, LEFT:] > 0).sum(axis=1)
    out, rows = np.zeros(len(ctx), np.uint32), np.argsort(doc, kind="stable")
    ahead, back = SuffixSort(ctx[:, LEFT:], segment), SuffixSort(np.ascontiguousarray(ctx[:, :LEFT][:, ::-1]), segment)
    n = len(ctx) + 1
    for k in range(LEFT + 1):
        own = rows[(left[rows] >= k) & (right[rows] >= SPAN - k)]
        if len(own) > 1:
            hit = first_owners(ahead.classes(SPAN - k)[own] * n + back.classes(k)[own], doc[own]) < doc[own]
            out[own[hit]] |= np.uint32(1 << k)
    return out


class Chunk:
    """The documents of a chunk that are not whole copies, as one sequence of bytes, with their anchors."""

    def __init__(self, docs: pa.Table, replies: pa.Table, name: str):
        rows = replies.to_pylist()
        copies = {r["bucket"] for r in rows if r["kind"] == 0}
        self.replies = [r for r in rows if r["kind"] == 2]
        self.masks = [r for r in rows if r["kind"] in (4, 5)]
        self.ids, self.texts = docs["doc_id"].to_pylist(), [(t or "").encode() for t in docs["text"].to_pylist()]
        self.id = docs[name][0].as_py() if len(docs) else 0
        self.copy = [d in copies for d in self.ids]
        own = [k for k, c in enumerate(self.copy) if not c and self.ids[k] is not None]
        self.own = own
        self.sym = np.frombuffer(b"".join(self.texts[k] for k in own), np.uint8)
        self.start = np.r_[0, np.cumsum([len(self.texts[k]) for k in own])].astype(np.int64)
        at, h = anchors(self.sym, self.start, SPAN, GRAM)
        self.row = np.searchsorted(self.start, at, "right") - 1
        self.doc = np.array([self.ids[k] for k in own], np.int64)[self.row]
        self.entries = Entries(at, h, self.doc)

    def contexts(self, buckets: int) -> None:
        """Distinct contexts of the repeated anchors in order of bucket and hash: ctx, owner (their smallest doc) and bucket;
        and each occurrence's context (of), anchor and doc. Those of a very common anchor are there twice, dealt by what is before the anchor and after it."""
        code = codes(self.entries, self.replies, buckets)[self.entries.entry]
        pick, side = np.flatnonzero(code), code[code > 0] - 1
        pick, side = np.r_[pick, pick[side > 0]], np.r_[side, np.full(int((side > 0).sum()), 2, np.uint8)]
        at, doc, row = self.entries.at[pick], self.doc[pick], self.row[pick]
        begin, end = self.start[row], self.start[row + 1]
        if side.any():
            full = possible(np.minimum(at - begin, LEFT), np.minimum(end - at, SPAN))
            has = (full & sides(side)) > 0
            at, doc, begin, end, side = at[has], doc[has], begin[has], end[has], side[has]
        ctx, inside = np.zeros((len(at), WIDE), np.uint8), np.zeros((len(at), WIDE), bool)
        for k in range(0, len(at), SLICE):
            own = slice(k, k + SLICE)
            col = at[own, None] + np.arange(-LEFT, SPAN)
            inside[own] = (col >= begin[own, None]) & (col < end[own, None])
            ctx[own] = self.sym[np.clip(col, 0, len(self.sym) - 1)] * inside[own]
        self.at, self.of_doc = at, doc
        gram = mix_bytes(ctx[:, LEFT : LEFT + GRAM])
        body = mix_bytes(ctx)
        body = mix(body * np.uint64(3) + inside.sum(axis=1).astype(np.uint64) * power(7) + (at - begin).clip(0, LEFT).astype(np.uint64) + side * power(9))
        b = bucket_of(np.where(side > 0, longer(ctx, side), gram), buckets).astype(np.int64)
        order = np.lexsort((doc, body, gram, b))
        new = np.r_[True, (body[order][1:] != body[order][:-1]) | (gram[order][1:] != gram[order][:-1])] if len(order) else np.zeros(0, bool)
        rep = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
        pairs = ((order[k : k + SLICE], rep[k : k + SLICE]) for k in range(0, len(order), SLICE))
        if not all((ctx[x] == ctx[y]).all() and (inside[x] == inside[y]).all() and (side[x] == side[y]).all() for x, y in pairs):
            # hashes collided: by the bytes themselves
            body = np.unique(np.concatenate([ctx, inside.view(np.uint8), side[:, None]], axis=1), axis=0, return_inverse=True)[1].ravel()
            order = np.lexsort((doc, body, gram, b))
            new = np.r_[True, (body[order][1:] != body[order][:-1]) | (gram[order][1:] != gram[order][:-1]) | (b[order][1:] != b[order][:-1])]
        first = order[new]
        self.of = np.empty(len(at), np.int64)
        self.of[order] = np.cumsum(new) - 1
        self.ctx, self.inside, self.owner, self.bucket, self.side = ctx[first], inside[first], doc[first], b[first], side[first]
        self.cut = np.flatnonzero(np.r_[True, self.bucket[1:] != self.bucket[:-1], True]) if len(first) else np.zeros(1, np.int64)

    def removed(self) -> np.ndarray:
        """By byte, whether it goes."""
        mask = np.zeros(len(self.ctx), np.uint32)
        begin = dict(zip(self.bucket[self.cut[:-1]].tolist(), self.cut[:-1].tolist(), strict=True))
        for r in self.masks:
            # windows that met one by one name their context once each
            np.bitwise_or.at(mask, begin[r["bucket"]] + np.frombuffer(r["more"], np.int64), np.frombuffer(r["data"], np.uint32))
        full = possible(self.inside[:, :LEFT].sum(axis=1), self.inside[:, LEFT:].sum(axis=1))
        # the owner has what the mask says; later documents of the chunk have all that the owner has
        mine = np.where(self.of_doc > self.owner[self.of], full[self.of], mask[self.of])
        edge = np.zeros(len(self.sym) + SPAN + 1, np.int32)
        for k in range(LEFT + 1):
            w = self.at[(mine >> np.uint32(k)) & np.uint32(1) == 1] - k
            np.add.at(edge, w, 1)
            np.add.at(edge, w + SPAN, -1)
        return np.cumsum(edge, dtype=np.int32)[: len(self.sym)] > 0


def sides(side: np.ndarray) -> np.ndarray:
    """Masks of the windows that contexts find by their side: 0 the anchor (all), 1 what is before it, 2 what is after it."""
    return np.array([EARLY | LATE, EARLY, LATE])[side]


def longer(ctx: np.ndarray, side: np.ndarray) -> np.ndarray:
    """Hashes of the anchors with HALF bytes more on their side."""
    return mix(np.where(side == 1, mix_bytes(ctx[:, LEFT - HALF : LEFT + GRAM]), mix_bytes(ctx[:, LEFT : LEFT + GRAM + HALF])) + side)


def mix_bytes(rows: np.ndarray) -> np.ndarray:
    out = np.zeros(len(rows), np.uint64)
    for j in range(rows.shape[1]):
        out = out * power(1) + rows[:, j] + np.uint64(1)
    return mix(out)


def _dedup(docs: DataFrame, finish, schema, hot: int = HOT, crowd: int = CROWD, **sizes) -> DataFrame:
    """finish (of a Chunk, by row: the bytes that go or None for none; and the table of its rows) over all chunks of docs."""
    plan = Plan(docs, **sizes)
    chunked = plan.chunked(docs)
    buckets = plan.buckets
    keys = docs.filter("text is not null and doc_id is not null").select("doc_id", F.sha2("text", 256).alias("h"), F.octet_length("text").alias("n")).filter(f"n >= {SPAN}")
    firsts = keys.groupBy("h").agg(F.min("doc_id").alias("first"), F.count("*").alias("c")).filter("c > 1")
    # a doc_id in several rows is left to the windows
    once = keys.groupBy("doc_id").agg(F.first("h").alias("h"), F.count("*").alias("c")).filter("c = 1").select("doc_id", "h")
    none = F.lit(None).cast("binary")
    copies = once.join(firsts, "h").filter("doc_id > first").select(F.lit(0).alias("kind"), plan.chunk().alias("chunk"), F.col("doc_id").alias("bucket"), none.alias("data"), none.alias("more"))

    def ask(docs_: pa.Table, replies: pa.Table) -> pa.Table:
        c = Chunk(docs_, replies, plan.name)
        return packed(c.entries.ask(c.id, plan))

    def send(docs_: pa.Table, replies: pa.Table) -> pa.Table:
        c = Chunk(docs_, replies, plan.name)
        c.contexts(buckets)
        out = []
        for s, e in zip(c.cut[:-1], c.cut[1:], strict=True):
            left, right = c.inside[s:e, :LEFT].sum(axis=1).astype(np.uint8), c.inside[s:e, LEFT:].sum(axis=1).astype(np.uint8)
            for hot_, kind in ((False, -1), (True, plan.part(c.id))):
                if len(k := np.flatnonzero((c.side[s:e] > 0) == hot_)):
                    out.append((kind, c.id, int(c.bucket[s]), c.ctx[s + k].tobytes(), _head(c.owner[s + k], k, left[k], right[k], c.side[s + k])))
        return packed(out)

    def cut(docs_: pa.Table, replies: pa.Table) -> pa.Table:
        c = Chunk(docs_, replies, plan.name)
        c.contexts(buckets)
        gone, place = c.removed(), {k: i for i, k in enumerate(c.own)}
        rows = []
        for k, raw in enumerate(c.texts):
            if c.copy[k]:
                rows.append(np.ones(len(raw), bool))
            else:
                rows.append(gone[c.start[place[k]] : c.start[place[k] + 1]] if k in place else None)
        return finish(c, rows, docs_.drop([plan.name]))

    def meet(replies: DataFrame, f, schema_) -> DataFrame:
        return chunked.groupBy(plan.name).cogroup(replies.groupBy("chunk")).applyInArrow(by_groups(f), schema_)

    counted = counts(meet(copies, ask, PACKED), hot)
    sent = meet(copies.union(counted), send, PACKED)
    parts = sent.filter("kind >= 0").groupBy("bucket", "kind").applyInArrow(by_group(_meet_part), PACKED)
    full = parts.filter(f"kind = {TALLY}").groupBy("bucket").applyInArrow(by_group(partial(_crowded, crowd)), PACKED)
    dealt = parts.filter(f"kind >= {PART}").groupBy("bucket", "kind").cogroup(full.groupBy("bucket", "kind")).applyInArrow(by_groups(partial(_deal, buckets)), PACKED)
    whole = sent.filter("kind < 0").union(dealt.filter(f"kind = {CONTEXT}")).groupBy("bucket").applyInArrow(by_group(_meet), PACKED)
    single = dealt.filter(f"kind = {WINDOW}").groupBy("bucket").applyInArrow(by_group(_meet_windows), PACKED)
    return meet(copies.union(counted).union(parts.filter("kind = 4")).union(whole).union(single), cut, schema)


#: Kinds of rows on their way from a part: how many contexts its longer grams have, contexts and windows that go on to all parts; those of part k are PART + k.
TALLY, CONTEXT, WINDOW, PART = 6, 9, 7, 16


def _head(doc: np.ndarray, index: np.ndarray, left: np.ndarray, right: np.ndarray, side: np.ndarray) -> bytes:
    """What goes with the contexts of one chunk, 14 bytes each; the side lies above the five bits of left."""
    return b"".join(x.astype(t).tobytes() for x, t in ((doc, np.int64), (index, np.int32), (left | (side << 5), np.uint8), (right, np.uint8)))


def _contexts(rows_: pa.Table) -> tuple:
    """Rows without their data, their numbers of contexts, and of all contexts: raw, doc, index, left, right, side."""
    rows = rows_.drop(["data"]).to_pylist()
    n = [len(r["more"]) // 14 for r in rows]
    raw = np.frombuffer(b"".join(rows_["data"].to_pylist()), np.uint8).reshape(-1, WIDE)
    doc, index, left, right = (np.concatenate([np.frombuffer(r["more"], t, m, k * m) for r, m in zip(rows, n, strict=True)]) for t, k in ((np.int64, 0), (np.int32, 8), (np.uint8, 12), (np.uint8, 13)))
    return rows, n, raw, doc, index, left & np.uint8(31), right, left >> np.uint8(5)


def _masks(rows: list[dict], n: list[int], mask: np.ndarray, index: np.ndarray, kind: int) -> list[tuple]:
    """Rows for the chunks: masks that are not empty and the places of their contexts."""
    out, at = [], 0
    for r, m in zip(rows, n, strict=True):
        own = slice(at, at + m)
        at += m
        if len(k := np.flatnonzero(mask[own])):
            out.append((kind, r["chunk"], r["bucket"], mask[own][k].tobytes(), index[own][k].astype(np.int64).tobytes()))
    return out


def _meet(rows_: pa.Table) -> pa.Table:
    """Contexts that meet in a bucket to masks for their chunks (5)."""
    rows, n, raw, doc, index, left, right, _ = _contexts(rows_)
    return packed(_masks(rows, n, resolve(raw, left, right, doc), index, 5))


def _meet_part(rows_: pa.Table) -> pa.Table:
    """Contexts of very common anchors that meet in a part of a bucket to masks for their chunks (4).

    Those with windows that are first in the part and that their side finds go on, and the bucket is told how many each longer gram has.
    """
    rows, n, raw, doc, index, left, right, side = _contexts(rows_)
    mask = resolve(raw, left, right, doc)
    out, at, more = _masks(rows, n, mask, index, 4), 0, (possible(left, right) & ~mask & sides(side)) > 0
    for r, m in zip(rows, n, strict=True):
        if len(k := at + np.flatnonzero(more[at : at + m])):
            out.append((PART + r["kind"], r["chunk"], r["bucket"], raw[k].tobytes(), _head(doc[k], index[k], left[k], right[k], side[k])))
        at += m
    if more.any():
        key, size = np.unique(longer(raw[more], side[more]), return_counts=True)
        out.append((TALLY, rows[0]["kind"], rows[0]["bucket"], key.tobytes(), size.astype(np.int32).tobytes()))
    return packed(out)


def _crowded(crowd: int, tallies: pa.Table) -> pa.Table:
    """The longer grams of a bucket with more than crowd contexts, for each part."""
    rows = tallies.to_pylist()
    own, of = np.unique(np.concatenate([np.frombuffer(r["data"], np.uint64) for r in rows]), return_inverse=True)
    size = np.bincount(of, weights=np.concatenate([np.frombuffer(r["more"], np.int32) for r in rows]), minlength=len(own))
    big = own[size > crowd].tobytes()
    return packed([(PART + r["chunk"], 0, r["bucket"], big, None) for r in rows] if big else [])


def _deal(buckets: int, rows_: pa.Table, full: pa.Table) -> pa.Table:
    """Contexts of a part for the whole bucket, or, if their longer gram is crowded, their windows for the buckets of these."""
    if not len(rows_):
        return packed([])
    big = np.frombuffer(b"".join(full["data"].to_pylist()), np.uint64)
    rows, n, raw, doc, index, left, right, side = _contexts(rows_)
    of, out, at = np.isin(longer(raw, side), big), [], 0
    for r, m in zip(rows, n, strict=True):
        k = at + np.flatnonzero(~of[at : at + m])
        if len(k):
            out.append((CONTEXT, r["chunk"], r["bucket"], raw[k].tobytes(), _head(doc[k], index[k], left[k], right[k], side[k])))
        k = at + np.flatnonzero(of[at : at + m])
        at += m
        for a in range(0, len(k), SLICE // LEFT):
            own = k[a : a + SLICE // LEFT]
            at_, j = np.nonzero((possible(left[own], right[own]) & sides(side[own]))[:, None] >> np.arange(LEFT + 1, dtype=np.uint32) & np.uint32(1))
            src = own[at_]
            win = np.lib.stride_tricks.sliding_window_view(raw, SPAN, axis=1)[src, LEFT - j]
            b = bucket_of(mix_bytes(win), buckets).astype(np.int64)
            order = np.argsort(b, kind="stable")
            cut = np.flatnonzero(np.r_[True, b[order][1:] != b[order][:-1], True]) if len(b) else [0]
            for s, e in zip(cut[:-1], cut[1:], strict=True):
                o = order[s:e]
                head = b"".join(x.astype(t).tobytes() for x, t in ((doc[src[o]], np.int64), (index[src[o]], np.int32), (j[o], np.int32)))
                out.append((WINDOW, r["chunk"], int(b[o[0]]), win[o].tobytes(), np.int64(r["bucket"]).tobytes() + head))
    return packed(out)


def _meet_windows(rows_: pa.Table) -> pa.Table:
    """Windows that meet one by one, as contexts with nothing before the anchor, to masks for their chunks (5)."""
    rows = rows_.drop(["data"]).to_pylist()
    n = [(len(r["more"]) - 8) // 16 for r in rows]
    win = np.frombuffer(b"".join(rows_["data"].to_pylist()), np.uint8).reshape(-1, SPAN)
    doc, index, j = (np.concatenate([np.frombuffer(r["more"], t, m, 8 + k * m) for r, m in zip(rows, n, strict=True)]) for t, k in ((np.int64, 0), (np.int32, 8), (np.int32, 12)))
    raw = np.zeros((len(win), WIDE), np.uint8)
    raw[:, LEFT:] = win
    mask = resolve(raw, np.zeros(len(win), np.uint8), np.full(len(win), SPAN, np.uint8), doc) << j.astype(np.uint32)
    for r in rows:
        r["bucket"] = int(np.frombuffer(r["more"], np.int64, 1)[0])
    return packed(_masks(rows, n, mask, index, 5))


def runs(gone: np.ndarray | None) -> np.ndarray:
    """Starts and ends [n, 2] of the runs of bytes that go."""
    return np.zeros((0, 2), np.int64) if gone is None else np.flatnonzero(np.diff(np.r_[0, gone.view(np.int8), 0])).reshape(-1, 2)


def spans(docs: DataFrame, **sizes) -> DataFrame:
    """For every row of docs (doc_id, text): doc_id, text_hash, n_bytes, n_removed, n_spans, kept_sha256, and spans (int64
    pairs: start and end of each removed run).

    A null text is empty. A whole text of SPAN bytes or more that a smaller doc_id has goes at once; rows of one doc_id count as one
    document and never remove each other's bytes; a row without doc_id loses nothing and removes nothing. An empty table gives no rows; other columns are ignored.
    """

    def finish(c: Chunk, gone: list, docs_: pa.Table) -> pa.Table:
        out = []
        for doc, raw, g in zip(c.ids, c.texts, gone, strict=True):
            r = runs(g)
            kept = np.frombuffer(raw, np.uint8)[~g].tobytes() if len(r) else raw
            out.append((doc, hashlib.sha256(raw).hexdigest(), len(raw), len(raw) - len(kept), len(r), hashlib.sha256(kept).hexdigest(), r.astype(np.int64).tobytes()))
        types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        names = [x.split()[0] for x in OUT.split(", ")]
        return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True) if out else [[]] * 7, types, strict=True)], names=names)

    return _dedup(docs.select("doc_id", "text"), finish, OUT, **sizes)


def kept_text(raw: bytes, gone: np.ndarray) -> str:
    """What is left of a text; a character goes if all its bytes go."""
    b = np.frombuffer(raw, np.uint8)
    if not len(b) or not gone.any():
        return raw.decode()
    begin = np.flatnonzero((b & 0xC0) != 0x80)
    whole = np.repeat(np.minimum.reduceat(gone, begin), np.diff(np.r_[begin, len(b)]))
    return b[~whole].tobytes().decode()


def remove(docs: DataFrame, **sizes) -> DataFrame:
    """docs without the passages that an earlier document has: text and, if there, n_chars are changed, other columns kept.

    Rows whose text loses all but white space go; rows that had no text before stay.
    """
    schema = docs.schema

    def finish(c: Chunk, gone: list, docs_: pa.Table) -> pa.Table:
        texts = [kept_text(raw, g) if g is not None and g.any() else None for raw, g in zip(c.texts, gone, strict=True)]
        old = docs_["text"].to_pylist()
        new = [o if t is None else t for o, t in zip(old, texts, strict=True)]
        out = docs_
        out = out.set_column(out.schema.get_field_index("text"), "text", pa.array(new, pa.string()))
        if "n_chars" in out.column_names:
            k = out.schema.get_field_index("n_chars")
            n = [v if t is None else len(t) for v, t in zip(out["n_chars"].to_pylist(), texts, strict=True)]
            out = out.set_column(k, "n_chars", pa.array(n, out.schema.field(k).type))
        return out.filter(pa.array([t is None or bool(t.strip()) for t in texts], pa.bool_()))

    return _dedup(docs, finish, schema, **sizes)


def op3_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return spans(table(spark, sf_dir, "documents")).drop("text_hash", "spans")


#: The same with windows as hex texts, as DuckDB reads it.
SQL = r"""
with d as (
  select doc_id, hex(encode(coalesce(text, ''))) as h from documents
), w as (
  select doc_id, p, substr(h, 2 * p + 1, 100) as win from (select doc_id, h, unnest(range(0, len(h) // 2 - 49)) as p from d where len(h) >= 100)
), hit as (
  select doc_id, p from (select doc_id, p, min(doc_id) over (partition by win) as first from w) where doc_id > first
), marked as (
  select doc_id, p, (p - coalesce(lag(p) over (partition by doc_id order by p), -51) > 50)::int as new from hit
), runs as (
  select doc_id, min(p) as a, max(p) + 50 as b from (select doc_id, p, sum(new) over (partition by doc_id order by p) as run from marked) group by doc_id, run
), gaps as (
  select doc_id, coalesce(lag(b) over (partition by doc_id order by a), 0) as s, a as e from runs
  union all select d.doc_id, coalesce(max(b), 0), any_value(len(h)) // 2 from d left join runs on runs.doc_id = d.doc_id group by d.doc_id
), kept as (
  select g.doc_id, string_agg(substr(h, 2 * s + 1, 2 * (e - s)), '' order by s) as k from gaps g join d on d.doc_id = g.doc_id group by g.doc_id
)
select d.doc_id, len(h) // 2 as n_bytes, coalesce(n, 0)::bigint as n_removed, coalesce(c, 0)::bigint as n_spans, sha256(unhex(k)) as kept_sha256
from d join kept on kept.doc_id = d.doc_id left join (select doc_id, sum(b - a) as n, count(*) as c from runs group by doc_id) r on r.doc_id = d.doc_id
"""
