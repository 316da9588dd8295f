"""Substring dedup: repeated runs of words, found with suffix automata of reference shards."""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import BASE, PACKED, Entries, Plan, bucket_of, codes, counts, gram_hashes, mix, packed
from .common import by_group, by_groups, table

#: Words of a removed window and of the anchors; words of the references of one automaton.
SPAN, GRAM, SHARD_WORDS = 20, 8, 60_000
OUT = "doc_id long, n_words long, n_removed long, kept_sha256 string, removed binary"


class SuffixAutomaton:
    """All substrings of the rows of words added so far."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]

    def add(self, row: list[bytes]) -> None:
        p = 0
        for w in row:
            p = self._step(p, w)

    def _copy(self, p: int, q: int, w) -> int:
        """A state for the shorter substrings of q, which p reaches by w."""
        nxt, c = self.next, len(self.next)
        nxt.append(nxt[q].copy())
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = c
        while p >= 0 and nxt[p].get(w) == q:
            nxt[p][w] = c
            p = self.link[p]
        return c

    def _step(self, last: int, w) -> int:
        nxt, link, length = self.next, self.link, self.length
        if (q := nxt[last].get(w)) is not None:  # known from an earlier row
            return q if length[last] + 1 == length[q] else self._copy(last, q, w)
        cur, p = len(nxt), last
        nxt.append({})
        length.append(length[p] + 1)
        link.append(0)
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            link[cur] = q if length[p] + 1 == length[q] else self._copy(p, q, w)
        return cur

    def matches(self, words: list[bytes]) -> list[int]:
        """Matching statistics: by position, the length of the longest run of words that ends there and is in the automaton."""
        nxt, link, length, v, l, out = self.next, self.link, self.length, 0, 0, []
        for w in words:
            while v and w not in nxt[v]:
                v = link[v]
                l = length[v]
            if w in nxt[v]:
                v, l = nxt[v][w], l + 1
            else:
                v = l = 0
            out.append(l)
        return out

    def windows(self, words: list[bytes]) -> list[bool]:
        """Whether each window of SPAN words is in the automaton."""
        return [n >= SPAN for n in self.matches(words)[SPAN - 1 :]]


def stream(rows: list[list[bytes]], key: list[tuple], more: list[bool], last: list[bool]) -> tuple[list[list[bool]], list[list[bool] | None]]:
    """For rows in the order of their keys: which windows a row with a smaller key has; and, where more, which the row's own reference has.

    Each row is streamed through the automaton of the rows before it and then becomes a reference itself, unless all of it is known or no row to come can have
    its windows (last). At SHARD_WORDS an automaton is full: the rest of the rows pass through it before the next one is begun.
    """
    found: list[list[bool]] = [[False] * (len(r) - SPAN + 1) for r in rows]
    own: list[list[bool] | None] = [None] * len(rows)
    at, n = 0, len(rows)
    while at < n:
        automaton, words, first = SuffixAutomaton(), 0, at == 0
        look = (lambda i, a=automaton: a.windows(rows[i])) if first else (lambda i, a=automaton: [x or y for x, y in zip(found[i], a.windows(rows[i]), strict=True)])
        while at < n and words < SHARD_WORDS:
            end = at + 1
            while end < n and key[end] == key[at]:
                end += 1
            for i in range(at, end):
                found[i] = look(i)
            for i in range(at, end):
                if not all(found[i]) and (more[i] or not last[i]):
                    automaton.add(rows[i])
                    words += len(rows[i])
            for i in range(at, end):
                if more[i]:
                    own[i] = [x or y for x, y in zip(found[i], automaton.windows(rows[i]), strict=True)]
            at = end
        for i in range(at, n):
            found[i] = [x or y for x, y in zip(found[i], automaton.windows(rows[i]), strict=True)]
    return found, own


#: The white space that parts words.
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
TABLE = 1 << 17
POWERS = np.r_[np.uint64(1), np.cumprod(np.full(TABLE - 1, BASE, np.uint64))]
INVERSE = np.r_[np.uint64(1), np.cumprod(np.full(TABLE - 1, pow(BASE, -1, 1 << 64), np.uint64))]


def word_hashes(buf: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hashes of the words [begin, end) of buf, from differences of prefix sums, block by block."""
    out, k = np.empty(len(begin), np.uint64), 0
    while k < len(begin):
        to = max(k + 1, int(np.searchsorted(end, begin[k] + TABLE // 2, "right")))
        base, n = int(begin[k]), int(end[to - 1] - begin[k])
        powers, inverse = (POWERS, INVERSE) if n < TABLE else (np.r_[np.uint64(1), np.cumprod(np.full(n, x, np.uint64))] for x in (BASE, pow(BASE, -1, 1 << 64)))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((buf[base : base + n].astype(np.uint64) + np.uint64(1)) * powers[:n], out=sums[1:])
        s, e = begin[k:to] - base, end[k:to] - base
        out[k:to] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64) * np.uint64(0x9E3779B1))
        k = to
    return out


def leftmost(g: np.ndarray, w: int) -> np.ndarray:
    """The place of the smallest of every w neighbours, the first one of equals."""
    at, n = np.arange(len(g)), 1
    least = lambda x, y: np.where(g[y] < g[x], y, x)
    while n * 2 <= w:
        at, n = least(at[: len(at) - n], at[n:]), n * 2
    return least(at[: len(at) - (w - n)], at[w - n :]) if w > n else at


class Words:
    """The words of a chunk's documents as one sequence: begin and end in raw, hash (sym), start of each row, and each row's doc.

    Every window belongs to the first of its smallest k-grams, its anchor. Windows side by side with one anchor are a run, of lo to hi; as the anchor depends on a window's
    words alone, equal windows have anchors of equal hash at equal distance, so places of anchors order them as places of windows do.
    """

    def __init__(self, docs: pa.Table, name: str):
        self.ids = docs["doc_id"].to_pylist()
        self.raws = [(t or "").encode() for t in docs["text"].to_pylist()]
        self.raw = b"\n".join([*self.raws, b""])
        buf = np.frombuffer(self.raw, np.uint8)
        inside = np.zeros(len(buf) + 2, bool)
        np.logical_not(SPACE[buf], out=inside[1:-1])
        turn = np.flatnonzero(inside[1:] != inside[:-1])
        self.begin, self.end = turn[::2], turn[1::2]
        offset = np.r_[0, np.cumsum([len(r) + 1 for r in self.raws])].astype(np.int64)
        self.start = np.searchsorted(self.begin, offset).astype(np.int64)
        self.size = np.diff(self.start)
        self.chunk = docs[name][0].as_py() if len(docs) else 0
        sym = word_hashes(buf, self.begin, self.end)
        fits = np.zeros(len(sym), bool)
        for k, (s, e) in enumerate(zip(self.start[:-1].tolist(), self.start[1:].tolist(), strict=True)):
            if self.ids[k] is not None:  # rows without doc_id take no part
                fits[s : max(s, e - SPAN + 1)] = True
        at = np.flatnonzero(fits)
        g = gram_hashes(sym, GRAM) if len(at) else sym
        own = leftmost(g, SPAN - GRAM + 1)[at] if len(at) else at
        new = np.r_[True, (np.diff(at) != 1) | (np.diff(own) != 0)][: len(at)]
        self.lo, self.hi = at[new], at[np.r_[new[1:], True][: len(at)]]
        row = np.searchsorted(self.start, self.lo, "right") - 1
        self.doc = np.array([d if d is not None else -1 for d in self.ids], np.int64)[row]
        self.place, self.hash = own[new] - self.start[row], g[own[new]] if len(at) else np.zeros(0, np.uint64)
        self.entries = Entries(self.lo, self.hash, self.lo)

    def text(self, s: int, e: int) -> bytes:
        return b" ".join(self.raw[self.begin[s] : self.end[e - 1]].split())

    def kept(self, k: int, gone: np.ndarray) -> bytes:
        """The words of row k that stay, joined by a blank."""
        if not gone.any():
            return b" ".join(self.raws[k].split())
        edge = np.flatnonzero(np.diff(np.r_[1, gone.view(np.int8), 1]))
        return b" ".join([self.text(s, e) for s, e in (edge.reshape(-1, 2) + self.start[k]).tolist()])

    def segments(self, replies: list[dict], buckets: int) -> None:
        """The distinct words of the runs whose anchor repeats, in order of bucket (begun at cut) and anchor: texts, the runs of each (of, by run) and the first of
        them in order of place (head); and whether the anchor is hot."""
        code = codes(self.entries, [r for r in replies if r["kind"] == 2], buckets)[self.entries.entry]
        pick = np.flatnonzero(code)
        pick = pick[np.lexsort((self.place[pick], self.doc[pick], self.hash[pick]))]
        found: dict[bytes, int] = {}
        self.run, self.of = pick, np.array([found.setdefault(self.text(s, e), len(found)) for s, e in zip(self.lo[pick].tolist(), (self.hi[pick] + SPAN).tolist(), strict=True)], np.int64)
        self.texts, first = list(found), np.unique(self.of, return_index=True)[1]
        self.head, self.several = pick[first], np.bincount(self.of) > 1
        self.bucket, self.hot = bucket_of(self.hash[self.head], buckets).astype(np.int64), code[self.head] == 2
        self.cut = np.flatnonzero(np.r_[True, np.diff(self.bucket) != 0, True]) if len(first) else np.zeros(1, np.int64)

    def sent(self, part: int):
        """Rows for the buckets: hot segments of the kind of the chunk's part, others of kind -1."""
        for s, e in zip(self.cut[:-1].tolist(), self.cut[1:].tolist(), strict=True):
            for hot, kind in ((False, -1), (True, part)):
                k = s + np.flatnonzero(self.hot[s:e] == hot)
                if len(k):
                    i = self.head[k]
                    head = np.stack([self.doc[i], self.place[i], self.hash[i].view(np.int64), np.full(len(k), self.chunk), k - s])
                    yield kind, self.chunk, int(self.bucket[s]), b"\n".join([self.texts[j] for j in k.tolist()]), head.tobytes() + self.several[k].tobytes()

    def gone(self, replies: list[dict]) -> np.ndarray:
        """By word, whether a window that covers it is found earlier."""
        size = (self.hi - self.lo + 1)[self.head]
        base = np.r_[0, np.cumsum(size)]
        found, own = np.zeros(base[-1], np.uint8), np.zeros(base[-1], np.uint8)
        begin = dict(zip(self.bucket[self.cut[:-1]].tolist(), self.cut[:-1].tolist(), strict=True))
        for r in replies:
            if r["kind"] in (7, 8):
                k = begin[r["bucket"]] + np.frombuffer(r["more"], np.int64)
                also = k[self.several[k] & (self.hot[k] == (r["kind"] == 7))]  # the whole bucket tells it of segments that met there only
                for bits, to, j in ((r["data"][: (size[k].sum() + 7) // 8], found, k), (r["data"][(size[k].sum() + 7) // 8 :], own, also)):
                    if bits:
                        to[_ranges(base[j], size[j])] |= np.unpackbits(np.frombuffer(bits, np.uint8), count=size[j].sum())
        first = self.head[self.of]
        later = (self.doc[self.run] != self.doc[first]) | (self.place[self.run] != self.place[first])
        n = size[self.of]
        at = _ranges(base[self.of], n)
        hit = _ranges(self.lo[self.run], n)[np.where(np.repeat(later, n), own[at], found[at]) > 0]
        words = int(self.start[-1])
        edge = np.bincount(hit, minlength=words + SPAN + 1) - np.bincount(hit + SPAN, minlength=words + SPAN + 1)
        return np.cumsum(edge)[:words] > 0


def _ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start, start + 1, ... (n of them) one after another."""
    return np.repeat(start - np.r_[0, np.cumsum(n)][:-1], n) + np.arange(int(n.sum()))


def _shards(rows: list[list[bytes]], doc: np.ndarray, place: np.ndarray, anchor: np.ndarray, more: np.ndarray):
    """stream over shards of whole anchors."""
    order = np.lexsort((place, doc, anchor))
    last = np.r_[np.diff(anchor[order].view(np.int64)) != 0, True][: len(order)]
    found, own = [None] * len(rows), [None] * len(rows)
    at, size = 0, np.cumsum([len(rows[i]) for i in order])
    ends = np.flatnonzero(last) + 1
    while at < len(order):
        end = int(ends[min(len(ends) - 1, np.searchsorted(size[ends - 1], (size[at - 1] if at else 0) + SHARD_WORDS))])
        k = order[at:end].tolist()
        for i, f, o in zip(k, *stream([rows[i] for i in k], list(zip(doc[k].tolist(), place[k].tolist(), strict=True)), more[k].tolist(), last[at:end].tolist()), strict=True):
            found[i], own[i] = f, o
        at = end
    return found, own


def _meet(part: bool, rows_: pa.Table) -> pa.Table:
    """Segments that meet in a bucket, of one part or of all: which of their windows start earlier among them, told to their chunks (7 and 8).

    Of a part, segments with other windows go on to the whole bucket (9).
    """
    rows = rows_.to_pylist()
    n = [len(r["more"]) // 41 for r in rows]
    segs = [seg.split(b" ") for r in rows for seg in r["data"].split(b"\n")]
    doc, place, anchor, chunk, index = np.concatenate([np.frombuffer(r["more"], np.int64, 5 * m).reshape(5, -1) for r, m in zip(rows, n, strict=True)], axis=1)
    more = np.concatenate([np.frombuffer(r["more"], bool, m, 40 * m) for r, m in zip(rows, n, strict=True)])
    found, own = _shards(segs, doc, place, anchor.view(np.uint64), more)
    out, order = [], np.lexsort((index, chunk))
    for k in np.split(order, np.flatnonzero(np.diff(chunk[order])) + 1):
        bits, also = ([x for i in k.tolist() for x in of[i] or ()] for of in (found, own))
        out.append((7 if part else 8, int(chunk[k[0]]), rows[0]["bucket"], np.packbits(bits).tobytes() + (np.packbits(also).tobytes() if also else b""), index[k].tobytes()))
    if part and len(k := np.array([i for i, f in enumerate(found) if not all(f)], np.int64)):
        head = np.stack([doc[k], place[k], anchor[k], chunk[k], index[k]])
        # what a segment's own reference has is settled
        out.append((9, rows[0]["kind"], rows[0]["bucket"], b"\n".join([b" ".join(segs[i]) for i in k.tolist()]), head.tobytes() + bytes(len(k))))
    return packed(out)


def repeats(docs: DataFrame, hot: int | None = None, **sizes) -> DataFrame:
    """For every row of docs (doc_id, text): doc_id, n_words, n_removed, kept_sha256 and removed (a bit by word).

    A word goes if a window of SPAN words that covers it also starts earlier: in a smaller doc_id or before in the same one. Hashes only choose
    where windows that may be equal meet: segments of documents go to the shards of their anchors, are streamed through the suffix automaton of the shard's references, and the matching
    statistics decide. Null texts have no words; rows of one doc_id are copies at the same places, none earlier; rows without doc_id lose and remove
    nothing; an empty table gives no rows; other columns are ignored. Equal segments of one chunk are sent once; those of anchors in more than hot chunks meet
    part by part first.
    """
    plan = Plan(docs.select("doc_id", "text"), **sizes)
    chunked, buckets = plan.chunked(docs.select("doc_id", "text")), plan.buckets

    def first(docs_: pa.Table) -> pa.Table:
        w = Words(docs_, plan.name)
        return packed(w.entries.ask(w.chunk, plan))

    def ask(docs_: pa.Table, replies: pa.Table) -> pa.Table:
        w = Words(docs_, plan.name)
        w.segments(replies.to_pylist(), buckets)
        return packed(list(w.sent(plan.part(w.chunk))))

    def cut(docs_: pa.Table, replies: pa.Table) -> pa.Table:
        w, rows = Words(docs_, plan.name), replies.to_pylist()
        w.segments(rows, buckets)
        gone, out = w.gone(rows), []
        for k, doc in enumerate(w.ids):
            g = gone[w.start[k] : w.start[k + 1]]
            out.append((doc, len(g), int(g.sum()), hashlib.sha256(w.kept(k, g)).hexdigest(), np.packbits(g).tobytes()))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True) if out else [[]] * 5, types, strict=True)], names=[x.split()[0] for x in OUT.split(", ")])

    def meet(replies: DataFrame, f, schema: str) -> DataFrame:
        return chunked.groupBy(plan.name).cogroup(replies.groupBy("chunk")).applyInArrow(by_groups(f), schema)

    counted = counts(chunked.groupBy(plan.name).applyInArrow(by_group(first), PACKED), plan.fan if hot is None else hot)
    asked = meet(counted, ask, PACKED)
    parts = asked.filter("kind >= 0").groupBy("bucket", "kind").applyInArrow(by_group(partial(_meet, True)), PACKED)
    whole = asked.filter("kind < 0").union(parts.filter("kind = 9")).groupBy("bucket").applyInArrow(by_group(partial(_meet, False)), PACKED)
    return meet(counted.union(parts.filter("kind = 7")).union(whole), cut, OUT)


def op5_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return repeats(table(spark, sf_dir, "documents")).drop("removed")


#: The same with windows as texts, as DuckDB reads it.
SQL = r"""
with words as (
  select doc_id, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents
), windows as (
  select doc_id, p, array_to_string(w[p + 1 : p + 20], ' ') as win from (select doc_id, w, unnest(range(0, len(w) - 19)) as p from words where len(w) >= 20)
), later as (
  select doc_id, p from (select doc_id, p, row_number() over (partition by win order by doc_id, p) as k from windows) where k > 1
), gone as (
  select distinct doc_id, unnest(range(p, p + 20)) as p from later
), kept as (
  select doc_id, string_agg(word, ' ' order by p) as t from (select doc_id, unnest(w) as word, unnest(range(0, len(w))) as p from words) anti join gone using (doc_id, p) group by doc_id
)
select doc_id, coalesce(len(w), 0)::bigint as n_words, coalesce(n, 0)::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256
from words left join (select doc_id, count(*) as n from gone group by doc_id) using (doc_id) left join kept using (doc_id)
"""
