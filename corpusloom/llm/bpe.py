"""BPE encoding and decoding with a pair occurrence index."""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import KEPT, arrow_map, table

#: Fixed value: the split pattern of the vocabulary file's pre-tokenizer, and the same over ASCII.
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
ASCII_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")
SPACE = re.compile(r"[ \n\t\r]")

#: Characters of a text handled at once, and words kept in a worker's cache.
PIECE, CACHE_WORDS = 1 << 18, 400_000
#: Words of one occurrence index; a few hundred keep it within a processor's cache.
INDEX_WORDS = 512
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    kept = [b for lo, hi in ((33, 126), (161, 172), (174, 255)) for b in range(lo, hi + 1)]
    others = iter(range(256, 512))
    return [chr(b if b in set(kept) else next(others)) for b in range(256)]


class Vocabulary:
    """Merges, token strings and special strings of a word-level BPE file, read on the driver and sent to the tasks."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        model, suffix = data["model"], data["model"]["end_of_word_suffix"]
        vocab = model["vocab"]
        self.token = {i: t for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.token |= {i: t for t, i in self.special.items()}
        chars = byte_chars()
        self.inner, self.final = [vocab[c] for c in chars], [vocab[c + suffix] for c in chars]
        self.left, self.right, self.made = array("i"), array("i"), array("i")
        for m in model["merges"]:
            a, b = m if isinstance(m, list) else m.split(" ")
            for to, t in ((self.left, a), (self.right, b), (self.made, a + b)):
                to.append(vocab[t])
        self.digest = hashlib.sha256(f"{sorted(self.token.items())}{self.made.tobytes()}".encode()).hexdigest()

    def ranks(self) -> dict[int, int]:
        return {a << 20 | b: r for r, (a, b) in enumerate(zip(self.left, self.right, strict=True))}


class Encoder:
    """Encodes words in batches. Words met before come from a bounded cache of two generations: when the younger is full it becomes the
    older, from which words that are met again are taken over."""

    def __init__(self, vocabulary: Vocabulary, cache_words: int = CACHE_WORDS):
        self.v, self.rank, self.cache_words = vocabulary, vocabulary.ranks(), cache_words
        self.token = [t.encode() for _, t in sorted(vocabulary.token.items())] if max(vocabulary.token) + 1 == len(vocabulary.token) else {i: t.encode() for i, t in vocabulary.token.items()}
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(vocabulary.special, key=len, reverse=True))) + ")") if vocabulary.special else None
        self.ids: dict[str, bytes] = {t: i.to_bytes(4, "little") for t, i in vocabulary.special.items()}
        self.old: dict[str, bytes] = {}

    def shown(self, ids: bytes) -> bytes:
        """The token strings of packed ids, joined by blanks: a file without a decoder asks for that."""
        return b" ".join(map(self.token.__getitem__, memoryview(ids).cast("I").tolist()))

    def merge(self, words: list[bytes]) -> list[list[int]]:
        """Token ids of each word. All words stand in one row of symbols; each active pair's rank has the list of its
        positions, ranks are applied in ascending order, and the lists of the pairs next to a merge are updated."""
        inner, final, rank, left, right, made = self.v.inner, self.v.final, self.rank, self.v.left, self.v.right, self.v.made
        sym: list[int] = []
        for w in words:
            sym += [inner[b] for b in w[:-1]]
            sym.append(final[w[-1]])
            sym.append(-1)  # between words
        nxt, prv = list(range(1, len(sym) + 1)), list(range(-1, len(sym) - 1))
        at: dict[int, list[int]] = {}
        get = rank.get
        for p, (a, b) in enumerate(zip(sym, sym[1:], strict=False)):
            if a >= 0 <= b and (r := get(a << 20 | b)) is not None:
                at.setdefault(r, []).append(p)
        active = list(at)
        heapify(active)
        while active:
            r = heappop(active)
            a, b, m = left[r], right[r], made[r]
            first = m << 20
            for p in sorted(at.pop(r)):
                q = nxt[p]
                if sym[p] != a or sym[q] != b:
                    continue
                n, l = nxt[q], prv[p]
                sym[p], sym[q], nxt[p], prv[n] = m, -2, n, p
                if (y := sym[n]) >= 0 and (s := get(first | y)) is not None:
                    if s in at:
                        at[s].append(p)
                    else:
                        at[s] = [p]
                        heappush(active, s)
                if l >= 0 and (x := sym[l]) >= 0 and (s := get(x << 20 | m)) is not None:
                    if s in at:
                        at[s].append(l)
                    else:
                        at[s] = [l]
                        heappush(active, s)
        out, word = [], []
        for s in sym:
            if s >= 0:
                word.append(s)
            elif s == -1:
                out.append(word)
                word = []
        return out

    def words(self, text: str) -> list[str]:
        """The pieces of a text that are encoded on their own; special strings are kept as they are."""
        if self.special and "<|" in text and len(parts := self.special.split(text)) > 1:
            return [w for k, part in enumerate(parts) for w in ([part] if k % 2 else self.plain(part))]
        return self.plain(text)

    @staticmethod
    def plain(text: str) -> list[str]:
        if text.isascii():
            return ASCII_SPLIT.findall(text.lower())
        return SPLIT.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def learn(self, words: set[str]) -> None:
        """Make ids of all words known; makes room first."""
        if len(self.ids) > self.cache_words // 2:
            self.old, self.ids = self.ids, {t: self.ids[t] for t in self.v.special}
        missing = words - self.ids.keys()
        again = missing & self.old.keys()
        self.ids.update((w, self.old[w]) for w in again)
        new = list(missing - again)
        for k in range(0, len(new), INDEX_WORDS):
            part = new[k : k + INDEX_WORDS]
            for w, ids in zip(part, self.merge([w.encode() for w in part]), strict=True):
                self.ids[w] = array("I", ids).tobytes()


def encoder(vocabulary: Vocabulary) -> Encoder:
    """The encoder that this worker's tasks share until another operator runs in it."""
    if "bpe" not in KEPT or KEPT["bpe"].v.digest != vocabulary.digest:
        KEPT["bpe"] = Encoder(vocabulary)
    return KEPT["bpe"]


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """A text cut after white space, which no token spans, into pieces of about size characters."""
    at = 0
    while at < len(text):
        m = SPACE.search(text, at + size)
        end = m.end() if m else len(text)
        yield text[at:end]
        at = end


def encode(docs: DataFrame, vocabulary: Vocabulary, with_ids: bool = False) -> DataFrame:
    """Digest columns (and, with_ids, the ids and the decoded text) of every row of docs (doc_id, text).

    A null or empty text, or one of white space, has no tokens. Very long texts are cut into pieces after white space,
    so a task holds a piece, its cache and, with_ids, one text's ids. Repeated rows give repeated results; other columns of docs
    are ignored. Decoding joins the token strings with blanks, as a file without a decoder asks for.
    """
    schema = SCHEMA + (", ids array<int>, decoded string" if with_ids else "")

    names = [x.split()[0] for x in schema.split(", ")]

    def made(rows: list) -> pa.RecordBatch:
        """rows (doc_id, digest of ids, digest of text, n_tokens, packed ids, decoded parts) of finished texts."""
        cols = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.int64()), *(pa.array([r[k].hexdigest() for r in rows], pa.string()) for k in (1, 2))]
        if with_ids:
            offsets = np.r_[0, np.cumsum([r[3] for r in rows])].astype(np.int32)
            cols.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(x for r in rows for x in r[4]), np.int32))))
            cols.append(pa.array([b" ".join(r[5]).decode() for r in rows], pa.string()))
        return pa.RecordBatch.from_arrays(cols, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        group: list = []  # (state of a text, words of its next piece or None at its end)
        held = 0

        def settle():
            enc.learn({w for _, words in group if words for w in words})
            out = []
            for state, words in group:
                if words:
                    ids = b"".join(map(enc.ids.__getitem__, words))
                    shown = enc.shown(ids)
                    state[1].update(ids)
                    state[2].update(b" " + shown if state[3] else shown)
                    state[3] += len(ids) // 4
                    if with_ids:
                        state[4].append(ids)
                        state[5].append(shown)
                elif words is None:
                    out.append(state)
            group.clear()
            return made(out)

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                state = [doc, hashlib.sha256(), hashlib.sha256(), 0, [], []]
                for piece in pieces(text.as_py() or ""):
                    group.append((state, enc.words(piece)))
                    held += len(piece)
                    if held > PIECE * 4:
                        yield settle()
                        held = 0
                group.append((state, None))
        yield settle()

    return arrow_map(docs.select("doc_id", "text"), run, schema, "bpe")


def op9_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode(table(spark, sf_dir, "documents"), Vocabulary(public_tokenizers.path("word_bpe_49k.json")))
