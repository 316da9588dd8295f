"""Language identification with a bidirectional gated recurrent network over bytes."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import arrow_map, table

#: Bounds of the labelled sample: rows a language, and characters of an excerpt of each, at a place that its id chooses.
SAMPLE_ROWS, SAMPLE_CHARS = 240, 4_096
#: Hidden units a direction, sequences a step, steps, and bytes of a sequence when training.
HIDDEN, BATCH, STEPS, TRAIN_BYTES = 16, 384, 240, 40
#: Bytes of a sequence when reading, and sequences read at once; widths they are padded to.
READ_BYTES, WIDE, WIDTHS = 128, 1024, (16, 32, 64, 96, 128)
#: Bytes of text handled at once, and the least score with which the pipeline keeps a text.
PIECE, LEAST = 1 << 21, 0.3
LETTER = regex.compile(r"\p{L}")
UNKNOWN = "und"
#: Bytes whose positions count: ASCII letters and all of multi-byte characters.
COUNTS = np.array([b >= 128 or chr(b).isalpha() for b in range(256)])


def cuts(raw: np.ndarray, begin: np.ndarray, end: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, lengths and owners of the sequences of at most longest bytes that texts [begin, end) of raw are read as, one after another; they end between characters."""
    step = longest - 3
    n = -(-(end - begin) // step)
    of = np.repeat(np.arange(len(begin)), n)
    start = begin[of] + (np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)) * step
    inner = start > begin[of]
    for _ in range(3):
        start = start - (inner & ((raw[start] & 0xC0) == 0x80))
    stop = np.r_[start[1:], 0]
    stop = np.where(np.r_[of[1:] != of[:-1], True], end[of], stop) if len(of) else stop[:0]
    return start, stop - start, of


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """GRU in both directions; every position's two states give the probabilities of the labels."""

    def __init__(self, labels: list[str], seed: int = 7, hidden: int = HIDDEN):
        rng, self.labels, self.hidden = np.random.default_rng(seed), labels, hidden
        shapes = {"xf": (256, 3 * hidden), "xb": (256, 3 * hidden), "uf": (hidden, 3 * hidden), "ub": (hidden, 3 * hidden), "o": (2 * hidden, len(labels)), "c": (len(labels),)}
        self.w = {k: (rng.standard_normal(s) * (0.3 if k[0] != "c" else 0)).astype(np.float32) for k, s in shapes.items()}

    def _run(self, codes: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """States [T, B, hidden] of one direction over codes [B, T]."""
        x, u, n = self.w["x" + d], self.w["u" + d], self.hidden
        h, out = np.zeros((len(codes), n), np.float32), []
        steps = range(codes.shape[1]) if d == "f" else range(codes.shape[1] - 1, -1, -1)
        for t in steps:
            g, hu = x[codes[:, t]], h @ u
            zr = sigmoid(g[:, : 2 * n] + hu[:, : 2 * n])
            z, r = zr[:, :n], zr[:, n:]
            new = np.tanh(g[:, 2 * n :] + r * hu[:, 2 * n :])
            if keep is not None:
                keep.append((t, h, z, r, new, hu[:, 2 * n :]))
            h = new + z * (h - new)
            out.append(h)
        return np.stack(out if d == "f" else out[::-1])

    def positions(self, codes: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Label probabilities [T, B, labels] of every position of equally long sequences."""
        h = np.concatenate([self._run(codes, d, keep.setdefault(d, []) if keep is not None else None) for d in "fb"], axis=2)
        e = h @ self.w["o"] + self.w["c"]
        p = np.exp(e - e.max(axis=2, keepdims=True))
        p /= p.sum(axis=2, keepdims=True)
        if keep is not None:
            keep["h"] = h
        return p

    def gradients(self, codes: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        """Back-propagation through time of the mean cross-entropy of all positions."""
        keep: dict = {}
        e = self.positions(codes, keep)
        e[:, np.arange(len(codes)), label] -= 1
        e /= codes.size
        n, h = self.hidden, keep["h"]
        out = {"o": h.reshape(-1, 2 * n).T @ e.reshape(-1, e.shape[2]), "c": e.sum(axis=(0, 1))}
        back = e @ self.w["o"].T
        for k, d in enumerate("fb"):
            u, du, dh = self.w["u" + d], np.zeros_like(self.w["u" + d]), np.zeros((len(codes), n), np.float32)
            at, seen = [], []
            for t, before, z, r, new, hun in reversed(keep[d]):
                dh = dh + back[t, :, k * n : (k + 1) * n]
                dn = dh * (1 - z) * (1 - new * new)
                dz, dr = dh * (before - new) * z * (1 - z), dn * hun * r * (1 - r)
                dhu = np.concatenate([dz, dr, dn * r], axis=1)
                du += before.T @ dhu
                at.append(np.concatenate([dz, dr, dn], axis=1))
                seen.append(codes[:, t])
                dh = dh * z + dhu @ u.T
            at, seen = np.concatenate(at), np.concatenate(seen)
            order = np.argsort(seen, kind="stable")
            first = np.flatnonzero(np.r_[True, np.diff(seen[order]) != 0])
            dx = np.zeros_like(self.w["x" + d])
            dx[seen[order][first]] = np.add.reduceat(at[order], first)
            out |= {"u" + d: du, "x" + d: dx}
        return out

    def fit(self, texts: list[bytes], label: np.ndarray, steps: int = STEPS, batch: int = BATCH, rate: float = 0.02, seed: int = 7) -> Network:
        """Adam over batches of equally long sequences of texts, drawn by how often each length occurs."""
        by, rng = defaultdict(list), np.random.default_rng(seed)
        raw, size = np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts], np.int64)
        start, n, of = cuts(raw, np.cumsum(size) - size, np.cumsum(size), TRAIN_BYTES)
        for length in np.unique(n):
            own = np.flatnonzero(n == length)
            by[int(length)] = (raw[start[own][:, None] + np.arange(length)], label[of[own]])
        groups = list(by.values())
        share = np.array([len(y) for _, y in groups], float)
        m, v = ({k: np.zeros_like(x) for k, x in self.w.items()} for _ in range(2))
        for i in range(1, steps + 1 if groups else 1):
            codes, y = groups[rng.choice(len(groups), p=share / share.sum())]
            at = rng.integers(len(y), size=min(batch, len(y)))
            now = rate * min(1, 2 * (1 - i / (steps + 1)))
            for k, g in self.gradients(codes[at], y[at]).items():
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.01 * (g * g - v[k])
                self.w[k] -= (now * (m[k] / (1 - 0.9**i)) / (np.sqrt(v[k] / (1 - 0.99**i)) + 1e-8)).astype(np.float32)
        return self

    def sums(self, codes: np.ndarray, size: np.ndarray) -> np.ndarray:
        """For sequences codes [T, B] of size bytes, zeros after them: the sums of counted positions' probabilities and, last, their number.

        The same as positions, laid out so that all arithmetic runs along the sequences.
        """
        n, width, (t_, b_) = self.hidden, len(self.labels), codes.shape
        states = []
        live = np.arange(t_)[:, None] < size
        for d in "fb":
            x, u = np.ascontiguousarray(self.w["x" + d].T), np.ascontiguousarray(self.w["u" + d].T)
            out, g, hu = np.empty((t_, n, b_), np.float32), np.empty((3 * n, b_), np.float32), np.empty((3 * n, b_), np.float32)
            before = np.zeros((n, b_), np.float32)
            for t in range(t_) if d == "f" else range(t_ - 1, -1, -1):
                np.take(x, codes[t], axis=1, out=g, mode="clip")
                np.dot(u, before, out=hu)
                zr, new = hu[: 2 * n], hu[2 * n :]
                zr += g[: 2 * n]
                zr *= 0.5
                np.tanh(zr, out=zr)
                zr *= 0.5
                zr += 0.5
                new *= zr[n:]
                new += g[2 * n :]
                np.tanh(new, out=new)
                h = out[t]
                np.subtract(before, new, out=h)
                h *= zr[:n]
                h += new
                if d == "b":
                    h *= live[t]  # the reading from the right begins at each sequence's end
                before = h
            states.append(out)
        o = np.ascontiguousarray(self.w["o"].T)
        total = np.zeros((width + 1, b_))
        for t in range(t_):
            e = o[:, :n] @ states[0][t] + o[:, n:] @ states[1][t] + self.w["c"][:, None]
            e -= e.max(axis=0)
            np.exp(e, out=e)
            c = COUNTS[codes[t]] & live[t]
            e *= c / e.sum(axis=0)
            total[:-1] += e
            total[-1] += c
        return total.T


class Scorer:
    """Scores texts: all bytes are read, as sequences of READ_BYTES that cross word borders, and probabilities are pooled over each text."""

    def __init__(self, net: Network):
        self.net = net

    def pooled(self, raws: list[bytes]) -> np.ndarray:
        """Of each text the sums of its counted positions' probabilities and, last, their number."""
        out = np.zeros((len(raws), len(self.net.labels) + 1))
        size = np.array([len(r) for r in raws], np.int64)
        raw = np.frombuffer(b"".join([*raws, bytes(READ_BYTES)]), np.uint8)
        start, n, of = cuts(raw, np.cumsum(size) - size, np.cumsum(size), READ_BYTES)
        low = 0
        for width in WIDTHS:
            own = np.flatnonzero((n > low) & (n <= width))
            low = width
            for k in (own[i : i + WIDE] for i in range(0, len(own), WIDE)):
                at = np.arange(width)[:, None]
                codes = np.where(at < n[k], raw[np.minimum(start[k] + at, len(raw) - 1)], np.uint8(0))
                np.add.at(out, of[k], self.net.sums(codes, n[k]))
        return out

    def score(self, texts: list[str | None]) -> list[tuple[str, float]]:
        found = [bool(self.net.labels) and LETTER.search(t or "") is not None for t in texts]
        sums = np.zeros((len(texts), len(self.net.labels) + 1))
        held: list[tuple[int, bytes]] = []
        size = 0
        for k, text in enumerate(texts):
            if found[k]:
                raw = text.encode()
                for a in range(0, len(raw), PIECE):  # a very long text is read in parts
                    held.append((k, raw[a : a + PIECE]))
                    size += len(held[-1][1])
                    if size >= PIECE:
                        self._add(sums, held)
                        held, size = [], 0
        self._add(sums, held)
        return [self._one(f, s) for f, s in zip(found, sums, strict=True)]

    def _add(self, sums: np.ndarray, held: list[tuple[int, bytes]]) -> None:
        if held:
            np.add.at(sums, [k for k, _ in held], self.pooled([r for _, r in held]))

    def _one(self, found: bool, sums: np.ndarray) -> tuple[str, float]:
        if not found or not sums[-1]:
            return UNKNOWN, 0.0
        p = sums[:-1] / sums[-1]
        k = int(p.argmax())
        return self.net.labels[k], round(float(min(1, max(0, p[k]))), 6)


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_chars: int = SAMPLE_CHARS) -> Network:
    """A network fitted on the driver to excerpts of at most sample_chars characters of at most sample_rows labelled rows a language.

    Rows are those with the smallest hash of their doc_id that are not held out; which share of the hashes is needed follows from a language's count of rows, so no
    task gathers a language. An excerpt begins where the id chooses; a text that is no longer is taken whole. Rows without text, lang or doc_id take no part.
    """
    known = docs.select("doc_id", "lang", "text").filter(~held_out() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    counts = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row a language
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    # a margin of a half and of some rows, so that the smallest sample_rows hashes are among them
    need = {x: min(1 << 40, int((1.5 * sample_rows + 50) / n * (1 << 40))) for x, n in counts.items()}
    if not need:
        return Network([])
    bound = F.create_map(*(F.lit(v) for x in sorted(need) for v in (x, need[x])))
    start = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.greatest(F.length("text") - sample_chars, F.lit(0)) + 1).cast("int") + 1
    rows = known.filter(draw <= F.element_at(bound, F.col("lang"))).select("lang", draw.alias("k"), "doc_id", F.substring("text", start, F.lit(sample_chars)).alias("text")).collect()
    by: dict[str, list] = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.k, r.doc_id, r.text)):
        if len(by[r.lang]) < sample_rows:
            by[r.lang].append(r.text.encode())
    labels = sorted(by)
    net = Network(labels)
    return net.fit([t for x in labels for t in by[x]], np.repeat(np.arange(len(labels)), [len(by[x]) for x in labels])) if len(labels) > 1 else net


def identify(docs: DataFrame, net: Network) -> DataFrame:
    """docs with lang_pred and score for every row's whole text; docs needs a text column, its others are kept.

    A null text, or one without any letter, is und with score 0, as is everything if nothing was learnt. The score is the mean probability of
    the predicted label over all counted positions; of equal probabilities the label first in order wins. doc_id plays no part, so it may be null or repeated; an empty table gives
    no rows. Columns of docs named lang_pred or score are replaced.
    """
    docs = docs.drop("lang_pred", "score")
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(net)
        for b in batches:
            found = scorer.score(b.column(names.index("text")).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())], names=[*names, "lang_pred", "score"])

    return arrow_map(docs, run, StructType([*docs.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())]))


def accept(docs: DataFrame, net: Network, least: float = LEAST) -> DataFrame:
    """The rows of docs, all columns as they are, whose text has a language: rows found und go, and so do those whose label has a score below least.

    Of four languages read in equal parts each gives 0.25, a text of one language about 0.99, single words 0.3 to 0.6.
    """
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(net)
        for b in batches:
            yield b.filter(pa.array([x != UNKNOWN and p >= least for x, p in scorer.score(b.column(at).to_pylist())], pa.bool_()))

    return arrow_map(docs, run, docs.schema)


def op4_langid(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), train(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
