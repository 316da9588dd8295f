"""Quality classifier: a sparse ensemble of rules over text statistics, compiled into Spark columns."""

from __future__ import annotations

import math
import operator
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import arrow_map, table

#: Labelled rows that a model is fitted to at most, by smallest hash of doc_id.
SAMPLE_ROWS = 20_000
#: Trees, their depth, bins of a statistic, and the lasso's weight.
TREES, DEPTH, BINS, LASSO = 40, 3, 32, 4e-4
THRESHOLD = 0.3


#: Characters of a text that are measured at once.
PIECE = 1 << 20
STATISTICS = ("log_chars", "word_length", "letters", "upper", "digits", "spaces", "marks", "symbols", "distinct_words", "distinct_lines", "line_length", "stops")
#: Groups of bytes: bytes within a multi-byte character count as letters where they begin one.
_BYTES = {
    "letters": [*range(65, 91), *range(97, 123), *range(192, 256)],
    "upper": range(65, 91),
    "digits": range(48, 58),
    "spaces": (9, 10, 11, 12, 13, 32),
    "marks": b"!?",
    "stops": b".",
    "plain": b".,;:!?'\"()-",
    "inner": range(128, 192),
}
GROUPS = {k: np.isin(np.arange(256), list(v)) for k, v in _BYTES.items()}


def statistics(text: str | None) -> list[float]:
    """STATISTICS of a whole text, a null text counting as empty. Very long texts are measured in parts."""
    hist, words, lines, n_words, n_lines = np.zeros(256, np.int64), set(), set(), 0, 1
    raw, at, open_word, open_line = (text or "").encode(), 0, b"", b""
    while at < len(raw):
        part = raw[at : at + PIECE]
        at += PIECE
        hist += np.bincount(np.frombuffer(part, np.uint8), minlength=256)
        rows = (open_line + part).split(b"\n")
        open_line = rows.pop()
        lines.update(rows)
        n_lines += len(rows)
        part = open_word + part
        split = part.split()
        open_word = split.pop() if split and part[-1:].strip() else b""
        words.update(split)
        n_words += len(split)
    lines.add(open_line)
    if open_word:
        words.add(open_word)
        n_words += 1
    c = {k: int(hist[g].sum()) for k, g in GROUPS.items()}
    n = len(raw) - c["inner"]
    share = lambda a, b: a / b if b else 0.0
    return [
        math.log1p(n), share(n - c["spaces"], n_words), share(c["letters"], n), share(c["upper"], c["letters"]), share(c["digits"], n), share(c["spaces"], n), share(c["marks"], n_words),
        share(n - c["letters"] - c["digits"] - c["spaces"] - c["plain"], n), share(len(words), n_words), share(len(lines), n_lines), share(n, n_lines), share(c["stops"], n_words),
    ]


def measured(docs: DataFrame, prefix: str = "", keep: bool = True) -> DataFrame:
    """docs with a double column for each of STATISTICS of its text, without the text unless keep."""
    fields = [f for f in docs.schema.fields if keep or f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = np.array([statistics(t.as_py()) for t in b.column("text")]).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in fields), *(pa.array(c) for c in found.T)], names=[f.name for f in schema.fields])

    schema = StructType([*fields, *(StructField(prefix + k, DoubleType()) for k in STATISTICS)])
    return arrow_map(docs, run, schema)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def _tree(x: np.ndarray, cuts: list[np.ndarray], g: np.ndarray, h: np.ndarray, at: np.ndarray, path: tuple, depth: int, rules: set, step: np.ndarray, rate: float) -> None:
    """Grow one regression tree on gradients; its paths go to rules and its predictions to step. x holds bin numbers."""
    if path:
        rules.add(tuple(sorted(path)))
    best, total_g, total_h = (1e-6, None), g[at].sum(), h[at].sum()
    base = total_g**2 / (total_h + 1)
    for k, c in enumerate(cuts if depth else []):
        sg, sh, sn = (np.cumsum(np.bincount(x[at, k], weights=w, minlength=len(c) + 1))[:-1] for w in (g[at], h[at], None))
        if len(c):
            gain = sg**2 / (sh + 1) + (total_g - sg) ** 2 / (total_h - sh + 1) - base
            gain[(sn < 5) | (len(at) - sn < 5)] = 0
            if gain.max() > best[0]:
                best = (gain.max(), (k, int(gain.argmax())))
    if best[1] is None:
        step[at] += rate * total_g / (total_h + 1)
        return
    k, b = best[1]
    low = x[at, k] <= b
    for side, rows in (("<=", at[low]), (">", at[~low])):
        _tree(x, cuts, g, h, rows, (*path, (k, side, float(cuts[k][b]))), depth - 1, rules, step, rate)


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS) -> list[tuple]:
    """Rules, each a conjunction ((statistic, <= or >, cut), ...), from all paths of boosted trees."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for c in x.T]
    cuts = [c[c < col.max()] for c, col in zip(cuts, x.T, strict=True)]
    binned = np.stack([np.searchsorted(c, col, "left") for c, col in zip(cuts, x.T, strict=True)], axis=1)
    score, rules = np.full(len(y), np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))), set()
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        _tree(binned, cuts, y - p, p * (1 - p), np.arange(len(y)), (), depth, rules, score, 0.3)
    return sorted(rules)


def holds(rules: list[tuple], x: np.ndarray) -> np.ndarray:
    """Which rules hold in which rows."""
    one = {c: (x[:, c[0]] <= c[2] if c[1] == "<=" else x[:, c[0]] > c[2]) for r in rules for c in r}
    return np.stack([reduce(operator.and_, (one[c] for c in r)) for r in rules], axis=1) if rules else np.zeros((len(x), 0), bool)


def lasso(r: np.ndarray, y: np.ndarray, weight: float = LASSO, steps: int = 400) -> tuple[float, np.ndarray]:
    """Intercept and weights of an L1-penalised logistic regression, by accelerated proximal gradient."""
    a = np.concatenate([np.ones((len(r), 1)), r], axis=1).astype(np.float32)
    rate = 4 / max(1e-9, float(np.linalg.norm(a / np.sqrt(len(a)), 2)) ** 2)
    w = np.zeros(a.shape[1], np.float32)
    w[0] = np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))
    z, t = w.copy(), 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(a @ z)))
        new = z - rate * (a.T @ (p - y).astype(np.float32)) / len(y)
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - rate * weight, 0)
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        z, w = new + np.float32((before - 1) / t) * (new - w), new
    return float(w[0]), w[1:].astype(float)


class RuleModel:
    """Names of statistics, rules with their weights, and an intercept."""

    def __init__(self, names: list[str], rules: list[tuple], intercept: float, weights: list[float]):
        self.names, self.rules, self.intercept, self.weights = names, rules, intercept, weights

    def score(self) -> Column:
        """The probability of a good text, over columns named as the statistics."""
        test = lambda k, side, cut: F.col(self.names[k]) <= cut if side == "<=" else F.col(self.names[k]) > cut
        terms = [F.when(reduce(operator.and_, (test(*c) for c in rule)), w).otherwise(0.0) for rule, w in zip(self.rules, self.weights, strict=True)]
        return 1 / (1 + F.exp(-reduce(operator.add, terms, F.lit(self.intercept))))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> RuleModel:
    """A model of labels (doc_id, quality) fitted on the driver to at most sample_rows labelled documents that are not held out.

    Labels other than 0 and 1 are left out; without both of them the score is a constant.
    """
    known = labels.filter("quality in (0, 1) and doc_id is not null").select("doc_id", "quality").filter(~held_out()).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rows = measured(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id"), keep=False).orderBy("doc_id", *STATISTICS).toPandas()
    names, y = list(STATISTICS), rows["quality"].to_numpy(dtype=float)
    if not len(y) or y.min() == y.max():
        return RuleModel(names, [], float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))), [])
    x = rows[names].to_numpy()
    rules = grow(x, y)
    at, w = lasso(holds(rules, x), y)
    kept = [k for k in np.flatnonzero(w)]
    return RuleModel(names, [rules[k] for k in kept], at, [float(w[k]) for k in kept])


def score(docs: DataFrame, model: RuleModel, keep: bool = True) -> DataFrame:
    """docs (without text unless keep) with score and predicted (1 from THRESHOLD on) for every row; null and empty texts are scored as empty.

    Columns of docs named score or predicted are replaced, all others kept; repeated rows get equal scores and an empty table stays empty.
    """
    docs = measured(docs.drop("score", "predicted"), "_stat_", keep)
    own = RuleModel([f"_stat_{k}" for k in model.names], model.rules, model.intercept, model.weights)
    return docs.withColumn("score", own.score()).drop(*own.names).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op2_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs.select("doc_id", "text"), fit(docs, table(spark, sf_dir, "labels")), keep=False).select("doc_id", held_out().alias("held_out"), "score", "predicted")
