"""Embedding near-dedup: random-hyperplane signs in several tables, exact cosines and connected components."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .buckets import binaries, forest, links, near_bits
from .chunks import mix
from .common import arrow_map, checkpoint, table
from .components import connected_components

#: Cosine from which two vectors link; tables and sign bits a table. Two vectors at the threshold agree in a bit with probability
#: 0.88, so in all of a table's bits with 0.168 and in some table with 0.988; nearer ones meet more surely.
COSINE, TABLES, BITS, SEED = 0.93, 24, 14, 11
#: Sign bits that go with a row to its tables, and how many of them may differ for a pair to go on: at the threshold 15 +- 4 do, of
#: unrelated vectors 64 +- 6.
SKETCH, FEW = 128, 34
#: Vectors of a bucket that are compared at once.
CHUNK = 1024


def sign_bits(x: np.ndarray, tables: int = TABLES, bits: int = BITS, seed: int = SEED) -> np.ndarray:
    """Booleans [n, tables * bits]: the sides of fixed random hyperplanes on which vectors [n, dims] lie."""
    return x @ np.random.default_rng(seed).standard_normal((x.shape[1], tables * bits)) > 0


def signatures(bits: np.ndarray) -> np.ndarray:
    """Keys [n, TABLES] of the tables."""
    return (bits.reshape(len(bits), TABLES, BITS) << np.arange(BITS)).sum(axis=2).astype(np.uint16)


def _vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of a column of lists of finite numbers: places and double vectors of one length, scaled to a largest component of 1."""
    flat, offsets = column.flatten().to_numpy(zero_copy_only=False).astype(float), column.offsets.to_numpy() - column.offsets[0].as_py()
    size = np.diff(offsets)
    for dims in np.unique(size):
        own = np.flatnonzero(size == dims)
        for at in np.array_split(own, -(-len(own) // 2048)):
            x = flat[offsets[at][:, None] + np.arange(dims)]
            yield at, x / np.abs(x).max(axis=1, keepdims=True)


def _deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, label, vec) to a row (g, id, data) for each table: g tells label, dimensions, table (its low bits) and signs; data is a sketch."""
    for b in batches:
        ids, label = (b.column(k).to_numpy(zero_copy_only=False) for k in range(2))
        for at, x in _vectors(b.column(2)):
            bits = sign_bits(x)
            s, sketch = signatures(bits), binaries(np.repeat(np.packbits(bits[:, :SKETCH], axis=1), TABLES, axis=0))
            key = mix(mix(label[at].astype(np.int64).view(np.uint64) + np.uint64(x.shape[1] << 32))[:, None] + s.astype(np.uint64) * np.uint64(64) + np.arange(TABLES, dtype=np.uint64))
            g = ((key >> np.uint64(6) << np.uint64(6)) | np.arange(TABLES, dtype=np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(g.ravel()), pa.array(np.repeat(ids[at], TABLES)), sketch], names=["g", "id", "data"])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (g, id, n, label, vec) to (g, id, data): n and label, signatures and unit vector."""
    for b in batches:
        g, ids, n, label = (b.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(4))
        for at, x in _vectors(b.column(4)):
            unit = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
            raw = np.concatenate([np.stack([n[at], label[at]], axis=1).view(np.uint8), signatures(sign_bits(x)).view(np.uint8), unit.view(np.uint8)], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(g[at]), pa.array(ids[at]), binaries(raw)], names=["g", "id", "data"])


def near_cosines(cosine: float, g: np.ndarray, data: list[bytes], lo, hi, lo2=None, hi2=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spanning links of the pairs of cosine or more that meet in no table before that of g, and for each vector in such pairs how many vectors they add."""
    x, y, w = [], [], []
    for k, (s, e) in enumerate(zip(lo, hi, strict=True)):
        t, own = int(g[s]) & 63, np.arange(s, e) if lo2 is None else np.r_[np.arange(s, e), np.arange(lo2[k], hi2[k])]
        size = np.array([len(data[i]) for i in own])
        for width in np.unique(size):  # vectors of other lengths met through equal hashes only
            at = own[size == width]
            raw = np.frombuffer(b"".join([data[i] for i in at]), np.uint8).reshape(len(at), -1)
            (n, label), signs = np.ascontiguousarray(raw[:, :16]).view(np.int64).T, np.ascontiguousarray(raw[:, 16 : 16 + 2 * TABLES]).view(np.uint16)
            v = np.ascontiguousarray(raw[:, 16 + 2 * TABLES :]).view(float)
            cut = len(at) if lo2 is None else int((at < e).sum())
            a, b = np.nonzero(v[:cut] @ (v if lo2 is None else v[cut:]).T >= cosine)
            b = b if lo2 is None else b + cut
            keep = (a < b) & (label[a] == label[b])
            a, b = a[keep], b[keep]
            fresh = ~(signs[a, :t] == signs[b, :t]).any(axis=1)
            a, b = a[fresh], b[fresh]
            extra = np.bincount(a, weights=n[b], minlength=len(at)) + np.bincount(b, weights=n[a], minlength=len(at))
            u, r = forest(len(at), a, b)
            some = np.flatnonzero(extra)
            x += [at[u], at[some]]
            y += [at[r], at[some]]
            w += [np.zeros(len(u), np.int64), extra[some].astype(np.int64)]
    join = lambda z: np.concatenate(z) if z else np.zeros(0, np.int64)
    return join(x), join(y), join(w)


def near_vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of rows (vec_id, embedding, label).

    Equal vectors of a label are one class before anything is dealt to tables, so copies cost nothing more. Only ids and sketches of signs go to all
    tables; vectors follow to the buckets in which a sketch has another near it, where cosines are computed. A pair is counted in the first table in which it
    meets. Vectors that are null, empty or zero, hold null or non-finite components, or have no label or no vec_id link with nothing
    (a row without vec_id has no component_id and is kept); vectors
    of different lengths never link. Repeated rows are vectors of their own. An empty table gives no rows; other columns are ignored.
    """
    vec = F.col("embedding")
    fine = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & vec.isNotNull() & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(vec, lambda x: x != 0)
    base = rows.select("vec_id", F.col("label").cast("long").alias("label"), vec.alias("vec"), F.coalesce(fine, F.lit(False)).alias("fine"))
    base = base.withColumn("k1", F.when(F.col("fine"), F.xxhash64("vec", "label"))).withColumn("k2", F.when(F.col("fine"), F.xxhash64("label", "vec", F.lit(1))))
    # classes have numbers of their own, for rows of one vec_id may hold several vectors
    classes = base.filter("fine").groupBy("k1", "k2").agg(F.min("vec_id").alias("node"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("vec").alias("vec"))
    classes = checkpoint(classes.withColumn("id", F.monotonically_increasing_id()))
    near = links(arrow_map(classes.select("id", "label", "vec"), _deal, "g long, id long, data binary"), partial(near_bits, FEW))
    asked = near.select("g", F.explode(F.array("u", "v")).alias("id")).distinct()
    packed = arrow_map(asked.join(classes, "id").select("g", "id", "n", "label", "vec"), _pack, "g long, id long, data binary")
    found = checkpoint(links(packed, partial(near_cosines, COSINE), CHUNK))
    comp = checkpoint(connected_components(found.filter("u != v").select("u", "v")).withColumnRenamed("node", "id"))
    least = comp.join(classes.select("id", "node"), "id").groupBy("component").agg(F.min("node").alias("component_id"))
    extra = found.filter("u = v").groupBy("u").agg(F.sum("w").alias("extra")).withColumnRenamed("u", "id")
    named = classes.select("k1", "k2", "id", "node", "n").join(comp.join(least, "component").select("id", "component_id"), "id", "left").join(extra, "id", "left")
    named = named.select("k1", "k2", (F.col("n") - 1 + F.coalesce("extra", F.lit(0))).alias("n_links"), F.coalesce("component_id", "node").alias("component_id"))
    out = base.select("vec_id", "k1", "k2").join(named, ["k1", "k2"], "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")).withColumn("kept", F.expr("vec_id <=> component_id"))


def op6_embeddings(spark, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
