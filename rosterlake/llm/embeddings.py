"""Near duplicates of embeddings by randomised-rotation binary codes.

Vectors that are equal in every component are one class. Every class vector is scaled to length one and turned
by random rotations (fixed by a seed and the vector length):

* The signs after the first rotation P are its binary code x = sign(Po) / sqrt(D), stored with the correction
  factor f = <x, Po>. For any unit vector q, <x, Pq> / f is an unbiased estimate of <o, q>, off by at most
  ``CONFIDENCE * sqrt((1 - f^2) / f^2 / (D - 1))`` with near certainty.
* Disjoint groups of ``bits`` signs over several rotations are the bucket keys of ``tables`` tables. Two vectors
  at the threshold angle agree in one sign with probability 1 - angle / pi, hence meet in no table with
  probability (1 - (1 - angle / pi)^bits)^tables; ``tables`` is chosen to hold this under ``miss``.

Inside a bucket (in pairs of blocks, so a bucket may have any size) the estimates of all pairs are computed; a
pair whose upper confidence bound, in both directions, reaches the threshold is recomputed exactly in double
precision. A linked pair counts in the first table where it meets, so no pair is counted twice or sent as a row.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

THRESHOLD, MISS, CONFIDENCE, BLOCK, BUCKET, SEED = 0.95, 1e-4, 5.0, 1024, 64, 11


def rotation(size: int, number: int) -> np.ndarray:
    """Random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng([SEED, size, number]).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def plan(rows: int, threshold: float = THRESHOLD, miss: float = MISS) -> tuple[int, int]:
    """Bits per table, so a bucket of unrelated vectors has about BUCKET rows, and the number of tables."""
    bits = max(4, math.ceil(math.log2(max(rows, 1) / BUCKET))) if rows > BUCKET else 4
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log(1 - meet))


def unit_rows(vectors: list) -> np.ndarray:
    x = np.array([np.asarray(v, np.float64) for v in vectors])
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow in the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def buckets(unit: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """(rows, tables) bucket keys from the signs after as many rotations as the tables need."""
    size = unit.shape[1]
    rotations = -(-bits * tables // size)
    signs = np.concatenate([unit @ rotation(size, k).T >= 0 for k in range(rotations)], axis=1)
    power = np.uint64(1) << np.arange(bits, dtype=np.uint64)
    keys = [(signs[:, t * bits:(t + 1) * bits] * power).sum(axis=1, dtype=np.uint64) for t in range(tables)]
    return np.stack([common.mix(common.mix(k) + np.uint64((t * 4096 + bits) << 32 | size)) for t, k in enumerate(keys)], axis=1)


def codes(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Turned vectors, their signs and correction factors."""
    size = unit.shape[1]
    turned = unit @ rotation(size, 0).T
    return turned, turned >= 0, np.abs(turned).sum(axis=1) / math.sqrt(size)


def by_length(vectors: list) -> list[np.ndarray]:
    length = np.array([len(v) for v in vectors])
    return [np.flatnonzero(length == n) for n in np.unique(length)]


def bucket_rows(classes: DataFrame, bits: int, tables: int) -> DataFrame:
    def build(frames):
        for frame in frames:
            ids, vectors = frame["rep"].to_numpy(), frame["embedding"].to_list()
            for rows in by_length(vectors):
                keys = buckets(unit_rows([vectors[i] for i in rows]), bits, tables)
                yield pd.DataFrame({"node": common.as_long(keys.reshape(-1)), "rep": np.repeat(ids[rows], tables)})

    return classes.select("rep", "embedding").mapInPandas(build, "node long, rep long")


def coded(classes: DataFrame) -> DataFrame:
    """Class table with the binary code and the correction factor of every vector."""
    def build(frames):
        for frame in frames:
            vectors = frame["embedding"].to_list()
            signs, factors = [b""] * len(vectors), np.zeros(len(vectors))
            for rows in by_length(vectors):
                _, s, f = codes(unit_rows([vectors[i] for i in rows]))
                for i, code, factor in zip(rows, np.packbits(s, axis=1), f):
                    signs[i], factors[i] = code.tobytes(), factor
            yield frame.assign(code=signs, factor=factors)

    return classes.mapInPandas(build, "rep long, first_id long, hi long, lo long, n_rows_equal long, embedding array<float>, code binary, factor double")


def close_pairs(unit, code, factor, threshold: float, across: np.ndarray | None):
    """(left, right) of the pairs at or above the threshold; ``across`` limits them to different parts."""
    n, size = unit.shape
    turned = (unit @ rotation(size, 0).T).astype(np.float32)
    signs = ((np.unpackbits(code, axis=1, count=size).astype(np.float32)) * 2 - 1) / math.sqrt(size)
    slack = CONFIDENCE * np.sqrt((1 - np.minimum(factor, 1) ** 2) / factor**2 / max(size - 1, 1))
    none = np.empty(0, np.int64)
    lefts, rights = [none], [none]
    for start in range(0, n, 256):
        rows = slice(start, start + 256)
        bound = signs[rows] @ turned.T / factor[rows, None] + slack[rows, None]
        other = turned[rows] @ signs.T / factor + slack
        near = (bound >= threshold) & (other >= threshold)
        left, right = np.nonzero(near)
        left += start
        keep = left < right
        if across is not None:
            keep &= across[left] != across[right]
        left, right = left[keep], right[keep]
        for s in range(0, len(left), 1 << 16):
            a, b = left[s:s + (1 << 16)], right[s:s + (1 << 16)]
            sure = np.einsum("ij,ij->i", unit[a], unit[b]) >= threshold - 1e-12
            lefts.append(a[sure])
            rights.append(b[sure])
    return np.concatenate(lefts), np.concatenate(rights)


def linked(placed: DataFrame, classes: DataFrame, bits: int, tables: int, threshold: float) -> DataFrame:
    """Per class and block pair: linked vectors of other classes that meet here first, and a root it links with."""
    keys = ["node", "low", "high"]

    def compare(frames):
        for frame in common.whole_groups(frames, keys):
            cut = common.bounds(frame, keys)
            ids, parts, equal = (frame[c].to_numpy() for c in ("rep", "part", "n_rows_equal"))
            vectors, code, factor = frame["embedding"].to_list(), frame["code"].to_list(), frame["factor"].to_numpy()
            nodes, low, high = (frame[c].to_numpy() for c in keys)
            out = []
            for s, e in zip(cut[:-1], cut[1:]):
                across = parts[s:e] if low[s] != high[s] else None
                if e - s < 2 or (across is not None and (across == across[0]).all()):
                    continue
                unit = unit_rows(vectors[s:e])
                left, right = close_pairs(unit, np.array([np.frombuffer(c, np.uint8) for c in code[s:e]]), factor[s:e], threshold, across)
                if not len(left):
                    continue
                met = buckets(unit, bits, tables)
                here = met[left] == met[right]
                own = common.as_long(np.take_along_axis(met[left], here.argmax(axis=1)[:, None], axis=1)[:, 0])
                first = own == nodes[s]
                count = np.bincount(left[first], equal[s:e][right[first]], minlength=e - s)
                count += np.bincount(right[first], equal[s:e][left[first]], minlength=e - s)
                root = common.smallest_roots(e - s, left, right)
                some = np.unique(np.concatenate([left, right]))
                out.append(pd.DataFrame({"rep": ids[s:e][some], "links": count[some].astype(np.int64), "root": ids[s:e][root[some]]}))
            if out:
                yield pd.concat(out)

    rows = placed.join(classes.select("rep", "n_rows_equal", "embedding", "code", "factor"), "rep")
    return (rows.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(compare, "rep long, links long, root long")
            .groupBy("rep", "root").agg(F.sum("links").alias("links")))


def near_vectors(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", threshold: float = THRESHOLD,
                 miss: float = MISS) -> DataFrame:
    """A row per vector: ``vec_id``, ``n_links`` (other vectors with cosine >= threshold), ``component_id`` and ``kept``.

    Null, empty and zero vectors and those with a null or non-finite component link with nothing. Vectors of
    different length never link. A null id comes back unlinked with a null component; rows that repeat an id are
    vectors of their own.
    """
    spark = vectors.sparkSession
    common.prepare(spark)
    vector = F.col(vector_column).cast("array<float>")
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), vector.alias("embedding"))
    # float32 overflows to infinity, so the test is on what is compared
    usable = (F.size("embedding") > 0) & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) \
        & F.exists("embedding", lambda x: x != 0)
    plain = F.transform("embedding", lambda x: x + F.lit(0.0).cast("float"))  # -0.0 becomes 0.0
    known = F.coalesce(usable, F.lit(False)) & F.col("vec_id").isNotNull()
    keyed = rows.withColumn("hi", F.when(known, F.xxhash64(plain))).withColumn("lo", F.when(known, F.xxhash64(plain, F.lit(1))))
    classes = (keyed.where("hi IS NOT NULL").groupBy("hi", "lo").agg(
        F.count(F.lit(1)).alias("n_rows_equal"), F.min(F.struct("vec_id", "embedding")).alias("x"))
        .select(F.monotonically_increasing_id().alias("rep"), F.col("x.vec_id").alias("first_id"), "hi", "lo", "n_rows_equal", "x.embedding"))
    classes = common.store(coded(common.store(classes, "equal")), "classes")
    bits, tables = plan(classes.count(), threshold, miss)
    placed = bucket_rows(classes, bits, tables)
    sizes = common.store(common.node_sizes(placed, "node"), "nodes")
    found = common.store(linked(common.block_pairs(placed, sizes, "node", "rep", BLOCK), classes, bits, tables, threshold), "links")
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = common.class_labels(classes, found)
    facts = common.store(classes.select("rep", "first_id", "hi", "lo", "n_rows_equal").join(counts, "rep", "left").join(joined, "rep", "left").select(
        "hi", "lo", (F.col("n_rows_equal") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("class_id", "first_id").alias("component")), "facts")
    return (keyed.select("vec_id", "hi", "lo").join(facts, ["hi", "lo"], "left")
            .select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))
