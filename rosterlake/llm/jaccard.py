"""N-gram Jaccard join by chosen paths.

A text is the set of hashes of its windows of five words (words: runs without space, tab to carriage
return; a text of one to four words is one window; a text without words has no set and no links).
Texts with equal sets are one class. The join runs over classes:

1. Every class gets a sketch of 128 sampled tokens (the smallest hash in each of 128 hash ranges; an
   empty range has none). ``runs`` independent searches start at the root with all classes.
2. In a search, a class enters the child ``token`` of a node if a random rank of (node, token) is below
   ``1/(threshold * tokens)``, so similar classes choose common tokens and meet. A node with more than
   ``leaf`` rows is split again the same way; after ``depth`` splits it is compared block by block.
3. Rows of small nodes are compared by brute force on the sketches; a pair well below the threshold
   (over four standard deviations) is dropped, the others form candidate groups.
4. Every candidate group is compared exactly on the full sets, again in pairs of blocks, so counts of
   links are exact without a row per pair.

One search keeps a pair of similarity ``threshold`` through ``d`` splits with probability
q(d) = 1 - exp(-q(d-1)), q(0) = 1; ``runs`` is the least number with (1 - q(depth)) ** runs <= 1 - recall.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

SKETCH = 128
SET_ROW = "doc_id long, hi long, lo long, n_shingles int, sketch binary, nodes array<long>"


def shingle_set(text: str | None, size: int) -> np.ndarray:
    return np.unique(common.windows(common.word_hashes(text), size))


def sampled(tokens: np.ndarray) -> np.ndarray:
    """Per hash range its smallest token, 0 where the range is empty."""
    edges = np.arange(SKETCH, dtype=np.uint64) << np.uint64(57)
    first = np.searchsorted(tokens, edges)
    full = first < np.append(first[1:], len(tokens))
    out = np.zeros(SKETCH, np.uint64)
    out[full] = tokens[first[full]] | np.uint64(1)
    return out


def sketch_of(sample: np.ndarray) -> np.ndarray:
    """16 bits per sampled token, 0 where a range is empty."""
    return np.where(sample != 0, (sample >> np.uint64(20)).astype(np.uint16) | np.uint16(1), np.uint16(0))


def searches(threshold: float, recall: float, depth: int) -> int:
    kept = 1.0
    for _ in range(depth):
        kept = 1 - math.exp(-kept)
    return math.ceil(math.log(1 - recall) / math.log(1 - kept))


def set_rows(docs: DataFrame, shingle: int, runs: int, threshold: float, seed: int) -> DataFrame:
    """Per document: digest and size of its set, its sketch, and the first nodes it enters in all searches."""
    roots = np.arange(1, runs + 1, dtype=np.uint64) + np.uint64(seed * 1000)

    def build(frames):
        for frame in frames:
            rows = []
            for doc, text in zip(frame["doc_id"], frame["text"]):
                tokens = shingle_set(text, shingle)
                if len(tokens):
                    key = common.as_long(np.frombuffer(xxhash.xxh3_128_digest(tokens.tobytes()), np.uint64))
                    sample = sampled(tokens)
                    _, nodes = chosen(roots, np.broadcast_to(sample, (runs, SKETCH)), threshold)
                    rows.append((doc, int(key[0]), int(key[1]), len(tokens), sketch_of(sample).tobytes(), common.as_long(nodes)))
                else:
                    rows.append((doc, 0, 0, 0, b"", []))
            yield pd.DataFrame(rows, columns=["doc_id", "hi", "lo", "n_shingles", "sketch", "nodes"])

    return docs.mapInPandas(build, SET_ROW)


def chosen(nodes: np.ndarray, tokens: np.ndarray, threshold: float):
    """Children of rows of a node and 128 tokens (0: none): row numbers and child nodes.

    A token keeps its place, so equal values of different hash ranges are different tokens.
    """
    filled = tokens != 0
    named = tokens.astype(np.uint64) ^ (np.arange(1, SKETCH + 1, dtype=np.uint64) << np.uint64(56))
    rank = common.mix(common.mix(named) * common.GOLDEN + common.mix(nodes)[:, None])
    limit = (1 / threshold / np.maximum(filled.sum(axis=1), 1)).clip(max=1.0)
    row, at = np.nonzero(filled & (rank.astype(np.float64) / 2.0**64 <= limit[:, None]))
    return row, common.mix(rank[row, at] ^ common.GOLDEN)


def matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint16).reshape(-1, SKETCH)


def child_rows(rows: DataFrame, threshold: float) -> DataFrame:
    """Rows (node, rep, sketch) dealt to the children that they choose."""
    def split(frames):
        for frame in frames:
            row, child = chosen(frame["node"].to_numpy().view(np.uint64), matrix(frame["sketch"]), threshold)
            if len(row):  # an empty binary column cannot be sent
                yield pd.DataFrame({"node": common.as_long(child), "rep": frame["rep"].to_numpy()[row], "sketch": frame["sketch"].to_numpy()[row]})

    return rows.select("node", "rep", "sketch").mapInPandas(split, "node long, rep long, sketch binary")


def alike(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray, threshold: float) -> np.ndarray:
    """Pairs whose sketches do not exclude the threshold. Sets of 128 tokens or fewer differ by their sizes at least."""
    low, high = np.minimum(n_left, n_right), np.maximum(n_left, n_right)
    used = ((left != 0) | (right != 0)).sum(axis=1)
    same = ((left == right) & (left != 0)).sum(axis=1)
    slack = 4.5 * np.sqrt(threshold * (1 - threshold) / np.maximum(used, 1))
    return (low >= threshold * high - 1e-9) & (same >= (threshold - slack) * used)


def near_in_group(ids, sizes, sketches, parts, threshold):
    """Star links (row, smallest connected row) among the rows of one node, or across its two blocks."""
    n = len(ids)
    left, right = [], []
    both = parts.min() != parts.max()
    for i in range(n - 1):
        ok = alike(sketches[i], sketches[i + 1:], sizes[i], sizes[i + 1:], threshold)
        if both:
            ok &= parts[i + 1:] != parts[i]
        found = np.flatnonzero(ok) + i + 1
        left.append(np.full(len(found), i))
        right.append(found)
    root = common.smallest_roots(n, np.concatenate(left), np.concatenate(right)) if left else np.arange(n)
    away = np.flatnonzero(root != np.arange(n))
    return ids[away], ids[root[away]]


def candidates(placed: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Candidate links (a, b) among rows that share a node: brute force on the sketches."""
    keys = ["node", "low", "high"]

    def compare(frames):
        for frame in common.whole_groups(frames, keys):
            cut = common.bounds(frame, keys)
            ids, sizes, sketches = frame["rep"].to_numpy(), frame["n_shingles"].to_numpy(), matrix(frame["sketch"])
            parts = frame["part"].to_numpy()
            own = parts == np.where(frame["low"] == frame["high"], parts, -1)
            length = np.diff(cut)
            found: list[tuple[np.ndarray, np.ndarray]] = []
            small = np.repeat(length <= 32, length)
            group = np.repeat(np.arange(len(length)), length)
            for lag in range(1, int(min(32, length.max()))):
                i = np.flatnonzero((group[lag:] == group[:-lag]) & small[lag:])
                i = i[own[i] | (parts[i] != parts[i + lag])]
                i = i[alike(sketches[i], sketches[i + lag], sizes[i], sizes[i + lag], threshold)]
                found.append((ids[i], ids[i + lag]))
            for g in np.flatnonzero(length > 32):
                s = slice(cut[g], cut[g + 1])
                found.append(near_in_group(ids[s], sizes[s], sketches[s], parts[s], threshold))
            a, b = (np.concatenate([x[k] for x in found]) if found else np.empty(0, np.int64) for k in (0, 1))
            if len(a):
                yield pd.DataFrame({"a": np.maximum(a, b), "b": np.minimum(a, b)}).drop_duplicates()

    rows = placed.join(classes.select("rep", "n_shingles", "sketch"), "rep")
    return (rows.repartition(*keys).sortWithinPartitions(*keys)
            .mapInPandas(compare, "a long, b long").distinct())


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the pairwise intersections of sets of sorted tokens."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    tokens = np.concatenate(sets)
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    new = np.concatenate([[True], tokens[1:] != tokens[:-1]])
    column = np.cumsum(new) - 1
    often = np.bincount(column) > 1
    keep = often[column]
    column, owner = (np.cumsum(often) - 1)[column[keep]], owner[keep]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        a, b = np.searchsorted(column, [start, start + 4096])
        part = np.zeros((len(sets), 4096), np.float32)
        part[owner[a:b], column[a:b] - start] = 1
        out += part @ part.T
    return out


def exact_links(placed: DataFrame, texts: DataFrame, shingle: int, threshold: float) -> DataFrame:
    """Per class and pair of blocks: exact number of linked documents of other classes, and a root it links with."""
    keys = ["component", "low", "high"]

    def verify(frames):
        for frame in common.whole_groups(frames, keys):
            cut = common.bounds(frame, keys)
            for start, end in zip(cut[:-1], cut[1:]):
                part = frame.iloc[start:end]
                sets = [shingle_set(t, shingle) for t in part["text"]]
                digest = [common.as_long(np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.uint64)) for s in sets]
                right = [d[0] == hi and d[1] == lo for d, hi, lo in zip(digest, part["hi"], part["lo"])]
                part, sets = part[right], [s for s, ok in zip(sets, right) if ok]
                once = ~part["rep"].duplicated().to_numpy()
                part, sets = part[once], [s for s, ok in zip(sets, once) if ok]
                if len(part) < 2:
                    continue
                n = np.array([len(s) for s in sets])
                shared = shared_counts(sets)
                link = shared >= threshold * (n[:, None] + n[None, :] - shared) - 1e-6
                np.fill_diagonal(link, False)
                block = part["part"].to_numpy()
                if part["low"].iloc[0] != part["high"].iloc[0]:
                    link &= block[:, None] != block[None, :]
                left, other = np.nonzero(link)
                root = common.smallest_roots(len(part), left, other)
                ids = part["rep"].to_numpy()
                yield pd.DataFrame({"rep": ids, "links": link.astype(np.int64) @ part["n_docs"].to_numpy(), "root": ids[root]})

    rows = placed.join(texts, placed["first_id"] == texts["doc_id"]).select(*keys, "part", "rep", "hi", "lo", "n_docs", "text")
    return (rows.repartition(*keys).sortWithinPartitions(*keys)
            .mapInPandas(verify, "rep long, links long, root long"))


def jaccard_join(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 5,
                 threshold: float = 0.8, recall: float = 0.99, leaf: int = 512, depth: int = 4, block: int = 1024,
                 exact_block: int = 128, seed: int = 1) -> DataFrame:
    """Near duplicates of whole texts: a row per document.

    Returns ``doc_id``, ``n_shingles``, ``n_links`` (other documents with Jaccard >= threshold, equal texts
    included), ``class_id`` (smallest id reachable by links) and ``kept`` (``doc_id = class_id``).
    Null and empty texts have no links. A null id is returned with null class and ``kept`` true and takes
    no part. Rows that repeat an id are documents of their own; all rows with the smallest id stay.
    """
    spark = docs.sparkSession
    common.prepare(spark)
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    unknown = texts.where("doc_id IS NULL")
    texts = texts.where("doc_id IS NOT NULL")
    sets = common.store(set_rows(texts, shingle, searches(threshold, recall, depth), threshold, seed), "sets")
    real = sets.where("n_shingles > 0")
    classes = common.store(
        real.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("n_docs"),
                                     F.min(F.struct("doc_id", "n_shingles", "sketch", "nodes")).alias("x"))
        .select(F.monotonically_increasing_id().alias("rep"), F.col("x.doc_id").alias("first_id"), "hi", "lo", "n_docs", "x.n_shingles", "x.sketch", "x.nodes"), "classes")

    rows = classes.select(F.explode("nodes").alias("node"), "rep")
    found = []
    for level in range(depth):
        sizes = common.store(common.node_sizes(rows, "node"), "nodes")
        small, large = sizes.where(F.col("n_rows") <= leaf), sizes.where(F.col("n_rows") > leaf)
        last = level == depth - 1
        found.append(common.block_pairs(rows.select("node", "rep"), sizes if last else small, "node", "rep", block))
        if last or large.isEmpty():
            break
        hot = rows.join(large.select("node"), "node", "left_semi")
        hot = hot if level else hot.join(classes.select("rep", "sketch"), "rep")
        rows = common.store(child_rows(hot, threshold), "children")
    placed = found[0]
    for more in found[1:]:
        placed = placed.unionByName(more)
    near = common.components(candidates(placed, classes, threshold)).withColumnRenamed("node", "rep")

    groups = common.store(near.join(classes.select("rep", "first_id", "hi", "lo", "n_docs"), "rep"), "groups")
    dealt = common.block_pairs(groups, common.node_sizes(groups, "component"), "component", "rep", exact_block)
    links = common.store(exact_links(dealt, common.wanted_rows(texts, "doc_id", groups.select("first_id")), shingle, threshold), "exact")
    counted = links.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = common.class_labels(classes, links)
    facts = common.store(classes.select("rep", "first_id", "hi", "lo", "n_docs").join(counted, "rep", "left").join(joined, "rep", "left")
                         .select("hi", "lo", (F.col("n_docs") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                                 F.coalesce("class_id", "first_id").alias("class_id")), "facts")
    out = (sets.select("doc_id", "hi", "lo", "n_shingles").alias("s").join(facts.alias("f"), (F.col("s.hi") == F.col("f.hi")) & (F.col("s.lo") == F.col("f.lo"))
                                               & (F.col("s.n_shingles") > 0), "left")
           .select("s.doc_id", "s.n_shingles", F.coalesce("f.n_links", F.lit(0)).alias("n_links"),
                   F.coalesce("f.class_id", "s.doc_id").alias("class_id")))
    alone = unknown.select("doc_id", F.lit(None).cast("int").alias("n_shingles"), F.lit(0).cast("long").alias("n_links"),
                           F.lit(None).cast("long").alias("class_id"))
    return out.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)))


def drop_near_copies(docs: DataFrame, **options) -> DataFrame:
    """The documents, one row of each group of near copies (the first of the smallest id); rows without an id stay.
    Rows that share an id are documents of their own."""
    rows, key = common.own_rows(docs)
    gone = jaccard_join(rows, id_column=key, **options).where("NOT kept").select(F.col("doc_id").alias("gone_id")).distinct()
    return rows.join(gone, F.col("gone_id") == rows[key], "left_anti").select(*docs.columns)
