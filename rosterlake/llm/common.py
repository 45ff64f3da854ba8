"""Helpers shared by the operators: word hashes, streams of whole groups, block pairs, components.

Conventions of every operator here: input columns are chosen by name and nothing else is read, so
extra columns (also ones named like an output) do no harm; a null text counts as empty text unless
the operator says otherwise; an empty table gives an empty result with the stated schema.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.session import scratch_path, shared_folder, store

#: Rows of an Arrow batch: keeps a batch of long documents small.
BATCH_ROWS = 512
#: Bytes of a text that are split into words at a time.
SLICE = 1 << 22
SPACES = b" \t\n\x0b\x0c\r"
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def prepare(spark: SparkSession) -> None:
    """Small Arrow batches, run-time Bloom filters on tables of any size, and a checkpoint folder."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "1MB")
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold", "10GB")
    shared_folder(spark)


# ------------------------------------------------------------------------------------ words
def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser: spreads every bit of uint64 values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_slices(data: bytes) -> Iterator[list[bytes]]:
    """The words of UTF-8 text (separators: space, tab to carriage return), a slice at a time."""
    at = 0
    while at < len(data):
        end = min(at + SLICE, len(data))
        if end < len(data):
            cuts = [c for c in (data.find(s, end) for s in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")) if c >= 0]
            end = min(cuts, default=len(data))
        yield data[at:end].split()
        at = end


def word_hashes(text: str | None) -> np.ndarray:
    """One 64-bit hash per word of the whole text."""
    digest = xxhash.xxh3_64_intdigest
    parts = [np.fromiter(map(digest, words), np.uint64, len(words))
             for words in word_slices((text or "").encode("utf-8", "replace"))]
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def windows(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every window of ``size`` consecutive words; a shorter text is one window, no word gives none."""
    size = min(size, len(words))
    if not size:
        return np.empty(0, np.uint64)
    # total[i] = size * G^size + sum of words[i + j] * G^(size - 1 - j), put together from sums over 1, 2, 4, ... words
    count = len(words) - size + 1
    total, done, step, sums = np.uint64(size), 0, 1, words
    while done < size:
        power = np.uint64(pow(int(GOLDEN), step, 1 << 64))
        if size & step:
            first = np.uint64(int(total) * int(power) % (1 << 64)) if not done else total * power
            total, done = first + sums[done:done + count], done + step
        if done < size:
            sums, step = sums[:-step] * power + sums[step:], 2 * step
    return mix(total)


def as_long(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def spread(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """first, first + 1, ... for every (first, count), one after the other."""
    return np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


# ------------------------------------------------------------------------- streams of groups
def whole_groups(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Frames that end where a group ends, from batches sorted by ``keys``; the last group waits for its rest."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        if frame.empty:
            continue
        values = frame[keys].to_numpy()
        if held:
            tail = held[-1][keys].iloc[-1].to_numpy()
            if (values[0] == tail).all() and (values[-1] == tail).all():
                held.append(frame)
                continue
        changes = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
        if held and not (values[0] == held[-1][keys].iloc[-1].to_numpy()).all():
            yield pd.concat(held, ignore_index=True) if len(held) > 1 else held[0].reset_index(drop=True)
            held = []
        if len(changes):
            yield pd.concat([*held, frame.iloc[:changes[-1]]], ignore_index=True)
            held = [frame.iloc[changes[-1]:]]
        else:
            held.append(frame)
    if held:
        yield pd.concat(held, ignore_index=True) if len(held) > 1 else held[0].reset_index(drop=True)


def bounds(frame: pd.DataFrame, keys: list[str]) -> np.ndarray:
    """Row numbers where the groups of a sorted frame start, and its length."""
    values = frame[keys].to_numpy()
    return np.concatenate([[0], np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1, [len(frame)]])


# ------------------------------------------------------------------------------ block pairs
def block_pairs(rows: DataFrame, sizes: DataFrame, node: str, item: str, block: int) -> DataFrame:
    """Rows of every node dealt into pairs of blocks of about ``block`` rows.

    Adds ``low``, ``high`` (the pair of blocks) and ``part`` (the block of this row). A node of n rows
    has n/block blocks, and each row meets every block once, so no task holds more than two blocks
    however many rows a node has. ``sizes`` has a row per node with ``n_rows``.
    """
    blocks = F.ceil(F.col("n_rows") / F.lit(block)).cast("int")
    part = F.pmod(F.xxhash64(item, node), blocks).cast("int")
    dealt = rows.join(sizes, node).withColumn("part", part).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return dealt.withColumn("low", F.least("part", "other")).withColumn("high", F.greatest("part", "other")).drop("other")


def node_sizes(rows: DataFrame, node: str) -> DataFrame:
    """Nodes with two rows or more, and their row counts (``n_rows``)."""
    return rows.groupBy(node).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def smallest_roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of n rows the smallest row that the pairs connect it with."""
    root = np.arange(n)
    while len(left):
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, root[left], low)
        np.minimum.at(root, root[right], low)
        np.minimum.at(root, left, low)
        np.minimum.at(root, right, low)
        while (root[root] != root).any():
            root = root[root]
        if (before == root).all():
            break
    return root


# -------------------------------------------------------------------------------- components
def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """Connected components of a table of links: ``node`` and ``component``, the smallest node of its component.

    Each round moves every node to the neighbour with the smallest random rank and keeps the links
    between the new nodes; the number of nodes falls by a constant factor per round, also on long
    paths. Rounds are written to the shared folder. Nodes without a link do not appear.
    """
    spark = edges.sparkSession
    links = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a <> b")
    links = store(links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    moves: list[DataFrame] = []
    while not links.isEmpty():
        seed = F.lit(len(moves))
        rank = lambda c: F.struct(F.xxhash64(c, seed).alias("rank"), F.col(c).alias("to"))  # noqa: E731, B023
        moved = links.groupBy("a").agg(F.min(rank("b")).alias("near"))
        moved = store(moved.select(F.col("a").alias("node"), F.least("near", rank("a"))["to"].alias("to")), "moves")
        moves.append(moved)
        of = lambda side: moved.select(F.col("node").alias(side), F.col("to").alias(f"{side}_to"))  # noqa: E731, B023
        links = store(links.join(of("a"), "a").join(of("b"), "b").where("a_to <> b_to")
                      .select(F.col("a_to").alias("a"), F.col("b_to").alias("b")).distinct(), "links")
    if not moves:
        return spark.createDataFrame([], "node long, component long")

    def follow(found: DataFrame, move: DataFrame) -> DataFrame:
        step = move.select(F.col("node").alias("to"), F.col("to").alias("further"))
        return found.join(step, "to", "left").select("node", F.coalesce("further", "to").alias("to"))

    found = store(reduce(follow, moves[1:], moves[0]), "components")
    least = store(found.groupBy("to").agg(F.least(F.min("node"), F.first("to")).alias("component")), "least")
    return found.join(least, "to").select("node", "component")


def wanted_rows(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Rows whose id is in the first column of ``ids``; texts that are not wanted mostly stay out of the shuffle.

    The ids are written with a constant that the join tests, because Spark makes a run-time Bloom filter (8 MB at
    most, whatever the size of the table) from tables that are filtered. The join itself is exact.
    """
    name = ids.columns[0]
    listed = store(ids.select(F.col(name).alias("wanted_id")).distinct().withColumn("wanted", F.lit(1)), "wanted")
    some = listed.where("wanted > 0").select("wanted_id")
    return rows.join(some, rows[column] == some["wanted_id"], "left_semi")


def own_rows(docs: DataFrame, id_column: str = "doc_id") -> tuple[DataFrame, str]:
    """The documents with a key of their own per row, and the name of that column; null where the id is null.

    The key is the id where no id repeats. Else the rows are sorted by id, written and numbered, so that keys rise
    with ids and equal ids by their order in the table; a hot id is spread over partitions by that order.
    """
    key = "row_key"
    while key in docs.columns:
        key += "_"
    whole = F.col(id_column).cast("long")
    if docs.where(whole.isNotNull()).groupBy(whole.alias("id")).count().where("count > 1").isEmpty():
        return docs.withColumn(key, whole), key
    order = F.monotonically_increasing_id()
    return store(docs.sort(whole, order).withColumn(key, F.when(whole.isNotNull(), F.monotonically_increasing_id())), "own_rows"), key


def class_labels(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``rep`` and ``class_id`` of linked classes: the smallest ``first_id`` in the component of the links (rep, root)."""
    joined = components(links.select(F.col("rep").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "rep")
    joined = store(joined.join(classes.select("rep", "first_id"), "rep"), "joined")
    least = joined.groupBy("component").agg(F.min("first_id").alias("class_id"))
    return joined.join(store(least, "least"), "component").select("rep", "class_id")


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


__all__ = ["BATCH_ROWS", "Callable", "Column", "prepare", "mix", "word_hashes", "word_slices", "windows", "as_long", "spread",
           "whole_groups", "bounds", "block_pairs", "node_sizes", "smallest_roots", "components", "class_labels", "own_rows", "wanted_rows", "read_table",
           "scratch_path", "shared_folder", "store"]
