"""Best-fit packing of documents into bins with conflicts.

A document of n words takes n words of room. A bin holds ``capacity`` words, at most one document of a
source and at most one of a duplicate cluster. A longer document fills whole bins of its own; its rest is
packed like a short one. Documents are dealt by a hash of their id into shards of about ``shard_rows`` rows,
and each shard is packed by itself, so a task's memory does not grow with the table and every shard has its
share of a hot source or cluster. Rows without an id are dealt by their place in the stored table.

Inside a shard documents come by falling size. Open bins are ordered by the room they have left; the search
starts at the first bin with enough room and goes on to its successors until one has neither the source nor
the cluster in its bitmaps: the tightest compatible bin. If none has, a new bin is opened.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

CAPACITY, SHARD_ROWS = 2048, 4096
#: Bins looked at together when the search goes on.
STRIDE = 256
SCHEMA = "shard long, row string, part int, start long, words int, bin long, left int"


class Bins:
    """Open bins ordered by the room left, with a bitmap of sources and of clusters each."""

    def __init__(self, most: int, n_sources: int, n_clusters: int) -> None:
        self.sources = np.zeros((-(-n_sources // 64) or 1, most), np.uint64)
        self.clusters = np.zeros((-(-n_clusters // 64) or 1, most), np.uint64)
        self.room = np.zeros(most, np.int64)
        self.order = np.empty(0, np.int64)  # bins by room, then by number
        self.rooms = np.empty(0, np.int64)  # their rooms
        self.count = 0

    def find(self, size: int, source: int, cluster: int) -> int:
        """Place in the order of the tightest compatible bin, -1 if there is none. Numbers below 0 conflict with nothing."""
        at = int(np.searchsorted(self.rooms, size))
        while at < len(self.order):
            bins = self.order[at:at + STRIDE]
            free = np.ones(len(bins), bool)
            if source >= 0:
                free &= self.sources[source >> 6, bins] >> np.uint64(source & 63) & np.uint64(1) == 0
            if cluster >= 0:
                free &= self.clusters[cluster >> 6, bins] >> np.uint64(cluster & 63) & np.uint64(1) == 0
            if free.any():
                return at + int(free.argmax())
            at += STRIDE
        return -1

    def put(self, size: int, capacity: int, source: int, cluster: int) -> int:
        at = self.find(size, source, cluster)
        if at < 0:
            number, room = self.count, capacity - size
            self.count += 1
        else:
            number, room = int(self.order[at]), int(self.rooms[at]) - size
            self.order, self.rooms = np.delete(self.order, at), np.delete(self.rooms, at)
        self.room[number] = room
        if source >= 0:
            self.sources[source >> 6, number] |= np.uint64(1 << (source & 63))
        if cluster >= 0:
            self.clusters[cluster >> 6, number] |= np.uint64(1 << (cluster & 63))
        low, high = np.searchsorted(self.rooms, room), np.searchsorted(self.rooms, room, side="right")
        place = int(low + np.searchsorted(self.order[low:high], number))
        self.order, self.rooms = np.insert(self.order, place, number), np.insert(self.rooms, place, room)
        return number


def numbered(values: pd.Series, at_least: int) -> tuple[np.ndarray, int]:
    """Numbers of the values that occur ``at_least`` times; -1 for the others and for null, which conflict with nothing."""
    codes, names = pd.factorize(values)
    often = np.bincount(codes[codes >= 0], minlength=len(names)) >= at_least
    new = np.append(np.where(often, np.cumsum(often) - 1, -1), -1)
    return new[codes], int(often.sum())


def pack(rows: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Best fit of one shard: ``row``, ``words``, ``source``, ``cluster`` to parts with their bins."""
    rows = rows.sort_values(["words", "row"], ascending=[False, True], kind="stable")
    sources, n_sources = numbered(rows["source"], 2)
    clusters, n_clusters = numbered(rows["cluster"], 2)
    sizes = rows["words"].to_numpy()
    full, rest = sizes // capacity, sizes % capacity
    whole = (rest == 0) & (sizes > 0)  # ends with a full bin
    order = np.argsort(-rest, kind="stable")
    bins = Bins(len(rows), n_sources, n_clusters)
    number = np.full(len(rows), -1)
    for i in order:
        if not whole[i]:
            number[i] = bins.put(int(rest[i]), capacity, int(sources[i]), int(clusters[i]))
    # bins filled by a part of one long document come after the shared ones
    parts = full + ~whole
    row = np.repeat(np.arange(len(rows)), parts)
    part = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
    own = part < full[row]
    bin_of = np.where(own, bins.count + np.cumsum(own) - 1, number[row])
    return pd.DataFrame({"row": rows["row"].to_numpy()[row], "part": part, "start": part * capacity,
                         "words": np.where(own, capacity, rest[row]), "bin": bin_of,
                         "left": np.where(own, 0, bins.room[number[row]])})


def best_fit(docs: DataFrame, id_column: str = "doc_id", words_column: str = "n_words", source_column: str = "source",
             cluster_column: str = "cluster", capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """A row per document, or per bin that a long document reaches into.

    Returns ``doc_id``, ``part``, ``start`` (first word), ``words``, ``shard``, ``bin`` (unique within the shard),
    ``left`` (room left in the bin at the end). Null or negative sizes count as 0 and take a place in some bin.
    A null source or cluster conflicts with nothing. Rows that repeat an id are packed as documents of their own.
    """
    common.prepare(docs.sparkSession)
    rows = common.store(docs.select(
        F.col(id_column).cast("string").alias("row"), F.greatest(F.coalesce(F.col(words_column).cast("int"), F.lit(0)), F.lit(0)).alias("words"),
        F.col(source_column).cast("string").alias("source"), F.col(cluster_column).cast("string").alias("cluster"),
        F.monotonically_increasing_id().cast("string").alias("place")), "sizes")
    shards = max(1, -(-rows.count() // shard_rows))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64(F.coalesce("row", "place")), F.lit(shards).cast("long")))

    def build(frame):
        out = pack(frame, capacity)
        out.insert(0, "shard", frame["shard"].iloc[0])
        return out

    packed = dealt.groupBy("shard").applyInPandas(build, SCHEMA)
    return packed.select(F.col("row").cast("long").alias("doc_id"), "part", "start", "words", "shard", "bin", "left")


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``source`` and ``cluster`` (equal words in equal order) of documents."""
    words = F.filter(F.split(F.coalesce("text", F.lit("")), "[ \\t-\\r]+"), lambda w: w != "")
    return docs.select("doc_id", "source", words.alias("w")).select(
        "doc_id", "source", F.size("w").alias("n_words"), F.when(F.size("w") > 0, F.sha2(F.concat_ws(" ", "w"), 256)).alias("cluster"))
