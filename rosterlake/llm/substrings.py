"""Fuzzy repeated passages across documents by collinear chaining of shared k-mer seeds.

1. Seeds: the hashed ``K``-word windows that are minimal among ``WINDOW`` consecutive ones, so any run of
   ``K + WINDOW - 1`` equal words shares a seed. Each carries two bits of the ``NEAR`` words on either side.
   The n-th occurrence of a seed in a text is also a seed of its own, so texts that repeat themselves match
   along the diagonal.
   Seeds travel sorted and packed, in chunks of a few million; a seed of one document only goes no further. Matches
   travel packed as well, by pairs of a document and a home.
2. Every seed has one home, its occurrence in the smallest document id, and one more among the occurrences with the same
   ``NEAR`` words before it and one among those with the same words after it; other documents match their
   occurrences with these homes only. A seed in n documents thus gives 3 n matches at most, not n squared pairs.
   All windows of ``min_words`` words are seeds too, so a passage that two documents share word for word
   always meets in the first document that holds it, whatever its parts have for homes. They travel in runs of
   neighbours with the same anchor, the smallest hash of their ``ANCHOR``-word windows: equal windows have equal
   anchors, and the windows of a run that only one document has are never unpacked.
   A match counts if ``ENOUGH`` of the ``NEAR`` words on one side agree. A passage of 50 words with 80 % equal words
   and no word inserted always holds such a window: else 12 words from each shared window on had 8 equal ones
   at most and the words between them 3 of 4.
3. Per document and home document, neighbouring matches on one diagonal are joined to runs and chained: score =
   words of runs minus ``GAP_COST`` per word of distance on both sides; the best predecessor is a prefix maximum
   in a Fenwick tree. Chains are taken from the best end on, until no run is left.
4. The words around the home passage (16-bit hashes, in stretches of whole blocks of 64 words) travel to the document, where
   the ends of all chains of a batch are grown at once and the chains that remain are aligned: runs word by word, gaps by their longest common subsequence, both ends grow while the
   score (+1 equal, -4 different word) rises. Ends that still grow at the last word sent come again with
   ``WIDER`` times as many words. The best parts of at least 80 % equal words remain.
5. Aligned parts of a document are merged; merged passages of ``min_words`` words or more are repeats.

Only documents after the home are marked, so the first document keeps its text.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import freed_shuffles
from . import common

K, WINDOW, MIN_WORDS = 4, 3, 50
#: Words looked at on either side of a match, and how many of one side must agree.
NEAR, ENOUGH = 8, 5
#: Seeds are dealt by 12 bits of their hash and told apart by 32 more; a chunk holds so many.
BUCKETS, CHUNK = 4096, 1 << 21
#: Words of texts whose seeds are taken at once; parts in which matches travel, dealt by document and home.
TOGETHER, MATCH_PARTS = 1 << 17, 1024
BLOCK, MARGIN, WIDER = 64, 64, 16
#: Words of an anchor of a ``min_words``-word window, at most.
ANCHOR = 32
#: Words between matches of one run, score by which a growing end may fall, words of the shortest part that counts.
JOIN, DROP, SHORT = 16, 40, 12
GAP_COST = 0.1
#: Score of a different word if an equal one counts 1: a part scores above 0 if over 80 % of its words are equal.
DIFFERENT = 4
WORD = re.compile(rb"[^\x20\x09-\x0d]+")
#: Packed columns are a few hundred numbers each: a codec without tables takes 2 % more room and half the time.
CODEC = "lz4_raw"


# ------------------------------------------------------------------------------------- seeds
def minimizers(hashes: np.ndarray, window: int) -> np.ndarray:
    """Positions that are minimal (the last of equals) in some window of consecutive hashes."""
    if len(hashes) <= window:
        return np.array([len(hashes) - 1 - int(np.argmin(hashes[::-1]))]) if len(hashes) else np.empty(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(hashes, window)
    parts = []
    for start in range(0, len(views), 1 << 16):
        part = views[start:start + (1 << 16), ::-1]
        parts.append(np.unique(start + np.arange(len(part)) + window - 1 - part.argmin(axis=1)))
    return np.unique(np.concatenate(parts))


def sliding_minimum(values: np.ndarray, window: int) -> np.ndarray:
    """The smallest of every ``window`` consecutive values, put together from those of 1, 2, 4, ... values."""
    size = 1
    while 2 * size <= window:
        values, size = np.minimum(values[:-size], values[size:]), 2 * size
    return np.minimum(values[:len(values) - (window - size)], values[window - size:]) if window > size else values


def anchored(words: np.ndarray, min_words: int) -> tuple[np.ndarray, ...]:
    """Runs of neighbouring ``min_words``-word windows with one anchor: (anchor, place of the first, windows), and 24 bits of
    the hash of every window, which are told apart behind 44 of their anchor. Smallest hashes gather at the low end, so they are spread again."""
    size = min(ANCHOR, min_words)
    anchors = sliding_minimum(common.windows(words, size), min_words - size + 1)
    first = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]]))
    counts = np.diff(first, append=len(anchors))
    return common.mix(anchors[first]), first.astype(np.int32), counts.astype(np.uint32), (common.windows(words, min_words) >> np.uint64(40)).astype(np.uint32)


def repeat_numbers(values: np.ndarray) -> np.ndarray:
    """How often each value occurred before its place."""
    order = np.argsort(values, kind="stable")
    new = np.concatenate([[True], values[order][1:] != values[order][:-1]])
    place = np.arange(len(values))
    out = np.empty(len(values), np.int64)
    out[order] = place - np.maximum.accumulate(np.where(new, place, 0))
    return out


def contexts(words: np.ndarray) -> np.ndarray:
    """For every ``K``-word window of a text two bits of each of the ``NEAR`` words before it (low half) and after it."""
    bits = np.zeros(len(words) + 2 * NEAR, np.uint32)
    bits[NEAR:NEAR + len(words)] = (words >> np.uint64(17)) & np.uint64(3)
    count = len(words) - K + 1
    out = np.zeros(count, np.uint32)
    for i in range(NEAR):
        out |= bits[i:i + count] << np.uint32(2 * i)
        out |= bits[NEAR + K + i:NEAR + K + i + count] << np.uint32(2 * (NEAR + i))
    return out


def agree(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether ``ENOUGH`` words of one side agree."""
    other = a ^ b
    same = ~(other | other >> np.uint32(1)) & np.uint32(0x55555555)
    return np.maximum(np.bitwise_count(same & np.uint32(0xFFFF)), np.bitwise_count(same >> np.uint32(16))) >= ENOUGH


def packed(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes: all lowest bytes, then all second ones and so on."""
    return pa.compress(np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T.tobytes(), codec=CODEC, asbytes=True)


def unpacked(data: bytes, size: int, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data, decompressed_size=size * width, codec=CODEC), np.uint8)
    return planes.reshape(width, size).T.copy().view(kind)[:, 0]


def chunk_rows(parts: list[tuple], whole: list[np.ndarray] | None = None) -> pd.DataFrame:
    """A row per bucket: its seeds by rising hash (32 bits, as differences), their documents, places and contexts; for runs of
    long windows their numbers of windows instead of contexts, and the hashes of these windows."""
    values, docs, places, near = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(values)
    if whole:
        hashes, counts = np.concatenate(whole), near.astype(np.int64)
        hashes = hashes[common.spread((np.cumsum(counts) - counts)[order], counts[order])]
    values, docs, places, near = values[order], docs[order], places[order], near[order]
    bucket = (values >> np.uint64(52)).astype(np.int64)
    rest = (values >> np.uint64(20)).astype(np.uint32)
    edge = np.searchsorted(bucket, np.arange(BUCKETS + 1))
    at = np.concatenate([[0], np.cumsum(near, dtype=np.int64)])[edge] if whole else None
    rows = [(b, int(e - s), packed(np.diff(rest[s:e], prepend=np.uint32(0))), packed(docs[s:e]), packed(places[s:e]), packed(near[s:e]),
             packed(hashes[at[b]:at[b + 1]]) if whole else b"")
            for b, (s, e) in enumerate(zip(edge[:-1], edge[1:])) if e > s]
    return pd.DataFrame(rows, columns=["bucket", "size", "seed", "doc_id", "pos", "near", "whole"])


def seeds_of(docs: np.ndarray, texts: list[np.ndarray], min_words: int) -> tuple[list[tuple], list[tuple], list[np.ndarray]]:
    """Seeds of some texts (words of each) at once: (hash, document, place, context) of the ``K``-word windows, the runs of
    long windows as :func:`anchored` gives them with their documents, and the hashes of these windows."""
    sizes = np.array([len(t) for t in texts])
    docs, words, sizes = docs[sizes >= K], np.concatenate([t for t in texts if len(t) >= K] or [np.empty(0, np.uint64)]), sizes[sizes >= K]
    parts, runs, whole = [], [], []
    if not len(sizes):
        return parts, runs, whole
    begin = np.cumsum(sizes) - sizes
    text, place = np.repeat(np.arange(len(sizes)), sizes), np.arange(len(words)) - np.repeat(begin, sizes)
    inside = place <= sizes[text] - K
    grams, of = common.windows(words, K)[inside[:len(words) - K + 1]], text[inside]
    at = all_minimizers(grams, of, WINDOW)
    values, of, place_ = grams[at], of[at], place[inside][at]
    order = np.lexsort((values, of))  # stable: equal windows of a text by place
    new = np.concatenate([[True], (values[order][1:] != values[order][:-1]) | (of[order][1:] != of[order][:-1])])
    row = np.arange(len(values))
    nth = np.empty(len(values), np.int64)
    nth[order] = row - np.maximum.accumulate(np.where(new, row, 0))
    bits = np.zeros(len(words) + NEAR * (len(sizes) + 1), np.uint32)
    bits[np.arange(len(words)) + NEAR * (text + 1)] = (words >> np.uint64(17)) & np.uint64(3)
    near, step = bits, 1
    while step < NEAR:  # two bits of each of ``NEAR`` words from here on
        near, step = near[:-step] | near[step:] << np.uint32(2 * step), 2 * step
    spot = begin[of] + place_ + NEAR * (of + 1)
    near = near[spot - NEAR] | near[spot + K] << np.uint32(2 * NEAR)
    again = nth > 0
    values = np.concatenate([values, common.mix(values[again] + nth[again].astype(np.uint64) * common.GOLDEN)])
    parts.append((values, *(np.concatenate([v, v[again]]) for v in (docs[of], place_.astype(np.int32), near))))
    inside = place <= sizes[text] - min_words
    if inside.any():
        size = min(ANCHOR, min_words)
        long, of, place = inside[:len(words) - min_words + 1], text[inside], place[inside]
        anchors = sliding_minimum(common.windows(words, size), min_words - size + 1)[long]
        first = np.flatnonzero(np.concatenate([[True], (anchors[1:] != anchors[:-1]) | (of[1:] != of[:-1])]))
        counts = np.diff(first, append=len(anchors)).astype(np.uint32)
        runs.append((common.mix(anchors[first]), docs[of[first]], place[first].astype(np.int32), counts))
        whole.append((common.windows(words, min_words)[long] >> np.uint64(40)).astype(np.uint32))
    return parts, runs, whole


def all_minimizers(hashes: np.ndarray, text: np.ndarray, window: int) -> np.ndarray:
    """:func:`minimizers` of the hashes of every text, which lie one after the other."""
    chosen = np.zeros(len(hashes), bool)
    if len(hashes) >= window:
        count = len(hashes) - window + 1
        best, at = hashes[:count], np.zeros(count, np.int64)
        for i in range(1, window):
            lower = hashes[i:i + count] <= best
            best, at = np.where(lower, hashes[i:i + count], best), np.where(lower, i, at)
        chosen[(np.arange(count) + at)[text[:count] == text[window - 1:]]] = True
    start = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]])) if len(text) else np.empty(0, np.int64)
    end = np.append(start[1:], len(text))
    for s, e in zip(start[end - start < window].tolist(), end[end - start < window].tolist()):
        chosen[s + minimizers(hashes[s:e], window)] = True
    return np.flatnonzero(chosen)


def seed_rows(texts: DataFrame, min_words: int) -> DataFrame:
    """Packed seeds of all documents; buckets from ``BUCKETS`` on hold the windows of ``min_words`` words."""
    def build(frames):
        parts, runs, whole, held = [], [], [], 0
        for docs, words in word_batches(frames):
            more, long, hashes = seeds_of(docs, words, min_words)
            parts, runs, whole = parts + more, runs + long, whole + hashes
            held += sum(len(p[0]) for p in more) + sum(len(r[0]) + len(h) // 4 for r, h in zip(long, hashes))
            if held >= CHUNK:
                yield from chunks(parts, runs, whole)
                parts, runs, whole, held = [], [], [], 0
        yield from chunks(parts, runs, whole)

    def word_batches(frames):
        docs, words, held = [], [], 0
        for frame in frames:
            for doc, text in zip(frame["doc_id"], frame["text"]):
                docs.append(doc)
                words.append(common.word_hashes(text))
                held += len(words[-1])
                if held >= TOGETHER:
                    yield np.array(docs, np.int64), words
                    docs, words, held = [], [], 0
        if docs:
            yield np.array(docs, np.int64), words

    def chunks(parts, runs, whole):
        if parts:
            yield chunk_rows(parts)
        if runs:
            yield chunk_rows(runs, whole).assign(bucket=lambda rows: rows["bucket"] + BUCKETS)

    return texts.mapInPandas(build, "bucket int, size int, seed binary, doc_id binary, pos binary, near binary, whole binary")


MATCH = (("doc_id", np.int64), ("home", np.int64), ("pos", np.int32), ("home_pos", np.int32), ("n", np.int32))


def match_chunks(seeds: DataFrame, min_words: int) -> DataFrame:
    """The matches of :func:`match_rows`, packed: a row per ``part`` of the pairs of a document and a home, a few million matches at a time."""
    find = match_frames(min_words)

    def build(frames):
        held, size = [], 0
        for frame in find(frames):
            held.append([frame[c].to_numpy() for c, _ in MATCH])
            size += len(frame)
            if size >= CHUNK:
                yield chunk(held)
                held, size = [], 0
        if held:
            yield chunk(held)

    def chunk(held):
        columns = [np.concatenate(c).astype(kind) for c, (_, kind) in zip(zip(*held), MATCH)]
        part = common.mix(common.mix(columns[0].view(np.uint64)) + columns[1].view(np.uint64)) % np.uint64(MATCH_PARTS)
        order = np.lexsort((columns[2], columns[1], columns[0], part))
        edge = np.searchsorted(part[order], np.arange(MATCH_PARTS + 1, dtype=np.uint64))
        columns = [c[order] for c in columns]
        rows = [(i, int(e - s), *(packed(c[s:e]) for c in columns)) for i, (s, e) in enumerate(zip(edge[:-1], edge[1:])) if e > s]
        return pd.DataFrame(rows, columns=["part", "size", *(c for c, _ in MATCH)])

    return (seeds.repartition("bucket").sortWithinPartitions("bucket")
            .mapInPandas(build, "part int, size int, doc_id binary, home binary, pos binary, home_pos binary, n binary"))


def match_rows(seeds: DataFrame, min_words: int) -> DataFrame:
    """Occurrences of seeds in documents after a home: ``doc_id``, ``home``, ``pos``, ``home_pos``, ``n`` equal words."""
    return (seeds.repartition("bucket").sortWithinPartitions("bucket")
            .mapInPandas(match_frames(min_words), "doc_id long, home long, pos int, home_pos int, n int"))


def match_frames(min_words: int):
    """The matches in batches of seeds that are sorted by bucket, as frames."""
    def build(frames):
        for frame in common.whole_groups(frames, ["bucket"]):
            cut = common.bounds(frame, ["bucket"])
            out = []
            columns = {c: frame[c].to_list() for c in frame.columns}
            for s, e in zip(cut[:-1], cut[1:]):
                load = lambda c, kind: [unpacked(columns[c][i], columns["size"][i], kind) for i in range(s, e)]  # noqa: E731, B023
                values = np.concatenate([np.cumsum(x, dtype=np.uint32) for x in load("seed", np.uint32)])
                docs, places, near = (np.concatenate(load(c, t)) for c, t in (("doc_id", np.int64), ("pos", np.int32), ("near", np.uint32)))
                long = frame["bucket"].iat[s] >= BUCKETS
                if long:
                    sizes = [int(x.sum()) for x in np.split(near, np.cumsum(columns["size"][s:e])[:-1])]
                    hashes = np.concatenate([unpacked(columns["whole"][i], n, np.uint32) for i, n in zip(range(s, e), sizes)])
                    values, docs, places = shared_windows(values, docs, places, near.astype(np.int64), hashes)
                    near = np.zeros(len(values), np.uint32)
                    if not len(values):
                        continue
                order = np.lexsort((places, docs, values))
                values, docs, places, near = values[order], docs[order], places[order], near[order]
                homes = [first_rows(values)]
                if not long:
                    sides = ((near & np.uint32(0xFFFF)).astype(np.uint64), (near >> np.uint32(16)).astype(np.uint64))
                    homes += [first_of(values.astype(np.uint64) << np.uint64(16) | side) for side in sides]
                for i, home in enumerate(homes):
                    mine = (docs != docs[home]) & agree(near, near[home])
                    for earlier in homes[:i]:
                        mine &= home != earlier
                    if mine.any():
                        found = (docs[mine], docs[home[mine]], places[mine], places[home[mine]], np.full(int(mine.sum()), min_words if long else K, np.int32))
                        out.append(neighbours(*found) if long else found)
            if out:
                yield pd.DataFrame(dict(zip(("doc_id", "home", "pos", "home_pos", "n"), map(np.concatenate, zip(*out)))))

    return build


def shared_windows(anchors: np.ndarray, docs: np.ndarray, places: np.ndarray, counts: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, ...]:
    """(value, document, place) of the windows in runs whose anchor two documents have."""
    order = np.argsort(anchors, kind="stable")
    start = np.flatnonzero(np.concatenate([[True], anchors[order][1:] != anchors[order][:-1]]))
    several = np.minimum.reduceat(docs[order], start) != np.maximum.reduceat(docs[order], start)
    kept = order[np.repeat(several, np.diff(start, append=len(order)))]
    n, at = counts[kept], common.spread((np.cumsum(counts) - counts)[kept], counts[kept])
    value = np.repeat(anchors[kept].astype(np.uint64) << np.uint64(32), n) | hashes[at].astype(np.uint64)
    return value, np.repeat(docs[kept], n), common.spread(places[kept].astype(np.int64), n).astype(np.int32)


def neighbours(docs: np.ndarray, homes: np.ndarray, x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Matches of neighbouring windows as one match each, by the rule that joins all matches of a pair later."""
    order = np.lexsort((homes, docs))
    docs, homes = docs[order], homes[order]
    new = np.concatenate([[True], (docs[1:] != docs[:-1]) | (homes[1:] != homes[:-1])])
    pair, *runs = all_runs(np.cumsum(new) - 1, x[order], y[order], n[order])
    return docs[new][pair], homes[new][pair], *(v.astype(np.int32) for v in runs)


def first_rows(values: np.ndarray) -> np.ndarray:
    """For every row of a sorted column the first row of the same value."""
    new = np.concatenate([[True], values[1:] != values[:-1]])
    return np.flatnonzero(new)[np.cumsum(new) - 1]


def first_of(values: np.ndarray) -> np.ndarray:
    """For every row the first row of the same value; equal values need not be neighbours."""
    order = np.argsort(values, kind="stable")
    out = np.empty(len(values), np.int64)
    out[order] = order[first_rows(values[order])]
    return out


def word_rows(texts: DataFrame) -> DataFrame:
    """16-bit word hashes of every document that has words."""
    def build(frames):
        for frame in frames:
            rows = [(doc, common.word_hashes(text).astype(np.uint16).tobytes()) for doc, text in zip(frame["doc_id"], frame["text"])]
            rows = [row for row in rows if row[1]]
            if rows:  # an empty binary column cannot be sent
                yield pd.DataFrame(rows, columns=["doc_id", "words"])

    return texts.mapInPandas(build, "doc_id long, words binary")


def word_counts(texts: pd.Series) -> pd.Series:
    """The number of words of every text."""
    return pd.Series([sum(map(len, common.word_slices((t or "").encode("utf-8", "replace")))) for t in texts], dtype="int64")


def block_rows(words: DataFrame) -> DataFrame:
    """The rows of :func:`word_rows` in blocks of ``BLOCK`` words, of homes."""
    size = 2 * BLOCK
    last = F.floor((F.length("words") - 1) / size).cast("int")
    rows = words.select(F.col("doc_id").alias("home"), "words", F.explode(F.sequence(F.lit(0), last)).alias("block"))
    return rows.select("home", "block", F.substring("words", F.col("block") * size + 1, F.lit(size)).alias("words"))


# ------------------------------------------------------------------------------------ chains
class Fenwick:
    """Prefix maxima of (score, item) over 1..n."""

    def __init__(self, n: int) -> None:
        self.best = [(0.0, -1)] * (n + 1)

    def put(self, at: int, value: tuple[float, int]) -> None:
        while at < len(self.best):
            if value > self.best[at]:
                self.best[at] = value
            at += at & -at

    def top(self, at: int) -> tuple[float, int]:
        found = (0.0, -1)
        while at > 0:
            if self.best[at] > found:
                found = self.best[at]
            at -= at & -at
        return found


def runs_of(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> list[tuple[int, int, int]]:
    """Matches on one diagonal with at most ``JOIN`` words between them, as (x, y, words)."""
    order = np.lexsort((x, x - y))
    x, y, n = (v[order].astype(np.int64) for v in (x, y, n))
    other = np.concatenate([[False], (x - y)[1:] != (x - y)[:-1]])
    floor = np.cumsum(other) << 40  # each diagonal above the one before, so one running maximum serves all
    reach = np.maximum.accumulate(floor + x + n)
    new = np.concatenate([[True], other[1:] | ((floor + x)[1:] > reach[:-1] + JOIN)])
    start = np.flatnonzero(new)
    end = np.append(start[1:], len(x)) - 1
    return [(int(x[s]), int(y[s]), int(reach[e] - floor[e] - x[s])) for s, e in zip(start, end)]


def thinned(runs: list[tuple[int, int, int]], most: int = 256) -> list[tuple[int, int, int]]:
    """Of very many runs those that cover the same words: in a text of one repeated word every place matches every other.

    Runs of ``MIN_WORDS`` words are repeats by themselves, so what lies inside their union adds nothing.
    """
    if len(runs) <= most:
        return runs
    long = sorted((r for r in runs if r[2] >= MIN_WORDS), key=lambda r: (r[0], -r[2]))
    keep, i, reach = [], 0, -1
    while i < len(long):
        best = None
        limit = max(reach, long[i][0])
        while i < len(long) and long[i][0] <= limit:
            if best is None or long[i][0] + long[i][2] > best[0] + best[2]:
                best = long[i]
            i += 1
        if best[0] + best[2] > reach:
            keep.append(best)
            reach = best[0] + best[2]
    covered = np.zeros(max(x + n for x, _, n in runs) + 1, np.int64)
    for x, _, n in keep:
        covered[x:x + n] = 1
    total = np.concatenate([[0], np.cumsum(covered)])
    return keep + [(x, y, n) for x, y, n in runs if total[x + n] - total[x] < n and n < MIN_WORDS]


def chains(runs: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """Disjoint collinear chains of runs, best first.

    f(i) = words(i) + max(0, max f(j) - GAP_COST * (distance in x + distance in y)) over runs j that start and
    end before i on both sides. The cost is separable, so j's key f(j) + GAP_COST * (end x + end y) goes into
    the tree at its end y once the sweep has passed its end x.
    """
    ends = sorted({y + n for _, y, n in runs})
    place = {y: i + 1 for i, y in enumerate(ends)}
    sorted_ends = np.array(ends)
    events = sorted([(x, 1, i) for i, (x, _, _) in enumerate(runs)] + [(x + n, 0, i) for i, (x, _, n) in enumerate(runs)])
    tree = Fenwick(len(ends))
    score, back = [0.0] * len(runs), [-1] * len(runs)
    for _, is_start, i in events:
        x, y, n = runs[i]
        if is_start:
            value, j = tree.top(int(np.searchsorted(sorted_ends, y, side="right")))
            gain = value - GAP_COST * (x + y) if j >= 0 else 0.0
            score[i], back[i] = (n + gain, j) if gain > 0 else (float(n), -1)
        else:
            tree.put(place[y + n], (score[i] + GAP_COST * (x + y + 2 * n), i))
    used, out = [False] * len(runs), []
    for i in sorted(range(len(runs)), key=lambda i: -score[i]):
        if used[i]:
            continue
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(runs[i])
            i = back[i]
        out.append(chain[::-1])
    return out


PAIR = "doc_id long, home long, sizes binary, x binary, y binary, n binary, firsts array<int>, lasts array<int>"


def pair_row(doc: int, home: int, found: list[tuple], margin: int) -> tuple:
    """Chains (x, y, n) of a document and a home in one row, with the stretches of blocks of the home that hold their words
    and ``margin`` more: first blocks and the blocks behind the last."""
    stretches: list[list[int]] = []
    for low, high in sorted((max(0, int(y[0]) - margin) // BLOCK, int(y[-1] + n[-1] + margin) // BLOCK + 1) for _, y, n in found):
        if stretches and low <= stretches[-1][1]:
            stretches[-1][1] = max(high, stretches[-1][1])
        else:
            stretches.append([low, high])
    return (doc, home, np.array([len(x) for x, _, _ in found], np.int32).tobytes(), *(np.concatenate(c).tobytes() for c in zip(*found)),
            *map(list, zip(*stretches)))


def all_runs(pair: np.ndarray, x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """:func:`runs_of` every pair at once: (pair, x, y, words) of the runs, pair by pair."""
    order = np.lexsort((x, x - y, pair))
    pair, x, y, n = (v[order].astype(np.int64) for v in (pair, x, y, n))
    other = np.concatenate([[False], ((x - y)[1:] != (x - y)[:-1]) | (pair[1:] != pair[:-1])])
    floor = np.cumsum(other) << 40
    reach = np.maximum.accumulate(floor + x + n)
    start = np.flatnonzero(np.concatenate([[True], other[1:] | ((floor + x)[1:] > reach[:-1] + JOIN)]))
    end = np.append(start[1:], len(x)) - 1
    return pair[start], x[start], y[start], reach[end] - floor[end] - x[start]


def chain_rows(matches: DataFrame) -> DataFrame:
    """The chains of every pair of a document and a home, from :func:`match_chunks`; a pair of one run is its own chain."""
    one = np.ones(1, np.int32).tobytes()

    def build(frames):
        for frame in common.whole_groups(frames, ["part"]):
            sizes = frame["size"].to_list()
            docs, homes, x, y, n = (np.concatenate([unpacked(d, size, kind) for d, size in zip(frame[c], sizes)]) for c, kind in MATCH)
            order = np.lexsort((homes, docs))
            docs, homes = docs[order], homes[order]
            new = np.concatenate([[True], (docs[1:] != docs[:-1]) | (homes[1:] != homes[:-1])])
            pair, x, y, n = all_runs(np.cumsum(new) - 1, x[order], y[order], n[order])
            docs, homes = docs[new], homes[new]
            edge = np.searchsorted(pair, np.arange(len(docs) + 1))
            single = np.diff(edge) == 1
            at = edge[:-1][single]
            low, high = np.maximum(y[at] - MARGIN, 0) // BLOCK, (y[at] + n[at] + MARGIN) // BLOCK + 1
            packed_ = [v[at].astype("<i4").tobytes() for v in (x, y, n)]
            rows = [(d, h, one, *(v[4 * i:4 * i + 4] for v in packed_), [s], [e])
                    for i, (d, h, s, e) in enumerate(zip(docs[single], homes[single], low.tolist(), high.tolist()))]
            for k in np.flatnonzero(~single):
                runs = list(zip(*(v[edge[k]:edge[k + 1]].tolist() for v in (x, y, n))))
                rows.append(pair_row(docs[k], homes[k], [tuple(np.array(v, np.int32) for v in zip(*chain)) for chain in chains(thinned(runs))], MARGIN))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in PAIR.split(", ")])

    return matches.repartition("part").sortWithinPartitions("part").mapInPandas(build, PAIR)


def gathered(frames, rows: int = 1 << 15):
    """The batches joined to larger ones: numbers take little room, and every batch costs the same."""
    held, size = [], 0
    for frame in frames:
        held.append(frame)
        size += len(frame)
        if size >= rows:
            yield pd.concat(held, ignore_index=True)
            held, size = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


# --------------------------------------------------------------------------------- alignment
def common_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, bit-parallel over the words of ``a``."""
    if not len(a) or not len(b):
        return 0
    places: dict[int, int] = {}
    for i, w in enumerate(a.tolist()):
        places[w] = places.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for w in b.tolist():
        hit = row & places.get(w, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def grown(a: np.ndarray, b: np.ndarray, margin: int) -> tuple[int, int, bool]:
    """Words by which equal starts of ``a`` and ``b`` extend a passage, words until the score has fallen by ``DROP``, and
    whether ``margin`` words were too few to tell."""
    n = min(len(a), len(b), margin)
    if not n:
        return 0, 0, False
    total = np.cumsum(np.where(a[:n] == b[:n], 1, -DIFFERENT))
    fallen = total < np.maximum(np.maximum.accumulate(total), 0) - DROP
    reach = int(fallen.argmax()) if fallen.any() else n
    best = int(total[:reach].argmax())
    return best + 1 if total[best] > 0 else 0, reach, n == margin and reach == n


def all_grown(same: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """:func:`grown` for many starts: ``same`` has a row of equal or different words each, of which ``sizes`` are there."""
    margin = same.shape[1]
    there = np.arange(margin) < sizes[:, None]
    total = np.cumsum(np.where(same, 1, -DIFFERENT), axis=1, dtype=np.int32)
    fallen = there & (total < np.maximum(np.maximum.accumulate(total, axis=1), 0) - DROP)
    reach = np.where(fallen.any(axis=1), fallen.argmax(axis=1), sizes)
    total = np.where(np.arange(margin) < reach[:, None], total, np.iinfo(np.int32).min)
    best = total.argmax(axis=1)
    gain = np.where(total[np.arange(len(total)), best] > 0, best + 1, 0)
    return np.where(sizes > 0, gain, 0), np.where(sizes > 0, reach, 0), (sizes == margin) & (reach == sizes)


def all_ends(owns: list[np.ndarray], chains_: list[tuple], margin: int, min_words: int) -> tuple[np.ndarray, ...]:
    """The ends of many chains (number of the text in ``owns``, words of the home, place of their first, x, y, n) as
    :func:`aligned` grows them: words before and behind, which chains it would drop, which it would send on."""
    own, x, y, end, home_end = (np.array(v, np.int64) for v in zip(*[
        (o, x[0], y[0] - first, x[-1] + n[-1], y[-1] + n[-1] - first) for o, _, first, x, y, n in chains_]))
    begin = np.cumsum([0] + [len(o) for o in owns])
    home_begin = np.cumsum([0] + [len(c[1]) for c in chains_])
    words, home = np.concatenate(owns), np.concatenate([c[1] for c in chains_])
    step = np.arange(margin)

    def same(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return words[np.clip(a, 0, len(words) - 1)] == home[np.clip(b, 0, len(home) - 1)]

    at, home_at = begin[own], home_begin[:-1]
    left = np.minimum(np.minimum(x, y), margin)
    right = np.maximum(np.minimum(np.minimum(begin[own + 1] - at - end, np.diff(home_begin) - home_end), margin), 0)
    lead, before, more = all_grown(same((at + x)[:, None] - 1 - step, (home_at + y)[:, None] - 1 - step), left)
    tail, after, further = all_grown(same((at + end)[:, None] + step, (home_at + home_end)[:, None] + step), right)
    more |= further
    return before, after, (end - x + lead + tail < SHORT) & (end - x + before + after < min_words) & ~more, more


def dense_parts(starts: np.ndarray, ends: np.ndarray, score: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Disjoint stretches of positive score, each as large as possible: the best one, then those beside it, as far as they
    can hold ``least`` words."""
    out, todo = [], [(0, len(score))]
    while todo:
        s, e = todo.pop()
        if s >= e or ends[e - 1] - starts[s] < least:
            continue
        total = np.concatenate([[0], np.cumsum(score[s:e])])
        low = np.minimum.accumulate(total[:-1])
        gain = total[1:] - low
        last = int(gain.argmax())
        if gain[last] <= 0:
            continue
        first = int(np.argmin(total[:last + 1]))
        out.append((s + first, s + last + 1))
        todo += [(s, s + first), (s + last + 1, e)]
    return out


def even_parts(first: np.ndarray, last: np.ndarray, score: np.ndarray, min_words: int) -> list[tuple[int, int]]:
    """Stretches of ``min_words`` words or more with 80 % equal words whose score nowhere gathers: their longest ones, merged."""
    total = np.concatenate([[0], np.cumsum(score)])
    low = np.minimum.accumulate(total[:-1])
    out: list[list[int]] = []
    equal = np.flatnonzero(score > 0)
    s = np.searchsorted(-low, -total[equal + 1], side="left")  # the first place not above
    s = equal[np.minimum(np.searchsorted(equal, s), np.arange(len(equal)))]
    holds = (last[equal] - first[s] >= min_words) & (total[equal + 1] >= total[s])
    for a, b in zip(first[s[holds]].tolist(), last[equal[holds]].tolist()):
        if out and a <= out[-1][1]:
            out[-1] = [min(out[-1][0], a), b]
        else:
            out.append([a, b])
    return [(s, e) for s, e in out]


def aligned(words: np.ndarray, home: np.ndarray, offset: int, x, y, n, margin: int, min_words: int,
            ends_known: tuple[int, int] | None = None) -> tuple[list[tuple[int, int]], bool]:
    """Passages of ``words`` that the chain matches with at least 80 % equal words, and whether an end may go on behind
    ``margin`` words. ``home`` starts at word ``offset``; ``ends_known`` are the words of :func:`all_ends` of a chain that
    it neither drops nor sends on."""
    y = y - offset
    starts, ends, scores = [], [], []  # pieces: single words of runs and ends, whole gaps

    def single(a: int, b: int, size: int) -> None:
        starts.append(np.arange(a, a + size))
        ends.append(starts[-1] + 1)
        scores.append(np.where(words[a:a + size] == home[b:b + size], 1, -DIFFERENT))

    end, home_end = x[-1] + n[-1], y[-1] + n[-1]
    if ends_known:
        before, after = ends_known
    else:
        lead, before, more = grown(words[max(0, x[0] - margin):x[0]][::-1], home[max(0, y[0] - margin):y[0]][::-1], margin)
        tail, after, further = grown(words[end:end + margin], home[home_end:home_end + margin], margin)
        short = end - x[0] + lead + tail < SHORT and end - x[0] + before + after < min_words
        if short or more or further:
            return [], more or further
    start, shift = x[0] - before, x[0] - y[0]
    even = bool((x - y == shift).all())  # one diagonal, and its gaps are compared word by word
    if even:
        same = words[start:end + after] == home[start - shift:end + after - shift]
        if same.all():
            return ([(int(start), int(end + after))] if end + after - start >= SHORT else []), False
        total = np.concatenate([[0], np.cumsum(same)])
        low, high = x[:-1] + n[:-1] - start, x[1:] - start
        even = bool((5 * (total[high] - total[low]) >= 3 * (high - low)).all())
    if even:
        single(start, start - shift, end + after - start)
    else:
        single(start, y[0] - before, before)
    for i in range(0 if even else len(x)):
        single(x[i], y[i], n[i])
        if i + 1 < len(x):
            a, b = words[x[i] + n[i]:x[i + 1]], home[y[i] + n[i]:y[i + 1]]
            if len(a) == len(b) and 5 * (a == b).sum() >= 3 * len(a):
                single(x[i] + n[i], y[i] + n[i], len(a))
                continue
            same = common_subsequence(a, b)
            starts.append(np.array([x[i] + n[i]]))
            ends.append(np.array([x[i + 1]]))
            scores.append(np.array([same - DIFFERENT * (max(len(a), len(b)) - same)]))
    if not even:
        single(end, home_end, after)
    first, last, score = np.concatenate(starts), np.concatenate(ends), np.concatenate(scores)
    parts = [(int(first[s]), int(last[e - 1])) for s, e in dense_parts(first, last, score, min(SHORT, min_words))]
    if last[-1] - first[0] >= min_words and max((e - s for s, e in parts), default=0) < min_words:
        parts += even_parts(first, last, score, min_words)
    return [(s, e) for s, e in parts if e - s >= SHORT], False


def merged(spans: list[tuple[int, int, int]], min_words: int) -> list[tuple[int, int, int]]:
    """Union of (start, end, home) spans that touch; the home of the longest part stays; short unions go."""
    out: list[list[int]] = []
    for s, e, home in sorted(spans):
        if out and s <= out[-1][1]:
            if e - s > out[-1][3]:
                out[-1][2:] = [home, e - s]
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e, home, e - s])
    return [(s, e, home) for s, e, home, _ in out if e - s >= min_words]


def cut_text(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text without the words of the spans and the white space after each word."""
    data = text.encode("utf-8", "replace")
    starts = np.array([m.start() for m in WORD.finditer(data)] + [len(data)])
    out, at = [], 0
    for s, e, _ in spans:
        out.append(data[at:starts[s]])
        at = starts[e]
    out.append(data[at:])
    return b"".join(out).decode("utf-8").rstrip(" \n") if spans else text


def home_words(blocks: dict, chain, margin: int) -> tuple[np.ndarray, int]:
    """The words of the home around a chain and the place of the first."""
    first = max(0, int(chain[1][0]) - margin) // BLOCK
    last = int(chain[1][-1] + chain[2][-1] + margin) // BLOCK
    return np.frombuffer(b"".join(blocks[b] for b in range(first, last + 1) if b in blocks), np.uint16), first * BLOCK


def chain_ends(owns: list[np.ndarray], chains_: list[tuple], margin: int, min_words: int) -> list[list]:
    """:func:`all_ends`, a few thousand chains at a time: (words before, words behind, dropped, sent on) per chain."""
    size, out = max(1, (1 << 18) // margin), []
    for s in range(0, len(chains_), size):
        part = chains_[s:s + size]
        used = sorted({c[0] for c in part})
        number = {o: i for i, o in enumerate(used)}
        found = all_ends([owns[o] for o in used], [(number[c[0]], *c[1:]) for c in part], margin, min_words)
        out += zip(*(v.tolist() for v in found))
    return out


def single_runs(owns: list[np.ndarray], found: list[tuple], margin: int, min_words: int) -> np.ndarray:
    """Which pairs (document, number of its text, home, chains, blocks of the home) are one single run that is dropped."""
    out = np.zeros(len(found), bool)
    singles = [i for i, f in enumerate(found) if len(f[3]) == 1 and len(f[3][0][0]) == 1]
    chains_ = [(found[i][1], *home_words(found[i][4], found[i][3][0], margin), *found[i][3][0]) for i in singles]
    out[singles] = [drop for _, _, drop, _ in chain_ends(owns, chains_, margin, min_words)]
    return out


def placed_ends(own: np.ndarray, home: np.ndarray, chains_: tuple[np.ndarray, ...], margin: int, min_words: int) -> tuple[np.ndarray, ...]:
    """:func:`all_ends` for chains that are given by places in all words of the documents (``own``) and of the homes
    (``home``), a few thousand at a time: where a chain starts and ends in both, and the bounds of its text and its home."""
    size, out, step = max(1, (1 << 18) // margin), [], np.arange(margin)

    def grown_(a: np.ndarray, b: np.ndarray, room: np.ndarray, side: int) -> tuple[np.ndarray, ...]:
        a, b = (np.clip(v[:, None] + side * step, 0, len(w) - 1) for v, w in ((a, own), (b, home)))
        return all_grown(own[a] == home[b], np.clip(room, 0, margin))

    for s in range(0, len(chains_[0]), size):
        x, y, end, home_end, low, high, home_low, home_high = (v[s:s + size] for v in chains_)
        lead, before, more = grown_(x - 1, y - 1, np.minimum(x - low, y - home_low), -1)
        tail, after, further = grown_(end, home_end, np.minimum(high - end, home_high - home_end), 1)
        more |= further
        out.append((before, after, (end - x + lead + tail < SHORT) & (end - x + before + after < min_words) & ~more, more))
    return tuple(map(np.concatenate, zip(*out)))


def span_rows(words: DataFrame, pairs: DataFrame, margin: int, min_words: int, some: bool) -> DataFrame:
    """Words of documents and of their homes meet per document, those of a home cut to the stretches that the pair needs. A
    row per pair: its passages, and its chains that need more words as a pair of the next round. ``some``: only few
    documents are left."""
    chain = [F.when(F.col("part") == 0, F.col(c)).alias(c) for c in ("sizes", "x", "y", "n")]
    asked = pairs.select("doc_id", "home", "sizes", "x", "y", "n", F.posexplode(F.arrays_zip("firsts", "lasts")).alias("part", "to"))
    asked = asked.select("doc_id", "home", "part", F.col("to.firsts").alias("first"), F.col("to.lasts").alias("last"), *chain)
    texts = common.wanted_rows(words, "doc_id", pairs.select("home")) if some else words
    width = 2 * BLOCK
    # both sides grow with the documents, so neither is broadcast
    sent = asked.join(texts.select(F.col("doc_id").alias("home"), "words").hint("merge"), "home").select(
        "doc_id", F.lit(1).alias("kind"), "home", "part", "first",
        F.substring("words", F.col("first") * width + 1, (F.col("last") - F.col("first")) * width).alias("words"), "sizes", "x", "y", "n")
    own = common.wanted_rows(words, "doc_id", pairs.select("doc_id")) if some else words
    rows = own.select("doc_id", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("home"), F.lit(0).alias("part"), F.lit(0).alias("first"), "words",
                      *[F.lit(None).cast("binary").alias(c) for c in ("sizes", "x", "y", "n")])
    keys = ["doc_id", "kind", "home", "part"]

    def places(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(b"".join(parts), np.uint16), np.cumsum([0, *(len(p) // 2 for p in parts)])

    def build(frames):
        for frame in common.whole_groups(gathered(frames, 4096), ["doc_id"]):
            values = frame[keys].to_numpy()
            mine, texts_of = values[:, 1] == 0, {}
            for doc, text in zip(values[mine, 0].tolist(), frame["words"][mine]):
                texts_of.setdefault(doc, set()).add(text)
            texts_of = {doc: next(iter(t)) for doc, t in texts_of.items() if len(t) == 1}
            number = {doc: i for i, doc in enumerate(texts_of)}
            # the texts of a home whose rows share its id: one of them
            kept = ~mine & np.append((values[1:] != values[:-1]).any(axis=1), True) & np.isin(values[:, 0], np.array(list(number), np.int64))
            if not kept.any():
                continue
            columns = {c: frame[c][kept].to_list() for c in ("words", "sizes", "x", "y", "n")}
            docs, _, homes, part = values[kept].T
            first = frame["first"].to_numpy()[kept].astype(np.int64) * BLOCK
            own, own_at = places(list(texts_of.values()))
            home, home_at = places(columns["words"])
            head = np.flatnonzero(part == 0)
            x, y, n, sizes = (np.frombuffer(b"".join(columns[c][i] for i in head), np.int32) for c in ("x", "y", "n", "sizes"))
            chain_pair = np.repeat(np.arange(len(head)), [len(columns["sizes"][i]) // 4 for i in head])
            edge = np.cumsum([0, *sizes.tolist()])
            text = np.array([number[d] for d in docs[head].tolist()])[chain_pair]
            start, stop = edge[:-1], edge[1:] - 1
            x0, y0, end, home_end = (v.astype(np.int64) for v in (x[start], y[start], x[stop] + n[stop], y[stop] + n[stop]))
            # the stretch of the home that holds the chain: the last of its pair that starts before it
            of_row = np.cumsum(part == 0) - 1
            row = np.searchsorted((of_row << 40) + first, (chain_pair << 40) + y0, side="right") - 1
            low, shift = own_at[text], home_at[row] - first[row]
            before, after, drop, more = placed_ends(own, home, (low + x0, shift + y0, low + end, shift + home_end, low, own_at[text + 1],
                                                                home_at[row], home_at[row + 1]), margin, min_words)
            found: dict[int, tuple[list, list]] = {}
            for c in np.flatnonzero(~drop).tolist():
                spans, left = found.setdefault(int(chain_pair[c]), ([], []))
                chain = tuple(v[edge[c]:edge[c + 1]] for v in (x, y, n))
                if more[c]:
                    left.append(chain)
                else:
                    r, t = row[c], text[c]
                    spans += aligned(own[own_at[t]:own_at[t + 1]], home[home_at[r]:home_at[r + 1]], first[r], *chain, margin, min_words,
                                     (before[c], after[c]))[0]
            out = []
            for pair, (spans, left) in found.items():
                if spans or left:
                    rest = pair_row(0, 0, left, margin * WIDER)[2:] if left else (b"", b"", b"", b"", [], [])
                    out.append((docs[head[pair]], homes[head[pair]], *rest, [a for a, _ in spans], [b for _, b in spans]))
            if out:
                yield pd.DataFrame(out, columns=["doc_id", "home", "sizes", "x", "y", "n", "firsts", "lasts", "starts", "ends"])

    return (rows.unionByName(sent).repartition("doc_id").sortWithinPartitions(*keys)
            .mapInPandas(build, PAIR + ", starts array<int>, ends array<int>"))


def passages(texts: DataFrame, min_words: int) -> DataFrame:
    """``doc_id``, ``starts``, ``ends``, ``homes`` of the documents that repeat an earlier one."""
    with freed_shuffles(texts.sparkSession):
        pairs = common.store(chain_rows(match_chunks(seed_rows(texts, min_words), min_words)), "pairs")
        words = common.store(word_rows(texts), "words")
        margin, rounds = MARGIN, []
        while not rounds or not pairs.isEmpty():
            rounds.append(common.store(span_rows(words, pairs, margin, min_words, bool(rounds)), "spans"))
            pairs = rounds[-1].where("size(firsts) > 0").select(*pairs.columns)
            margin *= WIDER
    found = rounds[0]
    for more in rounds[1:]:
        found = found.unionByName(more)
    found = found.select("doc_id", "home", F.explode(F.arrays_zip("starts", "ends")).alias("part"))
    found = found.groupBy("doc_id").agg(F.collect_list(F.struct("part.starts", "part.ends", "home")).alias("parts"))

    def build(frames):
        for frame in frames:
            spans = [merged([(p["starts"], p["ends"], p["home"]) for p in parts], min_words) for parts in frame["parts"]]
            rows = [(doc, *map(list, zip(*found))) for doc, found in zip(frame["doc_id"], spans) if found]
            if rows:
                yield pd.DataFrame(rows, columns=["doc_id", "starts", "ends", "homes"])

    return common.store(found.mapInPandas(build, "doc_id long, starts array<int>, ends array<int>, homes array<long>"), "passages")


def repeated_passages(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """A row per document: ``doc_id``, ``n_words``, and the word spans ``starts``/``ends`` of passages that repeat an
    earlier document, with the ids of these in ``homes``.

    Null and empty texts have no spans. Rows without an id take no part and come back without spans. Rows
    that share an id but not their text keep it whole; identical rows are treated alike.
    """
    common.prepare(docs.sparkSession)
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    found = passages(texts.where("doc_id IS NOT NULL"), min_words)
    spans = [F.coalesce(c, F.array().cast(f"array<{t}>")).alias(c) for c, t in (("starts", "int"), ("ends", "int"), ("homes", "long"))]
    return texts.select("doc_id", F.pandas_udf(word_counts, "long")("text").alias("n_words")).join(found, "doc_id", "left").select("doc_id", "n_words", *spans)


def cut_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents without passages that repeat an earlier document; documents of which nothing stays go.

    ``n_chars`` follows the new text. Documents without a repeat come back unchanged. Rows that share an id are
    documents of their own, in the order of the table.
    """
    common.prepare(docs.sparkSession)
    whole, key = common.own_rows(docs)
    texts = whole.select(F.col(key).alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = passages(texts.where("doc_id IS NOT NULL"), min_words)

    def build(frames):
        for frame in frames:
            yield pd.DataFrame({"doc_id": frame["doc_id"], "cut_text": [
                cut_text(t, [(int(a), int(b), 0) for a, b in zip(s, e)]) for t, s, e in zip(frame["text"], frame["starts"], frame["ends"])]})

    cut = (texts.join(found.where("size(starts) > 0"), "doc_id").select("doc_id", "text", "starts", "ends")
           .mapInPandas(build, "doc_id long, cut_text string"))
    cut = common.store(cut.dropDuplicates(["doc_id"]), "cut")
    rows = whole.select(F.struct(*docs.columns).alias("row"), F.col(key).alias("doc_id"))
    joined = rows.join(cut, "doc_id", "left").where("cut_text IS NULL OR cut_text RLIKE '[^ \\t-\\r]'")
    changed = {"text": F.col("cut_text"), "n_chars": F.length("cut_text").cast("long")}
    return joined.select(*[F.coalesce(changed[c], F.col("row")[c]).alias(c) if c in changed else F.col("row")[c].alias(c)
                           for c in docs.columns])
