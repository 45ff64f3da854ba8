"""Benchmark decontamination by a distributed positional inverted index.

``build_index`` stores the postings of all words of a corpus, sharded by document: a row of the index holds the
documents of one shard (up to ``SHARD_WORDS`` words, or one longer document), its distinct terms (separated by a space,
which no term holds), and for every term the length of its list and the sorted positions, counted over the words of the
shard, as packed 32-bit integers. So no list grows with the corpus, a search needs
no shuffle, and the lists of one shard are searched by one task.

A search takes the windows of the test items a block at a time. In each shard a window whose terms all occur starts
from its rarest term: the positions of that list, less the term's offset in the window, are the candidate starts; then
the list of the next rarest term, moved by its own offset, is intersected with them, and so on. What is left are exact
phrases. A proximity match is a stretch of at most ``within`` words that holds every distinct word of the window in any
order; its candidates start at the postings around the rarest term. No match crosses the end of a document.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, spread, store
from .lexical import BLOCK_BYTES, query_blocks, words
from .ranked import SQL_WORDS

WINDOW = 10
SHARD_WORDS = 1 << 16
#: Candidate starts that are intersected at a time.
CANDIDATES = 1 << 21

INDEX = "shard long, doc_ids array<long>, lengths array<int>, terms string, counts binary, positions binary"


# ----------------------------------------------------------------------------------- index
def shard_row(shard: int, ids: list, texts: list[list[bytes]]) -> tuple:
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    stream = np.array([i for text in texts for i in map(number.__getitem__, text)], np.int32)
    counts = np.bincount(stream, minlength=len(number)).astype("<i4")
    return (shard, ids, [len(t) for t in texts], b" ".join(number).decode("utf-8", "replace"), counts.tobytes(),
            np.argsort(stream, kind="stable").astype("<i4").tobytes())


def build_index(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shard_words: int = SHARD_WORDS) -> DataFrame:
    """The index of all rows of ``docs`` (``INDEX``), written to the shared folder, so that its shards keep their keys.

    Every row is a document of its own, also with a null or repeated id; null texts have no words but are listed.
    """
    prepare(docs.sparkSession)

    def postings(frames):
        shard = TaskContext.get().partitionId() << 33
        names = [c.split()[0] for c in INDEX.split(", ")]
        for frame in frames:
            ids, texts, size = [], [], 0
            for key, text in zip(frame["doc_id"], frame["text"]):
                found = words(text)
                if texts and size + len(found) > shard_words:
                    yield pd.DataFrame([shard_row(shard, ids, texts)], columns=names)
                    shard, ids, texts, size = shard + 1, [], [], 0
                ids.append(None if pd.isna(key) else int(key))
                texts.append(found)
                size += len(found)
            if texts:
                yield pd.DataFrame([shard_row(shard, ids, texts)], columns=names)
                shard += 1

    rows = docs.select(F.col(id_column).cast("string").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return store(rows.mapInPandas(postings, INDEX), "phrases")


# --------------------------------------------------------------------------------- windows
@dataclass
class Windows:
    """Distinct windows of a block of items: a row of term numbers each (-1 behind a short one), and the items they stand in."""

    numbers: dict[str, int]
    terms: np.ndarray
    sizes: np.ndarray
    items: list[list]

    @staticmethod
    def of(rows: list, size: int) -> Windows:
        numbers: dict[str, int] = {}
        found: dict[tuple, set] = {}
        for row in rows:
            ids = [numbers.setdefault(w.decode("utf-8", "replace"), len(numbers)) for w in words(row["text"])]
            for at in range(max(len(ids) - size, 0) + 1):
                found.setdefault(tuple(ids[at:at + size]), set()).add(row["item_id"])
        terms = np.full((len(found), size), -1, np.int64)
        for number, window in enumerate(found):
            terms[number, :len(window)] = window
        return Windows(numbers, terms, np.array([len(w) for w in found], np.int64),
                       [sorted(str(i) for i in items if i is not None) for items in found.values()])


class Lists:
    """Posting lists of the wanted terms of one shard: keys (term number * stride + position) in ascending order."""

    def __init__(self, numbers: dict[str, int], terms: str, counts: bytes, positions: bytes, lengths) -> None:
        counts, positions = (np.frombuffer(x, "<i4").astype(np.int64) for x in (counts, positions))
        self.ends = np.cumsum(np.asarray(lengths, np.int64))
        self.starts = self.ends - np.asarray(lengths, np.int64)
        self.stride = len(positions) + 1
        number = np.array([numbers.get(t, -1) for t in terms.split(" ") if t], np.int64)
        lists = np.flatnonzero(number >= 0)
        lists = lists[np.argsort(number[lists])]
        self.count = np.zeros(len(numbers), np.int64)
        self.count[number[lists]] = counts[lists]
        self.begin = np.cumsum(self.count) - self.count
        first = np.cumsum(counts) - counts
        self.keys = (np.repeat(number[lists] * self.stride, counts[lists]) + positions[spread(first[lists], counts[lists])])

    def holds(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        want = term * self.stride + position
        at = np.searchsorted(self.keys, want)
        return (position >= 0) & (position < self.stride) & (self.keys[np.minimum(at, len(self.keys) - 1)] == want)

    def next(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        """The first position of the term that is not before ``position``; the stride if there is none."""
        at = np.searchsorted(self.keys, term * self.stride + position)
        inside = at < (self.begin + self.count)[term]
        return np.where(inside, self.keys[np.minimum(at, len(self.keys) - 1)] - term * self.stride, self.stride)

    def document(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, position, side="right")


def portions(counts: np.ndarray, most: int) -> list[slice]:
    """Stretches of rows with about ``most`` in all; a longer row is a stretch by itself."""
    cuts = np.flatnonzero(np.diff(np.cumsum(counts) // most)) + 1
    edges = [0, *cuts.tolist(), len(counts)]
    return [slice(a, b) for a, b in zip(edges, edges[1:]) if b > a]


def rarest_first(lists: Lists, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows of which every term occurs in the shard, and the order of their terms by list length (missing ones last)."""
    length = np.where(terms >= 0, lists.count[terms], np.iinfo(np.int64).max)
    alive = np.flatnonzero((length > 0).all(axis=1))
    return alive, np.argsort(length[alive], axis=1, kind="stable")


def phrase_starts(lists: Lists, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
    """(window, start) of every exact phrase of the shard."""
    alive, order = rarest_first(lists, windows.terms)
    found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    rarest = windows.terms[alive, order[:, 0]] if len(alive) else alive
    for part in portions(lists.count[rarest], CANDIDATES):
        count = lists.count[rarest[part]]
        row = np.repeat(np.arange(part.start, part.stop), count)
        start = lists.keys[spread(lists.begin[rarest[part]], count)] - windows.terms[alive[row], order[row, 0]] * lists.stride - order[row, 0]
        for k in range(1, windows.terms.shape[1]):
            offset = order[row, k]
            term = windows.terms[alive[row], offset]
            ok = (term < 0) | lists.holds(np.maximum(term, 0), start + offset)
            row, start = row[ok], start[ok]
        ok = start >= 0
        row, start = row[ok], start[ok]
        ok = start + windows.sizes[alive[row]] <= lists.ends[lists.document(start)]
        found.append((alive[row[ok]], start[ok]))
    return np.concatenate([w for w, _ in found]), np.concatenate([s for _, s in found])


def near_stretches(lists: Lists, windows: Windows, within: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, start, end) of every stretch of at most ``within`` words that starts with a word of the window and
    holds all of them, as short as that start allows."""
    alive, order = rarest_first(lists, windows.terms)
    none = np.empty(0, np.int64)
    found = [(none, none, none)]
    rarest = windows.terms[alive, order[:, 0]] if len(alive) else alive
    for part in portions(lists.count[rarest] * windows.terms.shape[1] * within, CANDIDATES):
        count = lists.count[rarest[part]]
        row = np.repeat(np.arange(part.start, part.stop), count)
        term = rarest[row]
        anchor = lists.keys[spread(lists.begin[rarest[part]], count)] - term * lists.stride
        pairs = []
        for k in range(windows.terms.shape[1]):  # postings of every term in the words before the anchor
            other = windows.terms[alive[row], k]
            used = np.flatnonzero(other >= 0)
            low = np.searchsorted(lists.keys, other[used] * lists.stride + np.maximum(anchor[used] - within + 1, 0))
            high = np.searchsorted(lists.keys, other[used] * lists.stride + anchor[used], side="right")
            at = spread(low, high - low)
            pairs.append(np.stack([np.repeat(alive[row[used]], high - low),
                                   lists.keys[at] - np.repeat(other[used], high - low) * lists.stride]))
        pair = np.unique(np.concatenate(pairs, axis=1), axis=1)
        window, start = pair[0], pair[1]
        end = start.copy()
        for k in range(windows.terms.shape[1]):
            other = windows.terms[window, k]
            end = np.maximum(end, np.where(other < 0, start, lists.next(np.maximum(other, 0), start)))
        ok = (end - start < within) & (end < lists.stride)
        window, start, end = window[ok], start[ok], end[ok]
        ok = end < lists.ends[lists.document(start)]
        found.append((window[ok], start[ok], end[ok] + 1))
    return tuple(np.concatenate([f[i] for f in found]) for i in range(3))


# ---------------------------------------------------------------------------------- search
MATCHES = "shard long, number int, doc_id long, start int, end int, items array<string>, kind string"
HITS = "shard long, number int, hit array<int>, items array<string>"


def search(index: DataFrame, windows: Windows, finish, schema: str) -> DataFrame:
    """``finish(row, lists, windows)`` over every shard that holds a term of the windows; it returns tuples of ``schema``."""
    # plain values, so that workers need no module to read them
    sent = index.sparkSession.sparkContext.broadcast((windows.numbers, windows.terms, windows.sizes, windows.items))
    names = [c.split()[0] for c in schema.split(", ")]

    def shards(frames):
        windows = Windows(*sent.value)
        for frame in frames:
            for row in frame.itertuples(index=False):
                lists = Lists(windows.numbers, row.terms, row.counts, row.positions, row.lengths)
                if len(lists.keys):
                    yield pd.DataFrame(finish(row, lists, windows), columns=names)

    return index.mapInPandas(shards, schema)


def matches(index: DataFrame, items: DataFrame, size: int = WINDOW, within: int | None = None, item_id: str = "item_id",
            item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Exact phrases of the items' windows and, with ``within``, the proximity matches.

    One row per match: ``shard`` and ``number`` (the document's row in the index), ``doc_id``, the words ``start`` to
    ``end`` (exclusive) of the document, ``items`` (ids as sorted strings) and ``kind`` (phrase or near). Items without
    words match nothing, an item shorter than ``size`` is one window, items without an id have matches with no id.
    """
    def finish(row, lists, windows):
        window, start = phrase_starts(lists, windows)
        found = [(window, start, start + windows.sizes[window], "phrase")]
        if within:
            found.append((*near_stretches(lists, windows, within), "near"))
        out = []
        for window, start, end, kind in found:
            number = lists.document(start)
            offset = lists.starts[number]
            ids = [None if pd.isna(row.doc_ids[n]) else int(row.doc_ids[n]) for n in number]
            out += zip([row.shard] * len(start), number, ids, start - offset, end - offset,
                       [windows.items[w] for w in window], [kind] * len(start))
        return out

    blocks = [search(index, Windows.of(rows, size), finish, MATCHES) for rows in query_blocks(items, item_id, item_text, block_bytes)]
    out = index.sparkSession.createDataFrame([], MATCHES)
    for block in blocks:
        out = out.unionByName(block)
    return out


def document_hits(index: DataFrame, items: DataFrame, size: int = WINDOW, item_id: str = "item_id", item_text: str = "text",
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(``shard``, ``number``, ``hit``, ``items``): the hit word positions and item ids of the documents with a phrase, per block of items."""
    def finish(row, lists, windows):
        window, start = phrase_starts(lists, windows)
        number = lists.document(start)
        out = []
        for n in np.unique(number):
            mine = number == n
            hit = np.unique(spread(start[mine], windows.sizes[window[mine]])) - lists.starts[n]
            out.append((row.shard, n, hit, sorted({i for w in np.unique(window[mine]) for i in windows.items[w]})))
        return out

    out = index.sparkSession.createDataFrame([], HITS)
    for rows in query_blocks(items, item_id, item_text, block_bytes):
        out = out.unionByName(search(index, Windows.of(rows, size), finish, HITS))
    return out


def contamination(index: DataFrame, items: DataFrame, size: int = WINDOW, **options) -> DataFrame:
    """One row per document of the index: ``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``.

    ``n_hit`` counts the words inside any occurrence of any window, ``n_items`` the different item ids whose windows
    occur. Documents without words have zeros and the digest of the empty string; an empty benchmark leaves all clean.
    """
    documents = index.select("shard", F.posexplode(F.arrays_zip("doc_ids", "lengths")).alias("number", "x")).select(
        "shard", "number", F.col("x.doc_ids").alias("doc_id"), F.col("x.lengths").cast("long").alias("n_words"))
    hits = document_hits(index, items, size, **options).groupBy("shard", "number").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("hit")))).cast("long").alias("n_hit"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    hits = hits.select("shard", "number", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("digest"))
    joined = documents.join(hits, ["shard", "number"], "left")
    return joined.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
                         F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, items: DataFrame, size: int = WINDOW, **options) -> DataFrame:
    """``contamination`` of the documents through an index of them."""
    return contamination(build_index(docs), items, size, **options)


SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({SQL_WORDS}, []) AS w FROM documents),
i AS (SELECT item_id, {SQL_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
iw AS (SELECT DISTINCT item_id, k, array_to_string(w[p:p + k - 1], ' ') AS phrase
       FROM (SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p FROM i WHERE len(w) > 0)),
dw AS (SELECT r, k, p, array_to_string(w[p:p + k - 1], ' ') AS phrase
       FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM iw) WHERE len(w) >= k)),
h AS (SELECT DISTINCT r, k, p, item_id FROM dw JOIN iw USING (k, phrase)),
n AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(p, p + k)) AS at FROM h) GROUP BY r),
x AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
      FROM (SELECT DISTINCT r, item_id::VARCHAR AS x FROM h WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN x USING (r)
"""
