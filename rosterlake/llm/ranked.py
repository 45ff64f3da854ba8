"""Ranked lexical search by dense blocked matrix products.

Documents are read once to count the terms that the items use; the counts are stored, and from them come the number of
documents, their length and the weight of every term. Then each batch of documents is a tile of the impact matrix
(terms by documents, float64), each group of items a tile of a 0/1 matrix (items by terms, only the terms of these
items), and their products, taken in slices of ``VOCABULARY`` terms, add up to the scores. An impact is below
2^15 * 2^20 (weight times saturation), so a slice of 2^18 terms stays below 2^53 and every partial sum is exact; slices
are added as 64-bit integers.

A task keeps the ``k`` best documents per item. Ties are safe: a tile passes on every document that reaches its k-th
score, and the choice among equal scores is by document id, rows without an id last.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, store
from .lexical import BLOCK_BYTES, query_blocks, words

#: Items and terms of a tile; documents of a tile are the rows of an Arrow batch.
ITEMS, VOCABULARY = 256, 2048
#: Groups that the best rows of the tasks are merged in before the last merge of an item.
SHARDS = 64


def term_counts(docs: DataFrame, numbers: dict[bytes, int], id_column: str, text_column: str) -> DataFrame:
    """``doc_id``, ``n`` (all terms with repeats) and the wanted terms of every document with at least one term."""
    known = docs.sparkSession.sparkContext.broadcast(numbers)

    def count(frames):
        number = known.value
        for frame in frames:
            rows = []
            for key, text in zip(frame["doc_id"], frame["text"]):
                found = words(text)
                wanted = np.array([i for i in map(number.get, found) if i is not None], np.int32)
                terms, times = np.unique(wanted, return_counts=True)
                rows.append((key, len(found), terms, times))
            out = pd.DataFrame(rows, columns=["doc_id", "n", "terms", "times"])
            yield out[out["n"] > 0].astype({"doc_id": "Int64"})

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInPandas(count, "doc_id long, n long, terms array<int>, times array<long>")


def term_weight(n_docs: int, n_with: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n_with + 1)))


class Tile:
    """Up to ``ITEMS`` items against their own terms: a dense 0/1 matrix in slices of ``VOCABULARY`` terms."""

    def __init__(self, first: int, terms_of: list[np.ndarray], n_terms: int) -> None:
        used = np.unique(np.concatenate(terms_of))
        self.first, self.size, self.width = first, len(terms_of), len(used)
        self.place = np.full(n_terms, -1, np.int64)
        self.place[used] = np.arange(len(used))
        self.terms_of = terms_of

    def slice(self, start: int) -> np.ndarray:
        dense = np.zeros((self.size, min(VOCABULARY, self.width - start)))
        for row, terms in enumerate(self.terms_of):
            at = self.place[terms] - start
            dense[row, at[(at >= 0) & (at < dense.shape[1])]] = 1.0
        return dense

    def scores(self, slices: list[np.ndarray], terms: np.ndarray, docs: np.ndarray, impact: np.ndarray, n_docs: int) -> np.ndarray:
        total = np.zeros((self.size, n_docs), np.int64)
        at = self.place[terms]
        for number, dense in enumerate(slices):
            here = at - number * VOCABULARY
            inside = np.flatnonzero((here >= 0) & (here < dense.shape[1]))
            if len(inside):
                tile = np.zeros((dense.shape[1], n_docs))
                tile[here[inside], docs[inside]] = impact[inside]
                total += (dense @ tile).astype(np.int64)
        return total


def best_rows(found: np.ndarray, k: int) -> np.ndarray:
    """The k first rows of every item from columns (item, -score, id missing, id, ...), sorted."""
    found = found[np.lexsort(found.T[3::-1])]
    starts = np.flatnonzero(np.r_[True, found[1:, 0] != found[:-1, 0]]) if len(found) else np.empty(0, np.int64)
    rank = np.arange(len(found)) - np.repeat(starts, np.diff(np.r_[starts, len(found)]))
    return found[rank < k]


def block_scores(counts: DataFrame, terms_of: list[np.ndarray], weights: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(``item``, ``doc_id``, ``score``): the k best documents of every task for every item of a block."""
    sent = counts.sparkSession.sparkContext.broadcast((terms_of, weights))

    def score(frames):
        terms_of, weights = sent.value
        tiles = [Tile(at, terms_of[at:at + ITEMS], len(weights)) for at in range(0, len(terms_of), ITEMS)]
        # slices of one tile are kept; with more tiles they are made again for each batch
        kept = {t.first: [t.slice(s) for s in range(0, t.width, VOCABULARY)] for t in tiles[:1]}
        best = np.empty((0, 4), np.int64)
        for frame in frames:
            sizes = frame["terms"].map(len).to_numpy()
            if not sizes.sum():
                continue
            terms = np.concatenate(frame["terms"].to_list()).astype(np.int64)
            times = np.concatenate(frame["times"].to_list()).astype(np.int64)
            docs = np.repeat(np.arange(len(frame)), sizes)
            length = np.array([100 - 50 + 50 * int(n) * n_docs // n_terms for n in frame["n"]], np.int64)
            impact = (weights[terms] * (1_000_000_000 * times // (1000 * times + 20 * length[docs]))).astype(np.float64)
            missing = frame["doc_id"].isna().to_numpy()
            ids = frame["doc_id"].astype("Int64").fillna(0).to_numpy(np.int64)
            for tile in tiles:
                slices = kept.get(tile.first) or [tile.slice(s) for s in range(0, tile.width, VOCABULARY)]
                total = tile.scores(slices, terms, docs, impact, len(frame))
                floor = np.ones(tile.size, np.int64)
                mine = best[(best[:, 0] >= tile.first) & (best[:, 0] < tile.first + tile.size)]
                for item, count in zip(*np.unique(mine[:, 0], return_counts=True)):
                    if count == k:
                        floor[item - tile.first] = max(1, -mine[mine[:, 0] == item, 1].max())
                if total.shape[1] > k:
                    floor = np.maximum(floor, np.partition(total, -k, axis=1)[:, -k])
                row, col = np.nonzero(total >= floor[:, None])
                new = np.stack([row + tile.first, -total[row, col], missing[col].astype(np.int64), ids[col]], axis=1)
                best = np.concatenate([best, new])
            best = best_rows(best, k)
        yield pd.DataFrame({"item": best[:, 0], "doc_id": pd.array(best[:, 3], "Int64"), "score": -best[:, 1]}).assign(
            doc_id=lambda x: x["doc_id"].mask(best[:, 2] == 1))

    return counts.mapInPandas(score, "item long, doc_id long, score long")


def merged(found: DataFrame, k: int) -> DataFrame:
    """The k best rows per item with their ``rank``, first within shards of an item, then over the shards."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    shard = F.pmod(F.xxhash64("doc_id"), F.lit(SHARDS))
    some = found.withColumn("shard", shard).withColumn("place", F.row_number().over(Window.partitionBy("item", "shard").orderBy(*order)))
    some = some.where(F.col("place") <= k)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 50, doc_id: str = "doc_id", doc_text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: the k best documents of every item with a score above 0.

    Every row of ``items`` is an item of its own, also where ids or whole rows repeat, and every row of ``docs`` a
    document. Null and empty texts have no terms: such items return nothing, such documents are not counted. Documents
    without an id come last among equal scores. An empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    spark = docs.sparkSession
    key_type = items.schema[item_id].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {key_type}, rank int, doc_id long, score long")
    for rows in query_blocks(items, item_id, item_text, block_bytes):
        numbers: dict[bytes, int] = {}
        terms_of = [np.unique([numbers.setdefault(t, len(numbers)) for t in words(r["text"])]) for r in rows]
        counts = store(term_counts(docs, numbers, doc_id, doc_text), "counts")
        n_docs, n_terms = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        with_term = np.zeros(len(numbers), np.int64)
        for term, count in counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            with_term[term] = count
        weights = np.array([term_weight(n_docs, int(n)) for n in with_term], np.int64)
        best = merged(block_scores(counts, terms_of, weights, n_docs, n_terms, k), k)
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], f"item long, item_id {key_type}")
        out = out.unionByName(best.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    return out


#: Words of a text as DuckDB finds them.
SQL_WORDS = ("regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
             "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")

SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {SQL_WORDS} AS w FROM documents WHERE text IS NOT NULL),
i AS (SELECT row_number() OVER () AS item, item_id, {SQL_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
it AS (SELECT DISTINCT item, item_id, unnest(w) AS term FROM i),
dt AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY r, term),
s AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0),
df AS (SELECT term, count(*) AS df FROM dt GROUP BY term),
wt AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS w FROM df, s),
m AS (SELECT r, doc_id, 100 - 50 + ((50 * len(w) * n_docs) // n_terms) AS m FROM d, s WHERE len(w) > 0),
sc AS (SELECT item, item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
       FROM it JOIN dt USING (term) JOIN wt USING (term) JOIN m USING (r) GROUP BY ALL),
o AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM sc WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM o WHERE rank <= 50
"""
