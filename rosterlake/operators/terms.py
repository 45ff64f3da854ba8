"""Scores of list against list: the mean over needed terms of the best similarity among the terms at hand.

Terms are numbered once and their similarity is computed once per pair of terms that meets anywhere. Jobs and
candidates become lists of term numbers, equal lists one list; pairs of lists are scored by joining numbers. No vector
is ever on a row of a pair: with an encoder, vectors stay in the term table, and where a threshold is given a summary
of a few numbers per term (its first coordinates and the norm of the rest) bounds the similarity, so that only pairs
that may reach the threshold are joined with the vectors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vectors
from ..session import store
from .embedding import Encoder
from .tfidf import Tfidf

#: Coordinates of a term's summary before the norm of the rest.
SUMMARY = 32
#: Rounding of 32-bit coordinates that a bound must allow for.
SLACK = 1e-5


# ------------------------------------------------------------------------- similar texts
def summary(vector: Column, size: int = SUMMARY) -> Column:
    """The first coordinates and the norm of the rest: the cosine of two summaries is not below that of the vectors."""
    rest = F.filter(vector, lambda x, i: i >= size)
    norm = F.sqrt(F.aggregate(rest, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))
    return F.concat(F.slice(vector, 1, size).cast("array<double>"), F.array(norm))


class Vectors:
    """Vectors of distinct texts (id, text) by an encoder, stored; a text for which it has none is not known."""

    def __init__(self, texts: DataFrame, encode: Encoder) -> None:
        known = texts.join(encode(texts.select("text")), "text").where("vector IS NOT NULL")
        self.table = store(known.select("id", "text", "vector"), "vectors")
        self.known = self.table.select("id", "text")

    def similar(self, pairs: DataFrame, threshold: float | None = None) -> DataFrame:
        side = lambda name, c: self.table.select(F.col("id").alias(name), c.alias(f"_{name}"))
        cosine = vectors.cosine(F.col("_a"), F.col("_b"))
        if threshold is not None:
            short = summary(F.col("vector"))
            pairs = store(pairs.join(side("a", short), "a").join(side("b", short), "b").where(cosine >= threshold - SLACK).select("a", "b"), "close")
        joined = pairs.join(side("a", F.col("vector")), "a", "left").join(side("b", F.col("vector")), "b", "left")
        return joined.select("a", "b", cosine.alias("similarity"))


class Weights:
    """Word weights of distinct texts (id, text) in an inverted index."""

    def __init__(self, texts: DataFrame, model: Tfidf) -> None:
        self.known, self.model, self.index = texts, model, model.index(texts)

    def similar(self, pairs: DataFrame, threshold: float | None = None) -> DataFrame:
        return self.model.cosines(self.index, pairs)


def compare_by(texts: DataFrame, encode: Encoder | Tfidf) -> Vectors | Weights:
    """What compares distinct texts (id, text): ``similar(pairs, threshold)`` gives (a, b, similarity) of distinct pairs
    (a, b) of ids, null where a text has no vector; with a threshold, pairs below it may be missing."""
    return Weights(texts, encode) if isinstance(encode, Tfidf) else Vectors(texts, encode)


def text_key(text: Column) -> Column:
    """The first 16 bytes of the SHA-256 digest: as an id on every row of a word it is a quarter of the digest in hex."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def text_similarity(df: DataFrame, left: str, right: str, output: str, encode: Encoder | Tfidf,
                    texts: DataFrame | None = None) -> DataFrame:
    """Add the similarity of two text columns of the same row; null where a text is missing or has no vector.

    Each distinct pair of texts is compared once and found again by its digests. ``texts`` (text) lists the texts of
    both columns where they come from tables of entities; else they are taken from the rows, once per task and text.
    """
    keyed = df.withColumns({"_a": text_key(F.col(left)), "_b": text_key(F.col(right))})
    if texts is None:
        texts = df.select(F.explode(F.array(left, right)).alias("text"))
    # distinct texts are hashed in memory; a maximum of texts per digest would sort every row of a task
    known = texts.where("text IS NOT NULL").select("text").distinct().select(text_key(F.col("text")).alias("id"), "text")
    pairs = store(keyed.select(F.col("_a").alias("a"), F.col("_b").alias("b")).where("a IS NOT NULL AND b IS NOT NULL").distinct(), "pairs")
    found = store(compare_by(store(known, "texts"), encode).similar(pairs), "similar")
    found = found.select(F.col("a").alias("_a"), F.col("b").alias("_b"), F.col("similarity").alias(output))
    return keyed.join(found, ["_a", "_b"], "left").drop("_a", "_b")


# ---------------------------------------------------------------------------- term lists
def numbered_terms(items: DataFrame) -> DataFrame:
    """(id, text) of the distinct terms of ``items`` (text), stored so that the numbers stay."""
    return store(items.select("text").distinct().withColumn("id", F.monotonically_increasing_id()), "terms")


def list_items(lists: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, column, text) of every term in the list columns; empty strings and nulls are left out."""
    def tagged(name: str) -> Column:
        return F.transform(F.coalesce(F.col(name), F.array().cast("array<string>")), lambda x: F.struct(F.lit(name).alias("column"), x.alias("text")))

    return lists.select(F.col(key).alias("key"), F.explode(F.flatten(F.array(*map(tagged, columns)))).alias("x")).select("key", "x.column", "x.text").where("text <> ''")


def term_lists(items: DataFrame, terms: DataFrame, columns: list[str]) -> DataFrame:
    """(key, one sorted array of term numbers per column, null where a list is empty)."""
    numbers = items.join(terms, "text")
    return numbers.groupBy("key").agg(*[F.sort_array(F.collect_list(F.when(F.col("column") == c, F.col("id")))).alias(c) for c in columns])


def digest(ids: Column) -> Column:
    return F.sha2(F.array_join(ids.cast("array<string>"), ","), 256)


def best_means(sets: DataFrame, compare: Vectors | Weights, threshold: float | None) -> DataFrame:
    """(need, have, score) for distinct pairs of lists: ``sets`` has their digests and ``_need``, ``_have`` as arrays of numbers."""
    needs = sets.groupBy("need").agg(F.first("_need").alias("_need"))
    haves = store(sets.groupBy("have").agg(F.first("_have").alias("_have")), "haves")
    pairs = sets.select("need", "have")
    each = pairs.join(needs, "need").select("need", "have", F.explode("_need").alias("a"), F.size("_need").alias("n"))
    wanted = store(each.select("a", "have").distinct(), "wanted")
    met = wanted.join(haves, "have").select("a", "have", F.explode(F.array_distinct("_have")).alias("b"))
    similar = store(compare.similar(met.select("a", "b").distinct(), threshold), "similar")
    best = met.join(similar, ["a", "b"]).groupBy("a", "have").agg(F.max(F.coalesce("similarity", F.lit(0.0))).alias("best"))
    value = F.col("best") if threshold is None else F.when(F.col("best") >= threshold, F.col("best"))
    joined = each.join(best, ["a", "have"], "left")
    return joined.groupBy("need", "have").agg((F.sum(F.coalesce(value, F.lit(0.0))) / F.first("n")).alias("score"))


def list_scores(pairs: DataFrame, needs: DataFrame, haves: DataFrame, need_key: str, have_key: str, encode: Encoder | Tfidf,
                scores: dict[str, tuple[str, str, float | None, float]]) -> DataFrame:
    """Scores of distinct ``pairs`` of keys from the list columns of two tables with one row per key.

    ``scores`` names, per output, the needed list, the list at hand, the threshold (None: none) and the score where a
    list is empty. A repeated needed term counts each time, a term without a vector not at all. All columns share one
    dictionary of terms.
    """
    sides = []
    for table, key, at in ((needs, need_key, 0), (haves, have_key, 1)):
        columns = sorted({spec[at] for spec in scores.values()})
        sides.append((store(list_items(table, key, columns), "items"), key, columns))
    compare = compare_by(numbered_terms(sides[0][0].select("text").unionAll(sides[1][0].select("text"))), encode)
    out = pairs
    for side, (items, key, columns) in zip(("need", "have"), sides):
        lists = term_lists(items, compare.known, columns).withColumnRenamed("key", key)
        out = out.join(lists.select(key, *[F.col(c).alias(f"_{side}_{c}") for c in columns]), key, "left")
    ids = {name: (F.col(f"_need_{need}"), F.col(f"_have_{have}")) for name, (need, have, _, _) in scores.items()}
    numbers = [d.alias(f"_{name}_{side}") for name, both in ids.items() for side, d in zip(("need", "have"), map(digest, both))]
    lists = [x.alias(f"_{name}_{side}s") for name, both in ids.items() for side, x in zip(("need", "have"), both)]
    wide = store(out.select(need_key, have_key, *numbers, *lists), "lists")
    result = wide.select(need_key, have_key, *[c for c in wide.columns if c.endswith(("_need", "_have"))])
    for name, (_, _, threshold, empty) in scores.items():
        need, have = F.col(f"_{name}_needs"), F.col(f"_{name}_haves")
        sets = wide.where((F.size(need) > 0) & (F.size(have) > 0)).groupBy(
            F.col(f"_{name}_need").alias("need"), F.col(f"_{name}_have").alias("have")).agg(F.first(need).alias("_need"), F.first(have).alias("_have"))
        means = store(best_means(store(sets, "sets"), compare, threshold), "means").select(
            F.col("need").alias(f"_{name}_need"), F.col("have").alias(f"_{name}_have"), F.col("score").alias(name))
        result = result.join(means, [f"_{name}_need", f"_{name}_have"], "left").withColumn(name, F.coalesce(name, F.lit(float(empty))))
    return result.select(need_key, have_key, *scores)
