"""Exact TF-IDF similarity over an inverted index.

Words are the lower-case runs of letters, digits and connectors. The index has a row per (text, word) with the weight
of the word in the unit vector of its text, so a vector has as many entries as its text has words and no word is hashed
onto another. The similarity of given pairs is a sum over common words, found by joining the index.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import store

#: What separates two words.
SEPARATOR = r"(?U)\W+"


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), SEPARATOR), lambda w: w != "")


@dataclass(frozen=True)
class Tfidf:
    """Fitted on the distinct texts that are compared; a word in fewer than ``min_docs`` of them has weight 0.

    The weight of a word is its count times ln((texts + 1) / (texts with it + 1)). A word that all texts hold weighs
    nothing; a text without a weighted word has no vector.
    """

    min_docs: int = 0

    def index(self, texts: DataFrame) -> DataFrame:
        """(id, word, weight) of a table (id, text) of distinct texts, stored."""
        counts = store(texts.select("id", F.explode(words(F.col("text"))).alias("word")).groupBy("id", "word").agg(F.count("*").alias("times")), "words")
        total = texts.count()
        spread = counts.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= self.min_docs)
        idf = spread.select("word", F.log((F.lit(total) + 1.0) / (F.col("n") + 1.0)).alias("idf"))
        weights = counts.join(idf, "word").select("id", "word", (F.col("times") * F.col("idf")).alias("weight")).where("weight > 0")
        norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy("id")))  # a text has its own words only
        return store(weights.select("id", "word", (F.col("weight") / norm).alias("weight")), "index")

    def cosines(self, index: DataFrame, pairs: DataFrame) -> DataFrame:
        """(a, b, similarity) of distinct pairs of text ids; null where a text has no vector.

        A pair becomes one narrow row per word of its first text, which meets the postings of the second by (id, word):
        no vector travels with a pair, and a word that all texts share is no join key by itself.
        """
        left = index.select(F.col("id").alias("a"), "word", F.col("weight").alias("_wa"))
        right = index.select(F.col("id").alias("b"), "word", F.col("weight").alias("_wb"))
        sums = pairs.join(left, "a").join(right, ["b", "word"]).groupBy("a", "b").agg(F.sum(F.col("_wa") * F.col("_wb")).alias("_sum"))
        known = index.select("id").distinct()
        both = (pairs.join(known.withColumnRenamed("id", "a"), "a", "left_semi").join(known.withColumnRenamed("id", "b"), "b", "left_semi"))
        dots = both.join(sums, ["a", "b"], "left").select("a", "b", F.coalesce("_sum", F.lit(0.0)).alias("similarity"))
        return pairs.join(dots, ["a", "b"], "left")
