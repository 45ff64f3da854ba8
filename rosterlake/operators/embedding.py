"""Text vectors. The encoder is a plug-in: a function from (text) to (text, vector).

Every distinct text is encoded once and joined back by its digest: the digest is the key of
every exchange, and a text shared by many rows is not encoded again. Similarities that need no
vectors are in ``tfidf``, those of texts and lists in ``terms``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import store

Encoder = Callable[[DataFrame], DataFrame]


def lookup_encoder(table: DataFrame, text: str = "text", vector: str = "vector") -> Encoder:
    """Vectors from a given table."""
    known = table.select(F.col(text).alias("text"), F.col(vector).cast("array<float>").alias("vector"))
    return lambda texts: texts.join(known, "text", "left")


def udf_encoder(encode: Callable[[Column], Column]) -> Encoder:
    """Vectors from a user's pandas or Arrow UDF (a sentence model, for instance)."""
    return lambda texts: texts.withColumn("vector", encode(F.col("text")).cast("array<float>"))


def _digest(c: Column) -> Column:
    return F.sha2(c, 256)


def _encoded(texts: DataFrame, encode: Encoder) -> DataFrame:
    """Distinct texts -> (digest, vector).

    Texts are grouped by their digest, and the distinct ones stored, because an encoder may read
    them twice (fit and transform).
    """
    known = texts.where("text IS NOT NULL").groupBy(_digest(F.col("text")).alias("_digest")).agg(F.max("text").alias("text"))
    return encode(store(known.select("text"), "texts")).select(_digest(F.col("text")).alias("_digest"), "vector")


def encode_column(df: DataFrame, text: str, output: str, encode: Encoder) -> DataFrame:
    """Add the vector of a text column."""
    encoded = _encoded(df.select(F.col(text).alias("text")), encode).withColumnRenamed("vector", output)
    return (df.withColumn("_digest", _digest(F.col(text)))
            .join(encoded, "_digest", "left").drop("_digest"))


def encode_lists(entities: DataFrame, key: str, columns: dict[str, str], encode: Encoder) -> DataFrame:
    """Add list-of-vector columns for list-of-text columns of a table with a unique key.

    Empty strings are left out. Meant for jobs, candidates or requests before they are joined into
    pairs, so the work grows with the entities. A row is regrouped only from its own lists. The
    table is read twice; give a stored one if it is costly to compute.
    """
    def tagged(name: str) -> Column:
        texts = F.coalesce(F.col(name), F.array().cast("array<string>"))
        return F.transform(texts, lambda x: F.struct(F.lit(name).alias("source"), x.alias("text")))

    everything = F.flatten(F.array(*[tagged(c) for c in columns]))
    items = (entities.select(F.col(key).alias("_key"), F.explode(everything).alias("_item"))
             .select("_key", "_item.source", "_item.text").where("text <> ''"))
    encoded = _encoded(items.select("text"), encode)
    gathered = (items.withColumn("_digest", _digest(F.col("text"))).join(encoded, "_digest")
                .where("vector IS NOT NULL")
                .groupBy("_key").agg(*[
                    F.collect_list(F.when(F.col("source") == c, F.col("vector"))).alias(output)
                    for c, output in columns.items()]))
    empty = F.array().cast("array<array<float>>")
    joined = entities.join(gathered, F.col(key) == F.col("_key"), "left").drop("_key")
    return joined.withColumns({o: F.coalesce(F.col(o), empty) for o in columns.values()})
