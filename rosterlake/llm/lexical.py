"""Words of the phrase index and of the ranked search, and the blocks in which a table of queries is held by a task.

A word is a longest run of ASCII letters, digits and characters beyond ASCII; only A to Z are folded. In UTF-8 every
byte of a character beyond ASCII is 0x80 or more, so one translation of bytes and one split find the words.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from .common import store

#: Bytes of query text that a task holds at a time; a table with more is searched in several passes.
BLOCK_BYTES = 1 << 21


def fold_table() -> bytes:
    keep = [b >= 0x80 or chr(b).isalnum() for b in range(256)]
    return bytes(ord(chr(b).lower()) if keep[b] and b < 0x80 else b if keep[b] else 0x20 for b in range(256))


FOLD = fold_table()


def words(text: str | None) -> list[bytes]:
    """The folded words of a whole text in order; none for null."""
    return (text or "").encode("utf-8", "replace").translate(FOLD).split()


def query_blocks(items: DataFrame, id_column: str, text_column: str, block_bytes: int = BLOCK_BYTES) -> Iterator[list[Row]]:
    """The rows (``item_id``, ``text``) of a query table, dealt by hash into blocks of about ``block_bytes`` of text.

    Only one block is on the driver and in the tasks at a time, so a larger table takes more passes, not more memory; a
    single text is never cut. Rows without words are left out, equal rows stay.
    """
    rows = items.select(F.col(id_column).alias("item_id"), F.col(text_column).cast("string").alias("text")).where("text is not null")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    blocks = -(-size // block_bytes)
    if blocks > 1:
        rows = store(rows.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))), "items")
    for block in range(blocks):
        found = [r for r in (rows.where(F.col("block") == block) if blocks > 1 else rows).collect() if words(r["text"])]
        if found:
            yield sorted(found, key=lambda r: (r["item_id"] is not None, r["item_id"], r["text"]))
