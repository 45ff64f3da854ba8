"""Byte-level BPE over whole texts by overlapping chunks.

A text is cut into chunks of ``chunk`` characters that each read ``overlap`` characters further. Every chunk
is pre-tokenised by itself. A chunk's starts of matches hold for the text up to the start of its last match
(what follows may be cut, and so may a match that begins in the last three characters), once its first match
starts at a true boundary. Chunk i + 1 begins somewhere, so
its first boundaries may be wrong; where one of them equals a boundary of chunk i inside the overlap, both
agree from there on, and the pieces are stitched at that place. A seam without such a place (a match longer
than the overlap) joins the two chunks and pre-tokenises from the last sure boundary. The pieces between
seams start and end at true boundaries, so each is encoded by itself.

Texts of more than ``spread`` characters send their chunks and then their pieces to different tasks; the
others are cut, stitched and encoded in the task that reads them. Both ways use the same functions.
"""

from __future__ import annotations

import base64
import bisect
import hashlib

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

RANKS = "byte_bpe_50k.tiktoken"
CHUNK, OVERLAP, SPREAD = 16_384, 512, 65_536
#: Characters of the longest alternative of the pattern that is not a run of one class ('ll and the like).
LOOK = 3


class Tokenizer:
    """The vocabulary of a rank file (or a table of ranks) and the pattern that splits text; made once per task."""

    def __init__(self, ranks: str | None = None, pattern: str | None = None, table: dict[bytes, int] | None = None) -> None:
        import public_tokenizers
        import regex
        import tiktoken

        path, pattern = ranks or public_tokenizers.path(RANKS), pattern or public_tokenizers.PATTERN
        if table is None:
            with open(path, "rb") as lines:
                table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        # white space as the rank files' library defines it
        self.split = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.names = [str(i) for i in range(max(table.values()) + 1)]

    def starts(self, text: str, offset: int = 0, cut: bool = False) -> list[int]:
        """The first start of a match and all that do not follow white space; if the text is cut at its end, only
        those that the rest cannot move. A piece that ended with white space would be split in another way."""
        found = [m.start() for m in self.split.finditer(text)]
        # a match looks at most LOOK characters beyond its start or one beyond its end
        last = len(text) - LOOK if cut else len(text)
        return [s + offset for s in found[:1]] + [
            s + offset for before, s in zip(found, found[1:]) if before <= last and not text[s - 1].isspace()]

    def encode(self, piece: str) -> list[int]:
        return self.encoding.encode_ordinary(piece)


def cut(text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[tuple[int, str]]:
    """(offset, characters) of the overlapping chunks; a short text is one chunk."""
    return [(at, text[at:at + chunk + overlap]) for at in range(0, max(len(text), 1), chunk)]


def seam(left: list[int], right: list[int]) -> int | None:
    """First boundary that two neighbouring chunks agree on: not after the left one's last match starts.

    The right chunk's first start is where it was cut, which is a boundary of the text only if the left one
    has it too, and its last match may be cut as well.
    """
    if not left or not right:
        return None
    sure = set(left[bisect.bisect_left(left, right[0]):])
    return next((at for at in right if at in sure), None)


def stitched(chunks: list[tuple[int, int, list[int]]], length: int, resume) -> list[tuple[int, int]]:
    """Pieces (start, end) of the text between seams, from (offset, end, sure starts) of its chunks.

    ``resume(start, end)`` gives the sure starts of a stretch; it is called where a seam has no common boundary.
    """
    at, pieces = 0, []
    _, _, sure = chunks[0]
    for offset, end, starts in chunks[1:]:
        meet = seam(sure, starts)
        if meet is None:
            # boundaries of the joined stretch: from the last sure start to the end of this chunk
            begin = sure[-1] if sure else at
            sure = resume(begin, end)
            continue
        if meet > at:
            pieces.append((at, meet))
            at = meet
        sure = starts[bisect.bisect_left(starts, meet):]
    if at < length:
        pieces.append((at, length))
    return pieces


def pieces_of(text: str, tokenizer: Tokenizer, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[str]:
    """The stitched pieces of one text, all in this task."""
    if len(text) <= chunk:
        return [text] if text else []
    n = len(text)
    found = [(at, at + len(part), tokenizer.starts(part, at, at + len(part) < n)) for at, part in cut(text, chunk, overlap)]
    return [text[a:b] for a, b in stitched(found, n, lambda a, b: tokenizer.starts(text[a:b], a, b < n))]


def digest_row(ids: list[int], tokenizer: Tokenizer) -> tuple[int, str, str]:
    names = tokenizer.names
    return (len(ids), hashlib.sha256(" ".join([names[i] for i in ids]).encode()).hexdigest(),
            hashlib.sha256(tokenizer.encoding.decode_bytes(ids)).hexdigest())


def spread_pieces(long: DataFrame, chunk: int, overlap: int, ranks: str | None) -> DataFrame:
    """(row, n, piece) of long texts: chunks pre-tokenised in parallel, seams found per text, pieces cut again.

    Only boundaries within a chunk's overlaps and its last ones are gathered per text; where a seam fails the
    stretch is pre-tokenised in the task that holds the text.
    """
    def chunks(frames):
        for frame in frames:
            for row, text in zip(frame["row"], frame["text"]):
                parts = cut(text, chunk, overlap)
                yield pd.DataFrame({"row": row, "at": [a for a, _ in parts], "part": [p for _, p in parts], "length": len(text)})

    def split(frames):
        tokenizer = Tokenizer(ranks)
        for frame in frames:
            rows = []
            for row, at, part, length in zip(frame["row"], frame["at"], frame["part"], frame["length"]):
                starts = tokenizer.starts(part, at, at + len(part) < length)
                near = [s for s in starts if s < at + overlap + 1 or s >= at + chunk]
                rows.append((row, at, at + len(part), near or starts[-1:]))
            yield pd.DataFrame(rows, columns=["row", "at", "until", "starts"])

    def stitch(frames):
        tokenizer = Tokenizer(ranks)
        for frame in frames:
            for row, text, found in zip(frame["row"], frame["text"], frame["found"]):
                seams = sorted((int(x["at"]), int(x["until"]), [int(s) for s in x["starts"]]) for x in found)
                parts = stitched(seams, len(text), lambda a, b, t=text: tokenizer.starts(t[a:b], a, b < len(t)))
                yield pd.DataFrame({"row": row, "n": range(len(parts)), "piece": [text[a:b] for a, b in parts]})

    seams = (long.mapInPandas(chunks, "row string, at long, part string, length long").repartition("row", "at")
             .mapInPandas(split, "row string, at long, until long, starts array<long>")
             .groupBy("row").agg(F.collect_list(F.struct("at", "until", "starts")).alias("found")))
    return long.join(common.store(seams, "seams"), "row").select("row", "text", "found").mapInPandas(
        stitch, "row string, n int, piece string")


def encode_texts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", ranks: str | None = None,
                 chunk: int = CHUNK, overlap: int = OVERLAP, spread: int = SPREAD) -> DataFrame:
    """``doc_id`` and ``ids`` (array of token ids) of every row; null text counts as empty. Null and repeated ids are kept."""
    common.prepare(docs.sparkSession)
    return _encoded(docs, id_column, text_column, ranks, chunk, overlap, spread, lambda ids, _: (ids,), "ids array<int>")


def token_digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", ranks: str | None = None,
                  chunk: int = CHUNK, overlap: int = OVERLAP, spread: int = SPREAD) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of every row's encoding and its decoding."""
    common.prepare(docs.sparkSession)
    return _encoded(docs, id_column, text_column, ranks, chunk, overlap, spread, digest_row,
                    "n_tokens long, ids_sha256 string, decoded_sha256 string")


def _encoded(docs, id_column, text_column, ranks, chunk, overlap, spread, finish, schema):
    names = [c.split()[0] for c in schema.split(", ")]
    rows = docs.select(F.col(id_column).cast("string").alias("row"),
                       F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    big = F.char_length("text") > spread

    def whole(frames):
        tokenizer = Tokenizer(ranks)
        for frame in frames:
            out = []
            for row, text in zip(frame["row"], frame["text"]):
                ids = [i for piece in pieces_of(text, tokenizer, chunk, overlap) for i in tokenizer.encode(piece)]
                out.append((row, *finish(ids, tokenizer)))
            yield pd.DataFrame(out, columns=["row", *names])

    def pieces(frames):
        tokenizer = Tokenizer(ranks)
        for frame in frames:
            yield pd.DataFrame({"row": frame["row"].to_list(), "n": frame["n"].to_list(), "ids": [tokenizer.encode(p) for p in frame["piece"]]})

    def together(frames):
        tokenizer = Tokenizer(ranks)
        for frame in frames:
            for row, copies, found in zip(frame["row"], frame["copies"], frame["found"]):
                ids = [int(i) for x in sorted(found, key=lambda x: x["n"]) for i in x["ids"]]
                yield pd.DataFrame([(row, *finish(ids, tokenizer))] * int(copies), columns=["row", *names])

    short = rows.where(~big).mapInPandas(whole, f"row string, {schema}")
    # long rows are stored once; equal rows share a key and are encoded once
    key = F.sha2(F.concat(F.coalesce(F.col("row"), F.lit("-")), F.lit("\n"), "text"), 256)
    long = common.store(rows.where(big).select(F.col("row").alias("doc"), "text", key.alias("row")), "long")
    keys = common.store(long.groupBy("row").agg(F.first("doc").alias("doc"), F.count(F.lit(1)).alias("copies")), "keys")
    once = long.select("row", "text").dropDuplicates(["row"])
    encoded = (spread_pieces(once, chunk, overlap, ranks).repartition("row", "n").mapInPandas(pieces, "row string, n int, ids array<int>")
               .groupBy("row").agg(F.collect_list(F.struct("n", "ids")).alias("found")).join(keys, "row")
               .select("row", "copies", "found").mapInPandas(together, f"row string, {schema}"))
    encoded = encoded.join(keys.select("row", "doc"), "row").select(F.col("doc").alias("row"), *names)
    return short.unionByName(encoded).select(F.col("row").cast("long").alias("doc_id"), *names)
