"""Alignment of two tokenizers' tokens over the same bytes.

Both tokenizers encode a text; the lengths of their tokens in bytes add up to cumulative ends. A dictionary from end to
index per side and the intersection of their keys give the byte offsets where both sides end a token; the sorted common
offsets slice both id lists into groups that cover the same bytes. Inside a slice every pair of tokens whose bytes
overlap is a link. Links are kept as distinct id pairs with their number per document.

The counts of id pairs over the corpus come from one grouped aggregation. To give the counts back to the documents, the
``FREQUENT`` most counted pairs (a fixed number, so a bounded table, and every pair that could be a hot key) are
broadcast; the links of all other pairs are joined by a shuffle. Both parts are summed per document.
"""

from __future__ import annotations

import hashlib
import json
import os

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import prepare, spread, store

BYTE_TOKENS, PIECE_TOKENS = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Pairs whose counts are broadcast; the others are joined.
FREQUENT = 1 << 19
#: Characters of a text that go to a library in one piece where they can be split.
CHUNK = 1 << 17
#: Texts that are encoded in one call of a library.
CALL = 64

ALIGNED = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>")


def byte_alphabet() -> dict[str, int]:
    """Character of a byte-level vocabulary -> byte: printable bytes stand for themselves, the others follow from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteTokens:
    """The byte-level vocabulary; made once per task. Special tokens in a text are ordinary text.

    Where the ids of a file follow the order of its merges, merging by rank gives the same tokens as its list of merges,
    and the faster library for rank files encodes; other files take their own library.
    """

    def __init__(self, path: str | None = None, pattern: str | None = None) -> None:
        import public_tokenizers

        path = path or public_tokenizers.path(BYTE_TOKENS)
        alphabet = byte_alphabet()
        with open(path, encoding="utf-8") as lines:
            file = json.load(lines)
        self.bytes = [b""] * (1 + max([*file["model"]["vocab"].values(), *(t["id"] for t in file["added_tokens"])]))
        for name, i in file["model"]["vocab"].items():
            self.bytes[i] = bytes(alphabet[c] for c in name) if all(c in alphabet for c in name) else name.encode()
        for token in file["added_tokens"]:
            self.bytes[token["id"]] = token["content"].encode()
        self.ranked = None
        if in_merge_order(file):
            special = {t["id"] for t in file["added_tokens"]}
            self.ranked = bpe.Tokenizer(pattern=pattern, table={b: i for i, b in enumerate(self.bytes) if b and i not in special})
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer
            self.model = Tokenizer.from_file(path)
            self.model.encode_special_tokens = True

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.ranked is None:
            return [np.array(e.ids, np.int64) for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]
        to_numpy = self.ranked.encoding.encode_to_numpy
        return [np.concatenate([to_numpy(p, disallowed_special=()) for p in bpe.pieces_of(t, self.ranked, CHUNK)]).astype(np.int64) for t in texts]


def in_merge_order(file: dict) -> bool:
    """Whether merging the pair of smallest id is what the file's list of merges says, with the usual split and nothing before it."""
    model, first = file["model"], file["pre_tokenizer"]
    vocabulary = model["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    base = len(vocabulary) - len(merges) - sum(t["content"] in vocabulary for t in file["added_tokens"])
    plain = file.get("normalizer") is None and not model.get("dropout") and not model.get("ignore_merges")
    usual = first is not None and first["type"] == "ByteLevel" and not first["add_prefix_space"] and first.get("use_regex", True)
    return plain and usual and base == 256 and all(vocabulary.get(a + b) == base + i for i, (a, b) in enumerate(merges))


class PieceTokens:
    """The piece vocabulary with byte fallback; made once per task. It puts a space before the text itself."""

    def __init__(self, path: str | None = None) -> None:
        import public_tokenizers
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path(PIECE_TOKENS))
        self.bytes = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode())

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def end_index(ends: np.ndarray, size: int) -> np.ndarray:
    """The dictionary from cumulative byte end to index (from 1 on; the last of equal ends), as a table over all bytes; 0 is no end."""
    index = np.zeros(size + 1, np.int64)
    if (ends[1:] > ends[:-1]).all():
        index[ends] = np.arange(1, len(ends) + 1)
    else:
        np.maximum.at(index, ends, np.arange(1, len(ends) + 1))
    return index


def common_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exclusive ends, as indexes of both id lists, of the groups that two lists of cumulative byte ends share."""
    ends = [np.asarray(e, np.int64) for e in (ends_a, ends_b)]
    size = max((int(e[-1]) for e in ends if len(e)), default=0)
    index_a, index_b = (end_index(e, size) for e in ends)
    shared = np.flatnonzero((index_a > 0) & (index_b > 0))
    return index_a[shared], index_b[shared]


def slice_links(ends_a: np.ndarray, ends_b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of overlapping tokens, slice by slice.

    A slice of a and b tokens without a common end inside has a + b - 1 stretches between ends, and each stretch is the
    overlap of one pair, so the links of a slice are its A index and its B index at every one of its ends. In a slice of
    one token on a side that token meets all others; only the rest look at the ends.
    """
    size_a, size_b = np.diff(cuts_a, prepend=0), np.diff(cuts_b, prepend=0)
    count = size_a + size_b - 1
    first = np.cumsum(count) - count
    left, right = np.repeat(cuts_a - size_a, count), np.repeat(cuts_b - size_b, count)
    for size, links in ((size_a, left), (size_b, right)):
        long = np.flatnonzero(size > 1)
        links[spread(first[long], count[long])] += spread(np.zeros(len(long), np.int64), count[long])
    mixed = np.flatnonzero((size_a > 1) & (size_b > 1))
    if len(mixed):
        ends = np.union1d(ends_a[spread((cuts_a - size_a)[mixed], size_a[mixed])], ends_b[spread((cuts_b - size_b)[mixed], size_b[mixed])])
        rows = spread(first[mixed], count[mixed])
        left[rows], right[rows] = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
    return left, right


class Aligner:
    """Aligns texts by two tokenizers; holds their tables."""

    def __init__(self, byte_path: str | None = None, piece_path: str | None = None) -> None:
        self.a, self.b = ByteTokens(byte_path), PieceTokens(piece_path)
        self.lengths = [np.array([len(x) for x in t.bytes], np.int64) for t in (self.a, self.b)]
        # decimal ids with the sign behind them: inside a group's side, then at its end
        self.names = [np.array([f"{i}," for i in range(len(t.bytes))] + [f"{i}{end}" for i in range(len(t.bytes))], object)
                      for t, end in ((self.a, "|"), (self.b, ";"))]

    def tokens(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of both sides per text; None for an empty text and one that a side does not give back byte by byte."""
        found = []
        for text, a, b in zip(texts, self.a.encode([" " + t for t in texts]), self.b.encode(texts)):
            whole = (" " + text).encode("utf-8", "replace")
            same = text and all(b"".join(map(t.bytes.__getitem__, ids)) == whole for t, ids in ((self.a, a.tolist()), (self.b, b)))
            found.append((a, np.array(b, np.int64)) if same else None)
        return found

    def align(self, texts: list[str]) -> list[tuple]:
        """Per text: n_a, n_b, n_groups, n_links, digest of the groups, distinct id pairs (a * size of B + b), their numbers.

        The texts are taken as one stream, in which the end of a text is the end of a group.
        """
        out = [(0, 0, 0, 0, "", [], [])] * len(texts)
        found = self.tokens(texts)
        filled = [i for i, x in enumerate(found) if x is not None]
        if not filled:
            return out
        ids = [np.concatenate([found[i][side] for i in filled]) for side in (0, 1)]
        ends = [np.cumsum(length[x]) for length, x in zip(self.lengths, ids)]
        sizes = [np.cumsum([0] + [len(found[i][side]) for i in filled]) for side in (0, 1)]
        cuts: tuple[list, list] = ([], [])
        for k in range(len(filled)):  # a dictionary per text stays small
            base = ends[0][sizes[0][k] - 1] if k else 0  # both sides give back the same bytes
            one = common_ends(*(e[s[k]:s[k + 1]] - base for e, s in zip(ends, sizes)))
            for side in (0, 1):
                cuts[side].append(one[side] + sizes[side][k])
        groups = np.cumsum([0] + [len(c) for c in cuts[0]])
        cut_a, cut_b = np.concatenate(cuts[0]), np.concatenate(cuts[1])
        left, right = slice_links(*ends, cut_a, cut_b)
        links = np.cumsum([0] + [int(x) for x in np.diff(sizes[0]) + np.diff(sizes[1]) - np.diff(groups)])
        names = np.empty(len(ids[0]) + len(ids[1]), object)
        for side, mine, other in ((0, cut_a, cut_b), (1, cut_b, cut_a)):
            last = np.zeros(len(ids[side]), np.int64)
            last[mine - 1] = len(self.lengths[side])
            before = np.concatenate([[0], other[:-1]]) if side == 0 else other
            names[np.arange(len(last)) + np.repeat(before, np.diff(mine, prepend=0))] = self.names[side][ids[side] + last]
        pairs = ids[0][left] * len(self.b.bytes) + ids[1][right]
        for k, i in enumerate(filled):
            text = "".join(names[sizes[0][k] + sizes[1][k]:sizes[0][k + 1] + sizes[1][k + 1]].tolist())[:-1]
            distinct, times = np.unique(pairs[links[k]:links[k + 1]], return_counts=True)
            out[i] = (len(found[i][0]), len(found[i][1]), int(groups[k + 1] - groups[k]), int(links[k + 1] - links[k]),
                      hashlib.sha256(text.encode()).hexdigest(), distinct, times)
        return out


def aligned(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", byte_path: str | None = None,
            piece_path: str | None = None) -> DataFrame:
    """One row per document (``ALIGNED``): figures, digest of the groups, and its distinct id pairs with their numbers.

    ``row`` is a key of its own for every row, also where ids are null or repeated; write the table before joining by
    it. A text that is null, empty, or that a tokenizer does not give back byte by byte has no tokens.
    """
    prepare(docs.sparkSession)

    def align(frames):
        aligner = Aligner(byte_path, piece_path)
        key = TaskContext.get().partitionId() << 33
        for frame in frames:
            texts = [t or "" for t in frame["text"]]
            for at in range(0, len(texts), CALL):
                out = pd.DataFrame(aligner.align(texts[at:at + CALL]), columns=["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])
                out.insert(0, "doc_id", pd.array([None if pd.isna(i) else int(i) for i in frame["doc_id"][at:at + CALL]], "Int64"))
                out.insert(0, "row", np.arange(key, key + len(out)))
                key += len(out)
                yield out

    rows = docs.select(F.col(id_column).cast("string").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInPandas(align, ALIGNED)


def pair_counts(rows: DataFrame, size_b: int) -> DataFrame:
    """``pair``, ``count`` over the corpus and ``best``: whether no other A id is linked more often with the pair's B id."""
    links = rows.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).select(F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    counts = store(links.groupBy("pair").agg(F.sum("times").alias("count")).withColumn("b", F.pmod("pair", F.lit(size_b))), "pairs")
    # one row per B id: bounded by the vocabulary
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    return store(counts.join(F.broadcast(most), "b").select("pair", "count", (F.col("count") == F.col("most")).cast("long").alias("best")), "counts")


def with_counts(rows: DataFrame, counts: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """``row``, ``n_best`` and ``count_sum`` of every document that has links."""
    links = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select(
        "row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    common = store(counts.orderBy(F.desc("count"), "pair").limit(frequent), "frequent")
    sums = [F.sum(F.col("times") * F.col("best")).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum")]
    part = links.join(F.broadcast(common), "pair").groupBy("row").agg(*sums)
    if counts.count() > frequent:
        others = links.join(F.broadcast(common.select("pair")), "pair", "left_anti")
        rest = counts.join(F.broadcast(common.select("pair")), "pair", "left_anti")
        joined = others.join(rest, "pair").groupBy("row").agg(*sums)
        part = part.unionByName(joined).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return part


def token_alignment(docs: DataFrame, frequent: int = FREQUENT, **options) -> DataFrame:
    """One row per document: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``.

    ``n_best`` counts the links whose id pair is the most frequent of its B id in the corpus, ties included,
    ``count_sum`` adds up the corpus counts of the document's links. Documents without tokens have zeros and ''.
    """
    rows = store(aligned(docs, **options), "aligned")
    size_b = len(PieceTokens(options.get("piece_path")).bytes)
    found = with_counts(rows, pair_counts(rows, size_b), frequent)
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return rows.drop("pairs", "times").join(found, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
