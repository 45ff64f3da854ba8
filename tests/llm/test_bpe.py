import hashlib
import random

from rosterlake.llm import bpe

BITS = ["a", "Z", "é", " ", "  ", "\n", "\t", "'s", "'ll", "1", "23", "!", "***", "漢", "ß", "\x1c", "don't", "www", "    \n", "\u00a0"]


def texts(seed, n, length):
    rng = random.Random(seed)
    return ["".join(rng.choice(BITS) * rng.choice([1, 1, 1, 2, 9]) for _ in range(rng.randint(0, length))) for _ in range(n)]


def test_stitched_chunks_equal_the_library():
    tokenizer, rng = bpe.Tokenizer(), random.Random(1)
    for text in texts(4, 1500, 100):
        pieces = bpe.pieces_of(text, tokenizer, rng.choice([5, 8, 16, 40]), rng.choice([1, 3, 8, 20]))
        assert "".join(pieces) == text
        assert [i for p in pieces for i in tokenizer.encode(p)] == tokenizer.encoding.encode_ordinary(text)


def test_match_longer_than_every_overlap():
    tokenizer = bpe.Tokenizer()
    for text in ("x" * 300, " " * 300 + "y", "ab " * 5 + "!" * 200 + " end", "\n" * 100):
        assert [i for p in bpe.pieces_of(text, tokenizer, 16, 4) for i in tokenizer.encode(p)] == tokenizer.encoding.encode_ordinary(text)


def test_table_both_ways(frame, odd_rows):
    rows = [*odd_rows, *[(100 + i, t) for i, t in enumerate(texts(9, 30, 60))], (131, "z" * 500), (131, "z" * 500)]
    tokenizer = bpe.Tokenizer()
    want = []
    for i, t in rows:
        ids = tokenizer.encoding.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    for options in ({}, {"spread": 50, "chunk": 20, "overlap": 6}):
        out = bpe.token_digests(frame(rows), **options)
        assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)
    ids = {r["doc_id"]: r["ids"] for r in bpe.encode_texts(frame(rows[:5])).collect()}
    assert ids[1] == ids[2] == [] and tokenizer.encoding.decode(ids[3]) == " \n\t "


def test_empty_table(frame):
    assert bpe.token_digests(frame([])).count() == 0
