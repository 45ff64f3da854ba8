"""Long windows travel in runs by anchor: the same windows meet as if each were a seed of its own, in less room."""

import numpy as np
import pytest

from rosterlake.llm import common, substrings


def words_of(rng, size):
    return rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2)


@pytest.mark.parametrize("min_words", [1, 5, 32, 50])
def test_shared_windows_are_those_of_two_documents(min_words):
    rng = np.random.default_rng(3)
    texts = [words_of(rng, n) for n in (50, 51, 400, 90, 300)]
    texts += [np.concatenate([texts[3][:20], texts[2][40:140], texts[4][:60]]), texts[0].copy(), np.repeat(texts[1][:1], 200), np.repeat(texts[1][:1], 120)]
    parts = [(doc, *substrings.anchored(t, min_words)) for doc, t in enumerate(texts)]
    anchors, places, counts, hashes = (np.concatenate([p[i] for p in parts]) for i in range(1, 5))
    docs = np.repeat([p[0] for p in parts], [len(p[1]) for p in parts])
    assert counts.sum() == sum(len(t) - min_words + 1 for t in texts)
    order = rng.permutation(len(docs))  # runs in any order, their windows with them
    at = common.spread((np.cumsum(counts.astype(np.int64)) - counts.astype(np.int64))[order], counts[order].astype(np.int64))
    values, found, where = substrings.shared_windows((anchors[order] >> np.uint64(20)).astype(np.uint32), docs[order], places[order],
                                                     counts[order].astype(np.int64), hashes[at])
    got = {}
    for value, doc, place in zip(values.tolist(), found.tolist(), where.tolist()):
        got.setdefault(value, set()).add((doc, place))
    plain = {}
    for doc, t in enumerate(texts):
        for place in range(len(t) - min_words + 1):
            plain.setdefault(t[place:place + min_words].tobytes(), set()).add((doc, place))
    several = lambda groups: sorted(sorted(g) for g in groups.values() if len({d for d, _ in g}) > 1)
    assert several(got) == several(plain) and several(plain)


def test_runs_take_less_room_than_windows():
    rng = np.random.default_rng(4)
    runs, whole, single = [], [], []
    for doc in range(300):
        words = words_of(rng, 400)
        anchors, at, counts, hashes = substrings.anchored(words, 50)
        runs.append((anchors, np.full(len(at), doc, np.int64), at, counts))
        whole.append(hashes)
        grams = common.windows(words, 50)
        single.append((grams, np.full(len(grams), doc, np.int64), np.arange(len(grams), dtype=np.int32), np.zeros(len(grams), np.uint32)))
    bytes_of = lambda rows: sum(rows[c].map(len).sum() for c in ("seed", "doc_id", "pos", "near", "whole"))
    assert bytes_of(substrings.chunk_rows(runs, whole)) < 0.8 * bytes_of(substrings.chunk_rows(single))
    buckets = substrings.chunk_rows(runs, whole).set_index("bucket")["size"]
    assert buckets.max() <= 24  # 11,000 runs in 4096 buckets, dealt evenly


def test_windows_by_doubling():
    words = words_of(np.random.default_rng(5), 120)
    for size in (1, 2, 3, 4, 5, 8, 10, 31, 50, 64, 119, 120, 500):
        total = np.full(max(1, 121 - min(size, 120)), min(size, 120), np.uint64)
        for i in range(min(size, 120)):
            total = total * common.GOLDEN + words[i:i + len(total)]
        assert (common.windows(words, size) == common.mix(total)).all()
    assert not len(common.windows(words[:0], 4))


def test_ends_of_all_chains_at_once():
    rng = np.random.default_rng(6)
    owns = [rng.integers(0, 3, n).astype(np.uint16) for n in (30, 200, 500)]
    chains_ = []
    for i in range(300):
        own = i % 3
        there = np.concatenate([owns[own][5:], rng.integers(0, 3, 40).astype(np.uint16)]) if i % 2 else rng.integers(0, 3, 90).astype(np.uint16)
        size, most = int(rng.integers(1, 8)), min(len(owns[own]), len(there)) - 10
        x = int(rng.integers(0, most))
        y = max(0, x - 5) if i % 2 else int(rng.integers(0, most))
        runs = [[x], [y], [size]] if i % 5 else [[x, x + size + 1], [y, y + size + 1], [size, 1]]
        chains_.append((own, there, 7, *(np.array(v, np.int32) + (7 if k == 1 else 0) for k, v in enumerate(runs))))
    kinds = set()
    for margin in (16, 64):
        for chain, (before, after, drop, more) in zip(chains_, substrings.chain_ends(owns, chains_, margin, 50)):
            own, there, first, *runs = chain
            want = substrings.aligned(owns[own], there, first, *runs, margin, 50)
            assert want == (substrings.aligned(owns[own], there, first, *runs, margin, 50, (before, after)) if not (drop or more) else ([], more))
            kinds.add((drop, more))
    assert len(kinds) == 3


def test_neighbouring_long_windows_are_one_match(frame):
    text = " ".join(f"w{i}" for i in range(400))
    texts = frame([(1, text), (2, "x " + text)]).select("doc_id", "text")
    got = [r for r in substrings.match_rows(substrings.seed_rows(texts, 50), 50).collect() if r.n >= 50]
    assert len(got) < 351 / 4 and {(r.doc_id, r.home, r.pos - r.home_pos) for r in got} == {(2, 1, 1)}
    assert {p for r in got for p in range(r.home_pos, r.home_pos + r.n)} == set(range(400))


def test_words_are_stored_once_and_cut_into_blocks(frame):
    words = substrings.word_rows(frame([(1, " ".join(f"w{i}" for i in range(150))), (2, ""), (3, None), (4, " ".join("abcd" * 16))]).select("doc_id", "text"))
    whole = {r.doc_id: bytes(r.words) for r in words.collect()}
    blocks = {(r.home, r.block): bytes(r.words) for r in substrings.block_rows(words).collect()}
    size = 2 * substrings.BLOCK
    assert {k: len(v) for k, v in whole.items()} == {1: 300, 4: 128}
    assert blocks == {(d, i): w[i * size:(i + 1) * size] for d, w in whole.items() for i in range(-(-len(w) // size))}
