"""Steps of the passage search that work on many texts, matches or chains at once give what each alone gives."""

import numpy as np
from pyspark.sql import functions as F

from rosterlake.llm import common, substrings


def test_seeds_of_many_texts_are_those_of_each():
    rng = np.random.default_rng(7)
    for min_words in (3, 20, 50):
        texts = [rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (0, 1, 3, 4, 5, 6, 7, 49, 50, 51, 300, 4, 120)]
        texts += [np.repeat(texts[2][:1], 80), np.tile(texts[10][:7], 30), texts[10].copy()]
        docs = rng.permutation(len(texts)).astype(np.int64) - 3
        parts, runs, whole = substrings.seeds_of(docs, texts, min_words)
        seeds, long = set(), []
        for doc, words in zip(docs.tolist(), texts):
            if len(words) >= substrings.K:
                grams, near = common.windows(words, substrings.K), substrings.contexts(words)
                at = substrings.minimizers(grams, substrings.WINDOW)
                nth = substrings.repeat_numbers(grams[at])
                again = common.mix(grams[at] + nth.astype(np.uint64) * common.GOLDEN)
                seeds |= {(int(v), doc, int(p), int(near[p])) for v, p in zip(grams[at], at)} | {(int(v), doc, int(p), int(near[p])) for v, p in zip(again[nth > 0], at[nth > 0])}
                if len(words) >= min_words:
                    anchors, places, counts, hashes = substrings.anchored(words, min_words)
                    long += [(int(a), doc, int(p), h.tolist()) for a, p, h in zip(anchors, places, np.split(hashes, np.cumsum(counts)[:-1].astype(int)))]
        assert {tuple(row) for p in parts for row in zip(*(c.tolist() for c in p))} == seeds and sum(len(p[0]) for p in parts) == len(seeds)
        got = [(a, d, p, h.tolist()) for r, w in zip(runs, whole) for a, d, p, h in zip(*(c.tolist() for c in r[:3]), np.split(w, np.cumsum(r[3])[:-1].astype(int)))]
        assert sorted(got) == sorted(long)


def test_matches_travel_packed_and_homes_as_stretches(frame, words):
    base = words(1, 400)
    rows = [(i, " ".join(words(10 + i, 30) + base[:120] + words(50 + i, 3000) + base[200:330])) for i in range(1, 9)]
    texts = frame(rows).select("doc_id", "text")
    seeds = substrings.seed_rows(texts, 50)
    chunks, matches = substrings.match_chunks(seeds, 50).collect(), substrings.match_rows(seeds, 50).collect()
    got = [m for r in chunks for m in zip(*(substrings.unpacked(bytes(r[c]), r["size"], kind).tolist() for c, kind in substrings.MATCH))]
    assert sorted(got) == sorted(map(tuple, matches)) and len(chunks) < len(got) / 4
    pairs = common.store(substrings.chain_rows(substrings.match_chunks(seeds, 50)), "pairs")
    stretches = [r for r in pairs.collect() if r.home == 1]
    assert len(stretches) == 7 and all(len(r.firsts) == len(r.lasts) == 2 for r in stretches)
    sent = substrings.span_rows(substrings.word_rows(texts), pairs, substrings.MARGIN, 50, False)
    spans = {r.doc_id: sorted(zip(r.starts, r.ends)) for r in sent.where(F.col("home") == 1).collect()}
    assert len(spans) == 7 and all([(s, e) for s, e in found] == [(30, 150), (3150, 3280)] for found in spans.values())


def test_one_diagonal_is_aligned_like_its_pieces():
    rng = np.random.default_rng(8)
    for size in (14, 60, 200):
        home = rng.integers(0, 1 << 16, size + 20).astype(np.uint16)
        for changes in (0, 1, size // 12, size // 6):
            own = home.copy()
            own[10 + rng.choice(size, changes, replace=False)] ^= 1
            x = np.array([10, 10 + size - 4], np.int32)
            n = np.array([4, 4], np.int32)
            parts, more = substrings.aligned(own, home, 0, x, x, n, 64, 50, (0, 0))
            score = np.where(own[10:10 + size] == home[10:10 + size], 1, -substrings.DIFFERENT)
            place = np.arange(10, 10 + size)
            if changes < size // 6:
                want = [(10 + s, 10 + e) for s, e in substrings.dense_parts(place, place + 1, score, 0) if e - s >= substrings.SHORT]
                assert not more and set(want) <= set(parts) and (changes or parts == [(10, 10 + size)])
