import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from rosterlake.llm import lexical, ranked

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def split(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]


def brute(docs, items, k):
    texts = [(key, Counter(split(t)), len(split(t))) for key, t in docs if split(t)]
    count, total = len(texts), sum(n for _, _, n in texts)
    out = []
    for item, t in items:
        scores = []
        for key, tf, n in texts:
            m = 50 + (50 * n * count) // total
            score = 0
            for term in set(split(t)):
                df = sum(term in other for _, other, _ in texts)
                if tf[term]:
                    score += math.floor(1000 * math.log((2 * count + 2) / (2 * df + 1))) * ((10**9 * tf[term]) // (1000 * tf[term] + 20 * m))
            if score > 0:
                scores.append((-score, key is None, key or 0, key))
        out += [(item, rank, key, -s) for rank, (s, _, _, key) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def made(request):
    rng = random.Random(2)
    vocabulary = ["w%d" % i for i in range(60)] + ["Über", "漢", "A", "b2"]
    line = lambda n: " ".join(rng.choice(vocabulary[:rng.choice([3, 20, 64])]) for _ in range(n))
    docs = [(i, line(rng.randint(0, 30))) for i in range(300)] + [(400 + i, "w1 w2 w2") for i in range(40)]
    docs += [(None, "w1 w2 w2"), (None, None), (500, None), (501, "..."), (7, "w1 second row of an id"), (502, "w3 " * 20_000)]
    items = [(i, line(rng.randint(1, 12))) for i in range(9)] + [(3, "w1 w1 W2"), (3, "w1 w1 W2"), (20, None), (21, "?"), (22, "absent"), (None, "w5")]
    return docs, items


@pytest.mark.parametrize("options", [{}, {"k": 3}, {"block_bytes": 100}])
def test_equals_brute_force(spark, frame, made, options):
    docs, items = made
    got = ranked.ranked_search(frame(docs), spark.createDataFrame(items, "item_id long, text string"), **options)
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items, options.get("k", 50))


def test_many_tiles():
    rng = np.random.default_rng(3)
    terms_of = [np.unique(rng.integers(0, 9000, 40)) for _ in range(5)] + [np.arange(9000)]
    tile = ranked.Tile(0, terms_of, 9000)
    slices = [tile.slice(s) for s in range(0, tile.width, ranked.VOCABULARY)]
    assert len(slices) > 3
    terms, docs = rng.permutation(9000)[:4000], np.sort(rng.integers(0, 7, 4000))
    impact = rng.integers(0, 2**34, 4000).astype(float)
    want = [[int(sum(int(v) for v, t, d in zip(impact, terms, docs) if d == doc and t in set(own.tolist()))) for doc in range(7)] for own in terms_of]
    assert tile.scores(slices, terms, docs, impact, 7).tolist() == want


def test_ties_and_empty_tables(spark, frame):
    items = spark.createDataFrame([(1, "x y")], "item_id long, text string")
    rows = [(i, "x z") for i in range(900, 100, -1)] + [(5000 + i, "q") for i in range(900)]
    got = ranked.ranked_search(frame(rows), items).orderBy("rank").collect()
    assert [r["doc_id"] for r in got] == list(range(101, 151)) and len({r["score"] for r in got}) == 1
    assert ranked.ranked_search(frame([]), items).count() == 0
    assert ranked.ranked_search(frame(rows[:5]), items.limit(0)).count() == 0


def test_words_equal_the_pattern(odd_rows):
    for _, text in odd_rows + [(0, "Ärger_x[A]{b}`c`@D^e\\f~g\x7fh é😀 1a")]:
        assert [w.decode() for w in lexical.words(text)] == split(text)
