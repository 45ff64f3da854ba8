import random

import numpy as np
import pandas as pd
from rosterlake.llm import common


def test_word_hashes_split_like_the_contract():
    text = "a b  c\x0bd\x1ce\n\nf"
    assert len(common.word_hashes(text)) == 4 and len(common.word_hashes(None)) == len(common.word_hashes(" \n")) == 0


def test_word_hashes_of_slices(monkeypatch):
    text = " ".join("w" * (i % 9 + 1) + str(i) for i in range(500))
    whole = common.word_hashes(text)
    monkeypatch.setattr(common, "SLICE", 37)
    assert (common.word_hashes(text) == whole).all()


def test_whole_groups_keep_groups_together():
    rng = np.random.default_rng(1)
    keys = np.sort(rng.integers(0, 40, 300))
    frame = pd.DataFrame({"k": keys, "v": range(300)})
    for step in (1, 3, 50, 400):
        parts = list(common.whole_groups((frame.iloc[s:s + step] for s in range(0, 300, step)), ["k"]))
        assert pd.concat(parts, ignore_index=True).equals(frame)
        assert sum(p["k"].nunique() for p in parts) == frame["k"].nunique()


def union_find(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def test_components_of_paths_stars_and_random_links(spark):
    common.prepare(spark)
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(300, 300 + i) for i in range(1, 50)]
    edges += [(rng.randint(1000, 1100), rng.randint(1000, 1100)) for _ in range(70)] + [(5, 5)]
    found = common.components(spark.createDataFrame(edges, "a long, b long"))
    assert {r["node"]: r["component"] for r in found.collect()} == union_find([e for e in edges if e[0] != e[1]])
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_smallest_roots():
    left, right = np.array([5, 4, 1, 7]), np.array([4, 2, 3, 8])
    assert common.smallest_roots(9, left, right).tolist() == [0, 1, 2, 1, 2, 2, 6, 7, 7]


def test_block_pairs_meet_once(spark):
    common.prepare(spark)
    rows = spark.createDataFrame([(n, i) for n, size in ((1, 23), (2, 3), (3, 1)) for i in range(size)], "node long, rep long")
    dealt = common.block_pairs(rows, common.node_sizes(rows, "node"), "node", "rep", 5).collect()
    met = {}
    for r in dealt:
        met.setdefault((r["node"], r["low"], r["high"]), []).append((r["rep"], r["part"]))
    pairs = []
    for (node, low, high), some in met.items():
        pairs += [(node, a, b) for a, p in some for b, q in some if a < b and (low == high or p != q)]
    assert sorted(pairs) == sorted((n, a, b) for n, size in ((1, 23), (2, 3)) for a in range(size) for b in range(a + 1, size))
