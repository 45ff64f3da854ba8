import hashlib
import random
import re

import pytest
from rosterlake.llm import phrases

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, size=10):
    out = []
    for key, text in docs:
        w, hit, found = split(text), set(), set()
        for item, t in items:
            v = split(t)
            n = min(size, len(v))
            for a in range(len(v) - n + 1 if n else 0):
                for b in range(len(w) - n + 1):
                    if w[b:b + n] == v[a:a + n]:
                        hit |= set(range(b, b + n))
                        found |= {str(item)} if item is not None else set()
        out.append((key, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def near(docs, items, size, within):
    """(doc, start, end, items) of the shortest stretches by plain loops."""
    windows, out = {}, []
    for item, t in items:
        v = split(t)
        n = min(size, len(v))
        for a in range(len(v) - n + 1 if n else 0):
            windows.setdefault(tuple(v[a:a + n]), set()).add(str(item))
    for key, text in docs:
        w = split(text)
        for window, ids in windows.items():
            for s in range(len(w)):
                if w[s] in window:
                    ends = [e for e in range(s + 1, min(s + within, len(w)) + 1) if set(window) <= set(w[s:e])]
                    if ends:
                        out.append((key, s, ends[0], tuple(sorted(ids))))
    return sorted(out)


@pytest.fixture(scope="module")
def made():
    rng = random.Random(4)
    word = lambda: rng.choice(["a", "B", "cé", "d1", "E漢", "f", "gg"])
    line = lambda n: "".join(word() + rng.choice([" ", ", ", "\n", "--"]) for _ in range(n))
    items = [(i, line(rng.randint(1, 14))) for i in range(12)] + [(7, "a b"), (30, "The quick  BROWN fox"), (31, None), (32, " .,"), (None, "zeta eta theta")]
    docs = [(i, line(rng.randint(0, 60))) for i in range(60)]
    docs += [(100 + i, line(5) + (t or "") + " end " + line(3)) for i, (_, t) in enumerate(items)]
    docs += [(200, "the quick brown"), (201, "fox quick the brown fox"), (202, "THE QUICK brown_fox"), (None, "the quick brown fox"), (203, None), (203, "the quick brown fox"), (204, "")]
    return docs, items


@pytest.mark.parametrize("options", [{}, {"block_bytes": 60}])
def test_equals_brute_force(spark, frame, made, options):
    docs, items = made
    index = phrases.build_index(frame(docs), shard_words=100)
    table = spark.createDataFrame(items, "item_id long, text string")
    for size in (10, 3):
        got = phrases.contamination(index, table, size, **options)
        assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items, size)


def test_proximity_equals_brute_force(spark, frame, made):
    docs, items = made
    docs, items = [d for d in docs if d[0] not in (None, 203)], [i for i in items if i[0] is not None]
    found = phrases.matches(phrases.build_index(frame(docs), shard_words=150), spark.createDataFrame(items, "item_id long, text string"), 4, within=6).collect()
    got = sorted((r["doc_id"], r["start"], r["end"], tuple(r["items"])) for r in found if r["kind"] == "near")
    assert got == near(docs, items, 4, 6)
    exact = {(r["doc_id"], r["start"], r["end"]) for r in found if r["kind"] == "phrase"}
    assert exact and (201, 0, 3) not in exact


def test_odd_rows_and_empty_tables(spark, frame, odd_rows):
    items = spark.createDataFrame([(1, "same row here"), (2, odd_rows[5][1][:400])], "item_id long, text string")
    got = phrases.decontaminate(frame(odd_rows), items)
    assert got.count() == len(odd_rows) and got.where("contaminated").count() == 4
    assert phrases.decontaminate(frame([]), items).count() == 0
    assert phrases.decontaminate(frame(odd_rows), items.limit(0)).where("contaminated or n_items > 0").count() == 0


def test_common_word_lists_do_not_explode(spark, frame):
    docs = [(i, "of the " * 5000) for i in range(4)]
    got = phrases.decontaminate(frame(docs), spark.createDataFrame([(5, "the of " * 30)], "item_id long, text string")).collect()
    assert [(r["n_words"], r["n_hit"], r["n_items"]) for r in got] == [(10_000, 10_000, 1)] * 4
