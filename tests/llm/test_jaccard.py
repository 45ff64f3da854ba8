import random

import pytest
from rosterlake.llm import jaccard


def shingles(text):
    w = (text or "").encode().split()
    return {tuple(w[i:i + min(5, len(w))]) for i in range(max(len(w) - 4, 1))} if w else set()


def brute(rows, threshold=0.8):
    sets = [shingles(t) for _, t in rows]
    n = len(rows)
    links, root = [0] * n, list(range(n))
    for a in range(n):
        for b in range(a + 1, n):
            if sets[a] and sets[b] and rows[a][0] is not None and rows[b][0] is not None:
                shared = len(sets[a] & sets[b])
                if shared >= threshold * (len(sets[a]) + len(sets[b]) - shared):
                    links[a] += 1
                    links[b] += 1
                    old, new = root[b], root[a]
                    root = [new if r == old else r for r in root]
    least = {r: min((rows[i][0] for i in range(n) if root[i] == r and rows[i][0] is not None), default=None) for r in set(root)}
    return sorted(((rows[i][0], links[i], least[root[i]]) for i in range(n)), key=str)


def result(df):
    return sorted(((r["doc_id"], r["n_links"], r["class_id"]) for r in df.collect()), key=str)


def varied(words, seed, n_docs=120):
    rng = random.Random(seed)
    rows = []
    bases = [words(s, rng.randint(6, 120)) for s in range(12)]
    common_passage = words(77, 40)
    for i in range(n_docs):
        w = list(rng.choice(bases))
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = rng.choice(words(i, 3))
        if rng.random() < 0.3:
            w = w + common_passage
        rows.append((i * 10, " ".join(w)))
    return rows


@pytest.mark.parametrize("options", [{}, {"leaf": 4, "block": 8, "exact_block": 5}])
def test_equals_brute_force(frame, words, options):
    rows = varied(words, 1)
    assert result(jaccard.jaccard_join(frame(rows), **options)) == brute(rows)


def test_odd_rows(frame, odd_rows):
    assert result(jaccard.jaccard_join(frame(odd_rows))) == brute(odd_rows)
    kept = jaccard.drop_near_copies(frame(odd_rows))
    assert kept.columns == frame([]).columns
    stay = [i for i, _ in odd_rows if i != 5]
    stay.remove(6)  # of two equal rows one stays
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, stay))


def test_repeated_ids_are_documents_of_their_own(frame, words):
    a, b = " ".join(words(1, 60)), " ".join(words(2, 60))
    rows = [(5, a), (5, b), (5, b), (6, a + " more"), (7, b), (3, b + " x"), (8, "unlike")]
    assert result(jaccard.jaccard_join(frame(rows))) == brute(rows)


def test_empty_table(frame):
    assert jaccard.jaccard_join(frame([])).count() == 0 and jaccard.drop_near_copies(frame([])).count() == 0


def test_number_of_searches():
    assert jaccard.searches(0.8, 0.99, 1) == 5 and jaccard.searches(0.8, 0.99, 4) == 13


def test_rows_of_one_id_are_documents_of_their_own(frame, words):
    one, two, three = (" ".join(words(i, 60)) for i in (1, 2, 3))
    rows = [(5, one), (5, one), (5, one), (7, one), (7, two), (8, two + " more"), (9, three), (None, one), (None, one)]
    kept = jaccard.drop_near_copies(frame(rows)).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept) == sorted([("5", one), ("7", two), ("9", three), ("None", one), ("None", one)])
