import random

import numpy as np
from rosterlake.llm import common, substrings


def spans(df):
    return {r["doc_id"]: list(zip(r["starts"], r["ends"], r["homes"])) for r in df.collect()}


def test_every_exact_passage_is_found(frame, words):
    rng = random.Random(5)
    shared = [words(900 + i, 60) for i in range(4)]
    rows = []
    for i in range(60):
        w = words(i, rng.randint(20, 200))
        at = rng.randrange(len(w))
        rows.append((i, w[:at] + (shared[i % 8] if i % 8 < 4 else []) + w[at:], at))
    found = spans(substrings.repeated_passages(frame([(i, " ".join(w)) for i, w, _ in rows])))
    for i, w, at in rows:
        if i % 8 < 4 and i >= 8:
            (s, e, home), = found[i]
            assert s <= at and at + 60 <= e <= at + 62 and home == i % 8
        else:
            assert found[i] == []


def test_fuzzy_passages_and_clean_texts(frame, words):
    base = words(1, 120)
    fuzzy = list(base)
    for at in (20, 45, 70, 95):
        fuzzy[at] = "changed"
    del fuzzy[60]
    rows = [(1, " ".join(base)), (2, " ".join(words(2, 30) + fuzzy + words(3, 30))), (3, " ".join(words(4, 300))),
            (4, " ".join(words(5, 40) + base[:40] + words(6, 40)))]
    found = spans(substrings.repeated_passages(frame(rows)))
    (s, e, home), = found[2]
    assert abs(s - 30) <= 1 and abs(e - 149) <= 1 and home == 1
    assert found[1] == found[3] == found[4] == []  # 40 shared words are too few


def test_texts_that_repeat_themselves(frame):
    rows = [(1, "and " * 400), (2, "and " * 400), (3, "one two three four five six seven " * 60), (4, "one two three four five six seven " * 60)]
    found = spans(substrings.repeated_passages(frame(rows)))
    assert found[1] == found[3] == []
    assert sum(e - s for s, e, _ in found[2]) >= 380 and sum(e - s for s, e, _ in found[4]) >= 400


def test_cut_text(frame, words):
    shared = " ".join(words(1, 80))
    rows = [(1, "start of one.\n" + shared + "\nend"), (2, "start of two.\n" + shared + "\nmore words follow here"), (3, shared), (4, "clean   text\n")]
    out = substrings.cut_repeats(frame(rows))
    assert out.columns == frame([]).columns
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()}
    assert texts[1][0] == rows[0][1] and texts[4][0] == "clean   text\n" and 3 not in texts
    assert texts[2][0] == "start of two.\nmore words follow here" and texts[2][1] == len(texts[2][0])


def test_odd_rows(frame, odd_rows):
    out = substrings.repeated_passages(frame(odd_rows)).collect()
    assert sorted(str(r["doc_id"]) for r in out) == sorted(str(i) for i, _ in odd_rows)
    found = {r["doc_id"]: r for r in out}
    assert found[5]["starts"] == [0] and found[5]["ends"] == [30_000] and found[4]["starts"] == []
    left = substrings.cut_repeats(frame(odd_rows))
    assert left.count() == len(odd_rows) - 1
    assert substrings.repeated_passages(frame([])).count() == 0 and substrings.cut_repeats(frame([])).count() == 0


def quadratic_chain(runs):
    order = sorted(range(len(runs)), key=lambda i: runs[i][0])
    best = {}
    for i in order:
        x, y, n = runs[i]
        before = [best[j] - substrings.GAP_COST * (x - runs[j][0] - runs[j][2] + y - runs[j][1] - runs[j][2])
                  for j in best if runs[j][0] + runs[j][2] <= x and runs[j][1] + runs[j][2] <= y]
        best[i] = n + max([0.0, *before])
    return max(best.values())


def test_chains_are_optimal():
    rng = random.Random(2)
    for _ in range(60):
        runs = [(rng.randrange(200), rng.randrange(200), rng.randint(3, 12)) for _ in range(rng.randint(1, 40))]
        chain = substrings.chains(runs)[0]
        score = sum(n for _, _, n in chain) - substrings.GAP_COST * sum(
            b[0] - a[0] - a[2] + b[1] - a[1] - a[2] for a, b in zip(chain, chain[1:]))
        assert abs(score - quadratic_chain(runs)) < 1e-6


def test_common_subsequence():
    rng = np.random.default_rng(1)
    for _ in range(100):
        a, b = rng.integers(0, 5, rng.integers(0, 30)), rng.integers(0, 5, rng.integers(0, 30))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
        assert substrings.common_subsequence(a, b) == table[-1, -1]


def test_minimizers_hit_every_window():
    h = common.mix(np.arange(1000, dtype=np.uint64))
    at = substrings.minimizers(h, 16)
    assert np.diff(at).max() <= 16 and len(at) < 200 and len(substrings.minimizers(h[:3], 16)) == 1


def test_passages_with_a_changed_word_every_few_words(frame, words):
    rows, want = [], {}
    for step in range(6, 13):
        for size in (55, 60, 80):
            for i in range(6):
                doc = len(rows) + 1
                passage = words(10_000 + doc, size)
                edited = [f"new{doc}x{j}" if j % step == step - 1 and j < size - 1 else w for j, w in enumerate(passage)]
                rows.append((doc, " ".join(words(20_000 + doc, 30) + passage + words(30_000 + doc, 30))))
                rows.append((5000 + doc, " ".join(words(40_000 + doc, 25) + edited + words(50_000 + doc, 35))))
                want[5000 + doc] = (doc, size)
    found = spans(substrings.repeated_passages(frame(rows)))
    assert {i for i in found if found[i]} == set(want)
    for i, (home, size) in want.items():
        (s, e, h), = found[i]
        assert h == home and 25 <= s <= 30 and 20 + size <= e <= 25 + size


def test_ends_grow_as_far_as_the_words_are_equal(words):
    a = np.arange(5000, dtype=np.uint16)
    chain = (np.array([2000]), np.array([2000]), np.array([4]))
    assert substrings.aligned(a, a, 0, *chain, 64, 50) == ([], True)  # come again with more words
    assert substrings.aligned(a, a, 0, *chain, 4096, 50) == ([(0, 5000)], False)


def test_stock_sentences_of_earlier_documents_do_not_hide_a_passage(frame, words):
    rng = random.Random(8)
    rows, want = [], {}
    for i in range(24):
        source = words(60_000 + i, 70)
        at, parts = 0, []
        while at < 70:  # overlapping sentences, so every window of five words occurs in an earlier document
            size = rng.randint(14, 20)
            parts.append(source[max(0, at - 4):at + size])
            at += size
        for j, part in enumerate(parts):
            rows.append((100 * i + j, " ".join(words(70_000 + 100 * i + j, 20) + part + words(80_000 + 100 * i + j, 20))))
        for doc in (10_000 + i, 20_000 + i):
            rows.append((doc, " ".join(words(90_000 + doc, 30) + source[8:58 + i % 5] + words(140_000 + doc, 30))))
        want[20_000 + i] = (30, 80 + i % 5)
    found = spans(substrings.repeated_passages(frame(rows)))
    for i, (s, e) in want.items():
        assert any(a <= s and e <= b <= e + 2 for a, b, _ in found[i]), i
    stock = words(1, 60)
    assert spans(substrings.repeated_passages(frame([(1, " ".join(stock[:24])), (2, " ".join(stock)), (3, " ".join(stock))])))[3] == [(0, 60, 2)]


def test_batches_of_single_runs_equal_the_alignment():
    rng = random.Random(12)
    owns, found, want = [], [], []
    for case in range(400):
        home = np.array([rng.randrange(6) for _ in range(rng.randint(4, 400))], np.uint16)
        own = np.array([rng.randrange(6) for _ in range(rng.randint(4, 400))], np.uint16)
        n = rng.randint(1, min(len(home), len(own), 16))
        x, y = rng.randint(0, len(own) - n), rng.randint(0, len(home) - n)
        size = rng.choice([0, 3, 20, 90])
        for k in range(-size, n + size):  # a copy around the run, some words changed
            if 0 <= x + k < len(own) and 0 <= y + k < len(home) and (0 <= k < n or rng.random() < 0.9):
                own[x + k] = home[y + k]
        owns.append(own)
        blocks = {b: home[b * substrings.BLOCK:(b + 1) * substrings.BLOCK].tobytes() for b in range(-(-len(home) // substrings.BLOCK))}
        chain = tuple(np.array([v], np.int32) for v in (x, y, n))
        found.append((case, case, 0, [chain], blocks))
        there, first = substrings.home_words(blocks, chain, substrings.MARGIN)
        want.append(substrings.aligned(own, there, first, *chain, substrings.MARGIN, 50))
    dropped = substrings.single_runs(owns, found, substrings.MARGIN, 50)
    assert 50 < dropped.sum() < 350
    assert all(w == ([], False) for w, d in zip(want, dropped) if d)


def test_runs_of_all_pairs_equal_those_of_each():
    rng = np.random.default_rng(5)
    pair = np.sort(rng.integers(0, 30, 600))
    x, y, n = rng.integers(0, 90, 600), rng.integers(0, 90, 600), np.full(600, 4)
    got = list(zip(*(v.tolist() for v in substrings.all_runs(pair, x, y, n))))
    want = [(int(p), *run) for p in np.unique(pair) for run in substrings.runs_of(x[pair == p], y[pair == p], n[pair == p])]
    assert got == want


def test_rows_of_one_id_are_cut_apart(frame, words):
    """Two texts of one id that both hold a passage of another document lose it, and equal rows leave one."""
    passage, fill = " ".join(words(1, 80)), [" ".join(words(i, 40)) for i in range(2, 7)]
    rows = [(1, f"{fill[0]} {passage}"), (2, f"{fill[1]} {passage}"), (2, f"{passage} {fill[2]}"), (3, " ".join(words(9, 70))), (3, " ".join(words(9, 70)))]
    kept = substrings.cut_repeats(frame(rows)).collect()
    got = sorted((r["doc_id"], " ".join(r["text"].split())) for r in kept)
    assert got == sorted([(1, rows[0][1]), (2, fill[1]), (2, fill[2]), (3, rows[3][1])])
