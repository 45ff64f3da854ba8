import random

import numpy as np
import pytest
from rosterlake.llm import licences as L


def brute(text, containment=0.8):
    """Templates whose shingles are found to 80 % within some stretch of as many windows as the template's class has."""
    s, out = L.shingles(text), set()
    for i, (_, t) in enumerate(L.TEMPLATES):
        want = np.unique(L.shingles(t))
        near = np.flatnonzero(np.isin(s, want))
        if any(len(np.intersect1d(s[a:a + len(want)], want)) >= containment * len(want) - 1e-9 for a in near):
            out.add(i)
    return out


def found(df):
    out = {}
    for r in L.scan(df).collect():
        out.setdefault(r["doc_id"], []).append((r["template"], r["start_word"], r["end_word"], r["containment"]))
    return out


def test_planted_templates(frame, words):
    rng = random.Random(1)
    rows, want = [], {}
    for i in range(160):
        template = L.TEMPLATES[i % len(L.TEMPLATES)][1].split()
        if i >= 80:  # a few words changed
            for _ in range(rng.randint(0, 3)):
                template[rng.randrange(len(template))] = "changed"
        w = words(i, rng.randint(0, 300))
        at = rng.randint(0, len(w))
        rows.append((i, " ".join(w[:at] + [x.upper() for x in template] + w[at:]) + "\n\n"))
        want[i] = brute(rows[-1][1])
    out = found(frame(rows))
    assert {i: {m[0] for m in out.get(i, [])} for i in want} == want
    for i in range(80):
        (start, end, share), = [m[1:] for m in out[i] if m[0] == i % len(L.TEMPLATES)]
        assert share == 1 and end - start >= len(L.word_list(L.TEMPLATES[i % len(L.TEMPLATES)][1]))


def test_two_passages_of_one_template(frame, words):
    line = "Released under the MIT License."
    text = line + " " + " ".join(words(1, 40)) + " " + line
    assert [m[1:3] for m in found(frame([(1, text)]))[1]] == [(0, 5), (45, 50)]


def test_bands():
    for jaccard in (0.1, 0.19, 0.5, 0.9):
        bands = L.bands_for(jaccard)
        assert (1 - jaccard) ** bands <= 1e-3 < (1 - jaccard) ** (bands - 1)
    assert L.bands_for(1.0) == 1


def test_blocks_of_templates(frame, monkeypatch):
    rows = [(i, t) for i, (_, t) in enumerate(L.TEMPLATES)]
    whole = found(frame(rows))
    monkeypatch.setattr(L, "AT_ONCE", 4)
    assert {k: sorted(v) for k, v in found(frame(rows)).items()} == {k: sorted(v) for k, v in whole.items()}


def test_odd_rows(frame, odd_rows):
    line = "Licensed under the Apache License, Version 2.0."
    rows = [*odd_rows, (None, line), (7, line), (7, line)]
    out = L.scan(frame(rows)).collect()
    assert sorted(str(r["doc_id"]) for r in out) == ["7", "7", "None"]
    assert L.scan(frame([])).count() == 0
    with pytest.raises(ValueError, match="words"):
        L.Index([("x", "too short")])
