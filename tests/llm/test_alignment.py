import hashlib
import random
from collections import Counter

import pytest
from rosterlake.llm import alignment

ODD = ["a <s> b </s>", "<|endoftext|> <unk> <0x41>", "tab\tand\n\nlines   ", " lead", "▁", "漢字 é \U0001f600 x", "   ", "\x00\x01", "123 45", "é ﬁ"]


def byte_names():
    import json

    import public_tokenizers
    vocab = json.load(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8"))["model"]["vocab"]
    # every byte is a token of its own; the alphabet is the same for all entries
    keep = list(range(33, 127)) + list(range(161, 173)) + list(range(174, 256))
    rest = [b for b in range(256) if b not in keep]
    of = {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(rest)}
    return {i: bytes(of[c] for c in name) for name, i in vocab.items()}


def brute(rows):
    """doc rows from the two libraries and plain loops over all token pairs."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    one, two = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model"))
    one.encode_special_tokens = True
    names, out, links = byte_names(), [], []
    for key, text in rows:
        a = one.encode(" " + text, add_special_tokens=False).ids if text else []
        b = two.encode(text) if text else []
        ab = [names[i] for i in a]
        bb = [bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode() for p in map(two.id_to_piece, b)]
        if not text or b"".join(ab) != (" " + text).encode() or b"".join(bb) != (" " + text).encode():
            a, b, ab, bb = [], [], [], []
        spans = []
        for parts in (ab, bb):
            at = 0
            spans.append([])
            for p in parts:
                spans[-1].append((at, at + len(p)))
                at += len(p)
        mine = [(a[i], b[j]) for i, (s, e) in enumerate(spans[0]) for j, (t, f) in enumerate(spans[1]) if s < f and t < e]
        ends = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, last = [], 0
        for end in ends:
            part = ["," .join(str(x) for x, (s, e) in zip(ids, where) if last <= s and e <= end) for ids, where in zip((a, b), spans)]
            groups.append("|".join(part))
            last = end
        out.append([key, len(a), len(b), len(ends), len(mine), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""])
        links.append(mine)
    counts = Counter(p for mine in links for p in mine)
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return sorted((tuple(r[:5]) + (sum(counts[p] == most[p[1]] for p in mine), sum(counts[p] for p in mine), r[5])
                   for r, mine in zip(out, links)), key=str)


@pytest.mark.parametrize("frequent", [alignment.FREQUENT, 5, 0])
def test_equals_brute_force(frame, words, frequent):
    rng = random.Random(7)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (None, None), (40, None), (41, ""), (42, "same"), (42, "same"), (42, "other text of one id")]
    rows += [(100 + i, rng.choice([" ", "  ", "\n", ", "]).join(words(i, rng.randint(1, 60)))) for i in range(40)]
    got = alignment.token_alignment(frame(rows), frequent=frequent)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_long_text_and_empty_table(frame, odd_rows):
    got = {(r["doc_id"], r["n_a"]): r for r in alignment.token_alignment(frame(odd_rows)).collect()}
    assert len([1 for key in got if key[0] == 4]) == 1 and max(n for _, n in got) > 30_000
    assert all(r["n_links"] == r["n_a"] + r["n_b"] - r["n_groups"] for r in got.values())
    assert alignment.token_alignment(frame([])).count() == 0
    assert alignment.token_alignment(frame([(1, None)])).first()["groups_sha256"] == ""


def test_slices_of_random_ends():
    import numpy as np
    rng = random.Random(5)
    for _ in range(300):
        total = rng.randint(1, 40)
        ends = [np.array(sorted(rng.sample(range(1, total), rng.randint(0, total - 1)) + [total])) for _ in range(2)]
        cuts = alignment.common_ends(ends[0].tolist(), ends[1].tolist())
        left, right = alignment.slice_links(ends[0], ends[1], *map(np.array, cuts))
        begin = [np.r_[0, e[:-1]] for e in ends]
        want = [(i, j) for i in range(len(ends[0])) for j in range(len(ends[1]))
                if begin[0][i] < ends[1][j] and begin[1][j] < ends[0][i]]
        assert sorted(zip(left.tolist(), right.tolist())) == want


def test_common_ends_are_looked_up_in_whole_arrays():
    import numpy as np
    rng = random.Random(11)
    for _ in range(200):
        total = rng.randint(1, 60)
        ends = [np.array(sorted(rng.choices(range(1, total + 1), k=rng.randint(0, total))) + [total]) for _ in range(2)]
        got = alignment.common_ends(*ends)
        index = [dict(zip(e.tolist(), range(1, len(e) + 1))) for e in ends]
        shared = sorted(index[0].keys() & index[1].keys())
        assert all(isinstance(g, np.ndarray) for g in got)
        assert [g.tolist() for g in got] == [[x[end] for end in shared] for x in index]
