import math
import time
from collections import defaultdict

import numpy as np
import pytest
from rosterlake.llm import common, language

DOCS = "/root/testdata/sf0.001/documents.parquet"
SCHEMA = "kind string, id string, text string, declared string, host string"
EN, DE = "the thing and the of that with tion ing this", "der und die nicht schein keit ung auch eine"


@pytest.fixture(scope="module")
def model(spark):
    common.prepare(spark)
    return language.fit_text(spark.read.parquet(DOCS))


def identify(spark, model, rows):
    return {r["id"]: r for r in language.identify(spark.createDataFrame(rows, SCHEMA), *model).collect()}


def background():
    return [("page", f"e{i}", EN * 3, "en", "a.one.com") for i in range(40)] + [("page", f"d{i}", DE * 3, "de", "b.two.de") for i in range(40)]


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = language.identify(language.document_records(docs), *model).collect()
    assert len(out) == docs.count()
    assert sum(r["lang"] == r["declared"] for r in out) >= 0.99 * len(out)
    assert sum(r["text_lang"] == r["declared"] for r in out) >= 0.98 * len(out)
    assert sum(r["kept"] for r in out) >= 0.999 * len(out)


def test_evidence_is_fused(spark, model):
    rows = background() + [
        ("page", "wrong", DE * 3, "en", "x.three.org"),          # long text beats the declaration
        ("page", "short", "in", "de", "b.two.de"),               # declaration, suffix and host decide a short text
        ("page", "short2", "in", "en", "a.one.com"),
        ("page", "domain", "in", "", "new.two.de"),              # an unseen host falls back on its domain
    ]
    out = identify(spark, model, rows)
    assert [out[k]["lang"] for k in ("wrong", "short", "short2", "domain")] == ["de", "de", "en", "de"]
    assert out["short"]["probability"] > 0.9


def test_own_vote_is_left_out(spark, model):
    out = identify(spark, model, background() + [("page", "alone", DE * 3, "en", "only.once.net")])
    assert out["alone"]["lang"] == "de"


def test_without_language_is_rejected(spark, model):
    rows = background() + [("page", "digits", "123 456 !!", "en", "a.one.com"), ("page", "none", None, None, None),
                           ("page", "empty", "", "", ""), ("page", "cjk", "漢字仮名交文書類" * 40, "", "")]
    out = identify(spark, model, rows)
    assert [out[k]["kept"] for k in ("digits", "none", "empty", "cjk")] == [False] * 4
    assert out["none"]["lang"] == "und" and out["none"]["probability"] is None and out["e0"]["kept"]


def test_page_records(spark):
    html = "<html class=x lang='de-AT'><script>the</script><!-- the --><p>und<b>die</b></p>"
    pages = spark.createDataFrame([(1, "https://u@WWW.Site.co.uk:80/en/1?q", html), (2, None, None)], "page_id long, url string, html string")
    a, b = language.page_records(pages).orderBy("id").collect()
    assert (a["declared"], a["host"], a["text"].split()) == ("de", "www.site.co.uk", ["und", "die"])
    assert b["declared"] is None and b["host"] is None and b["text"] is None


def test_odd_rows(spark, frame, odd_rows):
    df = frame(odd_rows)
    common.prepare(spark)
    model = language.fit_text(df)
    assert language.identify(language.document_records(df), *model).count() == len(odd_rows)
    kept = language.keep_known(df)
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(i) for i, t in odd_rows if i is None or (t and t.strip()))
    assert language.keep_known(frame([])).count() == 0
    assert language.identify(language.document_records(frame([])), *language.fit_text(df)).count() == 0


def test_fusion_matches_plain_python(spark, model):
    """Every record's language and probability against a record-by-record computation over the whole table."""
    languages, table = model
    n, letter = len(languages), language.letters()
    docs = [("document", str(r["doc_id"]), r["text"][:300], r["lang"], r["source"]) for r in spark.read.parquet(DOCS).collect()]
    rows = docs + background() + [("page", "bare", "in", "", ""), ("page", "no host", EN * 3, "", ""), ("page", "null", None, None, None)]
    evidence = []
    for _, _, text, _, _ in rows:
        e, count = np.zeros(n + 1), 0
        for slots in language.trigrams(text, letter):
            e[:n] += table[:, slots].sum(axis=1, dtype=np.float64)
            count += len(slots)
        e[n] = -count * math.log(language.SLOTS)
        evidence.append((e, count))
    votes = {key: defaultdict(lambda: np.zeros(n)) for key in ("host", "domain", "suffix", "declared")}
    total, facts = np.zeros(n), []
    for (_, _, _, declared, host), (e, count) in zip(rows, evidence):
        share = np.exp(language.TEXT_WEIGHT * (e - e.max()))
        guess = int(e[:n].argmax()) if count and share.sum() <= 1 / language.SURE and e[n] < e.max() else None
        last = (host or "").rsplit(".", 1)
        keys = {"host": host or "", "domain": ".".join((host or "").split(".")[-2:]), "declared": declared or "",
                "suffix": last[1] if len(last) == 2 and 2 <= len(last[1]) <= 3 and last[1].isascii() and last[1].islower() else ""}
        facts.append((keys, guess))
        if guess is not None:
            total[guess] += 1
            for key, value in keys.items():
                if value:
                    votes[key][value][guess] += 1
    out = identify(spark, model, rows)
    for (_, i, _, _, _), (e, count), (keys, guess) in zip(rows, evidence, facts):
        mine = {}
        for key, value in keys.items():
            mine[key] = votes[key][value].copy()
            if value and guess is not None:
                mine[key][guess] -= 1
        prior = (total + 1) / (total.sum() + n)
        for key in ("domain", "host"):
            prior = (mine[key] + language.STRENGTH * prior) / (mine[key].sum() + language.STRENGTH)
        other = np.zeros(n)
        for key, weight in (("declared", 1), ("suffix", language.SUFFIX_WEIGHT)):
            if votes[key][keys[key]].sum():
                other += weight * np.log((mine[key] + 1) / (total + 2))
        scores = np.append(language.TEXT_WEIGHT * e[:n] + np.log(prior) + other, language.TEXT_WEIGHT * e[n] + math.log(language.UNKNOWN) + other.mean())
        chance = np.exp(scores - scores.max())
        chance /= chance.sum()
        if not count:
            assert out[i]["lang"] == "und" and not out[i]["kept"] and out[i]["probability"] is None
            continue
        assert abs(out[i]["probability"] - chance.max()) < 1e-6
        assert out[i]["lang"] == [*languages, "und"][int(scores.argmax())]


def test_many_languages(spark):
    """200 languages of their own letters: all are told apart, and the time does not grow with the square of their number."""
    rng = np.random.default_rng(3)
    codes = [a + b for a in "abcdefghijklmnopqrst" for b in "abcdefghij"]
    words = {c: ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(30)] for c in codes}
    rows = [(i, " ".join(rng.choice(words[codes[i % 200]], 25)), codes[i % 200], f"host{i % 300}", 0) for i in range(10_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").repartition(8).cache()
    docs.count()
    common.prepare(spark)
    start = time.time()
    languages, model = language.fit_text(docs)
    out = language.identify(language.document_records(docs), languages, model).select("lang", "text_lang", "declared").collect()
    assert time.time() - start < 40  # about 8 seconds here
    docs.unpersist()
    assert languages == sorted(codes)
    assert sum(r["text_lang"] == r["declared"] for r in out) > 0.99 * len(out) and sum(r["lang"] == r["declared"] for r in out) > 0.99 * len(out)


def test_rows_of_one_id_are_judged_apart(spark, frame):
    df = frame([(1, EN * 5), (2, EN * 4), (2, "123 !"), (3, None)])
    assert sorted((r["doc_id"], r["text"]) for r in language.keep_known(df).collect()) == [(1, EN * 5), (2, EN * 4)]


def test_references_of_pages_are_decoded(spark, model):
    rows = background() + [("page", "plain", "über schön für", "", ""), ("page", "coded", "&uuml;ber sch&#246;n f&#xfc;r", "", "")]
    out = identify(spark, model, rows)
    assert out["coded"]["n_trigrams"] == out["plain"]["n_trigrams"] and out["coded"]["lang"] == out["plain"]["lang"]
