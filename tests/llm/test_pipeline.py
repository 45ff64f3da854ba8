"""The pipeline stage by stage against plain Python on the smallest tables."""

import re
from collections import Counter

import corpus_pipeline
import pytest
from rosterlake.llm.common import prepare, store
from test_jaccard import brute
from test_quality import brute as figures

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Result of every stage, the input first."""
    prepare(spark)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(store(stage(spark, out[-1], FOLDER), name))
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality_rules", "ngram_jaccard_join", "substring_dedup", "best_fit_packing"]
    assert all(df.columns == stages[0].columns for df in stages[:-1])


def test_language_keeps_what_has_letters(stages):
    before, after = texts(stages[0]), texts(stages[1])
    assert {i for i, t in before.items() if re.search(r"[^\W\d_]", t)} == set(after)


def test_quality_is_the_base_rule_with_few_labels(stages):
    before, after = texts(stages[1]), texts(stages[2])
    kept = set()
    for i, t in before.items():
        n, _, _, _, repeated = figures(t)
        if n >= 10 and 100 * repeated <= 20 * n:
            kept.add(i)
    assert kept == set(after)


def test_one_of_each_group_stays(stages):
    rows = sorted(texts(stages[2]).items())
    assert set(texts(stages[3])) == {i for i, _, group in brute(rows) if i == group}


def test_no_long_passage_is_left_twice(stages):
    before, after = texts(stages[3]), texts(stages[4])
    windows = lambda t: {tuple(w[i:i + 50]) for w in [t.split()] for i in range(len(w) - 49)}
    assert not [w for w, n in Counter(w for t in after.values() for w in windows(t)).items() if n > 1]
    grams = {i: {tuple(w[k:k + 5]) for w in [t.split()] for k in range(len(w) - 4)} for i, t in before.items()}
    owners = Counter(g for some in grams.values() for g in some)
    for i, t in before.items():
        if all(owners[g] == 1 for g in grams[i]):
            assert after[i] == t  # a text of its own comes back as it was
    for i, t in after.items():
        if t != before[i]:
            words = iter(before[i].split())
            assert all(w in words for w in t.split())  # what is left is in the old order


def test_packing_holds_every_word(stages):
    documents = texts(stages[4])
    sources = {r["doc_id"]: r["source"] for r in stages[4].collect()}
    rows = stages[5].toPandas()
    assert rows.groupby("doc_id")["words"].sum().to_dict() == {i: len(t.split()) for i, t in documents.items()}
    rows["source"] = rows["doc_id"].map(sources)
    assert rows.groupby(["shard", "bin"])["words"].sum().max() <= 2048
    assert not rows.duplicated(["shard", "bin", "source"]).any()


def test_odd_rows(spark, frame, odd_rows):
    docs = frame([*odd_rows, (9, " ".join(f"word{i}" for i in range(30)))]).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        docs = store(stage(spark, docs, FOLDER))
    assert {r["doc_id"] for r in docs.collect()} >= {4, 9}
    empty = frame([]).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        empty = store(stage(spark, empty, FOLDER))
    assert empty.count() == 0


def test_run_equals_the_stages(spark, stages):
    key = lambda df: sorted(tuple(r) for r in df.select("doc_id", "part", "words", "start").collect())
    assert key(corpus_pipeline.run(spark, FOLDER)) == key(stages[5])
