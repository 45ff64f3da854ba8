"""List scores, text similarity and the location filter against plain Python."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from rosterlake.operators import location, terms
from rosterlake.operators.embedding import lookup_encoder
from rosterlake.operators.scoring import list_similarities
from rosterlake.operators.tfidf import Tfidf
from rosterlake.session import over_all_cores
from test_functions import brute_ratio


def cosine(a, b):
    dot = sum(x * y for x, y in zip(a, b))
    norms = math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))
    return dot / norms if norms else 0.0


def tfidf(texts):
    """text -> word -> weight of the unit vectors of distinct texts."""
    texts = {t: Counter(w for w in re.split(r"\W+", t.lower()) if w) for t in texts}
    spread = Counter(w for words in texts.values() for w in words)
    out = {}
    for t, words in texts.items():
        weights = {w: n * math.log((len(texts) + 1) / (spread[w] + 1)) for w, n in words.items()}
        norm = math.sqrt(sum(v * v for v in weights.values()))
        out[t] = {w: v / norm for w, v in weights.items() if v} if norm else {}
    return out


def mean_best(need, have, similar, threshold, empty):
    if not need or not have:
        return empty
    best = [max(similar(x, y) for y in have) for x in need]
    return sum(b if threshold is None or b >= threshold else 0.0 for b in best) / len(need)


@pytest.fixture(scope="module")
def lists():
    rng = random.Random(6)
    word = lambda: rng.choice(["sql", "big data", "data lake", "python sql", "lake", "x", "café", "zero", "unknown", ""])
    make = lambda: None if rng.random() < 0.1 else [word() for _ in range(rng.randint(0, 5))]
    return [[(f"{side}{i}", make(), make(), "extra") for i in range(25)] for side in "jc"]


def scores(spark, lists, encode):
    schema = "k string, skills array<string>, culture array<string>, need string"
    jobs, people = (spark.createDataFrame(rows, schema) for rows in lists)
    pairs = jobs.select(F.col("k").alias("job")).join(people.select(F.col("k").alias("person")), F.lit(True))
    got = list_similarities(pairs, jobs.withColumnRenamed("k", "job"), people.withColumnRenamed("k", "person"), "job", "person", encode).collect()
    assert len(got) == 625
    return {(r.job, r.person): (r.skill, r.culture) for r in got}


def expected(lists, similar, known=lambda t: True):
    clean = lambda x: [t for t in x or [] if t and known(t)]
    return {(j, p): (mean_best(clean(js), clean(ps), similar, 0.5, 0.0), mean_best(clean(jc), clean(pc), similar, None, 0.5))
            for j, js, jc, _ in lists[0] for p, ps, pc, _ in lists[1]}


def test_list_scores_by_tfidf(spark, lists):
    used = {t for rows in lists for _, a, b, _ in rows for t in (a or []) + (b or []) if t}
    weights = tfidf(used)
    similar = lambda x, y: sum(v * weights[y].get(w, 0) for w, v in weights[x].items())
    got, want = scores(spark, lists, Tfidf()), expected(lists, similar)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)


def test_list_scores_by_vectors(spark, lists):
    rng = random.Random(8)
    vectors = {t: [rng.gauss(0, 1) + (i < 3) for i in range(50)] for t in ["sql", "big data", "data lake", "python sql", "lake", "x", "café"]}
    vectors["zero"] = [0.0] * 50  # has a vector but no direction; "unknown" has none
    table = spark.createDataFrame(list(vectors.items()), "text string, vector array<double>")
    got, want = scores(spark, lists, lookup_encoder(table)), expected(lists, lambda x, y: cosine(vectors[x], vectors[y]), vectors.__contains__)
    assert all(got[k] == pytest.approx(want[k], abs=1e-5) for k in want)


def test_summary_bounds_the_cosine(spark):
    rng = random.Random(9)
    rows = [([rng.gauss(0, 1) for _ in range(40)], [rng.gauss(0, 1) for _ in range(40)]) for _ in range(50)] + [([1.0], [2.0]), ([0.0] * 40, [1.0] * 40)]
    df = spark.createDataFrame(rows, "a array<double>, b array<double>").select("a", "b", terms.summary(F.col("a"), 5).alias("x"), terms.summary(F.col("b"), 5).alias("y"))
    for r in df.collect():
        assert len(r.x) <= 6 and cosine(r.x, r.y) >= cosine(r.a, r.b) - 1e-9


@pytest.mark.parametrize("apart", [False, True])
def test_text_similarity_by_tfidf(spark, apart):
    rows = [("a b c", "a b d"), ("a b c", "a b c"), ("", "a"), (None, "a"), ("...", None), ("A  É", "é"), ("z", "y")]
    df = spark.createDataFrame([(i, *r, "w") for i, r in enumerate(rows)], "id int, l string, r string, word string")
    texts = {t for r in rows for t in r if t is not None}
    weights = tfidf(texts)
    given = spark.createDataFrame([(t,) for t in sorted(texts) * 2], "text string") if apart else None
    got = {r.id: r.s for r in terms.text_similarity(df, "l", "r", "s", Tfidf(), given).collect()}
    for i, (a, b) in enumerate(rows):
        known = a is not None and b is not None and weights[a] and weights[b]
        assert got[i] == (pytest.approx(sum(v * weights[b].get(w, 0) for w, v in weights[a].items())) if known else None)


def test_empty_tables(spark):
    schema = "k string, skills array<string>, culture array<string>"
    empty, one = spark.createDataFrame([], schema), spark.createDataFrame([("a", ["x"], [])], schema)
    pairs = spark.createDataFrame([("a", "b")], "job string, person string")
    got = list_similarities(pairs, one.withColumnRenamed("k", "job"), empty.withColumnRenamed("k", "person"), "job", "person", Tfidf()).collect()
    assert [tuple(r) for r in got] == [("a", "b", 0.0, 0.5)]
    assert terms.text_similarity(spark.createDataFrame([], "l string, r string"), "l", "r", "s", Tfidf()).count() == 0


def test_location_filter_loses_no_close_pair(spark):
    rng = random.Random(3)
    name = lambda: "".join(rng.choice("ABC D1") for _ in range(rng.randint(1, 12)))
    pairs = list({(name(), name()) for _ in range(400)})
    for threshold in (70.0, 90.0):
        got = location.close_names(spark.createDataFrame(pairs, "a string, b string"), threshold).collect()
        assert sorted(map(tuple, got)) == sorted(p for p in pairs if brute_ratio(*p) >= threshold)


def test_rows_over_all_cores(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "t"))
    dealt = over_all_cores(spark.read.parquet(str(tmp_path / "t")))
    assert dealt.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and dealt.count() == 100
