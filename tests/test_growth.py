"""What must not grow with a table: tasks per class, copies of wide rows, files in a Python batch, digests on rows of words."""

import random

import pytest
from pyspark.sql import functions as F

from rosterlake.operators import joins, location, profile, scoring, terms, training
from rosterlake.operators.tfidf import Tfidf
from rosterlake.sources import documents
from workload import REGISTRY


def plan(df, kind="executedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


def test_places_are_decided_where_the_rows_lie(spark):
    rng = random.Random(5)
    word = lambda: rng.choice([None, "", "rua 12 cidade 7", "Cidade 17", "nation_3", "São João", "s", "joão", "x" * 70, 'a"b\\c', "\x00"])
    rows = [(i, word(), word(), word(), word()) for i in range(300)]
    out = location.with_same_place(spark.createDataFrame(rows, "i int, a string, b string, c string, d string"), ["a", "b"], ["c", "d"], 70)
    assert "Exchange" not in plan(out) and "Join" not in plan(out)

    def near(x, y):
        return x in y or y in x or location.partial_ratios([(x, y)])[0] >= 70

    got = {r.i: r.ind_mesma_localidade for r in out.collect()}
    for i, *names in rows:
        here, there = ([x.upper() for x in side if x] for side in (names[:2], names[2:]))
        assert got[i] == any(near(x, y) for x in here for y in there), names


def test_no_shuffle_by_class_or_common_value(spark):
    rows = spark.createDataFrame([(i, None if i % 7 == 0 else i % 2, "ANA" if i % 3 else f"r{i % 40}") for i in range(400)], "id long, y int, r string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the plan as it is before the first task
    try:
        for df in (training.balanced_weight(rows, "y"), training.stratified_split(rows, "id", "y").where("is_test"), joins.group_rare(rows, "r", "k")):
            assert "SortMergeJoin" not in plan(df) and "BroadcastHashJoin" in plan(df)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    weights = {(r.y, round(r.weight, 6)) for r in training.balanced_weight(rows, "y").collect()}
    sizes = {y: rows.where(F.col("y").eqNullSafe(F.lit(y))).count() for y in (None, 0, 1)}
    assert weights == {(y, round(400 / (3 * n), 6)) for y, n in sizes.items()}


@pytest.mark.parametrize("nominal", [10_000, 20])
def test_trees_hold_a_category_as_one_number(spark, monkeypatch, nominal):
    monkeypatch.setattr(training, "NOMINAL", nominal)
    rows = [(i % 2 if i % 90 else 1 - i % 2, float(i % 5), f"k{i % 90}") for i in range(900)]
    df = spark.createDataFrame(rows, "y int, n double, c string")
    model, _ = training.train(df, "y", ["n"], ["c"], maxIter=3, maxDepth=2)
    assert model.stages[-1].numFeatures == (2 if nominal > 90 else 1 + 90 + 1)  # the unseen value
    unseen = spark.createDataFrame([(0, 1.0, "new"), (0, 1.0, None)], "y int, n double, c string")
    assert training.score_probability(model, unseen).count() == 2
    if nominal > 90:  # sets of values split what one value at a time cannot in two levels
        wrong = training.score_probability(model, df).where("predicted <> y").count()
        assert wrong <= 10


def test_texts_are_not_sorted_to_be_told_apart(spark, monkeypatch):
    seen = []
    keep = terms.store
    monkeypatch.setattr(terms, "store", lambda df, *a: seen.append(plan(df)) or keep(df, *a))
    df = spark.createDataFrame([("big data", "data"), ("big data", None), ("x", "big")], "l string, r string")
    assert terms.text_similarity(df, "l", "r", "s", Tfidf()).count() == 3
    assert seen and not any("SortAggregate" in p for p in seen)
    assert {len(r[0]) for r in df.select(terms.text_key(F.col("l"))).collect()} == {16}


def test_profile_is_dealt_over_all_cores(spark, tmp_path):
    spark.range(50).selectExpr("cast(id % 7 as string) AS a", "'x' AS b").coalesce(1).write.parquet(str(tmp_path / "t"))
    df = profile.qualitative_profile(spark.read.parquet(str(tmp_path / "t")))
    assert "RoundRobinPartitioning" in plan(df)
    assert {r["column"]: r.n_unique for r in df.collect()} == {"a": 7, "b": 1}


def test_files_reach_python_by_rows(spark):
    df = spark.createDataFrame([("a.docx", ["x", "y"]), ("b.docx", [])], "path string, lines array<string>")
    built = df.select("path", documents.word_file(F.col("lines")).alias("content"))
    read = documents.parse_documents(built)
    assert "ArrowEvalPython" not in plan(built) + plan(read)
    assert {r.path: r.text for r in read.collect()} == {"a.docx": "x\ny", "b.docx": ""}


def test_ranking_takes_a_skill_match_computed_before(spark):
    levels = {c: "PLENO" for c in [*scoring.JOB_LEVELS.values(), *scoring.CANDIDATE_LEVELS.values()]}
    row = spark.createDataFrame([("1", "2", 0.5, "big data", "data")], "codigo_vaga string, codigo_candidato string, s double, job_pv_principais_atividades string, app_cv_pt string")
    out = scoring.technical_ranking(row.withColumns({k: F.lit(v) for k, v in levels.items()}), None, None, Tfidf(), soft="s").first()
    assert out.soft_match_score == 0.5


def test_profile_columns_are_ready_before_the_pairs(spark, tmp_path):
    spark.sql("SELECT 1L AS o_orderkey, 5L AS o_custkey, 'F' AS o_orderstatus, 9.0D AS o_totalprice, DATE '1996-01-01' AS o_orderdate, '2-HIGH' AS o_orderpriority").write.parquet(str(tmp_path / "orders.parquet"))
    spark.sql("SELECT 5L AS c_custkey, 'N' AS c_name, 1 AS c_nationkey, 2.0D AS c_acctbal, 'BUILDING' AS c_mktsegment").write.parquet(str(tmp_path / "customer.parquet"))
    spark.sql("SELECT 1L AS l_orderkey, 5L AS l_partkey, 3L AS l_suppkey, 1 AS l_linenumber, 'A' AS l_returnflag, 'O' AS l_linestatus, DATE '1996-02-01' AS l_shipdate").write.parquet(str(tmp_path / "lineitem.parquet"))
    df = REGISTRY["completeness"].run(spark, str(tmp_path))
    optimized = plan(df, "optimizedPlan")
    assert optimized.index("Join") < optimized.index("AS tamanho_cv")
    assert df.first().tamanho_cv == len("EXPERIENCIA EM BUILDING E PYTHON COM SQL, DISPONIBILIDADE PJ 5")
