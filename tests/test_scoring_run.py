"""The scoring job builds its wide rows once and joins them with their scores in place."""

import copy

import pytest
from pyspark.sql import functions as F
from test_growth import plan
from test_plans import APPLICANTS, JOBS, PROSPECTS, TERMS

from rosterlake.operators import extraction
from rosterlake.operators.embedding import lookup_encoder
from rosterlake.plans import curate, scoring
from rosterlake.sources import schemas
from rosterlake.sources.tables import path_exists


def curated_tables(spark, folder):
    jobs, prospects, applicants = map(copy.deepcopy, (JOBS, PROSPECTS, APPLICANTS))
    applicants["10"] = {**copy.deepcopy(APPLICANTS["1"]), "cv_pt": "SQL"}  # has the id of a job
    prospects["10"]["prospects"] += [{"nome": "A", "codigo": "10"}, {"nome": "B", "codigo": "2"}]
    prospects["11"]["prospects"] = [{"nome": "A", "codigo": "10"}]
    tables = [spark.createDataFrame(keyed, schemas.with_id(record, key)) for keyed, key, record in (
        ([{"codigo_vaga": k, **v} for k, v in jobs.items()], "codigo_vaga", schemas.RAW_JOB),
        ([{"codigo_vaga": k, **v} for k, v in prospects.items()], "codigo_vaga", schemas.RAW_PROSPECT),
        ([{"codigo_candidato": k, **v} for k, v in applicants.items()], "codigo_candidato", schemas.RAW_APPLICANT))]
    curate.curate_all(*tables, folder)
    return folder


def test_answers_reach_their_rows(spark, tmp_path):
    words = extraction.keyword_extract(TERMS, {})
    asked = []

    def extract(sources, kind):
        asked.extend((kind, r.id) for r in sources.collect())
        found = words(sources, kind).withColumn("ok", F.col("id") != "2")
        return found.withColumn("dados", F.col("dados").withField("ferramentas_tecnologicas", F.array(F.concat(F.lit("T"), "id"))))

    known = spark.createDataFrame([(f"T{i}", [1.0, float(n)]) for n, i in enumerate(("1", "10", "10_cand", "11"))], "text string, vector array<double>")
    store = str(tmp_path / "store")
    out = scoring.run(spark, curated_tables(spark, str(tmp_path / "curated")), store, str(tmp_path / "scored"), extract, lookup_encoder(known))
    assert sorted(asked) == [("candidato", i) for i in ("1", "10", "10_cand", "2")] + [("vaga", i) for i in ("10", "11")]
    got = {(r.codigo_vaga, r.codigo_candidato): (r.job_ferramentas_tecnologicas, r.app_ferramentas_tecnologicas) for r in out.collect()}
    assert got == {("10", "1"): (["T10"], ["T1"]), ("10", "10_cand"): (["T10"], ["T10_cand"]), ("11", "10"): (["T11"], ["T10"])}
    features, enriched = (spark.read.parquet(f"{store}/{n}.parquet") for n in ("features", "resultado_final"))
    # a row without an answer stays a feature row, under its own ids
    assert sorted((r.codigo_vaga, r.codigo_candidato) for r in features.collect()) == [("10", "1"), ("10", "10"), ("10", "2"), ("11", "10")]
    added = [*extraction.answer_fields(F.col("x"), extraction.JOB_SCHEMA, "job_"), *extraction.answer_fields(F.col("x"), extraction.CANDIDATE_SCHEMA, "app_")]
    assert len(enriched.columns) == len(features.columns) + len(added) and not [c for c in features.columns if "answer" in c]
    assert enriched.count() == 3 and set(enriched.columns) <= set(out.columns)


def test_scores_join_in_place(spark):
    lists = [["SQL"], ["SQL", "PYTHON"], [], None]
    rows = [(str(i % 7), f"c{i}", lists[i % 4], lists[i % 3], ["L"], lists[i // 4 % 4], None, ["L", "M"], "BOM PERFIL") for i in range(96)] + [(None, "c", *lists, ["L"], ["M"], "")]
    names = [f"{side}_{f}" for side in ("job", "app") for f in ("competencias_tecnicas", "ferramentas_tecnologicas", "competencias_comportamentais")]
    shape = "codigo_vaga string, codigo_candidato string, " + ", ".join(f"{n} array<string>" for n in names) + ", p_comentario string"
    df = spark.createDataFrame([(*r[:2], *r[2:5], *r[5:8], r[8]) for r in rows], shape)
    levels = [c for side in (scoring.scoring.JOB_LEVELS, scoring.scoring.CANDIDATE_LEVELS) for c in side.values()]
    df = df.withColumns({c: F.lit(None).cast("string") for c in levels})
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the plan as it is before the first task
    try:
        out = scoring.score_table(df)
        assert "Exchange hashpartitioning" not in plan(out) and "SortMergeJoin" not in plan(out)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    got = {r.codigo_candidato: (r.score_skills, r.score_cultural) for r in out.collect()}
    assert len(got) == 96 and out.columns[:2] == ["codigo_vaga", "codigo_candidato"]
    keys = ["codigo_vaga", "codigo_candidato"]
    given = [df.select(k, F.concat(f"{p}_competencias_tecnicas", f"{p}_ferramentas_tecnologicas").alias("skills"),
                       F.col(f"{p}_competencias_comportamentais").alias("culture")) for k, p in zip(keys, ("job", "app"))]
    by_table = scoring.score_table(df, None, None, given[1].where("codigo_candidato IS NOT NULL"))
    assert {r.codigo_candidato: (r.score_skills, r.score_cultural) for r in by_table.collect()} == got


def test_shuffle_files_go_with_their_step(spark, tmp_path, monkeypatch):
    def held():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}

    curated = curated_tables(spark, str(tmp_path / "curated"))
    before, seen, stored = held(), [], scoring.store
    monkeypatch.setattr(scoring, "store", lambda df, label="stored": (seen.append(len(held() - before)), stored(df, label))[1])
    setting = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false")
    scoring.run(spark, curated, str(tmp_path / "store"), str(tmp_path / "scored"), extraction.keyword_extract(TERMS, {}))
    assert len(seen) == 3 and [*seen, len(held() - before)] == [0, 0, 0, 0]
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == setting


def test_wide_rows_are_joined_in_parts(spark, tmp_path, monkeypatch):
    """One part of the jobs after the other is shuffled, contact columns as marks, and the wide rows go when they are projected."""
    parts, joins, paths = [], [], []
    table, build, path = scoring.feature_table, scoring.features.build_features, scoring.scratch_path

    def part(prospects, applicants, jobs, today):
        parts.append({r.codigo_vaga for r in jobs.collect()})
        return table(prospects, applicants, jobs, today)

    def joined(df, *options):
        joins.append({r[0] for c in ("app_ib_telefone", "app_ib_email", "app_ip_url_linkedin") if c in df.columns for r in df.select(c).collect()})
        return build(df, *options)

    monkeypatch.setattr(scoring, "feature_table", part)
    monkeypatch.setattr(scoring.features, "build_features", joined)
    monkeypatch.setattr(scoring, "scratch_path", lambda *given: (paths.append(path(*given)), paths[-1])[1])
    out = scoring.run(spark, curated_tables(spark, str(tmp_path / "curated")), str(tmp_path / "store"), str(tmp_path / "scored"), extraction.keyword_extract(TERMS, {}))
    assert out.count() == 4 and out.select("codigo_vaga").distinct().count() == 2
    assert len(parts) == scoring.PARTS > 1 and sorted(i for p in parts for i in p) == ["10", "11"]
    assert set().union(*joins) <= {None, "x"}
    assert len(paths) == 1 and not path_exists(spark, paths[0])


def test_wide_steps_run_as_small_methods(spark, monkeypatch, tmp_path):
    name, seen = "spark.sql.codegen.hugeMethodLimit", []
    before = spark.conf.get(name)

    def stop(session, path):
        seen.append(session.conf.get(name))
        raise RuntimeError("seen")

    monkeypatch.setattr(scoring, "read_parquet", stop)
    with pytest.raises(RuntimeError, match="seen"):
        scoring.run(spark, str(tmp_path), str(tmp_path), str(tmp_path), None)
    assert seen == ["8000"] and spark.conf.get(name) == before
