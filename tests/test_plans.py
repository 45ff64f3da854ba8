"""Raw files to scored pairs, end to end."""

import json

import pytest
from pyspark.sql import functions as F

from rosterlake.operators import extraction
from rosterlake.operators.embedding import lookup_encoder
from rosterlake.plans import curate, scoring
from rosterlake.sources import keyed_json, schemas

JOBS = {
    "10": {"informacoes_basicas": {"titulo_vaga": "Analista  SQL!", "prioridade_vaga": "Alta: Urgente", "data_requicisao": "01-01-2021",
                                   "data_inicial": "05-01-2021", "data_final": "31-02-2021", "tipo_contratacao": "CLT Full, "},
           "perfil_vaga": {"cidade": "São Paulo", "nivel profissional": "Pleno", "nivel_academico": "Ensino Superior Completo",
                           "nivel_ingles": "Avançado", "vaga_especifica_para_pcd": "Sim",
                           "principais_atividades": "Python e SQL, com liderança", "areas_atuacao": "TI - Dados-"},
           "beneficios": {"valor_venda": "-"}},
    "11": {"informacoes_basicas": {}, "perfil_vaga": {}, "beneficios": {}},
}
PROSPECTS = {
    "10": {"titulo": "a", "modalidade": "", "prospects": [
        {"nome": "X", "codigo": "1", "situacao_candidado": "Aprovado", "data_candidatura": "10-01-2021", "ultima_atualizacao": "12-01-2021",
         "comentario": "Candidato motivado", "recrutador": "Ana"},
        {"nome": "Y", "codigo": "404", "data_candidatura": "01-02-2021"}, {"nome": "Z", "codigo": " - "}]},
    "11": {"titulo": "b", "modalidade": None, "prospects": []},
}
APPLICANTS = {
    "1": {"infos_basicas": {"nome": "Fulano", "local": "SAO PAULO", "telefone": "1", "data_criacao": "03-01-2021 10:00:00"},
          "informacoes_pessoais": {"cpf": "1", "pcd": "Sim", "email": "a@b.c"}, "informacoes_profissionais": {"nivel_profissional": "Sênior"},
          "formacao_e_idiomas": {"nivel_academico": "Pós-graduação", "nivel_ingles": "Avançado"}, "cargo_atual": {},
          "cv_pt": "Experiência em Python. Liderança.", "cv_en": ""},
    "2": {"infos_basicas": {"nome": "Sem vaga"}, "informacoes_pessoais": {}, "informacoes_profissionais": {}, "formacao_e_idiomas": {}},
}
TERMS = {"ferramentas_tecnologicas": ["PYTHON", "SQL"], "competencias_comportamentais": ["LIDERANÇA"]}


@pytest.fixture(scope="module")
def curated(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    tables = []
    for name, data, key, record in (("jobs", JOBS, "codigo_vaga", schemas.RAW_JOB), ("prospects", PROSPECTS, "codigo_vaga", schemas.RAW_PROSPECT),
                                    ("applicants", APPLICANTS, "codigo_candidato", schemas.RAW_APPLICANT)):
        (folder / f"{name}.json").write_text(json.dumps(data, ensure_ascii=False, indent=2), encoding="utf-8")
        tables.append(keyed_json.read_keyed_json(spark, str(folder / f"{name}.json"), key, record, "object_per_file"))
    target = str(folder / "curated")
    curate.curate_all(*tables, target, str(folder / "issues"))
    return target


def test_curated_tables(spark, curated):
    job = spark.read.parquet(f"{curated}/jobs.parquet").where("codigo_vaga = '10'").first()
    assert (job.ib_titulo_vaga, job.ib_prioridade_vaga, job.ib_data_final, str(job.ib_data_inicial)) == ("ANALISTA SQL", "ALTA: URGENTE", None, "2021-01-05")
    prospects = spark.read.parquet(f"{curated}/prospects.parquet")
    assert sorted(r.p_codigo for r in prospects.collect()) == ["1", "404"]
    assert len(spark.read.parquet(f"{curated}/applicants.parquet").columns) == 45


def test_scored_pairs(spark, curated, tmp_path):
    known = spark.createDataFrame([("PYTHON", [1.0, 0.0]), ("SQL", [0.0, 1.0]), ("LIDERANÇA", [1.0, 1.0])], "text string, vector array<double>")
    out = scoring.run(spark, curated, str(tmp_path / "store"), str(tmp_path / "scored"), extraction.keyword_extract(TERMS, {}),
                      lookup_encoder(known)).collect()
    assert len(out) == 1
    row = out[0]
    assert (row.codigo_vaga, row.codigo_candidato, row.job_ib_prioridade_vaga) == ("10", "1", "ALTA")
    assert (row.ind_app_telefone, row.ind_app_email, row.ind_mesma_localidade, row.match_pcd) == (True, False, True, True)
    assert row.job_ib_tipo_contratacao_cleaned_list == ["CLT FULL"] and row.job_pv_areas_atuacao_cleaned_list == ["TI", "DADOS"]
    assert (row.tempo_entre_job_inicial_e_candidatura, row.tempo_entre_criacao_e_candidatura, row.vaga_em_aberto_no_momento) == (5, 6, -1)
    assert row.score_skills == pytest.approx(0.7 * 0.5 + 0.3 * 1.0)
    assert (row.score_behavioral, row.score_cultural) == (0.9, pytest.approx(1.0))
    assert not {"app_ip_cpf", "p_nome", "app_ib_nome", "app_ib_telefone"} & set(row.asDict())


def test_answer_log(spark, tmp_path):
    log = str(tmp_path / "log")
    sources = spark.createDataFrame([("1", "cv"), ("2", "cv")], "id string, source string")
    extract = extraction.generator_extract([("m", lambda prompt: "{}", 2)], delay=0, log_path=log)
    assert extract(sources, "candidato").where("NOT ok").count() == 2
    rows = spark.read.parquet(log)
    assert rows.where("kind = 'candidato'").groupBy("id").agg(F.count("*").alias("n")).collect()[0].n == 2


def test_gate_publishes_by_rename(spark, tmp_path):
    from test_operators import prospects_raw
    target = str(tmp_path / "prospects.parquet")
    curate.curate(prospects_raw(spark, ["5", "6", None]), curate.PROSPECTS, target=target)
    curate.curate(prospects_raw(spark, ["7", "8", "9"]), curate.PROSPECTS, target=target)
    with pytest.raises(curate.QualityError, match="2 rows"):  # the table stays as it was
        curate.curate(prospects_raw(spark, ["1", "1"]), curate.PROSPECTS, target=target)
    assert sorted(r.p_codigo for r in spark.read.parquet(target).collect()) == ["7", "8", "9"]
    assert [p.name for p in tmp_path.iterdir()] == ["prospects.parquet"]
    # keys that only cleaning makes alike are not duplicates
    assert curate.curate(prospects_raw(spark, ["a", "A"]), curate.PROSPECTS).count() == 2


def test_gate_reports_contract_errors(spark, tmp_path):
    raw = spark.createDataFrame([(None, "t", None, [])], schemas.with_id(schemas.RAW_PROSPECT, "codigo_vaga"))
    with pytest.raises(ValueError, match="required columns|schema check"):
        curate.curate(raw.drop("codigo_vaga"), curate.PROSPECTS)


def test_fitted_behaviour(spark, tmp_path):
    from rosterlake.operators import scoring as scores
    from rosterlake.operators import training
    rows = [(i, float(i % 7), 5.0, ["ANA", "RUI", "EVA", None][i % 4], int(i % 7 > 3 or i % 4 == 1)) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, x double, flat double, who string, y int")
    model, _ = training.train(df.where("who IS NULL OR who <> 'EVA'"), "y", ["x", "flat"], ["who"], kind="linear")
    scored = training.score_probability(model, df).withColumn("own", training.linear_expression(model)).collect()  # EVA was never seen
    assert all(r.probability_1 == pytest.approx(r.own, abs=1e-9) for r in scored)
    assert {r.predicted == r.y for r in scored if r.who == "ANA"} == {True}
    only, _ = training.train(df, "y", [], ["who"], kind="linear")
    assert all(r.a == pytest.approx(r.b) for r in training.score_probability(only, df, "a").withColumn("b", training.linear_expression(only)).collect())
    # the exported model takes the place of the heuristic; without one the heuristic stays
    path = str(tmp_path / "exported")
    assert training.exported_model(spark, path) is None
    fitted, _ = training.train(df.withColumns({"p_recrutador_tratado": F.lit("outros"), "contem_palavra_chave_negativa": F.col("x")}), "y",
                               ["contem_palavra_chave_negativa"], ["p_recrutador_tratado"], kind="linear")
    fitted.write().save(path)
    pairs = df.select("id", F.lit("BOM PERFIL, INTERESSADO").alias("p_comentario"), F.lit("ana").alias("p_recrutador"))
    by_model = scores.behaviour_score(pairs, training.exported_model(spark, path))
    assert by_model.columns == [*pairs.columns, "score_behavioral"] and by_model.first().p_recrutador == "ana"
    assert by_model.first().score_behavioral < 0.5 and scores.behaviour_score(pairs).first().score_behavioral == 0.9
