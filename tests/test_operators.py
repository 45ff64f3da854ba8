import decimal
import json
import math
import random
import statistics
import zipfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlake.functions import vectors
from rosterlake.operators import drift, evaluation, extraction, features, flatten, joins, ordered, payload, profile, quality, training
from rosterlake.operators.embedding import encode_lists, lookup_encoder, udf_encoder
from rosterlake.plans import curate, monitoring
from rosterlake.plans import training as training_plan
from rosterlake.sources import documents, keyed_json, schemas, tables


# ---------------------------------------------------------------------------------- ordered
def test_running_totals_with_a_hot_value(spark):
    draw = random.Random(5)
    rows = [(draw.choice("ab"), 7.0 if draw.random() < 0.35 else round(draw.gauss(0, 50), 1), draw.randint(0, 3)) for _ in range(4000)]
    df = spark.createDataFrame(rows + [("a", None, 1)], "k string, v double, s int")
    out = ordered.running_totals(df, "v", ["s"], ["k"], buckets=16).collect()
    for k in "ab":
        expected = {}
        for _, v, s in (r for r in rows if r[0] == k):
            expected[v] = expected.get(v, 0) + s
        got = sorted((r for r in out if r.k == k), key=lambda r: r.v)
        assert [r.v for r in got] == sorted(expected)
        total = 0
        for r, nxt in zip(got, [*sorted(expected)[1:], None]):
            total += expected[r.v]
            assert (r.s, r.s_upto, r.s_total, r.next_value) == (expected[r.v], total, sum(expected.values()), nxt)


@pytest.mark.parametrize("accuracy", [4, 50, 10_000])
def test_quantiles(spark, accuracy):
    draw = random.Random(accuracy)
    data = {k: [draw.choice([1.0, 2.0, draw.gauss(0, 1)]) for _ in range(n)] for k, n in (("a", 501), ("b", 2), ("c", 1), ("d", 40))}
    df = spark.createDataFrame([(k, x) for k, v in data.items() for x in v] + [("a", None), ("e", None)], "k string, v double")
    shares = {"lo": 0.0, "q1": 0.25, "q2": 0.5, "q3": 0.75, "hi": 1.0}
    got = {r.k: r for r in ordered.quantiles(df, "v", shares, ["k"], accuracy).collect()}
    assert set(got) == set(data)
    for k, v in data.items():
        quarters = statistics.quantiles(v, n=4, method="inclusive") if len(v) > 1 else v * 3
        assert [got[k].lo, got[k].q1, got[k].q2, got[k].q3, got[k].hi] == pytest.approx([min(v), *quarters, max(v)])
    whole = ordered.quantiles(df, "v", {"q2": 0.5}, accuracy=accuracy).collect()
    assert [r.q2 for r in whole] == pytest.approx([statistics.median([x for v in data.values() for x in v])])


@pytest.mark.parametrize("accuracy", [3, 10_000])
def test_quantiles_of_many_columns(spark, accuracy):
    draw = random.Random(2)
    rows = [(draw.choice([None, 2**60 + i, i]), draw.gauss(0, 1), None, Decimal(i % 7) / 4) for i in range(400)]
    df = spark.createDataFrame(rows, "i bigint, x double, none double, d decimal(10,2)")
    shares = {"a": 0.0, "b": 0.3, "c": 1.0}
    around = ordered.probes(shares, accuracy)
    made = {c: [r[k] for r in rows if r[k] is not None] for k, c in enumerate(df.columns)}
    sketches = {c: (len(v), df.selectExpr(f"percentile_approx(double({c}), array({','.join(map(str, around))}), {accuracy})").first()[0]) for c, v in made.items()}
    got = ordered.column_quantiles(df, profile.number_groups(df, df.columns), sketches, shares, accuracy)
    for c, v in made.items():
        for name, share in shares.items():
            v, at = sorted(v), share * (len(v) - 1)
            low, high = (float(v[k]) for k in (math.floor(at), math.ceil(at))) if v else (None, None)
            assert got[c][name] == (pytest.approx(low + (high - low) * (at % 1)) if v else None)
    # brackets that miss their ranks are opened
    assert ordered.column_quantiles(df, profile.number_groups(df, ["x"]), {"x": (400, [9.0] * 6)}, shares)["x"] == got["x"]


def test_quantiles_of_odd_columns(spark):
    big = spark.createDataFrame([(2**60 + i,) for i in range(9)], "v bigint")  # wider than a double
    assert ordered.quantiles(big, "v", {"q": 0.25}).first().q == float(2**60 + 2)
    nan = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (float("nan"),)], "v double")
    assert ordered.quantiles(nan, "v", {"q": 1 / 3}).first().q == 2.0
    assert ordered.quantiles(nan.where("v < 0"), "v", {"q": 0.5}).collect() in ([], [(None,)])


@pytest.mark.parametrize("buckets", [2, 13, 128])
def test_quantiles_of_counted_values(spark, buckets):
    draw = random.Random(buckets)
    data = [draw.choice([1.0, 2.0, draw.gauss(0, 1)]) for _ in range(501)]
    values = ordered.value_sums(spark.createDataFrame([(x, 1) for x in data], "v double, n int"), "v", ["n"])
    row = ordered.quantiles_of(values, "v", {"q1": 0.25, "q2": 0.5, "q3": 0.75, "hi": 1.0}, buckets=buckets).first()
    assert [row.q1, row.q2, row.q3] == pytest.approx(statistics.quantiles(data, n=4, method="inclusive"))
    assert row.hi == max(data) and row.n_values == len(set(data))


def test_profiles(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("", 2.0, None), (None, 100.0, None), ("a" * 100, 3.0, None)],
                               "s string, x double, z string")
    q = {r["column"]: r for r in profile.qualitative_profile(df).collect()}
    assert (q["s"].null_count, q["s"].n_unique, q["s"].min_len, q["s"].max_len) == (1, 4, 0, 100)
    assert (q["z"].null_percent, q["z"].n_unique, q["z"].min_len, q["z"].avg_len) == (100.0, 1, 0, 0.0)
    assert q["x"].min_len is None
    n = profile.numeric_profile(df).first()
    assert (n.median, n.outlier_count, n.n_unique) == (2.5, 1, 4)
    approximate = profile.numeric_profile(df, exact=False).first()
    assert approximate.n_unique == 4 and approximate.outlier_count == 1
    assert profile.distinct_counts(df, ["z"], exact=False).first().n_unique == 1


def test_schema_tree(spark):
    df = spark.createDataFrame([], "a string, s struct<x:int, l:array<struct<y:double>>>")
    assert flatten.schema_tree(df.schema) == {"a": "string", "s": {"x": "int", "l": {"list_of": {"y": "double"}}}}


def test_schema_profile(spark):
    schema = "a string, s struct<x:int, l:array<struct<y:double, z:array<string>>>>, `odd name` array<array<int>>"
    rows = [("v", (1, [(1.0, ["p", None]), (None, None), None]), [[1, None], None, [2, 3]]), (None, None, None), ("w", (None, []), [])]
    got = [tuple(r) for r in flatten.schema_profile(spark.createDataFrame(rows, schema)).collect()]
    assert got == [("a", "string", 2), ("s.x", "int", 1), ("s.l[].y", "double", 1), ("s.l[].z[]", "string", 1), ("odd name[][]", "int", 3)]
    assert [r.n_values for r in flatten.schema_profile(spark.createDataFrame([], schema)).collect()] == [0] * 5


def test_group_rare(spark):
    rows = [("hot",)] * 40 + [("nine",)] * 9 + [("ten",)] * 10 + [(None,)] * 3
    df = joins.group_rare(spark.createDataFrame(rows, "r string"), "r", "g")
    assert {r.g: r["count"] for r in df.groupBy("g").count().collect()} == {"hot": 40, "Outros": 9, "ten": 10, None: 3}
    filled = joins.group_rare(spark.createDataFrame(rows, "r string"), "r", "g", missing="Desconhecido")
    assert {r.g: r["count"] for r in filled.groupBy("g").count().collect()} == {"hot": 40, "Outros": 12, "ten": 10}


# ---------------------------------------------------------------------------------- quality
def test_schema_contract(spark):
    assert len(schemas.CURATED_JOB) == 44 and len(schemas.CURATED_PROSPECT) == 10 and len(schemas.CURATED_APPLICANT) == 45
    df = spark.createDataFrame([("1", "x"), (None, "y")], "id string, a string")
    good = T.StructType([T.StructField("id", T.StringType(), False), T.StructField("a", T.StringType())])
    assert [(r.id, r["column"]) for r in quality.schema_errors(df, good, "id").collect()] == [(None, "id")]
    with pytest.raises(ValueError, match="null in a required field"):
        quality.assert_schema(df, good, "t", "id")
    quality.assert_schema(df.where("id IS NOT NULL"), good, "t", "id")


def test_checks(spark):
    df = spark.createDataFrame([("a", 1), ("-", 5), (None, 9), ("a", 1)], "s string, n int")
    rows = {(r["column"], r.detail): r.n_rows for r in quality.check_required(df, ["s", "n", "absent"]).collect()}
    assert rows == {("s", "null, empty, blank or '-'"): 2, ("absent", "column is missing"): None}
    assert quality.check_duplicates(df, ["s", "n"]).first().n_rows == 2
    assert quality.count_duplicates(spark.createDataFrame([(None,), (None,), (1,)], "k int"), ["k"]).first().n_rows == 2
    assert [r.detail for r in quality.check_domain(df, "s", ["a"]).collect()] == ["-"]
    assert quality.check_pattern(df, "s", "[a-z]").first().n_rows == 1
    assert sorted(r.n_rows for r in quality.check_range(df, "n", 2, 6).collect()) == [1, 2]
    assert quality.check_cardinality(df, "n", 2).first().n_rows == 3
    assert quality.check_cardinality(df, "n", 3).isEmpty()


# ---------------------------------------------------------------------------------- sources
def raw_job(title):
    return {"informacoes_basicas": {"titulo_vaga": title, "data_requicisao": "04-05-2021"}, "perfil_vaga": {"nivel profissional": "Pleno"},
            "beneficios": {}}


def test_keyed_json_layouts(spark, tmp_path):
    for i in range(2):
        (tmp_path / f"jobs{i}.json").write_text(json.dumps({f"{i}": raw_job("Á"), f"{i}9": raw_job("b")}, indent=1), encoding="utf-8")
    df = keyed_json.read_keyed_json(spark, str(tmp_path), "codigo_vaga", schemas.RAW_JOB, "object_per_file")
    flat = flatten.flatten_nested(df)
    assert flat.columns == [f.name for f in schemas.CURATED_JOB.fields]
    assert sorted((r.codigo_vaga, r.ib_titulo_vaga, r.pv_nivel_profissional) for r in flat.collect()) == [
        ("0", "Á", "Pleno"), ("09", "b", "Pleno"), ("1", "Á", "Pleno"), ("19", "b", "Pleno")]
    (tmp_path / "l").mkdir()
    (tmp_path / "l" / "x.json").write_text(json.dumps([{"codigo_vaga": "7", **raw_job("t")}], indent=1))
    listed = keyed_json.read_keyed_json(spark, str(tmp_path / "l"), "codigo_vaga", schemas.RAW_JOB, "list")
    assert listed.first().codigo_vaga == "7"


def test_empty_and_null_children(spark):
    rows = [("1", []), ("2", None), ("3", [("x",), ("y",)])]
    df = spark.createDataFrame(rows, "codigo_vaga string, prospects array<struct<codigo:string>>")
    assert sorted((r.codigo_vaga, r.p_codigo or "") for r in flatten.flatten_nested(df).collect()) == [
        ("1", ""), ("2", ""), ("3", "x"), ("3", "y")]


def test_word_files(spark, tmp_path):
    body = ('<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body>'
            "<w:p><w:r><w:t>Olá</w:t></w:r><w:r><w:tab/><w:t>mundo</w:t></w:r></w:p><w:p/><w:p><w:r><w:t>fim</w:t></w:r></w:p>"
            "</w:body></w:document>")
    with zipfile.ZipFile(tmp_path / "cv.docx", "w") as z:
        z.writestr("word/document.xml", body)
    (tmp_path / "bad.DOC").write_bytes(b"nothing")
    (tmp_path / "a.txt").write_bytes("é".encode() + b"\xff!")
    (tmp_path / "b.png").write_bytes(b"x")
    out = {r.path.rsplit("/", 1)[1]: (r.kind, r.text, r.reason) for r in
           documents.parse_documents(documents.read_files(spark, str(tmp_path))).collect()}
    assert out == {"cv.docx": ("docx", "Olá\tmundo\n\nfim", None), "bad.DOC": ("docx", "", None), "a.txt": ("txt", "é!", None),
                   "b.png": (None, None, "unsupported file type")}


def test_files_are_bounded(spark, tmp_path):
    rows = spark.createDataFrame([("a.docx", ["x & <y>", "", " z\t"]), ("b.docx", ["é"] * 3)], "name string, lines array<string>")
    folder = str(tmp_path / "files")
    documents.write_files(rows.select("name", documents.word_file(F.col("lines")).alias("content")), folder)
    read = lambda **o: {r.path.split("/")[-1]: (r.text, r.reason) for r in documents.parse_documents(documents.read_files(spark, folder, **o)).collect()}
    assert read() == {"a.docx": ("x & <y>\n\n z\t", None), "b.docx": ("é\né\né", None)}
    assert read(max_bytes=10) == {"a.docx": (None, "file is too large"), "b.docx": (None, "file is too large")}
    bomb = documents._word_bytes(["x" * 100_000] * 20)
    assert len(bomb) < 10_000 and documents._paragraphs(bomb, 1_000_000) == "" and len(documents._paragraphs(bomb)) == 2_000_019



def test_missing_jsonl_is_empty(spark, tmp_path):
    assert tables.read_jsonl(spark, str(tmp_path / "none"), "a int").isEmpty()


def test_rows_table(spark):
    assert tables.rows_table(spark, [{"b": 2}, {"a": "x"}], "a string, b int").collect() == [(None, 2), ("x", None)]


# ------------------------------------------------------------------------------------ gates
def prospects_raw(spark, codes):
    child = {f: None for f in schemas.PROSPECT_ITEM_FIELDS}
    rows = [{"codigo_vaga": "1", "titulo": " t! ", "modalidade": None,
             "prospects": [{**child, "codigo": c, "data_candidatura": "01-02-2020"} for c in codes]}]
    return spark.createDataFrame(rows, schemas.with_id(schemas.RAW_PROSPECT, "codigo_vaga"))


def test_prospect_gate(spark, tmp_path):
    issues = str(tmp_path / "issues")
    df = curate.curate(prospects_raw(spark, ["5", " - ", "6"]), curate.PROSPECTS, issues)
    assert sorted(r.p_codigo for r in df.collect()) == ["5", "6"]
    log = spark.read.parquet(issues).first()
    assert log.n_rows == 1 and log.label == "prospects"
    with pytest.raises(curate.QualityError, match="DUPLICATE"):
        curate.curate(prospects_raw(spark, ["5", "5"]), curate.PROSPECTS)


# -------------------------------------------------------------------------------- extraction
def full_answer(kind):
    return json.dumps({f.name: ["x"] if isinstance(f.dataType, T.ArrayType) else "y" for f in extraction.SCHEMAS[kind].fields})


def test_retry_and_fallback(spark):
    good = full_answer("candidato")

    def main(prompt):
        if "boom" in prompt:
            raise RuntimeError("down")
        return good if "fine" in prompt else "{}"

    def spare(prompt):
        return "nope" if "boom" in prompt else "```json\n" + good + "\n```"

    prompts = spark.createDataFrame([("1", "fine"), ("2", "poor"), ("3", "boom")], "id string, prompt string")
    log = extraction.generate_answers(prompts, extraction.CANDIDATE_SCHEMA, [("main", main, 3), ("spare", spare, 1)], delay=0, tasks=2)
    tries = sorted((r.id, r.model, r.attempt, r.ok) for r in log.collect())
    assert tries == [("1", "main", 1, True), ("2", "main", 1, False), ("2", "main", 2, False), ("2", "main", 3, False),
                     ("2", "spare", 1, True), ("3", "main", 1, False), ("3", "main", 2, False), ("3", "main", 3, False), ("3", "spare", 1, False)]
    last = {r.id: (r.ok, r.dados.experiencia_anos) for r in extraction.last_answers(log, extraction.CANDIDATE_SCHEMA).collect()}
    assert last["1"] == (True, "y") and last["2"] == (True, "y") and last["3"][0] is False


def test_failed_ids_are_tried_again(spark, tmp_path):
    from rosterlake.plans.scoring import read_answers, run_extraction
    rows = spark.createDataFrame([("1", "10", "t", "cv"), ("2", "20", "t", "bad"), ("3", "3", "t", "cv")],
                                 "codigo_vaga string, codigo_candidato string, job_ib_titulo_vaga string, app_cv_pt string")
    job, person = full_answer("vaga"), full_answer("candidato")

    def generate(prompt):
        return "{}" if prompt.startswith("bad") else person if "principais" in prompt else job

    extract = extraction.generator_extract([("m", generate, 1)], delay=0)
    out = run_extraction(spark, rows, str(tmp_path), extract)
    assert sorted(r.codigo_candidato for r in out.collect()) == ["10", "3_cand"]
    out = run_extraction(spark, rows, str(tmp_path), extraction.generator_extract([("m", lambda p: person, 1)], delay=0))
    assert sorted(r.codigo_candidato for r in out.collect()) == ["10", "20", "3_cand"]
    assert {k: a.count() for k, a in read_answers(spark, str(tmp_path)).items()} == {"vaga": 3, "candidato": 3}


# ----------------------------------------------------------------------------------- payload
def vectors_for(words):
    return lambda texts: texts.withColumn("vector", F.array(*[(F.col("text") == w).cast("float") for w in words]))


def score(spark, rows, words, **options):
    shape = "request_id string, resume_text string, job_id string, job_description string, candidate_data string, job_data string"
    out = payload.score_requests(spark.createDataFrame(rows, shape), vectors_for(words), **options)
    return {r.request_id: r for r in out.collect()}


def test_payload_cases(spark):
    cand = json.dumps({"skills": {"technical_skills": ["Python"], "tools": ["SQL"], "soft_skills": ["Foco"]}})
    job = json.dumps({"requirements": {"required_tech_skills": ["Python", "Java"], "required_soft_skills": ["Foco"]}, "metadata": {"job_title": "t"}})
    rows = [("both", None, None, None, cand, job), ("nojob", None, None, None, cand, None), ("neither", "", None, None, None, None),
            ("enum", None, None, None, json.dumps({"profile": {"seniority_inferred": "boss"}}), None),
            ("title", None, None, None, cand, json.dumps({"metadata": {"location": "x"}})), ("json", None, None, None, "{oops", None),
            ("type", None, None, None, json.dumps({"skills": {"tools": "SQL"}}), None),
            ("known", None, "J1", None, cand, None), ("text", "Python e SQL", None, "Java", None, None)]
    jobs = spark.createDataFrame([("J1", ["SQL"], ["Foco"])], "codigo_vaga string, job_skills array<string>, job_culture array<string>")
    extract = extraction.keyword_extract({"competencias_tecnicas": ["Python", "Java"], "ferramentas_tecnologicas": ["SQL"]}, {})
    out = score(spark, rows, ["Python", "SQL", "Java", "Data Science", "Foco", "Proatividade"], extract=extract, jobs=jobs)
    assert (out["both"].score_skills, out["both"].score_cultural, out["both"].score_behavioral) == (0.5, 1.0, 0.5)
    assert out["nojob"].fallback_used and out["nojob"].score_skills == 0.5
    assert out["known"].score_skills == 1.0 and not out["known"].fallback_used
    assert out["text"].score_skills == 0.0 and out["text"].score_cultural == 0.5
    reasons = {k: out[k].reason for k in ("neither", "enum", "title", "json", "type")}
    assert reasons == {"neither": "resume_text or candidate_data is required", "enum": "unknown seniority_inferred",
                       "title": "job_title is required", "json": "invalid candidate_data", "type": "invalid candidate_data"}
    assert all(out[k].score_skills is None for k in reasons)


def test_encode_lists(spark):
    df = spark.createDataFrame([("1", ["a", "", "b"], []), ("2", None, ["a"])], "k string, x array<string>, y array<string>")
    known = spark.createDataFrame([("a", [1.0]), ("b", [2.0])], "text string, vector array<double>")
    out = {r.k: r for r in encode_lists(df, "k", {"x": "vx", "y": "vy"}, lookup_encoder(known)).collect()}
    assert sorted(out["1"].vx) == [[1.0], [2.0]] and out["1"].vy == [] and out["2"].vx == [] and out["2"].vy == [[1.0]]
    lengths = encode_lists(df, "k", {"x": "vx"}, udf_encoder(lambda c: F.array(F.length(c).cast("float"))))
    assert {r.k: r.vx for r in lengths.collect()}["1"] == [[1.0], [1.0]]


# ------------------------------------------------------------------------------------- drift
def test_drift_pair(spark):
    draw = random.Random(7)
    def rows(n, center, letters):
        return [(draw.expovariate(1 / center), draw.triangular(-3, 9, 2), draw.choice(letters), draw.randint(0, 50), 1.0, None) for _ in range(n)]
    shape = "moved double, steady double, group string, number int, same double, empty double"
    reference, current = spark.createDataFrame(rows(700, 3, "uvw"), shape), spark.createDataFrame(rows(900, 6, "uvwz"), shape)
    out = {r["column"]: r for r in drift.column_drift(reference, current, test="p_value").collect()}
    assert out["moved"].drifted and out["moved"].test == "ks"
    assert out["group"].drifted and out["group"].score == 0.0 and math.isinf(out["group"].statistic)
    assert not out["steady"].drifted and not out["number"].drifted and not out["same"].drifted
    assert (out["empty"].status, out["empty"].drifted, out["empty"].score) == ("no_values", False, None)
    far = {r["column"]: r for r in drift.column_drift(reference, current).collect()}
    assert far["moved"].drifted and far["moved"].test == "wasserstein" and far["group"].test == "jensen_shannon"
    share = drift.dataset_drift(drift.column_drift(reference, current, ["moved", "steady", "group", "number"], test="p_value")).first()
    assert (share.drift_share, share.dataset_drift, share.alert) == (0.5, True, True)
    psi = {r["column"]: r for r in drift.population_stability(reference, current, ["moved", "steady"]).collect()}
    assert psi["moved"].alert and not psi["steady"].alert


@pytest.mark.parametrize("test", ["distance", "p_value"])
def test_drift_with_one_empty_side(spark, test):
    full = spark.createDataFrame([("a", 1.0, 5), ("b", 2.0, 5)], "c string, x double, k int")
    bare = spark.createDataFrame([(None, None, None)], "c string, x double, k int")
    for reference, current in ((full, bare), (bare, full)):
        out = drift.column_drift(reference, current, test=test, categorical=["k"]).collect()
        assert {r["column"]: (r.status, r.drifted, r.score) for r in out} == {n: ("one_sided", True, None) for n in "cxk"}
    with pytest.raises(ValueError, match="unknown test"):
        drift.column_drift(full, full, test="size")


def test_numbers_above_double_precision(spark):
    ids = spark.createDataFrame([(2**53 + i, decimal.Decimal(2**60 + i)) for i in range(10)], "n bigint, d decimal(30,0)")
    out = {r["column"]: r for r in profile.numeric_profile(ids).collect()}
    assert out["n"].n_unique == out["d"].n_unique == 10
    measured = {r["column"]: r for r in drift.numeric_drift(ids.where(f"n < {2**53 + 5}"), ids, ["n", "d"]).collect()}
    assert measured["n"].n_values == measured["d"].n_values == 10 and measured["n"].ks == pytest.approx(0.5)


def test_split_keeps_every_row(spark):
    rows = [(None if i % 3 else i, i, None if i % 5 == 0 else i % 2) for i in range(1000)]
    df = spark.createDataFrame(rows, "k bigint, x int, y int")
    for bits in (2, 12):
        out = training.stratified_split(df, "k", "y", bits=bits)
        assert out.columns == ["k", "x", "y", "is_test"]
        found = {r.y: (r.n, r.t) for r in out.groupBy("y").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect()}
        assert found == {None: (200, 40), 0: (400, 80), 1: (400, 80)} and out.select("x").distinct().count() == 1000
    weights = {r.y: r.weight for r in training.balanced_weight(df, "y").collect()}
    assert weights == pytest.approx({None: 1000 / 600, 0: 1000 / 1200, 1: 1000 / 1200})
    many = spark.range(3000).selectExpr("id AS k", "id % 1500 AS y")
    assert training.balanced_weight(many, "y").where("weight = 1").count() == 3000 and training.stratified_split(many, "k", "y").count() == 3000


def test_search_space():
    model = training.boosted_trees("y", maxBins=128)
    assert model.getMaxBins() == 128
    draws = training.random_params(model, 50)
    assert all(50 <= d[model.maxIter] < 300 and 4 <= d[model.maxDepth] <= 6 for d in draws)


def test_broken_keyed_json_is_an_error(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"1": raw_job("x")}))
    (tmp_path / "b.json").write_text('{"3": {"perfil_vaga": {}}, "4": {"perfil')
    for layout in ("object_per_file", "list", "lines"):
        with pytest.raises(Exception, match="MALFORMED|malformed|Malformed|FAILED_READ_FILE"):
            keyed_json.read_keyed_json(spark, str(tmp_path), "codigo_vaga", schemas.RAW_JOB, layout).collect()


def test_requests_are_scored_apart(spark):
    cand = lambda skill: json.dumps({"skills": {"technical_skills": [skill]}})
    job = json.dumps({"requirements": {"required_tech_skills": ["Python"]}, "metadata": {"job_title": "t"}})
    shape = "request_id string, resume_text string, job_id string, job_description string, candidate_data string, job_data string"
    rows = [("same", None, None, None, cand("Python"), job), ("same", None, None, None, cand("Java"), job),
            ("same", None, None, None, cand("Java"), job), (None, None, None, None, cand("Python"), job)]
    out = payload.score_requests(spark.createDataFrame(rows, shape), vectors_for(["Python", "Java"])).collect()
    assert sorted((r.request_id or "", r.status, r.reason or "", r.score_skills if r.score_skills is not None else -1) for r in out) == [
        ("", "rejected", "request_id is required", -1), ("same", "ok", "", 0.0), ("same", "ok", "", 0.0), ("same", "ok", "", 1.0)]


def test_schema_errors_are_all_kept(spark, tmp_path):
    df = spark.createDataFrame([(None, str(i)) for i in range(60)], "id string, a string")
    contract = T.StructType([T.StructField("id", T.StringType(), False), T.StructField("a", T.StringType())])
    with pytest.raises(ValueError, match="60 errors"):
        quality.assert_schema(df, contract, "t", "id", str(tmp_path / "errors"))
    assert spark.read.parquet(str(tmp_path / "errors")).count() == 60


def test_kernel_block_limits(monkeypatch):
    import numpy as np
    import pyarrow as pa
    rng = np.random.default_rng(1)
    lists = lambda: pa.array([rng.standard_normal((int(n), 4)).tolist() for n in rng.integers(0, 9, 40)], pa.list_(pa.list_(pa.float32())))
    a, b = lists(), lists()
    whole = vectors._mean_best(a, b, None, 0.5).to_pylist()
    for cells in (1, 300, 5000):
        monkeypatch.setattr(vectors, "CELLS", cells)
        assert vectors._mean_best(a, b, None, 0.5).to_pylist() == pytest.approx(whole)


def test_p_values():
    assert drift._chi2_p(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-9)
    assert drift._chi2_p(18.307038053275146, 10) == pytest.approx(0.05, abs=1e-9)
    assert drift._chi2_p(2.0, 4) == pytest.approx(2 * math.exp(-1), abs=1e-12)
    assert drift._normal_p(1.959963984540054) == pytest.approx(0.05, abs=1e-9)
    assert drift._ks_p(0.0, 10, 10) == 1.0 and drift._ks_p(0.9, 100, 100) < 1e-9


def test_report_skips_empty_side(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    row = monitoring.drift_report(df, df.where("false"), None, F.lit("d")).first()
    assert (row.status, row.drift_share, row.alert) == ("skipped", 0.0, False)


# ---------------------------------------------------------------------------------- training
def test_stratified_split_is_exact(spark):
    df = spark.createDataFrame([(i, i % 10 == 0) for i in range(1234)], "id int, y boolean")
    out = training.stratified_split(df, "id", "y", bits=4).groupBy("y").agg(F.count_if("is_test").alias("t"), F.count("*").alias("n")).collect()
    assert all(r.t == round(0.2 * r.n) for r in out) and sum(r.n for r in out) == 1234


def test_auc_and_report(spark):
    draw = random.Random(9)
    rows = [(draw.randint(0, 8) / 8, draw.randint(0, 1)) for _ in range(300)]
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    expected = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg)
    df = spark.createDataFrame(rows, "s double, y int")
    assert evaluation.roc_auc(df, "s", "y").first()[0] == pytest.approx(expected)
    assert evaluation.roc_auc(df.where("y = 1"), "s", "y").first()[0] is None
    report = {r.label: r for r in evaluation.classification_report(df.withColumn("p", F.lit(0)), "y", "p").collect()}
    assert report[1].precision == 0.0 and report[0].recall == 1.0


def test_train_log_export(spark, tmp_path):
    draw = random.Random(1)
    rows = [(i, float(draw.random()), draw.choice(["a", "b"])) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, x double, c string").withColumn("engajado", (F.col("x") > 0.6).cast("int"))
    runs, models = str(tmp_path / "runs"), str(tmp_path / "models")
    metrics = training_plan.train_and_log(spark, df, "id", runs, models, "t", ["x", "absent"], ["c"], maxIter=2)
    assert metrics["roc_auc"] > 0.95
    training.log_run(spark, runs, "worse", {}, {"roc_auc": 0.1})
    training.log_run(spark, runs, "none", {}, {})
    run_id = training.export_best_model(spark, runs, str(tmp_path / "best"))
    best = training.best_run(spark.read.parquet(runs)).first()
    assert best.run_name == "t" and best.run_id == run_id and (tmp_path / "best").exists()


def test_retrain_gate(spark, tmp_path):
    jobs = spark.createDataFrame([("1",), ("2",)], "codigo_vaga string")
    calls, state = [], str(tmp_path / "state")
    assert training_plan.retrain_if_new(spark, jobs, state, lambda: calls.append(1))
    assert not training_plan.retrain_if_new(spark, jobs, state, lambda: calls.append(2))
    more = jobs.unionAll(spark.createDataFrame([("3",)], "codigo_vaga string"))
    with pytest.raises(RuntimeError):
        training_plan.retrain_if_new(spark, more, state, lambda: (_ for _ in ()).throw(RuntimeError()))
    assert training_plan.retrain_if_new(spark, more, state, lambda: calls.append(3))
    assert calls == [1, 3]


def test_built_features_run_once(spark):
    assert features.build_features(spark.createDataFrame([("1",)], "codigo_vaga string")).columns == ["codigo_vaga"]
