import json

from pyspark.sql import functions as F

from rosterlake.operators import extraction
from rosterlake.plans.scoring import read_answers
from rosterlake.streaming import jobs


def test_score_stream(spark, tmp_path):
    shape = "request_id string, candidate_data string, job_data string"
    cand = json.dumps({"skills": {"technical_skills": ["Python"]}})
    source = str(tmp_path / "in")
    spark.createDataFrame([("1", cand, None), ("2", "{oops", None)], shape).write.parquet(source)
    stream = spark.readStream.schema(shape).parquet(source)
    assert jobs.parsed_requests(stream).isStreaming
    encode = lambda texts: texts.withColumn("vector", F.array((F.col("text") == "Python").cast("float"), F.lit(1.0).cast("float")))
    query = jobs.score_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp"), encode).trigger(availableNow=True).start()
    query.awaitTermination(120)
    out = {r.request_id: r.status for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert out == {"1": "ok", "2": "rejected"}


def test_extraction_stream_skips_done_ids(spark, tmp_path):
    shape = "codigo_vaga string, codigo_candidato string, job_ib_titulo_vaga string, app_cv_pt string"
    source, folder, out = (str(tmp_path / n) for n in ("in", "state", "out"))
    extract = extraction.keyword_extract({"ferramentas_tecnologicas": ["SQL"]}, {})
    for rows in ([("1", "10", "SQL", "cv sql")], [("1", "11", "SQL", "cv"), ("2", "10", "x", "cv sql")]):
        spark.createDataFrame(rows, shape).write.mode("append").parquet(source)
        stream = spark.readStream.schema(shape).parquet(source)
        jobs.extraction_stream(stream, folder, out, str(tmp_path / "cp"), extract).trigger(availableNow=True).start().awaitTermination(120)
    assert spark.read.parquet(out).count() == 3
    assert {k: a.count() for k, a in read_answers(spark, folder).items()} == {"vaga": 2, "candidato": 2}
