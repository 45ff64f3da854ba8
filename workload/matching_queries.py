"""Scores, embeddings, extraction, payloads and their plans."""

from __future__ import annotations

import json
import re
import sys

from pyspark.sql import Window
from pyspark.sql import functions as F

from rosterlake.functions import matching, text, vectors
from rosterlake.operators import embedding, extraction, payload, scoring, terms
from rosterlake.operators.tfidf import Tfidf
from rosterlake.operators.joins import prefix_columns
from rosterlake.plans import scoring as scoring_plan
from rosterlake.session import scratch_path, ship_with_tasks, store
from rosterlake.sources import tables

from .base import CURATED_SQL, JOINED_SQL, WORD, applicants, joined, jobs, prospects, query, r, table
from .text_queries import sql_level, sql_sentiment


# the weights that both sides use
WEIGHTS = dict(matching.BASELINE_WEIGHTS)
TECHNICAL = dict(matching.TECHNICAL_WEIGHTS)


# --------------------------------------------------------------------------------- vectors
# A job's list is cut from one vector, a candidate's list from the next vector, 8 numbers each;
# every tenth list is empty. Nothing is grouped.
def slices(column, first, last):
    return F.transform(F.sequence(F.lit(first), F.lit(last)), lambda i: F.slice(column, i * 8 + 1, F.lit(8)))


def vector_pairs(spark, sf):
    e = table(spark, sf, "embeddings")
    empty = F.array().cast("array<array<float>>")
    need = e.select("vec_id", F.when(F.col("vec_id") % 10 == 0, empty).otherwise(slices(F.col("embedding"), 0, 3)).alias("need"),
                    F.col("embedding").alias("a"))
    have = e.select((F.col("vec_id") - 1).alias("vec_id"), F.when(F.col("vec_id") % 10 == 5, empty)
                    .otherwise(slices(F.col("embedding"), 2, 7)).alias("have"), F.col("embedding").alias("b"))
    return need.join(have, "vec_id")


def sql_slices(first, last):
    return "[" + ", ".join(f"embedding[{i * 8 + 1}:{i * 8 + 8}]::double[]" for i in range(first, last + 1)) + "]"


PAIRS_SQL = f"""need AS (SELECT vec_id, CASE WHEN vec_id % 10 = 0 THEN [] ELSE {sql_slices(0, 3)} END AS need, embedding::double[] AS a FROM embeddings),
    have AS (SELECT vec_id - 1 AS vec_id, CASE WHEN vec_id % 10 = 5 THEN [] ELSE {sql_slices(2, 7)} END AS have, embedding::double[] AS b FROM embeddings),
    pairs AS (SELECT *, [list_max([list_cosine_similarity(x, y) for y in have]) for x in need] AS best FROM need JOIN have USING (vec_id))"""


def sql_mean_best(threshold, empty):
    best = f"[CASE WHEN z >= {threshold} THEN z ELSE 0.0 END for z in best]" if threshold else "best"
    return f"CASE WHEN len(need) = 0 OR len(have) = 0 THEN {empty}::double ELSE list_avg({best}) END"


@query("cosine_pairs", "M5,J10", f"""
    WITH {PAIRS_SQL} SELECT vec_id, round(list_cosine_similarity(a, b), 6) AS similarity FROM pairs""")
def _(spark, sf):
    return vector_pairs(spark, sf).select("vec_id", F.round(vectors.cosine(F.col("a"), F.col("b")), 6).alias("similarity"))


@query("skill_similarity", "M1,X2", f"""
    WITH {PAIRS_SQL} SELECT vec_id, round({sql_mean_best(0.3, 0.0)}, 6) AS score FROM pairs""")
def _(spark, sf):
    return vector_pairs(spark, sf).select(
        "vec_id", F.round(scoring.skill_similarity(F.col("need"), F.col("have"), 0.3), 6).alias("score"))


@query("culture_similarity", "M8,M9", f"""
    WITH {PAIRS_SQL} SELECT 'c' || vec_id AS codigo_candidato, vec_id::varchar AS codigo_vaga, round({sql_mean_best(None, 0.5)}, 6) AS score_cultural FROM pairs""")
def _(spark, sf):
    df = vector_pairs(spark, sf).select(
        F.concat(F.lit("c"), "vec_id").alias("codigo_candidato"), F.col("vec_id").cast("string").alias("codigo_vaga"), "need", "have")
    return scoring.cultural_scores(df, "need", "have").withColumn("score_cultural", r("score_cultural"))


def sql_ratio(job, candidate):
    j, c = sql_level(job), sql_level(candidate)
    return f"(CASE WHEN ({j}) = 0 THEN 1.0 WHEN ({c}) = 0 THEN 0.0 ELSE least(({c})::double / ({j}), 1.0) END)::double"


PROFESSIONAL = sql_ratio("job_pv_nivel_profissional", "app_ip_nivel_profissional")
ACADEMIC = sql_ratio("job_pv_nivel_academico", "app_fei_nivel_academico")
ENGLISH = sql_ratio("job_pv_nivel_ingles", "app_fei_nivel_ingles")
STRUCTURED = f"({PROFESSIONAL} * 0.6::double + {ACADEMIC} * 0.2::double + {ENGLISH} * 0.2::double)"


@query("structured_score", "M2,M3,F26,X1", f"""
    WITH {JOINED_SQL} SELECT codigo_vaga, codigo_candidato, linha, round({PROFESSIONAL}, 6) AS score_senioridade, round({ACADEMIC}, 6) AS score_academico,
      round({ENGLISH}, 6) AS score_ingles, round({STRUCTURED}, 6) AS structured_match_score FROM joined""")
def _(spark, sf):
    return scoring.structured_columns(joined(spark, sf)).select(
        "codigo_vaga", "codigo_candidato", "linha", r("score_senioridade"), r("score_academico"), r("score_ingles"),
        r("structured_match_score"))


@query("weighted_totals", "M4,M6,M7", f"""
    WITH {PAIRS_SQL}, s AS (SELECT vec_id, {sql_mean_best(0.3, 0.0)} AS soft, (vec_id % 5) / 4.0::double AS st, list_cosine_similarity(a, b) AS cs FROM pairs)
    SELECT vec_id, round(0.7::double * soft + 0.3::double * st, 6) AS total, round(0.4::double * st + 0.6::double * cs, 6) AS baseline,
      round(0.6::double * soft + 0.15::double * st + 0.25::double * cs, 6) AS technical FROM s""")
def _(spark, sf):
    df = vector_pairs(spark, sf).select(
        "vec_id", scoring.skill_similarity(F.col("need"), F.col("have"), 0.3).alias("soft"),
        ((F.col("vec_id") % 5) / 4.0).alias("st"), vectors.cosine(F.col("a"), F.col("b")).alias("cs"))
    soft, st, cs = F.col("soft"), F.col("st"), F.col("cs")
    return df.select("vec_id", F.round(scoring.total_skill_score(soft, st), 6).alias("total"),
                     F.round(scoring.baseline_technical(st, cs), 6).alias("baseline"),
                     F.round(scoring.weighted_technical(soft, st, cs), 6).alias("technical"))


@query("behavioural_score", "M11,F20,F21,P8", f"""
    WITH {JOINED_SQL} SELECT codigo_candidato, codigo_vaga, CASE {sql_sentiment('p_comentario', text.SENTIMENT_SCORING)}
      WHEN 1 THEN 0.9 WHEN -1 THEN 0.2 ELSE 0.5 END::double AS score_behavioral FROM joined""")
def _(spark, sf):
    return scoring.behavioural_scores(joined(spark, sf))


OVERLAP_SQL = """
    WITH s AS (SELECT l_orderkey, l_linenumber, string_split(p.p_name, ' ') AS have, string_split(q.p_name, ' ') AS need, [p.p_type] AS have2, [q.p_type] AS need2,
        p.p_brand = q.p_brand AS same, p.p_size > 25 AS degree
      FROM lineitem JOIN part p ON l_partkey = p.p_partkey JOIN part q ON l_suppkey = q.p_partkey),
    m AS (SELECT *, len(list_intersect(have, need))::double / len(need) AS tools, len(list_intersect(have2, need2))::double AS tech FROM s),
    t AS (SELECT *, tools * 0.4::double + tech * 0.4::double + CASE WHEN same THEN 1.0 ELSE 0.5 END * 0.1::double + CASE WHEN degree THEN 0.1 ELSE 0.0 END::double AS technical FROM m)
    SELECT l_orderkey, l_linenumber, round(technical * 100, 2) AS score_tecnico, round(tools * 100, 2) AS score_cultural,
      round((technical * 0.7::double + tools * 0.3::double) * 100, 2) AS score_final FROM t"""


@query("overlap_score", "M12,U4", OVERLAP_SQL)
def _(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", F.split("p_name", " ").alias("words"), F.array("p_type").alias("kind"), "p_brand", "p_size")
    df = (table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
          .join(part.toDF("l_partkey", "have", "have2", "brand", "size"), "l_partkey")
          .join(part.toDF("l_suppkey", "need", "need2", "brand2", "size2"), "l_suppkey"))
    tools = matching.list_coverage(F.col("have"), F.col("need"))
    scores = matching.overlap_scores(tools, matching.list_coverage(F.col("have2"), F.col("need2")),
                                     F.col("brand") == F.col("brand2"), F.col("size") > 25, tools)
    return df.select("l_orderkey", "l_linenumber", *[c.alias(n) for n, c in scores.items()])


@query("tiers_kmeans", "M13,W1,A3", """
    SELECT unnest([0, 1, 2]) AS tier, (SELECT count(*) FROM customer) AS total, true AS above_previous""")
def _(spark, sf):
    """Clusters depend on their start, but tiers always split the scores into ascending ranges."""
    df = table(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").alias("score"))
    tiers = scoring.add_tiers(df, "score").groupBy("tier").agg(
        F.count("*").alias("n"), F.min("score").alias("low"), F.max("score").alias("high"))
    by_tier = Window.orderBy("tier")
    return tiers.select("tier", F.sum("n").over(Window.partitionBy()).alias("total"),
                        F.coalesce(F.col("low") > F.lag("high").over(by_tier), F.lit(True)).alias("above_previous"))


# An encoder that SQL can repeat: how often each of a few letters occurs in the text.
LETTERS = "aeiorstnADMO "


def letter_encoder(texts):
    count = lambda c: (F.length("text") - F.length(F.replace(F.col("text"), F.lit(c), F.lit("")))).cast("float")
    return texts.withColumn("vector", F.array(*[count(c) for c in LETTERS]))


def sql_letters(x: str) -> str:
    return "[" + ", ".join(f"(length({x}) - length(replace({x}, '{c}', '')))::double" for c in LETTERS) + "]"


def sql_letter_cosine(a: str, b: str) -> str:
    """Null if one side is missing or holds none of the letters."""
    return (f"CASE WHEN list_sum({sql_letters(a)}) > 0 AND list_sum({sql_letters(b)}) > 0 "
            f"THEN list_cosine_similarity({sql_letters(a)}, {sql_letters(b)}) END")


@query("text_embedding", "M14,M5", f"""
    SELECT a.conv_id, a.turn, round({sql_letter_cosine('a.text', 'b.text')}, 5) AS similarity, a.text = b.text AS same_text
    FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1""")
def _(spark, sf):
    """Similarity of every turn with the next turn of its conversation."""
    c = table(spark, sf, "conversations")
    nxt = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reply"))
    df = c.select("conv_id", "turn", "text").join(nxt, ["conv_id", "turn"])
    out = terms.text_similarity(df, "text", "reply", "similarity", letter_encoder)
    return out.select("conv_id", "turn", r("similarity", 5), (F.col("text") == F.col("reply")).alias("same_text"))


def sql_tfidf(texts: str) -> str:
    """CTEs over ``texts`` (a query of one column ``t``): ``wt`` (t, word, weight) holds the unit vectors of its distinct texts."""
    return f"""tx AS (SELECT DISTINCT t FROM ({texts}) WHERE t IS NOT NULL),
    tw AS (SELECT t, word, count(*) AS times FROM (SELECT t, unnest(string_split_regex(lower(t), '[^{WORD}]+')) AS word FROM tx) WHERE word <> '' GROUP BY ALL),
    ti AS (SELECT word, ln(((SELECT count(*) FROM tx) + 1.0::double) / (count(*) + 1)) AS idf FROM tw GROUP BY word),
    tu AS (SELECT t, word, times * idf AS w FROM tw JOIN ti USING (word) WHERE idf > 0),
    wt AS (SELECT t, word, w / sqrt(sum(w * w) OVER (PARTITION BY t)) AS weight FROM tu)"""


def sql_tfidf_pairs(a: str, b: str, source: str) -> str:
    """CTE ``sim`` (a, b, cosine) for the distinct pairs of two text expressions of ``source``; null where a text has no vector."""
    return f"""pq AS (SELECT DISTINCT {a} AS a, {b} AS b FROM {source}),
    sim AS (SELECT a, b, CASE WHEN a IN (SELECT t FROM wt) AND b IN (SELECT t FROM wt) THEN coalesce(s, 0) END AS cosine FROM pq LEFT JOIN (
      SELECT a, b, sum(x.weight * y.weight) AS s FROM pq JOIN wt x ON x.t = a JOIN wt y ON y.t = b AND y.word = x.word GROUP BY a, b) USING (a, b))"""


TURNS = "SELECT a.conv_id, a.turn, a.text, b.text AS reply FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1"


@query("tfidf_similarity", "M14,M5", f"""
    WITH turns AS ({TURNS}), {sql_tfidf('SELECT text AS t FROM turns UNION ALL SELECT reply FROM turns')}, {sql_tfidf_pairs('text', 'reply', 'turns')}
    SELECT conv_id, turn, round(cosine, 6) AS similarity, text = reply AS same_text FROM turns LEFT JOIN sim ON a IS NOT DISTINCT FROM text AND b IS NOT DISTINCT FROM reply""")
def _(spark, sf):
    c = table(spark, sf, "conversations")
    nxt = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reply"))
    df = c.select("conv_id", "turn", "text").join(nxt, ["conv_id", "turn"])
    out = terms.text_similarity(df, "text", "reply", "similarity", Tfidf())
    return out.select("conv_id", "turn", r("similarity"), (F.col("text") == F.col("reply")).alias("same_text"))


def entities(spark, sf):
    """The prefixed job and candidate tables."""
    return prefix_columns(jobs(spark, sf), "job_", ["codigo_vaga"]), prefix_columns(applicants(spark, sf), "app_", ["codigo_candidato"])


BASELINE_TEXTS = ("coalesce(job_pv_principais_atividades, '') || ' ' || coalesce(job_pv_competencia_tecnicas_e_comportamentais, '')",
                  "coalesce(app_ip_conhecimentos_tecnicos, '') || ' ' || coalesce(app_cv_pt, '')")


@query("technical_baseline", "M6,M13,F24", f"""
    WITH {JOINED_SQL}, s AS (SELECT codigo_vaga, codigo_candidato, linha, {STRUCTURED} AS st, {sql_letter_cosine(*BASELINE_TEXTS)} AS cosine FROM joined)
    SELECT codigo_vaga, codigo_candidato, linha, round(st, 6) AS structured_match_score, round(cosine, 5) AS soft_match_score,
      round({WEIGHTS['structured']}::double * st + {WEIGHTS['cosine']}::double * cosine, 5) AS final_technical_score, true AS nearest_tier FROM s""")
def _(spark, sf):
    """A tier is right if its centre is the nearest of the three mean scores of the tiers."""
    df = scoring.technical_baseline(joined(spark, sf), letter_encoder, entities(spark, sf))
    scores = store(df.select("codigo_vaga", "codigo_candidato", "linha", "structured_match_score", "soft_match_score", "final_technical_score"))
    tiers = store(scoring.add_tiers(scores, "final_technical_score"))
    centers = tiers.groupBy("tier").agg(F.avg("final_technical_score").alias("center"))
    listed = centers.agg(F.array_sort(F.collect_list("center")).alias("centers"))  # three rows
    away = F.transform("centers", lambda c: F.abs(F.col("final_technical_score") - c))
    near = F.element_at(away, F.col("tier").cast("int") + 1) <= F.array_min(away) + 1e-3
    return tiers.crossJoin(F.broadcast(listed)).select(
        "codigo_vaga", "codigo_candidato", "linha", r("structured_match_score"), r("soft_match_score", 5), r("final_technical_score", 5),
        F.coalesce(near, F.lit(False)).alias("nearest_tier"))


@query("technical_ranking", "M7,U3,T1,M1,M3", f"""
    WITH {JOINED_SQL}, {PAIRS_SQL}, n AS (SELECT count(*) AS n FROM pairs), s AS (
      SELECT codigo_vaga, codigo_candidato, ({sql_mean_best(0.5, 0.0)}) AS soft, {STRUCTURED} AS st,
        {sql_letter_cosine("coalesce(job_pv_principais_atividades, '')", "coalesce(app_cv_pt, '')")} AS cosine
      FROM joined, n JOIN pairs ON pairs.vec_id = codigo_candidato::bigint % n.n)
    SELECT codigo_vaga, codigo_candidato, round(soft, 3) AS soft_match_score, round(st, 3) AS structured_match_score, round(cosine, 3) AS cosine_similarity_score,
      round({TECHNICAL['soft']}::double * soft + {TECHNICAL['structured']}::double * st + {TECHNICAL['cosine']}::double * coalesce(cosine, 0), 3) AS technical_score FROM s""")
def _(spark, sf):
    # lists of vectors are compared once per row of the embeddings, not once per prospect that meets them
    pairs = store(vector_pairs(spark, sf).select("vec_id", scoring.skill_similarity(F.col("need"), F.col("have")).alias("_soft")))
    n = pairs.agg(F.count("*")).scalar()
    df = joined(spark, sf).withColumn("vec_id", F.col("codigo_candidato").cast("bigint") % n).join(pairs, "vec_id")
    return scoring.technical_ranking(df, None, None, letter_encoder, entities=entities(spark, sf), soft="_soft")


@query("cultural_baseline", "M10,F24", f"""
    WITH {JOINED_SQL}, t AS (SELECT *, job_pv_habilidades_comportamentais_necessarias || ' ' || job_ib_objetivo_vaga AS job_culture_text,
      coalesce(app_ib_objetivo_profissional, '') || ' ' || coalesce(p_comentario, '') AS app_culture_text FROM joined)
    SELECT codigo_vaga, codigo_candidato, linha, job_culture_text, app_culture_text, round({sql_letter_cosine('job_culture_text', 'app_culture_text')}, 5) AS cultural_score FROM t""")
def _(spark, sf):
    df = scoring.cultural_baseline(joined(spark, sf), letter_encoder)
    return df.select("codigo_vaga", "codigo_candidato", "linha", "job_culture_text", "app_culture_text", r("cultural_score", 5))


# ------------------------------------------------------------------------------- extraction
TERMS = {"ferramentas_tecnologicas": ["PYTHON", "SQL", "EXCEL"], "competencias_tecnicas": ["SQL", "GRUPO 1"],
         "competencias_comportamentais": ["LIDERANCA", "COMUNICACAO"], "principais_ferramentas_tecnologicas": ["PYTHON"]}
OPTIONS = {"senioridade_aparente": {"Sênior": ["2-HIGH", "MACHINERY"], "Pleno": ["BUILDING", "3-MEDIUM"]}}


def sql_terms(source, terms):
    return ("array_to_string([w for w in [" + ", ".join(f"'{t}'" for t in terms) + f"] if contains(lower({source}), lower(w))], '|')")


CV = "coalesce(app_cv_pt, '')"
JOB_TEXT = ("job_ib_titulo_vaga || job_pv_principais_atividades || job_pv_competencia_tecnicas_e_comportamentais || "
            "coalesce(job_pv_demais_observacoes, '') || job_pv_habilidades_comportamentais_necessarias")


@query("keyword_extraction", "E5,E3", """
    SELECT doc_id, array_to_string([w for w in ['the', 'und', 'não', 'qui'] if contains(lower(text), w)], '|') AS words,
      CASE WHEN contains(lower(text), 'ção') THEN 'pt' WHEN contains(lower(text), 'tion') THEN 'latin' ELSE 'Não mencionado' END AS kind FROM documents""")
def _(spark, sf):
    from pyspark.sql import types as T
    schema = T.StructType.fromDDL("words array<string>, kind string")
    fields = extraction.keyword_fields(F.col("text"), schema, {"words": ["the", "und", "não", "qui"]},
                                       {"kind": {"pt": ["ção"], "latin": ["tion"]}})
    return table(spark, sf, "documents").select("doc_id", fields.alias("d")).select(
        "doc_id", F.array_join("d.words", "|").alias("words"), "d.kind")


@query("extract_incremental", "E1,E3,J4,J5,F32,S4", f"""
    WITH {JOINED_SQL} SELECT codigo_vaga, CASE WHEN codigo_candidato = codigo_vaga THEN codigo_candidato || '_cand' ELSE codigo_candidato END AS codigo_candidato, linha,
      {sql_terms(JOB_TEXT, TERMS['ferramentas_tecnologicas'])} AS job_tools, {sql_terms(CV, TERMS['ferramentas_tecnologicas'])} AS app_tools,
      CASE WHEN contains(lower({JOB_TEXT}), '2-high') OR contains(lower({JOB_TEXT}), 'machinery') THEN 'Sênior'
           WHEN contains(lower({JOB_TEXT}), 'building') OR contains(lower({JOB_TEXT}), '3-medium') THEN 'Pleno' ELSE 'Não mencionado' END AS job_level
    FROM joined""")
def _(spark, sf):
    """Two runs over the same folder: the second one finds half of the ids already done."""
    folder, extract = scratch_path(spark, "extract"), extraction.keyword_extract(TERMS, OPTIONS)
    df = store(joined(spark, sf).select("codigo_vaga", "codigo_candidato", "linha", "app_cv_pt", *extraction.JOB_PROMPT_COLUMNS.values()))
    entities = {"vaga": prefix_columns(jobs(spark, sf), "job_", ["codigo_vaga"]),
                "candidato": prefix_columns(applicants(spark, sf), "app_", ["codigo_candidato"])}
    scoring_plan.run_extraction(spark, df.where("linha % 2 = 0"), folder, extract)
    out = scoring_plan.run_extraction(spark, df, folder, extract, entities)
    return out.select("codigo_vaga", "codigo_candidato", "linha", F.array_join("job_ferramentas_tecnologicas", "|").alias("job_tools"),
                      F.array_join("app_ferramentas_tecnologicas", "|").alias("app_tools"), F.col("job_senioridade_aparente").alias("job_level"))


LIST_FIELDS = extraction.CANDIDATE_LIST_FIELDS
TEXT_FIELDS = extraction.TEXT_FIELDS


# Two stand-in generators that answer from the text alone: one needs a sentence end, the other a capital letter. Whatever they
# cannot answer they decline in words, which is no JSON.
FOUND = {"lead": ["the", "und", "de"], "spare": ["en", "is"]}


def rule_generator(words, needed, fenced):
    def generate(prompt: str) -> str:
        if not re.search(needed, prompt):
            return "não sei responder"
        seen = [w for w in words if w in prompt.lower()]
        answer = json.dumps({**{n: seen for n in LIST_FIELDS}, **{n: str(len(prompt)) for n in TEXT_FIELDS}})
        return f"```json\n{answer}\n```" if fenced else answer

    return generate


def sql_found(words):
    return "[w for w in [" + ", ".join(f"'{w}'" for w in words) + "] if contains(lower(t), w)]"


@query("extract_retry", "E2,E3,X5,F29", f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_matches(t, '[.]') AS lead, regexp_matches(t, '[A-Z]') AS spare FROM documents)
    SELECT doc_id::varchar AS id, CASE WHEN lead THEN 1 ELSE 3 END AS tries, CASE WHEN lead THEN 'lead' ELSE 'spare' END AS model, CASE WHEN lead OR spare THEN 1 ELSE 0 END AS good,
      CASE WHEN lead THEN array_to_string({sql_found(FOUND['lead'])}, '|') WHEN spare THEN array_to_string({sql_found(FOUND['spare'])}, '|') END AS skills,
      CASE WHEN lead OR spare THEN length(t)::varchar END AS area, CASE WHEN lead OR spare THEN 0 ELSE 3 END AS errors FROM d""")
def _(spark, sf):
    """Two tries of one generator, then one of another, over every document."""
    prompts = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), F.coalesce("text", F.lit("")).alias("prompt"))
    generators = [("lead", rule_generator(FOUND["lead"], r"[.]", True), 2), ("spare", rule_generator(FOUND["spare"], r"[A-Z]", False), 1)]
    log = store(extraction.generate_answers(prompts, extraction.CANDIDATE_SCHEMA, generators, delay=0))
    tried = log.groupBy("id").agg(F.count("*").cast("int").alias("tries"), F.max_by("model", F.struct("ok", "model")).alias("model"),
                                  F.count_if("ok").cast("int").alias("good"),
                                  F.when(F.bool_or("ok"), 0).otherwise(F.count("error")).alias("errors"))
    answers = extraction.last_answers(log, extraction.CANDIDATE_SCHEMA)
    return tried.join(answers.select("id", F.array_join("dados.competencias_tecnicas", "|").alias("skills"), F.col("dados.area_formacao").alias("area")), "id")


@query("extract_batch", "E4,P7,F27", f"""
    WITH {CURATED_SQL} SELECT codigo_candidato AS id, {sql_terms("coalesce(cv_pt, '')", TERMS['ferramentas_tecnologicas'])} AS tools FROM applicants WHERE codigo_candidato::bigint % 3 <> 0""")
def _(spark, sf):
    done = applicants(spark, sf).where("cast(codigo_candidato as bigint) % 3 = 0").select(F.col("codigo_candidato").alias("id"))
    out = extraction.batch_candidates(applicants(spark, sf), extraction.keyword_extract(TERMS, OPTIONS), done)
    return out.select("id", F.array_join("dados.ferramentas_tecnologicas", "|").alias("tools"))


def sql_list(source, fields):
    """The extracted terms of some list fields, in order and with repeats."""
    words = ", ".join(f"'{t}'" for f in fields for t in TERMS[f])
    return f"[w for w in [{words}] if contains(lower({source}), lower(w))]"


def sql_list_score(need, have, threshold, empty):
    """Mean of the best similarity from the CTE ``sim`` for lists of terms."""
    best = f"list_max([coalesce(m[x || '|' || y], 0.0) for y in {have}])"
    if threshold:
        best = f"[CASE WHEN z >= {threshold} THEN z ELSE 0.0 END for z in [{best} for x in {need}]]"
    else:
        best = f"[{best} for x in {need}]"
    return f"CASE WHEN len({need}) = 0 OR len({have}) = 0 THEN {empty}::double ELSE list_avg({best}) END"


SKILLS, CULTURE = ["competencias_tecnicas", "ferramentas_tecnologicas"], ["competencias_comportamentais"]


# ---------------------------------------------------------------------------------- payloads
def requests(spark, sf):
    """One request per vector: skills named after vectors, with all the ways a request can be wrong."""
    n = F.col("vec_id")
    word = lambda k: F.concat(F.lit("skill "), (n + k).cast("string"))
    candidate = F.to_json(F.struct(
        F.struct(F.array(word(0), word(1)).alias("technical_skills"), F.array(word(2)).alias("soft_skills"),
                 F.array(word(3), F.lit("")).alias("tools")).alias("skills"),
        F.when(n % 11 == 3, F.struct(F.lit("wizard").alias("seniority_inferred"))).alias("profile")))
    job = F.to_json(F.struct(
        F.struct(F.array(word(1)).alias("required_tech_skills"), F.array(word(4)).alias("nice_to_have_skills"),
                 F.array(word(2), word(5)).alias("required_soft_skills")).alias("requirements"),
        F.when(n % 13 == 4, F.struct(F.lit("x").alias("department"))).otherwise(
            F.struct(F.lit(None).cast("string").alias("department"))).alias("metadata")))
    job = F.when(n % 13 == 4, job).otherwise(F.regexp_replace(job, r',?"metadata":\{[^}]*\}', ""))
    return table(spark, sf, "embeddings").select(
        n.cast("string").alias("request_id"),
        F.when(n % 7 == 1, F.lit('{"skills": [')).when(n % 7 == 2, F.lit(None)).otherwise(candidate).alias("candidate_data"),
        F.when(n % 5 == 0, F.lit(None)).otherwise(job).alias("job_data"))


def vocabulary(spark, sf):
    words = table(spark, sf, "embeddings").select(F.concat(F.lit("skill "), "vec_id").alias("text"), F.col("embedding").alias("vector"))
    fallback = table(spark, sf, "embeddings").where("vec_id < 2").select(
        F.when(F.col("vec_id") == 0, "Python").otherwise("Data Science").alias("text"), F.col("embedding").alias("vector"))
    return words.unionAll(fallback)


PAYLOAD_SQL = """
    WITH v AS (SELECT vec_id, embedding::double[] AS e FROM embeddings),
    base AS (SELECT a.vec_id AS n, v0.e AS e0, v1.e AS e1, v2.e AS e2, v3.e AS e3, v4.e AS e4, v5.e AS e5 FROM embeddings a
      LEFT JOIN v v0 ON v0.vec_id = a.vec_id LEFT JOIN v v1 ON v1.vec_id = a.vec_id + 1 LEFT JOIN v v2 ON v2.vec_id = a.vec_id + 2
      LEFT JOIN v v3 ON v3.vec_id = a.vec_id + 3 LEFT JOIN v v4 ON v4.vec_id = a.vec_id + 4 LEFT JOIN v v5 ON v5.vec_id = a.vec_id + 5),
    fb AS (SELECT (SELECT e FROM v WHERE vec_id = 0) AS p, (SELECT e FROM v WHERE vec_id = 1) AS d),
    l AS (SELECT n, n % 5 = 0 AS fallback, [x for x in [e0, e1, e3] if x IS NOT NULL] AS cs, [x for x in [e2] if x IS NOT NULL] AS cc,
        CASE WHEN n % 5 = 0 THEN [p, d] ELSE [x for x in [e1, e4] if x IS NOT NULL] END AS js,
        CASE WHEN n % 5 = 0 THEN [] ELSE [x for x in [e2, e5] if x IS NOT NULL] END AS jc,
        CASE WHEN n % 7 = 1 THEN 'invalid candidate_data' WHEN n % 7 <> 2 AND n % 11 = 3 THEN 'unknown seniority_inferred'
             WHEN n % 5 <> 0 AND n % 13 = 4 THEN 'job_title is required' WHEN n % 7 = 2 THEN 'resume_text or candidate_data is required' END AS reason
      FROM base, fb),
    b AS (SELECT *, [list_max([list_cosine_similarity(x, y) for y in cs]) for x in js] AS bs, [list_max([list_cosine_similarity(x, y) for y in cc]) for x in jc] AS bc FROM l)
    SELECT n::varchar AS request_id, CASE WHEN reason IS NULL THEN 'ok' ELSE 'rejected' END AS status, reason, CASE WHEN reason IS NULL THEN fallback END AS fallback_used,
      CASE WHEN reason IS NULL THEN round(CASE WHEN len(js) = 0 OR len(cs) = 0 THEN 0.0 ELSE list_avg([CASE WHEN z >= 0.5 THEN z ELSE 0.0 END for z in bs]) END, 6) END AS score_skills,
      CASE WHEN reason IS NULL THEN round(CASE WHEN len(jc) = 0 OR len(cc) = 0 THEN 0.5 ELSE list_avg(bc) END, 6) END AS score_cultural,
      CASE WHEN reason IS NULL THEN 0.5::double END AS score_behavioral FROM b"""


@query("payload_score", "M16,M17,M14", PAYLOAD_SQL)
def _(spark, sf):
    encode = embedding.lookup_encoder(vocabulary(spark, sf))
    scored = payload.score_requests(requests(spark, sf), encode)
    return scored.withColumns({"score_skills": r("score_skills"), "score_cultural": r("score_cultural")})


@query("payload_repeated_ids", "M16", f"""
    SELECT (request_id::bigint % 10)::varchar AS request_id, * EXCLUDE (request_id) FROM ({PAYLOAD_SQL}) WHERE request_id::bigint % 17 <> 0
    UNION ALL SELECT NULL, 'rejected', coalesce(reason, 'request_id is required'), NULL, NULL, NULL, NULL FROM ({PAYLOAD_SQL}) WHERE request_id::bigint % 17 = 0""")
def _(spark, sf):
    """Ten ids for all requests and none for some: every request is scored by its own payload."""
    n = F.col("request_id").cast("bigint")
    shared = requests(spark, sf).withColumn("request_id", F.when(n % 17 != 0, (n % 10).cast("string")))
    scored = payload.score_requests(shared, embedding.lookup_encoder(vocabulary(spark, sf)))
    return scored.withColumns({"score_skills": r("score_skills"), "score_cultural": r("score_cultural")})


DESCRIPTION = "'PROCURA ' || c_mktsegment || CASE WHEN c_custkey % 2 = 0 THEN ' COM PYTHON E LIDERANCA' ELSE ' COM EXCEL, GRUPO 1 E COMUNICACAO' END"


@query("payload_branches", "M16,E3", f"""
    WITH {CURATED_SQL}, r AS (SELECT c_custkey, cv_pt AS cv, CASE c_custkey % 4 WHEN 1 THEN (c_custkey // 4)::varchar END AS job_id,
        CASE WHEN c_custkey % 4 IN (1, 2) THEN {DESCRIPTION} END AS jd FROM customer JOIN applicants ON codigo_candidato = c_custkey::varchar),
    k AS (SELECT codigo_vaga, {sql_list('pv_competencia_tecnicas_e_comportamentais', SKILLS)} AS ks, {sql_list('pv_habilidades_comportamentais_necessarias', CULTURE)} AS kc FROM jobs),
    l AS (SELECT c_custkey, cv, {sql_list("coalesce(cv, '')", SKILLS)} AS cs, {sql_list("coalesce(cv, '')", CULTURE)} AS cc,
        CASE WHEN ks IS NOT NULL THEN ks WHEN jd IS NOT NULL THEN {sql_list('jd', SKILLS)} ELSE [] END AS js,
        CASE WHEN ks IS NOT NULL THEN kc WHEN jd IS NOT NULL THEN {sql_list('jd', CULTURE)} ELSE [] END AS jc FROM r LEFT JOIN k ON codigo_vaga = job_id),
    f AS (SELECT c_custkey, cv, cs, cc, len(js) = 0 AS fallback, CASE WHEN len(js) = 0 THEN ['Python', 'Data Science'] ELSE js END AS js,
        CASE WHEN len(js) = 0 THEN ['Proatividade'] ELSE jc END AS jc FROM l),
    vocabulary AS (SELECT DISTINCT unnest(list_concat(list_concat(js, cs), list_concat(jc, cc))) AS t FROM f WHERE cv IS NOT NULL),
    {sql_tfidf('SELECT t FROM vocabulary')}, met AS (SELECT x.t AS p, y.t AS q FROM vocabulary x, vocabulary y), {sql_tfidf_pairs('p', 'q', 'met')},
    mm AS (SELECT map(list(a || '|' || b ORDER BY a, b), list(coalesce(cosine, 0) ORDER BY a, b)) AS m FROM sim)
    SELECT c_custkey::varchar AS request_id, CASE WHEN cv IS NULL THEN 'rejected' ELSE 'ok' END AS status, CASE WHEN cv IS NOT NULL THEN fallback END AS fallback_used,
      CASE WHEN cv IS NULL THEN 'resume_text or candidate_data is required' END AS reason,
      CASE WHEN cv IS NOT NULL THEN round({sql_list_score('js', 'cs', 0.5, 0.0)}, 6) END AS score_skills,
      CASE WHEN cv IS NOT NULL THEN round({sql_list_score('jc', 'cc', None, 0.5)}, 6) END AS score_cultural, CASE WHEN cv IS NOT NULL THEN 0.5::double END AS score_behavioral FROM f, mm""")
def _(spark, sf):
    """Candidates from their text; jobs by id where it is known, else from a description, else the fallback lists."""
    people = applicants(spark, sf).select(F.col("codigo_candidato").alias("request_id"), F.col("cv_pt").alias("resume_text"))
    k = F.col("c_custkey") % 4
    asked = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("request_id"), F.when(k == 1, F.expr("cast(c_custkey div 4 as string)")).alias("job_id"),
        F.when(k.isin(1, 2), F.expr(DESCRIPTION)).alias("job_description"))
    listed = lambda source, fields: F.concat(*[text.listed_terms(F.col(source), TERMS[f]) for f in fields])
    known = jobs(spark, sf).select("codigo_vaga", listed("pv_competencia_tecnicas_e_comportamentais", SKILLS).alias("job_skills"),
                                   listed("pv_habilidades_comportamentais_necessarias", CULTURE).alias("job_culture"))
    scored = payload.score_requests(people.join(asked, "request_id"), Tfidf(), extraction.keyword_extract(TERMS, {}), known)
    return scored.withColumns({"score_skills": r("score_skills"), "score_cultural": r("score_cultural")})


@query("payload_defaults", "M17", """
    SELECT conv_id, turn, 'unknown' AS seniority, 'not_declared' AS education, CASE WHEN turn % 3 <> 0 THEN role END AS title, 'general' AS department,
      CASE WHEN turn % 3 = 0 THEN 'x' ELSE 'remote' END AS location, -1 AS days,
      0 AS n_tools, 1 AS n_skills, CASE WHEN turn % 3 = 0 THEN 'job_title is required' END AS rejected FROM conversations""")
def _(spark, sf):
    c = table(spark, sf, "conversations")
    candidate = F.to_json(F.struct(F.struct(F.array("role").alias("technical_skills")).alias("skills"),
                                   F.struct(F.col("text").alias("resume_text")).alias("profile"),
                                   F.create_map(F.lit("x"), F.lit(1)).alias("behavioral_signals")))
    titled = F.to_json(F.struct(F.struct(F.col("role").alias("job_title")).alias("metadata")))
    df = c.select("conv_id", "turn", "role", F.concat_ws("-", "conv_id", "turn").alias("request_id"), candidate.alias("candidate_data"),
                  F.when(F.col("turn") % 3 == 0, F.lit('{"metadata": {"location": "x"}}')).otherwise(titled).alias("job_data"))
    out = payload.read_payloads(df)
    return out.select("conv_id", "turn", F.col("candidate.profile.seniority_inferred").alias("seniority"),
                      F.col("candidate.profile.education_level").alias("education"), F.col("job.metadata.job_title").alias("title"),
                      F.col("job.metadata.department").alias("department"),
                      F.col("job.metadata.location").alias("location"),
                      F.col("candidate.behavioral_signals.days_in_process").alias("days"),
                      F.size("candidate.skills.tools").alias("n_tools"), F.size("candidate.skills.technical_skills").alias("n_skills"), "rejected")


@query("payload_build", "M18", f"""
    WITH {JOINED_SQL}, t AS (SELECT codigo_candidato, count(p_recrutador) AS touches FROM joined GROUP BY 1),
    q AS (SELECT job_ib_requisitante, count(*) AS n FROM joined GROUP BY 1)
    SELECT codigo_vaga, codigo_candidato, linha, codigo_vaga || '-' || codigo_candidato AS request_id, touches AS touchpoints,
      CASE WHEN n >= 10 THEN job_ib_requisitante ELSE 'outros' END AS recruiter_id, job_ib_titulo_vaga AS job_title,
      CASE WHEN coalesce(job_ib_empresa_divisao, '') = '' THEN 'general' ELSE job_ib_empresa_divisao END AS department,
      job_pv_cidade || coalesce('/' || job_pv_bairro, '') AS location, coalesce(datediff('day', job_ib_data_requicisao, date '2002-01-01'), -1) AS days_since_opening,
      CASE WHEN app_fei_nivel_academico LIKE '%MESTRADO%' OR app_fei_nivel_academico LIKE '%PÓS%' THEN 'masters'
           WHEN app_fei_nivel_academico LIKE '%INCOMPLETO%' THEN 'high_school' ELSE 'not_declared' END AS education_level,
      CASE WHEN app_cv_pt IS NULL THEN 'resume_text is empty' END AS rejected
    FROM joined JOIN t USING (codigo_candidato) JOIN q USING (job_ib_requisitante)""")
def _(spark, sf):
    built = payload.build_payloads(joined(spark, sf), F.lit("2002-01-01").cast("date"),
                                   F.concat_ws("-", "codigo_vaga", "codigo_candidato", "linha"))
    # one parse of the fields that are read, each as text
    fields = F.from_json("payload", "request_id string, candidate struct<profile: struct<education_level: string>, "
                         "behavioral_signals: struct<recruiter_touchpoints: string>>, job_context struct<metadata: struct<recruiter_id: string, "
                         "job_title: string, department: string, location: string, days_since_opening: string>>")
    built, at = built.withColumn("p", fields), lambda path: F.col(f"p.{path}")
    return built.select(
        "codigo_vaga", "codigo_candidato", F.split(at("request_id"), "-")[2].cast("int").alias("linha"),
        F.regexp_replace(at("request_id"), "-[0-9]+$", "").alias("request_id"),
        at("candidate.behavioral_signals.recruiter_touchpoints").cast("bigint").alias("touchpoints"),
        at("job_context.metadata.recruiter_id").alias("recruiter_id"), at("job_context.metadata.job_title").alias("job_title"),
        at("job_context.metadata.department").alias("department"), at("job_context.metadata.location").alias("location"),
        at("job_context.metadata.days_since_opening").cast("int").alias("days_since_opening"),
        at("candidate.profile.education_level").alias("education_level"), "rejected")


# --------------------------------------------------------------------------------- whole job


@query("score_pairs", "M15,M1,M3,M4,M8,M11,J3", f"""
    WITH {JOINED_SQL}, {PAIRS_SQL}, n AS (SELECT count(*) AS n FROM pairs)
    SELECT codigo_vaga, codigo_candidato, linha,
      round(0.7::double * ({sql_mean_best(0.5, 0.0)}) + 0.3::double * {STRUCTURED}, 6) AS score_skills,
      CASE {sql_sentiment('p_comentario', text.SENTIMENT_SCORING)} WHEN 1 THEN 0.9 WHEN -1 THEN 0.2 ELSE 0.5 END::double AS score_behavioral,
      round({sql_mean_best(None, 0.5)}, 6) AS score_cultural
    FROM joined, n JOIN pairs ON pairs.vec_id = codigo_candidato::bigint % n.n""")
def _(spark, sf):
    """Vectors come from the embeddings table; the pair id picks a row of it."""
    pairs = vector_pairs(spark, sf).drop("a", "b")
    n = pairs.agg(F.count("*")).scalar()
    df = joined(spark, sf).withColumn("vec_id", F.col("codigo_candidato").cast("bigint") % n).join(pairs, "vec_id")
    scored = scoring_plan.score_pairs(df, ("need", "need"), ("have", "have"))
    return scored.select("codigo_vaga", "codigo_candidato", "linha", r("score_skills"), "score_behavioral", r("score_cultural"))


@query("score_table", "M15,M14,M1,M8,E1,S2,S3", f"""
    WITH {JOINED_SQL}, l AS (SELECT *, {sql_list(JOB_TEXT, SKILLS)} AS js, {sql_list(CV, SKILLS)} AS cs, {sql_list(JOB_TEXT, CULTURE)} AS jc, {sql_list(CV, CULTURE)} AS cc FROM joined),
    vocabulary AS (SELECT DISTINCT unnest(list_concat(list_concat(js, cs), list_concat(jc, cc))) AS t FROM l),
    {sql_tfidf('SELECT t FROM vocabulary')}, met AS (SELECT x.t AS p, y.t AS q FROM vocabulary x, vocabulary y), {sql_tfidf_pairs('p', 'q', 'met')},
    mm AS (SELECT map(list(a || '|' || b ORDER BY a, b), list(coalesce(cosine, 0) ORDER BY a, b)) AS m FROM sim)
    SELECT codigo_vaga, CASE WHEN codigo_candidato = codigo_vaga THEN codigo_candidato || '_cand' ELSE codigo_candidato END AS codigo_candidato, linha,
      CASE {sql_sentiment('p_comentario', text.SENTIMENT_SCORING)} WHEN 1 THEN 0.9 WHEN -1 THEN 0.2 ELSE 0.5 END::double AS score_behavioral,
      round({STRUCTURED}, 6) AS structured_match_score, round(0.7::double * ({sql_list_score('js', 'cs', 0.5, 0.0)}) + 0.3::double * {STRUCTURED}, 6) AS score_skills,
      round({sql_list_score('jc', 'cc', None, 0.5)}, 6) AS score_cultural FROM l, mm""")
def _(spark, sf):
    """Curated tables to scored pairs, written and read back."""
    curated, out = scratch_path(spark, "curated"), scratch_path(spark, "scored")
    for name, df in (("prospects", prospects(spark, sf)), ("applicants", applicants(spark, sf)), ("jobs", jobs(spark, sf))):
        tables.write_parquet(df, f"{curated}/{name}.parquet")
    scored = scoring_plan.run(spark, curated, scratch_path(spark, "store"), out, extraction.keyword_extract(TERMS, OPTIONS))
    return scored.select("codigo_vaga", "codigo_candidato", "linha", "score_behavioral", r("structured_match_score"), r("score_skills"), r("score_cultural"))


ship_with_tasks(sys.modules[__name__])
