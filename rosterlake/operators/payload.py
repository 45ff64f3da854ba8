"""Scoring requests as a table: JSON payloads in, scores or a rejection reason out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import matching, temporal, text
from ..session import store
from .embedding import Encoder
from .extraction import CANDIDATE_SCHEMA, JOB_SCHEMA, Extract
from .joins import add_if_absent, group_rare
from .scoring import list_similarities
from .tfidf import Tfidf

# --- fixed values: payload contract and fallbacks -------------------------------------------
SENIORITY = ["junior", "mid", "senior", "specialist", "unknown"]
EDUCATION_LEVEL = ["high_school", "bachelors", "masters", "phd", "not_declared"]
DEGREES = ["bachelors", "masters", "phd"]
FALLBACK_SKILLS = ["Python", "Data Science"]
FALLBACK_CULTURE = ["Proatividade"]
CANDIDATE_DEFAULTS = {
    "profile": {"resume_text": None, "years_experience_range": "unknown", "seniority_inferred": "unknown",
                "education_level": "not_declared", "field_of_study": None, "has_degree": False,
                "languages": [], "availability": "unspecified"},
    "skills": {"technical_skills": [], "soft_skills": [], "tools": [], "certifications": []},
    "quality_signals": {"has_email": False, "has_phone": False, "has_linkedin": False,
                        "completeness_score": 0.0, "is_local_to_job": False},
    "behavioral_signals": {"days_since_profile_update": -1, "days_in_process": -1,
                           "recruiter_touchpoints": 0, "sentiment_score": 0},
}
JOB_DEFAULTS = {
    "metadata": {"job_title": None, "department": "general", "location": "remote", "contract_type": "unspecified"},
    "requirements": {"required_tech_skills": [], "required_soft_skills": [], "target_seniority": "unknown",
                     "nice_to_have_skills": []},
}
# -----------------------------------------------------------------------------------------------

def _shape(defaults: Mapping[str, Mapping]) -> T.StructType:
    """Schema of a payload side: the type of a field is the type of its default, text where that is null."""
    kinds = {bool: T.BooleanType(), int: T.IntegerType(), float: T.DoubleType(), list: T.ArrayType(T.StringType())}
    blocks = [T.StructField(block, T.StructType([T.StructField(n, kinds.get(type(v), T.StringType()))
                                                 for n, v in fields.items()]))
              for block, fields in defaults.items()]
    return T.StructType([*blocks, T.StructField("embeddings", T.MapType(T.StringType(), T.ArrayType(T.FloatType())))])


CANDIDATE_PAYLOAD = _shape(CANDIDATE_DEFAULTS)
JOB_PAYLOAD = _shape(JOB_DEFAULTS)
CORRUPT = "_corrupt_record"


def _default(value, dtype: T.DataType) -> Column:
    if isinstance(value, list):
        return F.array().cast(dtype)
    return F.lit(value).cast(dtype)


def with_defaults(payload: Column, schema: T.StructType, defaults: Mapping[str, Mapping]) -> Column:
    """Fill missing fields of each present block; a missing block stays null."""
    blocks = []
    for f in schema.fields:
        block = payload.getField(f.name)
        if f.name in defaults:
            filled = F.struct(*[
                F.coalesce(block.getField(inner.name), _default(defaults[f.name][inner.name], inner.dataType))
                .alias(inner.name) for inner in f.dataType.fields])
            blocks.append(F.when(block.isNotNull(), filled).alias(f.name))
        else:
            blocks.append(F.coalesce(block, F.create_map().cast(f.dataType)).alias(f.name))
    return F.when(payload.isNotNull(), F.struct(*blocks))


def _parse(df: DataFrame, source: str, output: str, schema: T.StructType) -> DataFrame:
    """Parse a JSON column; ``<output>_bad`` tells text that is no object of that shape."""
    reading = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    df = df.withColumn("_parsed", F.from_json(F.col(source), reading, {"columnNameOfCorruptRecord": CORRUPT}))
    bad = F.col(source).isNotNull() & (F.col("_parsed").isNull() | F.col("_parsed").getField(CORRUPT).isNotNull())
    kept = F.struct(*[F.col("_parsed").getField(f.name).alias(f.name) for f in schema.fields])
    return (df.withColumn(f"{output}_bad", bad)
            .withColumn(output, F.when(F.col("_parsed").isNotNull() & ~F.col(f"{output}_bad"), kept))
            .drop("_parsed"))


def _outside(value: Column, allowed: list[str]) -> Column:
    return F.coalesce(~value.isin(allowed), F.lit(False))


def read_payloads(requests: DataFrame) -> DataFrame:
    """Parse ``candidate_data`` and ``job_data`` JSON, fill defaults, set ``rejected`` to a reason or null.

    Input columns: request_id, resume_text, job_id, job_description, candidate_data, job_data;
    all but the first may be absent.
    """
    for name in ("resume_text", "job_id", "job_description", "candidate_data", "job_data"):
        requests = add_if_absent(requests, name, F.lit(None).cast("string"))
    df = _parse(requests, "candidate_data", "candidate", CANDIDATE_PAYLOAD)
    df = _parse(df, "job_data", "job", JOB_PAYLOAD)
    title_missing = F.col("job.metadata").isNotNull() & F.col("job.metadata.job_title").isNull()
    has_text = text.is_filled(F.col("resume_text"))
    reason = (F.when(F.col("candidate_bad"), "invalid candidate_data")
              .when(F.col("job_bad"), "invalid job_data")
              .when(_outside(F.col("candidate.profile.seniority_inferred"), SENIORITY), "unknown seniority_inferred")
              .when(_outside(F.col("candidate.profile.education_level"), EDUCATION_LEVEL), "unknown education_level")
              .when(_outside(F.col("job.requirements.target_seniority"), SENIORITY), "unknown target_seniority")
              .when(title_missing, "job_title is required")
              .when(F.col("candidate").isNull() & ~has_text, "resume_text or candidate_data is required")
              .when(F.col("request_id").isNull(), "request_id is required"))
    return (df.withColumn("rejected", reason)
            .withColumn("candidate", with_defaults(F.col("candidate"), CANDIDATE_PAYLOAD, CANDIDATE_DEFAULTS))
            .withColumn("job", with_defaults(F.col("job"), JOB_PAYLOAD, JOB_DEFAULTS))
            .drop("candidate_bad", "job_bad"))


def _list(c: Column) -> Column:
    return F.coalesce(c, F.array().cast("array<string>"))


def _read_text(df: DataFrame, needed: Column, source: str, kind: str, extract: Extract | None, output: str) -> DataFrame:
    """Extracted fields of the rows that need them, from free text; others get null."""
    schema = JOB_SCHEMA if kind == "vaga" else CANDIDATE_SCHEMA
    if extract is None:
        return df.withColumn(output, F.lit(None).cast(schema))
    key = F.col("_request" if "_request" in df.columns else "request_id").cast("string")
    sources = df.where(needed).select(key.alias("id"), F.col(source).alias("source"))
    answers = extract(sources, kind).select(F.col("id").alias("_id"), F.col("dados").alias(output))
    return df.join(answers, key == F.col("_id"), "left").drop("_id")


def request_lists(payloads: DataFrame, extract: Extract | None = None, jobs: DataFrame | None = None) -> DataFrame:
    """Skill and culture lists of both sides of each request.

    Candidate: structured data wins over extracted text. Job: structured data, else the job table
    row with that id, else the extracted description, else the fallback lists. ``jobs`` has
    codigo_vaga, job_skills and job_culture.
    """
    has_candidate, has_job = F.col("candidate").isNotNull(), F.col("job").isNotNull()
    df = _read_text(payloads, ~has_candidate & text.is_filled(F.col("resume_text")) & F.col("rejected").isNull(),
                    "resume_text", "candidato", extract, "_cv")
    df = _read_text(df, ~has_job & text.is_filled(F.col("job_description")) & F.col("rejected").isNull(),
                    "job_description", "vaga", extract, "_jd")
    if jobs is None:
        df = df.withColumns({"_known_skills": F.lit(None).cast("array<string>"),
                             "_known_culture": F.lit(None).cast("array<string>")})
    else:
        known = jobs.select(F.col("codigo_vaga").alias("job_id"), F.col("job_skills").alias("_known_skills"),
                            F.col("job_culture").alias("_known_culture"))
        df = df.join(known, "job_id", "left")
    skills, needs = F.col("candidate.skills"), F.col("job.requirements")
    df = df.withColumns({
        "cand_skills": F.when(has_candidate, F.concat(_list(skills.technical_skills), _list(skills.tools)))
        .otherwise(F.concat(_list(F.col("_cv.competencias_tecnicas")), _list(F.col("_cv.ferramentas_tecnologicas")))),
        "cand_culture": F.when(has_candidate, _list(skills.soft_skills))
        .otherwise(_list(F.col("_cv.competencias_comportamentais"))),
        "job_skills": F.when(has_job, F.concat(_list(needs.required_tech_skills), _list(needs.nice_to_have_skills)))
        .when(F.col("_known_skills").isNotNull(), F.col("_known_skills"))
        .otherwise(F.concat(_list(F.col("_jd.competencias_tecnicas")), _list(F.col("_jd.ferramentas_tecnologicas")))),
        "job_culture": F.when(has_job, _list(needs.required_soft_skills))
        .when(F.col("_known_skills").isNotNull(), _list(F.col("_known_culture")))
        .otherwise(_list(F.col("_jd.competencias_comportamentais"))),
    }).drop("_cv", "_jd", "_known_skills", "_known_culture")
    fallback = ~has_job & (F.size("job_skills") == 0)
    return df.withColumn("fallback_used", fallback).withColumns({
        "job_culture": F.when(fallback, F.array(*map(F.lit, FALLBACK_CULTURE))).otherwise(F.col("job_culture")),
        "job_skills": F.when(fallback, F.array(*map(F.lit, FALLBACK_SKILLS))).otherwise(F.col("job_skills")),
    })


def score_requests(requests: DataFrame, encode: Encoder | Tfidf, extract: Extract | None = None,
                   jobs: DataFrame | None = None) -> DataFrame:
    """(request_id, status, reason, score_skills, score_cultural, score_behavioral).

    Rejected requests have null scores. A request carries no comment, so its behavioural score is
    the neutral one. The parsed lists are stored: they are read twice, and reading them again would
    repeat the extractor. Requests that share an id are scored each by itself; one without an id is
    rejected.
    """
    # numbered once and stored, so that every later step sees the same numbers
    numbered = store(requests.withColumn("_request", F.monotonically_increasing_id()), "numbered")
    parsed = request_lists(read_payloads(numbered), extract, jobs)
    lists = store(parsed.select("_request", "request_id", "rejected", "fallback_used", "job_skills", "cand_skills",
                                "job_culture", "cand_culture"), "requests")
    side = lambda name, key: lists.where("rejected IS NULL").select(
        F.col("_request").alias(key), F.col(f"{name}_skills").alias("skills"), F.col(f"{name}_culture").alias("culture"))
    pairs = lists.where("rejected IS NULL").select("_request", F.col("_request").alias("_same"))
    similar = list_similarities(pairs, side("job", "_request"), side("cand", "_same"), "_request", "_same", encode)
    df = lists.join(similar, "_request", "left")
    good = F.col("rejected").isNull()
    return df.select(
        "request_id", F.when(good, "ok").otherwise("rejected").alias("status"), F.col("rejected").alias("reason"),
        F.when(good, F.col("fallback_used")).alias("fallback_used"),
        F.when(good, F.col("skill")).alias("score_skills"), F.when(good, F.col("culture")).alias("score_cultural"),
        F.when(good, matching.behaviour_score(text.sentiment(F.lit(""), text.SENTIMENT_SCORING)))
        .alias("score_behavioral"))


# --- fixed values: feature-table values of the payload enums -----------------------------------
SENIORITY_WORDS = {"junior": ["JÚNIOR", "JUNIOR", "ESTÁGIO", "ESTAGIO", "TRAINEE"], "mid": ["PLENO"],
                   "senior": ["SÊNIOR", "SENIOR"], "specialist": ["ESPECIALISTA", "LÍDER"]}
EDUCATION_WORDS = {"phd": ["DOUTORADO"], "masters": ["MESTRADO", "PÓS"], "high_school": ["MÉDIO", "INCOMPLETO"],
                   "bachelors": ["SUPERIOR", "TECNÓLOGO"]}
# ------------------------------------------------------------------------------------------------


def build_payloads(features: DataFrame, now: Column, request_id: Column | None = None) -> DataFrame:
    """The versioned payload of each feature-table row as JSON: every signal with its fallback.

    Columns that the table lacks read as null and take the fallback. Vectors come from
    ``app_vector``, ``job_vector`` and ``job_requirements_vector`` if present.
    """
    def col(name: str, dtype: str = "string") -> Column:
        return F.col(name) if name in features.columns else F.lit(None).cast(dtype)

    def items(name: str) -> Column:
        return _list(col(name, "array<string>"))

    def pieces(name: str, separators: str = "[,;/\n]") -> Column:
        parts = F.transform(F.split(F.coalesce(col(name), F.lit("")), separators), lambda x: F.trim(x))
        return F.filter(parts, lambda x: x != "")

    def filled(name: str, default: str) -> Column:
        value = col(name)
        return F.when(text.is_filled(value), value).otherwise(default)

    def vector(name: str) -> Column:
        return F.coalesce(col(name, "array<float>"), F.array().cast("array<float>"))

    df = features
    if "p_recrutador" in df.columns:
        touches = df.groupBy("codigo_candidato").agg(F.count("p_recrutador").alias("_touches"))
        df = df.join(touches, "codigo_candidato", "left")
    if "job_ib_requisitante" in df.columns:
        df = group_rare(df, "job_ib_requisitante", "_recruiter", 10, "outros")
    touchpoints = F.col("_touches") if "_touches" in df.columns else F.lit(None)
    recruiter = F.col("_recruiter") if "_recruiter" in df.columns else F.lit(None)

    education = text.word_class(col("app_fei_nivel_academico"), EDUCATION_WORDS, "not_declared")
    languages = {"english": "app_fei_nivel_ingles", "spanish": "app_fei_nivel_espanhol"}
    spoken = F.array_compact(F.array(*[
        F.when(text.is_filled(col(c)) & (F.upper(col(c)) != "NENHUM"), F.lit(n)) for n, c in languages.items()]))
    others = F.when(text.is_filled(col("app_fei_outro_idioma")), F.array(col("app_fei_outro_idioma"))) \
        .otherwise(F.array().cast("array<string>"))
    proficiency = F.create_map(*[x for n, c in languages.items() for x in (F.lit(n), F.lower(filled(c, "unknown")))])
    cv = col("app_cv_pt")
    available = (F.when(cv.rlike("(?iu)disponível|disponibilidade"), "available")
                 .when(cv.rlike(r"(?U)\bPJ\b"), "PJ").when(cv.rlike(r"(?U)\bCLT\b"), "CLT").otherwise("unspecified"))
    tech = pieces("job_pv_competencia_tecnicas_e_comportamentais")
    soft = items("job_competencias_comportamentais")

    candidate = F.struct(
        F.struct(cv.alias("resume_text"),
                 filled("app_experiencia_anos", "unknown").alias("years_experience_range"),
                 text.word_class(F.coalesce(col("app_senioridade_aparente"), col("app_ip_nivel_profissional")),
                                 SENIORITY_WORDS, "unknown").alias("seniority_inferred"),
                 education.alias("education_level"), col("app_fei_cursos").alias("field_of_study"),
                 education.isin(DEGREES).alias("has_degree"), F.concat(spoken, others).alias("languages"),
                 proficiency.alias("language_proficiency"), available.alias("availability")).alias("profile"),
        F.struct(items("app_competencias_tecnicas").alias("technical_skills"),
                 items("app_competencias_comportamentais").alias("soft_skills"),
                 items("app_ferramentas_tecnologicas").alias("tools"),
                 pieces("app_ip_certificacoes").alias("certifications")).alias("skills"),
        F.struct(*[F.coalesce(col(c, "boolean"), F.lit(False)).alias(n) for n, c in {
            "has_email": "ind_app_email", "has_phone": "ind_app_telefone", "has_linkedin": "ind_app_linkedin",
            "has_address": "ind_app_endereco", "has_social_profile": "ind_app_facebook"}.items()],
                 F.coalesce(col("percentual_perfil_completo", "double"), F.lit(0.0)).alias("completeness_score"),
                 F.coalesce(col("ind_mesma_localidade", "boolean"), F.lit(False)).alias("is_local_to_job"))
        .alias("quality_signals"),
        F.struct(*[F.coalesce(col(c, "int"), F.lit(-1)).alias(n) for n, c in {
            "days_since_profile_update": "dias_desde_ultima_atualizacao", "days_in_process": "dias_no_processo",
            "application_velocity": "dias_para_se_candidatar"}.items()],
                 F.coalesce(touchpoints, F.lit(0)).alias("recruiter_touchpoints"),
                 F.coalesce(col("sentimento_comentario_score", "int"), F.lit(0)).alias("sentiment_score"))
        .alias("behavioral_signals"),
        F.create_map(F.lit("semantic_vector"), vector("app_vector")).alias("embeddings"))
    place = F.concat_ws("/", *[F.when(text.is_filled(col(c)), col(c)) for c in ("job_pv_cidade", "job_pv_bairro")])
    job = F.struct(
        F.struct(col("job_ib_titulo_vaga").alias("job_title"),
                 filled("job_ib_empresa_divisao", "general").alias("department"),
                 F.coalesce(recruiter, F.lit("outros")).alias("recruiter_id"),
                 filled("job_ib_tipo_contratacao", "unspecified").alias("contract_type"),
                 temporal.calendar_days(now, col("job_ib_data_requicisao", "date")).alias("days_since_opening"),
                 F.when(place != "", place).otherwise("remote").alias("location")).alias("metadata"),
        F.struct(F.array_except(tech, soft).alias("required_tech_skills"),
                 F.array_intersect(tech, soft).alias("required_soft_skills"),
                 text.word_class(col("job_pv_nivel_profissional"), SENIORITY_WORDS, "unspecified")
                 .alias("target_seniority"),
                 pieces("job_pv_demais_observacoes").alias("nice_to_have_skills"),
                 pieces("job_pv_equipamentos_necessarios").alias("tools"),
                 pieces("job_pv_habilidades_comportamentais_necessarias").alias("soft_constraints"))
        .alias("requirements"),
        F.create_map(F.lit("description_vector"), vector("job_vector"),
                     F.lit("requirements_vector"), vector("job_requirements_vector")).alias("embeddings"))
    key = F.concat_ws("-", "codigo_vaga", "codigo_candidato") if request_id is None else request_id
    return df.select(
        "codigo_vaga", "codigo_candidato",
        F.to_json(F.struct(key.alias("request_id"), candidate.alias("candidate"), job.alias("job_context")),
                  {"ignoreNullFields": "false"}).alias("payload"),
        F.when(~text.is_filled(cv), "resume_text is empty").alias("rejected"))
