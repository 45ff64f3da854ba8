"""Structured fields from free text, once per job and once per candidate.

The extractor is a plug-in, a function from (id, prompt-source columns) to
(id, dados, ok, and log columns). Two are given: a keyword extractor that stays in the JVM,
and one that calls a user's text generator from Arrow batches with retries and a fallback.
"""

from __future__ import annotations

import json
import sys
import time
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text
from ..functions.text import unfenced
from ..session import ship_with_tasks
from .joins import enrich, not_in, rename_if_absent

# --- fixed values: target fields, options and prompt inputs --------------------------------
JOB_LIST_FIELDS = ["ferramentas_tecnologicas", "competencias_comportamentais", "competencias_tecnicas"]
CANDIDATE_LIST_FIELDS = ["principais_ferramentas_tecnologicas", "ferramentas_tecnologicas",
                         "competencias_tecnicas", "competencias_comportamentais"]
TEXT_FIELDS = ["experiencia_anos", "senioridade_aparente", "formacao_academica", "nivel_formacao", "area_formacao"]
NOT_MENTIONED = "Não mencionado"
EXPERIENCE_RANGES = ["0-2 anos", "2-5 anos", "5-8 anos", "8-10 anos", "10+ anos"]
SENIORITIES = ["Estágio", "Júnior", "Pleno", "Sênior", "Especialista"]
EDUCATION = ["Ensino Médio", "Tecnólogo", "Superior Completo", "Pós-graduação", "Mestrado", "Doutorado"]
JOB_PROMPT_COLUMNS = {
    "Título": "job_ib_titulo_vaga",
    "Atividades": "job_pv_principais_atividades",
    "Competências": "job_pv_competencia_tecnicas_e_comportamentais",
    "Observações": "job_pv_demais_observacoes",
    "Habilidades comportamentais": "job_pv_habilidades_comportamentais_necessarias",
}
CANDIDATE_PROMPT_COLUMN = "app_cv_pt"
RETRIES = 3
RETRY_DELAY = 0.2
# ---------------------------------------------------------------------------------------------


def answer_schema(list_fields: Sequence[str], text_fields: Sequence[str] = TEXT_FIELDS) -> T.StructType:
    return T.StructType([T.StructField(n, T.ArrayType(T.StringType())) for n in list_fields]
                        + [T.StructField(n, T.StringType()) for n in text_fields])


JOB_SCHEMA = answer_schema(JOB_LIST_FIELDS)
CANDIDATE_SCHEMA = answer_schema(CANDIDATE_LIST_FIELDS)
SCHEMAS = {"vaga": JOB_SCHEMA, "candidato": CANDIDATE_SCHEMA}


# ------------------------------------------------------------------------------ prompts
def _instructions(kind: str) -> str:
    """Request text generated from the target fields and their options."""
    options = {"experiencia_anos": EXPERIENCE_RANGES, "senioridade_aparente": SENIORITIES,
               "formacao_academica": ["true", "false"], "nivel_formacao": EDUCATION}
    lines = []
    for field in SCHEMAS[kind].fields:
        if isinstance(field.dataType, T.ArrayType):
            lines.append(f'"{field.name}": lista de 10 a 13 itens, 1 ou 2 palavras cada')
        else:
            choice = ", ".join(options.get(field.name, ["texto livre"]))
            lines.append(f'"{field.name}": {choice} ou {NOT_MENTIONED}')
    return "Responda somente com um objeto JSON com os campos:\n" + "\n".join(lines)


def _column_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def job_prompt(df: DataFrame, columns: Mapping[str, str] = JOB_PROMPT_COLUMNS,
               instructions: str | None = None) -> Column:
    """Labelled job texts followed by the request; absent columns read as ''."""
    parts = []
    for label, name in columns.items():
        value = text.first_text(F.col(name), _column_type(df, name)) if name in df.columns else F.lit("")
        parts.append(F.concat(F.lit(f"{label}: "), value))
    return F.concat_ws("\n", *parts, F.lit(instructions or _instructions("vaga")))


def candidate_prompt(df: DataFrame, column: str = CANDIDATE_PROMPT_COLUMN, instructions: str | None = None) -> Column:
    value = text.first_text(F.col(column), _column_type(df, column)) if column in df.columns else F.lit("")
    return F.concat_ws("\n---\n", value, F.lit(instructions or _instructions("candidato")))


# ------------------------------------------------------------------- keyword extractor
def _first_option(source: Column, options: Mapping[str, Sequence[str]], default: str) -> Column:
    lowered = F.lower(source)
    out = None
    for option, words in options.items():
        hit = F.lit(False)
        for word in words:
            hit = hit | F.contains(lowered, F.lit(word.lower()))
        out = F.when(hit, option) if out is None else out.when(hit, option)
    return out.otherwise(default) if out is not None else F.lit(default)


def keyword_fields(source: Column, schema: T.StructType, terms: Mapping[str, Sequence[str]],
                   options: Mapping[str, Mapping[str, Sequence[str]]]) -> Column:
    """Struct of the target fields by dictionary look-up; unlisted fields are empty or 'not mentioned'."""
    fields = []
    for f in schema.fields:
        if isinstance(f.dataType, T.ArrayType):
            value = text.listed_terms(source, terms[f.name]) if terms.get(f.name) else F.array().cast("array<string>")
        else:
            value = _first_option(source, options.get(f.name, {}), NOT_MENTIONED)
        fields.append(value.alias(f.name))
    return F.struct(*fields)


# --------------------------------------------------------------------- text generators
ATTEMPT_SCHEMA = "id string, attempt int, model string, raw string, ok boolean, error string"


def _problem(raw: str, list_fields: Sequence[str], text_fields: Sequence[str]) -> str | None:
    """Why an answer is not usable, or None."""
    try:
        data = json.loads(unfenced(raw))
    except ValueError as error:
        return f"not JSON: {error}"
    if not isinstance(data, dict):
        return "not an object"
    for name in list_fields:
        value = data.get(name)
        if not isinstance(value, list) or not all(isinstance(v, str) for v in value):
            return f"{name} is not a list of strings"
    for name in text_fields:
        if not isinstance(data.get(name), str):
            return f"{name} is not a string"
    return None


def _attempts(prompt: str, generators: Sequence[tuple[str, Callable[[str], str], int]], check, delay: float):
    """All tries for one prompt: each generator its number of times, until an answer is valid."""
    for model, generate, tries in generators:
        for attempt in range(1, tries + 1):
            raw, error = None, None
            try:
                raw = generate(prompt)
                error = check(raw)
            except Exception as failure:  # a generator may fail in any way; the log keeps it
                error = f"{type(failure).__name__}: {failure}"
            yield attempt, model, raw, error is None, error
            if error is None:
                return
            if delay:
                time.sleep(delay)


def generate_answers(prompts: DataFrame, schema: T.StructType,
                     generators: Sequence[tuple[str, Callable[[str], str], int]],
                     delay: float = RETRY_DELAY, tasks: int | None = None) -> DataFrame:
    """One log row per attempt for ``prompts(id, prompt)``.

    ``generators`` are ``(model name, prompt -> answer, tries)`` in order of preference. The
    calls are slow, so rows are spread over ``tasks`` partitions regardless of their bytes.
    """
    lists = [f.name for f in schema.fields if isinstance(f.dataType, T.ArrayType)]
    texts = [f.name for f in schema.fields if not isinstance(f.dataType, T.ArrayType)]
    names = ["id", "attempt", "model", "raw", "ok", "error"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, prompt in zip(batch["id"], batch["prompt"]):
                rows += [(key, *t) for t in _attempts(prompt, generators, lambda r: _problem(r, lists, texts), delay)]
            yield pd.DataFrame(rows, columns=names)

    spread = prompts.select("id", "prompt")
    if tasks:
        spread = spread.repartition(tasks, "id")
    return spread.mapInPandas(run, ATTEMPT_SCHEMA)


def last_answers(attempts: DataFrame, schema: T.StructType) -> DataFrame:
    """Per id the valid answer if there is one, else the last raw answer; parsed.

    The number of rows per id is the number of tries, so the aggregate is small.
    """
    chosen = attempts.groupBy("id").agg(
        F.bool_or("ok").alias("ok"),
        F.coalesce(F.max(F.when(F.col("ok"), F.col("raw"))),
                   F.max_by("raw", F.struct(F.col("raw").isNotNull(), "attempt"))).alias("raw"))
    return chosen.withColumn("dados", text.parse_answer(F.col("raw"), schema))


# ------------------------------------------------------------------------ incremental use
Extract = Callable[[DataFrame, str], DataFrame]


def keyword_extract(terms: Mapping[str, Sequence[str]], options: Mapping[str, Mapping[str, Sequence[str]]]) -> Extract:
    def extract(sources: DataFrame, kind: str) -> DataFrame:
        fields = keyword_fields(F.col("source"), SCHEMAS[kind], terms, options)
        return sources.select("id", fields.alias("dados"), F.lit(True).alias("ok"))

    return extract


def generator_extract(generators: Sequence[tuple[str, Callable[[str], str], int]], delay: float = RETRY_DELAY,
                      tasks: int | None = None, log_path: str | None = None) -> Extract:
    """Extract through text generators.

    With ``log_path`` every raw answer is kept there (kind, run, id, attempt, model, answer, error),
    and the answers are read from that log, so that nothing calls a generator twice.
    """
    def extract(sources: DataFrame, kind: str) -> DataFrame:
        prompts = sources.select("id", F.concat_ws("\n", "source", F.lit(_instructions(kind))).alias("prompt"))
        attempts = generate_answers(prompts, SCHEMAS[kind], generators, delay, tasks)
        if log_path:
            run_path = f"{log_path}/kind={kind}/run={uuid.uuid4().hex}"
            attempts.write.parquet(run_path)
            attempts = sources.sparkSession.read.schema(ATTEMPT_SCHEMA).parquet(run_path)
        return last_answers(attempts, SCHEMAS[kind]).select("id", "dados", "ok")

    return extract


def job_source(df: DataFrame) -> Column:
    present = {k: c for k, c in JOB_PROMPT_COLUMNS.items() if c in df.columns}
    return F.concat_ws("\n", *[
        F.concat(F.lit(f"{k}: "), text.first_text(F.col(c), _column_type(df, c))) for k, c in present.items()])


def candidate_source(df: DataFrame, column: str = CANDIDATE_PROMPT_COLUMN) -> Column:
    return text.first_text(F.col(column), _column_type(df, column))


def pending(df: DataFrame, id_column: str, source: Column, done: DataFrame | None) -> DataFrame:
    """Distinct unprocessed ids with the text to read. A null id cannot be tracked and is left out.

    Every row of an id carries the same entity text; ``max`` makes the choice repeatable and
    combines map-side, so a hot id is one row per task before the shuffle.
    """
    sources = df.select(F.col(id_column).alias("id"), source.alias("source"))
    if done is not None:
        sources = not_in(sources, done.select("id"), "id")
    return sources.where("id IS NOT NULL").groupBy("id").agg(F.max("source").alias("source"))


def extract_new(df: DataFrame, kind: str, extract: Extract, done: DataFrame | None = None) -> DataFrame:
    """(id, dados, ok) for the ids not in ``done``."""
    id_column, source = (("codigo_vaga", job_source(df)) if kind == "vaga"
                         else ("codigo_candidato", candidate_source(df)))
    return extract(pending(df, id_column, source, done), kind)


def extract_new_entities(df: DataFrame, kind: str, entities: DataFrame, extract: Extract,
                         done: DataFrame | None = None) -> DataFrame:
    """The same with the texts from the job or candidate table, which has one row per key.

    The pair rows give only their distinct ids, so the long texts are not shuffled once per pair.
    ``entities`` carries the prefixed columns; ``df`` is not disambiguated yet.
    """
    key = "codigo_vaga" if kind == "vaga" else "codigo_candidato"
    own = F.col(key) if kind == "vaga" else text.tell_apart(F.col(key), F.col("codigo_vaga"))
    ids = df.select(own.alias("id"), F.col(key).alias("_key")).where("id IS NOT NULL").distinct()
    if done is not None:
        ids = not_in(ids, done.select("id"), "id")
    source = job_source(entities) if kind == "vaga" else candidate_source(entities)
    texts = entities.select(F.col(key).alias("_key"), source.alias("source"))
    return extract(ids.join(texts, "_key").select("id", "source"), kind)


def disambiguate(df: DataFrame) -> DataFrame:
    """Candidate ids that equal the job id of their row get a suffix."""
    return df.withColumn("codigo_candidato", text.tell_apart(F.col("codigo_candidato"), F.col("codigo_vaga")))


def spread_fields(answers: DataFrame, schema: T.StructType, prefix: str, key: str) -> DataFrame:
    return answers.select(F.col("id").alias(key), *answer_fields(F.col("dados"), schema, prefix))


def answer_fields(answer: Column, schema: T.StructType, prefix: str) -> list[Column]:
    return [answer.getField(f.name).alias(f"{prefix}{f.name}") for f in schema.fields]


def attach_extracted(df: DataFrame, job_answers: DataFrame, candidate_answers: DataFrame) -> DataFrame:
    """Rows whose job and candidate were both extracted, with ``job_`` and ``app_`` fields."""
    return enrich(df,
                  spread_fields(job_answers.where("ok"), JOB_SCHEMA, "job_", "codigo_vaga"),
                  spread_fields(candidate_answers.where("ok"), CANDIDATE_SCHEMA, "app_", "codigo_candidato"))


def batch_candidates(applicants: DataFrame, extract: Extract, done: DataFrame | None = None) -> DataFrame:
    """Candidates read straight from the applicants table; invalid answers are kept, failures dropped."""
    df = rename_if_absent(applicants, "cv_pt", CANDIDATE_PROMPT_COLUMN)
    answers = extract(pending(df, "codigo_candidato", candidate_source(df), done), "candidato")
    return answers.where("dados IS NOT NULL").select("id", "dados", "ok")


ship_with_tasks(sys.modules[__name__])
