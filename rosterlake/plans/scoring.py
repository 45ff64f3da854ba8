"""Curated tables -> feature table -> extracted fields -> scored pairs."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import extraction, features, scoring, training
from ..operators.embedding import Encoder
from ..operators.joins import join_entities, latest_value, prefix_columns
from ..operators.terms import text_key
from ..operators.tfidf import Tfidf
from ..session import freed_shuffles, over_all_cores, scratch_path, small_methods, store
from ..sources.ledger import Ledger
from ..sources.tables import delete_path, read_parquet, write_parquet

#: The scoring job joins its wide rows in so many parts, one after the other.
PARTS = 8
STATES = {"vaga": "vagas_processadas", "candidato": "candidatos_processados"}


def feature_table(prospects: DataFrame, applicants: DataFrame, jobs: DataFrame, today: Column | None = None) -> DataFrame:
    """Joined rows with all structured features, in one plan.

    ``today`` defaults to the latest application date among the joined rows. The tables are scans. Contact columns of
    which only the presence flag stays travel as a mark.
    """
    contact = [c.removeprefix("app_") for c in features.CONTACT_FLAGS.values() if c not in features.CANDIDATE_PLACES]
    marked = applicants.withColumns({c: F.when(text.is_filled(F.col(c)), "x") for c in contact if c in applicants.columns})
    joined = join_entities(over_all_cores(prospects), marked, jobs)
    return features.build_features(joined, today)


def wide_rows(spark: SparkSession, path: str, prospects: DataFrame, applicants: DataFrame, jobs: DataFrame, today: Column) -> DataFrame:
    """The rows of :func:`feature_table`, stored under ``path``. They are joined in ``PARTS`` parts of the jobs, so that the
    shuffles of wide rows hold one part at a time."""
    for part in range(PARTS):
        mine = F.pmod(F.xxhash64("codigo_vaga"), F.lit(PARTS)) == part
        rows = feature_table(prospects.where(mine), applicants, jobs.where(mine), today)
        rows.write.mode("append").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def run_extraction(spark: SparkSession, rows: DataFrame, folder: str, extract: extraction.Extract,
                   entities: dict[str, DataFrame] | None = None, batch: tuple[str, int] | None = None) -> DataFrame:
    """Extract the ids that are new, commit them to the ledger of answers, return the enriched rows.

    A restart skips what an earlier run finished. Failed ids are not stored, so the next run tries
    them again. Jobs and candidates are committed together, one row per id also if two runs are at work at
    once; ``batch`` (stream, number) makes a repeated batch change nothing. ``entities`` (``vaga``,
    ``candidato``) are the prefixed job and candidate tables, if the texts should come from there rather
    than from the pair rows.
    """
    answers = commit_answers(spark, rows, folder, extract, entities, batch)
    return extraction.attach_extracted(extraction.disambiguate(rows), answers["vaga"], answers["candidato"])


def commit_answers(spark: SparkSession, rows: DataFrame, folder: str, extract: extraction.Extract,
                   entities: dict[str, DataFrame] | None = None, batch: tuple[str, int] | None = None) -> dict[str, DataFrame]:
    """The extraction of :func:`run_extraction` without its join: the stored answers. With ``entities`` the two keys of the rows suffice."""
    apart = extraction.disambiguate(rows)
    ledger, new = Ledger(spark, f"{folder}/answers"), {}
    for kind, name in STATES.items():
        done = ledger.read(name)
        found = (extraction.extract_new(apart, kind, extract, done) if entities is None
                 else extraction.extract_new_entities(rows, kind, entities[kind], extract, done))
        new[name] = found.where("ok").select("id", "dados", "ok")
    ledger.commit(new, unique="id", batch=batch)
    return read_answers(spark, folder)


def read_answers(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The stored answers of jobs and candidates (``vaga``, ``candidato``), one row per id."""
    ledger = Ledger(spark, f"{folder}/answers")
    return {kind: ledger.read(name) for kind, name in STATES.items()}


def score_pairs(df: DataFrame, job_vectors: tuple[str, str], candidate_vectors: tuple[str, str]) -> DataFrame:
    """Add the three scores in place, and the level scores they use.

    ``job_vectors`` and ``candidate_vectors`` name the list-of-vector columns of skills and culture.
    """
    return with_scores(df, scoring.skill_similarity(F.col(job_vectors[0]), F.col(candidate_vectors[0])),
                       scoring.culture_similarity(F.col(job_vectors[1]), F.col(candidate_vectors[1])))


def with_scores(df: DataFrame, skill: Column, culture: Column, model: PipelineModel | None = None) -> DataFrame:
    """Add the three scores from the two similarities, and the level scores they use; ``model`` is the fitted
    engagement model, if there is one."""
    df = scoring.structured_columns(df).withColumns({
        "score_skills": scoring.total_skill_score(skill, F.col("structured_match_score")), "score_cultural": culture})
    return scoring.behaviour_score(df, model)


def listed(df: DataFrame, key: str, prefix: str, given: DataFrame | None) -> DataFrame:
    """Add ``_<prefix>``, the skills and the culture of the job or candidate of each row, and ``_<prefix>_key``, a digest of both."""
    if given is None:
        skills = F.concat(F.col(f"{prefix}_competencias_tecnicas"), F.col(f"{prefix}_ferramentas_tecnologicas"))
        df = df.withColumn(f"_{prefix}", F.struct(skills.alias("skills"), F.col(f"{prefix}_competencias_comportamentais").alias("culture")))
    else:
        df = df.join(given.select(key, F.struct("skills", "culture").alias(f"_{prefix}")), key, "left")
    return df.withColumn(f"_{prefix}_key", text_key(F.coalesce(F.to_json(f"_{prefix}"), F.lit(""))))


def score_table(df: DataFrame, encode: Encoder | Tfidf | None = None, job_lists: DataFrame | None = None,
                candidate_lists: DataFrame | None = None, model: PipelineModel | None = None) -> DataFrame:
    """Enriched rows -> rows with the three scores; raw rows get their features first. Rows without a job or candidate id go.

    The lists are those of the row unless tables (key, skills, culture) are given. Rows with equal lists have equal scores, so
    only the distinct pairs of lists are compared; the wide rows meet two numbers by the digests of their lists, in place
    where these pairs are few.
    """
    ids = ["codigo_vaga", "codigo_candidato"]
    df = features.build_features(df).dropna(subset=ids)
    rows = listed(listed(df, "codigo_vaga", "job", job_lists), "codigo_candidato", "app", candidate_lists)
    side = lambda name: rows.select(f"_{name}_key", f"_{name}.skills", f"_{name}.culture").distinct()
    similar = store(scoring.list_similarities(rows.select("_job_key", "_app_key").distinct(), side("job"), side("app"), "_job_key", "_app_key",
                                              encode or Tfidf()).withColumnsRenamed({"skill": "_skill", "culture": "_culture"}), "similar")
    rows = rows.join(similar, ["_job_key", "_app_key"]).select(*ids, *[c for c in df.columns if c not in ids], "_skill", "_culture")
    return with_scores(rows, F.col("_skill"), F.col("_culture"), model).drop("_skill", "_culture")


def pair_keys(prospects: DataFrame, applicants: DataFrame, jobs: DataFrame) -> DataFrame:
    """The two keys and the application date of the rows that :func:`feature_table` will have."""
    keys = prospects.select(F.col("p_codigo").alias("codigo_candidato"), "codigo_vaga", "p_data_candidatura")
    return (keys.join(applicants.select("codigo_candidato"), "codigo_candidato", "left_semi")
            .join(jobs.select("codigo_vaga"), "codigo_vaga", "left_semi"))


def with_answers(table: DataFrame, key: str, answers: DataFrame, name: str = "_answer", suffix: str = "") -> DataFrame:
    """Add the answer of each entity (of its id with ``suffix``) as a struct, null without one."""
    found = answers.where("ok").select(F.col("id").alias("_id"), F.struct("dados").alias(name))
    own = F.concat(F.col(key), F.lit(suffix)) if suffix else F.col(key)  # the plain key keeps its partitioning
    return table.join(found, own == F.col("_id"), "left").drop("_id")


def enriched_rows(wide: DataFrame, columns: list[str]) -> DataFrame:
    """:func:`extraction.attach_extracted` of feature rows (``columns``) that carry their answers."""
    ids = ["codigo_candidato", "codigo_vaga"]
    apart = F.col("codigo_candidato") == F.col("codigo_vaga")
    candidate = F.when(apart, F.col("app__answer_apart")).otherwise(F.col("app__answer"))
    rows = extraction.disambiguate(wide.withColumn("_app", candidate)).where("_app IS NOT NULL AND job__answer IS NOT NULL")
    return rows.select(*ids, *[c for c in columns if c not in ids],
                       *extraction.answer_fields(F.col("job__answer.dados"), extraction.JOB_SCHEMA, "job_"),
                       *extraction.answer_fields(F.col("_app.dados"), extraction.CANDIDATE_SCHEMA, "app_"))


def run(spark: SparkSession, curated: str, folder: str, output: str, extract: extraction.Extract,
        encode: Encoder | Tfidf | None = None, model_path: str | None = None) -> DataFrame:
    """The whole job: curated tables -> feature table -> enriched table -> scored table, each stored.

    An engagement model exported to ``model_path`` is loaded once and gives the behavioural score.

    The extraction needs the keys of the pairs only, so it comes first: its answers join the entities, and the wide rows
    are built and shuffled once, part by part. The feature table and the enriched table are projections of them, and they go
    when these are written. Shuffle files of a step go when it is stored. Its projections of some seventy
    columns run as several generated methods.
    """
    with freed_shuffles(spark), small_methods(spark):
        prospects, applicants, jobs = (read_parquet(spark, f"{curated}/{n}.parquet") for n in ("prospects", "applicants", "jobs"))
        entities = {"vaga": prefix_columns(jobs, "job_", ["codigo_vaga"]),
                    "candidato": prefix_columns(applicants, "app_", ["codigo_candidato"])}
        pairs = store(pair_keys(prospects, applicants, jobs), "pairs")
        answers = commit_answers(spark, pairs, folder, extract, entities)
        people = with_answers(applicants, "codigo_candidato", answers["candidato"])
        people = store(with_answers(people, "codigo_candidato", answers["candidato"], "_answer_apart", text.APART), "people")
        path = scratch_path(spark, "wide")
        wide = wide_rows(spark, path, prospects, people, with_answers(jobs, "codigo_vaga", answers["vaga"]),
                         latest_value(pairs, "p_data_candidatura"))
        table = wide.drop("app__answer", "app__answer_apart", "job__answer")
        write_parquet(table, f"{folder}/features.parquet")
        write_parquet(enriched_rows(wide, table.columns), f"{folder}/resultado_final.parquet")
        delete_path(spark, path)
        scored = score_table(read_parquet(spark, f"{folder}/resultado_final.parquet"), encode, model=training.exported_model(spark, model_path))
        write_parquet(scored, output)
    return read_parquet(spark, output)
