"""Match scores of candidate/job pairs. All scores are added in place; no self-joins."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import matching, text, vectors
from ..session import store
from .embedding import Encoder
from .features import sentiment_columns
from .terms import list_scores, text_similarity
from .tfidf import Tfidf
from .training import score_probability

# --- fixed values: column names and thresholds of the recruiting tables -------------------
SKILL_THRESHOLD = 0.5
CULTURE_NEUTRAL = 0.5
JOB_LEVELS = {"professional": "job_pv_nivel_profissional", "academic": "job_pv_nivel_academico",
              "english": "job_pv_nivel_ingles"}
CANDIDATE_LEVELS = {"professional": "app_ip_nivel_profissional", "academic": "app_fei_nivel_academico",
                    "english": "app_fei_nivel_ingles"}
LEVEL_SCORES = {"professional": "score_senioridade", "academic": "score_academico", "english": "score_ingles"}
SKILL_TEXTS = (["job_pv_principais_atividades", "job_pv_competencia_tecnicas_e_comportamentais"],
               ["app_ip_conhecimentos_tecnicos", "app_cv_pt"])
CULTURE_TEXTS = (["job_pv_habilidades_comportamentais_necessarias", "job_ib_objetivo_vaga"],
                 ["app_ib_objetivo_profissional", "p_comentario"])
CLUSTERS = 3
SEED = 42
# --------------------------------------------------------------------------------------------


def skill_similarity(job_vectors: Column, candidate_vectors: Column, threshold: float = SKILL_THRESHOLD) -> Column:
    return vectors.mean_best_cosine(job_vectors, candidate_vectors, threshold, 0.0)


def culture_similarity(job_vectors: Column, candidate_vectors: Column) -> Column:
    return vectors.mean_best_cosine(job_vectors, candidate_vectors, None, CULTURE_NEUTRAL)


def list_similarities(pairs: DataFrame, jobs: DataFrame, candidates: DataFrame, job_key: str, candidate_key: str,
                      encode: Encoder | Tfidf) -> DataFrame:
    """``skill`` and ``culture`` of distinct pairs of keys, from tables (key, skills, culture) of lists of terms."""
    return list_scores(pairs, jobs, candidates, job_key, candidate_key, encode, {
        "skill": ("skills", "skills", SKILL_THRESHOLD, 0.0), "culture": ("culture", "culture", None, CULTURE_NEUTRAL)})


def entity_texts(table: DataFrame, columns: list[str]) -> DataFrame:
    """(text): the joined texts of a job or candidate table with prefixed columns."""
    return table.select(text.join_texts(*[F.col(c) for c in columns]).alias("text"))


def structured_columns(df: DataFrame, job: Mapping[str, str] = JOB_LEVELS,
                       candidate: Mapping[str, str] = CANDIDATE_LEVELS) -> DataFrame:
    """The three level scores and their weighted sum.

    The level numbers are columns of their own first, so each text is looked up once.
    """
    df = df.withColumns({f"_{side}_{k}": matching.level_score(F.col(columns[k]))
                         for side, columns in (("job", job), ("app", candidate)) for k in job})
    df = df.withColumns({LEVEL_SCORES[k]: matching.requirement_ratio(F.col(f"_job_{k}"), F.col(f"_app_{k}")) for k in job})
    parts = {k: F.col(LEVEL_SCORES[k]) for k in job}
    return (df.withColumn("structured_match_score", matching.weighted(parts, matching.LEVEL_WEIGHTS))
            .drop(*[f"_{side}_{k}" for side in ("job", "app") for k in job]))


def total_skill_score(semantic: Column, structured: Column) -> Column:
    return matching.weighted({"semantic": semantic, "structured": structured}, matching.TOTAL_WEIGHTS)


def baseline_technical(structured: Column, cosine: Column) -> Column:
    return matching.weighted({"structured": structured, "cosine": cosine}, matching.BASELINE_WEIGHTS)


def weighted_technical(soft: Column, structured: Column, cosine: Column) -> Column:
    return matching.weighted({"soft": soft, "structured": structured, "cosine": cosine}, matching.TECHNICAL_WEIGHTS)


def technical_baseline(df: DataFrame, encode: Encoder | Tfidf, entities: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Structured score, text similarity and their weighted sum.

    ``entities`` are the prefixed job and candidate tables, if the distinct texts should come from there.
    """
    job, candidate = SKILL_TEXTS
    texts = entities and entity_texts(entities[0], job).unionAll(entity_texts(entities[1], candidate))
    df = structured_columns(df).withColumns({
        "_job_text": text.join_texts(*[F.col(c) for c in job]),
        "_app_text": text.join_texts(*[F.col(c) for c in candidate]),
    })
    df = text_similarity(df, "_job_text", "_app_text", "soft_match_score", encode, texts).drop("_job_text", "_app_text")
    return df.withColumn("final_technical_score", baseline_technical(
        F.col("structured_match_score"), F.col("soft_match_score")))


def technical_ranking(df: DataFrame, job_vectors: str | None, candidate_vectors: str | None, encode: Encoder | Tfidf,
                      texts: tuple[str, str] = ("job_pv_principais_atividades", "app_cv_pt"),
                      candidate_levels: Mapping[str, str] = CANDIDATE_LEVELS,
                      entities: tuple[DataFrame, DataFrame] | None = None, soft: str | None = None) -> DataFrame:
    """Pairs ranked by the weighted sum of skill match, level match and text similarity.

    Skills are compared by their list-of-vector columns, or ``soft`` names the column of a skill match that was computed
    before; missing texts read as ''. ``entities`` as in :func:`technical_baseline`.
    """
    known = entities and entity_texts(entities[0], texts[:1]).unionAll(entity_texts(entities[1], texts[1:]))
    df = structured_columns(df, candidate=candidate_levels).withColumns({
        "soft_match_score": F.col(soft) if soft else skill_similarity(F.col(job_vectors), F.col(candidate_vectors)),
        "_left": F.coalesce(F.col(texts[0]), F.lit("")), "_right": F.coalesce(F.col(texts[1]), F.lit("")),
    })
    df = text_similarity(df, "_left", "_right", "cosine_similarity_score", encode, known).withColumn(
        "technical_score", weighted_technical(F.col("soft_match_score"), F.col("structured_match_score"),
                                              F.coalesce("cosine_similarity_score", F.lit(0.0))))
    names = ["codigo_vaga", "codigo_candidato", "soft_match_score", "structured_match_score",
             "cosine_similarity_score", "technical_score"]
    # a sort reads its input twice, once to find the ranges
    return ranking(store(df.select(*names), "ranked"), {n: n for n in names}, "technical_score")


def cultural_baseline(df: DataFrame, encode: Encoder | Tfidf) -> DataFrame:
    job, candidate = CULTURE_TEXTS
    df = df.withColumns({
        "job_culture_text": text.join_texts(*[F.col(c) for c in job]),
        "app_culture_text": text.join_texts(*[F.col(c) for c in candidate]),
    })
    return text_similarity(df, "job_culture_text", "app_culture_text", "cultural_score", encode)


def behaviour_score(df: DataFrame, model: PipelineModel | None = None, output: str = "score_behavioral") -> DataFrame:
    """Add the probability of a fitted engagement model, else the comment heuristic; no other column changes.

    The model sees the columns of the table and, computed here from cleaned texts, the sentiment of the comment and the
    listed recruiter.
    """
    comment = text.clean_text(F.col("p_comentario")) if "p_comentario" in df.columns else F.lit("")
    if model is None:
        return df.withColumn(output, matching.behaviour_score(text.sentiment(comment, text.SENTIMENT_SCORING)))
    recruiter = text.clean_text(F.col("p_recrutador")) if "p_recrutador" in df.columns else F.lit(None).cast("string")
    ready = sentiment_columns(df.withColumns({"_comment": comment, "p_recrutador_tratado": text.keep_listed(recruiter, text.COMMON_RECRUITERS)}),
                              text.SENTIMENT_SCORING, "_comment")
    scored = score_probability(model, ready, "_probability").withColumnRenamed("_probability", output)
    return scored.select(*[c for c in df.columns if c != output], output)


def behavioural_scores(df: DataFrame, model: PipelineModel | None = None) -> DataFrame:
    """(candidate, job, score): the probability of a fitted engagement model, else the comment heuristic."""
    return behaviour_score(df, model).select("codigo_candidato", "codigo_vaga", "score_behavioral")


def cultural_scores(df: DataFrame, job_vectors: str, candidate_vectors: str) -> DataFrame:
    """(candidate, job, score) from list-of-vector columns."""
    return df.select("codigo_candidato", "codigo_vaga",
                     culture_similarity(F.col(job_vectors), F.col(candidate_vectors)).alias("score_cultural"))


def ranking(df: DataFrame, columns: Mapping[str, str], final: str, digits: int = 3) -> DataFrame:
    """The named columns (output name -> column), fractions rounded, best ``final`` first."""
    kinds = dict(df.dtypes)
    shown = [(F.round(F.col(c), digits) if kinds[c] in ("double", "float") else F.col(c)).alias(name)
             for name, c in columns.items()]
    return df.select(*shown).orderBy(F.desc(final))


def rank_centers(centers: DataFrame, center: str = "center", output: str = "tier") -> DataFrame:
    """Number the cluster centres in ascending order, from 0. The table has one row per cluster."""
    return centers.withColumn(output, F.row_number().over(Window.orderBy(center)) - 1)


def add_tiers(df: DataFrame, score: str, clusters: int = CLUSTERS, seed: int = SEED, output: str = "tier") -> DataFrame:
    """Cluster a score and number the clusters from low to high; a null score has no tier."""
    assemble = VectorAssembler(inputCols=[score], outputCol="_point", handleInvalid="skip")
    points = assemble.transform(df.select(F.col(score).cast("double").alias(score)))
    model = KMeans(k=clusters, seed=seed, featuresCol="_point", predictionCol="_cluster").fit(points)
    centers = df.sparkSession.createDataFrame(
        [(i, float(c[0])) for i, c in enumerate(model.clusterCenters())], "_cluster int, center double")
    ranked = rank_centers(centers, output=output).drop("center")
    scored = model.transform(VectorAssembler(inputCols=["_score"], outputCol="_point", handleInvalid="keep")
                             .transform(df.withColumn("_score", F.col(score).cast("double"))))
    out = scored.join(F.broadcast(ranked), "_cluster").drop("_cluster", "_point", "_score")
    return out.withColumn(output, F.when(F.col(score).isNotNull(), F.col(output)))
