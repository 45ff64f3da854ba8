"""Level, list-overlap and weighted-score expressions."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip_space

# --- fixed values -----------------------------------------------------------------
LEVELS = {
    "NENHUM": 0, "BÁSICO": 1, "INTERMEDIÁRIO": 2, "AVANÇADO": 3, "FLUENTE": 4, "TÉCNICO": 1.5,
    "JÚNIOR": 1, "JUNIOR": 1, "PLENO": 2, "SÊNIOR": 3, "SENIOR": 3, "ESPECIALISTA": 4, "LÍDER": 5,
    "ENSINO MÉDIO COMPLETO": 1, "ENSINO SUPERIOR INCOMPLETO": 2, "ENSINO SUPERIOR COMPLETO": 3,
    "PÓS-GRADUAÇÃO": 4, "MESTRADO": 4, "DOUTORADO": 4,
}
LEVEL_WEIGHTS = {"professional": 0.6, "academic": 0.2, "english": 0.2}
TOTAL_WEIGHTS = {"semantic": 0.7, "structured": 0.3}
BASELINE_WEIGHTS = {"structured": 0.4, "cosine": 0.6}
TECHNICAL_WEIGHTS = {"soft": 0.60, "structured": 0.15, "cosine": 0.25}
OVERLAP_WEIGHTS = {"tools": 0.4, "skills": 0.4, "seniority": 0.1, "degree": 0.1}
OVERLAP_FINAL_WEIGHTS = {"technical": 0.7, "cultural": 0.3}
BEHAVIOUR_SCORES = {1: 0.9, -1: 0.2, 0: 0.5}
# ----------------------------------------------------------------------------------


def level_score(c: Column, levels: Mapping[str, float] = LEVELS) -> Column:
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable((k, float(v)) for k, v in levels.items())])
    return F.coalesce(F.try_element_at(table, strip_space(F.upper(c))), F.lit(0.0))


def requirement_ratio(job_value: Column, candidate_value: Column) -> Column:
    """Share of the required level that the candidate has, capped at 1.

    No requirement is fully met; a missing candidate level meets nothing.
    """
    ratio = F.least(F.try_divide(candidate_value, job_value), F.lit(1.0))
    return F.when(job_value == 0, 1.0).when(candidate_value == 0, 0.0).otherwise(ratio)


def level_match(job_level: Column, candidate_level: Column) -> Column:
    return requirement_ratio(level_score(job_level), level_score(candidate_level))


def weighted(parts: Mapping[str, Column], weights: Mapping[str, float]) -> Column:
    total = F.lit(0.0)
    for name, weight in weights.items():
        total = total + parts[name] * F.lit(float(weight))
    return total


def structured_match(job_levels: Mapping[str, Column], candidate_levels: Mapping[str, Column],
                     weights: Mapping[str, float] = LEVEL_WEIGHTS) -> Column:
    return weighted({k: level_match(job_levels[k], candidate_levels[k]) for k in weights}, weights)


def list_union(a: Column, b: Column) -> Column:
    return F.array_distinct(F.concat(a, b))


def list_coverage(have: Column, need: Column) -> Column:
    """Distinct common items over the number of required items (duplicates kept); no requirement = 1."""
    return F.when(F.coalesce(F.size(need), F.lit(0)) <= 0, 1.0).otherwise(
        F.try_divide(F.size(F.array_intersect(have, need)).cast("double"), F.size(need)))


def overlap_scores(tools: Column, skills: Column, same_seniority: Column, has_degree: Column,
                   behaviour: Column) -> dict[str, Column]:
    """Technical, cultural and final percentage from list coverages and two yes/no columns."""
    technical = weighted({
        "tools": tools,
        "skills": skills,
        "seniority": F.when(same_seniority, 1.0).otherwise(0.5),
        "degree": F.when(has_degree, 1.0).otherwise(0.0),
    }, OVERLAP_WEIGHTS)
    final = weighted({"technical": technical, "cultural": behaviour}, OVERLAP_FINAL_WEIGHTS)
    return {
        "score_tecnico": F.round(technical * 100, 2),
        "score_cultural": F.round(behaviour * 100, 2),
        "score_final": F.round(final * 100, 2),
    }


def behaviour_score(sentiment: Column) -> Column:
    return (F.when(sentiment == 1, BEHAVIOUR_SCORES[1])
            .when(sentiment == -1, BEHAVIOUR_SCORES[-1])
            .otherwise(BEHAVIOUR_SCORES[0]))
